"""Operator 2, quality rules: a threshold table compiled into one projection.

``RULES`` is data: a feature, a lower and an upper bound.  ``compile_rules``
turns the table into one expression over length, symbol, stop-word and line
ratios; Spark evaluates it in the scan's stage, with no user functions, no
shuffle and no state between rows.

Defined cases: NULL, empty and blank texts have no words, all counts 0, and
fail the base rule; ratios over nothing are 0; repeated rows are judged one
by one; an empty table gives an empty result.  Repeated 3-word windows are
compared by 64-bit hashes within one text.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlake.llm.common import let, read, words

#: Fixed value: frequent function words of the languages of the corpus.
STOP_WORDS = (
    "the of and to in is it that for on with as by this be are was at or an "
    "de la le les un une des que et en du pour dans par qui sur "
    "el los las del por una con para se su "
    "der die das und von mit den ist ein nicht zu sich auf"
).split()


class Rule(NamedTuple):
    name: str
    feature: str
    low: float | None
    high: float | None


#: The production threshold table.
RULES = (
    Rule("word_length", "mean_word_chars", 2.0, 12.0),
    Rule("symbols", "symbol_ratio", None, 0.1),
    Rule("stop_words", "stop_word_ratio", 0.02, None),
    Rule("repeated_lines", "dup_line_ratio", None, 0.5),
    Rule("upper_case", "upper_word_ratio", None, 0.5),
    Rule("exclamations", "exclamation_ratio", None, 0.5),
    Rule("ellipsis_lines", "ellipsis_line_ratio", None, 0.5),
)


def repeat_words(w: Column) -> Column:
    """Words covered by 3-word windows that occur at least twice in the text.

    Windows are sorted by (hash, place); equal neighbours are repeats.  Their
    places, in order, cover three words each, less where they overlap.
    O(n log n), and only for texts that have a repeat at all.
    """
    n = F.size(w)
    windows = F.when(
        n >= 3,
        F.transform(
            F.sequence(F.lit(0), n - 3), lambda j: F.xxhash64(F.get(w, j), F.get(w, j + 1), F.get(w, j + 2))
        ),
    ).otherwise(F.array().cast("array<bigint>"))

    def places(s: Column) -> Column:
        def repeated(x: Column, i: Column) -> Column:
            return (x["h"] == F.get(s, i - 1)["h"]) | (x["h"] == F.get(s, i + 1)["h"])

        kept = F.filter(s, lambda x, i: F.coalesce(repeated(x, i), F.lit(False)))
        return F.array_sort(F.transform(kept, lambda x: x["j"]))

    def covered(p: Column) -> Column:
        gaps = F.transform(p, lambda j, k: F.least(F.coalesce(F.get(p, k + 1) - j, F.lit(3)), F.lit(3)))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: a + g)

    def count(t: Column) -> Column:
        pairs = F.array_sort(F.transform(t, lambda h, j: F.struct(h.alias("h"), j.alias("j"))))
        return F.when(
            F.size(F.array_distinct(t)) < F.size(t), let(pairs, lambda s: let(places(s), covered))
        ).otherwise(F.lit(0).cast("long"))

    return let(windows, count)


def count_if(array: Column, test) -> Column:
    return F.size(F.filter(array, test)).cast("long")


def counts(text: Column) -> Column:
    """Base counts of a text as one struct of longs."""
    t = F.coalesce(text, F.lit(""))

    def of_words(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.aggregate(w, F.lit(0).cast("long"), lambda a, x: a + F.char_length(x)).alias("word_chars"),
            repeat_words(w).alias("n_repeat_words"),
            count_if(w, lambda x: F.lower(F.rtrim(x, F.lit(".,;:"))).isin(*STOP_WORDS)).alias("n_stop_words"),
            count_if(w, lambda x: (F.upper(x) == x) & (F.lower(x) != x) & (F.char_length(x) > 1)).alias("n_upper_words"),
            count_if(w, lambda x: x.endswith("!")).alias("n_exclamations"),
        )

    def of_lines(lines: Column) -> Column:
        return F.struct(
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            count_if(lines, lambda x: F.rtrim(x).endswith("...") | F.rtrim(x).endswith("…")).alias("n_ellipsis_lines"),
        )

    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return F.struct(
        F.regexp_count(t, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        let(words(text), of_words).alias("w"),
        let(lines, of_lines).alias("l"),
    )


def flat(c: Column) -> dict[str, Column]:
    """The longs of ``counts`` by name."""
    of_words = ("n_words", "word_chars", "n_repeat_words", "n_stop_words", "n_upper_words", "n_exclamations")
    of_lines = ("n_lines", "n_dup_lines", "n_ellipsis_lines")
    return {"n_symbols": c["n_symbols"]} | {n: c["w"][n] for n in of_words} | {n: c["l"][n] for n in of_lines}


def features(c: dict[str, Column]) -> dict[str, Column]:
    """Ratios that rules may bound, over ``flat`` counts."""

    def ratio(a: str, b: str) -> Column:
        return F.when(c[b] > 0, c[a].cast("double") / c[b]).otherwise(F.lit(0.0))

    return {
        "n_words": c["n_words"].cast("double"),
        "mean_word_chars": ratio("word_chars", "n_words"),
        "symbol_ratio": ratio("n_symbols", "n_words"),
        "stop_word_ratio": ratio("n_stop_words", "n_words"),
        "dup_line_ratio": ratio("n_dup_lines", "n_lines"),
        "upper_word_ratio": ratio("n_upper_words", "n_words"),
        "exclamation_ratio": ratio("n_exclamations", "n_words"),
        "ellipsis_line_ratio": ratio("n_ellipsis_lines", "n_lines"),
        "repeat_word_ratio": ratio("n_repeat_words", "n_words"),
    }


def compile_rules(rules: Sequence[Rule], values: dict[str, Column]) -> Column:
    """Name of the first rule that a text breaks, NULL if none."""
    first = F.lit(None).cast("string")
    for r in reversed(rules):
        v = values[r.feature]
        broken = F.lit(False)
        if r.low is not None:
            broken = broken | (v < r.low)
        if r.high is not None:
            broken = broken | (v > r.high)
        first = F.when(broken, F.lit(r.name)).otherwise(first)
    return first


def verdict(text: Column, rules: Sequence[Rule] = RULES) -> Column:
    """Counts, base_failed, broken_rule and kept as one struct.

    The counts are bound as one value: a filter on the verdict would otherwise
    be rewritten to count anew at each mention.
    """

    def of_counts(c: Column) -> Column:
        n = flat(c)
        base = (n["n_words"] < 50) | (100 * n["n_repeat_words"] > 50 * n["n_words"])
        return F.struct(
            *[v.alias(k) for k, v in n.items()],
            base.alias("base_failed"),
            compile_rules(rules, features(n)).alias("broken_rule"),
        )

    def with_kept(v: Column) -> Column:
        kept = ~v["base_failed"] & v["broken_rule"].isNull()
        return v.withField("kept", kept)

    return let(let(counts(text), of_counts), with_kept)


def judge(docs: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text") -> DataFrame:
    """The input's rows with a struct ``__q``: counts, base_failed, broken_rule and kept."""
    return docs.withColumn("__q", verdict(F.col(text_col), rules))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    q = judge(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return q.select(
        "doc_id", "__q.n_words", "__q.word_chars", "__q.n_symbols", "__q.n_dup_lines", "__q.n_repeat_words",
        "__q.base_failed", "__q.kept", "__q.broken_rule",
    )


_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)

OP2_SQL = rf"""
with t as (select doc_id, row_number() over () as r, coalesce(text, '') as text from documents),
w as (select r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as w,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l from t),
g as (select r, unnest(range(len(w) - 2)) as j, w from w where len(w) >= 3),
k as (select r, j, count(*) over (partition by r, w[j + 1], w[j + 2], w[j + 3]) as n from g),
p as (select r, count(distinct i) as n_repeat_words
      from (select r, unnest([j, j + 1, j + 2]) as i from k where n > 1) group by r),
c as (select w.doc_id, len(w) as n_words,
        coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
        len(regexp_extract_all(text, '[#*$%&|<>]')) as n_symbols,
        len(l) - len(list_distinct(l)) as n_dup_lines, len(l) as n_lines,
        coalesce(p.n_repeat_words, 0) as n_repeat_words,
        len(list_filter(w, lambda x: lower(rtrim(x, '.,;:')) in ({_STOP}))) as n_stop,
        len(list_filter(w, lambda x: upper(x) = x and lower(x) <> x and length(x) > 1)) as n_upper,
        len(list_filter(w, lambda x: ends_with(x, '!'))) as n_bang,
        len(list_filter(l, lambda x: ends_with(rtrim(x, ' '), '...') or ends_with(rtrim(x, ' '), '…'))) as n_ellipsis
      from w left join p on w.r = p.r),
v as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
        case when n_words = 0 then 'word_length'
             when word_chars / n_words < 2.0 or word_chars / n_words > 12.0 then 'word_length'
             when n_symbols / n_words > 0.1 then 'symbols'
             when n_stop / n_words < 0.02 then 'stop_words'
             when n_dup_lines / n_lines > 0.5 then 'repeated_lines'
             when n_upper / n_words > 0.5 then 'upper_case'
             when n_bang / n_words > 0.5 then 'exclamations'
             when n_ellipsis / n_lines > 0.5 then 'ellipsis_lines' end as broken_rule from c)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and broken_rule is null as kept, broken_rule from v
"""
