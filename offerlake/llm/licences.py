"""Operator 5, licence scans: canonical digest lookup.

A text is brought to one canonical form: lower case; lines that state who holds
the rights dropped (running text that opens a line with the word stays);
every run of characters that are neither letters nor digits turned into one
space; equivalent spellings replaced.  Two texts that differ in nothing else
share the digest of that form, so whole texts are matched to known licences by
a hash join on digests.  The same digests of single lines find one-line
notices inside longer texts.

The known texts are those of ``licence_texts.py`` (short permissive licences, and
the headers that stand for licences of many pages) and, where a caller has them,
a table or a folder of reference texts, of any number and length.

Defined cases: NULL, empty and blank texts, and texts of copyright lines
alone, have no digest and match nothing; repeated rows match one by one; a
digest that is listed for two licences goes to the first by name; reference
texts that are NULL or blank, or have no name, are left out; an empty table or
an empty list of licences gives no matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlake.llm.common import lookup, read
from offerlake.llm.licence_texts import NOTICES, SPELLINGS, TEXTS
from offerlake.session import materialize

#: The word within running text, at a line's end or before what is no holder: marked by capitals, as texts are lower case.
RUNNING = (
    r"(?m)\bcopyright([^\pL\pN\n©]*$|[^\pL\pN\n©]+(?:notices?|holders?|owners?|licen[cs]es?|laws?|statements?|permissions?"
    r"|interests?|treaty|rights?|patents?|trademarks?|protection|disclaimers?|status|and|or|on|in|is|as|to|for|of|the (?:software|library|program))\b)"
)
#: A line that only states who holds the rights: it opens with the word or the sign.
COPYRIGHT = r"(?m)^[^\pL\pN\n]*(?:copyright\b|©|c\) *[0-9]{4}|all rights reserved)[^\n]*$"
NOT_TEXT = r"[^\pL\pN\n]+"


def canonical_lines(text: Column) -> Column:
    """Canonical lines of a text: an array without empty lines."""
    t = F.lower(F.coalesce(text, F.lit("")))
    t = F.regexp_replace(t, RUNNING, "COPYRIGHT$1")
    t = F.regexp_replace(t, COPYRIGHT, "")
    t = F.replace(t, F.lit("COPYRIGHT"), F.lit("copyright"))
    t = F.regexp_replace(t, NOT_TEXT, " ")
    for variant, kept in SPELLINGS:
        t = F.replace(t, F.lit(variant), F.lit(kept))
    return F.filter(F.transform(F.split(t, "\n"), lambda x: F.trim(x)), lambda x: x != "")


def digest(lines: Column) -> Column:
    """Digest of a text by its canonical lines; line breaks count as spaces."""
    return F.when(F.size(lines) > 0, F.sha2(F.array_join(lines, " "), 256))


def known(spark: SparkSession, texts=TEXTS + NOTICES, reference: DataFrame | None = None) -> DataFrame:
    """Digests of known texts: (digest, licence).

    ``reference`` adds a table (licence, text), such as ``licence_folder`` reads.
    """
    rows = spark.createDataFrame(list(texts), "licence string, text string")
    if reference is not None:
        rows = rows.unionAll(reference.select(F.col("licence").cast("string"), F.col("text").cast("string")))
    rows = rows.select(digest(canonical_lines(F.col("text"))).alias("digest"), "licence")
    return rows.filter("digest is not null and licence is not null").groupBy("digest").agg(F.min("licence").alias("licence"))


def licence_folder(spark: SparkSession, path: str) -> DataFrame:
    """Reference texts (licence, text) from a folder of whole texts, each named <licence id>.txt."""
    files = spark.read.text(path, wholetext=True, pathGlobFilter="*.txt")
    name = F.url_decode(F.replace(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1), F.lit("+"), F.lit("%2B")))
    return files.select(F.regexp_replace(name, r"\.txt$", "").alias("licence"), F.col("value").alias("text"))


def scan(docs: DataFrame, licences: DataFrame, text_col: str = "text") -> DataFrame:
    """The input's rows with __lines, __digest and __licence (of the whole text).

    ``licences`` (digest, licence) is a reference list.  The whole texts are
    hash-joined to it.
    """
    d = docs.withColumn("__lines", canonical_lines(F.col(text_col)))
    d = d.withColumn("__digest", digest(F.col("__lines")))
    d = lookup(d, licences.select(F.col("digest").alias("__digest"), F.col("licence").alias("__licence")), ["__digest"])
    return d


def notices(lines: Column, listed: list[tuple[str, str]]) -> Column:
    """Licences named by single lines, sorted and comma-joined; '' if none."""
    by_digest = F.create_map(*[F.lit(x) for pair in listed for x in pair])
    keys = [k for k, _ in listed]
    hits = F.filter(F.transform(lines, lambda x: F.sha2(x, 256)), lambda x: x.isin(*keys))
    return F.array_join(F.array_sort(F.array_distinct(F.transform(hits, lambda x: by_digest[x]))), ",")


def op5_licence_scan(spark: SparkSession, sf_dir: str, reference: DataFrame | None = None) -> DataFrame:
    """Digest, licence of the whole text and licences of notice lines, for every document.

    ``reference`` (licence, text) adds licences to those of the package.
    """
    licences = materialize(known(spark, reference=reference))
    short = [(r["digest"], r["licence"]) for r in known(spark, NOTICES).collect()]  # a fixed list
    d = scan(read(spark, sf_dir, "documents").select("doc_id", "text"), licences)
    return d.select(
        "doc_id", F.col("__digest").alias("digest"), F.col("__licence").alias("licence"),
        notices(F.col("__lines"), short).alias("notices"),
    )


def _sql_lines(text: str) -> str:
    """DuckDB text of ``canonical_lines``."""
    t = f"lower(coalesce({text}, ''))"
    # This engine's classes need braces; its word boundary is the same here.
    for pattern, by in ((RUNNING, r"COPYRIGHT\1"), (COPYRIGHT, ""), ("COPYRIGHT", "copyright"), (NOT_TEXT, " ")):
        t = f"regexp_replace({t}, '{pattern.replace(chr(92) + 'pL', chr(92) + 'p{L}').replace(chr(92) + 'pN', chr(92) + 'p{N}')}', '{by}', 'g')"
    for variant, kept in SPELLINGS:
        t = f"replace({t}, '{variant}', '{kept}')"
    return f"list_filter(list_transform(string_split({t}, chr(10)), lambda x: trim(x)), lambda x: x <> '')"


def _sql_values(texts) -> str:
    return ", ".join("('%s', '%s')" % (k, t.replace("'", "''")) for k, t in texts)


OP5_SQL = f"""
with k as (select sha256(array_to_string({_sql_lines('t')}, ' ')) as digest, min(licence) as licence
           from (values {_sql_values(TEXTS + NOTICES)}) v(licence, t) group by 1),
n as (select sha256(array_to_string({_sql_lines('t')}, ' ')) as digest, licence
      from (values {_sql_values(NOTICES)}) v(licence, t)),
d as (select doc_id, row_number() over () as r, {_sql_lines('text')} as l from documents),
h as (select r, string_agg(distinct licence, ',' order by licence) as notices
      from (select r, sha256(unnest(l)) as digest from d) join n using (digest) group by r)
select doc_id, case when len(l) > 0 then sha256(array_to_string(l, ' ')) end as digest, licence,
       coalesce(notices, '') as notices
from d left join k on len(l) > 0 and sha256(array_to_string(l, ' ')) = k.digest left join h using (r)
"""
