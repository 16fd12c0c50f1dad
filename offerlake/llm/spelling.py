"""Operator 12, spelling variants: words that differ by one code point, found in a trie.

1. Words are counted, combined before the shuffle, and those with enough
   letters and occurrences kept (``counted_words``).
2. Every word enters one trie twice, forwards and backwards (two subtrees).  Its
   edges are a table: node, character, child, and which characters leave the
   child (``edge_table``).  A node is named by the characters on its way.
3. The frontier holds states (word, position, node, edits).  A word starts at
   each of its own nodes from its middle on, with no edit: an edit in its first
   half is one in the second half of the word backwards.  Level by level the
   states are joined with the edges of that depth: a state without an edit takes
   another character than the word's (replaced), or one more (inserted); a state
   with one edit takes the word's next character.  An edge that knows that no
   way goes on from its child yields no state.
4. A state that has read its word with one edit and ends where a word ends is a
   near pair.  A deleted character is an insertion seen from the other word.

A level's edges travel once, in that level, and at most one edge leaves a node for
each character of the alphabet; adaptive execution splits the states of a node
that very many words pass.  Words of over LONG code points are not walked
level by level: they meet by the fingerprints of what is left when one code point
is left out (``long_pairs``), and are compared whole.

Defined cases: NULL and empty texts have no words; a row without an id hashes as an
empty id; repeated rows count again; ties go to the smallest word in
code-point order; an empty table gives an empty result; extra columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlake.llm.common import read
from offerlake.llm.suffix_index import fingerprint, mix, running
from offerlake.session import scratch_path

#: Least code points and occurrences of a word, and how many times more often its form occurs.
LETTERS, OCCURRENCES, TIMES = 7, 2, 10
#: One run in so many loses a code point.
SLIP = 31
#: Code points up to which words walk the trie.
LONG = 48
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words whose states one task of a level handles.
TASK_WORDS = 50_000
#: Bit that marks a word's end among the bits of the letters a to z.
_END = 1 << 26


def counted_words(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", letters: int = LETTERS, occurrences: int = OCCURRENCES
) -> DataFrame:
    """(word, n): runs of letters, some of them with a code point left out, that are long and frequent enough."""
    runs = F.regexp_extract_all(F.col(text_col), F.lit("([A-Za-zÀ-ÿ]{%d,}+)" % letters))
    found = docs.select(F.col(id_col).cast("string").alias("id"), F.explode(runs).alias("run"))
    found = found.select("id", F.translate("run", _UPPER, _LOWER).alias("run"))
    h = F.crc32(F.concat(F.coalesce("id", F.lit("")), F.lit(":"), "run").cast("binary"))
    found = found.select("run", h.alias("h"))
    # Bound where it is used: only a row in SLIP needs the place.
    slipped = F.expr(f"if(h % {SLIP} = 0, concat(left(run, int(h % length(run))), substr(run, int(h % length(run)) + 2)), run)")
    words = found.select(slipped.alias("word")).filter(F.length("word") >= letters)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= occurrences)


def marked(words: DataFrame) -> DataFrame:
    """(w): every word forwards behind ``>`` and backwards behind ``<``."""
    return words.select(F.explode(F.array(F.concat(F.lit(">"), "word"), F.concat(F.lit("<"), F.reverse("word")))).alias("w"))


def start_depth(w: str = "w") -> str:
    """Where a marked word's states start: after its mark and half of its characters."""
    return f"if(startswith({w}, '>'), 1 + (length({w}) - 1) div 2, length({w}) - (length({w}) - 1) div 2)"


def code(text: str, at: str) -> str:
    """SQL: the code point at a place of a marked word, 0 past its end."""
    return f"if({at} > length({text}), 0, ascii(substr({text}, {at}, 1)))"


def bits(c: str) -> tuple[str, str]:
    """SQL for the bits of a code point: of a to z and a word's end (0), and of U+00C0 to U+00FF."""
    low = f"if({c} = 0, {_END}L, if({c} < 128, shiftleft(1L, {c} - 97), 0L))"
    return low, f"if({c} >= 192, shiftleft(1L, {c} - 192), 0L)"


def leads_to(c: str) -> str:
    """SQL: whether the code points after the child hold ``c``, or a word's end where it is 0."""
    low, high = bits(c)
    return f"((low & {low}) != 0 or (high & {high}) != 0)"


def edge_table(words: DataFrame, letters: int = LETTERS) -> DataFrame:
    """Edges of the trie: depth, node, c (the edge's code point), and the bits of what leaves the child (low, high).

    Only edges below the depth where the shortest words' states start.
    """
    first = 2 + letters // 2  # the first child that any state reaches
    ways = marked(words).select("w", F.explode(F.sequence(F.lit(first), F.length("w"))).alias("k"))
    ways = ways.select(F.expr("left(w, k)").alias("child"), F.expr(code("w", "k + 1")).alias("next"))
    low, high = bits("next")
    nodes = ways.groupBy("child").agg(F.bit_or(F.expr(low)).alias("low"), F.bit_or(F.expr(high)).alias("high"))
    depth = (F.length("child") - 1).alias("depth")
    return nodes.select(depth, F.expr("left(child, length(child) - 1) node"), F.expr("ascii(right(child, 1)) c"), "low", "high")


def walked_pairs(words: DataFrame, letters: int = LETTERS) -> DataFrame:
    """Near pairs (word, near) of words of at most LONG code points; each pair from one side at least."""
    spark = words.sparkSession
    deepest, count = words.agg(F.max(F.length("word")), F.count("*")).first()
    if not count:
        return words.select("word", F.col("word").alias("near"))
    # A level of few words needs few files.
    tasks = max(spark.sparkContext.defaultParallelism, count // TASK_WORDS)
    first, base = 1 + letters // 2, scratch_path(spark, "spelling-trie")
    edge_table(words, letters).coalesce(tasks).sortWithinPartitions("depth").write.parquet(f"{base}/edges")
    edges = spark.read.parquet(f"{base}/edges")
    starts = marked(words).withColumn("start", F.expr(start_depth()))
    # here: the word's next code point, then: the one after it.
    carry = f"e = 1 and c = here and {leads_to('then')}"
    replace = f"e = 0 and here != 0 and c > here and {leads_to('then')}"
    insert = f"e = 0 and c != here and {leads_to('here')}"
    for depth in range(first, deepest + 2):
        states = starts.filter((F.col("start") <= depth) & (F.length("w") >= depth)).select(
            "w", F.lit(depth).alias("k"), F.expr(f"left(w, {depth}) node"), F.lit(0).alias("e")
        )
        if depth > first:
            states = states.unionAll(spark.read.parquet(f"{base}/level={depth}").filter("not done").select(*states.columns))
        states = states.selectExpr("*", f"{code('w', 'k + 1')} here", f"{code('w', 'k + 2')} then")
        step = edges.filter(F.col("depth") == depth).drop("depth")
        joined = states.join(step, "node").filter(f"({carry}) or ({replace}) or ({insert})")
        places = f"if(e = 1, array(k + 1), if({replace}, if({insert}, array(k, k + 1), array(k + 1)), array(k)))"
        moved = joined.select("w", F.explode(F.expr(places)).alias("k"), F.expr("concat(node, char(c)) node"), F.lit(1).alias("e"))
        moved.withColumn("done", F.expr("k = length(w)")).coalesce(tasks).write.parquet(f"{base}/level={depth + 1}")
    ends = spark.read.option("basePath", base).parquet(*[f"{base}/level={d + 1}" for d in range(first, deepest + 2)])
    plain = lambda c: F.expr(f"if(startswith({c}, '>'), substr({c}, 2), reverse(substr({c}, 2)))")
    return ends.filter("done").select(plain("w").alias("word"), plain("node").alias("near"))


def long_pairs(words: DataFrame) -> DataFrame:
    """Near pairs (word, near) among words of over LONG - 1 code points, each from one side at least.

    A word gives the fingerprint of what is left without its i-th code point, for
    each i, and its own.  At most one word for each character of the alphabet
    shares (i, rest), so the groups are small; pairs are compared at the end.
    """
    names = ["id", "size", "i", "rest"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                data = np.frombuffer(t.encode("latin-1"), np.uint8)
                n = len(data)
                sums, at = running(data), np.arange(n + 1)
                head, tail = fingerprint(sums, 0 * at, at), fingerprint(sums, at, 0 * at + n)
                # What is left without each code point; and the word parted where a longer one would have one more.
                rest, own = mix(head[:-1] + mix(tail[1:])), mix(head + mix(tail))
                place = pa.array(np.r_[at[:-1], -1 - at])
                keys = pa.array(np.r_[rest, own].view(np.int64))
                same = [pa.array([v], k).take(pa.array(np.zeros(len(keys), np.int64))) for v, k in ((name, pa.string()), (n, pa.int64()))]
                whole = pa.RecordBatch.from_arrays([*same, place, keys], names=names)
                yield from (whole.slice(a, 10_000) for a in range(0, len(keys), 10_000))

    named = words.filter(F.length("word") >= LONG).select(F.md5(F.col("word").cast("binary")).alias("id"), "word")
    keys = named.mapInArrow(run, "id string, size long, i long, rest long")
    out = keys.filter("i >= 0")
    other = out.select("i", "rest", F.col("id").alias("near"), F.col("size").alias("near_size"))
    own = keys.filter("i < 0").select((-1 - F.col("i")).alias("i"), "rest", F.col("id").alias("near"), F.col("size").alias("near_size"))
    replaced = out.join(other, ["i", "rest"]).filter("id < near and size = near_size")
    shorter = out.join(own, ["i", "rest"]).filter("size = near_size + 1")
    pairs = replaced.unionAll(shorter).filter(f"size > {LONG} or near_size > {LONG}").select("id", "near").distinct()
    pairs = pairs.join(named, "id").select("near", "word")
    pairs = pairs.join(named.select(F.col("id").alias("near"), F.col("word").alias("w")), "near").select("word", F.col("w").alias("near"))
    return pairs.filter("levenshtein(word, near, 1) = 1")


def near_pairs(words: DataFrame, letters: int = LETTERS) -> DataFrame:
    """All ordered pairs (word, near, near_n) of words that differ by one code point; ``words`` must be stored."""
    found = walked_pairs(words.filter(F.length("word") <= LONG), letters).unionAll(long_pairs(words))
    once = found.select(F.least("word", "near").alias("word"), F.greatest("word", "near").alias("near")).distinct()
    both = once.select(F.inline(F.array(F.struct("word", "near"), F.struct(F.col("near").alias("word"), F.col("word").alias("near")))))
    return both.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")


def with_roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words with a form: forms are followed by doubling until none has another.

    Every form is TIMES as frequent as its word, so the ways are short and never turn back.
    """
    spark = forms.sparkSession
    path = scratch_path(spark, "spelling-roots")
    forms.select("word", F.col("form").alias("root")).write.parquet(f"{path}/0")
    for i in range(64):
        now = spark.read.parquet(f"{path}/{i}")
        on = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        far = now.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        far.write.parquet(f"{path}/{i + 1}")
        if not spark.read.parquet(f"{path}/{i + 1}").filter("moved").limit(1).count():
            break
    return spark.read.parquet(f"{path}/{i + 1}").select("word", "root")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per word: form, root, n, n_near and form_n."""
    spark = docs.sparkSession
    path = scratch_path(spark, "spelling-words")
    counted_words(docs, id_col, text_col).write.parquet(path)
    words = spark.read.parquet(path)
    best = F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("form")))
    near = near_pairs(words).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("b"))
    told = scratch_path(spark, "spelling-near")
    joined = words.join(near, "word", "left").withColumn("has", -F.col("b.m") >= TIMES * F.col("n"))
    joined.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("has"), F.col("b.form")).alias("form"),
        F.when(F.col("has"), -F.col("b.m")).cast("long").alias("form_n"),
    ).write.parquet(told)
    told = spark.read.parquet(told)
    roots = with_roots(told.filter("form is not null"))
    return told.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of ``documents`` with the far more frequent word that it is a slip of."""
    return variants(read(spark, sf_dir, "documents"))


#: Near words as those that share (place, rest without that code point), or whose rest is the other word; CRC-32 by its table.
OP12_SQL = """
WITH RECURSIVE crc AS (SELECT list(v ORDER BY b) AS t FROM (
       SELECT b, list_reduce(list_prepend(CAST(b AS UBIGINT), CAST(range(8) AS UBIGINT[])),
                lambda c, k: xor(c >> 1, (c & 1) * 3988292384::UBIGINT)) AS v
       FROM (SELECT unnest(range(256)) AS b))),
runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
many AS (SELECT doc_id, run, count(*) AS k FROM runs WHERE length(run) >= 7 GROUP BY doc_id, run),
raw AS (SELECT *, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS x FROM many),
hashed AS (SELECT run, k, xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(range(1, length(x) // 2 + 1),
             lambda i: CAST('0x' || substr(x, 2 * i - 1, 2) AS UBIGINT))),
             lambda c, v: xor(c >> 8, t[CAST(xor(c, v) & 255 AS BIGINT) + 1])), 4294967295::UBIGINT) AS h FROM raw, crc),
words AS (SELECT CASE WHEN h % 31 = 0 THEN left(run, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2)
            ELSE run END AS word, CAST(sum(k) AS BIGINT) AS n FROM hashed GROUP BY 1),
w AS (SELECT word, n FROM words WHERE length(word) >= 7 AND n >= 2),
cut AS (SELECT word, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM w)),
one AS (SELECT a.word, b.word AS near FROM cut a JOIN cut b USING (i, rest) WHERE a.word <> b.word
        UNION SELECT c.word, w.word FROM cut c JOIN w ON w.word = c.rest
        UNION SELECT w.word, c.word FROM cut c JOIN w ON w.word = c.rest),
near AS (SELECT one.word, count(*) AS n_near, min({'m': -v.n, 'f': one.near}) AS b FROM one JOIN w v ON v.word = one.near GROUP BY 1),
told AS (SELECT w.word, w.n, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near,
           CASE WHEN -b.m >= 10 * w.n THEN b.f END AS form, CASE WHEN -b.m >= 10 * w.n THEN -b.m END AS form_n
         FROM w LEFT JOIN near ON near.word = w.word),
way AS (SELECT word, word AS at, form AS next FROM told
        UNION ALL SELECT way.word, way.next, t.form FROM way JOIN told t ON t.word = way.next)
SELECT told.word, told.form, way.at AS root, told.n, told.n_near, CAST(told.form_n AS BIGINT) AS form_n
FROM told JOIN way ON way.word = told.word AND way.next IS NULL
"""
