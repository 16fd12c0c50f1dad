"""Operator 10, n-gram Jaccard join by prefix trees.

Texts whose 3-word shingle sets (kept as 64-bit hashes) have a Jaccard
similarity of at least ``percent`` / 100 are linked; the result names each
text's connected component.  Equal sets are one node throughout.

1. One pass makes each text's set, its digest, and, per task, the most
   frequent shingles (a Misra-Gries summary).  At most FREQUENT of them form
   the end of the global order, by rising count; all other shingles come
   before, by hash.  Any such order gives right results; this one keeps
   passages that many texts share out of the prefixes.
2. Two linked sets share a shingle among the first ``n - need + 1`` of both.
   Each text sends these to their shingle's group with its size and place.
   Groups are counted, and large ones split, by a second common shingle or
   into blocks that meet pairwise, before any task holds one.
   Groups of one end there.  Small groups emit their pairs, each pair once
   after a distinct; then both texts' sketches are compared: how many members
   fall into each hash cell.  The sum of the cells' differences never exceeds
   the sets' difference, so pairs beyond the bound are no links.  Large groups
   fetch the sketches first and emit a spanning forest of the candidates
   instead of all pairs.
3. Connected candidates are gathered with their texts, in ranges of set size
   when one component is large, and joined exactly: a prefix tree of the
   ordered sets is walked by each set, sharing the partial overlap of common
   beginnings and leaving subtrees by the lengths that remain.
4. The exact links' connected components are the result.

Defined cases: NULL, empty and blank texts have an empty set and link with
nothing; texts of fewer words than a shingle have one shingle; repeated rows
and equal sets share a component; rows with a NULL id name no component and
make no links, but take the component of an equal set, else NULL; an empty table
gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from offerlake.llm.common import BROADCAST_ROWS, kept, read, sliced, whole_groups
from offerlake.llm.components import components
from offerlake.llm.prefix_tree import forest
from offerlake.session import materialize, scratch_path

#: Most shingles that the global order may hold as frequent; the list has a fixed size limit.
FREQUENT = 50_000
#: Entries of a task's summary of frequent shingles.
SUMMARY = 50_000
#: Rows of a shingle's group that one task compares; larger groups are split.
GROUP_ROWS = 2_000
#: Shingles of the texts that one tree joins; larger components are cut by set size.
TREE_SHINGLES = 2_000_000
#: Words whose hash a worker remembers.
REMEMBERED = 100_000


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of a text's words, A-Z in lower case."""
    found = text.encode("utf-8", "surrogatepass").lower().split()
    memory = kept("word hashes", dict)
    get = memory.get
    out = []
    for w in found:
        h = get(w)
        if h is None:
            h = xxhash.xxh64_intdigest(w)
            if len(w) <= 64:
                if len(memory) >= REMEMBERED:
                    memory.clear()
                memory[w] = h
        out.append(h)
    return np.array(out, np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64 bits (the finaliser of a common public hash)."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingles(text: str | None, width: int) -> np.ndarray:
    """Distinct shingle hashes of a text, ascending."""
    if not text:
        return np.empty(0, np.uint64)
    w = word_hashes(text)
    if len(w) == 0:
        return w
    width = min(width, len(w))
    n = len(w) - width + 1
    h = np.full(n, width, np.uint64)
    for k in range(width):
        h = mix(h + w[k : k + n])
    return np.unique(h)


def digest(s: np.ndarray) -> bytes:
    return xxhash.xxh128_digest(s.tobytes())


def node_of(d: bytes) -> int:
    return int.from_bytes(d[:8], "little", signed=True)


class Summary:
    """The most frequent values of a stream, Misra-Gries style: counts are never too large."""

    def __init__(self, size: int):
        self.size, self.values, self.counts = size, np.empty(0, np.uint64), np.empty(0, np.int64)
        self.waiting: list[np.ndarray] = []
        self.n = 0

    def add(self, values: np.ndarray) -> None:
        self.waiting.append(values)
        self.n += len(values)
        if self.n >= 8 * self.size:
            self.settle()

    def settle(self) -> None:
        if not self.waiting:
            return
        v, c = np.unique(np.concatenate(self.waiting), return_counts=True)
        self.waiting, self.n = [], 0
        both = np.concatenate([self.values, v])
        v, inv = np.unique(both, return_inverse=True)
        c = np.bincount(inv, np.concatenate([self.counts, c]), len(v)).astype(np.int64)
        if len(v) > self.size:
            c = c - np.partition(c, len(c) - self.size - 1)[len(c) - self.size - 1]
            v, c = v[c > 0], c[c > 0]
        self.values, self.counts = v, c


def sets(docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """Rows of texts (id, n, digest) and rows of frequent shingles (token, df), told apart by ``token``."""
    kind = docs.schema[id_col].dataType
    schema = pa.schema(
        [("id", to_arrow_type(kind)), ("n", pa.int64()), ("digest", pa.binary()), ("node", pa.int64()), ("sketch", pa.binary())]
        + [("token", pa.int64()), ("df", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, seen = Summary(SUMMARY), set()
        for b in sliced(batches, 512):
            n, d, k = [], [], []
            for t in b.column(1).to_pylist():
                s = shingles(t, width)
                n.append(len(s))
                k.append(sketch(s) if len(s) else None)
                d.append(digest(s) if len(s) else None)
                if len(s) and d[-1] not in seen:
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen.add(d[-1])
                    common.add(s)
            node, none = [x and node_of(x) for x in d], pa.nulls(len(n), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(d, pa.binary()), pa.array(node, pa.int64())]
                + [pa.array(k, pa.binary()), none, none],
                schema=schema,
            )
        common.settle()
        v, c = common.values[common.counts >= 4], common.counts[common.counts >= 4]
        top = np.argsort(-c, kind="stable")[:FREQUENT]
        if len(top):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.nulls(len(top), schema[0].type), pa.nulls(len(top), pa.int64()), pa.nulls(len(top), pa.binary()),
                    pa.nulls(len(top), pa.int64()), pa.nulls(len(top), pa.binary()), pa.array(v[top].view(np.int64)), pa.array(c[top]),
                ],
                schema=schema,
            )

    # The id column's name may be anything; inside it is called id.
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {kind.simpleString()}, n long, digest binary, node long, sketch binary, token long, df long"
    )


def cells(n):
    """Hash cells of a sketch by set size: larger sets need more to be told apart."""
    n = np.asarray(n)
    return np.where(n <= 400, 64, np.where(n <= 1_500, 128, np.where(n <= 5_000, 256, 512)))


def sketch(s: np.ndarray) -> bytes:
    """Members per hash cell, modulo 256."""
    k = int(cells(len(s)))
    return np.bincount((mix(s) >> np.uint64(40)).astype(np.int64) % k, minlength=k).astype(np.uint8).tobytes()


def folded(sketches: list[bytes], k: int) -> np.ndarray:
    """Sketches of k or more cells as rows of k cells."""
    out = np.empty((len(sketches), k), np.uint8)
    for i, b in enumerate(sketches):
        v = np.frombuffer(b, np.uint8)
        out[i] = v if len(v) == k else v.reshape(-1, k).sum(axis=0, dtype=np.uint8)
    return out


def least_difference(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """A lower bound of the sets' differences: a cell's difference, modulo 256, taken the short way round."""
    d = x - y
    return np.minimum(d, -d).sum(axis=-1, dtype=np.int64)


def least_common(na, nb, percent: int):
    """Smallest intersection of two linked sets of these sizes."""
    return -(-percent * (na + nb) // (100 + percent))


class Order:
    """The global order of shingles: by hash, frequent ones last, by rising count."""

    def __init__(self, frequent: list[tuple[int, int]]):
        ranked = sorted(frequent, key=lambda x: (x[1], x[0]))
        tokens = np.array([t for t, _ in ranked], np.int64).view(np.uint64)
        by_value = np.argsort(tokens, kind="stable")
        self.tokens, self.rank = tokens[by_value], by_value
        self.df = np.array([c for _, c in ranked], np.int64)[by_value]

    def frequent(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which members of an ascending set are frequent, and their places in the list."""
        if not len(self.tokens):
            return np.zeros(len(s), bool), np.zeros(len(s), np.int64)
        at = np.minimum(np.searchsorted(self.tokens, s), len(self.tokens) - 1)
        return self.tokens[at] == s, at

    def sort(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """An ascending set in global order, and the members' counts (0: not frequent)."""
        hit, at = self.frequent(s)
        last = np.flatnonzero(hit)
        last = last[np.argsort(self.rank[at[last]], kind="stable")]
        order = np.concatenate([np.flatnonzero(~hit), last])
        df = np.where(hit, self.df[at] if len(self.df) else 0, 0)
        return s[order], df[order]


#: Columns of a prefix row; place is n << 32 | position.
COLUMNS = ["key", "node", "place"]


def prefixes(docs: DataFrame, frequent, percent: int, width: int, text_col: str) -> DataFrame:
    """One row of COLUMNS per prefix shingle of each distinct set, and one for the shingle that follows the prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, seen = Order(frequent.value), set()
        out: list[np.ndarray] = []
        size = 0
        for b in sliced(batches, 512):
            for t in b.column(0).to_pylist():
                s = shingles(t, width)
                if not len(s) or (d := digest(s)) in seen:
                    continue
                if len(seen) >= REMEMBERED:
                    seen.clear()
                seen.add(d)
                n = len(s)
                p = n + percent * n // -100 + 1  # n - ceil(percent / 100 * n) + 1
                key = order.sort(s)[0][: p + 1]
                out.append(np.stack([key.view(np.int64), np.full(len(key), node_of(d)), (n << 32) | np.arange(len(key))], axis=1))
                size += len(key)
                if size >= 20_000:
                    yield table(out, COLUMNS)
                    out, size = [], 0
        if out:
            yield table(out, COLUMNS)

    return docs.select(F.col(text_col).alias("text")).mapInArrow(run, ", ".join(f"{c} long" for c in COLUMNS))


def dealt(rows: DataFrame, percent: int, group_rows: int) -> DataFrame:
    """Prefix rows under the keys by which they meet, in groups of about ``group_rows`` at most.

    Groups are counted, and those with more rows are split in one of two ways,
    whichever makes fewer rows.  Two different sets that link at more than 50
    percent have two shingles in common, both among the prefixes and the
    shingles that follow them; so a row may meet others under its shingle and each later
    one.  Or the group, and what such pairs of shingles leave too large, is cut
    into blocks that meet pairwise.
    """
    pos = F.col("place").bitwiseAND(0xFFFFFFFF)
    later = F.expr(f"(place >> 32) - ({percent} * (place >> 32) + 99) div 100 + 1") - pos  # 0: follows the prefix
    first = rows.filter(later > 0)
    counted = materialize(first.groupBy("key").count().filter(F.col("count") > group_rows).select("key"))
    n = counted.limit(BROADCAST_ROWS + 1).count()
    if not n:
        return first

    def few(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if n <= BROADCAST_ROWS else df  # one row for each large group

    rest = first.join(few(counted), "key", "left_anti")
    hot = materialize(first.join(few(counted), "key", "left_semi").distinct())  # a set comes once from each task
    parts = F.floor(F.col("df") / group_rows) + 1
    size = hot.groupBy("key").agg(F.count("*").alias("df"), F.sum(later).alias("ahead"))
    size = size.select("key", (F.lit(percent > 50) & (F.col("ahead") < F.col("df") * parts)).alias("paired"))
    hot = hot.join(few(size), "key")
    one = hot.filter("paired").select(*COLUMNS)
    two = rows.join(one.select("node").distinct(), "node", "left_semi").distinct()
    two = two.select("node", F.col("key").alias("second"), pos.alias("at"))
    pairs = one.join(two, "node").filter(F.col("at") > pos).select(F.xxhash64("key", "second").alias("key"), "node", "place")
    both = materialize(pairs.unionAll(hot.filter("not paired").select(*COLUMNS)))
    large = both.groupBy("key").agg(F.count("*").alias("df")).filter(F.col("df") > group_rows).select("key", parts.alias("parts"))
    cut = both.join(large, "key", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    cut = cut.withColumn("own", F.pmod(F.xxhash64("node"), "parts")).withColumn("other", F.explode(F.expr("sequence(0L, parts - 1)")))
    block = F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other"))
    return rest.unionAll(cut.select(F.when(F.col("parts") == 1, F.col("key")).otherwise(block).alias("key"), "node", "place"))


def table(rows: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
    m = np.concatenate(rows)
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(m[:, i])) for i in range(m.shape[1])], names=names)


def possible(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of prefix rows (a[i], b[i]) may be links with this shingle as their first common one."""
    na, nb = a[:, 2] >> 32, b[:, 2] >> 32
    rest = np.minimum(na - (a[:, 2] & 0xFFFFFFFF), nb - (b[:, 2] & 0xFFFFFFFF))
    return (rest >= least_common(na, nb, percent)) & (a[:, 1] != b[:, 1])


#: Groups of up to so many rows emit their pairs.
SMALL_GROUP = 12


def small_and_large(m: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Of whole groups, rows sorted by key: the pairs of small ones, [k, 2] of nodes, and the rows of large ones."""
    cuts = np.flatnonzero(np.r_[True, m[1:, 0] != m[:-1, 0], True])
    sizes = np.diff(cuts)
    s, pairs = m[np.repeat((sizes > 1) & (sizes <= SMALL_GROUP), sizes)], []
    for ahead in range(1, SMALL_GROUP):
        a = np.flatnonzero(s[ahead:, 0] == s[:-ahead, 0]) if len(s) > ahead else np.empty(0, int)
        if not len(a):
            break
        a = a[possible(s[a], s[a + ahead], percent)]
        pairs.append(np.stack([s[a, 1], s[a + ahead, 1]], axis=1))
    e = np.concatenate(pairs) if pairs else np.empty((0, 2), np.int64)
    return np.unique(np.sort(e, axis=1), axis=0), m[np.repeat(sizes > SMALL_GROUP, sizes)]


def longs(t: pa.Table) -> np.ndarray:
    return np.stack([t.column(c).to_numpy() for c in COLUMNS], axis=1)


def grouped(rows: DataFrame, percent: int) -> DataFrame:
    """The groups of ``rows``, each in one place: pairs (key NULL, node, place: two nodes) and rows of large groups."""
    schema = pa.schema([(c, pa.int64()) for c in COLUMNS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, COLUMNS):
            pairs, large = small_and_large(longs(t), percent)
            none = pa.nulls(len(pairs), pa.int64())
            yield pa.RecordBatch.from_arrays([none, *(pa.array(c) for c in np.ascontiguousarray(pairs.T))], schema=schema)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in np.ascontiguousarray(large.T)], schema=schema)

    dealt = rows.repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(run, ", ".join(f"{c} long" for c in COLUMNS))


def alike(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (u, v) that their sketches allow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            u, v, na, nb = (b.column(i).to_numpy() for i in range(4))
            sa, sb = b.column(4).to_pylist(), b.column(5).to_pylist()
            k, ok = np.minimum(cells(na), cells(nb)), np.zeros(len(u), bool)
            for width in np.unique(k):
                at = np.flatnonzero(k == width)
                apart = least_difference(folded([sa[i] for i in at], width), folded([sb[i] for i in at], width))
                ok[at] = apart <= (na + nb - 2 * least_common(na, nb, percent))[at]
            yield pa.RecordBatch.from_arrays([pa.array(u[ok]), pa.array(v[ok])], names=["u", "v"])

    def side(node: str, n: str, s: str) -> DataFrame:
        return sketches.select(F.col("node").alias(node), F.col("n").alias(n), F.col("sketch").alias(s))

    both = pairs.distinct().join(side("u", "na", "sa"), "u").join(side("v", "nb", "sb"), "v")
    return both.select("u", "v", "na", "nb", "sa", "sb").mapInArrow(run, "u long, v long")


def group_edges(g: np.ndarray, sketches: list[bytes], percent: int) -> np.ndarray:
    """A spanning forest of one large group's candidates, [k, 2] of nodes."""
    # Rows by size, so that a set's possible partners are neighbours.
    order = np.lexsort((g[:, 1], g[:, 2] >> 32))
    g, sketches = g[order], [sketches[i] for i in order]
    n = g[:, 2] >> 32
    width = int(cells(n.min()))
    cell, wide = folded(sketches, width), sketches
    out, left = [], np.arange(len(g))
    while len(left) > 1:
        wave, left = left[:1], left[1:]
        while len(wave) and len(left):
            here, wave = wave[0], wave[1:]
            lo, hi = np.searchsorted(n[left], [-(-percent * n[here] // 100), 100 * n[here] // percent + 1])
            near = left[lo:hi]
            ok = possible(np.broadcast_to(g[here], (len(near), 3)), g[near], percent)
            limit = n[here] + n[near] - 2 * least_common(n[here], n[near], percent)
            at = np.flatnonzero(ok)
            ok[at] = least_difference(cell[here], cell[near[at]]) <= limit[at]
            for i in np.flatnonzero(ok) if len(wide[here]) > width else ():  # the rest at full width
                k = min(len(wide[here]), len(wide[near[i]]))
                ok[i] = least_difference(*folded([wide[here], wide[near[i]]], k)) <= limit[i]
            if ok.any():
                found = near[ok]
                left = np.delete(left, lo + np.flatnonzero(ok))
                out.append(np.stack([np.full(len(found), g[here, 1]), g[found, 1]], axis=1))
                wave = np.concatenate([wave, found])
    return np.concatenate(out) if out else np.empty((0, 2), np.int64)


def large_edges(rows: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Candidate edges (u, v) of large groups."""
    names = [*COLUMNS, "sketch"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, names):
            m, s, edges = longs(t), t.column("sketch").to_pylist(), [np.empty((0, 2), np.int64)]
            cuts = np.flatnonzero(np.r_[True, m[1:, 0] != m[:-1, 0], True])
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                once = lo + np.unique(m[lo:hi, 1], return_index=True)[1]  # a set comes once from each task
                edges.append(group_edges(m[once], [s[i] for i in once], percent))
            yield table([np.unique(np.sort(np.concatenate(edges), axis=1), axis=0)], ["u", "v"])

    dealt = rows.join(sketches.select("node", "sketch"), "node").select(*names)
    return dealt.repartition("key").sortWithinPartitions("key").mapInArrow(run, "u long, v long")


def candidates(rows: DataFrame, sketches: DataFrame, percent: int, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Candidate links (u, v) between nodes."""
    spark = rows.sparkSession
    kept, path = scratch_path(spark, "prefixes"), scratch_path(spark, "shingle-groups")
    rows.write.parquet(kept)
    grouped(dealt(spark.read.parquet(kept), percent, group_rows), percent).write.parquet(path)
    found = spark.read.parquet(path)
    pairs = found.filter("key is null").select(F.col("node").alias("u"), F.col("place").alias("v"))
    return alike(pairs, sketches, percent).unionAll(large_edges(found.filter("key is not null"), sketches, percent))


def cut(members: DataFrame, percent: int, tree_shingles: int) -> DataFrame:
    """Members (comp, digest, n) with ``part``, one row for each pair of blocks that they meet in.

    A component of up to ``tree_shingles`` is one block.  A larger one is cut
    by set size, and inside one size by digest, into blocks; each two blocks
    whose sizes can link meet.
    """
    by_size = members.groupBy("comp", "n").agg((F.count("*") * F.col("n")).alias("w"))
    run = Window.partitionBy("comp").orderBy("n")  # one row per size, not per text
    half = max(1, tree_shingles // 2)
    by_size = by_size.select(
        "comp", "n", "w", F.sum("w").over(run).alias("upto"), F.sum("w").over(Window.partitionBy("comp")).alias("all")
    )
    first = F.when(F.col("all") <= tree_shingles, F.lit(0)).otherwise(F.floor((F.col("upto") - F.col("w")) / half))
    last = F.when(F.col("all") <= tree_shingles, F.lit(0)).otherwise(F.floor((F.col("upto") - 1) / half))
    by_size = by_size.select("comp", "n", first.cast("long").alias("first"), last.cast("long").alias("last"))
    m = members.join(by_size, ["comp", "n"])
    block = F.col("first") + F.pmod(F.xxhash64("digest"), F.col("last") - F.col("first") + 1)
    m = m.withColumn("block", block)
    blocks = m.groupBy("comp", "block").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    a, b = blocks.alias("a"), blocks.alias("b")
    meets = F.col("a.high") * 100 >= F.col("b.low") * percent
    pairs = a.join(b, (F.col("a.comp") == F.col("b.comp")) & (F.col("a.block") <= F.col("b.block")) & meets)
    pairs = pairs.select(F.col("a.comp").alias("comp"), F.col("a.block").alias("x"), F.col("b.block").alias("y"))
    both = pairs.select("comp", F.col("x").alias("block"), "x", "y").unionAll(
        pairs.filter("x != y").select("comp", F.col("y").alias("block"), "x", "y")
    )
    return m.join(both, ["comp", "block"]).select("comp", "x", "y", "digest", "id")


def exact_links(placed: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (u, v) between digests that connect what is connected, within each (comp, x, y)."""
    schema = pa.schema([("u", pa.binary()), ("v", pa.binary())])

    def join(texts: list[str]) -> list[tuple[bytes, bytes]]:
        found = {}
        for t in texts:
            s = shingles(t, width)
            found.setdefault(digest(s), s)
        if len(found) < 2:
            return []
        names, arrays = list(found), list(found.values())
        # Shingles of many of the texts come first, so that paths are shared.
        values, inv, count = np.unique(np.concatenate(arrays), return_inverse=True, return_counts=True)
        rank = np.empty(len(values), np.int64)
        rank[np.lexsort((values, -count))] = np.arange(len(values))
        flat, ranked, at = rank[inv], [], 0
        for a in arrays:
            ranked.append(np.sort(flat[at : at + len(a)]).tolist())
            at += len(a)
        return [(names[a], names[b]) for a, b in forest(ranked, percent)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, texts = None, []
        for b in sliced(batches, 512):
            keys = list(zip(*(b.column(i).to_pylist() for i in range(3))))
            for k, t in zip(keys, b.column(3).to_pylist()):
                if k != now:
                    if len(texts) > 1 and (e := join(texts)):
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*e)], schema=schema)
                    now, texts = k, []
                texts.append(t)
        if len(texts) > 1 and (e := join(texts)):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*e)], schema=schema)

    cols = ["comp", "x", "y"]
    dealt = placed.select(*cols, "text").repartition(*cols).sortWithinPartitions(*cols)
    return dealt.mapInArrow(run, "u binary, v binary")


def most_frequent(summaries: DataFrame) -> list[tuple[int, int]]:
    """(token, df) of shingles that many texts share, at most FREQUENT of them.

    Those of the largest powers of two of df (16 at least) are taken, and of the
    last power as many as fit, by hash; only the numbers by power and by hash
    bucket are gathered, so nothing is sorted.
    """
    top = summaries.groupBy("token").agg(F.sum("df").alias("df")).filter("df >= 16")
    top = top.withColumn("power", F.floor(F.log2("df")).cast("int")).withColumn("part", F.pmod(F.xxhash64("token"), F.lit(1024)))
    left, least, parts = FREQUENT, 64, 0
    for r in top.groupBy("power").count().orderBy(F.col("power").desc()).collect():
        if r["count"] > left:
            for e in top.filter(F.col("power") == r["power"]).groupBy("part").count().orderBy("part").collect():
                if e["count"] > left:
                    break
                left, parts = left - e["count"], e["part"] + 1
            least = r["power"] + 1
            break
        left, least = left - r["count"], r["power"]
    taken = (F.col("power") >= least) | ((F.col("power") == least - 1) & (F.col("part") < parts))
    return [(r["token"], r["df"]) for r in top.filter(taken).select("token", "df").collect()]


def jaccard_classes(
    docs: DataFrame,
    width: int = 3,
    percent: int = 90,
    id_col: str = "doc_id",
    text_col: str = "text",
    group_rows: int = GROUP_ROWS,
    tree_shingles: int = TREE_SHINGLES,
) -> DataFrame:
    """Per row: id, n_shingles, component_id (smallest id in its component)."""
    spark = docs.sparkSession
    made = materialize(sets(docs, width, id_col, text_col))
    texts = made.filter("token is null").select("id", "n", "digest", "node")
    frequent = spark.sparkContext.broadcast(most_frequent(made.filter("token is not null")))
    rows = prefixes(docs, frequent, percent, width, text_col)
    sketches = made.filter("node is not null").groupBy("node").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    rough = components(candidates(rows, sketches, percent, group_rows))

    nodes = texts.filter("digest is not null and id is not null").groupBy("digest", "node", "n").agg(F.min("id").alias("id"))
    members = materialize(nodes.join(rough, "node").select(F.col("root").alias("comp"), "digest", "id", "n"))
    placed = cut(members, percent, tree_shingles)
    # One text for each set; a set that only rows without an id have is read by its digest below.
    named = placed.filter("id is not null").join(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "id")
    links = exact_links(named, width, percent)

    exact = components(links).select(F.col("node").alias("digest"), "root")
    whole = nodes.join(exact, "digest", "left").select("digest", "id", F.coalesce("root", "digest").alias("root"))
    least = whole.groupBy("root").agg(F.min("id").alias("component_id"))
    classes = whole.join(least, "root").select("digest", "component_id")
    out = texts.join(classes, "digest", "left")
    component = F.coalesce(F.col("component_id"), F.col("id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"))


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size and component of every document's set of 3-word shingles, at 90 percent."""
    return jaccard_classes(read(spark, sf_dir, "documents"))
