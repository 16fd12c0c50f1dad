"""Operator 4, exact top-k search by inner product with block-at-a-time pruning.

Rows are ordered by their dominant components, so that like vectors are
neighbours, and cut into ranges of BLOCK rows.  A block keeps a forward index
(its vectors) and, per component, the largest and smallest value.  For a
query the summed term maxima ``sum(max(q * high, q * low))`` bound every score
in a block.  Blocks are taken in order of that bound, best first, and scored
through their forward index, until the next bound falls below the query's
k-th score so far; blocks that tie with it are still read, because ties go to
the smaller id.  No bound is estimated, so the result is exact.

Shards of about SHARD rows and chunks of CHUNK queries are the units of work; a
shard keeps the box around its vectors, a chunk a box around every run of its
queries (at most GROUP, of one dominant component), which are ordered as the rows
are.  The search has two rounds.  First each box of queries is scored in the shard
whose middle suits it best, which gives every query a k-th score.  Then only those pairs of shard and chunk are brought
together of which a bound still reaches the k-th score of a query; in them,
blocks are read against that score.  What meets everywhere is boxes, page by
page, not rows.

Defined cases: vectors that are NULL or hold NULL or non-finite components,
and rows without an id, take no part; components that one of two vectors
lacks count as 0; equal rows of the query set ask once; rows with the query's
own id are not its candidates; equal candidate rows are ranked one after the
other; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from offerlake.llm.common import read
from offerlake.session import materialize, scratch_path

BLOCK = 64
SHARD = 8_192
CHUNK = 8_192
#: Queries of a chunk that share a box, at most.
GROUP = 64
#: Shards and chunks whose boxes meet in one task (6 kB a box at 384 components).
SHARD_PAGE = 1_024
CHUNK_PAGE = 16


def usable(id_col: str, vec_col: str) -> Column:
    """Rows that take part."""
    bad = F.exists(vec_col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & ~bad


def pack(ids: np.ndarray, rows: list[np.ndarray], scale: float, group: int | None) -> dict:
    """Ids and scaled, floored vectors of a run of rows as bytes, and boxes around them.

    Boxes hold at most ``group`` neighbours of one dominant component; None: all rows share one.
    """
    dim = max((len(r) for r in rows), default=0)
    m = np.zeros((len(rows), dim))
    for i, r in enumerate(rows):
        m[i, : len(r)] = np.floor(scale * r)
    small = m.size == 0 or np.abs(m).max() < 2**31
    cuts = np.zeros(1, int)
    if group and dim:
        top = np.abs(m).argmax(1)
        sign = m[np.arange(len(m)), top] < 0
        runs = np.flatnonzero(np.r_[True, (top[1:] != top[:-1]) | (sign[1:] != sign[:-1]), True])
        cuts = np.concatenate([np.arange(a, e, group) for a, e in zip(runs[:-1], runs[1:])])
    return {
        "n": len(rows), "dim": dim, "small": bool(small), "ids": ids.astype("<i8").tobytes(),
        "m": m.astype("<i4" if small else "<f8").tobytes(),
        "high": np.maximum.reduceat(m, cuts, axis=0).tobytes(), "low": np.minimum.reduceat(m, cuts, axis=0).tobytes(),
        "cuts": cuts.astype("<i4").tobytes(),
    }


def unpack(r) -> tuple[np.ndarray, np.ndarray]:
    m = np.frombuffer(r["m"], "<i4" if r["small"] else "<f8").reshape(r["n"], r["dim"])
    return np.frombuffer(r["ids"], "<i8"), m.astype(np.float64)


def boxes(r) -> tuple[np.ndarray, np.ndarray]:
    """Largest and smallest values of a packed row's boxes, [boxes, components]."""
    return tuple(np.frombuffer(r[f], "<f8").reshape(len(starts(r)), r["dim"]) for f in ("high", "low"))


def starts(r) -> np.ndarray:
    """The first row of each box."""
    return np.frombuffer(r["cuts"], "<i4")


BYTES = ("n", "dim", "small", "ids", "m")
BOXES = ("n", "dim", "high", "low", "cuts")
PACKED = "n int, dim int, small boolean, ids binary, m binary, high binary, low binary, cuts binary"


def packed(df: DataFrame, key: str, scale: float, unit: int, group: int | None) -> DataFrame:
    """One row per partition and ``unit`` rows of ``df`` (id, v): key, and the packed rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        ids, rows, made = [], [], 0

        def flush():
            nonlocal ids, rows, made
            got = pack(np.array(ids, np.int64), rows, scale, group) | {key: (part << 24) + made}
            ids, rows, made = [], [], made + 1
            return pa.RecordBatch.from_pylist([got], schema=schema)

        for b in batches:
            flat, at = b.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64), b.column(1).offsets.to_numpy()
            for i, x in enumerate(b.column(0).to_pylist()):
                ids.append(x)
                rows.append(flat[at[i] - at[0] : at[i + 1] - at[0]])
                if len(ids) >= unit:
                    yield flush()
        if ids:
            yield flush()

    kinds = {"int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}
    schema = pa.schema([(name, kinds[kind]) for name, kind in (f.split(" ") for f in PACKED.split(", "))] + [(key, pa.int64())])
    return df.mapInArrow(run, f"{PACKED}, {key} long")


def box_bounds(high: np.ndarray, low: np.ndarray, s_high: np.ndarray, s_low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds that no product of a vector in box i and one in box j of the second boxes is above; products of the boxes' middles.

    A vector is a box's centre and a rest within its half widths: the product
    of the centres is exact, the rests count by their size.
    """
    dim = max(high.shape[1], s_high.shape[1])
    high, low, s_high, s_low = (np.pad(x, ((0, 0), (0, dim - x.shape[1]))) for x in (high, low, s_high, s_low))
    sizes = [max(np.abs(a).max(initial=0), np.abs(b).max(initial=0), 1) for a, b in ((high, low), (s_high, s_low))]
    mid, half, s_mid, s_half = (high + low) / 2, (high - low) / 2, (s_high + s_low) / 2, (s_high - s_low) / 2
    middles = mid @ s_mid.T
    if dim * sizes[0] * sizes[1] >= 2**48:  # sums of quarters would round
        return np.full(middles.shape, np.inf), middles
    return middles + (np.abs(mid) + half) @ s_half.T + half @ np.abs(s_mid).T, middles


def best_blocks(
    queries: np.ndarray, qids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int, block: int = BLOCK, floor: np.ndarray | None = None
):
    """Each query's k best (score, id) among the vectors, and the number of blocks read.

    Returns arrays [nq, k] of scores and ids; missing places hold score -inf.
    ``floor`` is a score that k other rows are known to reach, per query:
    rows below it are left out.
    """
    nq, n = len(queries), len(vectors)
    dim = max(queries.shape[1], vectors.shape[1])
    queries, vectors = (np.pad(x, ((0, 0), (0, dim - x.shape[1]))) for x in (queries, vectors))
    exact = dim * max(np.abs(queries).max(initial=0), 1) * max(np.abs(vectors).max(initial=0), 1) < 2**53
    cuts = np.arange(0, n, block)
    high = np.maximum.reduceat(vectors, cuts, axis=0)
    low = np.minimum.reduceat(vectors, cuts, axis=0)
    bounds = np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T
    if not exact:
        # Beyond 2**53 sums round: nothing is pruned and scores are summed as whole numbers.
        bounds[:] = np.inf
        queries, vectors = to_int(queries), to_int(vectors)
    order = np.argsort(-bounds, axis=1, kind="stable")
    floor = np.full(nq, -np.inf) if floor is None or not exact else floor
    best = np.full((nq, k), -np.inf, object if not exact else float)
    who = np.full((nq, k), np.iinfo(np.int64).max)
    done, width, reads = 0, 1, 0
    while done < len(cuts):
        # The next few blocks of each query, as far as their bounds reach its k-th score.
        ahead = order[:, done : done + width]
        want = np.take_along_axis(bounds, ahead, 1) >= np.maximum(best[:, -1:].astype(float), floor[:, None])
        if not want.any():
            break
        q_of, place = np.nonzero(want)
        b_of = ahead[q_of, place]
        reads += len(b_of)
        by_block = np.argsort(b_of, kind="stable")
        q_of, b_of = q_of[by_block], b_of[by_block]
        edges = np.flatnonzero(np.r_[True, b_of[1:] != b_of[:-1], True])
        for s, e in zip(edges[:-1], edges[1:]):
            q, lo = q_of[s:e], b_of[s] * block
            got_ids = ids[lo : lo + block]
            got = queries[q] @ vectors[lo : lo + block].T
            got = np.where(qids[q][:, None] == got_ids[None, :], -np.inf, got)
            scores = np.concatenate([best[q], got], axis=1)
            names = np.concatenate([who[q], np.broadcast_to(got_ids, (len(q), len(got_ids)))], axis=1)
            first = np.lexsort((names, -scores), axis=1)[:, :k] if exact else rank_objects(scores, names, k)
            best[q], who[q] = np.take_along_axis(scores, first, 1), np.take_along_axis(names, first, 1)
        done, width = done + width, width * 4
    best[best < floor[:, None]] = -np.inf
    return best, who, reads


def to_int(m: np.ndarray) -> np.ndarray:
    out = np.empty(m.shape, object)
    out.ravel()[:] = [int(x) for x in m.ravel()]
    return out


def rank_objects(scores: np.ndarray, names: np.ndarray, k: int) -> np.ndarray:
    return np.array([sorted(range(len(s)), key=lambda i: (-s[i], n[i]))[:k] for s, n in zip(scores, names)])


def stored(df: DataFrame, name: str) -> DataFrame:
    """A table in the shared folder, of which later steps read the columns they need."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def ordered(rows: DataFrame, parts: int) -> DataFrame:
    """Rows (id, v) ranged over ``parts`` partitions by their two dominant components.

    Where a session deals them over more partitions, neighbours are put
    together again: units of work are as large as said, not as many as partitions.
    """
    size = F.array_sort(F.transform("v", lambda x, i: F.struct((-F.abs(x)).alias("a"), F.when(x < 0, -i - 1).otherwise(i + 1).alias("i"))))
    keyed = rows.withColumn("__d", F.transform(F.slice(size, 1, 2), lambda s: s["i"]))
    return keyed.repartitionByRange(parts, "__d", "id").sortWithinPartitions("__d", "id").select("id", "v").coalesce(parts)


def pages(key: str, parts: int, page: int) -> tuple[Column, int]:
    """The page of a shard or chunk, and how many there are."""
    n = -(-parts // page)
    return F.pmod(F.shiftright(key, 24), F.lit(n)).cast("int"), n


def bounded(shards: DataFrame, chunks: DataFrame, parts: tuple[int, int], body, schema: str) -> DataFrame:
    """``body(chunk row, bounds and middles [boxes, shards], shards)`` for every chunk and page of shards, as one table.

    Only boxes are dealt: a page of shards' meets a page of chunks' in one task.
    """
    s_page, s_n = pages("shard", parts[0], SHARD_PAGE)
    c_page, c_n = pages("chunk", parts[1], CHUNK_PAGE)
    left = shards.select("shard", *BOXES, s_page.alias("s"), F.explode(F.sequence(F.lit(0), F.lit(c_n - 1))).alias("c"))
    right = chunks.drop("small", "ids", "m").select(
        "*", c_page.alias("to_c"), F.explode(F.sequence(F.lit(0), F.lit(s_n - 1))).alias("to_s")
    )

    def run(key, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        dim = int(a["dim"].max()) if len(a) else 0
        held = [[np.pad(x, ((0, 0), (0, dim - x.shape[1]))) for x in boxes(r)] for _, r in a.iterrows()]
        out = [pd.DataFrame(columns=[f.split(" ")[0] for f in schema.split(", ")], dtype=object)]
        if held:
            high, low = (np.concatenate(x) for x in zip(*held))
            out += [body(c, *box_bounds(*boxes(c), high, low), a["shard"].to_numpy()) for _, c in b.iterrows()]
        return pd.concat([x for x in out if len(x)] or out[:1])

    return left.groupBy("s", "c").cogroup(right.groupBy("to_s", "to_c")).applyInPandas(run, schema)


def floors(c) -> np.ndarray:
    """The k-th score so far of each query of a chunk, -inf where fewer are known."""
    out = np.full(c["n"], -np.inf)
    if c["told"] is not None and len(c["told"]):
        out[np.asarray(c["told"], int)] = np.asarray(c["kth"], float)
    return out


def scored(shards: DataFrame, chunks: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    """Best rows of the shards of ``pairs`` (shard, chunk, of: boxes) for the queries of those boxes."""
    left = shards.select("shard", *BYTES).join(pairs.select("shard", "chunk"), "shard")
    named = pairs.select(F.col("shard").alias("to_shard"), F.col("chunk").alias("to_chunk"), "of")  # both sides hold ``pairs``
    right = chunks.select("chunk", "cuts", "told", "kth", *BYTES).join(named, F.col("chunk") == F.col("to_chunk")).drop("chunk")

    def run(key, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame(columns=["chunk", "at", "q", "i", "s"], dtype=object)]
        for (_, s), (_, c) in zip(a.iterrows(), b.iterrows()):  # one of each
            ids, m = unpack(s)
            qids, q = unpack(c)
            at = np.flatnonzero(np.isin(np.searchsorted(starts(c), np.arange(c["n"]), "right") - 1, np.asarray(c["of"], int)))
            best, who, _ = best_blocks(q[at], qids[at], m, ids, k, floor=floors(c)[at])
            keep = best != -np.inf
            each = keep.sum(1)
            found = {"chunk": key[1], "at": np.repeat(at, each), "q": np.repeat(qids[at], each), "i": who[keep]}
            out.append(pd.DataFrame(found | {"s": [clip(x) for x in best[keep]]}))
        return pd.concat([x for x in out if len(x)] or out[:1])

    groups = left.groupBy("shard", "chunk").cogroup(right.groupBy("to_shard", "to_chunk"))
    return groups.applyInPandas(run, "chunk long, at int, q long, i long, s long")


def first_pairs(shards: DataFrame, chunks: DataFrame, parts: tuple[int, int]) -> DataFrame:
    """The shard whose middle has the largest product with that of a box of queries: shard, chunk, of (boxes)."""

    def body(c, bounds, middles, names):
        j = middles.argmax(1)
        rows = np.arange(len(j))
        return pd.DataFrame({"chunk": c["chunk"], "of": rows, "shard": names[j], "middle": middles[rows, j]})

    best = bounded(shards, chunks, parts, body, "chunk long, of int, shard long, middle double")
    best = best.groupBy("chunk", "of").agg(F.max_by("shard", F.struct("middle", "shard")).alias("shard"))
    return best.groupBy("shard", "chunk").agg(F.collect_list("of").alias("of"))


def more_pairs(shards: DataFrame, chunks: DataFrame, parts: tuple[int, int]) -> DataFrame:
    """Pairs of which a bound reaches the k-th score of a query and that were not scored yet."""

    def body(c, bounds, middles, names):
        least = np.minimum.reduceat(floors(c), starts(c))
        hit = bounds >= least[:, None]
        for shard, of in zip(c["in_shard"], c["in_box"]):
            hit[of, names == shard] = False
        js = np.flatnonzero(hit.any(0))
        return pd.DataFrame({"shard": names[js], "chunk": c["chunk"], "of": [np.flatnonzero(hit[:, j]) for j in js]})

    return bounded(shards, chunks, parts, body, "shard long, chunk long, of array<int>")


def search(vectors: DataFrame, queries: DataFrame, k: int, scale: float, id_col: str, vec_col: str):
    """Both rounds: found rows (q, i, s), the pairs (shard, chunk, of) of each round."""
    ident, vec = F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v")
    rows = vectors.filter(usable(id_col, vec_col)).select(ident, vec)
    asked = materialize(queries.filter(usable(id_col, vec_col)).select(ident, vec).distinct())
    parts = max(1, -(-rows.count() // SHARD)), max(1, -(-asked.count() // CHUNK))
    shards = stored(packed(ordered(rows, parts[0]), "shard", scale, SHARD, None), "topk-shards")
    chunks = stored(packed(ordered(asked, parts[1]), "chunk", scale, CHUNK, GROUP), "topk-chunks")
    first = materialize(first_pairs(shards, chunks, parts))
    none = F.expr("cast(null as array<int>)").alias("told"), F.expr("cast(null as array<double>)").alias("kth")
    once = materialize(scored(shards, chunks.select("*", *none), first, k))
    known = once.groupBy("chunk", "at").agg(F.count("*").alias("n"), F.min("s").cast("double").alias("kth")).filter(F.col("n") >= k)
    known = known.groupBy("chunk").agg(F.collect_list(F.struct("at", "kth")).alias("t")).select("chunk", F.col("t.at").alias("told"), "t.kth")
    done = first.select("chunk", "shard", F.explode("of").alias("of")).groupBy("chunk").agg(F.collect_list(F.struct("shard", "of")).alias("p"))
    done = done.select("chunk", F.col("p.shard").alias("in_shard"), F.col("p.of").alias("in_box"))
    told = chunks.join(known, "chunk", "left")
    more = materialize(more_pairs(shards, told.join(done, "chunk"), parts))
    return once.unionAll(scored(shards, told, more, k)).select("q", "i", "s"), first, more


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int, scale: float = 256.0, id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """Each query's k best rows of ``vectors``: query_id, rank, <id_col>, score."""
    found, _, _ = search(vectors, queries, k, scale, id_col, vec_col)
    order = Window.partitionBy("q").orderBy(F.col("s").desc(), "i")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select(F.col("q").alias("query_id"), "rank", F.col("i").alias(id_col), F.col("s").alias("score"))


def clip(x) -> int:
    """A score as a long; sums beyond its range stay at its ends."""
    return max(-(2**63), min(2**63 - 1, int(x)))


def op4_block_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best rows of every row whose vec_id is divisible by 50."""
    rows = read(spark, sf_dir, "embeddings")
    return top_k(rows, rows.filter(F.col("vec_id") % 50 == 0), 5)


OP4_SQL = """
with v as (select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as e from embeddings
           where vec_id is not null and embedding is not null
             and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id as query_id, v.vec_id, list_inner_product(q.e, v.e)::bigint as score
      from v join v as q on q.vec_id % 50 = 0 and q.vec_id <> v.vec_id),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from s)
select query_id, rank, vec_id, score from r where rank <= 5
"""
