"""Operator 7, sharding: rendezvous hashing of stable record keys over weighted shards.

Every record scores each shard from a hash of (key, shard) and the shard's
weight and goes to the best score.  Adding a shard only adds one more score
to each record, so a record either stays or moves to the new shard; the
expected share of a shard is its part of the summed weights.

Defined cases: a NULL key is placed by its text instead (rows without a key
do not pile up in one shard); equal rows land in one shard and take
neighbouring slots; a NULL text has no bytes; an empty table gives an empty
result.  Extra columns play no part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from offerlake.llm.common import read
from offerlake.session import materialize

#: Rows of one numbering bucket: a bucket is sorted by one task.
BUCKET_ROWS = 200_000


def unit(key: Column, salt: int) -> Column:
    """A number in (0, 1) that depends on key and salt alone."""
    h = F.xxhash64(key, F.lit(salt))
    return (F.shiftrightunsigned(h, 12).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard (0-based) with the largest weighted score; ties go to the smaller shard.

    The score -w / ln(u) makes P(shard i wins) = w_i / sum(w).  Shards of
    weight 0 take nothing.
    """
    if not weights or any(w < 0 for w in weights) or not any(weights):
        raise ValueError("weights must be non-negative and one of them positive")
    scores = [
        F.struct((F.lit(-float(w)) / F.log(unit(key, i))).alias("score"), F.lit(-i).alias("neg"))
        for i, w in enumerate(weights)
        if w > 0
    ]
    best = scores[0] if len(scores) == 1 else F.greatest(*scores)
    return (-best["neg"]).cast("int")


def shard(
    docs: DataFrame,
    weights: Sequence[float],
    grown_weights: Sequence[float] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Place every row: id, size, text_crc32, shard, slot and, on request, grown_shard.

    ``slot`` numbers a shard's rows from 0 without gaps.  Shards are few, so
    a window over a shard would put 1/n of all rows in one task; rows are
    numbered inside hash buckets of a shard and shifted by the summed counts
    of the buckets before, which is a table of counts, not of rows.
    """
    spark = docs.sparkSession
    t = F.coalesce(F.col(text_col), F.lit(""))
    key = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("text:"), F.sha2(t, 256)))
    rows = docs.select(
        F.col(id_col),
        (F.octet_length(t) + 1).cast("long").alias("size"),
        F.crc32(t.cast("binary")).alias("text_crc32"),
        key.alias("__key"),
    )
    placed = [rendezvous(F.col("__key"), weights).alias("shard")]
    if grown_weights is not None:
        placed.append(rendezvous(F.col("__key"), grown_weights).alias("grown_shard"))
    rows = materialize(rows.select("*", *placed, F.xxhash64("__key", F.lit(-1)).alias("__h")))
    n_buckets = max(1, -(-rows.count() // BUCKET_ROWS))
    rows = rows.withColumn("__bucket", F.pmod(F.shiftright("__h", 20), F.lit(n_buckets)))
    # One row per shard and bucket: numbers of rows only.
    counts = rows.groupBy("shard", "__bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "__bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__off"))
    inside = Window.partitionBy("shard", "__bucket").orderBy("__h", "__key", "text_crc32", "size")
    out = rows.withColumn("__i", F.row_number().over(inside) - 1).join(offsets, ["shard", "__bucket"])
    cols = [id_col, "size", "text_crc32", "shard", (F.col("__off") + F.col("__i")).cast("long").alias("slot")]
    if grown_weights is not None:
        cols.append("grown_shard")
    return out.select(*cols)


def op7_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents over 16 equal shards, and where they would be with a 17th."""
    out = shard(read(spark, sf_dir, "documents"), [1.0] * 16, [1.0] * 17)
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
