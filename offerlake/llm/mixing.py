"""Operator 1, mixing sources to target weights.

Every document gets a stable pseudo-random position in [0, 2**30).  Tokens
are summed by source and by the top ten bits of the position; the bucket in
which a source's running sum passes its budget is the only one that is summed
again, by the next ten bits, and then by the last ten.  The result is one
threshold per source: documents below it are taken.  No rows are sorted, and
a larger budget takes a superset of a smaller one.

A target above the source's size takes every document
``floor(target / size)`` times and the ones below the threshold of the
remainder once more.

Defined cases: NULL texts have size 0 and follow their position like others;
NULL sources form one source, ordered last; equal rows share a position and
so a fate; a row whose id is NULL is placed by its text; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from offerlake.llm.common import lookup, n_words, read
from offerlake.session import materialize

BITS = 10
LEVELS = 3


def position(id_col: str, text_col: str) -> Column:
    """30 stable pseudo-random bits of a row."""
    return F.shiftrightunsigned(F.xxhash64(F.col(id_col), F.col(text_col), F.lit(7919)), 64 - BITS * LEVELS)


def targets(sizes: DataFrame, weights: Sequence[float], share: float, max_repeats: float) -> DataFrame:
    """Budget per source: (source, source_size, target), one row per source.

    ``sizes`` has one row per source (source, source_size).  Weights repeat
    over the sources in code-point order, NULL last.  Together the targets
    are ``share`` times all sizes; none is above ``max_repeats`` times its
    source, the excess goes to the others by weight.  With
    r = max_repeats * size / weight sorted upwards, the sources below a level
    are full and the rest share what is left: level = (budget - caps before) /
    (weights from here on), the first source with r >= level and all after it
    are not full.
    """
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("i") % len(weights) + 1).cast("int"))
    # These windows see one row per source, not rows of data.
    ranked = sizes.withColumn("i", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    ranked = ranked.withColumn("w", w).withColumn("cap", F.lit(float(max_repeats)) * F.col("source_size"))
    by_ratio = Window.orderBy(F.col("cap") / F.col("w"), F.col("i"))
    caps_before = F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left_weight = F.sum("w").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    budget = F.lit(float(share)) * F.sum("source_size").over(Window.partitionBy())
    level = ((budget - caps_before) / left_weight).alias("level")
    t = ranked.select("*", level, F.row_number().over(by_ratio).alias("pos"))
    # The level of the first source that is not full holds for it and all after it.
    first = F.min(F.when(F.col("cap") >= F.col("level") * F.col("w"), F.struct("pos", "level"))).over(
        Window.partitionBy()
    )
    target = F.when(
        first.isNull() | (F.col("pos") < first["pos"]), F.col("cap")
    ).otherwise(F.least(F.col("cap"), first["level"] * F.col("w")))
    return t.select("source", "source_size", target.alias("target"))


def thresholds(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Per source the position below which its remainder is taken.

    ``rows``: source, size, pos.  ``plan``: source, source_size, rest (tokens wanted
    beyond whole copies).  Returns plan plus ``threshold``.
    """
    total = BITS * LEVELS
    state = plan.withColumn("prefix", F.lit(0).cast("long")).withColumn("left", F.col("rest"))
    for level in range(1, LEVELS + 1):
        shift = total - BITS * level
        bucket = F.shiftright(F.col("pos"), shift)
        if level == 1:
            hist = rows.groupBy("source", bucket.alias("b")).agg(F.sum("size").alias("n"))
        else:
            # Only the boundary bucket of each source is looked at again.
            inside = lookup(rows, state.select("source", "prefix"), ["source"])
            hist = (
                inside.filter(F.shiftright("pos", shift + BITS) == F.col("prefix"))
                .groupBy("source", bucket.alias("b"))
                .agg(F.sum("size").alias("n"))
            )
        hist = hist.select(F.col("source").alias("hs"), "b", "n")
        first, left = F.shiftleft(F.col("prefix"), BITS), F.col("left")
        run = Window.partitionBy("source").orderBy("b")
        cells = state.join(hist, F.col("source").eqNullSafe(F.col("hs")), "left").withColumn(
            "upto", F.coalesce(F.sum("n").over(run), F.lit(0))
        )
        # Whole cells that fit in what is left; the next one is the boundary.
        fits = (F.col("upto") <= left) & F.col("b").isNotNull()
        state = cells.groupBy("source", "source_size", "target", "rest", "copies", "prefix", "left").agg(
            F.coalesce(F.max(F.when(fits, F.col("upto"))), F.lit(0)).alias("used"),
            F.min(F.when(~fits, F.struct("b", "upto"))).alias("next"),
        )
        end = F.shiftleft(F.col("prefix") + 1, BITS)
        cell = F.coalesce(F.col("next.b"), end)
        if level == LEVELS:
            # The finest boundary cell is taken when that comes nearer to the budget.
            nearer = F.col("next.upto") - left < left - F.col("used")
            cell = cell + F.coalesce(nearer, F.lit(False)).cast("long")
        state = materialize(
            state.select(
                "source", "source_size", "target", "rest", "copies",
                cell.alias("prefix"), (left - F.col("used")).alias("left"),
            )
        )
    threshold = F.when(F.col("rest") > 0, F.col("prefix")).otherwise(F.lit(0)).alias("threshold")
    return state.select("source", "source_size", "target", "copies", threshold)


def plan_mix(
    docs: DataFrame,
    weights: Sequence[float],
    share: float,
    max_repeats: float,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """One row per source: source, source_size, target, copies, threshold (materialised)."""
    rows = materialize(
        docs.select(
            F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"),
            position(id_col, text_col).alias("pos"),
        )
    )
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    t = targets(sizes, weights, share, max_repeats)
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    t = t.withColumn("copies", copies.cast("long"))
    t = materialize(t.withColumn("rest", F.col("target") - F.col("copies") * F.col("source_size")))
    return thresholds(rows, t)


def mix(
    docs: DataFrame,
    weights: Sequence[float],
    share: float,
    max_repeats: float,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """The input's rows with __source_size, __target and __times (how often the mix takes the row)."""
    plan = plan_mix(docs, weights, share, max_repeats, id_col, text_col, source_col).select(
        F.col("source").alias(source_col),
        F.col("source_size").alias("__source_size"),
        F.col("target").alias("__target"),
        F.col("copies").alias("__copies"),
        F.col("threshold").alias("__threshold"),
    )
    out = lookup(docs, plan, [source_col])
    more = (position(id_col, text_col) < F.col("__threshold")).cast("long")
    return out.withColumn("__times", F.col("__copies") + more).drop("__copies", "__threshold")


def mixed(docs: DataFrame, **params) -> DataFrame:
    """The mix itself: the input's columns, each row as often as the mix takes it."""
    m = mix(docs, **params).filter(F.col("__times") > 0)
    each = m.withColumn("__i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__times"))))
    return each.select(*docs.columns)


#: Production parameters of the registered query and of the pipeline's stage.
PARAMS = {"weights": (3.0, 1.0, 2.0), "share": 1.5, "max_repeats": 2.0}


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its source's target and the words the mix takes of it."""
    m = mix(read(spark, sf_dir, "documents"), **PARAMS)
    size = n_words(F.col("text"))
    return m.select(
        "doc_id", size.alias("size"), F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"), (size * F.col("__times")).alias("taken"),
    )
