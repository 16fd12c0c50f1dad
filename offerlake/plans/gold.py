"""Gold tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlake.operators.clean import require
from offerlake.operators.schema import ML_FEATURES

ANALYTICS_COLUMNS = ("offer_date", "city", "price_total", "price_per_msq", "size")


def spread_key(df: DataFrame) -> Column:
    """A row hash to order ties by, so range partitioning can split one hot sort value."""
    return F.xxhash64(*[F.col(c) for c in df.columns])


def price_analytics(silver: DataFrame, sort: bool = True) -> DataFrame:
    """J2 = P12 + P13 + O1: five columns, both prices present, by offer date (NULLs first).

    Filter before projection so ``IsNotNull`` reaches the scan.  The sort is
    a range shuffle (sampled bounds), never a single-task sort; rows of one
    date are ordered by a row hash, so a date holding a third of all rows
    is still split over many tasks.  Pass ``sort=False`` when the writer
    orders within files instead (``sorted_for_write``).
    """
    out = require(silver, ("price_total", "price_per_msq")).select(*ANALYTICS_COLUMNS)
    return out.orderBy(F.col("offer_date"), spread_key(out)) if sort else out


def sorted_for_write(df: DataFrame, column: str = "offer_date") -> DataFrame:
    """O1 for a table write: range-partition on (column, row hash) and sort each
    partition, so files are ordered among themselves and inside."""
    key = spread_key(df)
    return df.repartitionByRange(F.col(column), key).sortWithinPartitions(F.col(column), key)


def ml_dataset(silver: DataFrame) -> DataFrame:
    """J3 = P14 + P15: the 32 model columns, target present."""
    return require(silver, ("price_total",)).select(*ML_FEATURES)
