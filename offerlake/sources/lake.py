"""Lake tables: layered paths, reads, appends, overwrites, schema evolution
(SURVEY S1-S3, S5, S6, S9).

The table format is a parameter (default Parquet); Delta or Iceberg work the
same way when their jars are on the classpath.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

DEFAULT_FORMAT = "parquet"


@dataclass(frozen=True)
class LakePaths:
    """Bronze / silver / gold layout under one root (a shared URI on a cluster)."""

    root: str

    def bronze(self, site: str) -> str:
        return f"{self.root.rstrip('/')}/bronze/crawl/{site}"

    def landing(self, site: str) -> str:
        return f"{self.root.rstrip('/')}/landing/crawl/{site}"

    @property
    def silver(self) -> str:
        return f"{self.root.rstrip('/')}/silver/crawl_data"

    @property
    def gold_analytics(self) -> str:
        return f"{self.root.rstrip('/')}/gold/price_analytics"

    @property
    def gold_ml(self) -> str:
        return f"{self.root.rstrip('/')}/gold/ml_dataset"

    @property
    def model(self) -> str:
        return f"{self.root.rstrip('/')}/gold/price_model"

    def schemas(self, site: str) -> str:
        return f"{self.root.rstrip('/')}/_schemas/{site}"

    def state(self, site: str) -> str:
        return f"{self.root.rstrip('/')}/_state/{site}"

    @property
    def search_ledger(self) -> str:
        return self.checkpoint("price-model-search")

    def checkpoint(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/_checkpoints/{name}"


def children(spark: SparkSession, path: str) -> list[str] | None:
    """Names in a folder of any store that Spark reads, None where there is no such folder."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in fs.listStatus(at)] if fs.exists(at) else None


def read_table(
    spark: SparkSession,
    path: str | Sequence[str],
    fmt: str = DEFAULT_FORMAT,
    schema: StructType | str | None = None,
    merge_schema: bool = False,
) -> DataFrame:
    """Read a table by path, always naming the format.

    With ``schema`` the scan reads exactly those columns (missing ones come
    back NULL); ``merge_schema`` reconciles files written with evolving
    schemas (S5).
    """
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    if merge_schema:
        r = r.option("mergeSchema", "true")
    return r.load(list(path) if not isinstance(path, str) else path)


def append_table(df: DataFrame, path: str, fmt: str = DEFAULT_FORMAT, partition_by: Sequence[str] = ()) -> None:
    """Append rows to a table."""
    w = df.write.format(fmt).mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def overwrite_table(
    df: DataFrame,
    path: str,
    fmt: str = DEFAULT_FORMAT,
    partition_by: Sequence[str] = (),
    dynamic: bool = False,
) -> None:
    """S3: replace a table; with ``dynamic`` only the partitions present in ``df``."""
    w = df.write.format(fmt).mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    w.save(path)


def union_evolving(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack frames whose schemas drifted; absent columns become NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
