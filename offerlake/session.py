"""Spark session settings and the shared checkpoint location.

Object-store settings and credentials come from the caller (``extra``); none
live in code.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every pipeline run wants, whatever the cluster size.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # A row of a listing is many times as wide once it is read and parsed as it is in Parquet:
    # a task that reads 128 MB sorts gigabytes for the dedup's map side, and spills them all.
    "spark.sql.files.maxPartitionBytes": "16m",
    # Landed files are small (512 items): at the default of 4 MB a file, four of them fill a split, each
    # split becomes a bronze file of its own, and each of these a map task with a few rows for every reducer.
    "spark.sql.files.openCostInBytes": "64k",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Long chains of CASE/IN over many string columns make constraint
    # propagation blow up the driver heap (plan-size trap); it buys nothing here.
    "spark.sql.constraintPropagation.enabled": "false",
    # Wide projections (a rule per column) generate methods over the JIT's
    # 8000-byte limit, which then run interpreted; above it, fall back to
    # per-expression code split into small methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # The dedup's min(struct) runs as a sort-based aggregate; without code
    # generation it evaluates row by row (measured: silver build 15.3 s ->
    # 9.9 s at sf0.1).
    "spark.sql.codegen.aggregate.sortAggregate.enabled": "true",
    # Silver is overwritten one source partition at a time.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}


def build_session(
    app_name: str = "offerlake",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: Mapping[str, str] | None = None,
) -> SparkSession:
    """Create or get a session with the pipeline's settings.

    ``master`` is left unset on a cluster (spark-submit decides);
    ``shuffle_partitions`` should be sized so one shuffle partition is about
    128-256 MB at the target scale; AQE coalesces small ones at run time.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def shuffle_partitions_for(df: DataFrame, bytes_per_partition: int = 256 * 1024**2) -> int:
    """Shuffle partitions that give each about ``bytes_per_partition`` of ``df``'s input.

    The size is the optimizer's estimate for the scan (file sizes, no job
    runs).  AQE can merge small partitions after a shuffle but never splits
    a large one outside joins, so the starting count must fit the data: 100 TB
    of bronze at the default of 200 would give 500 GB per dedup partition.
    """
    return max(1, -(-estimated_bytes(df) // bytes_per_partition))


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of a frame's size; no job runs."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()  # a Scala BigInt, or an int via Py4J
    return size if isinstance(size, int) else int(size.toString())


_UNITS = {"k": 1024, "m": 1024**2, "g": 1024**3, "t": 1024**4}


def task_memory(spark: SparkSession) -> int:
    """Bytes of Spark's memory that each task of an executor has when all its cores are busy."""
    sc = spark.sparkContext
    conf, status = sc.getConf(), sc._jsc.sc().getExecutorMemoryStatus()
    if status.size() > 1:  # the driver and its executors
        size = conf.get("spark.executor.memory", "1g").lower().rstrip("b")
        heap = int(size[:-1]) * _UNITS[size[-1]] if size[-1] in _UNITS else int(size) * _UNITS["m"]
        cores = int(conf.get("spark.executor.cores", "0")) or -(-sc.defaultParallelism // (status.size() - 1))
    else:
        heap, cores = sc._jvm.java.lang.Runtime.getRuntime().maxMemory(), sc.defaultParallelism
    return max(0, int((heap - 300 * 1024**2) * float(conf.get("spark.memory.fraction", "0.6")))) // cores


@contextmanager
def shuffle_partitions(spark: SparkSession, n: int | None):
    """Run a block's jobs with ``n`` shuffle partitions (None: as set); the setting is restored after it."""
    key = "spark.sql.shuffle.partitions"
    with setting(spark, key, str(n) if n else spark.conf.get(key)):
        yield


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """Run a block's jobs with a setting, which is restored after it."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def apply_query_conf(spark: SparkSession) -> None:
    """Settings a query relies on when it runs in a session it did not build."""
    for k in (
        "spark.sql.constraintPropagation.enabled",
        "spark.sql.codegen.hugeMethodLimit",
        "spark.sql.codegen.aggregate.sortAggregate.enabled",
        "spark.sql.files.maxPartitionBytes",
        "spark.sql.files.openCostInBytes",
    ):
        spark.conf.set(k, BASE_CONF[k])


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and hand-over tables.

    Taken from the session (``spark.checkpoint.dir`` or a directory set on
    the context).  Only a local-mode session without one (tests, a laptop)
    gets a fresh scratch folder; on a cluster a machine-local folder would
    not survive a lost executor, so the setting is required there.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/object store) for this cluster")
        d = tempfile.mkdtemp(prefix="offerlake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and continue from the copy.

    Cuts the lineage where several jobs (fits, counts) would otherwise each
    recompute the plan; survives lost executors, unlike a local checkpoint.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def columnar_copy(df: DataFrame) -> DataFrame:
    """``materialize`` as columns in Parquet, where no row's place matters.

    A checkpoint keeps every row uncompressed, many times as large, and each pass reads all its columns.
    The shuffles of the plan are cleared away with the write's end: nothing reads them again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "copy")
    with setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique sub-folder of the shared checkpoint folder."""
    base = checkpoint_dir(spark)
    leaf = f"{name}-{os.getpid()}-{next(_counter)}"
    return f"{base}/{leaf}"


def _count():
    i = 0
    while True:
        i += 1
        yield i


_counter = _count()
