"""Operator 13, embedding whitening by spectral divide and conquer.

Entries c become whole numbers floor(scale * c) + shift, so that counts, sums
and products add up exactly, in any order and after any retry:

1. one pass counts the rows and sums each dimension;
2. one pass sums the products of entries less the whole part of their mean; the
   covariance follows exactly (divisor n, the rest of the mean taken out);
3. the driver splits the d x d covariance into components by QDWH polar
   decompositions (``polar_eigen``) and broadcasts the first of them;
4. rows are centred and projected where they lie; a pass over the whitened values
   measures how far their covariance is from the identity.

Tasks send d rows of d sums each, which are summed as a stream, never all held.
What reaches the driver is bounded by d squared.

Defined cases: a vector that is NULL, empty or holds a NULL or non-finite entry
takes no part; nor does one of another length than most have (of equally many
the shorter); repeated rows and rows without an id count one by one; a direction
without spread is no component, so an empty table, a single row or equal rows
give no components; a deviation beyond a long is NULL; extra columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from offerlake.llm.common import read
from offerlake.llm.polar_eigen import eigen
from offerlake.session import materialize

SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
#: Rows whose products are summed at once.
ROWS = 4_096
#: Sizes of vectors that a task counts apart before it hands them on.
SIZES = 64
#: Sums of doubles below this are exact.
EXACT = 1 << 53


class Whitening(NamedTuple):
    """What whitening needs: rows, sums per dimension, eigenvalues and eigenvectors (columns) kept, and each one's share."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray


def usable(vector: Column) -> Column:
    """Whether a vector is there and all of its entries are finite."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & ~bad, F.lit(False))


def _matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Vectors of one length at a time: their rows, and them as a matrix of doubles."""
    size = column.value_lengths().to_numpy(zero_copy_only=False)
    for d in np.unique(size):
        at = np.flatnonzero(size == d)
        for lo in range(0, len(at), ROWS):
            part = column.take(pa.array(at[lo : lo + ROWS]))
            yield at[lo : lo + ROWS], part.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, int(d))


def _whole(m: np.ndarray, scale: int) -> np.ndarray:
    return np.floor(scale * m).astype(np.int64)


def _sums(vectors: DataFrame, scale: int, shift: int) -> DataFrame:
    """Per task and vector size: size, n, sums."""
    names = ["size", "n", "sums"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def told():
            rows = [pa.array(list(held), pa.int64()), pa.array([h[0] for h in held.values()], pa.int64())]
            sums = pa.array([[Decimal(int(x)) for x in h[1]] for h in held.values()], pa.list_(pa.decimal128(38, 0)))
            return pa.RecordBatch.from_arrays([*rows, sums], names=names)

        for b in batches:
            for _, m in _matrices(b.column(0)):
                n, s = held.get(m.shape[1], (0, 0))
                held[m.shape[1]] = [n + len(m), s + (_whole(m, scale) + shift).sum(axis=0).astype(object)]
                if len(held) > SIZES:
                    yield told()
                    held.clear()
        yield told()

    return vectors.mapInArrow(run, "size long, n long, sums array<decimal(38,0)>")


def _products(vectors: DataFrame, centre: list[int], scale: int, shift: int) -> DataFrame:
    """Sums of products of the entries less the centre: one row (i, sums over all rows of t_i t_j) for each i."""
    d = len(centre)
    m0 = np.array(centre, np.int64)
    kind, names = pa.list_(pa.decimal128(38, 0)), ["i", "sums"]

    def told(i, total) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int64()), pa.array([[Decimal(int(x)) for x in row] for row in total], kind)], names=names
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, room = np.zeros((d, d), np.int64), 0
        for b in batches:
            for _, m in _matrices(b.column(0)):
                t = _whole(m, scale) + shift - m0
                most = int(np.abs(t).max()) ** 2 * len(t)
                if most < EXACT:  # every partial sum is a whole number that a double holds
                    f = t.astype(float)
                    part = (f.T @ f).astype(np.int64)
                else:
                    part = t.astype(object).T @ t.astype(object)
                    most = max(most, 1 << 62)
                if room + most >= 1 << 62:
                    yield told(range(d), total)
                    total, room = np.zeros((d, d), np.int64), 0
                if most >= 1 << 62:
                    yield told(range(d), part)
                else:
                    total, room = total + part, room + most
        yield told(range(d), total)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for i, row in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                held[i] = held.get(i, 0) + np.array([int(x) for x in row], object)
        yield told(list(held), list(held.values()))

    ddl = "i long, sums array<decimal(38,0)>"
    return vectors.mapInArrow(run, ddl).repartition("i").mapInArrow(added, ddl)


def _vectors(rows: DataFrame, vec_col: str) -> DataFrame:
    return rows.filter(usable(F.col(vec_col))).select(F.col(vec_col).cast("array<double>").alias("v"))


def fit(
    rows: DataFrame, vec_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT
) -> Whitening | None:
    """The whitening of all usable vectors, or None where there is none."""
    vectors = _vectors(rows, vec_col)
    counted = materialize(_sums(vectors, scale, shift))
    top = counted.groupBy("size").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "size").first()
    if top is None:
        return None
    d, n = top["size"], top["n"]
    mine = counted.filter(F.col("size") == d).select(F.posexplode("sums").alias("i", "s"))
    sums = [int(r["s"]) for r in mine.groupBy("i").agg(F.sum("s").alias("s")).orderBy("i").collect()]
    centre = [s // n for s in sums]
    got = _products(vectors.filter(F.size("v") == d), centre, scale, shift).collect()
    rest = np.array([s - n * c for s, c in zip(sums, centre)], object)
    # n^2 V, a matrix of whole numbers; each entry of V is rounded once.
    exact = np.empty((d, d), object)
    for r in got:
        exact[r["i"]] = [n * int(x) for x in r["sums"]]
    exact = exact - np.outer(rest, rest)
    cov = np.array([[x / (n * n) for x in row] for row in exact.tolist()], float).reshape(d, d)
    values, vecs = eigen(cov)
    total = float(np.trace(cov))
    keep = min(components, int(np.sum(values > d * np.finfo(float).eps * max(values[0], 0))))
    return Whitening(n, sums, values[:keep], vecs[:, :keep], values[:keep] / total if total else values[:0])


#: The column that ``whitened`` adds.
WHITE = "__white"
_TYPE = StructType([StructField("deviation", LongType()), StructField("values", ArrayType(DoubleType()))])


def whitened(
    rows: DataFrame, model: Whitening, vec_col: str = "embedding", scale: int = SCALE, shift: int = SHIFT
) -> DataFrame:
    """The rows that took part, with ``__white``: their deviation and whitened values."""
    n, d = model.n, len(model.sums)
    centre = [s // n for s in model.sums]
    held = rows.sparkSession.sparkContext.broadcast(
        (np.array(centre, np.int64), np.array([s - n * c for s, c in zip(model.sums, centre)], np.int64), model.vectors / np.sqrt(model.values))
    )
    part = rows.filter(usable(F.col(vec_col)) & (F.size(vec_col) == d))
    at = part.columns.index(vec_col)
    kind = pa.struct([("deviation", pa.int64()), ("values", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m0, rest, turn = held.value
        for whole in batches:
            for lo in range(0, whole.num_rows, ROWS):
                b = whole.slice(lo, ROWS)
                m = b.column(at).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, d)
                t = _whole(m, scale) + shift - m0
                z = (t - rest / n) @ turn
                if d * (n * (int(np.abs(t).max(initial=0)) + 1)) ** 2 < 1 << 63:
                    dev = ((n * t - rest) ** 2).sum(axis=1).tolist()
                else:
                    dev = [x if x < 1 << 63 else None for x in ((n * t.astype(object) - rest.astype(object)) ** 2).sum(axis=1)]
                white = pa.array([{"deviation": x, "values": y} for x, y in zip(dev, z.tolist())], kind)
                yield pa.RecordBatch.from_arrays([*b.columns, white], names=[*b.schema.names, WHITE])

    return part.mapInArrow(run, StructType([*part.schema.fields, StructField(WHITE, _TYPE)]))


def identity_error(white: DataFrame, model: Whitening) -> float | None:
    """Largest absolute entry of the whitened values' covariance less the identity; None without components."""
    k, n = len(model.values), model.n
    if not k:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for b in batches:
            z = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
            total += np.concatenate([z.sum(axis=0)[None], z.T @ z])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["i", "s"])

    parts = white.select(F.col(f"{WHITE}.values")).mapInArrow(run, "i long, s double")
    total = np.zeros((k + 1) * k)
    for r in parts.groupBy("i").agg(F.sum("s").alias("s")).collect():
        total[r["i"]] = r["s"]
    total = total.reshape(k + 1, k) / n
    return float(np.abs(total[1:] - np.outer(total[0], total[0]) - np.eye(k)).max())


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first components of every embedding, whitened, and how well."""
    rows = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = fit(rows)
    kinds = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None or not len(model.values):
        return rows.select("vec_id").limit(0).selectExpr("vec_id", *(f"cast(null as {k.split()[1]}) as {k.split()[0]}" for k in kinds.split(", ")[1:]))
    white = whitened(rows, model)
    error = identity_error(white, model)
    shares = F.array(*[F.lit(float(x)) for x in model.explained])
    return white.select("vec_id", F.col(f"{WHITE}.deviation").alias("deviation"), F.posexplode(f"{WHITE}.values").alias("i", "whitened")).select(
        "vec_id",
        (F.col("i") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, "i").alias("explained"),
        F.lit(error).alias("identity_error"),
    )
