"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word, as every operator counts it: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Small tables may be broadcast up to this many rows; beyond it a shuffled join is used.
BROADCAST_ROWS = 20_000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def words(text: Column) -> Column:
    """Words of a text as an array; NULL, empty and blank texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def n_words(text: Column) -> Column:
    """Number of words; NULL has none.  Counted as the starts of words."""
    t = F.coalesce(text, F.lit(""))
    return F.regexp_count(t, F.lit(WORD)).cast("long")


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body`` as a bound variable.

    Inside a higher-order function an outer expression would be evaluated for
    each element; a lambda variable is already a value.
    """
    return F.transform(F.array(value), lambda v: body(v))[0]


def lookup(df: DataFrame, small: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Left-join a per-key table to ``df`` on NULL-safe keys.

    ``small`` must be materialised; it is broadcast only when a count shows
    that it has at most BROADCAST_ROWS rows.  Beyond that the join shuffles,
    and adaptive execution splits a hot key's partition.
    """
    cond = None
    r = small
    for k in keys:
        r = r.withColumnRenamed(k, f"__r_{k}")
        c = df[k].eqNullSafe(F.col(f"__r_{k}"))
        cond = c if cond is None else cond & c
    if small.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        r = F.broadcast(r)
    return df.join(r, cond, "left").drop(*[f"__r_{k}" for k in keys])


_kept: dict[Hashable, Any] = {}


def kept(key: Hashable, make: Callable[[], Any]) -> Any:
    """What a worker keeps from task to task, of the last key alone.

    The stages of a pipeline share their workers; what one has remembered would
    otherwise stay beside what the next ones remember.
    """
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


def sliced(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Record batches cut to at most ``rows`` rows, so that what a task makes of one stays small."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def batches_of_bytes(batches: Iterable[pa.RecordBatch], column: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Record batches cut so that the texts of ``column`` fill at most ``limit`` bytes; a longer text comes alone."""
    for b in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        a = 0
        while a < b.num_rows:
            e = int(np.searchsorted(size, (size[a - 1] if a else 0) + limit, "right"))
            yield b.slice(a, max(1, e - a))
            a = max(a + 1, e)


def whole_groups(batches: Iterable[pa.RecordBatch], names: list[str]) -> Iterator[pa.Table]:
    """Record batches sorted by their first column, regrouped so that no group is cut."""
    rest = None
    for b in batches:
        t = pa.Table.from_batches([b]).select(names)
        t = pa.concat_tables([rest, t]).combine_chunks() if rest is not None else t
        if not t.num_rows:
            continue
        k = t.column(0).to_numpy()
        done = int(k.searchsorted(k[-1]))  # the last group may go on
        rest = t.slice(done)
        if done:
            yield t.slice(0, done)
    if rest is not None and rest.num_rows:
        yield rest
