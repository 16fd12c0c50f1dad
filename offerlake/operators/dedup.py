"""Deduplication, distinct sources and the single-source guard.

Survivor choice decides row counts, so every dedup takes an explicit order:
the first row by ``order_by`` (ascending, NULLs first), ties broken by the
remaining columns, so the result never depends on partitioning.

Implemented as ``groupBy(key).agg(min(struct(order, row)))`` rather than a
``row_number`` window: the aggregate runs a partial (map-side) step, so a
hot key -- even one holding a third of all rows -- is reduced to one row per
input partition before the shuffle, instead of landing whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructType

from offerlake.operators.clean import null_tokens, quote

SOURCES = ("olx", "otodom")


def _orderable(t: DataType) -> bool:
    if isinstance(t, MapType):
        return False
    if isinstance(t, ArrayType):
        return _orderable(t.elementType)
    if isinstance(t, StructType):
        return all(_orderable(f.dataType) for f in t.fields)
    return True


def keep_first(
    df: DataFrame,
    key: str | Sequence[str],
    order_by: Sequence[str],
    keep_null_keys: bool = False,
) -> DataFrame:
    """One row per ``key`` (NULL keys form one group, as in ``dropDuplicates``).

    The survivor is the minimum of struct(order columns, other columns): each
    column is carried once through the shuffle.  Columns that cannot be
    ordered (maps) ride along with ``min_by``.  ``keep_null_keys=True`` passes
    rows with a NULL key through untouched.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = [c for c in order_by if c not in keys]
    dtypes = {f.name: f.dataType for f in df.schema.fields}
    rest = [c for c in df.columns if c not in keys and c not in order]
    tie = [c for c in rest if _orderable(dtypes[c])]
    other = [c for c in rest if not _orderable(dtypes[c])]
    ordered = f"struct({', '.join(quote(c) for c in [*order, *tie])})"
    aggs = [F.expr(f"min({ordered}) AS _m")]
    if other:
        aggs.append(F.expr(f"min_by(struct({', '.join(quote(c) for c in other)}), {ordered}) AS _x"))
    if keep_null_keys:
        null_key = None
        for k in keys:
            e = F.col(k).isNull()
            null_key = e if null_key is None else null_key | e
        passthrough = df.filter(null_key)
        df = df.filter(~null_key)
    pick = [quote(c) if c in keys else f"{'_x' if c in other else '_m'}.{quote(c)} AS {quote(c)}" for c in df.columns]
    out = df.groupBy(*keys).agg(*aggs).selectExpr(*pick)
    if keep_null_keys:
        out = out.unionByName(passthrough)
    return out


def text_runs(df: DataFrame, apart: Sequence[str]) -> list[list[str]]:
    """Runs of two or more string columns that follow each other once the columns ``apart`` are taken out;
    a key among these ends a run, so that each run keeps its place in the order of the columns."""
    runs: list[list[str]] = [[]]
    for f in df.schema.fields:
        if f.dataType == StringType() and f.name not in apart:
            runs[-1].append(f.name)
        else:
            runs.append([])
    return [r for r in runs if len(r) > 1]


#: Ends a packed value; code points 0 and 1 inside a value are written as 1 1 and 1 2, a value begins with 1, a NULL is empty.
_END = "\\u0000"
_ESCAPES = (("\\u0001", "\\u0001\\u0002"), ("\\u0000", "\\u0001\\u0001"))


def pack(columns: Sequence[str]) -> str:
    """String columns as one string (SQL text) that compares as the columns do one after the other, NULLs first.

    A row of thirty strings has an offset and a length for each of them and pads each to eight bytes: packed, it
    sorts in half the memory and shuffles in half the bytes.
    """

    def one(c: str) -> str:
        escaped = quote(c)
        for ch, code in _ESCAPES:
            escaped = f"replace({escaped}, '{ch}', '{code}')"
        return f"CASE WHEN {quote(c)} IS NULL THEN '{_END}' ELSE concat('\\u0001', {escaped}, '{_END}') END"

    return f"concat({', '.join(one(c) for c in columns)})"


def unpack(pieces: str, i: int) -> str:
    """The ``i``-th value of a packed string that was split at its ends (SQL text)."""
    value = f"substring({pieces}[{i}], 2)"
    for ch, code in reversed(_ESCAPES):
        value = f"replace({value}, '{code}', '{ch}')"
    return f"CASE WHEN {pieces}[{i}] != '' THEN {value} END"


def deduplicate(
    df: DataFrame,
    order_by: Sequence[str] = ("date_scraped",),
    keys: Sequence[str] = ("offer_id", "short_description"),
    keep_null_keys: bool = False,
) -> DataFrame:
    """D3: one row per offer id, then one row per short description (two shuffles).

    Strings that no key or order reads are packed for both shuffles, which leaves the order of rows as it is.
    """
    runs = text_runs(df.drop(*order_by), keys)
    prefix = "_run"
    while any(c.startswith(prefix) for c in df.columns):
        prefix = f"_{prefix}"
    names = [f"{prefix}{k}" for k in range(len(runs))]
    run_of = {c: (name, i) for name, run in zip(names, runs) for i, c in enumerate(run)}
    first = {run[0]: f"{pack(run)} AS {name}" for name, run in zip(names, runs)}
    out = df.selectExpr(*[first.get(c, quote(c)) for c in df.columns if c in first or c not in run_of])
    for k in keys:
        out = keep_first(out, k, order_by, keep_null_keys=keep_null_keys)
    if not runs:
        return out
    # Arrays of pieces, in a projection of their own: each string is split once.
    out = out.selectExpr(*[f"split({c}, '[\\\\x00]') AS {c}" if c in names else quote(c) for c in out.columns])
    return out.selectExpr(*[f"{unpack(*run_of[c])} AS {quote(c)}" if c in run_of else quote(c) for c in df.columns])


def distinct_sources(df: DataFrame, column: str = "offer_source") -> DataFrame:
    """D4."""
    return df.select(column).distinct()


def exists(df: DataFrame, condition=None) -> bool:
    """A1: does any row satisfy ``condition``?  Stops at the first match."""
    d = df.where(condition) if condition is not None else df
    return len(d.limit(1).collect()) > 0


def exists_frame(df: DataFrame, condition, name: str = "exists") -> DataFrame:
    """A1 as a one-row frame: ``limit(1)`` stops every task at its first match."""
    return df.where(condition).limit(1).agg((F.count(F.lit(1)) > 0).alias(name))


def single_source(df: DataFrame, allowed: Sequence[str] = SOURCES, column: str = "offer_source") -> str:
    """The one site a frame holds; ValueError for none, several or an unknown one.

    Runs on the raw source column (a one-column scan) and brings at most three
    values to the driver.  NULLs and placeholder strings (P1) are no source.
    """
    named = null_tokens(df.select(column)).filter(F.col(column).isNotNull())
    found = sorted(r[0] for r in distinct_sources(named, column).limit(3).collect())
    if not found:
        raise ValueError("frame holds no offers")
    if len(found) > 1:
        raise ValueError(f"frame holds offers from several sites: {found}")
    if found[0] not in allowed:
        raise ValueError(f"site {found[0]!r} is not supported; expected one of {list(allowed)}")
    return found[0]
