"""Standardisation, projections and filters.

All operators are DataFrame -> DataFrame and narrow (no shuffle) except
``drop_null_columns`` (P20), which needs one global count pass.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from offerlake.functions import vocab

TEXT_COLUMNS = ("short_description", "description")
REQUIRED_COLUMNS = ("offer_id", "price_total")


def quote(name: str) -> str:
    """A column name as a SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


def sql_string(value: str) -> str:
    """A Python string as a SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def null_tokens(df: DataFrame, tokens: Sequence[str] = vocab.NULL_TOKENS, subset: Iterable[str] | None = None) -> DataFrame:
    """Whole-value placeholder strings -> NULL, in string columns only.

    One IN test per column (not ``replace``, whose CASE chains bloat plans);
    array elements are left alone.  The token literals are built once and
    shared by every column's expression.
    """
    strings = string_columns(df)
    targets = set(subset) & set(strings) if subset is not None else set(strings)
    # Built as SQL text: one JVM call per column instead of dozens for a
    # column-by-column expression tree (the plan is the same).
    inlist = ", ".join(sql_string(t) for t in tokens)

    def one(c: str) -> str:
        q = quote(c)
        return f"CASE WHEN {q} IN ({inlist}) THEN CAST(NULL AS STRING) ELSE {q} END AS {q}"

    return df.selectExpr(*[one(c) if c in targets else quote(c) for c in df.columns])


def drop_all_null(df: DataFrame) -> DataFrame:
    """Drop rows in which every column is NULL."""
    return df.dropna(how="all")


def require(df: DataFrame, columns: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """Drop rows missing any of ``columns`` (plain IS NOT NULL filters push down to the scan)."""
    cond = None
    for c in columns:
        e = F.col(c).isNotNull()
        cond = e if cond is None else cond & e
    return df.filter(cond) if cond is not None else df


def one_line(df: DataFrame, columns: Sequence[str] = TEXT_COLUMNS) -> DataFrame:
    """Every CR or LF becomes one space."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: F.regexp_replace(F.col(c), r"[\n\r]", " ") for c in present})


def standardize(
    df: DataFrame,
    tokens: Sequence[str] = vocab.NULL_TOKENS,
    required: Sequence[str] = REQUIRED_COLUMNS,
    text_columns: Sequence[str] = TEXT_COLUMNS,
) -> DataFrame:
    """P5 = P1 -> P2 -> P3 -> P4.

    P3 is evaluated on the raw columns first ("present and not a token"),
    which is the same test as "not NULL after P1" but reaches the Parquet scan
    as pushed filters.  P3 implies P2 whenever ``required`` is non-empty.
    """
    strings = set(string_columns(df))
    pre = None
    for c in required:
        e = F.col(c).isNotNull()
        if c in strings:
            e = e & ~F.col(c).isin(*tokens)
        pre = e if pre is None else pre & e
    out = df.filter(pre) if pre is not None else df
    out = null_tokens(out, tokens)
    if not required:
        out = drop_all_null(out)
    return one_line(out, text_columns)


def drop_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Drop columns if present."""
    return df.drop(*[c for c in columns if c in df.columns])


def source_filter(df: DataFrame, needle: str, column: str = "offer_source") -> DataFrame:
    """Rows whose source contains ``needle`` (pushed to Parquet as StringContains)."""
    return df.filter(F.col(column).contains(needle))


def categorical_columns(df: DataFrame) -> list[str]:
    """Non-numeric columns are categorical (booleans, strings, dates included)."""
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, NumericType)]


def split_target(df: DataFrame, target: str = "price_total") -> tuple[DataFrame, DataFrame]:
    """(all columns but the target, the target alone)."""
    return df.drop(target), df.select(target)


def non_null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """A2: one row, the number of non-NULL values per column (single partial-aggregated pass)."""
    cols = list(columns) if columns is not None else df.columns
    return df.agg(*[F.count(F.col(c)).alias(c) for c in cols])


def drop_null_columns(df: DataFrame) -> DataFrame:
    """P20: drop columns that are NULL in every row.

    One aggregate over all columns; only a one-row result reaches the driver.
    """
    counts: Mapping[str, int] = non_null_counts(df).first().asDict()
    return df.select(*[c for c in df.columns if counts[c] > 0])
