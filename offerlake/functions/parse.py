"""Column functions: casts, dates, strings and flags.

Every function maps Columns to a Column built only from Spark's own
expressions, so it stays inside whole-stage codegen, and is safe under ANSI
mode: parse failures give NULL, never an error.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, TimestampNTZType, TimestampType

from offerlake.functions import vocab

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --------------------------------------------------------------------- casts

# Integer part of a decimal literal with optional sign and surrounding blanks:
# the strings a legacy (non-ANSI) string->int cast accepts.
LEGACY_INT_PATTERN = r"^\s*([+-]?\d+)(\.\d*)?\s*$"


def legacy_int(c: ColumnOrName) -> Column:
    """String -> int as the legacy cast does: '2.0'->2, '2.9'->2, ' 3 '->3, '3/5'->NULL.

    ``try_cast(... as int)`` alone rejects '2.0', and going through double
    accepts '1e3'; both differ from the legacy cast.  Overflow gives NULL.
    """
    return F.regexp_extract(_c(c), LEGACY_INT_PATTERN, 1).try_cast("int")


def to_float(c: ColumnOrName) -> Column:
    """String -> float, unparsable -> NULL."""
    return _c(c).try_cast("float")


def money(c: ColumnOrName, lenient: bool = False) -> Column:
    """C3: '450 000 zł' -> 450000.0.  Drops the currency suffix and blanks, then C2.

    Strict by default (no-break spaces and decimal commas make NULL); ``lenient``
    also strips U+00A0 and reads ',' as the decimal point.
    """
    s = F.replace(_c(c), F.lit(vocab.CURRENCY_SUFFIX), F.lit(""))
    s = F.replace(s, F.lit(" "), F.lit(""))
    if lenient:
        s = F.replace(F.replace(s, F.lit("\u00a0"), F.lit("")), F.lit(","), F.lit("."))
    return to_float(s)


def round2(c: ColumnOrName) -> Column:
    """C4: round half-up to 2 places; keeps the input type (float stays float)."""
    return F.round(_c(c), 2)


def typed_null(dtype: DataType | str) -> Column:
    """NULL of a given type."""
    return F.lit(None).cast(dtype)


# --------------------------------------------------------------------- dates

def to_date_text(c: ColumnOrName, compat: bool = False) -> Column:
    """T1: 'yyyy-MM-dd' text -> date.

    ``compat=True`` reproduces the source pipeline's pattern 'yyyy-mm-dd', in
    which 'mm' means minutes: the month is dropped and '2024-12-31' becomes
    2024-01-31.
    """
    return F.try_to_date(_c(c), "yyyy-mm-dd" if compat else "yyyy-MM-dd")


def scrape_date(c: ColumnOrName, compat: bool = False) -> Column:
    """Crawl timestamp -> its date; ``compat`` goes through text with T1's bug."""
    if compat:
        return to_date_text(F.get(F.split(_c(c).cast("string"), " "), 0), compat=True)
    return day_of(c)


def day_of(c: ColumnOrName) -> Column:
    """The date of a date, a timestamp or a text that begins with one; unparsable text gives NULL."""
    return _c(c).try_cast("date")


def to_timestamp_any(c: ColumnOrName, dtype: DataType) -> Column:
    """To TIMESTAMP from text (unparsable -> NULL) or from any timestamp type."""
    if isinstance(dtype, StringType):
        return F.try_to_timestamp(_c(c))
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        return _c(c).cast("timestamp")
    return _c(c).try_cast("timestamp")


_ISO_INSTANT = r"^(\d{4}-\d{1,2}-\d{1,2})T\d{1,2}:\d{1,2}:\d{1,6}(Z|[+-]\d{2}:?\d{2}(:?\d{2})?)$"


def iso_local_date(c: ColumnOrName) -> Column:
    """T4: ISO instant 'YYYY-MM-DDTHH:MM:SS+zone' -> its own local date, no zone shift.

    Mirrors the accepted shape date 'T' hour ':' minute ':' second-digits zone;
    anything else (fractional seconds included) gives NULL.
    """
    day = F.regexp_extract(_c(c), _ISO_INSTANT, 1)
    return F.try_to_date(day, "yyyy-M-d")


_POLISH_DATE = r"^\s*(\d{1,2})\s+(\S+)\s+(\d{4})\s*$"


def polish_long_date(c: ColumnOrName) -> Column:
    """T5: '12 stycznia 2024' -> 2024-01-12 (after removing every 'o ').

    Month names are matched case-insensitively against the genitive forms.
    """
    s = F.replace(_c(c), F.lit("o "), F.lit(""))
    months = F.expr("map(" + ", ".join(f"{_sql_string(m)}, {i}" for i, m in enumerate(vocab.POLISH_MONTHS, 1)) + ")")
    month = F.try_element_at(months, F.lower(F.regexp_extract(s, _POLISH_DATE, 2)))
    text = F.concat_ws(
        "-",
        F.regexp_extract(s, _POLISH_DATE, 3),
        month.cast("string"),
        F.regexp_extract(s, _POLISH_DATE, 1),
    )
    return F.when(month.isNotNull(), F.try_to_date(text, "yyyy-M-d"))


def offer_date(c: ColumnOrName, scraped: ColumnOrName, compat: bool = False) -> Column:
    """T6 + T1: an offer date text; 'Dzisiaj ...' (today) means the crawl date.

    With ``compat=True`` the word is left in place (the source discarded its
    replacement), so such rows become NULL like any other unparsable text.
    """
    parsed = to_date_text(c, compat=compat)
    if compat:
        return parsed
    return F.when(_c(c).contains(vocab.TODAY_WORD), day_of(scraped)).otherwise(parsed)


# ----------------------------------------------------------- strings & flags

def qualified_id(source: ColumnOrName, offer_id: ColumnOrName) -> Column:
    """B1: '<source>_<id>', NULL when either part is NULL."""
    return F.concat(_c(source), F.lit("_"), _c(offer_id))


def lower(c: ColumnOrName) -> Column:
    """B2."""
    return F.lower(_c(c))


def split_part(c: ColumnOrName, sep: str, index: int) -> Column:
    """``split(c, sep)[index]`` with NULL past the end (``sep`` is a regex)."""
    return F.get(F.split(_c(c), sep), index)


def offer_type(c: ColumnOrName, private_word: str) -> Column:
    """NULL stays NULL; the private word -> 'private_owner'; anything else -> 'company'."""
    x = _c(c)
    return F.when(x.isNull(), F.lit(None).cast("string")).when(x == private_word, "private_owner").otherwise("company")


def primary_market(market: ColumnOrName) -> Column:
    """Market differs from the secondary-market word; NULL counts as false."""
    return F.coalesce(_c(market) != vocab.SECONDARY_MARKET_WORD, F.lit(False))


def yes_flag(c: ColumnOrName, yes_word: str = vocab.LIFT_YES_WORD) -> Column:
    """Three-valued flag, NULL stays NULL."""
    return _c(c) == yes_word


def present_flag(c: ColumnOrName) -> Column:
    """Value present."""
    return _c(c).isNotNull()


def contains_flag(c: ColumnOrName, needle: str) -> Column:
    """Substring test, NULL stays NULL."""
    return _c(c).contains(needle)


def _sql_string(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def translate_values(c: ColumnOrName, mapping: Mapping[str, str]) -> Column:
    """Whole-value dictionary translation; unknown values pass through.

    The dictionary is one constant map literal (built from SQL text in a
    single call), looked up per row."""
    m = F.expr("map(" + ", ".join(_sql_string(x) for kv in mapping.items() for x in kv) + ")")
    return F.coalesce(F.try_element_at(m, _c(c)), _c(c))


def join_location(district: ColumnOrName, city: ColumnOrName, region: ColumnOrName) -> Column:
    """B10: 'district;city;region', a missing part as an empty string."""
    return F.concat_ws(";", *[F.coalesce(_c(x), F.lit("")) for x in (district, city, region)])


def stored_image_path(c: ColumnOrName) -> Column:
    """Image store path without the 'full/' folder."""
    return F.replace(_c(c), F.lit("full/"), F.lit(""))
