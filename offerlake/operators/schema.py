"""Table schemas and schema fitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DateType,
    FloatType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from offerlake.functions import parse
from offerlake.operators.clean import quote, sql_string

S, D, FL, I, B, TS = StringType(), DateType(), FloatType(), IntegerType(), BooleanType(), TimestampType()

IMAGE_STRUCT = StructType([StructField(n, S) for n in ("url", "path", "checksum", "status")])

_FLAGS = (
    "has_lift", "has_tv", "has_internet", "has_phone_line", "is_furnished", "has_dishwasher",
    "has_fridge", "has_oven", "has_stove", "has_washing_machine", "has_garden", "has_balcony",
    "has_porch", "has_parking", "gated_community", "guarded_building", "has_cctv",
)

# FIXED VALUES (names, types, order): silver, 48 fields.  primary_market and has_parking are declared non-nullable
# upstream but nullability is not enforced, so all fields are nullable here.
SILVER_SCHEMA = StructType(
    [
        StructField("offer_source", S), StructField("offer_id", S), StructField("date_scraped", D),
        StructField("title", S), StructField("canonical_url", S), StructField("short_description", S),
        StructField("description", S), StructField("offer_type", S), StructField("offer_date", D),
        StructField("modified_date", D), StructField("location", S), StructField("city", S),
        StructField("district", S), StructField("region", S), StructField("price_total", FL),
        StructField("price_per_msq", FL), StructField("size", FL), StructField("n_rooms", I),
        StructField("construction_status", S), StructField("ownership_type", S), StructField("floor", I),
        StructField("rent", FL), StructField("heating_type", S), StructField("year_built", I),
        StructField("building_type", S), StructField("windows_type", S), StructField("building_material", S),
        StructField("image_urls", ArrayType(S)), StructField("images", ArrayType(IMAGE_STRUCT)),
        StructField("scraper_timestamp", TS), StructField("primary_market", B),
    ]
    + [StructField(n, B) for n in _FLAGS]
)

_BRONZE_COMMON = [
    ("offer_source", S), ("offer_id", S), ("date_scraped", TS), ("title", S), ("canonical_url", S),
    ("short_description", S), ("description", S), ("price_total", S), ("offer_type", S),
    ("offer_date", S), ("modified_date", S), ("location", S), ("city", S), ("district", S),
    ("region", S), ("price_per_msq", S),
]

# OLX bronze.
BRONZE_OLX_SCHEMA = StructType(
    [StructField(n, t) for n, t in _BRONZE_COMMON]
    + [StructField(n, t) for n, t in (("primary_market", B), ("floor", S), ("building_type", S), ("size", S), ("n_rooms", S))]
    + [StructField("image_urls", ArrayType(S)), StructField("images", ArrayType(IMAGE_STRUCT))]
)

# otodom bronze.
BRONZE_OTODOM_SCHEMA = StructType(
    [StructField(n, t) for n, t in _BRONZE_COMMON]
    + [
        StructField(n, S)
        for n in (
            "size", "n_rooms", "construction_status", "ownership_type", "floor", "rent", "outdoor",
            "parking", "heating_type", "market", "year_built", "building_type", "windows_type", "lift",
            "media_types", "security", "equipment", "building_material",
        )
    ]
    + [StructField("image_urls", ArrayType(S)), StructField("images", ArrayType(IMAGE_STRUCT))]
)

BRONZE_SCHEMAS = {"olx": BRONZE_OLX_SCHEMA, "otodom": BRONZE_OTODOM_SCHEMA}

# FIXED VALUES: the model's columns, target first, then 31 inputs, in the source's order.
ML_FEATURES = [
    "price_total", "city", "size", "offer_type", "n_rooms",
    "construction_status", "ownership_type", "floor", "rent",
    "heating_type", "year_built", "building_type",
    "windows_type", "building_material", "primary_market",
    "has_lift", "has_tv", "has_internet", "has_phone_line", "is_furnished",
    "has_dishwasher", "has_fridge", "has_oven", "has_stove",
    "has_washing_machine", "has_garden", "has_balcony",
    "has_porch", "has_parking", "gated_community",
    "guarded_building", "has_cctv",
]


def _cast_sql(name: str, src: DataType, dst: DataType) -> str:
    """ANSI-safe cast as SQL text; string -> int goes through the legacy rule."""
    q = quote(name)
    if src == dst:
        return q
    if isinstance(src, StringType) and isinstance(dst, IntegerType):
        return f"TRY_CAST(regexp_extract({q}, {sql_string(parse.LEGACY_INT_PATTERN)}, 1) AS INT)"
    return f"TRY_CAST({q} AS {dst.simpleString()})"


def ensure_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """P10 = P7 + P8 + P9 in one projection.

    Missing fields become typed NULLs (P7), present ones are cast (P8), and
    only the schema's fields are kept, in its order (P9).  Nullability is not
    enforced.  The projection is written as SQL text (one JVM call per
    column).
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for f in schema.fields:
        if f.name in have:
            cols.append(f"{_cast_sql(f.name, have[f.name], f.dataType)} AS {quote(f.name)}")
        else:
            cols.append(f"CAST(NULL AS {f.dataType.simpleString()}) AS {quote(f.name)}")
    return df.selectExpr(*cols)
