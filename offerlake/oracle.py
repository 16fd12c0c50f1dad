"""DuckDB oracle SQL for the registered queries.

Written against the SURVEY's semantics directly in SQL, independent of the
Spark code; only the fixture texts (F4, F5) are shared.  Helpers below build
repeated fragments (a null-token CASE per column, a value map as CASE).
"""

from __future__ import annotations

from offerlake.functions import vocab
from offerlake.sources.fixtures import F4_SQL, F5_SQL, duck

F4 = duck(F4_SQL)
F5 = duck(F5_SQL)

F4_STRINGS = (
    "offer_source", "offer_id", "short_description", "description", "price_total", "offer_type",
    "offer_date", "city", "price_per_msq", "floor", "building_type", "size", "n_rooms",
)
F4_COLUMNS = (
    "offer_source", "offer_id", "date_scraped", "short_description", "description", "price_total",
    "offer_type", "offer_date", "city", "price_per_msq", "floor", "building_type", "size", "n_rooms", "seq",
)
F5_COLUMNS = (
    "offer_source", "offer_id", "date_scraped", "short_description", "description", "price_total",
    "price_per_msq", "size", "n_rooms", "floor", "offer_date", "city", "market", "offer_type", "year_built",
    "lift", "media_types", "rent", "equipment", "outdoor", "parking", "security", "windows_type",
    "building_material", "heating_type", "ownership_type", "construction_status", "building_type", "seq",
)
F5_STRINGS = (
    "offer_source", "offer_id", "short_description", "description", "price_total", "price_per_msq",
    "size", "n_rooms", "floor", "offer_date", "city", "market", "offer_type", "year_built", "lift",
    "media_types", "rent", "equipment", "outdoor", "parking", "security", "windows_type",
    "building_material", "heating_type", "ownership_type", "construction_status", "building_type",
)


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


TOKENS = "(" + ", ".join(q(t) for t in vocab.NULL_TOKENS) + ")"
LEGACY_INT_RE = r"'^\s*([+-]?\d+)(\.\d*)?\s*$'"


def nt(c: str) -> str:
    return f"case when {c} in {TOKENS} then null else {c} end"


def legacy_int(e: str) -> str:
    return f"try_cast(regexp_extract({e}, {LEGACY_INT_RE}, 1) as integer)"


def money(e: str) -> str:
    return f"cast(round(try_cast(replace(replace({e}, ' zł', ''), ' ', '') as float), 2) as float)"


def to_float2(e: str) -> str:
    return f"cast(round(try_cast({e} as float), 2) as float)"


def case_map(e: str, mapping: dict) -> str:
    whens = " ".join(f"when {q(k)} then {q(v)}" for k, v in mapping.items())
    return f"case {e} {whens} else {e} end"


def real_date(e: str) -> str:
    return f"cast(try_strptime({e}, '%Y-%m-%d') as date)"


def offer_date(e: str, scraped: str = "date_scraped") -> str:
    return f"case when contains({e}, 'Dzisiaj') then cast({scraped} as date) else {real_date(e)} end"


def compat_date(e: str) -> str:
    """'yyyy-mm-dd' read with mm as minutes: year and day kept, month dropped."""
    return (
        f"case when regexp_full_match({e}, '\\d{{4}}-[0-5]\\d-\\d{{2}}') "
        f"then cast(try_strptime(substr({e}, 1, 4) || '-01-' || substr({e}, 9, 2), '%Y-%m-%d') as date) end"
    )


def standardized_cte(src: str, strings: tuple, rest: tuple, name: str = "std") -> str:
    """P5 over a fixture CTE ``src``: tokens -> NULL, both keys present, newlines -> spaces."""
    cols = []
    for c in strings:
        e = nt(c)
        if c in ("short_description", "description"):
            e = f"regexp_replace({e}, '[\\n\\r]', ' ', 'g')"
        cols.append(f"{e} as {c}")
    cols += list(rest)
    return (
        f"{name} as (select {', '.join(cols)} from {src} "
        f"where {nt('offer_id')} is not null and {nt('price_total')} is not null)"
    )


def total_order(columns: tuple, key: str, order: tuple = ("date_scraped", "seq")) -> str:
    """The order columns, then every other non-key column in table order: a total order."""
    tie = [c for c in columns if c not in order and c != key]
    return "order by " + ", ".join(f"{c} nulls first" for c in list(order) + tie)


def dedup_cte(src: str, name: str = "dd", columns: tuple = (), order: tuple = ("date_scraped", "seq")) -> str:
    """D3 with the fixture order (date_scraped, seq), ties broken by the other columns."""
    o1 = total_order(columns, "offer_id", order)
    o2 = total_order(columns, "short_description", order)
    return (
        f"{name}_1 as (select * from {src} qualify row_number() over (partition by offer_id {o1}) = 1), "
        f"{name} as (select * from {name}_1 qualify row_number() over (partition by short_description {o2}) = 1)"
    )


SILVER_TYPES = (
    ("offer_source", "varchar"), ("offer_id", "varchar"), ("date_scraped", "date"), ("title", "varchar"),
    ("canonical_url", "varchar"), ("short_description", "varchar"), ("description", "varchar"),
    ("offer_type", "varchar"), ("offer_date", "date"), ("modified_date", "date"), ("location", "varchar"),
    ("city", "varchar"), ("district", "varchar"), ("region", "varchar"), ("price_total", "float"),
    ("price_per_msq", "float"), ("size", "float"), ("n_rooms", "integer"), ("construction_status", "varchar"),
    ("ownership_type", "varchar"), ("floor", "integer"), ("rent", "float"), ("heating_type", "varchar"),
    ("year_built", "integer"), ("building_type", "varchar"), ("windows_type", "varchar"),
    ("building_material", "varchar"), ("image_urls", "varchar[]"),
    ("images", "struct(url varchar, path varchar, checksum varchar, status varchar)[]"),
    ("scraper_timestamp", "timestamp"), ("primary_market", "boolean"),
) + tuple(
    (n, "boolean")
    for n in (
        "has_lift", "has_tv", "has_internet", "has_phone_line", "is_furnished", "has_dishwasher",
        "has_fridge", "has_oven", "has_stove", "has_washing_machine", "has_garden", "has_balcony",
        "has_porch", "has_parking", "gated_community", "guarded_building", "has_cctv",
    )
)


def fit_silver(src: str, present: dict) -> str:
    """P10: the 48 silver columns in order; absent ones as typed NULLs."""
    cols = []
    for n, t in SILVER_TYPES:
        e = present.get(n)
        cols.append(f"cast({e} as {t}) as {n}" if e else f"cast(null as {t}) as {n}")
    return f"select {', '.join(cols)} from {src}"


def shared_exprs(cols: tuple) -> dict:
    """B12 expressions over the deduplicated fixture columns."""
    e = {
        "offer_source": "offer_source",
        "offer_id": "offer_source || '_' || offer_id",
        "date_scraped": "cast(date_scraped as date)",
        "scraper_timestamp": "cast(date_scraped as timestamp)",
        "short_description": "short_description",
        "description": "description",
        "price_total": money("price_total"),
        "price_per_msq": to_float2("price_per_msq"),
        "size": to_float2("size"),
        "n_rooms": legacy_int("n_rooms"),
        "floor": legacy_int(case_map("floor", vocab.FLOOR_LABELS)),
        "offer_date": offer_date("offer_date"),
        "city": "city",
        "offer_type": "offer_type",
        "building_type": "building_type",
    }
    return {k: v for k, v in e.items() if k in cols or k in ("scraper_timestamp",)}


def olx_exprs() -> dict:
    sh = shared_exprs(F4_STRINGS + ("date_scraped", "seq"))
    sh["offer_type"] = (
        "case when offer_type is null then null when offer_type = 'Prywatne' then 'private_owner' else 'company' end"
    )
    sh["city"] = "lower(city)"
    sh["building_type"] = case_map("building_type", vocab.OLX_VALUE_MAPS["building_type"])
    return sh


def olx_silver_ctes(p: str = "ol", bronze: bool = False) -> str:
    """CTEs {p}_f4 .. silver_olx: J1 over F4 (OLX rules).

    ``bronze=True``: F4 as it reads back from the OLX bronze table (no ``seq``),
    deduplicated by ``date_scraped`` with ties broken by the bronze columns in
    table order -- the whole run's order.
    """
    sh = olx_exprs()
    if bronze:
        src, strings, rest, columns, order = bronze_rows(F4, "olx", F4_COLUMNS), *bronze_parts("olx"), ("date_scraped",)
    else:
        src, strings, rest, columns, order = F4, F4_STRINGS, ("date_scraped", "seq"), F4_COLUMNS, ("date_scraped", "seq")
    return (
        f"{p}_f4 as ({src}), {standardized_cte(p + '_f4', strings, rest, p + '_std')}, "
        f"{dedup_cte(p + '_std', p + '_dd', columns, order)}, silver_olx as ({fit_silver(p + '_dd', sh)})"
    )


def otodom_exprs() -> dict:
    rest = ("date_scraped", "seq")
    e = shared_exprs(F5_STRINGS + rest)
    e.update(
        {
            "primary_market": "coalesce(market <> 'wtórny', false)",
            "offer_type": "case when offer_type is null then null "
            "when offer_type = 'prywatny' then 'private_owner' else 'company' end",
            "year_built": legacy_int("year_built"),
            "has_lift": "lift = 'tak'",
            "rent": money("rent"),
            "has_parking": "parking is not null",
            "city": "lower(city)",
        }
    )
    for src, flags in vocab.CONTAINMENT_FLAGS.items():
        for flag, needle in flags.items():
            e[flag] = f"contains({src}, {q(needle)})"
    for c, m in vocab.OTODOM_VALUE_MAPS.items():
        e[c] = case_map(c, m)
    return e


def otodom_silver_ctes(p: str = "ot", bronze: bool = False) -> str:
    """CTEs {p}_f5 .. silver_otodom: J1 over F5 (otodom rules); ``bronze`` as for OLX."""
    if bronze:
        src, strings, rest, columns, order = bronze_rows(F5, "otodom", F5_COLUMNS), *bronze_parts("otodom"), ("date_scraped",)
    else:
        src, strings, rest, columns, order = F5, F5_STRINGS, ("date_scraped", "seq"), F5_COLUMNS, ("date_scraped", "seq")
    return (
        f"{p}_f5 as ({src}), {standardized_cte(p + '_f5', strings, rest, p + '_std')}, "
        f"{dedup_cte(p + '_std', p + '_dd', columns, order)}, silver_otodom as ({fit_silver(p + '_dd', otodom_exprs())})"
    )


def duck_type(t) -> str:
    """DuckDB spelling of the Spark types the bronze schemas use."""
    from pyspark.sql.types import ArrayType, BooleanType, StringType, StructType, TimestampType

    if isinstance(t, StringType):
        return "varchar"
    if isinstance(t, BooleanType):
        return "boolean"
    if isinstance(t, TimestampType):
        return "timestamp"
    if isinstance(t, ArrayType):
        return duck_type(t.elementType) + "[]"
    if isinstance(t, StructType):
        return "struct(" + ", ".join(f"{f.name} {duck_type(f.dataType)}" for f in t.fields) + ")"
    raise TypeError(t)


def bronze_rows(fixture: str, site: str, have: tuple) -> str:
    """A fixture's rows (columns ``have``) as the site's bronze table holds them:
    its columns, its types, typed NULLs for the rest."""
    from offerlake.operators.schema import BRONZE_SCHEMAS

    cols = []
    for f in BRONZE_SCHEMAS[site].fields:
        t = duck_type(f.dataType)
        cols.append(f"cast({f.name if f.name in have else 'null'} as {t}) as {f.name}")
    return f"select {', '.join(cols)} from ({fixture})"


def bronze_parts(site: str) -> tuple[tuple, tuple, tuple]:
    """(string columns, other columns, all columns in order) of a bronze table."""
    from pyspark.sql.types import StringType

    from offerlake.operators.schema import BRONZE_SCHEMAS

    fields = BRONZE_SCHEMAS[site].fields
    strings = tuple(f.name for f in fields if isinstance(f.dataType, StringType))
    rest = tuple(f.name for f in fields if not isinstance(f.dataType, StringType))
    return strings, rest, tuple(f.name for f in fields)
