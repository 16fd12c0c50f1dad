"""The oracle SQL texts, one per registered query id that SQL can express."""

from __future__ import annotations

from offerlake import oracle as o
from offerlake.functions import vocab
from offerlake.operators.schema import BRONZE_OLX_SCHEMA, BRONZE_OTODOM_SCHEMA, ML_FEATURES
from offerlake.sources import listing_pages
from offerlake.sources.fixtures import duck

ORACLES: dict[str, str] = {}


def oracle(name: str, sql: str) -> None:
    ORACLES[name] = sql


# ------------------------------------------------------------ composites (J)

oracle("j1_silver_olx", f"with {o.olx_silver_ctes()} select * from silver_olx")
oracle("j1_silver_otodom", f"with {o.otodom_silver_ctes()} select * from silver_otodom")

_COMPAT = o.olx_exprs() | {
    "offer_date": o.compat_date("offer_date"),
    "date_scraped": o.compat_date("split_part(cast(date_scraped as varchar), ' ', 1)"),
}
oracle(
    "j1_silver_olx_compat",
    f"with {o.olx_silver_ctes().split(', silver_olx as')[0]}, silver_c as ({o.fit_silver('ol_dd', _COMPAT)}) "
    "select * from silver_c",
)

_COMPAT5 = o.otodom_exprs() | {c: _COMPAT[c] for c in ("offer_date", "date_scraped")}
oracle(
    "j1_silver_otodom_compat",
    f"with {o.otodom_silver_ctes().split(', silver_otodom as')[0]}, silver_c as ({o.fit_silver('ot_dd', _COMPAT5)}) "
    "select * from silver_c",
)

_BOTH = (
    f"with {o.olx_silver_ctes()}, {o.otodom_silver_ctes()}, "
    "silver as (select * from silver_olx union all select * from silver_otodom)"
)

oracle(
    "j2_analytics",
    f"{_BOTH} select offer_date, city, price_total, price_per_msq, size from silver "
    "where price_total is not null and price_per_msq is not null order by offer_date nulls first",
)
oracle(
    "j3_ml_dataset",
    f"{_BOTH} select {', '.join(ML_FEATURES)} "
    "from silver where price_total is not null",
)

# ------------------------------------------------------ standardise & dedup

_F4_STD = f"f4 as ({o.F4}), {o.standardized_cte('f4', o.F4_STRINGS, ('date_scraped', 'seq'))}"

oracle("p5_standardize", f"with {_F4_STD} select * from std")
oracle("d3_deduplicate", f"with {_F4_STD}, {o.dedup_cte('std', 'dd', o.F4_COLUMNS)} select * from dd")

oracle(
    "p10_ensure_schema",
    f"with {_F4_STD} "
    + o.fit_silver(
        "std",
        {
            "offer_source": "offer_source",
            "offer_id": "offer_id",
            "date_scraped": "cast(date_scraped as date)",
            "short_description": "short_description",
            "description": "description",
            "price_total": "try_cast(price_total as float)",
            "offer_type": "offer_type",
            "offer_date": "try_cast(offer_date as date)",
            "city": "city",
            "price_per_msq": "try_cast(price_per_msq as float)",
            "floor": o.legacy_int("floor"),
            "building_type": "building_type",
            "size": "try_cast(size as float)",
            "n_rooms": o.legacy_int("n_rooms"),
        },
    ),
)

_B12 = o.shared_exprs(o.F4_STRINGS + ("date_scraped", "seq"))
oracle(
    "b12_shared_rules",
    f"with {_F4_STD} select {', '.join(f'{e} as {n}' for n, e in _B12.items())}, seq from std",
)

# --------------------------------------------------------- row-wise operators

_F4 = f"f4 as ({o.F4})"
_F5 = f"f5 as ({o.F5})"
_U = f"{_F4}, {_F5}, u as (select * from f4 union all by name select * from f5)"


def _sel(cols: dict, src: str) -> str:
    return f"select {', '.join(f'{e} as {n}' for n, e in cols.items())} from {src}"


_P1_F4 = {c: o.nt(c) for c in o.F4_STRINGS} | {"date_scraped": "date_scraped", "seq": "seq"}
_P1_F5 = {c: o.nt(c) for c in o.F5_STRINGS} | {"date_scraped": "date_scraped", "seq": "seq"}
_T4 = f"{_F4}, t4 as ({_sel(_P1_F4, 'f4')})"
_T5 = f"{_F5}, t5 as ({_sel(_P1_F5, 'f5')})"

oracle("p1_null_tokens", f"with {_T4} select * from t4")
oracle(
    "p2_drop_all_null",
    f"with {_F5}, t as ({_sel({c: o.nt(c) for c in ('floor', 'year_built', 'lift')}, 'f5')}) "
    "select * from t where not (floor is null and year_built is null and lift is null)",
)
oracle("p3_require_keys", f"with {_T4} select * from t4 where offer_id is not null and price_total is not null")
oracle(
    "p4_one_line",
    f"with {_F4} select * replace (regexp_replace(short_description, '[\\n\\r]', ' ', 'g') as short_description, "
    "regexp_replace(description, '[\\n\\r]', ' ', 'g') as description) from f4",
)
oracle(
    "p4_one_line_documents",
    "select doc_id, regexp_replace(text, '[\\n\\r]', ' ', 'g') as text, lang, source, n_chars from documents",
)
oracle("p11_drop_consumed", f"with {_F5} select * exclude (media_types, lift, equipment, market, outdoor, parking, security) from f5")
oracle("p16_source_filter", f"with {_U} select * from u where contains(offer_source, 'olx')")
oracle("s1_read_table", "select * from lineitem")
oracle("s6_read_schema", "select l_orderkey, l_linenumber, l_extendedprice, l_shipdate from lineitem")
oracle("d5_single_source", "select 'olx' as site, count(*) as n from orders union all select 'otodom', count(*) from lineitem")
oracle("s5_union_evolving", f"with {_U} select * from u")

_STD4 = f"{_F4}, {o.standardized_cte('f4', o.F4_STRINGS, ('date_scraped', 'seq'))}"
oracle(
    "d1_dedup_offer_id",
    f"with {_STD4} select * from std qualify row_number() over "
    f"(partition by offer_id {o.total_order(o.F4_COLUMNS, 'offer_id')}) = 1",
)
_D2 = (
    "select * from std qualify row_number() over "
    f"(partition by short_description {o.total_order(o.F4_COLUMNS, 'short_description')}) = 1"
)
oracle("d2_dedup_short_description", f"with {_STD4} {_D2}")
oracle(
    "d2_keep_null_keys",
    f"with {_STD4} select * from std where short_description is null "
    f"union all select * from ({_D2.replace('from std', 'from std where short_description is not null')})",
)
oracle(
    "d3_documents",
    "select * from documents qualify row_number() over (partition by text order by doc_id) = 1",
)
oracle("d4_distinct_sources", f"with {_U} select distinct offer_source from u")
oracle(
    "a1_exists",
    f"with {_U} select count(*) > 0 as has_olx from (select 1 from u where contains(offer_source, 'olx') limit 1)",
)

oracle(
    "c1_legacy_int",
    f"with {_F4} select seq, floor, n_rooms, {o.legacy_int('floor')} as floor_int, "
    f"{o.legacy_int('n_rooms')} as n_rooms_int from f4",
)
oracle(
    "c1_legacy_int_year",
    f"with {_F5} select seq, year_built, n_rooms, {o.legacy_int('year_built')} as year_int, "
    f"{o.legacy_int('n_rooms')} as n_rooms_int from f5",
)
oracle(
    "c2_to_float",
    f"with {_F4} select seq, try_cast(price_per_msq as float) as price_per_msq, try_cast(size as float) as size from f4",
)
_MONEY_RAW = "try_cast(replace(replace({c}, ' zł', ''), ' ', '') as float)"
oracle(
    "c3_money",
    f"with {_F5} select seq, rent, {_MONEY_RAW.format(c='price_total')} as price_total_f, "
    f"{_MONEY_RAW.format(c='rent')} as rent_f from f5",
)
oracle(
    "c4_round",
    f"with {_F4} select seq, {o.to_float2('price_per_msq')} as price_per_msq, {o.money('price_total')} as price_total from f4",
)
oracle(
    "t1_to_date",
    f"with {_F4} select seq, offer_date, {o.real_date('offer_date')} as real_date, "
    f"{o.compat_date('offer_date')} as compat_date from f4",
)
_SCRAPE_TXT = "split_part(cast(date_scraped as varchar), ' ', 1)"
oracle(
    "t2_scrape_date",
    f"with {_F5} select seq, cast(date_scraped as date) as real_date, "
    f"{o.compat_date(_SCRAPE_TXT)} as compat_date from f5",
)
oracle(
    "t3_to_timestamp",
    f"with {_F4} select seq, cast(date_scraped as timestamp) as ts, try_cast(offer_date as timestamp) as offer_ts from f4",
)
_ISO = r"\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,6}(Z|[+-]\d{2}:?\d{2}(:?\d{2})?)"
oracle(
    "t4_iso_date",
    "with e as (select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || case event_id % 3 when 0 then '+01:00' "
    "when 1 then 'Z' else '.123Z' end as created_at from events) "
    f"select event_id, created_at, case when regexp_full_match(created_at, '{_ISO}') "
    "then cast(try_strptime(split_part(created_at, 'T', 1), '%Y-%m-%d') as date) end as offer_date from e",
)
_MONTHS = "[" + ", ".join(o.q(m) for m in vocab.POLISH_MONTHS) + "]"
_PL_RE = r"'^\s*(\d{1,2})\s+(\S+)\s+(\d{4})\s*$'"
oracle(
    "t5_polish_date",
    f"with m as (select o_orderkey, o_orderdate, list_extract({_MONTHS}, month(o_orderdate)) as name from orders), "
    "t as (select o_orderkey, case when o_orderkey % 5 = 0 then 'Dzisiaj o 12:00' else "
    "cast(day(o_orderdate) as varchar) || ' ' || case when o_orderkey % 5 = 1 "
    "then upper(substr(name, 1, 1)) || substr(name, 2) else name end || ' ' || cast(year(o_orderdate) as varchar) "
    "end as posted from m), "
    "s as (select o_orderkey, posted, replace(posted, 'o ', '') as s from t), "
    f"p as (select o_orderkey, posted, regexp_extract(s, {_PL_RE}, 1) as d, "
    f"list_position({_MONTHS}, lower(regexp_extract(s, {_PL_RE}, 2))) as mo, regexp_extract(s, {_PL_RE}, 3) as y from s) "
    "select o_orderkey, posted, case when mo is not null then "
    "cast(try_strptime(y || '-' || lpad(cast(mo as varchar), 2, '0') || '-' || lpad(d, 2, '0'), '%Y-%m-%d') as date) "
    "end as offer_date from p",
)
oracle(
    "t6_today",
    f"with {_F4} select seq, {o.offer_date('offer_date')} as real_date, {o.compat_date('offer_date')} as compat_date from f4",
)
oracle("b1_qualified_id", f"with {_T4} select seq, offer_source || '_' || offer_id as offer_id from t4")
oracle("b2_lower_city", f"with {_F4} select seq, lower(city) as city from f4")
oracle(
    "b3_split_get",
    f"with {_F4}, t as (select seq, cast(date_scraped as varchar) as txt from f4) "
    "select seq, split(txt, ' ')[1] as day, split(txt, ' ')[2] as time, split(txt, ' ')[6] as past_end from t",
)
oracle(
    "b4_offer_type",
    f"with {_T5} select seq, case when offer_type is null then null when offer_type = 'prywatny' "
    "then 'private_owner' else 'company' end as offer_type from t5",
)
oracle("b5_primary_market", f"with {_T5} select seq, coalesce(market <> 'wtórny', false) as primary_market from t5")
oracle("b6_lift", f"with {_T5} select seq, lift = 'tak' as has_lift from t5")
oracle("b7_parking", f"with {_T5} select seq, parking is not null as has_parking from t5")
_FLAGS = {
    flag: f"contains({src}, {o.q(needle)})"
    for src, flags in vocab.CONTAINMENT_FLAGS.items()
    for flag, needle in flags.items()
}
oracle("b8_flags", f"with {_T5} {_sel({'seq': 'seq'} | _FLAGS, 't5')}")
oracle("b9_value_maps", f"with {_F5} {_sel({'seq': 'seq'} | {c: o.case_map(c, m) for c, m in vocab.OTODOM_VALUE_MAPS.items()}, 'f5')}")
oracle("b9_value_maps_olx", f"with {_F4} {_sel({'seq': 'seq'} | {c: o.case_map(c, m) for c, m in vocab.OLX_VALUE_MAPS.items()}, 'f4')}")
oracle(
    "b10_location",
    f"with {_T5} select seq, concat_ws(';', coalesce(floor, ''), coalesce(city, ''), coalesce(lift, '')) as location from t5",
)
oracle("b11_image_path", "select page_id, replace('full/' || sha1(url) || '.jpg', 'full/', '') as path from pages")
_STD5 = f"{_F5}, {o.standardized_cte('f5', o.F5_STRINGS, ('date_scraped', 'seq'))}"
oracle("b13_otodom_rules", f"with {_STD5} {_sel(o.otodom_exprs() | {'seq': 'seq'}, 'std')}")
oracle("b14_olx_rules", f"with {_STD4} {_sel(o.olx_exprs() | {'seq': 'seq'}, 'std')}")

# ------------------------------------------------------- extraction (pages)

_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", " "), ("&amp;", "&"))


def _unescape(e: str) -> str:
    for ent, ch in _ENTITIES:
        e = f"replace({e}, {o.q(ent)}, {o.q(ch)})"
    return e


_HIDDEN = r"(?is)<script\b[^>]*>.*?</script>|<style\b[^>]*>.*?</style>|<!--.*?-->"
oracle(
    "x1_title",
    "select page_id, " + _unescape(
        r"nullif(regexp_extract(html, '(?is)<title\b[^>]*>([^<]*)</title>', 1), '')"
    ) + " as title from pages",
)
oracle(
    "x2_first_paragraph",
    f"with v as (select page_id, regexp_replace(html, '{_HIDDEN}', '', 'g') as h from pages), "
    r"p as (select page_id, regexp_extract_all(h, '(?is)<p\b[^>]*>(.*?)</p\s*>', 1) as paras from v), "
    r"r as (select page_id, flatten(list_transform(paras, lambda x: regexp_split_to_array(x, '<[^>]*>'))) as runs from p) "
    "select page_id, " + _unescape("list_filter(runs, lambda x: x <> '')[1]") + " as description from r",
)
_SCHEME = "[a-zA-Z][a-zA-Z0-9+.-]*"
oracle(
    "x4_links",
    r"""with h as (select page_id, url, unnest(regexp_extract_all(html, '(?is)<a\b[^>]*?\bhref\s*=\s*["'']([^"'']*)["'']', 1)) as href from pages), """
    f"u as (select page_id, url, {_unescape('href')} as href from h), "
    f"a as (select distinct page_id, case when regexp_matches(href, '^{_SCHEME}:') then href "
    f"when starts_with(href, '//') then regexp_extract(url, '^({_SCHEME}:)', 1) || href "
    f"when starts_with(href, '/') then regexp_extract(url, '^({_SCHEME}://[^/?#]+)', 1) || href "
    f"else coalesce(nullif(regexp_extract(url, '^({_SCHEME}://[^?#]*/)', 1), ''), "
    f"regexp_extract(url, '^({_SCHEME}://[^/?#]+)', 1) || '/') || href end as link from u) "
    "select page_id, link from a where regexp_matches(link, '(?:/[a-z]+$)') and not regexp_matches(link, '/the$')",
)
oracle(
    "s11_crawl_seeds",
    r"with b as (select regexp_extract(url, '^([^?#]*)', 1) as base, "
    r"coalesce(try_cast(nullif(regexp_extract(url, '[?&]page=(\d+)', 1), '') as integer), 1) as n from pages), "
    "g as (select base, max(n) as n from b group by base), "
    "s as (select base, cast(unnest(range(1, greatest(n, 1) + 1)) as integer) as page from g) "
    "select base, page, base || '?page=' || cast(page as varchar) as seed_url from s",
)

_OLX_PAGES = f"with p as ({duck(listing_pages.OLX_PAGES_SQL)})"
_OTODOM_PAGES = f"with p as ({duck(listing_pages.OTODOM_PAGES_SQL)})"


def _same(names: str) -> dict[str, str]:
    return {c: c for c in names.split(", ")}


def _unless_broken(**cols: str) -> dict[str, str]:
    return {c: f"case when not broken then {e} end" for c, e in cols.items()}


_OLX_DETAILS = _same("offer_type, price_per_msq, primary_market, floor, building_type, size, n_rooms")
_OLX_STATE = _same("price_total, district, city, region")
_OLX_IMAGES = {"image_urls": "list_filter([image_1, image_2], lambda x: x is not null)"}
_OTODOM_CELLS = {c: f"nullif({c}, '')" for c in vocab.OTODOM_DETAIL_CELLS}
_OTODOM_IDS = _unless_broken(offer_id="'otodom_' || k", city="city", district="district", region="region")
_OTODOM_IMAGES = _unless_broken(image_urls="[image_1, image_2]")
_OTODOM_DATES = _unless_broken(offer_date="created", modified_date="modified")
_OTODOM_PRICES = {"price_total": "price_total", "price_per_msq": "price_per_msq", "location": "address"}

for _name, _ctes, _cols in (
    ("x3_head_links", _OLX_PAGES, _same("canonical_url, short_description")),
    ("x4_links_by_anchor", _OTODOM_PAGES, {"link": "url"}),
    ("x5_olx_details", _OLX_PAGES, _OLX_DETAILS),
    ("x6_olx_state", _OLX_PAGES, _OLX_STATE),
    ("x7_otodom_details", _OTODOM_PAGES, _OTODOM_CELLS),
    ("x8_otodom_ids", _OTODOM_PAGES, _OTODOM_IDS),
    ("x9_otodom_images", _OTODOM_PAGES, _OTODOM_IMAGES),
    ("x10_otodom_prices", _OTODOM_PAGES, _OTODOM_PRICES),
    ("x11_otodom_dates", _OTODOM_PAGES, _OTODOM_DATES),
    ("x12_olx_footer_and_images", _OLX_PAGES, {"offer_id": "offer_id"} | _OLX_IMAGES),
):
    oracle(_name, f"{_ctes} {_sel({'page_id': 'page_id'} | _cols, 'p')}")


def _bronze_page(ctes: str, schema, known: dict[str, str]) -> str:
    """A bronze row per page: the known columns, NULL for the rest."""
    cols = [f"{known[f.name]} as {f.name}" if f.name in known else f"cast(null as {o.duck_type(f.dataType)}) as {f.name}" for f in schema.fields]
    return f"{ctes} select page_id, {', '.join(cols)} from p"


_CRAWLED = {"date_scraped": "timestamp '2024-01-22 10:00:00'"}
oracle(
    "x13_bronze_olx",
    _bronze_page(
        _OLX_PAGES,
        BRONZE_OLX_SCHEMA,
        {"offer_source": "'olx'", "offer_date": "offer_date", "modified_date": "offer_date"}
        | _CRAWLED | _same("title, canonical_url, short_description, description, offer_id") | _OLX_STATE | _OLX_DETAILS | _OLX_IMAGES
        | _unless_broken(location="concat_ws(';', district, city, region)"),
    ),
)
oracle(
    "x13_bronze_otodom",
    _bronze_page(
        _OTODOM_PAGES,
        BRONZE_OTODOM_SCHEMA,
        {"offer_source": "'otodom'", "title": "title", "canonical_url": "url", "short_description": "title", "description": "short_description"}
        | _CRAWLED | _OTODOM_IDS | _OTODOM_IMAGES | _OTODOM_DATES | _OTODOM_PRICES | _OTODOM_CELLS,
    ),
)
_TITLE = _unescape(r"nullif(regexp_extract(html, '(?is)<title\b[^>]*>([^<]*)</title>', 1), '')")
_NOTHING = "cast(null as varchar) as offer_id, cast(null as varchar) as price_total"
oracle(
    "x13_raw_pages_olx",
    f"select page_id, 'olx' as offer_source, {_TITLE} as title, {_NOTHING}, false as primary_market, cast([] as varchar[]) as image_urls from pages",
)
oracle("x13_raw_pages_otodom", f"select page_id, 'otodom' as offer_source, {_TITLE} as title, {_NOTHING}, cast(null as varchar[]) as image_urls from pages")

# ------------------------------------------------------------- price model

_GOLD = f"{_BOTH}, gold as materialized (select {', '.join(ML_FEATURES)} from silver where price_total is not null)"
_TYPES = dict(o.SILVER_TYPES)
_MEAN = ("size", "rent")
_MODE = (
    "offer_type", "building_type", "year_built", "floor", "primary_market", "has_lift", "has_tv", "has_internet",
    "has_phone_line", "is_furnished", "has_dishwasher", "has_fridge", "has_oven", "has_stove",
    "has_washing_machine", "has_garden", "has_balcony", "has_porch", "has_parking", "gated_community",
    "guarded_building", "has_cctv", "n_rooms",
)
_CATS = [c for c in ML_FEATURES if _TYPES[c] in ("varchar", "boolean")]
_CONST = [c for c in ML_FEATURES if _TYPES[c] == "varchar" and c not in _MODE]

oracle("p19_features", f"{_GOLD} select * exclude (price_total) from gold")
oracle("p19_target", f"{_GOLD} select price_total from gold")
oracle("a2_non_null_counts", f"{_GOLD} select {', '.join(f'count({c}) as {c}' for c in ML_FEATURES)} from gold")
oracle("a3_mean", f"{_GOLD} select {', '.join(f'round(avg({c}), 4) as {c}_mean' for c in _MEAN)} from gold")


def _mode_rows() -> str:
    parts = []
    for c in _MODE:
        num = f"cast({c} as double)" if _TYPES[c] in ("integer", "boolean", "float") else "cast(null as double)"
        txt = "cast(null as varchar)" if _TYPES[c] in ("integer", "boolean", "float") else f"cast({c} as varchar)"
        parts.append(
            f"select {o.q(c)} as \"column\", {num} as num, {txt} as txt, cast({c} as varchar) as value, count(*) as n "
            f"from gold where {c} is not null group by all"
        )
    return " union all ".join(parts)


_MODES = (
    f"modes as (select \"column\", value, n from ({_mode_rows()}) "
    "qualify row_number() over (partition by \"column\" order by n desc, num asc nulls first, txt asc nulls first) = 1)"
)
oracle("a4_mode", f"{_GOLD}, {_MODES} select * from modes")
oracle(
    "a5_categories",
    f"{_GOLD}, c as ("
    + " union all ".join(f"select distinct {o.q(c)} as \"column\", cast({c} as varchar) as category from gold where {c} is not null" for c in _CATS)
    + ") select \"column\", category, cast(dense_rank() over (partition by \"column\" order by category) - 1 as double) as index from c",
)
oracle(
    "a6_rmse",
    f"{_GOLD}, m as (select city, avg(price_total) as prediction from gold group by city) "
    "select round(sqrt(avg(power(m.prediction - gold.price_total, 2))), 4) as rmse "
    "from gold join m on gold.city is not distinct from m.city",
)

# The means are made once; as subqueries of every row's projection they made the check run out of time.
_MEANS = "means as materialized (select " + ", ".join(f"cast(avg({c}) as float) as {c}_mean" for c in _MEAN) + " from gold)"
_MEAN_FILL = {c: f"coalesce({c}, {c}_mean)" for c in _MEAN}
_MODE_FILL = {
    c: f"coalesce({c}, (select cast(value as {_TYPES[c]}) from modes where \"column\" = {o.q(c)}))" for c in _MODE
}
_CONST_FILL = {c: f"coalesce({c}, 'MISSING')" for c in _CONST}


def _replace(fills: dict) -> str:
    """Gold with columns replaced; the one row of means is joined once, not looked up by each row."""
    means = ", means" if any(c in fills for c in _MEAN) else ""
    return "select gold.* replace (" + ", ".join(f"{e} as {c}" for c, e in fills.items()) + f") from gold{means}"


oracle("m1_impute_mean", f"{_GOLD}, {_MEANS} {_replace(_MEAN_FILL)}")
oracle("m2_impute_mode", f"{_GOLD}, {_MODES} {_replace(_MODE_FILL)}")
oracle("m3_impute_const", f"{_GOLD} {_replace(_CONST_FILL)}")
oracle(
    "m4_ordinal_encode",
    f"{_GOLD}, {_MEANS}, {_MODES}, imp as ({_replace(_MEAN_FILL | _MODE_FILL | _CONST_FILL)}) select price_total, "
    + ", ".join(
        f"cast(dense_rank() over (order by cast({c} as varchar)) - 1 as double) as {c}_idx" for c in _CATS
    )
    + " from imp",
)



def _fold_fills(k: int = 3) -> str:
    """Mean and mode of each column over the rows of the other folds (fold: whole price modulo k)."""
    fold = f"cast(cast(floor(price_total) as bigint) % {k} as integer)"
    parts = []
    for f in range(k):
        rows = f"gold where {fold} <> {f}"
        parts += [f"select {f} as fold, {o.q(c)} as \"column\", cast(null as varchar) as value, round(avg(cast({c} as double)), 6) as mean from {rows}" for c in _MEAN]
        modes = _mode_rows().replace("from gold where", f"from gold where {fold} <> {f} and")
        parts.append(
            f"select {f} as fold, \"column\", value, cast(null as double) as mean from ({modes}) "
            "qualify row_number() over (partition by \"column\" order by n desc, num asc nulls first, txt asc nulls first) = 1"
        )
    return " union all ".join(f"({x})" for x in parts)


oracle("m2_fold_fills", f"{_GOLD} {_fold_fills()}")

# Fold sizes follow from the global rank alone (fold = rank mod 3), whatever order ties take.
oracle(
    "m8_folds",
    f"{_GOLD} select fold, count(*) as n from "
    "(select cast((row_number() over () - 1) % 3 as integer) as fold from gold) group by fold",
)
# Neighbours in price are dealt to different folds, so every price range is shared evenly.
oracle(
    "m8_folds_by_price",
    f"{_GOLD} select cast(floor(price_total / 20000) as bigint) as price_range, count(*) as n, true as even from gold group by 1",
)
oracle("m6_fit_and_score", f"{_GOLD} select count(*) as n, count(*) as n_finite, true as beats_city_mean from gold")
oracle("m9_predict_no_model", f"{_GOLD} select *, cast({vocab.NO_MODEL_PREDICTION} as double) as prediction from gold")

# ------------------------------------------------------- ingest and whole run

# Two ingest runs over the landed OLX rows: bronze holds each row exactly once.
oracle("s4_stream_ingest", o.bronze_rows(o.F4, "olx", o.F4_COLUMNS))

oracle("s4_stream_ingest_otodom", o.bronze_rows(o.F5, "otodom", o.F5_COLUMNS))
oracle(
    "s4_batch_counts",
    f"select 'olx' as site, count(*) as rows, 0 as rescued from ({o.F4}) union all select 'otodom', count(*), 0 from ({o.F5})",
)
# Fields that the schema lacks are kept, with their column or without one.
oracle(
    "s5_evolving_ingest",
    o.bronze_rows(o.F4, "olx", o.F4_COLUMNS).replace(
        " from (", ", cast(seq % 50 as double) / 10 as agent_rating, 'C' || (seq % 7) as energy_class from (", 1
    ),
)
oracle(
    "s2_append_twice",
    f"with {o.olx_silver_ctes()}, s as (select * from silver_olx) select * from s union all select * from s",
)

# The whole run: both sites through bronze (no seq column, so the run's dedup
# order is date_scraped with ties broken by the bronze columns), silver, then
# the analytics gold table as written.
_RUN = (
    f"with {o.olx_silver_ctes(bronze=True)}, {o.otodom_silver_ctes(bronze=True)}, "
    "silver as (select * from silver_olx union all select * from silver_otodom) "
)
oracle("j1_incremental_silver", f"with {o.olx_silver_ctes(bronze=True)} select * from silver_olx")
oracle("j4_silver", f"{_RUN} select * from silver")
oracle("j4_ml", f"{_RUN} select {', '.join(ML_FEATURES)} from silver where price_total is not null")
oracle(
    "j4_run_pipeline",
    f"{_RUN}"
    "select offer_date, city, price_total, price_per_msq, size from silver "
    "where price_total is not null and price_per_msq is not null",
)

# P20 on OLX-only gold: the OLX rules fill seven of the model columns; the
# other 25 are NULL in every OLX row, so exactly these seven remain.
oracle(
    "p20_drop_null_columns",
    f"with {o.olx_silver_ctes()} select price_total, city, size, offer_type, n_rooms, floor, building_type "
    "from silver_olx where price_total is not null",
)
