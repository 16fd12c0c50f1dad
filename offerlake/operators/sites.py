"""Typing shared by both sites and each site's own rules.

Each step is one projection in which every expression reads the columns as
they were before the step (simultaneous assignment, P6).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlake.functions import parse, vocab
from offerlake.operators.clean import drop_columns
from offerlake.operators.dedup import single_source


def shared_rules(df: DataFrame, compat_dates: bool = False) -> DataFrame:
    """Prices, floor, rooms, sizes, qualified id, dates, crawl timestamp.

    Rules whose source column is absent are skipped.  Dates are real
    'yyyy-MM-dd' dates unless ``compat_dates`` asks for the source pipeline's
    minute-for-month pattern.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    e = {}
    if "floor" in have:
        e["floor"] = parse.legacy_int(parse.translate_values("floor", vocab.FLOOR_LABELS))
    if "n_rooms" in have:
        e["n_rooms"] = parse.legacy_int("n_rooms")
    if "price_total" in have:
        e["price_total"] = parse.round2(parse.money("price_total"))
    for c in ("price_per_msq", "size"):
        if c in have:
            e[c] = parse.round2(parse.to_float(c))
    if "offer_id" in have and "offer_source" in have:
        e["offer_id"] = parse.qualified_id("offer_source", "offer_id")
    for c in ("offer_date", "modified_date"):
        if c in have:
            e[c] = parse.offer_date(c, "date_scraped", compat=compat_dates)
    if "date_scraped" in have:
        e["scraper_timestamp"] = parse.to_timestamp_any("date_scraped", have["date_scraped"])
        e["date_scraped"] = parse.scrape_date("date_scraped", compat=compat_dates)
    return df.withColumns(e)


def containment_flags(df: DataFrame) -> dict:
    """Flag expressions for every needle whose source column is present."""
    return {
        flag: parse.contains_flag(src, needle)
        for src, flags in vocab.CONTAINMENT_FLAGS.items()
        if src in df.columns
        for flag, needle in flags.items()
    }


def value_maps(df: DataFrame, maps: dict) -> dict:
    """Translation expressions for the mapped columns that are present."""
    return {c: parse.translate_values(c, m) for c, m in maps.items() if c in df.columns}


def otodom_rules(df: DataFrame) -> DataFrame:
    """Otodom market, seller, year, lift, amenities, rent, parking, city, vocabularies."""
    have = set(df.columns)
    e = {}
    if "market" in have:
        e["primary_market"] = parse.primary_market("market")
    if "offer_type" in have:
        e["offer_type"] = parse.offer_type("offer_type", vocab.PRIVATE_OWNER_WORD["otodom"])
    if "year_built" in have:
        e["year_built"] = parse.legacy_int("year_built")
    if "lift" in have:
        e["has_lift"] = parse.yes_flag("lift")
    if "rent" in have:
        e["rent"] = parse.round2(parse.money("rent"))
    if "parking" in have:
        e["has_parking"] = parse.present_flag("parking")
    if "city" in have:
        e["city"] = parse.lower("city")
    e.update(containment_flags(df))
    # The vocabularies translate the values as they were before this step.
    e.update(value_maps(df, vocab.OTODOM_VALUE_MAPS))
    return drop_columns(df.withColumns(e), vocab.OTODOM_CONSUMED_COLUMNS)


def olx_rules(df: DataFrame) -> DataFrame:
    """OLX seller type, city, building vocabulary."""
    e = {}
    if "offer_type" in df.columns:
        e["offer_type"] = parse.offer_type("offer_type", vocab.PRIVATE_OWNER_WORD["olx"])
    if "city" in df.columns:
        e["city"] = parse.lower("city")
    e.update(value_maps(df, vocab.OLX_VALUE_MAPS))
    return df.withColumns(e)


SITE_RULES = {"olx": olx_rules, "otodom": otodom_rules}


def site_rules(df: DataFrame, source: str | None = None) -> DataFrame:
    """Apply the rules of the frame's site (found by D5 when not given)."""
    site = source if source is not None else single_source(df)
    return SITE_RULES[site](df)
