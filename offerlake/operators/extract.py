"""Extraction of bronze rows from raw pages, and crawl seeds.

A page table ``(page_id, url, html)`` is turned into bronze rows by one
projection of column expressions: no driver loop, no Python per row.  The
work is a narrow map over the page table, so it scales with the number of
files; a page is never split, so a single huge page stays one row.
"""

from __future__ import annotations

import os
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlake.functions import html as H
from offerlake.functions import parse, vocab
from offerlake.operators.schema import BRONZE_OLX_SCHEMA, BRONZE_OTODOM_SCHEMA, ensure_schema

from pyspark.sql.types import LongType, StructField, StructType

OLX_PAGE_ROW = StructType([StructField("page_id", LongType())] + BRONZE_OLX_SCHEMA.fields)
OTODOM_PAGE_ROW = StructType([StructField("page_id", LongType())] + BRONZE_OTODOM_SCHEMA.fields)


# ------------------------------------------------------------ single fields

def page_title(h: str = "html") -> Column:
    """``//title/text()``."""
    return H.text_or_null(F.regexp_extract(F.col(h), r"(?is)<title\b[^>]*>([^<]*)</title>", 1))


def first_paragraph_text(h: str = "html") -> Column:
    """TakeFirst over ``//p//text()``: the first non-empty text node inside a paragraph.

    Scripts, styles and comments are removed first, so a '</p>' inside a
    script cannot end a paragraph.
    """
    return H.first_text(H.all_inner(H.visible(F.col(h)), "p"))


def canonical_url(h: str = "html") -> Column:
    """``//link[@rel='canonical']/@href``."""
    return H.tag_attribute(h, "link", "rel", "canonical", "href")


def meta_description(h: str = "html") -> Column:
    """``//meta[@name='description']/@content``."""
    return H.tag_attribute(h, "meta", "name", "description", "content")


_URL = r"^(?:([^:/?#]+):)?(?://([^/?#]*))?([^?#]*)(\?[^#]*)?(#.*)?$"


def remove_dots(path: Column) -> Column:
    """A path without '.' and '..' segments (RFC 3986, 5.2.4): '..' takes the segment before it along."""
    parts = F.split(path, "/")
    kept = F.aggregate(
        parts,
        F.array(F.lit("")).cast("array<string>"),
        # The first entry stands for what is before the first '/', and is never removed.
        lambda acc, x: F.when(x == ".", acc)
        .when(x == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(1))))
        .otherwise(F.concat(acc, F.array(x))),
    )
    joined = F.concat(F.lit("/"), F.array_join(F.filter(F.slice(kept, 2, 1_000_000_000), lambda x, i: (i > 0) | (x != "")), "/"))
    # A last segment of dots leaves the folder it names.
    folder = path.rlike(r"(?:^|/)\.\.?$") & ~joined.endswith("/")
    return F.when(folder, F.concat(joined, F.lit("/"))).otherwise(joined)


def resolve_url(href: Column, page_url: Column) -> Column:
    """Absolute form of a link on a page (RFC 3986, 5.2), without its fragment."""

    def part(url: Column, group: int) -> Column:
        return F.regexp_extract(url, _URL, group)

    def absolute(ref: Column, base: Column) -> Column:
        scheme, has_host = part(base, 1), ref.rlike(r"^(?:[^:/?#]+:)?//")
        ref_path, base_path = part(ref, 3), part(base, 3)
        merged = F.concat(F.regexp_extract(base_path, r"^(.*/)", 1), ref_path)
        path = (
            F.when(ref_path == "", base_path)
            .when(ref_path.startswith("/"), remove_dots(ref_path))
            .otherwise(remove_dots(merged))
        )
        path = F.when(has_host, F.when(ref_path == "", F.lit("")).otherwise(remove_dots(ref_path))).otherwise(path)
        host = F.when(has_host, part(ref, 2)).otherwise(part(base, 2))
        query = F.when((part(ref, 4) != "") | has_host | (ref_path != ""), part(ref, 4)).otherwise(part(base, 4))
        return F.concat(scheme, F.lit("://"), host, path, query)

    ref = F.regexp_replace(href, r"^[\x00-\x20]+|[\x00-\x20]+$", "")
    whole = F.regexp_replace(ref, r"#.*$", "")
    return F.when(ref.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), whole).otherwise(absolute(ref, page_url))


#: Schemes that a link extractor follows.
SCHEMES = ("http", "https", "file", "ftp")


def harvest_links(
    pages: DataFrame,
    allow: Sequence[str] = (),
    deny: Sequence[str] = (),
    url_col: str = "url",
    html_col: str = "html",
    anchor: tuple[str, str] | None = None,
    domains: Sequence[str] = (),
) -> DataFrame:
    """Every distinct absolute link of a page kept by an allow pattern and no deny pattern.

    ``anchor`` = (attribute, value) restricts the anchors, ``domains`` the hosts
    (a domain admits its sub-domains).  One row per (page, link).  ``explode``
    keeps the work per page; distinct is per page (``array_distinct``), so there
    is no shuffle.
    """
    tag = H.open_tag("a", *anchor) if anchor else H.open_tag("a")
    tags = F.regexp_extract_all(F.col(html_col), F.lit(rf"({tag})"), 1)
    hrefs = F.filter(F.transform(tags, lambda x: H.attribute_value(x, "href")), lambda x: x.isNotNull())
    links = F.array_distinct(F.transform(hrefs, lambda x: resolve_url(x, F.col(url_col))))
    out = pages.select("page_id", F.explode(links).alias("link"))
    out = out.filter(F.col("link").rlike(rf"^(?i:{'|'.join(SCHEMES)})://"))
    if domains:
        hosts = "|".join(re.escape(d) for d in domains)
        out = out.filter(F.col("link").rlike(rf"^[^/]+://(?:[^/?#@]*@)?(?:[^/?#@]*\.)?(?i:{hosts})(?::\d+)?(?:[/?]|$)"))
    if allow:
        out = out.filter(F.col("link").rlike("|".join(f"(?:{a})" for a in allow)))
    for d in deny:
        out = out.filter(~F.col("link").rlike(d))
    return out


#: Pages of one range of seeds.
SEED_RANGE = 100_000


def crawl_seeds(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """Listing seeds, base URL x page numbers 1..n, n the highest page seen for that base.

    One group per base URL with a partial aggregate (max).  A base's pages are
    first cut into ranges of SEED_RANGE, which are dealt over tasks, and then
    listed, so no task lists more than its share whatever number a URL carries.
    """
    base = F.regexp_extract(F.col(url_col), r"^([^?#]*)", 1)
    page = F.regexp_extract(F.col(url_col), r"[?&]page=(\d+)", 1)
    n = F.coalesce(F.when(page != "", page.try_cast("int")), F.lit(1))
    per_base = pages.select(base.alias("base"), n.alias("n")).groupBy("base").agg(F.max("n").alias("n"))
    last = F.greatest(F.col("n"), F.lit(1))
    first_pages = F.sequence(F.lit(1), last, F.lit(SEED_RANGE))
    ranges = per_base.select("base", last.alias("last"), F.explode(first_pages).alias("first"))
    ranges = ranges.repartition("base", "first")
    end = F.least(F.col("first").cast("long") + (SEED_RANGE - 1), F.col("last").cast("long")).cast("int")
    listed = ranges.select("base", F.explode(F.sequence("first", end)).alias("page"))
    return listed.select("base", "page", F.concat("base", F.lit("?page="), F.col("page").cast("string")).alias("seed_url"))


# ------------------------------------------------------------- OLX extractors

def olx_detail_items(h: str = "html") -> Column:
    """Text nodes of ``//ul[@class='css-sfcl1s']/li/p//text()``."""
    ul = H.element_inner(F.col(h), "ul", "class", "css-sfcl1s")
    paras = F.regexp_extract_all(F.coalesce(ul, F.lit("")), F.lit(rf"(?s){H.open_tag('li')}\s*{H.open_tag('p')}(.*?)</(?i:p)\s*>"), 1)
    runs = F.flatten(F.transform(paras, H.text_runs))
    return F.transform(runs, lambda x: H.unescape(x))


def _first(items: Column, pred) -> Column:
    return F.get(F.filter(items, pred), 0)


def _strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def olx_details(items: Column) -> dict[str, Column]:
    """Offer type, price per m2, primary market, floor, building type, size, rooms.

    First matching item; pieces are taken by splitting on ':' or on single
    spaces as the site lays them out, decimal commas become dots.
    """
    offer_type = _first(items, lambda x: x.isin(*vocab.OLX_OFFER_TYPES))
    ppm = _first(items, lambda x: x.contains(vocab.OLX_PRICE_PER_MSQ_MARK))
    floor = _first(items, lambda x: x.contains(vocab.OLX_FLOOR_LABEL))
    btype = _first(items, lambda x: x.contains(vocab.OLX_BUILDING_TYPE_LABEL))
    size = _first(items, lambda x: x.contains(vocab.OLX_SIZE_LABEL))
    rooms = _first(items, lambda x: x.contains(vocab.OLX_ROOMS_LABEL))
    return {
        "offer_type": offer_type,
        "price_per_msq": F.replace(_strip(parse.split_part(ppm, " ", 3)), F.lit(","), F.lit(".")),
        "primary_market": F.exists(items, lambda x: x.contains(vocab.OLX_PRIMARY_MARKET_WORD)),
        "floor": _strip(parse.split_part(floor, ":", 1)),
        "building_type": _strip(parse.split_part(btype, ":", 1)),
        "size": F.replace(_strip(parse.split_part(size, " ", 1)), F.lit(","), F.lit(".")),
        "n_rooms": _strip(parse.split_part(rooms, " ", 2)),
    }


_OLX_STATE_PREFIX = "window.__PRERENDERED_STATE__= "


def olx_state_json(h: str = "html") -> Column:
    """The page state, a JSON document encoded as a JSON string on the fifth script line."""
    body = H.script_body(h, "olx-init-config")
    line = _strip(parse.split_part(body, "\n", 4))
    literal = F.replace(line, F.lit(_OLX_STATE_PREFIX), F.lit(""))
    literal = F.substring(literal, F.lit(1), F.length(literal) - 1)  # drop the trailing ';'
    # Decode the outer string literal by wrapping it as the value of a JSON object.
    return F.get_json_object(F.concat(F.lit('{"v":'), literal, F.lit("}")), "$.v")


def olx_state_fields(state: Column) -> dict[str, Column]:
    """Price text and the three location names ('' when the value is null), of a ``json_document``."""
    def path(p):
        return F.when(state["doc"].isNotNull(), F.coalesce(H.json_text(state, p), F.lit("")))

    return {
        "price_total": path("$.ad.ad.price.displayValue"),
        "district": path("$.ad.ad.location.districtName"),
        "city": path("$.ad.ad.location.cityName"),
        "region": path("$.ad.ad.location.regionNormalizedName"),
    }


def olx_offer_id(h: str = "html") -> Column:
    """Text of the last span with text in the footer bar."""
    bar = H.element_inner(F.col(h), "div", "data-cy", "ad-footer-bar-section")
    spans = F.regexp_extract_all(F.coalesce(bar, F.lit("")), F.lit(rf"(?s){H.open_tag('span')}([^<]+)"), 1)
    return H.unescape(F.try_element_at(spans, F.lit(-1)))


def olx_image_urls(h: str = "html") -> Column:
    """``//div[@class='swiper-zoom-container']/img/@src``."""
    pat = rf"{H.open_tag('div', 'class', 'swiper-zoom-container')}\s*({H.open_tag('img')})"
    tags = F.regexp_extract_all(F.col(h), F.lit(pat), 1)
    return F.filter(F.transform(tags, lambda x: H.attribute_value(x, "src")), lambda x: x.isNotNull())


def olx_bronze(pages: DataFrame, crawled_at: Column | None = None, h: str = "html") -> DataFrame:
    """X13 for OLX: one F1 bronze row per page."""
    crawled = crawled_at if crawled_at is not None else F.current_timestamp()
    # What several columns read is made once, in a projection below theirs.
    pages = pages.withColumns({"__items": olx_detail_items(h), "__state": H.json_document(olx_state_json(h))})
    d = olx_details(F.col("__items"))
    st = olx_state_fields(F.col("__state"))
    posted = H.direct_text(h, "span", "data-cy", "ad-posted-at")
    posted = F.replace(posted, F.lit("o "), F.lit(""))
    offer_date = F.when(posted.contains(vocab.TODAY_WORD), posted).otherwise(
        F.date_format(parse.polish_long_date(posted), "yyyy-MM-dd")
    )
    desc = H.element_inner(H.element_inner(H.visible(F.col(h)), "div", "data-cy", "ad_description"), "div")
    cols = {
        "offer_source": F.lit("olx"),
        "offer_id": olx_offer_id(h),
        "date_scraped": crawled.cast("timestamp"),
        "title": page_title(h),
        "canonical_url": canonical_url(h),
        "short_description": meta_description(h),
        "description": H.first_text(F.array(desc)),
        "price_total": st["price_total"],
        "offer_type": d["offer_type"],
        "offer_date": offer_date,
        "modified_date": offer_date,
        "location": F.when(st["city"].isNotNull(), parse.join_location(st["district"], st["city"], st["region"])),
        "city": st["city"],
        "district": st["district"],
        "region": st["region"],
        "price_per_msq": d["price_per_msq"],
        "primary_market": d["primary_market"],
        "floor": d["floor"],
        "building_type": d["building_type"],
        "size": d["size"],
        "n_rooms": d["n_rooms"],
        "image_urls": olx_image_urls(h),
    }
    return ensure_schema(pages.select("page_id", *[e.alias(n) for n, e in cols.items()]), OLX_PAGE_ROW)


# ---------------------------------------------------------- otodom extractors

_NEXT = "$.props.pageProps.ad"


def next_data(h: str = "html") -> Column:
    """The otodom page JSON (``<script id="__NEXT_DATA__">``)."""
    return H.script_body(h, "__NEXT_DATA__")


def otodom_cells(h: str = "html") -> Column:
    """The page's detail cells as a struct of their names and their texts (NULL where empty), in page order: what X7 reads.

    One pattern over the page gives each cell from its name on.  A tag's name is the value of its first
    ``data-testid``, so no such attribute may come before the one that matches.
    """
    testids = list(vocab.OTODOM_DETAIL_CELLS.values())
    same = os.path.commonprefix(testids)
    names = rf"{re.escape(same)}(?:{'|'.join(re.escape(t.removeprefix(same)) for t in testids)})"
    attr = rf"{H.any_case('data-testid')}\s*=\s*"
    wanted = H.first_in_tag(rf"""{attr}(?="{names}"|'{names}').""", rf"""{attr}(?:"[^">]*"|'[^'>]*')""")
    pat = rf"""(?s)<{H.any_case('div')}(?=[\s>/]){wanted}([^>]*>[^<]*)"""

    def parts(cells: Column) -> Column:
        name = F.transform(cells, lambda x: F.substring_index(F.substring_index(x, '"', 1), "'", 1))
        text = F.transform(cells, lambda x: F.substring(x, F.locate(">", x) + 1, F.length(x)))
        text = F.transform(text, lambda x: F.when(x != "", H.decoded(x)))
        return F.struct(name.alias("names"), text.alias("texts"))

    # A plain struct would be made again for each cell.
    return H.once(F.regexp_extract_all(F.col(h), F.lit(pat), 1), parts)


def otodom_details(cells: Column) -> dict[str, Column]:
    """The text of the first cell of each ``data-testid``; missing and empty cells give NULL."""

    def first(testid: str) -> Column:
        return F.get(cells["texts"], (F.array_position(cells["names"], testid) - 1).cast("int"))

    return {name: first(testid) for name, testid in vocab.OTODOM_DETAIL_CELLS.items()}


def otodom_prices(h: str = "html") -> dict[str, Column]:
    """Price, price per square metre and address, by their aria labels."""
    return {
        "price_total": H.direct_text(h, "strong", "aria-label", vocab.OTODOM_PRICE_LABEL),
        "price_per_msq": H.direct_text(h, "div", "aria-label", vocab.OTODOM_PRICE_PER_MSQ_LABEL),
        "location": H.direct_text(h, "a", "aria-label", vocab.OTODOM_ADDRESS_LABEL),
    }


def otodom_ids(doc: Column) -> dict[str, Column]:
    """Prefixed id, city, district, region of a ``json_document``; district and region default to ''."""
    def path(p):
        return H.json_text(doc, f"{_NEXT}{p}")

    present = doc["doc"].isNotNull()
    return {
        "offer_id": F.when(present, F.concat(F.lit("otodom_"), F.coalesce(path(".id"), F.lit("")))),
        "city": F.when(present, F.coalesce(path(".target.City"), F.lit(""))),
        "district": F.when(present, F.coalesce(path(".location.address.district.name"), F.lit(""))),
        "region": F.when(present, F.coalesce(path(".target.Province"), F.lit(""))),
    }


def otodom_image_urls(doc: Column, size: str = "medium") -> Column:
    """The image URL of one size for every image of the ad."""
    images = F.from_json(H.json_text(doc, f"{_NEXT}.images"), "array<map<string,string>>")
    return F.transform(images, lambda m: F.try_element_at(m, F.lit(size)))


def otodom_dates(doc: Column) -> dict[str, Column]:
    """X11: creation and modification instants -> 'YYYY-MM-DD' of their own zone (T4)."""
    def day(p):
        return F.date_format(parse.iso_local_date(H.json_text(doc, f"{_NEXT}{p}")), "yyyy-MM-dd")

    return {"offer_date": day(".createdAt"), "modified_date": day(".modifiedAt")}


def otodom_bronze(pages: DataFrame, crawled_at: Column | None = None, h: str = "html", img_size: str = "medium") -> DataFrame:
    """X13 for otodom: one F2 bronze row per page."""
    crawled = crawled_at if crawled_at is not None else F.current_timestamp()
    pages = pages.withColumns({"__doc": H.json_document(next_data(h)), "__cells": otodom_cells(h)})
    doc = F.col("__doc")
    ids = otodom_ids(doc)
    paras = H.all_inner(H.element_inner(H.visible(F.col(h)), "div", "data-cy", "adPageAdDescription"), "p")
    cols = {
        "offer_source": F.lit("otodom"),
        "offer_id": ids["offer_id"],
        "city": ids["city"],
        "district": ids["district"],
        "region": ids["region"],
        "date_scraped": crawled.cast("timestamp"),
        "title": page_title(h),
        "canonical_url": canonical_url(h),
        "short_description": meta_description(h),
        "description": H.first_text(paras),
        **otodom_prices(h),
        "image_urls": otodom_image_urls(doc, img_size),
        **otodom_dates(doc),
        **otodom_details(F.col("__cells")),
    }
    return ensure_schema(pages.select("page_id", *[e.alias(n) for n, e in cols.items()]), OTODOM_PAGE_ROW)
