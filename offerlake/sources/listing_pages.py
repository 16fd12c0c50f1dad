"""Listing pages derived from the driver's tables (FIXTURES F8).

One SQL text per site, valid in Spark and in DuckDB: its columns are what
extraction must give, and ``html`` is a page that says so, with the anchors that
the extractors read and traps beside them: look-alike attribute names, values
in the wrong case, nested elements, empty cells, and a part of the pages
without the site's script and lists.  JSON is written with « and » for braces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from offerlake.functions import vocab
from offerlake.sources.fixtures import F5_SQL, table

_BRACES = "concat(chr(123), chr(125))"

_OLX_FACTS = """select o_orderkey as page_id, broken, cast(o_orderkey as string) as k,
 concat('https://www.olx.pl/d/oferta/', cast(o_orderkey as string)) as url,
 concat('Flat ', cast(o_orderkey as string), ' & garden') as title,
 concat('https://www.olx.pl/d/oferta/', cast(o_orderkey as string), '.html') as canonical_url,
 concat('bright "flat" ', cast(o_orderkey as string)) as short_description,
 case when not broken then cast(o_orderkey * 3 as string) end as offer_id,
 case when not broken then concat('line1 ', o_orderpriority) end as description,
 case when not broken then case when o_orderkey % 11 = 0 then ''
  else concat(cast(cast(floor(o_totalprice / 1000) as bigint) as string), ' 000 zł') end end as price_total,
 case when not broken then case when o_custkey % 3 = 0 then 'Warszawa' else 'Kraków' end end as city,
 case when not broken then case when o_custkey % 5 = 0 then '' else concat('District ', cast(o_custkey % 7 as string)) end end as district,
 case when not broken then case when o_custkey % 3 = 0 then 'mazowieckie' else 'malopolskie' end end as region,
 case when not broken and o_orderkey % 7 <> 0 then case when o_orderstatus = 'F' then 'Prywatne' else 'Firmowe' end end as offer_type,
 case when not broken then concat(cast(5000 + o_custkey as string), '.25') end as price_per_msq,
 not broken and o_orderkey % 2 = 0 as primary_market,
 case when not broken then case when o_orderkey % 6 = 0 then 'Parter' else cast(o_orderkey % 10 as string) end end as floor,
 case when not broken then case when o_orderkey % 4 = 0 then 'Blok' else 'Kamienica' end end as building_type,
 case when not broken then concat(cast(20 + o_custkey % 100 as string), '.5') end as size,
 case when not broken then cast(1 + o_custkey % 5 as string) end as n_rooms,
 case when o_orderkey % 13 = 0 then 'Dzisiaj o 12:00' else concat(cast(1 + o_orderkey % 28 as string), ' ',
  case o_orderkey % 3 when 0 then 'stycznia' when 1 then 'Lipca' else 'grudnia' end, ' ', cast(2020 + o_orderkey % 5 as string)) end as posted,
 case when o_orderkey % 13 = 0 then 'Dzisiaj 12:00' else concat(cast(2020 + o_orderkey % 5 as string), '-',
  case o_orderkey % 3 when 0 then '01' when 1 then '07' else '12' end, '-', lpad(cast(1 + o_orderkey % 28 as string), 2, '0')) end as offer_date,
 case when not broken and o_orderkey % 3 <> 0 then concat('https://img.example/', cast(o_orderkey as string), 'a.jpg') end as image_1,
 case when not broken and o_orderkey % 4 <> 0 then concat('https://img.example/', cast(o_orderkey as string), 'b.jpg') end as image_2
from (select *, o_orderkey % 17 = 0 as broken from {orders}) o"""

_OLX_STATE = f"""translate(concat('«"ad":«"ad":«"params":[],"price":«"displayValue":',
 case when price_total = '' then 'null' else concat('"', price_total, '"') end,
 '»,"location":«"districtName":', case when district = '' then 'null' else concat('"', district, '"') end,
 ',"cityName":"', city, '","regionNormalizedName":"', region, '"»»»»'), '«»', {_BRACES})"""

OLX_PAGES_SQL = f"""select *, concat('<!DOCTYPE html><html><head><TITLE lang="pl">Flat ', k, ' &amp; garden</TITLE>',
 '<link data-rel="canonical" href="/wrong"><link href="', canonical_url, '" rel="canonical">',
 '<meta data-name="description" content="wrong"><META content="bright &quot;flat&quot; ', k, '" NAME="description">',
 case when broken then '' else concat(
  '<script data-id="olx-init-config">wrong</script><script id="olx-init-config">', chr(10), 'a', chr(10), 'b', chr(10), 'c', chr(10),
  '   window.__PRERENDERED_STATE__= "', replace({_OLX_STATE}, '"', concat(chr(92), '"')), '";', chr(10), 'd</script>') end,
 '</head><body><span data-cy="AD-POSTED-AT">wrong</span><span data-cy="ad-posted-at">', posted, '</span>',
 case when broken then '' else concat('<ul class="css-sfcl1s">',
  case when offer_type is null then '' else concat('<li><p>', offer_type, '</p></li>') end,
  '<li><p><b>Cena za m²: ', replace(price_per_msq, '.', ','), ' zł/m²</b></p></li>',
  case when primary_market then '<li><p>Rynek: Pierwotny</p></li>' else '<li><p>Rynek: Wtórny</p></li>' end,
  '<li><p>Poziom: ', floor, '</p></li><li><P class="x">Rodzaj zabudowy: ', building_type, '</P></li>',
  '<li><p>Powierzchnia: ', replace(size, '.', ','), ' m²</p></li><li><p>Liczba pokoi: ', n_rooms, ' pokoje</p></li></ul>',
  '<div data-cy="ad_description"><div><div></div>', description, '<br>more</div></div>',
  case when image_1 is null then '' else concat('<div class="swiper-zoom-container"><img alt="x" src="', image_1, '"></div>') end,
  case when image_2 is null then '' else concat('<div class="swiper-zoom-container"> <img src="', image_2, '"></div>') end,
  '<div data-cy="ad-footer-bar-section"><div><div>x</div></div><span>ID: </span><span>', offer_id, '</span><span></span></div>',
  '<div><span>wrong</span></div>') end,
 '</body></html>') as html
from ({_OLX_FACTS}) facts"""

_OTODOM_FACTS = f"""select *, seq as page_id, cast(seq as string) as k, seq % 19 = 0 as broken,
 concat('https://www.otodom.pl/pl/oferta/', cast(seq as string)) as url,
 case when seq % 4 = 0 then '' else concat('District ', cast(seq % 9 as string)) end as district,
 case when city = 'Warszawa' then 'mazowieckie' else 'malopolskie' end as region,
 concat('Offer ', cast(seq as string), ' & more') as title,
 concat('2024-', case when seq % 2 = 0 then '01' else '11' end, '-2', cast(seq % 9 as string)) as created,
 concat('2024-12-0', cast(1 + seq % 9 as string)) as modified,
 concat('https://img.example/m', cast(seq as string), '.jpg') as image_1,
 concat('https://img.example/n', cast(seq as string), '.jpg') as image_2,
 concat(city, ', ulica ', cast(seq % 50 as string)) as address
from ({F5_SQL}) rows_of_f5"""

_CELLS = "".join(
    f"""'<div data-test="{testid}">wrong</div><div class="c" data-testid="{testid}">', {column}, '</div>', """
    for column, testid in vocab.OTODOM_DETAIL_CELLS.items()
)

_NEXT = f"""translate(concat('«"props":«"pageProps":«"ad":«"id":', k,
 ',"target":«"City":"', city, '","Province":"', region, '"»,"location":«"address":«"district":',
 case when district = '' then 'null' else concat('«"name":"', district, '"»') end, '»»,"createdAt":"', created,
 'T10:00:00+01:00","modifiedAt":"', modified, 'T23:59:59Z","images":[«"thumbnail":"t","medium":"', image_1, '"»,«"medium":"', image_2,
 '"»]»»»»'), '«»', {_BRACES})"""

OTODOM_PAGES_SQL = f"""select *, concat('<html><head><title>', replace(title, '&', '&amp;'),
 '</title><link rel="canonical" href="', url, '"><meta name="description" content="', title,
 '"><script data-id="__NEXT_DATA__">wrong</script>',
 case when broken then '' else concat('<SCRIPT id="__NEXT_DATA__" type="application/json">', {_NEXT}, '</SCRIPT>') end,
 '</head><body><strong aria-label="CENA">wrong</strong><strong aria-label="Cena">', price_total, '</strong>',
 '<div aria-label="Cena za metr kwadratowy">', price_per_msq, '</div><a aria-label="Adres" href="#">', address, '</a>',
 {_CELLS}
 '<div data-cy="adPageAdDescription"><div><div>not a paragraph</div></div><p></p><p><i>', short_description,
 '</i> and more</p></div></body></html>') as html
from ({_OTODOM_FACTS}) facts"""


def olx_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OLX-like listing pages (page_id, url, html), one per order."""
    return spark.sql(OLX_PAGES_SQL, orders=table(spark, sf_dir, "orders")).select("page_id", "url", "html")


def otodom_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Otodom-like listing pages (page_id, url, html), one per line item."""
    return spark.sql(OTODOM_PAGES_SQL, lineitem=table(spark, sf_dir, "lineitem")).select("page_id", "url", "html")
