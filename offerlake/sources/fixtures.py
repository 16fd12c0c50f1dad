"""Bronze-like inputs derived from the driver's tables (FIXTURES F4, F5).

One SQL text per fixture, valid in Spark and in DuckDB, used by both sides of
every oracle check.  ``{orders}`` / ``{lineitem}`` are the source tables: a
DataFrame argument of ``spark.sql`` on the Spark side, the view name in DuckDB.
The fixtures grow with the tables (one row per order / per line item).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlake.session import estimated_bytes, task_memory

F4_SQL = """select 'olx' as offer_source,
 case when o_orderkey % 97 = 0 then 'MISSING'
      else cast(o_orderkey - o_orderkey % 2 as string) end as offer_id,
 o_orderdate as date_scraped,
 case when o_orderkey % 11 = 0 then ''
      else concat('Flat ', cast(o_orderkey % 4000 as string)) end as short_description,
 concat('line1 ', o_orderpriority, chr(10), 'line2', chr(13)) as description,
 case when o_orderkey % 89 = 0 then 'brak informacji'
      when o_orderkey % 83 = 0 then 'Zamienię'
      else concat(cast(cast(floor(o_totalprice / 1000) as bigint) as string), ' ',
                  lpad(cast(cast(floor(o_totalprice) as bigint) % 1000 as string), 3, '0'), ' zł')
      end as price_total,
 case when o_orderkey % 7 = 0 then 'BRAK INFORMACJI'
      when o_orderstatus = 'F' then 'Prywatne' else 'Firmowe' end as offer_type,
 case when o_orderkey % 13 = 0 then 'Dzisiaj 12:00'
      else substr(cast(o_orderdate as string), 1, 10) end as offer_date,
 case o_custkey % 3 when 0 then 'Warszawa' when 1 then 'Kraków' else 'Wrocław' end as city,
 case when o_orderkey % 17 = 0 then 'None'
      else concat(cast(5000 + o_custkey as string), '.5') end as price_per_msq,
 case o_orderkey % 6 when 0 then 'Parter' when 1 then 'Suterena' when 2 then 'Powyżej 10'
      when 3 then '3/5' when 4 then 'missing' else cast(o_orderkey % 10 as string) end as floor,
 case o_orderkey % 4 when 0 then 'Blok' when 1 then 'Kamienica' when 2 then 'Pozostałe'
      else 'Wieżowiec' end as building_type,
 concat(cast(20 + o_custkey % 100 as string),
        case when o_orderkey % 19 = 0 then ' m²' else '' end) as size,
 concat(cast(1 + o_custkey % 5 as string), '.0') as n_rooms,
 o_orderkey as seq
from {orders}"""

F5_SQL = """select 'otodom' as offer_source,
 concat('otodom_', cast(l_orderkey as string), '_', cast(l_linenumber as string)) as offer_id,
 l_shipdate as date_scraped,
 concat('Offer ', cast(l_orderkey as string)) as short_description,
 concat('a', chr(10), 'b') as description,
 concat(cast(cast(floor(l_extendedprice / 1000) as bigint) as string), ' ',
        lpad(cast(cast(floor(l_extendedprice) as bigint) % 1000 as string), 3, '0'), ' zł') as price_total,
 case when l_partkey % 3 = 0 then '12 345 zł/m²' else cast(l_partkey as string) end as price_per_msq,
 case when l_partkey % 4 = 0 then '52,5 m²' else cast(20 + l_partkey % 90 as string) end as size,
 cast(1 + l_partkey % 6 as string) as n_rooms,
 case l_partkey % 3 when 0 then 'parter/4' when 1 then '3' else 'BRAK INFORMACJI' end as floor,
 substr(cast(l_shipdate as string), 1, 10) as offer_date,
 case l_suppkey % 3 when 0 then 'Warszawa' when 1 then 'Kraków' else 'Wrocław' end as city,
 case l_partkey % 3 when 0 then 'wtórny' when 1 then 'pierwotny' else '' end as market,
 case l_suppkey % 3 when 0 then 'prywatny' when 1 then 'biuro nieruchomości' else 'brak informacji' end as offer_type,
 case when l_partkey % 5 = 0 then 'brak informacji' else cast(1950 + l_partkey % 74 as string) end as year_built,
 case l_linenumber % 3 when 0 then 'tak' when 1 then 'nie' else 'MISSING' end as lift,
 case l_partkey % 4 when 0 then 'telewizja kablowa, internet' when 1 then 'internet, telefon'
      when 2 then 'telefon' else '' end as media_types,
 case when l_suppkey % 6 = 0 then 'None' when l_suppkey % 7 = 0 then 'wg licznika'
      else concat('1 ', lpad(cast(l_suppkey % 1000 as string), 3, '0'), ' zł') end as rent,
 case l_partkey % 5 when 0 then 'meble, zmywarka, lodówka' when 1 then 'piekarnik, kuchenka'
      when 2 then 'pralka' when 3 then 'meble, pralka, kuchenka' else 'missing' end as equipment,
 case l_suppkey % 4 when 0 then 'balkon, taras' when 1 then 'ogródek' when 2 then 'balkon' else '' end as outdoor,
 case when l_linenumber % 2 = 0 then 'garaż/miejsce parkingowe' else '' end as parking,
 case l_suppkey % 4 when 0 then 'teren zamknięty, ochrona' when 1 then 'monitoring / ochrona'
      when 2 then 'monitoring' else 'brak informacji' end as security,
 case l_partkey % 4 when 0 then 'drewniane' when 1 then 'plastikowe' when 2 then 'aluminiowe' else '' end as windows_type,
 case l_partkey % 8 when 0 then 'beton' when 1 then 'cegła' when 2 then 'silikat' when 3 then 'żelbet'
      when 4 then 'wielka płyta' when 5 then 'pustak' when 6 then 'inne' else 'keramzyt' end as building_material,
 case l_suppkey % 6 when 0 then 'elektryczne' when 1 then 'gazowe' when 2 then 'miejskie'
      when 3 then 'kotłownia' when 4 then 'inne' else 'piece kaflowe' end as heating_type,
 case l_partkey % 6 when 0 then 'użytkowanie wieczyste / dzierżawa'
      when 1 then 'spółdzielcze wł. prawo do lokalu' when 2 then 'pełna własność'
      when 3 then 'udział' when 4 then 'inne' else 'BRAK INFORMACJI' end as ownership_type,
 case l_linenumber % 4 when 0 then 'do remontu' when 1 then 'do wykończenia'
      when 2 then 'do zamieszkania' else 'inne' end as construction_status,
 case l_suppkey % 7 when 0 then 'blok' when 1 then 'szeregowiec' when 2 then 'apartamentowiec'
      when 3 then 'dom wolnostojący' when 4 then 'kamienica' when 5 then 'inne' else 'loft' end as building_type,
 l_orderkey * 10 + l_linenumber as seq
from {lineitem}"""

# Total order used wherever a survivor must be chosen on these fixtures.
FIXTURE_ORDER = ("date_scraped", "seq")


def table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df.select(*columns) if columns else df)


#: Rows of a scan that one task should hold: the dedup's map side sorts them at some 500 bytes each.
TASK_ROWS = 250_000
#: Memory for that sort, with room to spare (measured: 109 MB).
TASK_BYTES = 160 * 1024**2


def spread(df: DataFrame) -> DataFrame:
    """Give a scan at least the cluster's parallelism in tasks that have rows, and none of more rows than ``most_rows``.

    A row group is read by one task, which then runs every narrow step after
    it alone, and splits of a file beyond its row groups are empty.  So the rows
    of each task are counted (from the footers, no column is read).  A well-cut table is returned untouched.
    Tasks of more rows than their memory can sort as listings get smaller splits first, which costs no shuffle:
    the session keeps that split size until ``apply_query_conf`` sets it anew.  Where row groups are too
    large or too few for that, rows are spread round-robin to as many tasks as they need.
    """
    spark = df.sparkSession
    want = spark.sparkContext.defaultParallelism
    rows, most = task_rows(df), most_rows(spark)
    if well_cut(rows, want, most):
        return df
    if max(rows, default=0) > most:
        before = spark.conf.get(SPLIT)
        size = min(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes(), estimated_bytes(df) // want)
        spark.conf.set(SPLIT, str(max(1, size * TASK_ROWS // max(rows))))
        if well_cut(task_rows(df), want, most):
            return df
        spark.conf.set(SPLIT, before)
    return df.repartition(max(want, -(-sum(rows) // TASK_ROWS)))


SPLIT = "spark.sql.files.maxPartitionBytes"


def task_rows(df: DataFrame) -> list[int]:
    """Rows of each task that has any."""
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]  # one row per task


def most_rows(spark: SparkSession) -> int:
    """Rows that a task may hold: twice TASK_ROWS, or as many as its executor's memory can sort."""
    return max(2 * TASK_ROWS, TASK_ROWS * task_memory(spark) // TASK_BYTES)


def well_cut(rows: list[int], want: int, most: int) -> bool:
    return len(rows) >= want and max(rows) <= most


def duck(sql: str) -> str:
    """The fixture text for DuckDB, where the tables are views of the same name."""
    return sql.format(orders="orders", lineitem="lineitem")


def olx_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OLX-like bronze rows, one per order."""
    orders = table(spark, sf_dir, "orders")
    return spark.sql(F4_SQL, orders=orders)


def otodom_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    """otodom-like bronze rows, one per line item."""
    lineitem = table(spark, sf_dir, "lineitem")
    return spark.sql(F5_SQL, lineitem=lineitem)


BRONZE_BUILDERS = {"olx": olx_like, "otodom": otodom_like}
