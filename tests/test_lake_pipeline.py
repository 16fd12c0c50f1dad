"""Lake round trips, schema evolution, streaming ingest and the whole run."""

import json

import pytest
from pyspark.sql import functions as F

from paths import SF_SMALL
from offerlake.operators.schema import BRONZE_SCHEMAS, SILVER_SCHEMA, ensure_schema
from offerlake.plans.pipeline import bronze_to_silver, run_pipeline, write_silver
from offerlake.sources import bronze, fixtures, lake
from offerlake.streaming.ingest import batch_counts, ingest, land_batch, start_ingest


def test_round_trip_and_evolution(spark, tmp_root):
    p = lake.LakePaths(tmp_root)
    a = spark.createDataFrame([(1, "x")], "id long, a string")
    b = spark.createDataFrame([(2, "y")], "id long, b string")
    lake.overwrite_table(a, p.bronze("t"))
    lake.append_table(b, p.bronze("t"))
    back = lake.read_table(spark, p.bronze("t"), merge_schema=True)
    assert sorted(back.columns) == ["a", "b", "id"] and back.count() == 2
    u = lake.union_evolving([a, b])
    assert u.filter(F.col("b").isNull()).count() == 1


def test_ensure_schema_idempotent(spark):
    df = fixtures.olx_like(spark, SF_SMALL)
    once = ensure_schema(df, SILVER_SCHEMA)
    assert once.schema == SILVER_SCHEMA or [f.name for f in once.schema] == SILVER_SCHEMA.fieldNames()
    twice = ensure_schema(once, SILVER_SCHEMA)
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))


def test_silver_rerun_replaces_partition(spark, tmp_root):
    p = lake.LakePaths(tmp_root)
    silver = bronze_to_silver(fixtures.olx_like(spark, SF_SMALL), "olx", order_by=fixtures.FIXTURE_ORDER)
    n = silver.count()
    write_silver(silver, p)
    write_silver(silver, p)
    back = lake.read_table(spark, p.silver)
    assert back.count() == n
    assert back.filter(F.col("offer_id").isNull()).count() == 0


def test_stream_ingest_exactly_once(spark, tmp_root):
    p = lake.LakePaths(tmp_root)
    rows = ensure_schema(fixtures.olx_like(spark, SF_SMALL), BRONZE_SCHEMAS["olx"])
    n = rows.count()
    land_batch(rows, p, "olx")
    assert ingest(spark, tmp_root, sites=("olx",))["olx"] == n
    assert ingest(spark, tmp_root, sites=("olx",))["olx"] == 0
    land_batch(rows.limit(5), p, "olx")
    assert ingest(spark, tmp_root, sites=("olx",))["olx"] == 5
    assert lake.read_table(spark, p.bronze("olx")).count() == n + 5


def test_whole_run_twice_same_silver(spark, tmp_root):
    p = lake.LakePaths(tmp_root)
    for site, build in fixtures.BRONZE_BUILDERS.items():
        lake.overwrite_table(ensure_schema(build(spark, SF_SMALL), BRONZE_SCHEMAS[site]), p.bronze(site))
    run_pipeline(spark, tmp_root, train=False)
    first = sorted(map(str, lake.read_table(spark, p.silver).collect()))
    run_pipeline(spark, tmp_root, train=False)
    again = sorted(map(str, lake.read_table(spark, p.silver).collect()))
    assert first == again
    gold = lake.read_table(spark, p.gold_analytics)
    assert gold.filter(F.col("price_total").isNull() | F.col("price_per_msq").isNull()).count() == 0
    dates = [r["offer_date"] for r in gold.collect()]
    assert dates == sorted(dates, key=lambda d: (d is not None, d))


def test_shuffle_partitions_fit_the_input_and_are_restored(spark):
    from offerlake.session import shuffle_partitions, shuffle_partitions_for

    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    assert shuffle_partitions_for(df, bytes_per_partition=1 << 40) == 1
    many = shuffle_partitions_for(df, bytes_per_partition=1)  # no cap
    assert many > 100_000
    with pytest.raises(KeyError), shuffle_partitions(spark, 37):
        assert spark.conf.get(key) == "37"
        raise KeyError
    assert spark.conf.get(key) == before
    with shuffle_partitions(spark, None):
        assert spark.conf.get(key) == before


def test_ingest_counts_all_of_many_micro_batches(spark, tmp_root):
    from offerlake.operators.schema import BRONZE_SCHEMAS, ensure_schema

    rows = ensure_schema(spark.range(240).selectExpr("cast(id as string) as offer_id", "'olx' as offer_source"), BRONZE_SCHEMAS["olx"])
    land_batch(rows.coalesce(1), lake.LakePaths(tmp_root), "olx", batch_size=2)  # 120 files
    p = lake.LakePaths(tmp_root)
    assert ingest(spark, tmp_root, sites=("olx",), max_files_per_trigger=1) == {"olx": 240}
    assert ingest(spark, tmp_root, sites=("olx",)) == {"olx": 0}
    land_batch(rows.limit(3), p, "olx")
    assert ingest(spark, tmp_root, sites=("olx",)) == {"olx": 3}
    counts = batch_counts(spark, p, "olx")
    assert counts.count() >= 121 and counts.agg(F.sum("rows")).first()[0] == 243
    assert {tuple(r) for r in counts.filter("batch < 120").select("rows", "rescued").collect()} == {(2, 0)}


def test_a_count_lost_with_its_driver_is_made_up_for(spark, tmp_root, monkeypatch):
    p = lake.LakePaths(tmp_root)
    for n in (4, 5):
        land_batch(spark.range(n).selectExpr("cast(id as string) as offer_id"), p, "olx")
        q = start_ingest(spark, p, "olx")  # commits, but its counts are never written
        q.awaitTermination()
    land_batch(spark.range(6).selectExpr("cast(id as string) as offer_id"), p, "olx")
    assert ingest(spark, tmp_root, sites=("olx",)) == {"olx": 15}
    assert ingest(spark, tmp_root, sites=("olx",)) == {"olx": 0}
    assert batch_counts(spark, p, "olx").agg(F.sum("rows")).first()[0] == 15


def test_unknown_fields_are_rescued_and_promoted(spark, tmp_root):
    p = lake.LakePaths(tmp_root)
    lines = [
        '{"offer_id": "1", "offer_source": "olx", "price_total": "5", "rooms": 3, "tags": ["a", "b"], "note": null}',
        '{"offer_id": "2", "rooms": "4", "owner": {"name": "x"}}',
        "no json",
        "",
        '{"offer_id": "3"}',
    ]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(p.landing("olx"))
    assert ingest(spark, tmp_root, sites=("olx",)) == {"olx": 4}
    kept = {r["offer_id"]: r["_rescued"] for r in bronze.read_bronze(spark, p, "olx", rescued=True).collect()}
    assert json.loads(kept["1"]) == {"rooms": "3", "tags": '["a","b"]'} and kept["3"] is None
    assert json.loads(kept["2"]) == {"rooms": "4", "owner": '{"name":"x"}'} and kept[None] == "no json"
    found = {r["field"]: (r["n"], r["type"]) for r in bronze.rescued_fields(spark, p, "olx").collect()}
    assert found == {"rooms": (2, "bigint"), "tags": (1, "string"), "owner": (1, "string")}
    assert bronze.promote(spark, p, "olx", {"rooms": "bigint", "tags": "array<string>"}) == 1
    assert bronze.promote(spark, p, "olx", {"rooms": "bigint"}) == 1
    with pytest.raises(ValueError):
        bronze.promote(spark, p, "olx", {"rooms": "string"})
    more = ['{"offer_id": "4", "rooms": 5, "tags": ["c"]}', '{"offer_id": "5", "rooms": "many"}']
    spark.createDataFrame([(x,) for x in more], "value string").coalesce(1).write.mode("append").text(p.landing("olx"))
    ingest(spark, tmp_root, sites=("olx",))
    got = {r["offer_id"]: (r["rooms"], r["tags"], r["_rescued"]) for r in bronze.read_bronze(spark, p, "olx", rescued=True).collect()}
    assert got["1"] == (3, ["a", "b"], None) and got["2"][0] == 4 and json.loads(got["2"][2]) == {"owner": '{"name":"x"}'}
    assert got["4"] == (5, ["c"], None) and got["5"] == (None, None, '{"rooms":"many"}') and got[None] == (None, None, "no json")
    plan = bronze.read_bronze(spark, p, "olx")._jdf.queryExecution().toString()
    assert "rooms" in plan and "_rescued" not in bronze.read_bronze(spark, p, "olx").columns


def test_two_appends_are_two_copies_and_overwrite_is_one(spark, tmp_root):
    from offerlake.plans.pipeline import write_silver

    silver = spark.range(5).selectExpr("id as offer_id", "'olx' as offer_source")
    p = lake.LakePaths(tmp_root)
    for _ in range(2):
        write_silver(silver, p, append=True)
    assert spark.read.parquet(p.silver).count() == 10
    write_silver(silver, p)
    assert spark.read.parquet(p.silver).count() == 5


def test_bronze_columns_of_later_files_are_kept(spark, tmp_root):
    p = lake.LakePaths(tmp_root)
    spark.range(3).selectExpr("id as offer_id").write.parquet(p.bronze("olx"))
    spark.range(2).selectExpr("id as offer_id", "'x' as extra").write.mode("append").parquet(p.bronze("olx"))
    got = lake.read_table(spark, p.bronze("olx"), merge_schema=True)
    assert got.filter("extra = 'x'").count() == 2 and got.count() == 5


def test_landed_json_is_compressed_and_read_whole(spark, tmp_root):
    import glob
    import os

    from offerlake.operators.schema import BRONZE_SCHEMAS, ensure_schema

    p = lake.LakePaths(tmp_root)
    rows = spark.range(2000).selectExpr("concat('id ', id) as offer_id", "'otodom' as offer_source", "concat('zażółć \n', id) as description")
    items = ensure_schema(rows, BRONZE_SCHEMAS["otodom"])
    land_batch(items.coalesce(1), p, "otodom")
    plain = sum(len(r[0].encode()) + 1 for r in items.toJSON(use_unicode=True).map(lambda x: (x,)).collect())
    files = glob.glob(f"{p.landing('otodom')}/part-*")
    assert len(files) == 4 and sum(map(os.path.getsize, files)) * 4 < plain
    land_batch(items.limit(3), p, "otodom", fmt="parquet")  # formats of their own compression stay as they are
    assert len(glob.glob(f"{p.landing('otodom')}/part-*.parquet")) == 1
    os.remove(glob.glob(f"{p.landing('otodom')}/part-*.parquet")[0])
    assert ingest(spark, tmp_root, sites=("otodom",)) == {"otodom": 2000}
    got = bronze.read_bronze(spark, p, "otodom")
    assert sorted(map(str, got.collect())) == sorted(map(str, items.select(got.columns).collect()))


def test_small_landed_files_share_bronze_files(spark, tmp_root):
    """Landed files of a few rows fill a split together: a bronze file holds many of them."""
    paths = lake.LakePaths(tmp_root)
    land_batch(spark.range(400).selectExpr("cast(id as string) as offer_id").coalesce(1), paths, "olx", batch_size=5)  # 80 files
    assert ingest(spark, tmp_root, sites=("olx",)) == {"olx": 400}
    table = spark.read.parquet(paths.bronze("olx"))
    assert table.count() == 400 and len(table.inputFiles()) <= 2 * spark.sparkContext.defaultParallelism
