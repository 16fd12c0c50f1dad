"""Standardisation, dedup and the source guard on literal rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from offerlake.operators.clean import drop_all_null, drop_null_columns, null_tokens, one_line, require, standardize
from offerlake.operators.dedup import deduplicate, exists, keep_first, single_source

T0 = dt.datetime(2024, 1, 1)


def rows(spark):
    data = [
        ("olx", "1", T0, "Flat\r\none", "a\nb", "100 zł", 1),
        ("olx", "MISSING", T0, "x", "x", "5 zł", 2),
        ("olx", "2", T0, "", "d", "None", 3),
        ("olx", "3", T0 + dt.timedelta(days=1), "brak informacji", "BRAK INFORMACJI", "7 zł", 4),
    ]
    return spark.createDataFrame(
        data, "offer_source string, offer_id string, date_scraped timestamp, short_description string, "
        "description string, price_total string, seq long")


def test_null_tokens_strings_only(spark):
    df = spark.createDataFrame([("", ["", "MISSING"], 1)], "s string, a array<string>, n int")
    r = null_tokens(df).first()
    assert r["s"] is None and r["a"] == ["", "MISSING"] and r["n"] == 1


def test_standardize(spark):
    out = standardize(rows(spark)).orderBy("seq").collect()
    assert [r["seq"] for r in out] == [1, 4]
    assert out[0]["short_description"] == "Flat  one" and out[0]["description"] == "a b"
    assert out[1]["short_description"] is None and out[1]["description"] is None


def test_standardize_idempotent(spark):
    once = standardize(rows(spark))
    assert sorted(map(tuple, standardize(once).collect())) == sorted(map(tuple, once.collect()))


def test_drop_all_null_and_require(spark):
    df = spark.createDataFrame([(None, None), ("a", None), (None, "b")], "x string, y string")
    assert drop_all_null(df).count() == 2
    assert require(df, ["x"]).count() == 1


def test_one_line(spark):
    df = spark.createDataFrame([("a\r\nb",)], "description string")
    assert one_line(df).first()[0] == "a  b"


def test_keep_first_order_and_nulls(spark):
    df = spark.createDataFrame(
        [("k", 2, "late"), ("k", 1, "early"), (None, 3, "n1"), (None, 4, "n2"), ("j", 5, "only")],
        "key string, seq int, v string")
    got = {r["key"]: r["v"] for r in keep_first(df, "key", ["seq"]).collect()}
    assert got == {"k": "early", None: "n1", "j": "only"}
    kept = keep_first(df, "key", ["seq"], keep_null_keys=True)
    assert kept.filter(F.col("key").isNull()).count() == 2


def test_keep_first_ties_are_deterministic(spark):
    df = spark.createDataFrame([("k", 1, "b"), ("k", 1, "a")], "key string, seq int, v string")
    assert keep_first(df.repartition(2), "key", ["seq"]).first()["v"] == "a"


def test_hot_key_partial_aggregation(spark):
    # one key holds a third of all rows; the plan must aggregate map-side before the shuffle
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("key"),
        F.col("id").alias("seq"))
    out = keep_first(df, "key", ["seq"])
    assert out.count() == 20001
    assert out.filter("key = 'hot'").first()["seq"] == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan or "Partial" in plan


def test_deduplicate_idempotent(spark):
    std = standardize(rows(spark))
    once = deduplicate(std, order_by=["date_scraped", "seq"])
    twice = deduplicate(once, order_by=["date_scraped", "seq"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_single_source_guard(spark):
    df = rows(spark)
    assert single_source(df) == "olx"
    with pytest.raises(ValueError):
        single_source(df.union(df.withColumn("offer_source", F.lit("otodom"))))
    with pytest.raises(ValueError):
        single_source(df.withColumn("offer_source", F.lit("gumtree")))
    with pytest.raises(ValueError):
        single_source(df.limit(0))
    assert exists(df, F.col("offer_source").contains("olx"))
    assert not exists(df, F.col("offer_source").contains("otodom"))


def test_drop_null_columns(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "a int, b string")
    assert drop_null_columns(df).columns == ["a"]


def test_source_guard_ignores_nulls_and_placeholders(spark):
    from offerlake.operators.dedup import single_source

    def guard(*sources):
        return single_source(spark.createDataFrame([(x,) for x in sources], "offer_source string"))

    assert guard("olx", None, "MISSING", "brak informacji") == "olx"
    for bad in ((None,), ("MISSING", None), ("olx", "otodom"), ("other", None)):
        with pytest.raises(ValueError):
            guard(*bad)


def _plain_deduplicate(df, order_by, keys=("offer_id", "short_description")):
    from offerlake.operators.dedup import keep_first

    for k in keys:
        df = keep_first(df, k, order_by)
    return df


@pytest.mark.parametrize("seed", range(3))
def test_packed_strings_leave_the_survivors_as_they_are(spark, seed):
    """Ties are broken by every column in turn: NULLs, empty strings, prefixes and the packing's own marks included."""
    import random

    from offerlake.operators.dedup import deduplicate

    r = random.Random(seed)
    texts = [None, "", "a", "ab", "a\x00", "a\x01", "\x00", "\x01", "\x01\x02", "\x00\x01\x01", "\x02", "b", "ż\x01", "\\", "'"]
    names = ["s", "offer_id", "x", "short_description", "y", "n", "z", "w"]
    rows = [
        (r.choice("pq"), r.choice("ijkl"), r.choice(texts), r.choice([None, "d", "e", "f"]), r.choice(texts), r.choice([None, 1, 2]), r.choice(texts), r.choice(texts), r.choice("12"))
        for _ in range(300)
    ]
    df = spark.createDataFrame(rows, "s string, offer_id string, x string, short_description string, y string, n int, z string, w string, day string")
    for order in (["day"], ["n", "day"], ["w"]):
        got = deduplicate(df, order_by=order)
        want = _plain_deduplicate(df, order)
        assert got.columns == df.columns and got.schema == want.schema
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    # All rows in one group: the least row by every text in turn.
    whole = df.select(F.lit("i").alias("offer_id"), F.lit("d").alias("short_description"), "x", "y", "z", "w")
    assert deduplicate(whole, order_by=[]).collect() == _plain_deduplicate(whole, []).collect()


def test_deduplicate_shuffles_packed_strings(spark):
    from offerlake.operators.dedup import deduplicate

    wide = spark.range(20).selectExpr("cast(id as string) offer_id", "'d' short_description", "1 as date_scraped", *[f"cast(id as string) c{i}" for i in range(20)])
    plan = deduplicate(wide)._jdf.queryExecution().optimizedPlan().toString()
    aggregates = [line for line in plan.splitlines() if "Aggregate" in line]
    assert len(aggregates) == 2 and not any("c19" in line for line in aggregates)
