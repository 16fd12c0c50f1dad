"""Unit tests of the column functions on literal rows (quirks of SURVEY §2)."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from offerlake.functions import parse, vocab


def one(spark, expr, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_legacy_int(spark):
    cases = {"2.0": 2, "2.9": 2, " 3 ": 3, "3/5": None, "-1": -1, "+7": 7, "99999999999": None, "": None,
             "abc": None, "1e3": None, None: None}
    for s, want in cases.items():
        assert one(spark, parse.legacy_int("x"), s) == want, s


def test_money_and_round(spark):
    assert one(spark, parse.money("x"), "450 000 zł") == 450000.0
    assert one(spark, parse.money("x"), "1 250,50 zł") is None
    assert one(spark, parse.money("x", lenient=True), "1 250,50 zł") == 1250.5
    assert one(spark, parse.money("x"), "Zamienię") is None
    assert abs(one(spark, parse.round2(parse.to_float("x")), "12345.678") - 12345.68) < 1e-3
    r = spark.createDataFrame([("12345.678",)], "x string").select(parse.round2(parse.to_float("x")).alias("r"))
    assert r.schema["r"].dataType.typeName() == "float"


def test_dates(spark):
    assert one(spark, parse.to_date_text("x"), "2024-12-31") == dt.date(2024, 12, 31)
    assert one(spark, parse.to_date_text("x", compat=True), "2024-12-31") == dt.date(2024, 1, 31)
    assert one(spark, parse.to_date_text("x"), "Dzisiaj 12:00") is None
    assert one(spark, parse.iso_local_date("x"), "2024-01-21T23:30:00+01:00") == dt.date(2024, 1, 21)
    assert one(spark, parse.iso_local_date("x"), "2024-01-21T23:30:00Z") == dt.date(2024, 1, 21)
    assert one(spark, parse.iso_local_date("x"), "2024-01-21T23:30:00.123Z") is None
    assert one(spark, parse.polish_long_date("x"), "12 stycznia 2024") == dt.date(2024, 1, 12)
    assert one(spark, parse.polish_long_date("x"), "3 Października 2023") == dt.date(2023, 10, 3)
    assert one(spark, parse.polish_long_date("x"), "31 lutego 2024") is None
    assert one(spark, parse.polish_long_date("x"), "Dzisiaj o 12:00") is None


def test_today_word(spark):
    df = spark.createDataFrame([("Dzisiaj 12:00", dt.datetime(2024, 1, 21, 10, 0))], "d string, ts timestamp")
    r = df.select(parse.offer_date("d", "ts").alias("a"), parse.offer_date("d", "ts", compat=True).alias("b")).first()
    assert r["a"] == dt.date(2024, 1, 21) and r["b"] is None


def test_scrape_date_and_timestamp(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 12, 31, 12, 34, 56),)], "ts timestamp")
    r = df.select(parse.scrape_date("ts").alias("a"), parse.scrape_date("ts", compat=True).alias("b"),
                  parse.to_timestamp_any("ts", df.schema["ts"].dataType).alias("c")).first()
    assert r["a"] == dt.date(2024, 12, 31) and r["b"] == dt.date(2024, 1, 31)
    assert r["c"] == dt.datetime(2024, 12, 31, 12, 34, 56)
    assert one(spark, parse.to_timestamp_any("x", StringType()), "2024-01-02 03:04:05") == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert one(spark, parse.to_timestamp_any("x", StringType()), "Dzisiaj 12:00") is None


def test_flags_and_strings(spark):
    assert one(spark, parse.qualified_id(F.lit("otodom"), "x"), "otodom_1") == "otodom_otodom_1"
    assert one(spark, parse.qualified_id(F.lit("olx"), "x"), None) is None
    assert one(spark, parse.offer_type("x", "prywatny"), None) is None
    assert one(spark, parse.offer_type("x", "prywatny"), "prywatny") == "private_owner"
    assert one(spark, parse.offer_type("x", "prywatny"), "biuro") == "company"
    assert one(spark, parse.primary_market("x"), None) is False
    assert one(spark, parse.primary_market("x"), "wtórny") is False
    assert one(spark, parse.primary_market("x"), "pierwotny") is True
    assert one(spark, parse.yes_flag("x"), None) is None
    assert one(spark, parse.yes_flag("x"), "nie") is False
    assert one(spark, parse.present_flag("x"), None) is False
    assert one(spark, parse.contains_flag("x", "balkon"), None) is None
    assert one(spark, parse.contains_flag("x", "balkon"), "balkon, taras") is True
    assert one(spark, parse.translate_values("x", vocab.OTODOM_VALUE_MAPS["building_material"]), "cegła") == "brick"
    assert one(spark, parse.translate_values("x", vocab.OTODOM_VALUE_MAPS["building_material"]), "keramzyt") == "keramzyt"
    assert one(spark, parse.translate_values("x", vocab.OTODOM_VALUE_MAPS["building_material"]), None) is None
    assert one(spark, parse.split_part("x", " ", 0), "2024-01-01 12:00:00") == "2024-01-01"
    assert one(spark, parse.split_part("x", " ", 5), "a b") is None
    assert one(spark, parse.stored_image_path("x"), "full/abc.jpg") == "abc.jpg"
    df = spark.createDataFrame([(None, "Warszawa", "maz")], "d string, c string, r string")
    assert df.select(parse.join_location("d", "c", "r")).first()[0] == ";Warszawa;maz"


def test_days_of_text_never_fail(spark):
    rows = [("garbage", None), ("2024-01-22 10:00:00", "2024-01-22"), ("2024-02-30", None), ("", None), (None, None)]
    df = spark.createDataFrame(rows, "d string, want string")
    for r in df.select("d", "want", parse.scrape_date("d").alias("x"), parse.offer_date(F.lit("Dzisiaj 12:00"), "d").alias("y")).collect():
        assert (r["x"] and str(r["x"])) == r["want"] == (r["y"] and str(r["y"])), r
