"""Imputation, encoding, folds, scoring and model round trip."""

import pytest
from pyspark.sql import functions as F

from offerlake.operators import ml


@pytest.fixture(scope="module")
def ten(spark):
    rows = [
        (100.0 * i, "warszawa" if i % 2 else "kraków", float(30 + i) if i != 3 else None, None,
         2 if i < 4 else 3 if i < 8 else None, i % 2 == 0 if i != 5 else None, "blok" if i < 9 else None,
         "gazowe" if i < 5 else None)
        for i in range(10)
    ]
    return spark.createDataFrame(rows, "price_total double, city string, size float, rent float, n_rooms int, "
                                       "has_lift boolean, building_type string, heating_type string")


def test_mode_tie_goes_to_smallest(spark, ten):
    modes = {r["column"]: (r["value"], r["n"]) for r in ml.mode_table(ten, ["n_rooms", "has_lift"]).collect()}
    assert modes["n_rooms"] == ("2", 4)  # 4 twos and 4 threes: the smaller wins
    assert modes["has_lift"] == ("true", 5)


def test_imputer_and_all_null_column(spark, ten):
    df, cats = ml.features_frame(ten)
    assert "rent" not in df.columns  # all NULL: dropped
    imp = ml.fit_imputer(df)
    out = imp.transform(df)
    assert out.filter(F.col("size").isNull()).count() == 0
    assert out.filter(F.col("building_type") == "blok").count() == 10  # mode
    assert out.filter(F.col("heating_type") == "MISSING").count() == 5  # constant
    assert out.filter(F.col("n_rooms").isNull()).count() == 0
    assert set(cats) == {"city", "has_lift", "building_type", "heating_type"}


def codes(enc, df):
    return {r["city"]: r["city_idx"] for r in enc.transform(df).select("city", "city_idx").distinct().collect()}


@pytest.mark.parametrize("listed,broadcast", [(64, 20_000), (0, 20_000), (0, 0)])
def test_encoder_codes_and_rejects_unseen(spark, ten, monkeypatch, listed, broadcast):
    monkeypatch.setattr(ml, "LISTED_CATEGORIES", listed)
    monkeypatch.setattr(ml, "BROADCAST_CATEGORIES", broadcast)
    enc = ml.fit_encoder(ten, ["city"], {"city": "MISSING"})
    assert codes(enc, ten) == {"kraków": 1.0, "warszawa": 2.0}
    assert codes(enc, spark.createDataFrame([(None,)], "city string")) == {None: None}
    unseen = spark.createDataFrame([("gdańsk",)], "city string")
    with pytest.raises(Exception, match="unseen category"):
        enc.transform(unseen).collect()


def priced(spark, n=400, cities=45):
    """Prices by city, more cities than a tree's bins, one city with a single row, some NULLs."""
    rows = [
        (100.0 + 10 * (i % cities) + i % 3, f"city{i % cities:02}" if i else "solo", float(20 + i % 50) if i % 9 else None,
         i % 2 == 0 if i % 7 else None, "gazowe" if i % 4 else None)
        for i in range(n)
    ]
    return spark.createDataFrame(rows, "price_total double, city string, size float, has_lift boolean, heating_type string")


def test_training_takes_any_number_of_categories_and_rare_ones(spark, tmp_root):
    df = priced(spark)
    fit = ml.train_price_model(df, grid={"stepSize": (0.2,), "maxDepth": (4,), "maxIter": (5, 8)}, n_iter=2)
    spread = df.agg(F.stddev("price_total")).first()[0]
    assert fit.best_rmse < spread and len(fit.candidates) == 2
    got = ml.predict(fit.model, df)
    assert got.filter(F.col("prediction").isNull() | F.isnan("prediction")).count() == 0
    assert ml.rmse(got).first()[0] < spread


def test_fold_imputers_equal_a_fit_on_each_folds_training_rows(spark):
    """From sums and counts of all folds, as the imputer of the other folds' rows would have it."""
    folded = ml.assign_folds(priced(spark, 200, 5), 3).withColumn("n_rooms", F.expr("cast(price_total as int) % 4"))
    folded = folded.withColumn("year_built", F.expr("if(fold = 1, null, cast(price_total as int) % 7)"))
    folded = folded.withColumn("has_tv", F.expr("if(fold = 2, n_rooms > 1, null)")).withColumn("building_type", F.expr("nullif('x', 'x')"))
    for f, imputer in enumerate(ml.fold_imputers(folded, 3)):
        want = ml.fit_imputer(folded.filter(F.col("fold") != f).drop("fold")).fills
        got = imputer.fills
        assert got["size"] == pytest.approx(want["size"], rel=1e-12)
        assert {c: v for c, v in got.items() if c != "size"} == {c: v for c, v in want.items() if c != "size"}
        assert "has_tv" not in got or f != 2


def test_folds_balanced_by_price(spark):
    df = spark.range(300).select((F.col("id") * 7 % 300).cast("double").alias("price_total"), F.col("id"))
    f = ml.assign_folds(df, 3)
    sizes = sorted(r["count"] for r in f.groupBy("fold").count().collect())
    assert sizes == [100, 100, 100]
    # every three consecutive prices land in three different folds
    by_price = [r["fold"] for r in f.orderBy("price_total").collect()]
    assert all(len(set(by_price[i:i + 3])) == 3 for i in range(0, 300, 3))


def test_sample_params():
    a = ml.sample_params(ml.DEFAULT_GRID, 10, 2137)
    assert len(a) == 10 and a == ml.sample_params(ml.DEFAULT_GRID, 10, 2137)
    assert len({tuple(sorted(p.items())) for p in a}) == 10


def test_train_save_load_predict(spark, ten, tmp_root):
    big = ten.union(ten).union(ten)
    fit = ml.train_price_model(big, grid={"stepSize": (0.1,), "maxDepth": (2,), "maxIter": (3, 5)}, n_iter=2)
    assert fit.best_rmse >= 0 and len(fit.candidates) == 2
    path = f"{tmp_root}/model"
    ml.save_model(fit.model, path)
    loaded = ml.load_model(path)
    a = [r["prediction"] for r in fit.model.transform(big).orderBy("price_total").collect()]
    b = [r["prediction"] for r in ml.predict(loaded, big).orderBy("price_total").collect()]
    assert a == b
    assert {r["prediction"] for r in ml.predict(None, ten).collect()} == {-2137.0}
