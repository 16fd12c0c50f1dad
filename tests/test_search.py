"""Staged search: prefixes of an ensemble, the ledger, and going on after a failure."""

import json

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F
from paths import SF_SMALL
from test_ml import priced

from offerlake.operators import ml, search

GRID = {"stepSize": (0.1, 0.3), "maxDepth": (2,), "maxIter": (2, 4, 6)}


@pytest.fixture(scope="module")
def vectors(spark):
    p = ml.prepare(priced(spark, 120, 7))
    return p, p.vectors(p.df, p.imputer(p.df)).coalesce(1).cache()


def test_staged_draws_share_fits():
    draws = ml.sample_params(ml.DEFAULT_GRID, 10)
    fits = search.staged(draws)
    assert sum(len(v) for v in fits.values()) == 10 and len(fits) == 8
    assert all(v == sorted(v) for v in fits.values())
    assert {json.dumps({"maxDepth": 5, "stepSize": 0.05}): [800, 900]}.items() <= fits.items()


def test_a_prefix_of_a_fit_is_the_shorter_fit(spark, vectors):
    p, rows = vectors
    params = {"stepSize": 0.2, "maxDepth": 3}
    counts = [1, 10, 90]
    whole = p.trees({**params, "maxIter": 90}, 7).fit(rows)
    errors = search.stage_errors(whole, rows, ml.TARGET, counts)
    assert [(c, n) for c, _, n in errors] == [(c, 120) for c in counts]
    measure = RegressionEvaluator(labelCol=ml.TARGET, metricName="mse")
    for c, sse, n in errors:
        short = p.trees({**params, "maxIter": c}, 7).fit(rows)
        splits = [[t.toDebugString.split("\n", 1)[1] for t in trees] for trees in (short.trees, whole.trees[:c])]
        assert splits[0] == splits[1]  # the first line is a name
        assert sse / n == pytest.approx(measure.evaluate(short.transform(rows)), rel=1e-9)
    # One pass: a single scan of the stored rows, however many stages.
    parts = search.segments(whole, counts)
    out = rows
    for s in parts:
        out = s.transform(out)
    total = out.select((F.col("_s0") + F.col("_s1") + F.col("_s2")).alias("t")).collect()
    assert [r["t"] for r in total] == pytest.approx([r["prediction"] for r in whole.transform(rows).select("prediction").collect()])


def test_a_search_that_was_cut_off_goes_on(spark, tmp_root, monkeypatch):
    df = priced(spark, 90, 5)
    plain = ml.train_price_model(df, grid=GRID, n_iter=6, parallelism=1)
    made, real = [], search.stage_errors

    def counted(model, *rest):
        if len(made) == 3:
            raise RuntimeError("the driver is lost")
        made.append(model.uid)
        return real(model, *rest)

    ledger = f"{tmp_root}/ledger"
    monkeypatch.setattr(search, "stage_errors", counted)
    with pytest.raises(RuntimeError):
        ml.train_price_model(df, grid=GRID, n_iter=6, parallelism=1, ledger=ledger)
    assert spark.read.option("recursiveFileLookup", "true").parquet(ledger).select("fit", "fold").distinct().count() == 3
    made.clear()
    monkeypatch.setattr(search, "stage_errors", lambda *a: made.append(a) or real(*a))
    again = ml.train_price_model(df, grid=GRID, n_iter=6, parallelism=2, ledger=ledger)
    assert len(made) == 3  # of two fits in three folds
    assert again.best_params == plain.best_params
    assert [e for _, e in again.candidates] == pytest.approx([e for _, e in plain.candidates], rel=1e-9)
    # A finished search makes no fit; other rows or another seed do not use the ledger's figures.
    made.clear()
    ml.train_price_model(df, grid=GRID, n_iter=6, ledger=ledger)
    assert not made
    ml.train_price_model(df.limit(80), grid={**GRID, "stepSize": (0.1,)}, n_iter=1, ledger=ledger)
    assert len(made) == 3


def test_fold_statistics_take_two_passes(spark, monkeypatch):
    folded = ml.assign_folds(priced(spark, 60, 4), 3)
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("fills-3", "")
    search.fold_fills(folded, 3, ["size"], ["heating_type", "has_lift"])
    three = len(jobs.getJobIdsForGroup("fills-3"))
    spark.sparkContext.setJobGroup("fills-9", "")
    search.fold_fills(folded.withColumn("fold", F.expr("fold * 3")), 9, ["size"], ["heating_type", "has_lift"])
    assert len(jobs.getJobIdsForGroup("fills-9")) == three
    spark.sparkContext.setJobGroup("", "")


def test_candidates_equal_a_fit_for_each_draw_and_fold(spark):
    """The search against plain fits: every draw with its own number of trees, imputed by its fold's training rows."""
    df = priced(spark, 90, 5)
    found = ml.train_price_model(df, grid={**GRID, "stepSize": (0.3,)}, n_iter=3)
    p = ml.prepare(df)
    folded = ml.assign_folds(p.df, 3)
    for params, rmse in found.candidates:
        errors = []
        for f in range(3):
            train, test = folded.filter(F.col("fold") != f).drop("fold"), folded.filter(F.col("fold") == f).drop("fold")
            fills = p.imputer(train)
            model = p.trees(params, 2137).fit(p.vectors(train, fills))
            errors.append(ml.rmse(model.transform(p.vectors(test, fills)), label=ml.TARGET).first()[0])
        assert rmse == pytest.approx(sum(errors) / 3, rel=1e-6)
    assert found.best_rmse == min(e for _, e in found.candidates)


def test_whole_run_with_its_model_step_scores_every_gold_row(spark):
    from offerlake import catalog

    scored = catalog.j4_train(spark, SF_SMALL).select("price_total", "prediction").toPandas()
    assert len(scored) == catalog.gold(spark, SF_SMALL).count() and scored.notna().all().all()
    error = ((scored.price_total - scored.prediction) ** 2).mean() ** 0.5
    assert error < scored.price_total.std()


def test_queries_search_the_whole_grid(spark, monkeypatch):
    from offerlake import catalog
    from offerlake.plans import pipeline

    asked = []
    monkeypatch.setattr(catalog, "gold", lambda *a, **k: priced(spark, 30, 3))
    monkeypatch.setattr(ml, "train_price_model", lambda rows, **kw: asked.append(kw) or ml.FitResult(None, {}, 0.0, [({"stepSize": 0.1, "maxDepth": 2, "maxIter": 100}, 1.0)]))
    assert catalog.m7_staged_search(spark, SF_SMALL).count() == 1
    monkeypatch.setattr(ml, "save_model", lambda model, path: None)
    monkeypatch.setattr(ml, "load_model", lambda path: None)
    monkeypatch.setattr(pipeline, "write_silver", lambda *a, **k: None)
    for name in ("read_bronze", "bronze_to_silver", "sorted_for_write", "price_analytics", "ml_dataset"):
        monkeypatch.setattr(pipeline, name, lambda *a, **k: priced(spark, 30, 3))
    monkeypatch.setattr(pipeline, "single_source", lambda df: "olx")
    monkeypatch.setattr(pipeline.lake, "overwrite_table", lambda *a, **k: None)
    monkeypatch.setattr(pipeline.lake, "read_table", lambda *a, **k: priced(spark, 30, 3))
    monkeypatch.setattr(catalog, "read_table", lambda *a, **k: priced(spark, 30, 3))
    monkeypatch.setattr(catalog, "_whole_run", lambda spark, sf_dir, **kw: pipeline.run_pipeline(spark, "nowhere", sites_in_order=("olx",), **kw))
    catalog.j4_train(spark, SF_SMALL)
    assert len(asked) == 2
    for kw in asked:  # nothing that makes the search smaller: the defaults are the source's grid, ten draws and three folds
        assert not {"grid", "n_iter", "folds"} & kw.keys()


def test_a_search_stores_columns_and_no_vectors(spark):
    df = priced(spark, 90, 5)
    p = ml.prepare(df)
    imputer = p.imputer(p.df)
    kept = p.stored(p.df, imputer)
    assert len(kept.inputFiles()) > 0 and "features" not in kept.columns
    assert {f.dataType.typeName() for f in kept.schema.fields} <= {"double", "float", "integer", "long", "boolean", "short"}
    key = lambda d: sorted((r[0], tuple(r[1].toArray())) for r in d.collect())
    assert key(p.assembled(kept)) == key(p.vectors(p.df, imputer))
