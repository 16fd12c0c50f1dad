"""Operator 13 against numpy's eigenvectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from offerlake.llm import whitening as W
from offerlake.llm.polar_eigen import eigen, polar_factor

VECS = "vec_id long, embedding array<float>"


def whole(rows):
    """Plain quantised vectors."""
    return np.floor(1024 * np.array(rows, np.float32).astype(float)).astype(np.int64) + 100_000


def plain(x, k):
    """Deviations, whitened values and shares."""
    n, s = len(x), x.sum(axis=0)
    dev = ((n * x - s) ** 2).sum(axis=1)
    v = np.cov(x.T.astype(float), bias=True).reshape(x.shape[1], -1)
    e, vec = np.linalg.eigh(v)
    e, vec = e[::-1][:k], vec[:, ::-1][:, :k]
    return dev, (x - s / n) @ vec / np.sqrt(e), e / np.trace(v)


@pytest.mark.parametrize("kind", ["random", "graded", "pairs", "low rank", "identity", "zero", "diagonal"])
@pytest.mark.parametrize("n", [1, 2, 7, 40])
def test_eigenvectors(kind, n):
    r = np.random.default_rng(n)
    q = np.linalg.qr(r.standard_normal((n, n)))[0]
    x = r.standard_normal((2, n))
    a = {
        "random": lambda: (q * r.random(n)) @ q.T,
        "graded": lambda: (q * np.logspace(4, -9, n)) @ q.T,
        "pairs": lambda: (q * (np.arange(n) // 2)) @ q.T,
        "low rank": lambda: x.T @ x,
        "identity": lambda: 3.7 * np.eye(n),
        "zero": lambda: np.zeros((n, n)),
        "diagonal": lambda: np.diag(np.arange(n) * 1.0),
    }[kind]()
    e, v = eigen(a)
    size = max(np.linalg.norm(a), 1e-300)
    assert np.all(np.diff(e) <= 0)
    assert np.abs(v.T @ v - np.eye(n)).max() < 1e-13
    assert np.linalg.norm(a @ v - v * e) / size < 1e-13
    assert np.abs(e - np.linalg.eigvalsh((a + a.T) / 2)[::-1]).max() / size < 1e-13


def test_polar_factor_is_the_sign():
    r = np.random.default_rng(0)
    q = np.linalg.qr(r.standard_normal((9, 9)))[0]
    e = np.array([5, 3, 1, 1e-9, 1e-13, -1e-12, -1e-6, -2, -9])
    u = polar_factor((q * e) @ q.T)
    assert np.abs(u @ u - np.eye(9)).max() < 1e-13
    big = np.abs(e) > 1e-8
    assert np.abs((q.T @ u @ q - np.diag(np.sign(e)))[np.ix_(big, big)]).max() < 1e-6


def table(spark, n, d, seed=0):
    r = np.random.default_rng(seed)
    m = (r.standard_normal((n, d)) * np.linspace(0.1, 0.5, d)).astype(np.float32)
    return m, [(i, row.tolist()) for i, row in enumerate(m)]


def held(df, model):
    got = df.select("vec_id", f"{W.WHITE}.deviation", f"{W.WHITE}.values").orderBy("vec_id").collect()
    return np.array([r[1] for r in got]), np.array([r[2] for r in got])


def same_up_to_sign(a, b):
    return all(min(np.abs(a[:, k] - s * b[:, k]).max() for s in (1, -1)) < 1e-9 for k in range(a.shape[1]))


@pytest.mark.parametrize("n, d", [(200, 12), (40, 3), (9, 1)])
def test_whitening_equals_eigh(spark, n, d):
    m, rows = table(spark, n, d)
    df = spark.createDataFrame(rows, VECS).repartition(3)
    model = W.fit(df)
    dev, z, share = plain(whole(m), min(8, d))
    out = W.whitened(df, model)
    got_dev, got = held(out, model)
    assert (got_dev == dev).all() and same_up_to_sign(got, z)
    assert np.allclose(model.explained, share, rtol=1e-12)
    assert W.identity_error(out, model) < 1e-12


def test_the_result_does_not_depend_on_the_dealing(spark):
    _, rows = table(spark, 300, 6)
    fits = [W.fit(spark.createDataFrame(rows, VECS).repartition(p)) for p in (1, 4, 7)]
    for f in fits[1:]:
        assert f.sums == fits[0].sums and (f.vectors == fits[0].vectors).all() and (f.values == fits[0].values).all()


def test_odd_rows(spark):
    m, rows = table(spark, 60, 5)
    bad = [(100, None), (101, []), (102, [1.0, None, 0.0, 0.0, 0.0]), (103, [float("nan")] + [0.0] * 4)]
    bad += [(104, [float("inf")] + [0.0] * 4), (105, [float("-inf")] + [0.0] * 4), (106, [1.0, 2.0])]
    extra = [(None, rows[0][1]), (7, rows[7][1])]
    df = spark.createDataFrame(rows + extra + bad, VECS)
    names = "component n deviation whitened explained identity_error size i s v sums values".split()
    df = df.select("*", *[F.lit("x").alias(c) for c in names])
    model = W.fit(df)
    x = whole([*m, m[0], m[7]])
    dev, z, _ = plain(x, 5)
    out = W.whitened(df, model)
    assert out.columns == [*df.columns, W.WHITE] and out.count() == 62 and model.n == 62
    by_id = {}
    for r in out.collect():
        by_id.setdefault(r["vec_id"], []).append(r[W.WHITE]["deviation"])
    assert by_id[None] == [dev[60]] and by_id[7] == [dev[7]] * 2 and by_id[3] == [dev[3]]


@pytest.mark.parametrize("rows", [[], [(1, [0.5, 0.25])], [(1, [0.5, 0.25]), (2, [0.5, 0.25])], [(1, None)]])
def test_without_spread_there_is_no_component(spark, rows, tmp_root):
    spark.createDataFrame(rows, VECS).write.parquet(f"{tmp_root}/embeddings.parquet")
    out = W.op13_whitening(spark, tmp_root)
    assert out.count() == 0
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_large_entries_add_up_exactly(spark):
    rows = [(i, [float(c) for c in v]) for i, v in enumerate([(3e9, 1.0), (-3e9, 2.0), (1e9, 5.0), (0.0, 7.0)])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    model = W.fit(df)
    x = np.array([[int(c * 1024) + 100_000 for c in v] for _, v in rows], object)
    assert model.sums == x.sum(axis=0).tolist()
    got = {r["vec_id"]: r[W.WHITE]["deviation"] for r in W.whitened(df, model).collect()}
    want = ((4 * x - x.sum(axis=0)) ** 2).sum(axis=1)
    assert [got[i] for i in range(4)] == [int(w) if w < 1 << 63 else None for w in want]
