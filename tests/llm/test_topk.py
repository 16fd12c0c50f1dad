import math

import numpy as np
import pytest

from offerlake.llm import topk
from offerlake.llm.topk import best_blocks, box_bounds, search, top_k

VECS = "vec_id long, embedding array<float>, label int"


def plain(rows, k, every=50):
    """Scores of all pairs, sorted."""
    ok = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, x in {(i, tuple(v)) for i, v in ok if i % every == 0}:
        scored = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in ok if i != q)
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def data(n, dim=8, seed=1):
    r = np.random.default_rng(seed)
    return [(int(i), [float(x) for x in r.normal(0, 0.3, dim).astype(np.float32)]) for i in range(n)]


def found(df):
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in df.collect())


def run(spark, rows, k=5):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], VECS)
    return found(top_k(df, df.filter("vec_id % 50 = 0"), k))


@pytest.mark.parametrize("shard,chunk,block", [(8192, 8192, 64), (100, 3, 7), (17, 1, 1)])
def test_equals_brute_force(spark, monkeypatch, shard, chunk, block):
    for name, v in (("SHARD", shard), ("CHUNK", chunk), ("BLOCK", block)):
        monkeypatch.setattr(topk, name, v)
    rows = data(400)
    rows[50] = (50, rows[0][1])  # ties
    rows[51] = (51, rows[0][1])
    rows += [(1000, None), (1050, [math.nan] * 8), (1100, [math.inf] + [0.0] * 7), (1150, [None] * 8), (None, rows[3][1])]
    assert run(spark, rows) == plain(rows, 5)


def test_unequal_lengths_zero_vectors_and_few_rows(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.0]), (2, []), (3, [0.0, 0.0, 9.0]), (50, [-1.0, -1.0, -1.0])]
    assert run(spark, rows) == plain(rows, 5)
    assert run(spark, rows[:1]) == []
    assert run(spark, []) == []


def test_large_components_stay_exact(spark):
    rows = [(i, [3e6 + i, -3e6, 2.5e6 * (i % 3)]) for i in range(120)]
    assert run(spark, rows) == plain(rows, 5)


def test_repeated_rows_rank_one_after_the_other(spark):
    rows = [(0, [1.0]), (0, [1.0]), (7, [2.0]), (7, [2.0]), (8, [1.0])]
    assert run(spark, rows) == [(0, 1, 7, 131072), (0, 2, 7, 131072), (0, 3, 8, 65536)]


def test_blocks_below_the_kth_score_are_not_read():
    r = np.random.default_rng(0)
    centers = 40 * np.eye(16)
    m = np.concatenate([np.floor(256 * c + r.normal(0, 20, (64, 16))) for c in centers])
    ids = np.arange(len(m))
    best, who, reads = best_blocks(m[::64], ids[::64], m, ids, 5)
    assert reads < 3 * 16  # of 16 * 16
    for q in range(16):
        s = m @ m[64 * q]
        s[64 * q] = -np.inf
        want = np.lexsort((ids, -s))[:5]
        assert list(who[q]) == list(want) and list(best[q]) == list(s[want])


def test_clashing_columns(spark):
    df = spark.createDataFrame([(i, v, 0) for i, v in data(60)], VECS).selectExpr("*", "1 as id", "2 as v", "3 as n", "4 as s", "5 as q")
    assert found(top_k(df, df.filter("vec_id % 50 = 0"), 5)) == plain(data(60), 5)


def small_units(monkeypatch, **sizes):
    for name, v in sizes.items():
        monkeypatch.setattr(topk, name, v)


def clusters(n_clusters=32, size=64):
    """Vectors around far centres, one for each component, in mixed order."""
    r = np.random.default_rng(3)
    rows = np.concatenate([40 * c + r.normal(0, 0.1, (size, n_clusters)) for c in np.eye(n_clusters)])
    ids = r.permutation(len(rows))
    return [(int(i), [float(x) for x in v.astype(np.float32)]) for i, v in zip(ids, rows)]


def test_few_pairs_of_shard_and_chunk_meet_on_clusters(spark, monkeypatch):
    small_units(monkeypatch, SHARD=64, CHUNK=64, GROUP=4, BLOCK=8, SHARD_PAGE=5, CHUNK_PAGE=3)
    rows = clusters()
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], VECS)
    queries = df.filter("vec_id % 4 = 0")
    _, first, more = search(df, queries, 5, 256.0, "vec_id", "embedding")
    shipped = first.select("shard", "chunk").unionAll(more.select("shard", "chunk")).distinct().count()
    assert shipped * 5 < (len(rows) / 64) * (len(rows) / 4 / 64)
    assert found(top_k(df, queries, 5)) == plain(rows, 5, every=4)


@pytest.mark.parametrize("sizes", [(9, 4, 3, 2, 2), (50, 7, 2, 1, 1), (8192, 8192, 64, 1024, 16)])
def test_rounds_find_all_where_bounds_prune_nothing(spark, monkeypatch, sizes):
    small_units(monkeypatch, **dict(zip(("SHARD", "CHUNK", "GROUP", "SHARD_PAGE", "CHUNK_PAGE"), sizes)))
    rows = data(200, 6, seed=8)
    rows[10:40] = [(i, rows[3][1]) for i in range(10, 40)]  # ties over many shards
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], VECS)
    assert found(top_k(df, df.filter("vec_id % 10 = 0"), 5)) == plain(rows, 5, every=10)


def test_fewer_rows_in_a_shard_than_asked_for(spark, monkeypatch):
    small_units(monkeypatch, SHARD=2, CHUNK=2, GROUP=1)
    rows = data(30, 3)
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], VECS)
    assert found(top_k(df, df.filter("vec_id % 10 = 0"), 7)) == plain(rows, 7, every=10)


def test_no_pair_without_a_key(spark):
    df = spark.createDataFrame([(i, v, 0) for i, v in data(120)], VECS)
    plan = top_k(df, df.filter("vec_id % 50 = 0"), 5)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_box_bounds_hold():
    r = np.random.default_rng(5)
    for _ in range(50):
        q, s = (np.floor(r.normal(0, 50, (6, 4)) + r.normal(0, 80, (1, 4))) for _ in range(2))
        bound, _ = box_bounds(q.max(0, keepdims=True), q.min(0, keepdims=True), s.max(0, keepdims=True), s.min(0, keepdims=True))
        assert (q @ s.T).max() <= bound[0, 0]
        assert all((x == q @ s.T).all() for x in box_bounds(q, q, s, s))
    assert np.isinf(box_bounds(*[np.full((1, 2), 3e9)] * 4)[0]).all()
