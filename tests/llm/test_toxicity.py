import random
import zlib

import numpy as np
import pytest
from conftest_llm import DOCS, text

from offerlake.llm import toxicity
from offerlake.llm.toxicity import Machine, fit, held_out, score, sigmoid, slots, train


def corpus(n, seed):
    """Toxic if an insult meets a group; either alone is clean."""
    r = random.Random(seed)
    out = []
    for i in range(n):
        insult, group = r.random() < 0.5, r.random() < 0.5
        t = text(seed * 100_000 + i, 12) + " awful" * insult + " greens" * group
        out.append((t, int(insult and group)))
    return out


def test_pairs_are_learned_that_a_weight_per_term_cannot_express():
    data = corpus(1500, 1)
    m = fit([slots(t) for t, _ in data], np.array([y for _, y in data]), epochs=40)
    test = corpus(500, 2)
    rows = [slots(t) for t, _ in test]
    starts = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    got = m.score(np.concatenate(rows), starts) >= 0.5
    assert np.mean(got == np.array([y for _, y in test])) > 0.97
    assert np.abs(m.v).max() > 0.1


def test_the_pair_sum_equals_all_pairs():
    r = np.random.default_rng(0)
    m = Machine(0.3, r.normal(size=40), r.normal(size=(40, 3)))
    rows = [np.array([1, 5, 7]), np.array([], int), np.array([2, 3, 11, 30])]
    starts = np.array([0, 3, 3, 7])
    got = m.raw(np.concatenate(rows), starts)
    for x, s in zip(rows, got):
        pairs = sum(m.v[a] @ m.v[b] for i, a in enumerate(x) for b in x[i + 1 :])
        assert s == pytest.approx(0.3 + m.w[x].sum() + pairs)


def test_one_class_or_no_labels():
    assert score_of(fit([], np.array([])), "x") == pytest.approx(0, abs=1e-6)
    assert score_of(fit([slots("a b")], np.array([1])), "x") == pytest.approx(1, abs=1e-6)


def score_of(m, t):
    s = slots(t)
    return float(m.score(s, np.array([0, len(s)]))[0])


@pytest.fixture(scope="module")
def tables(spark):
    data = corpus(900, 3)
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, (t, _) in enumerate(data)], DOCS)
    labels = spark.createDataFrame([(i, 1, y) for i, (_, y) in enumerate(data)], "doc_id long, quality int, toxic int")
    return docs, labels


def test_held_out_rows_are_never_learned_from(spark, tables):
    docs, labels = tables
    hidden = {r["doc_id"] for r in docs.select("doc_id", held_out(docs.doc_id).alias("h")).filter("h").collect()}
    assert hidden == {i for i in range(900) if zlib.crc32(str(i).encode()) % 5 == 0}
    other = labels.selectExpr("doc_id", "quality", "case when crc32(binary(string(doc_id))) % 5 = 0 then 1 - toxic else toxic end as toxic")
    a, b = train(docs, labels), train(docs.repartition(7), other)
    assert a.w0 == b.w0 and (a.w == b.w).all() and (a.v == b.v).all()


def test_accuracy_on_held_out_rows(tables):
    docs, labels = tables
    s = {r["doc_id"]: r["score"] for r in score(docs, train(docs, labels)).collect()}
    y = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    h = [i for i in s if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(s[i] >= 0.5) == y[i] for i in h]) > 0.9


def test_the_sample_is_bounded(tables):
    docs, labels = tables
    n = {r["__y"]: r["count"] for r in toxicity.sample(labels, 40, "doc_id", "toxic").groupBy("__y").count().collect()}
    assert n == {0: 40, 1: 40}


def test_defined_cases(spark, odd, empty, clashing):
    labels = spark.createDataFrame(
        [(1, 1, 1), (1, 1, 0), (3, 1, 0), (7, None, None), (None, 1, 1), (99, 1, 0)], "doc_id long, quality int, toxic int"
    )
    m = train(clashing, labels)
    got = score(clashing, m).collect()
    assert len(got) == odd.count() and all(0 <= r["score"] <= 1 for r in got)
    blank = {round(r["score"], 12) for r in got if r["doc_id"] in (4, 5, 6)}
    assert blank == {round(float(sigmoid(np.float64(m.w0))), 12)}
    assert score(empty, m).count() == 0
    nothing = train(empty, labels.limit(0))
    assert all(r["score"] < 1e-6 for r in score(odd, nothing).collect())
