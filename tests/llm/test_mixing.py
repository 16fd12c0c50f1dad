import re

import pytest
from conftest_llm import DOCS, rows, text

from offerlake.llm import mixing
from offerlake.llm.mixing import PARAMS, mix, mixed


def level_targets(sizes, weights, share, cap):
    """Shares by weight, the excess given on until none is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, free, out = share * sum(sizes.values()), set(names), {}
    while free:
        total = sum(w[s] for s in free)
        full = {s for s in free if left * w[s] / total > cap * sizes[s]}
        if not full:
            out.update({s: left * w[s] / total for s in free})
            break
        for s in full:
            out[s] = cap * sizes[s]
        left -= sum(out[s] for s in full)
        free -= full
    return out


def size(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(
        [(i, text(i, 5 + i % 40), "en", None if i % 7 == 0 else f"s{i * i % 5}", 1) for i in range(1500)], DOCS
    )


def test_targets_and_taken_words(docs):
    got = mix(docs, **PARAMS).select("doc_id", "text", "source", "__source_size", "__target", "__times").collect()
    sizes, taken = {}, {}
    for r in got:
        n = size(r["text"])
        sizes[r["source"]] = sizes.get(r["source"], 0) + n
        taken[r["source"]] = taken.get(r["source"], 0) + n * r["__times"]
        assert 0 <= r["__times"] <= 2
    want = level_targets(sizes, (3, 1, 2), 1.5, 2)
    for r in got:
        assert r["__source_size"] == sizes[r["source"]]
        assert r["__target"] == pytest.approx(want[r["source"]])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 45


def test_reruns_and_partitionings_agree(docs):
    cols = ["doc_id", "__times"]
    assert rows(mix(docs, **PARAMS).select(*cols)) == rows(mix(docs.repartition(7, "text"), **PARAMS).select(*cols))


def test_a_larger_budget_takes_a_superset(docs):
    small = dict(rows(mix(docs, (1.0,), 0.4, 2.0).select("doc_id", "__times")))
    large = dict(rows(mix(docs, (1.0,), 0.9, 2.0).select("doc_id", "__times")))
    assert all(large[k] >= v for k, v in small.items())
    assert sum(small.values()) < sum(large.values())


def test_the_mix_repeats_rows(docs):
    times = dict(rows(mix(docs, **PARAMS).select("doc_id", "__times")))
    out = [r[0] for r in mixed(docs, **PARAMS).select("doc_id").collect()]
    assert sorted(out) == sorted(i for i, n in times.items() for _ in range(n))


def test_only_the_boundary_bucket_is_refined_when_one_document_fills_a_source(spark):
    docs = spark.createDataFrame([(1, text(1, 900), "en", "big", 1), (2, text(2, 3), "en", "small", 1)], DOCS)
    got = {r["doc_id"]: r for r in mix(docs, (1.0,), 0.5, 2.0).collect()}
    assert got[1]["__times"] in (0, 1) and got[1]["__target"] + got[2]["__target"] == pytest.approx(0.5 * 903)


def test_defined_cases(odd, empty, clashing):
    got = mix(odd, **PARAMS)
    assert got.count() == odd.count()
    assert {r["__times"] for r in got.filter("text is null").collect()} <= {0, 1, 2}
    two = got.filter("doc_id = 2").select("__times").collect()
    assert two[0] == two[1]
    assert mix(empty, **PARAMS).count() == 0 and mixed(empty, **PARAMS).count() == 0
    assert mixed(clashing, **PARAMS).columns == clashing.columns
    assert mixing.PARAMS["max_repeats"] == 2.0
