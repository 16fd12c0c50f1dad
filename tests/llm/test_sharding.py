import zlib
from collections import Counter

import pytest
from conftest_llm import DOCS, rows, text

from offerlake.llm.sharding import shard


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, text(i, i % 9), "en", "s", 1) for i in range(3000)], DOCS)


def test_a_new_shard_takes_rows_only_into_itself(docs):
    got = shard(docs, [1.0] * 16, [1.0] * 17).collect()
    assert all(r["grown_shard"] in (r["shard"], 16) for r in got)
    moved = sum(r["grown_shard"] == 16 for r in got)
    assert 0.03 < moved / len(got) < 0.09
    assert all(120 <= n <= 260 for n in Counter(r["shard"] for r in got).values())


def test_weights_set_the_shares(docs):
    n = Counter(r["shard"] for r in shard(docs, [1.0, 3.0, 0.0]).collect())
    assert n[2] == 0 and 2.5 < n[1] / n[0] < 3.6
    with pytest.raises(ValueError):
        shard(docs, [0.0])


def test_slots_sizes_and_checksums(docs, monkeypatch):
    monkeypatch.setattr("offerlake.llm.sharding.BUCKET_ROWS", 100)  # many numbering buckets
    got = shard(docs, [1.0] * 5).collect()
    for s in range(5):
        own = sorted(r["slot"] for r in got if r["shard"] == s)
        assert own == list(range(len(own)))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in got:
        b = texts[r["doc_id"]].encode()
        assert r["size"] == len(b) + 1 and r["text_crc32"] == zlib.crc32(b)


def test_place_depends_on_key_and_count_alone(docs):
    a = rows(shard(docs, [1.0] * 16).select("doc_id", "shard"))
    b = rows(shard(docs.filter("doc_id % 3 = 0").repartition(5), [1.0] * 16).select("doc_id", "shard"))
    assert set(b) <= set(a)


def test_defined_cases(odd, empty, clashing):
    got = shard(odd, [1.0] * 4, [1.0] * 5)
    assert got.count() == odd.count()
    for r in got.collect():
        assert r["size"] >= 1 and r["slot"] >= 0
    null = got.filter("doc_id = 5").first()
    assert null["size"] == 1 and null["text_crc32"] == 0
    assert shard(empty, [1.0] * 4).count() == 0
    assert shard(clashing, [1.0] * 4).count() == odd.count()
