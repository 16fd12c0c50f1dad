import hashlib
import random

import numpy as np
import pytest
from conftest_llm import DOCS, text

from offerlake.llm import suffix_dedup, suffix_index
from offerlake.llm.suffix_dedup import Seen, cut, dedup, merged, op6_suffix_dedup
from offerlake.llm.suffix_index import Family, anchors, window_min


def plain(rows, length=100):
    """What every named text keeps, strings looked up one by one."""
    first, texts = {}, {}
    for i, t in rows:
        if i is not None:
            texts.setdefault(i, set()).add((t or "").encode())
    for i in sorted(texts):
        for b in texts[i]:
            for p in range(len(b) - length + 1):
                s = b[p : p + length]
                first[s] = min(first.get(s, (i, p)), (i, p))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        mark = bytearray(len(b))
        if i is not None:
            for p in range(len(b) - length + 1):
                if first[b[p : p + length]] < (i, p):
                    mark[p : p + length] = b"\1" * length
        kept = bytes(c for c, m in zip(b, mark) if not m)
        out.append((i, len(b), sum(mark), len([x for x in bytes(mark).split(b"\0") if x]), kept))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r[:4]) + (bytes(r[4]),) for r in df.collect()), key=repr)


def shared_passages(seed, n):
    r = random.Random(seed)
    passages = [text(seed * 77 + k, 30) for k in range(4)]
    out = []
    for i in range(n):
        parts = [text(seed * 1000 + i, r.randint(0, 25))]
        for _ in range(r.randint(0, 3)):
            p = r.choice(passages)
            a = r.randint(0, len(p) // 2)
            parts += [p[a : a + r.randint(60, len(p))], text(r.randint(0, 10**6), r.randint(0, 10))]
        out.append((i * 3, "".join(parts) + "é" * r.randint(0, 3)))
    out += [(n * 3 + 1, "ab" * 400), (n * 3 + 2, "x" * 99), (n * 3 + 4, "x" * 100), (n * 3 + 5, "x" * 101), (n * 3 + 7, "ab" * 300)]
    return out


@pytest.mark.parametrize("sizes", [{}, {"batch_rows": 40, "task_bytes": 2_000}])
@pytest.mark.parametrize("seed", [1, 2])
def test_equals_a_plain_version(spark, monkeypatch, seed, sizes):
    if sizes:
        monkeypatch.setattr(suffix_dedup, "SLICE_BYTES", 600)
        monkeypatch.setattr(suffix_dedup, "PACKED_BYTES", 300)
        monkeypatch.setattr(suffix_dedup, "ROWS", 40)
        monkeypatch.setattr(suffix_dedup, "OPEN_BYTES", 500)
        monkeypatch.setattr(suffix_dedup, "HOT_SEGMENTS", 2)
        monkeypatch.setattr(suffix_index, "PIECE", 64)
    rows = shared_passages(seed, 60)
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS).repartition(5)
    assert found(dedup(docs, **sizes)) == plain(rows)


def test_other_lengths(spark):
    rows = shared_passages(5, 30)
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS)
    assert found(dedup(docs, length=40)) == plain(rows, 40)


def test_defined_cases(odd, empty, clashing):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert found(dedup(odd)) == plain(rows)
    assert found(dedup(clashing)) == plain(rows)
    assert dedup(empty).count() == 0


def test_query(spark, tmp_path):
    rows = shared_passages(3, 20)
    spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    want = [(i, n, gone, k, hashlib.sha256(kept).hexdigest()) for i, n, gone, k, kept in plain(rows)]
    assert sorted((tuple(r) for r in op6_suffix_dedup(spark, str(tmp_path)).collect()), key=repr) == sorted(want, key=repr)


def test_every_string_has_one_anchor_and_equal_strings_the_same():
    r = np.random.default_rng(0)
    a, b = (r.integers(97, 101, 700).astype(np.uint8) for _ in range(2))
    b[200:420] = a[50:270]
    seen = []
    for x in (a, b):
        gram, segment, start, count = anchors(x, 100)
        assert start[0] == 0 and (start[1:] == start[:-1] + count[:-1]).all() and count.sum() == len(x) - 99
        assert (count >= 1).all() and (count <= 81).all()
        seen.append({p: (g, s) for g, s, f, n in zip(gram, segment, start, count) for p in range(f, f + n)})
    # Strings 50..170 of the first are strings 200..320 of the second.
    assert all(seen[0][50 + k][0] == seen[1][200 + k][0] for k in range(121))
    assert sum(seen[0][50 + k] == seen[1][200 + k] for k in range(121)) > 20


def test_window_min():
    x = np.random.default_rng(0).integers(0, 99, 50)
    for w in (1, 2, 3, 7, 8, 50):
        assert window_min(x, w).tolist() == [x[i : i + w].min() for i in range(51 - w)]


def test_levels_grow_geometrically_and_report_each_segment_once():
    r, family = random.Random(3), Family()
    rows = [(r.randint(0, 60), r.randint(0, 4), i, i) for i in range(1000)]
    copies, opened = [], []
    for lo in range(0, 1000, 50):
        g, s, d, a = (np.array(x) for x in zip(*rows[lo : lo + 50]))
        (cd, _), (og, od, _) = family.add(g.astype(np.uint64), s.astype(np.uint64), d, a)
        copies += cd.tolist()
        opened += list(zip(og.tolist(), od.tolist()))
        ranks = [level.rank for level in family.levels]
        assert ranks == sorted(set(ranks), reverse=True)  # one level of each size
    first, by_gram = {}, {}
    for g, s, d, _ in rows:
        first.setdefault((g, s), d)
        by_gram.setdefault(g, set()).add(s)
    assert sorted(copies) == sorted(d for g, s, d, _ in rows if first[g, s] != d)
    assert sorted(opened) == sorted((g, d) for (g, s), d in first.items() if len(by_gram[g]) > 1)
    assert len(family.levels) == bin(20).count("1")


@pytest.mark.parametrize("cuts", [(0, 9), (0, 3, 9), (0, 3, 5, 9), tuple(range(10))])
def test_a_repeated_row_is_no_copy_over_batches(cuts):
    # (gram, segment, doc, at); places of two and three rows, the third segment also at a later place.
    rows = [(7, 1, 1, 0), (7, 2, 1, 40), (8, 3, 2, 0), (8, 3, 2, 0), (8, 3, 2, 0), (9, 4, 2, 50), (9, 4, 2, 50), (8, 3, 5, 0), (8, 3, 5, 0)]
    family, copies = Family(), []
    for lo, hi in zip(cuts, cuts[1:]):
        g, s, d, a = (np.array(x) for x in zip(*rows[lo:hi]))
        (cd, ca), _ = family.add(g.astype(np.uint64), s.astype(np.uint64), d, a)
        copies += zip(cd.tolist(), ca.tolist())
    assert copies == [(5, 0), (5, 0)]


def test_repeated_rows_parted_over_batches(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SLICE_BYTES", 1)
    limit = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(limit)
    rows = [r for r in shared_passages(4, 12) for _ in range(2)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS).repartition(5)
    spark.conf.set(limit, "3")
    try:
        assert found(dedup(docs, batch_rows=1)) == plain(rows)
    finally:
        spark.conf.set(limit, before)


def test_repeated_strings_of_opened_segments():
    a, b, c = b"q" + b"abcdefghij" * 3, b"z" + b"abcdefghij" * 3, b"abcdefghij" * 3
    want = [(2, 41 + k, 62 + k) for k in range(10)] + [(3, 7 + k, 28 + k) for k in range(10)]
    rows = [(5, 1, 0, a), (5, 2, 40, b), (5, 3, 7, c), (6, 9, 0, a)]
    for cuts in ([0, 4], [0, 1, 4], [0, 2, 4], [0, 1, 2, 3, 4]):
        seen, got = Seen(), []
        for lo, hi in zip(cuts, cuts[1:]):
            g, d, s, p = zip(*rows[lo:hi])
            got += zip(*(x.tolist() for x in seen.repeated(np.array(g), np.array(d), np.array(s), list(p), 21)))
        assert sorted(got) == want


def test_merging_and_cutting():
    d, lo, hi = merged(np.array([2, 1, 1, 1]), np.array([0, 5, 0, 30]), np.array([4, 9, 5, 40]))
    assert list(zip(d, lo, hi)) == [(1, 0, 9), (1, 30, 40), (2, 0, 4)]
    assert cut(b"0123456789", np.array([7, 1]), np.array([99, 3])) == (b"03456", 2)
