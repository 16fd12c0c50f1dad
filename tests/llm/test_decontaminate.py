"""Operator 11 against plain searches."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from conftest_llm import DOCS, rows, text

from offerlake.llm import decontaminate as D
from offerlake.llm.common import batches_of_bytes

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEMS = "item_id long, text string"


class Held:
    """Stands for a broadcast."""

    def __init__(self, value):
        self._v = value

    @property
    def value(self):
        return self._v


def words(t):
    return WORD.findall((t or "").translate(LOWER))


def plain(docs, items, window):
    out = []
    for d in docs:
        ws = words(d)
        hit, found = [0] * len(ws), set()
        for item, t in items:
            v = words(t)
            n = min(window, len(v))
            for a in range(len(v) - n + 1 if n else 0):
                for p in range(len(ws) - n + 1):
                    if ws[p : p + n] == v[a : a + n]:
                        hit[p : p + n] = [1] * n
                        found.add(item)
        out.append((len(ws), sum(hit), sorted(x for x in found if x is not None)))
    return out


@pytest.mark.parametrize("seed", range(40))
def test_leaks_equal_plain_search(seed, monkeypatch):
    r = random.Random(seed)
    letters = r.choice([["a", "b"], ["a", "b", "c", "é"], [f"w{i}" for i in range(30)]])

    def make(n):
        mark = r.choice([" ", ". ", "--", "\n"])
        return mark.join(r.choice(letters).upper() if r.random() < 0.1 else r.choice(letters) for _ in range(n))

    docs = [make(r.randint(0, 60)) for _ in range(r.randint(1, 8))] + r.choice([[], [None], ["", None, " .. "]])
    items = [(None if r.random() < 0.1 else str(j % 5), make(r.randint(0, 14))) for j in range(r.randint(0, 7))]
    window = r.choice([2, 3, 5, 10])
    # Small shards cut texts into overlapping pieces; several blocks and few pairs at once change nothing.
    monkeypatch.setattr(D, "SHARD_BYTES", r.choice([40, 2 << 20]))
    monkeypatch.setattr(D, "PAIRS", r.choice([3, 1 << 20]))
    parts = r.choice([[items], [items[:3], items[3:]]])
    held = [Held(D.block([i for i, _ in p], pa.array([t for _, t in p], pa.string()), window)) for p in parts]
    got = []
    column = pa.RecordBatch.from_arrays([pa.array(docs, pa.string())], names=["t"])
    for b in batches_of_bytes([column], 0, D.SHARD_BYTES):
        got += [(x["n_words"], x["n_hit"], x["items"]) for x in D.leaks(b.column(0), held, window)]
    assert got == plain(docs, items, window)


def test_suffix_array_is_sorted():
    r = random.Random(1)
    for _ in range(50):
        n = r.randint(0, 40)
        x = [r.randint(1, 3) for _ in range(n)] + [0]
        assert D.suffix_array(np.array(x)).tolist() == sorted(range(len(x)), key=lambda i: x[i:])


def test_words_of_equal_fingerprint_are_told_apart(monkeypatch):
    """With a fingerprint that knows only a word's length, the bytes decide."""
    monkeypatch.setattr(D, "fingerprint", lambda sums, start, end: (end - start).astype(np.uint64))
    held = [Held(D.block(["1"], pa.array(["ab cde f ab"]), 3))]
    got = D.leaks(pa.array(["x ab cde f", "x yz cde f", "ab cde g ab cde f"]), held, 3)
    assert [x["n_hit"] for x in got] == [3, 0, 3]
    with pytest.raises(ValueError):
        D.block(["1"], pa.array(["ab cd"]), 3)


def test_odd_rows_and_blocks(spark, odd, clashing, empty):
    items = spark.createDataFrame(
        [(1, text(2, 80)), (1, "one"), (2, text(2, 30)), (None, "two"), (3, None), (4, ""), (4, " .."), (5, text(9, 20))], ITEMS
    )
    whole = D.judge(odd, items)
    docs = [r["text"] for r in odd.collect()]
    want = plain(docs, [(None if r[0] is None else str(r[0]), r[1]) for r in items.collect()], D.WINDOW)
    got = sorted((r["text"] or "", r[D.LEAK]["n_words"], r[D.LEAK]["n_hit"], r[D.LEAK]["items"]) for r in whole.collect())
    assert got == sorted((t or "", *w) for t, w in zip(docs, want))
    in_blocks = D.judge(odd, items, block_bytes=60)
    assert rows(in_blocks) == rows(whole)
    assert rows(D.judge(clashing, items).select(*odd.columns, D.LEAK)) == rows(whole)
    kept = D.decontaminated(odd, items)
    assert kept.columns == odd.columns and kept.count() == sum(w[1] == 0 for w in want)
    assert D.judge(empty, items).count() == 0
    assert rows(D.decontaminated(odd, items.limit(0))) == rows(odd)


def test_longest_matches(spark):
    docs = spark.createDataFrame(
        [(1, "a b c d e f", *[None] * 3), (2, "x b c d y a b c d e", *[None] * 3), (3, None, *[None] * 3), (3, "q", *[None] * 3)], DOCS
    )
    items = spark.createDataFrame([(7, "Z b c d e g a b")], ITEMS)
    got = rows(D.longest_matches(docs, items))
    # (item, start, words, document, place): of equal lengths the smallest document and place.
    assert got == [("7", 1, 4, 1, 1), ("7", 2, 3, 1, 2), ("7", 3, 2, 1, 3), ("7", 6, 2, 1, 0)]


def test_a_long_text_is_searched_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(D, "SHARD_BYTES", 400)
    body = text(5, 3_000)
    passage = " ".join(body.split()[1_490:1_530])
    got = D.leaks(pa.array([body]), [Held(D.block(["1"], pa.array([passage]), 10))], 10)
    assert got == [{"n_words": 3_000, "n_hit": 40, "items": ["1"]}]
