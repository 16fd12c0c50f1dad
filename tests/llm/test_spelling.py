"""Operator 12 against the edits of every word."""

import random
import re
import zlib
from collections import Counter

import pytest
from conftest_llm import DOCS, rows

from offerlake.llm import spelling as S

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs):
    count = Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    words = {w: n for w, n in count.items() if len(w) >= 7 and n >= 2}
    letters = {c for w in words for c in w}
    out = {}
    for w, n in words.items():
        near = {w[:p] + w[p + 1 :] for p in range(len(w))}
        near |= {w[:p] + c + w[p + 1 :] for p in range(len(w)) for c in letters}
        near |= {w[:p] + c + w[p:] for p in range(len(w) + 1) for c in letters}
        near = {v for v in near if v in words and v != w}
        form = min(near, key=lambda v: (-words[v], v), default=None)
        form = form if form and words[form] >= 10 * n else None
        out[w] = (form, n, len(near), words.get(form))

    def root(w):
        while out[w][0]:
            w = out[w][0]
        return w

    return sorted(((w, f, root(w), n, k, m) for w, (f, n, k, m) in out.items()), key=repr)


@pytest.mark.parametrize("letters", ["abcdefghij", "abé"])
def test_variants_equal_all_edits(spark, letters):
    r = random.Random(3)
    base = ["".join(r.choice(letters) for _ in range(r.choice([6, 7, 7, 8, 8, 9, 10, 12, 47, 48, 49, 50, 130]))) for _ in range(40)]

    def slip(w):
        p, k = r.randrange(len(w)), r.random()
        return w if k < 0.7 else w[:p] + w[p + 1 :] if k < 0.8 else w[:p] + r.choice(letters) + w[p + (k < 0.9) :]

    docs = [(j, " ".join(slip(slip(base[int(40 * r.random() ** 3)])) for _ in range(200))) for j in range(60)]
    docs += [(None, "abababab " * 3), (None, "ABABABAB"), (5, None), (6, "")]
    got = rows(S.variants(spark.createDataFrame(docs, "doc_id long, text string")).select(*COLUMNS))
    want = plain(docs)
    assert got == want
    assert any(w[1] for w in want) and any(len(w[0]) > S.LONG and w[4] for w in want)
    if letters == "abé":
        assert any(w[1] and w[2] != w[1] for w in want)  # a chain of forms


def test_chains_of_forms(spark):
    forms = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(11)] + [("v", "w5")], "word string, form string")
    assert rows(S.with_roots(forms)) == sorted([(f"w{i}", "w11") for i in range(11)] + [("v", "w11")], key=repr)


def test_odd_rows(spark, odd, clashing, empty):
    got = rows(S.variants(odd).select(*COLUMNS))
    assert got == plain([(r["doc_id"], r["text"]) for r in odd.collect()])
    assert rows(S.variants(clashing).select(*COLUMNS)) == got
    assert S.variants(empty).columns == ["word", "form", "root", "n", "n_near", "form_n"] and S.variants(empty).count() == 0


def test_a_very_long_run_of_letters(spark):
    long = "abcdefg" * 3_000
    docs = [(1, f"{long} {long}"), (2, long[:900] + long[901:]), (3, long[:900] + long[901:]), (4, long[:-1] + "z"), (5, long[:-1] + "z")]
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in docs], DOCS)
    got = {r["n_near"] for r in S.variants(df).collect()}
    near = {w: k for w, _, _, _, k, _ in rows(S.variants(df).select(*COLUMNS))}
    assert got == {1, 2} and near[long] == 2
