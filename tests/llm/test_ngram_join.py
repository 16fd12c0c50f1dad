import random

import numpy as np
import pytest
from conftest_llm import DOCS, text
from hypothesis import given, settings
from hypothesis import strategies as st

from offerlake.llm import ngram_join
from offerlake.llm.components import components
from offerlake.llm.ngram_join import Order, Summary, folded, jaccard_classes, least_difference, shingles, sketch
from offerlake.llm.prefix_tree import PrefixTree, forest


def plain_sets(t, width):
    w = (t or "").encode().lower().split()
    width = min(width, len(w))
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if w else set()


def plain_classes(rows, width, percent):
    """Component of every named row, all pairs compared."""
    sets = [(i, plain_sets(t, width)) for i, t in rows]
    named = [x for x in sets if x[0] is not None and x[1]]
    parent = list(range(len(named)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(named)):
        for b in range(a):
            both = len(named[a][1] & named[b][1])
            if 100 * both >= percent * (len(named[a][1]) + len(named[b][1]) - both):
                parent[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(named):
        least[root(k)] = min(least.get(root(k), i), i)
    by_set = {frozenset(s): least[root(k)] for k, (_, s) in enumerate(named)}
    return sorted(((i, len(s), by_set.get(frozenset(s), i) if s else i) for i, s in sets), key=repr)


def found(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect()), key=repr)


def near_copies(seed, groups, copies, n):
    """Groups of texts that differ from each other in a few words."""
    r, out = random.Random(seed), []
    passage = text(seed + 999, 40)  # shared by all
    for g in range(groups):
        base = text(seed * 1000 + g, n).split()
        for _ in range(copies):
            w = list(base)
            for _ in range(r.randint(0, 6)):
                w[r.randrange(len(w))] = f"new{r.randint(0, 99)}"
            out.append(" ".join(w) + (" " + passage if r.random() < 0.5 else ""))
    r.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("width,percent", [(3, 90), (5, 80), (2, 60)])
@pytest.mark.parametrize("sizes", [{}, {"group_rows": 5, "tree_shingles": 1500}])
def test_equals_all_pairs(spark, monkeypatch, width, percent, sizes):
    if sizes:
        monkeypatch.setattr(ngram_join, "SMALL_GROUP", 3)
    rows = near_copies(percent, 6, 25, 120)
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS).repartition(4)
    assert found(jaccard_classes(docs, width, percent, **sizes)) == plain_classes(rows, width, percent)


def test_defined_cases(odd, empty, clashing):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert found(jaccard_classes(odd)) == plain_classes(rows, 3, 90)
    assert found(jaccard_classes(clashing)) == plain_classes(rows, 3, 90)
    assert jaccard_classes(empty).count() == 0


def test_a_chain_of_links_is_one_component(spark):
    w = [f"w{i}" for i in range(200)]
    rows = [(10 - k, " ".join(w[k * 5 : k * 5 + 150])) for k in range(8)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS)
    got = found(jaccard_classes(docs))
    assert {c for _, _, c in got} == {3} and got == plain_classes(rows, 3, 90)


def test_results_do_not_depend_on_what_counts_as_frequent(spark, monkeypatch):
    rows = near_copies(4, 3, 40, 60)
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS)
    want = plain_classes(rows, 3, 90)
    for n in (1, 50, 50_000):
        monkeypatch.setattr(ngram_join, "FREQUENT", n)
        monkeypatch.setattr(ngram_join, "SUMMARY", max(8, n))
        assert found(jaccard_classes(docs)) == want


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sets(st.integers(0, 40), min_size=1, max_size=30), min_size=1, max_size=20), st.sampled_from([50, 80, 90, 100]))
def test_prefix_tree_finds_all_links(groups, percent):
    sets = [list(x) for x in {tuple(sorted(g)) for g in groups}]
    tree = PrefixTree(sets, percent)

    def links(i):
        a = set(sets[i])
        return [j for j, b in enumerate(sets) if 100 * len(a & set(b)) >= percent * len(a | set(b))]

    for i in range(len(sets)):
        assert sorted(tree.linked(sets[i])) == links(i)
    reached = {0}
    while more := {j for i in reached for j in links(i)} - reached:
        reached |= more
    edges = forest(sets, percent)
    got, old = {0}, set()
    while got != old:
        old = set(got)
        got |= {x for e in edges if set(e) & got for x in e}
    assert got == reached


def test_long_stretches_are_left_early():
    a, b = list(range(0, 20_000, 2)), list(range(1, 20_001, 2))
    tree = PrefixTree([a, b], 90)
    assert tree.linked(a) == [0]


def test_sketches_never_overstate():
    r = np.random.default_rng(0)
    for n in (3, 300, 1400, 1600, 5100):
        a = np.unique(r.integers(0, 2**63, n).astype(np.uint64))
        for change in (0, 1, n // 10, n):
            b = np.unique(np.concatenate([a[change:], r.integers(0, 2**63, change).astype(np.uint64)]))
            if len(b):
                real = len(np.setxor1d(a, b))
                for k in (64, min(len(sketch(a)), len(sketch(b)))):
                    assert least_difference(folded([sketch(a)], k), folded([sketch(b)], k))[0] <= real


def test_summaries_keep_the_most_frequent():
    s, r = Summary(50), np.random.default_rng(1)
    for _ in range(40):
        s.add(np.concatenate([np.repeat(np.arange(5, dtype=np.uint64), 20), r.integers(100, 10**9, 100).astype(np.uint64)]))
    s.settle()
    counts = dict(zip(s.values.tolist(), s.counts.tolist()))
    assert len(counts) <= 50 and all(600 <= counts[i] <= 800 for i in range(5))


def test_order_puts_frequent_shingles_last():
    s = np.array([1, 5, 9, 12], np.uint64)
    got, df = Order([(5, 70), (1, 300), (77, 16)]).sort(s)
    assert got.tolist() == [9, 12, 5, 1] and df.tolist() == [0, 0, 70, 300]
    assert Order([]).sort(s)[0].tolist() == s.tolist()


def test_the_list_of_frequent_shingles_is_filled(spark):
    rows = spark.range(60_000).selectExpr("id as token", "1000000L as df")
    got = ngram_join.most_frequent(rows.unionAll(spark.range(90_000, 90_010).selectExpr("id", "5000000L")))
    assert 45_000 < len(got) <= ngram_join.FREQUENT and {t for t, d in got if d == 5_000_000} == set(range(90_000, 90_010))
    assert ngram_join.most_frequent(rows.filter("df < 0")) == []


@pytest.mark.parametrize("alike", [False, True])
def test_large_groups_are_split_and_lose_no_pair(spark, alike):
    """2,000 sets that all share a shingle: unlike ones part by a second shingle, others into blocks."""
    r, n, percent, limit = random.Random(3), 40, 80, 100
    p = n - 32 + 1
    sets = [[7, *sorted(r.sample(range(100, 115 if alike else 20_000), p))] for _ in range(2_000)]
    rows = [(k, i, n << 32 | at) for i, s in enumerate(sets) for at, k in enumerate(s)]
    got = ngram_join.dealt(spark.createDataFrame(rows, "key long, node long, place long"), percent, limit).collect()
    groups = {}
    for x in got:
        groups.setdefault(x["key"], set()).add(x["node"])
    assert max(map(len, groups.values())) < 4 * limit
    met = {(a, b) for g in groups.values() if len(g) > 1 for a in g for b in g if a < b}
    for a in range(0, 2_000, 7):
        for b in range(a + 1, 2_000):
            common = set(sets[a]) & set(sets[b])
            if len(common) >= 2 and (alike or b % 3 == 0):
                assert (a, b) in met
    if not alike:
        assert len(got) < 2 * len(rows)  # no row for each block


def test_words_are_split_and_lowered_as_defined():
    a, b = shingles("A b\x0bC É x", 3), shingles("a B\x0cc É X", 3)
    assert a.tolist() == b.tolist() and len(a) == 3
    assert shingles("é x y", 3).tolist() != shingles("É x y", 3).tolist()
    assert len(shingles("a\x1cb\x85c", 3)) == 1 and len(shingles(" \n", 3)) == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_components_of_random_graphs(spark, seed):
    r = random.Random(seed)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)] + [(500, x) for x in range(501, 560)]
    got = {x["node"]: x["root"] for x in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    alone = {x for x in parent if all(x not in e or e[0] == e[1] for e in edges)}
    assert got == {x: root(x) for x in parent if x not in alone}


def test_components_without_edges(spark):
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
    assert components(spark.createDataFrame([(3, 3)], "u long, v long")).count() == 0
