import random
import re

import numpy as np
import pytest
from conftest_llm import DOCS, rows, text

from offerlake.llm import pii, pii_tagger
from offerlake.llm.pii_rules import base_spans, digits, luhn, small_parts


def plain_base(t):
    """The four rules by plain searches."""
    out = [(m.start(), m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append((m.start(), m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = digits(m.group())
        if 14 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 10 <= len(digits(m.group())) <= 15:
            out.append((m.start(), m.end(), "phone"))
    return sorted(out, key=lambda s: (s[0], ["email", "ip", "card", "phone"].index(s[2])))


def test_base_spans_equal_plain_searches():
    r = random.Random(4)
    parts = ["@", ".", "a", "b-c", "1", "25", "255", "300", "+", " ", "-", "(", ")", "é", "\U0001f600", "x@y.z",
             "1.2.3.4", "4111 1111 1111 1111", "+1 555 123 4567", "\n", "%", "..", "@@", "00"]
    for _ in range(6000):
        t = "".join(r.choice(parts) for _ in range(r.randint(0, 16)))
        assert base_spans(t) == plain_base(t), t


@pytest.mark.parametrize("t", ["a" * 300_000 + "@", "1" * 300_000, "1." * 150_000 + "x", "+1 " * 100_000, "a@" * 150_000, "9 " * 150_000])
def test_base_spans_of_long_runs_take_linear_time(t):
    import time

    start = time.time()
    base_spans(t)
    assert time.time() - start < 5


def test_luhn_and_parts():
    assert luhn("4111111111111111") and not luhn("4111111111111112")
    assert small_parts("0.0.0.255") and small_parts("1.000000000000000000000255.3.4") and not small_parts("1.2.3.256")


def test_gradients_match_differences():
    p, rng = pii_tagger.new_model(), np.random.default_rng(0)
    x = rng.integers(0, pii_tagger.CODES, (6, 3))
    y = np.array([[0, 1, 0], [1, 2, 3], [2, 2, 4], [0, 0, 0], [5, 7, 0], [6, 8, 1]])
    _, g = pii_tagger.gradients(p, x, y)
    for k, w in p.items():
        for _ in range(3):
            i = tuple(rng.integers(0, n) for n in w.shape)
            if k == "A" and pii_tagger.closed()[i] < 0:
                continue
            keep = w[i]
            w[i] = keep + 1e-5
            up = pii_tagger.gradients(p, x, y)[0]
            w[i] = keep - 1e-5
            down = pii_tagger.gradients(p, x, y)[0]
            w[i] = keep
            assert (up - down) / 2e-5 == pytest.approx(g[k][i], abs=1e-5)


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(2)
    p = pii_tagger.new_model(3)
    p["A"] = rng.normal(0, 1, p["A"].shape)
    x = rng.integers(1, 128, (4, 1))
    e, _ = pii_tagger.emissions({k: w.astype(np.float32) for k, w in p.items()}, x)
    a = p["A"] + pii_tagger.closed()
    import itertools

    def total(path):
        s = e[0, 0, path[0]] + (pii_tagger.CLOSED if path[0] and path[0] % 2 == 0 else 0)
        return s + sum(e[t, 0, path[t]] + a[path[t - 1], path[t]] for t in range(1, 4))

    best = max(itertools.product(range(pii_tagger.TAGS), repeat=4), key=total)
    want = pii_tagger.spans_of(np.array(best), np.zeros(4))
    got = pii_tagger.decode(p, ["".join(map(chr, x[:, 0]))])[0]
    assert [s[:3] for s in got] == [s[:3] for s in want]


@pytest.fixture(scope="module")
def model():
    return pii_tagger.train(pii.examples([text(i, 12) for i in range(60)]), pii.WIDTH)


def test_held_out_spellings_are_found(model):
    r, hits, tries = random.Random(123), 0, 240
    cases = []
    for i in range(tries):
        kind = ("email", "ip", "card", "phone")[i % 4]
        v = pii.rewrite(kind, r.choice(pii.EXAMPLES[kind]), r)
        left = text(1000 + i, 5) + " "
        left = re.sub(r"[0-9]", "", left)
        cases.append((left + v + " " + re.sub(r"[0-9]", "", text(2000 + i, 5)), (len(left), len(left) + len(v), kind)))
    for (t, want), (_, spans) in zip(cases, pii.find([c[0] for c in cases], model)):
        hits += want in spans
    assert hits >= 0.7 * tries


def test_plain_text_is_left_alone(model):
    texts = [re.sub(r"[0-9]", "", text(i, 200)) for i in range(50)] + ["on 2021-03-04 at 12:30 it was version 1.2.3"]
    assert [s for _, s in pii.find(texts, model)] == [[]] * len(texts)


def test_windows_overlap_and_cover_every_trigger():
    t = "x" * 500 + "7" + "y" * 30 + "@" + "z" * 900 + "5"
    ws = pii.windows_of(t)
    assert all(t[lo : lo + pii.WIDTH] == w for lo, w in ws)
    for m in pii.TRIGGER.finditer(t):
        assert sum(lo <= m.start() < lo + len(w) for lo, w in ws) == 2
    assert pii.windows_of("no trigger here " * 100) == []


def test_reconciling_takes_the_best_set_and_keeps_base():
    t = "call 555 123 4567 or 555 987 6543 now"
    whole, other = (5, 17, "phone", 3.0), (21, 33, "phone", 2.0)
    both = (5, 33, "phone", 4.0)
    assert pii.reconcile(t, [], [(0, len(t), [whole, other, both])]) == [(5, 17, "phone"), (21, 33, "phone")]
    base = [(5, 17, "card")]
    assert pii.reconcile(t, base, [(0, len(t), [whole, other])]) == [(5, 17, "card"), (21, 33, "phone")]


def test_spans_cut_by_a_window_edge_give_way():
    t = "tel 555 123 4567 x"
    assert pii.reconcile(t, [], [(0, 12, [(4, 12, "phone", 9.0)]), (6, 12, [(0, 10, "phone", 9.0)])]) == []


def address(r, size):
    """A spelled-out address of about so many characters."""
    words = ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 9))) for _ in range(40)]
    out = f"{words[0]} dot {words[1]} (at) {words[2]} dot {words[3]}"
    for w in words[4:]:
        out += f" dot {w}" if len(out) < size else ""
    return out


@pytest.mark.parametrize("size", [50, 60, 70, 95, 96, 97, 120, 150])
def test_long_spans_are_found_at_every_offset(monkeypatch, size):
    value = address(random.Random(size), size)
    for offset in range(2 * pii.WIDTH):
        t = "x" * offset + " " + value + " " + "y" * 120
        a, z = offset + 1, offset + 1 + len(value)

        def decode(model, windows):
            got = []
            for lo, w in pii.windows_of(t):
                lo, hi = max(a - lo, 0), min(z - lo, len(w))
                got.append([(lo, hi, "email", 1.0)] if lo < hi else [])
            return got

        monkeypatch.setattr(pii_tagger, "decode", decode)
        assert pii.find([t], {}) == [([], [(a, z, "email")])], offset


def test_long_spellings_are_found_by_the_tagger(model):
    r, hits, cases = random.Random(6), 0, []
    for i in range(96):
        v = address(r, 50 + i)
        left = re.sub(r"[0-9]", "", text(3000 + i, 30))[: 20 + i] + " "
        cases.append((left + v + ", " + re.sub(r"[0-9]", "", text(4000 + i, 9)), (len(left), len(left) + len(v), "email")))
    for (t, want), (_, spans) in zip(cases, pii.find([c[0] for c in cases], model)):
        hits += want in spans
    assert hits >= 0.5 * len(cases), hits


def test_redaction():
    t = "a x@y.org b 1.2.3.4"
    assert pii.redact(t, base_spans(t)) == "a <EMAIL> b <IP>"
    assert pii.redact("12345", [(0, 3, "ip"), (2, 4, "card")]) == "<IP>5"


def test_defined_cases(odd, empty, clashing, model):
    got = pii.detect(odd, model)
    assert got.count() == odd.count() and pii.detect(empty, model).count() == 0
    assert pii.detect(clashing, model).count() == odd.count()
    out = pii.redacted(clashing, model)
    assert out.columns == clashing.columns and out.filter("text is null").count() == odd.filter("text is null").count()


def test_training_on_an_empty_table_uses_the_fixed_examples(empty, monkeypatch):
    seen = []
    monkeypatch.setattr(pii_tagger, "train", lambda s, w: seen.extend(s) or {})
    pii.train(empty)
    assert {k for _, spans in seen for *_, k in spans} == {"email", "ip", "card", "phone"}


def test_query_equals_base_rules(spark, tmp_path, monkeypatch):
    import hashlib

    monkeypatch.setattr(pii, "train", lambda docs: pii_tagger.new_model())
    data = [(1, "x@y.org 1.2.3.4 +1 555 123 4567", "en", "s", 1), (2, None, None, None, None), (3, "\U0001f600 a@b.cd", "en", "s", 1)]
    spark.createDataFrame(data, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    for r in pii.op3_pii(spark, str(tmp_path)).collect():
        b = plain_base(data[r["doc_id"] - 1][1] or "")
        listed = [f"{k}:{a}:{z}" for a, z, k in b]
        assert r["base_sha256"] == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert set(listed) <= set(r["spans"].split(",")) or not listed
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(k == x[2] for x in b) for k in ("email", "ip", "card", "phone")]
    assert rows(pii.op3_pii(spark, str(tmp_path)).select("doc_id")) == [(1,), (2,), (3,)]

def test_what_passes_holds_a_trigger_and_is_covered():
    r = random.Random(8)
    parts = ["jane", "roe", "at", "AT", " at ", " At ", " dot ", " DOT ", ".", "(at)", " [ AT ] ", "{dot}", " < Dot > ", "@", " @ ", "x" * 60, "a-b", "7", " ", "dot"]
    listed = ["jane.roe at example.org", "jane dot roe at example.org", "JANE (AT) EXAMPLE (DOT) ORG", "at at b.c", "a at " + "b" * 99 + " dot c"]
    found = 0
    for t in listed + ["".join(r.choice(parts) for _ in range(r.randint(3, 12))) for _ in range(60_000)]:
        if any(pii.passes(k, t) for k in ("email", "ip", "card", "phone")):
            found += 1
            assert pii.TRIGGER.search(t), t
            whole = "q " * 90 + t + " q" * 90
            held = {i for lo, w in pii.windows_of(whole) for i in range(lo, lo + len(w))}
            assert set(range(180, 180 + len(t))) <= held, t
    assert found > 150 and all(pii.passes("email", t) for t in listed)


@pytest.mark.parametrize("t", ["a." * 150_000, "a dot " * 60_000, "a at " * 80_000, "a at b." * 60_000, "a(at)" * 80_000, "a(dot)" * 60_000])
def test_windows_of_long_runs_take_linear_time(t):
    import time

    start = time.time()
    pii.windows_of(t)
    assert time.time() - start < 5


SPELLINGS = ("jane (at) example (dot) org", "x@y.org", "+1 555 123 4567", "10.0.0.1", "4111.1111.1111.1111", "a(dot)b", "the house")


@pytest.mark.parametrize("parts,size", [(("a(dot)",), 360_000), (tuple(f"{s} " for s in SPELLINGS), 1_000_000)])
def test_long_texts_full_of_finds_take_linear_time(parts, size):
    import time

    r, model = random.Random(4), pii_tagger.new_model()
    t = "".join(r.choice(parts) for _ in range(size // min(map(len, parts))))[:size]
    start = time.time()
    base, spans = pii.find([t], model)[0]
    assert time.time() - start < 15  # about 1.5 and 3.5 s on an idle core
    assert set(base) <= set(spans) and sum(b - a for a, b, _ in base) > (0 if len(parts) == 1 else size // 10) - 1


def test_added_spans_never_meet_base_spans():
    r = random.Random(6)
    for _ in range(20):
        t = " ".join(r.choice(SPELLINGS) for _ in range(60))
        base = pii.base_spans(t)
        votes = [(a := r.randrange(len(t) - 30), min(len(t), a + r.randint(4, 30)), k) for k in pii.KINDS for _ in range(400)]
        got = pii.reconcile(t, base, [(0, len(t), [(a, b, k, 1.0) for a, b, k in votes])])
        added = [s for s in got if s not in base]
        assert not any(x < b and a < y for a, b, _ in added for x, y, _ in base)
        assert set(base) <= set(got)
