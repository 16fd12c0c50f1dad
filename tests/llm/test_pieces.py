import hashlib
import random

import pytest
from conftest_llm import text

from offerlake.llm import pieces

public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def vocabulary():
    with open(pieces.vocabulary_path(), "rb") as f:
        return pieces.Vocabulary(f.read())


def strings():
    r = random.Random(8)
    alphabet = list(" ▁  ab\n\t\x00é漢\U0001f600　​﻿") + ["the", "ing", "<0x41>", "<s>", "</s>", "<unk>", "  "]
    yield from ("", " ", "  ", "▁", " a", "a ", "\n", "<s>", "é" * 50, "漢" * 200, "a" * 5000, text(1, 500))
    for _ in range(4000):
        yield "".join(r.choice(alphabet) for _ in range(r.randint(0, 25)))


def test_ids_and_texts_equal_the_library(vocabulary):
    for s in strings():
        want = vocabulary.library.encode(s)
        assert vocabulary.encode(s) == want, s
        assert vocabulary.decode(want) == vocabulary.library.decode(want), s


def test_decoding_any_ids_equals_the_library(vocabulary):
    r = random.Random(9)
    for _ in range(3000):
        ids = [r.choice((r.randint(0, 400), r.randint(0, 31999))) for _ in range(r.randint(0, 8))]
        assert vocabulary.decode(ids) == vocabulary.library.decode(ids), ids


def test_both_agendas_agree(vocabulary, monkeypatch):
    for s in list(strings())[:1500]:
        short = vocabulary.merge_short(s)
        monkeypatch.setattr(pieces, "SHORT", -1)
        assert vocabulary.merge(s) == short
        monkeypatch.undo()


def test_whole_texts_equal_their_words(vocabulary, monkeypatch):
    for s in list(strings())[:500]:
        by_word = vocabulary.encode(s)
        monkeypatch.setattr(vocabulary, "by_word", False)
        assert vocabulary.encode(s) == by_word
        monkeypatch.undo()


def test_memory_is_bounded_and_does_not_show(vocabulary, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 10)
    vocabulary.memory.clear()
    t = text(3, 400)
    assert vocabulary.encode(t) == vocabulary.library.encode(t)
    assert len(vocabulary.memory) <= 10


def test_differences_find_nothing_and_defined_cases(odd, empty, clashing):
    path = pieces.vocabulary_path()
    assert pieces.differences(odd, path).count() == 0
    for r in pieces.digests(clashing, path).collect():
        if r["n_tokens"] == 0:
            assert r["ids_sha256"] == r["decoded_sha256"] == hashlib.sha256(b"").hexdigest()
    assert pieces.digests(odd, path).count() == odd.count()
    assert pieces.digests(empty, path).count() == 0 and pieces.encode(empty, path).count() == 0


def test_round_trip_and_digests(odd):
    path = pieces.vocabulary_path()
    for r in odd.join(pieces.encode(odd.filter("doc_id > 0"), path), "doc_id").distinct().collect():
        # The word mark itself reads as a space.
        assert r["decoded"] == (r["text"] or "").replace("▁", " ")
    made = {r["doc_id"]: r for r in pieces.digests(odd, path).collect()}
    for r in pieces.encode(odd, path).collect():
        ids = ",".join(map(str, r["ids"]))
        assert made[r["doc_id"]]["n_tokens"] == len(r["ids"]) or r["doc_id"] is None
        if r["doc_id"] is not None:
            assert made[r["doc_id"]]["ids_sha256"] == hashlib.sha256(ids.encode()).hexdigest()


def test_unremembered_words_are_cut_where_no_piece_crosses(vocabulary, monkeypatch):
    """Runs are remembered, so that a word before a line end is known beside any other."""
    for s in list(strings())[:1500]:
        for part in vocabulary.parts(s):
            runs = vocabulary.runs(part)
            assert "".join(runs) == part
            assert [i for r in runs for i in vocabulary.ids_of(r)] == vocabulary.ids_of(part), part
    made = []
    monkeypatch.setattr(vocabulary, "memory", {})
    monkeypatch.setattr(vocabulary, "older", {})
    monkeypatch.setattr(vocabulary, "made", lambda r, make=vocabulary.made: made.append(r) or make(r))
    for t in ("word\nnext", "word\nother", "sword\nnext"):
        assert vocabulary.encode(t) == vocabulary.library.encode(t)
    assert made.count("next") == made.count("\n") == 1


def test_remembered_words_hold_ids_alone(vocabulary, monkeypatch):
    """Decimal lists and texts of hundreds of thousands of words, in every worker, were what an executor ran out of."""
    import gc
    import tracemalloc

    monkeypatch.setattr(vocabulary, "memory", {})
    monkeypatch.setattr(vocabulary, "older", {})
    vocabulary.digest("a word")
    gc.collect()
    tracemalloc.start()
    words = [f"word{i}" for i in range(20_000)]
    at, known = tracemalloc.get_traced_memory()[0], len(vocabulary.memory)
    for w in words:
        vocabulary.digest(w)
    gc.collect()
    held = (tracemalloc.get_traced_memory()[0] - at) / (len(vocabulary.memory) - known)
    tracemalloc.stop()
    assert held < 270, held  # bytes a word: 181; 367 with the decimal list and the text


def test_digests_of_byte_pieces_equal_the_library(vocabulary):
    for s in list(strings())[:1500]:
        ids = vocabulary.library.encode(s)
        want = [hashlib.sha256(t.encode()).hexdigest() for t in (",".join(map(str, ids)), vocabulary.library.decode(ids))]
        assert vocabulary.digest(s) == (len(ids), *want), s


def test_a_worker_keeps_what_it_remembers_for_the_last_operator_alone(vocabulary):
    from offerlake.llm import common, ngram_join

    class Model:
        with open(pieces.vocabulary_path(), "rb") as f:
            id, value = "m", f.read()

    v = pieces.load(Model)
    assert pieces.load(Model) is v
    ngram_join.word_hashes("some words")
    assert list(common._kept) == ["word hashes"]
    assert pieces.load(Model) is not v and len(common._kept) == 1


def test_parts_of_texts_with_single_spaces_equal_the_pattern(vocabulary):
    for s in [*strings(), "a b", "a  b", " a b", "a b ", "a\nb c", "\u2581a b"]:
        assert vocabulary.parts(s) == (pieces.WORDS.findall(pieces.MARK + s.replace(" ", pieces.MARK)) if s else [])


def test_line_ends_are_decoded_without_a_walk_over_bytes(vocabulary, monkeypatch):
    texts = ["a\nb\tc\n\n", "\n", "one\r\ntwo \x00", "x\ny", " \n ▁\n"]
    wants = [hashlib.sha256(vocabulary.library.decode(vocabulary.library.encode(t)).encode()).hexdigest() for t in texts]
    mixed = "é漢\U0001f600\n漢a\n" * 3
    want = hashlib.sha256(vocabulary.library.decode(vocabulary.library.encode(mixed)).encode()).hexdigest()
    assert vocabulary.digest(mixed)[2] == want
    monkeypatch.setattr(vocabulary, "raw", lambda *_, **__: pytest.fail("a text of ASCII was walked byte by byte"))
    assert [vocabulary.digest(t)[2] for t in texts] == wants
