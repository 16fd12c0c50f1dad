import importlib.util
import random
from pathlib import Path

import pytest
from conftest_llm import DOCS, rows, text

from offerlake.llm import mixing, pii, quality
from offerlake.llm.pieces import Vocabulary, vocabulary_path

pytest.importorskip("public_tokenizers")

_path = Path(__file__).resolve().parents[2] / "corpus_pipeline.py"
_spec = importlib.util.spec_from_file_location("corpus_pipeline", _path)
pipeline = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(pipeline)


def sentence(seed, n):
    """Clean prose: function words among others."""
    r = random.Random(seed)
    return " ".join(r.choice(("the", "of", "and", "in")) + " " + text(r.randint(0, 10**9), 1) for _ in range(n))


@pytest.fixture(scope="module")
def documents():
    out = []
    for i in range(40):
        t = sentence(i, 60)
        out.append((10 * i, t, "en", f"s{i % 4}", len(t)))
        if i % 4 == 0:
            near = t.split()
            near[7] = "changed"
            out.append((10 * i + 3, " ".join(near), "en", "copies", 1))
        if i % 10 == 0:
            out.append((10 * i + 5, t.replace(" of ", " # of # ") + " ###", "en", "junk", 1))
    out += [(999, sentence(500, 60) + " mail x.y@example.org", "en", "s1", 1), (1000, None, None, None, None), (1001, "", "en", "s1", 0)]
    out += [out[0], (None, sentence(501, 60), "en", None, 1)]
    return out


def shingle_sets(t, width=5):
    w = t.encode().lower().split()
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}


@pytest.fixture(scope="module")
def stages(spark, documents, tmp_path_factory):
    """The input and each stage's output."""
    docs, out = spark.createDataFrame(documents, DOCS), []
    for name, stage in pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, "").write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def test_stages_are_named_in_order():
    assert [n for n, _ in pipeline.STAGES] == ["quality_rules", "near_duplicates", "pii", "mixing", "sentencepiece"]


def test_quality_keeps_clean_documents_only(spark, documents, stages):
    want = quality.judge(spark.createDataFrame(documents, DOCS)).filter("__q.kept").select("doc_id", "text")
    assert rows(stages[0].select("doc_id", "text")) == rows(want)
    kept = {r["doc_id"] for r in stages[0].collect()}
    assert {10 * i for i in range(40)} <= kept and not kept & {5, 105, 1000, 1001}


def test_one_document_of_each_group_stays(stages):
    before = [(r["doc_id"], r["text"]) for r in stages[0].collect()]
    after = sorted((r["doc_id"] for r in stages[1].collect()), key=repr)
    kept, named = [], sorted((x for x in set(before) if x[0] is not None))
    for i, t in named:  # groups here are cliques, so the first of each is what stays
        a = shingle_sets(t)
        if not any(5 * len(a & b) >= 4 * len(a | b) for b in map(shingle_sets, (t for _, t in kept))):
            kept.append((i, t))
    assert after == sorted([i for i, _ in kept] + [None], key=repr)


def test_texts_that_share_an_id_are_judged_each_for_itself(spark):
    t = sentence(900, 60)
    near = " ".join(["changed", *t.split()[1:]])
    other, third = sentence(901, 60), sentence(902, 60)
    data = [(1, t), (2, other), (2, near), (2, other), (3, third), (3, third + " more"), (None, t)]
    docs = spark.createDataFrame([(i, x, "en", "s", 1) for i, x in data], DOCS)
    kept = sorted(((r["doc_id"], r["text"]) for r in pipeline.keep_first_of_near_copies(spark, docs, "").collect()), key=repr)
    assert len(kept) == 4 and (1, t) in kept and (2, other) in kept and (None, t) in kept
    assert [x for i, x in kept if i == 3][0] in (third, third + " more")


def test_personal_data_goes_and_the_rest_stays(stages):
    before = {r["doc_id"]: r["text"] for r in stages[1].collect()}
    for r in stages[2].collect():
        assert pii.base_spans(r["text"]) == [] and r["n_chars"] == len(r["text"])
        if r["doc_id"] == 999:
            assert r["text"].endswith("mail <EMAIL>")
        elif "<" not in r["text"]:
            assert r["text"] == before[r["doc_id"]]


def test_documents_occur_as_often_as_the_mix_takes_them(stages):
    times = mixing.mix(stages[2], **mixing.PARAMS).select("doc_id", "__times").collect()
    want = sorted((r["doc_id"] for r in times for _ in range(r["__times"])), key=repr)
    assert sorted((r["doc_id"] for r in stages[3].collect()), key=repr) == want


def test_ids_equal_the_library(stages):
    with open(vocabulary_path(), "rb") as f:
        library = Vocabulary(f.read()).library
    texts = {r["doc_id"]: r["text"] for r in stages[3].collect()}
    got = stages[4].collect()
    assert len(got) == stages[3].count()
    for r in got:
        assert r["ids"] == library.encode(texts[r["doc_id"]]) and r["n_tokens"] == len(r["ids"])


def test_run_chains_the_stages(spark, documents, stages, tmp_path):
    spark.createDataFrame(documents, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    assert rows(pipeline.run(spark, str(tmp_path))) == rows(stages[4])


def test_columns_pass_through(spark, clashing, empty):
    for docs in (clashing, empty):
        now = docs
        for _, stage in pipeline.STAGES[:-1]:
            now = stage(spark, now, "")
            assert now.columns == docs.columns
    assert pipeline.STAGES[-1][1](spark, now, "").count() == 0
