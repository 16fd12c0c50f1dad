import textwrap

import pytest
from conftest_llm import DOCS

from offerlake.llm.licence_texts import HEADERS, NOTICES, TEXTS
from offerlake.llm.licences import known, licence_folder, op5_licence_scan, scan

MIT = next(t for k, t in TEXTS if k == "MIT")


@pytest.fixture(scope="module")
def licences(spark):
    return known(spark).cache()


def licence(spark, licences, *texts):
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCS)
    return [r["__licence"] for r in sorted(scan(docs, licences).collect(), key=lambda r: r["doc_id"])]


def test_every_known_text_is_found(spark, licences):
    assert licence(spark, licences, *[t for _, t in TEXTS + NOTICES]) == [k for k, _ in TEXTS + NOTICES]


def test_what_does_not_count(spark, licences):
    variants = [
        MIT.upper(), MIT.replace("\n", "  \r\n\t"), MIT.replace(",", " ").replace('"', "“"),
        "Copyright (c) 2021 A. Person\n© 2020 Another\n(C) 1999 x\n\n" + MIT + "\n  All rights reserved.",
        MIT.replace("sublicense", "sublicence").replace("NONINFRINGEMENT", "NON-INFRINGEMENT"),
    ]
    assert licence(spark, licences, *variants) == ["MIT"] * len(variants)


def test_other_words_and_parts_do_not_match(spark, licences):
    assert licence(spark, licences, MIT + " and more", MIT[:200], MIT.replace("copyright notice", "notice"), "", None, "  \n ") == [None] * 6


def test_notice_lines(spark, tmp_path):
    docs = [
        (1, "words\n" + NOTICES[0][1] + "\nmore\n" + NOTICES[4][1].upper(), "en", "s", 1), (2, None, None, None, None),
        (3, "in a sentence: " + NOTICES[0][1], "en", "s", 1), (3, MIT, "en", "s", 1),
    ]
    spark.createDataFrame(docs, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((r["doc_id"], r["licence"] or "", r["notices"]) for r in op5_licence_scan(spark, str(tmp_path)).collect())
    assert got == [(1, "", "CC-BY-NC-4.0,MIT"), (2, "", ""), (3, "", ""), (3, "MIT", "")]


def test_defined_cases(odd, empty, clashing, licences):
    assert scan(odd, licences).count() == odd.count() and scan(empty, licences).count() == 0
    assert set(clashing.columns) < set(scan(clashing, licences).columns)
    assert scan(odd, licences.limit(0)).filter("__licence is not null").count() == 0


@pytest.mark.parametrize("width", [9, 30, 41, 60, 72, 100, 10**6])
def test_known_texts_at_other_widths(spark, licences, width):
    wrapped = [textwrap.fill(" ".join(t.split()), width, break_long_words=False, break_on_hyphens=False) for _, t in TEXTS]
    assert licence(spark, licences, *wrapped) == [k for k, _ in TEXTS]


def test_lines_that_state_a_holder_are_dropped(spark, licences):
    stated = ["Copyright (c) 2021 A. Person", "Copyright © Notice Ltd", "copyright 1999-2004 Holder", "COPYRIGHT Jane Roe", "Copyright by the authors of x", "* Copyright: The Example Authors"]
    assert licence(spark, licences, *[c + "\n\n" + MIT for c in stated]) == ["MIT"] * len(stated)


def test_a_folder_of_reference_texts(spark, tmp_path):
    long = "\n".join(f"Section {i}. You may copy the Work under term {i}, see the copyright notice." for i in range(20_000))
    (tmp_path / "texts").mkdir()
    for name, text in (("Long-1.0", long), ("House+Rules-2", "Ask the owner first."), ("Blank", " \n"), ("MIT-copy", MIT)):
        (tmp_path / "texts" / f"{name}.txt").write_text(text)
    (tmp_path / "texts" / "README.md").write_text("no licence")
    docs = [(1, long.upper().replace("\n", " "), "en", "s", 1), (2, "ask the owner\nfirst", "en", "s", 1), (3, MIT, "en", "s", 1),
            (4, "no licence", "en", "s", 1), (5, None, "en", "s", 1), (6, long[:-1000], "en", "s", 1)]
    spark.createDataFrame(docs, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    reference = licence_folder(spark, str(tmp_path / "texts"))
    got = {r["doc_id"]: r["licence"] for r in op5_licence_scan(spark, str(tmp_path), reference).collect()}
    assert got == {1: "Long-1.0", 2: "House+Rules-2", 3: "MIT", 4: None, 5: None, 6: None}


def test_reference_rows_that_name_nothing(spark):
    rows = spark.createDataFrame([(None, "some text"), ("x", None), ("y", ""), ("b", "one text"), ("a", "One text!")], "licence string, text string")
    assert sorted(r["licence"] for r in known(spark, NOTICES[:1], rows).collect()) == ["MIT", "a"]


def test_headers_under_a_holder(spark, licences):
    texts = [f"Copyright (C) 2020 Jane Roe <jane@example.org>\n\n{t}" for _, t in HEADERS]
    assert licence(spark, licences, *texts) == [k for k, _ in HEADERS]
