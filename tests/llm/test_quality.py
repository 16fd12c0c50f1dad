import re
from collections import Counter

import pytest
from conftest_llm import DOCS, text
from pyspark.sql import functions as F

from offerlake.llm.quality import RULES, STOP_WORDS, Rule, compile_rules, counts, features, flat, judge


def plain(t):
    """The base counts, written plainly."""
    w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    windows = Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i, x in enumerate(zip(w, w[1:], w[2:])) if windows[x] > 1 for k in range(3)}
    lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")),
        len(lines) - len(set(lines)), len(covered),
    )


TEXTS = [
    None, "", " \n ", "a", "a b", "a b c", "a b c a b c", "x x x x x x", "a b c d a b c e a b c",
    "one line\none line\n\n \none line", "### $$$ | <b>&amp;</b> 100%", "é ü ß \U0001f600", text(1, 300) + " " + text(1, 300),
    "\x1c\x1d a\x0bb\x0cc\rd", text(5, 4000),
]


def test_counts_equal_a_plain_version(spark):
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(TEXTS)], DOCS)
    for r in judge(docs).collect():
        q = r["__q"]
        got = (q["n_words"], q["word_chars"], q["n_symbols"], q["n_dup_lines"], q["n_repeat_words"])
        assert got == plain(r["text"]), r["text"]
        assert q["base_failed"] == (got[0] < 50 or 100 * got[4] > 50 * got[0])


@pytest.mark.parametrize("rule", RULES, ids=lambda r: r.name)
def test_every_rule_rejects_what_it_names(spark, rule):
    clean = [f"{STOP_WORDS[i % 5]} word{i}" for i in range(60)]
    bad = {
        "word_length": "of " * 3 + " ".join("wordsoverlong" * 2 + str(i) for i in range(60)),
        "symbols": " ".join(f"{x} #" for x in clean),
        "stop_words": " ".join(f"word{i}" for i in range(60)),
        "repeated_lines": " ".join(clean) + "\n" + "the same\n" * 6,
        "upper_case": " ".join(clean).upper(),
        "exclamations": " ".join(f"{x}! loud{i}!" for i, x in enumerate(clean)),
        "ellipsis_lines": "\n".join(f"{x} and so on ..." for x in clean),
    }[rule.name]
    docs = spark.createDataFrame([(1, bad, None, None, None), (2, " ".join(clean), None, None, None)], DOCS)
    got = {r["doc_id"]: r["__q"] for r in judge(docs).collect()}
    assert got[1]["broken_rule"] == rule.name and not got[1]["kept"]
    assert got[2]["broken_rule"] is None and got[2]["kept"]


def test_the_table_is_data(spark):
    docs = spark.createDataFrame([(1, text(1, 60), None, None, None)], DOCS)
    rules = [Rule("few", "n_words", 100, None), Rule("many", "n_words", None, 10)]
    q = judge(docs, rules).first()["__q"]
    assert q["broken_rule"] == "few"
    one = docs.select(counts(F.col("text")).alias("c")).select(compile_rules(rules[1:], features(flat(F.col("c")))).alias("x"))
    assert one.first()["x"] == "many"


def test_the_plan_is_one_projection_without_python(spark):
    docs = spark.createDataFrame([(1, "a", None, None, None)], DOCS)
    plan = judge(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Exchange|Python|Arrow|Pandas|Aggregate", plan)


def test_a_filter_on_the_verdict_counts_once(spark):
    docs = spark.createDataFrame([(1, "a", None, None, None)], DOCS)
    plan = judge(docs).filter("__q.kept").select(*docs.columns)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("xxhash64(") == 1


def test_defined_cases(odd, empty, clashing):
    got = judge(odd)
    assert got.count() == odd.count() and judge(empty).count() == 0
    assert got.filter("text is null and not __q.base_failed").count() == 0
    assert set(clashing.columns) < set(judge(clashing).columns)
