"""A training-corpus pipeline: quality rules, near duplicates, PII, mixing, token ids.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``.  All but the
last return the columns of ``docs``, whatever they are.

Defined cases: an empty table passes through as an empty result; NULL, empty
and blank texts fail the quality rules; rows without an id stay when the rules
keep them; rows that share id and text count as one document, rows that share
an id but not a text as several; a NULL source is a source of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from offerlake.llm import mixing, ngram_join, pieces, pii, quality
from offerlake.session import scratch_path

#: Near duplicates: shingles of five words, Jaccard similarity of at least 0.8.
NEAR = {"width": 5, "percent": 80}


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rule nor the threshold table rejects."""
    return quality.judge(docs).filter("__q.kept").select(*docs.columns)


def keep_first_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document of the smallest id; repeated rows once.

    A document is an id with a text, so that of texts under one id each is
    judged for itself; near copies among them leave the one of the smallest hash.
    """
    name = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", F.xxhash64("text").alias("h")))
    classes = ngram_join.jaccard_classes(docs.select(name.alias("name"), "text"), id_col="name", **NEAR)
    stay = classes.filter("name = component_id").select("name.*").distinct()
    plain = [c for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    same = Window.partitionBy("doc_id", "__h").orderBy(F.xxhash64(*plain))
    hashed = docs.withColumn("__h", F.xxhash64("text"))
    named = hashed.join(stay.withColumnRenamed("h", "__h"), ["doc_id", "__h"], "left_semi")
    once = named.withColumn("__i", F.row_number().over(same)).filter("__i = 1").select(*docs.columns)
    return once.unionAll(docs.filter("doc_id is null"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind; n_chars follows the text."""
    out = pii.redacted(docs, pii.train(docs))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: a document occurs as often as the mix takes it."""
    return mixing.mixed(docs, **mixing.PARAMS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document: doc_id, n_tokens, ids."""
    out = pieces.encode(docs, pieces.vocabulary_path())
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality_rules", keep_good),
    ("near_duplicates", keep_first_of_near_copies),
    ("pii", redact),
    ("mixing", mix),
    ("sentencepiece", encode),
]

#: SQL expresses neither the tagger nor the hashes; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
