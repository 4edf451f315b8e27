"""Corpus pipeline: quality rules, language ID, n-gram Jaccard join, best-fit packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next one's ``docs``.  The first three return rows of ``documents`` with the columns they came with:

- quality rules: rows that the rules keep;
- language ID: rows in an identified language, by a model and thresholds learned from the rows that came in;
- n-gram Jaccard join: one row of each group of near duplicates, that of the least doc_id;
- best-fit packing: a row for every piece, with its sequence and its place there.

Nulls, empty texts, repeated rows and empty tables have the results that the operators state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerfold.llm import jaccard_join, language_id, packing, quality_rules
from ledgerfold.llm.token_files import scratch


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_quality(docs)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language_id.fit(docs.filter(~F.coalesce(language_id.held_out(F.col("doc_id")), F.lit(False))), reject=True)
    return language_id.keep_identified(docs, model)


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.drop_near_duplicates(spark, docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(spark, docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("language_id", language_stage),
    ("jaccard_join", jaccard_stage),
    ("best_fit_packing", packing_stage),
]

#: MinHash, a trained model and a tokenizer are beyond SQL; tests/llm hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the whole documents table."""
    folder = scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
