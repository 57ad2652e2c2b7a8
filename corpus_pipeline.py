"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again as the next one's input.

A stage takes (spark, docs, sf_dir) and returns a frame; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairscore.llm import decontaminate, language, minhash, mixing, pii
from pairscore.llm.common import store

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _kept(docs: DataFrame, judged: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id ``judged`` keeps."""
    kept = judged.where("kept").select("doc_id").where("doc_id is not null").distinct()
    return docs.select(*COLUMNS).join(kept, "doc_id", "left_semi").select(*COLUMNS)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is certain enough; those rejected go, and ``lang`` is the language found. A repeated
    doc_id keeps the rows of which one is kept, with the smallest language of these; a null doc_id goes."""
    found = (language.identify(docs.select(*COLUMNS)).where("kept and doc_id is not null")
             .groupBy("doc_id").agg(F.min("language").alias("_language")))
    return (docs.select(*COLUMNS).join(found, "doc_id")
            .select("doc_id", "text", F.col("_language").alias("lang"), "source", "n_chars"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity of 0.8 or more); documents without
    words are no duplicates. Of rows that repeat a doc_id the smallest stays."""
    kept = _kept(docs, minhash.near_duplicates(docs, width=5, percent=80))
    again = store(kept.groupBy("doc_id").agg(F.count("*").alias("c")).where("c > 1").select("doc_id"), "pipeline-again")
    if again.isEmpty():
        return kept
    one = (kept.join(again, "doc_id", "left_semi").groupBy("doc_id")
           .agg(F.min(F.struct(*COLUMNS[1:])).alias("r")).select("doc_id", "r.*"))
    return kept.join(again, "doc_id", "left_anti").unionByName(one)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item."""
    benchmark = spark.read.parquet(os.path.join(sf_dir, "benchmark.parquet"))
    return _kept(docs, decontaminate.decontaminate(docs, benchmark))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the spans of personal data replaced by their kind; n_chars counts the new text."""
    carried = pii.detect(docs.select(*COLUMNS), mask=True, carry=["lang", "source", "n_chars"])
    length = F.when(F.col("masked").isNull(), F.col("n_chars")).otherwise(F.length("masked").cast("long"))
    return carried.select("doc_id", F.col("masked").alias("text"), "lang", "source", length.alias("n_chars"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Poisson replicas of the documents at the target weights of their sources, shuffled globally."""
    return mixing.replicate(docs.select(*COLUMNS))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", mask_personal_data),
    ("mixing", mix_sources),
]

#: Near duplicates, trigram models and the tagger are not for SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
