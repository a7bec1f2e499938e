"""Corpus pipeline: toxicity, near duplicates, benchmark passages, personal data, mixing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents. A
stage's result is written as Parquet and read again as the next stage's docs.

Defined results: stages decide row by row, whatever the ids: rows that share a doc_id, or have none, are documents of
their own; extra columns pass through all stages with their values, whatever their names; empty tables give empty tables.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobmarket.llm import cgk_decontam, mixing, ngram_join, pii, toxicity
from jobmarket.llm.common import result, scratch, table, written


def _whole(docs: DataFrame) -> Column:
    """All columns of docs as one struct, so that no name that a stage uses can clash."""
    return F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model predicts as toxic go."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored_rows(docs, model).filter("predicted = 0").select("row.*")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the smallest doc_id (null last).

    Rows get numbers of their own, written with them, and the join runs on these."""
    rows = written(docs.select(F.monotonically_increasing_id().alias("doc_id"), _whole(docs)), "rows")
    with scratch(spark):
        found = written(ngram_join.near_duplicates(rows.select("doc_id", "row.text")), "components")
        grouped = found.groupBy("component_id").agg(F.count("*").alias("n")).filter("n > 1").select("component_id")
        members = found.join(grouped, "component_id").join(rows.select("doc_id", F.col("row.doc_id").alias("own")), "doc_id")
        stays = members.groupBy("component_id").agg(F.min(F.struct(F.col("own").isNull().alias("none"), "own", "doc_id")).alias("first"))
        gone = result(members.join(stays, "component_id").filter("doc_id <> first.doc_id").select("doc_id"), "near-duplicates")
    return rows.join(gone, "doc_id", "left_anti").select("row.*")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go. Rows are known by a hash of id and text, on which alone this depends."""
    rows = docs.select(F.xxhash64(docs["doc_id"], docs["text"]).alias("doc_id"), docs["text"], _whole(docs))
    gone = written(cgk_decontam.contaminated(rows.select("doc_id", "text"), table(spark, sf_dir, "benchmark")).select("doc_id").distinct(), "contaminated")
    return rows.join(gone, "doc_id", "left_anti").select("row.*")


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by its kind in brackets; n_chars follows."""
    out = pii.redact(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: every document as often as it is taken, with the copy's number, its size and its source's target."""
    return mixing.mixture(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("pii", personal_data_stage),
    ("mixing", mixing_stage),
]

#: Trained models and hashed rounding have no SQL form; the tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{re.sub('[^a-z]', '-', name)}")
    return STAGES[-1][1](spark, docs, sf_dir)
