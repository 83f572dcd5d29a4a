"""The corpus pipeline over ``documents``: rule filter, line dedup, near-duplicate join, decontamination, mixing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitflow.llm import decontaminate, lines, mixing, ngram_join, quality
from visitflow.llm.common import written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the rules reject."""
    return quality.quality_rules(docs).where("kept").select(COLUMNS)


def apply_line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the repeated lines; ``n_chars`` follows the text."""
    return lines.line_dedup(docs).withColumn("n_chars", F.char_length("text").cast("long")).select(COLUMNS)


def apply_ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies, the one with the smallest id."""
    return ngram_join.deduplicated(docs).select(COLUMNS)


def apply_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that contain a benchmark passage."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.decontaminated(docs, benchmark).select(COLUMNS)


def apply_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents until the sources meet their targets."""
    return mixing.mix(docs).select(COLUMNS)


STAGES = [
    ("quality_rules", apply_quality_rules),
    ("line_dedup", apply_line_dedup),
    ("ngram_jaccard_join", apply_ngram_join),
    ("benchmark_decontamination", apply_decontamination),
    ("mixing", apply_mixing),
]

# Not expressible in SQL: the near-duplicate groups and the fingerprints are
# tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read again, as by the stage runner."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
