"""The registered queries: each operator over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from visitflow.llm import (
    decontaminate,
    html_text,
    lines,
    lm_score,
    mixing,
    negatives,
    ngram_join,
    quality,
    secrets,
    spelling,
    suffixes,
    toxicity,
    urls,
)


def _over(table: str, query: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: query(spark.read.parquet(f"{sf_dir}/{table}.parquet"))


def _over_two(one: str, two: str, query: Callable[[DataFrame, DataFrame], DataFrame]):
    return lambda spark, sf_dir: query(*(spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in (one, two)))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_decontamination": _over_two("documents", "benchmark", decontaminate.query),
        "op2_lm_score": _over("documents", lm_score.query),
        "op3_toxicity": _over_two("documents", "labels", toxicity.query),
        "op4_ngram_jaccard_join": _over("documents", ngram_join.query),
        "op5_url_filter": _over("pages", urls.query),
        "op6_secret_scan": _over("documents", secrets.query),
        "op7_mixing": _over("documents", mixing.query),
        "op8_quality_rules": _over("documents", quality.query),
        "op9_html_text": _over("pages", html_text.query),
        "op10_line_dedup": _over("documents", lines.query),
        "op11_suffix_dedup": _over("documents", suffixes.query),
        "op12_spelling_variants": _over("documents", spelling.query),
        "op13_hard_negatives": _over("embeddings", negatives.query),
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_decontamination": decontaminate.ORACLE,
        "op4_ngram_jaccard_join": ngram_join.ORACLE,
        "op5_url_filter": urls.oracle(),
        "op7_mixing": mixing.ORACLE,
        "op8_quality_rules": quality.oracle(),
        "op10_line_dedup": lines.ORACLE,
        "op13_hard_negatives": negatives.ORACLE,
    }
