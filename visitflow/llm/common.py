"""Helpers shared by the operators: scratch tables, word rules, guarded broadcast."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space that ends a word, as a Java/DuckDB pattern.
SPACE = r"[\x20\x09-\x0D]"
NOT_SPACE = r"[^\x20\x09-\x0D]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor sees: ``spark.checkpoint.dir``.

    A private folder is set only in local mode (tests); a cluster that names
    none gets an error, because executors do not share local folders.
    """
    sc = spark.sparkContext
    named = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="visitflow-llm-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back.

    Cuts lineage: a lost executor loses nothing, later reads see the same
    rows, and the planner knows the table's size.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/visitflow-{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else (``lower`` alone also changes other letters)."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def words(text: Column) -> Column:
    """The runs of other than white space, in order; empty array for a text without words."""
    trimmed = F.btrim(text, F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE + "+"))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A lambda variable is not inlined by the optimizer, an alias is.
    """
    return F.element_at(F.transform(F.array(value), body), 1)
