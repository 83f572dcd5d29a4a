"""Pipe-separated text sources: the visit log and the cookie-label file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitflow.functions.columns import DROPMALFORMED, check_mode, field, split_fields
from visitflow.schema import COOKIE, DEFAULT_DOMAIN_LABELS, LOG_COLUMNS, ORDER


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines (``value``) plus ``log_order``: file, split and place in the
    split, which is the input's own order however Spark packs the files."""
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )
    return spark.read.text(path).select("value", place.alias(ORDER))


def _require(ok, mode: str, what: str):
    if check_mode(mode) == DROPMALFORMED:
        return ok
    return F.when(ok, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit(f"malformed {what} line: "), F.col("value"))))


def parse_track_log(lines: DataFrame, mode: str = "FAILFAST") -> DataFrame:
    """Visit-log lines → log rows.  Lines starting with ``#`` are comments;
    fields 0-4 are log_type, log_server_time, cookie, ip, url (extra fields
    ignored); fewer than five fields is malformed (error or dropped)."""
    fields = split_fields(F.col("value"))
    # one condition, so that a comment never reaches the check that raises
    is_data = F.when(F.col("value").startswith("#"), F.lit(False)).otherwise(_require(F.size(fields) >= 5, mode, "visit log"))
    data = lines.where(is_data)
    order = [F.col(ORDER)] if ORDER in lines.columns else [F.monotonically_increasing_id().alias(ORDER)]
    return data.select(*[field(fields, i).alias(name) for i, name in enumerate(LOG_COLUMNS)], *order)


def read_track_log(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    return parse_track_log(read_lines(spark, path), mode)


def parse_cookie_labels(lines: DataFrame, mode: str = "FAILFAST") -> DataFrame:
    """``cookie|label`` lines → (cookie, cookie_label); no comment lines."""
    fields = split_fields(F.col("value"))
    data = lines.where(_require(F.size(fields) >= 2, mode, "cookie label"))
    return data.select(field(fields, 0).alias(COOKIE), field(fields, 1).alias("cookie_label"))


def read_cookie_labels(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    return parse_cookie_labels(spark.read.text(path), mode)


def default_domain_labels(spark: SparkSession) -> DataFrame:
    """The fixed four-entry domain → label dimension."""
    return spark.createDataFrame(list(DEFAULT_DOMAIN_LABELS), "domain string, domain_label string")
