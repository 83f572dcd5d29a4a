"""Output datasets ``<base>/trackerlog`` and ``<base>/trackerSession``."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from visitflow.functions.columns import json_line
from visitflow.schema import LOG_COLUMNS, SESSION_COLUMNS, TRACKER_LOG, TRACKER_SESSION
from visitflow.sources.staging import exists, move, remove

FORMATS = ("text", "parquet")
# The dataset folders.
LOG_DIR = "trackerlog"
SESSION_DIR = "trackerSession"


def check_format(fmt: str) -> str:
    if fmt not in FORMATS:
        raise ValueError(f"output format must be one of {FORMATS}, got {fmt!r}")
    return fmt


def write_dataset(df: DataFrame, path: str, columns: list[str], fmt: str) -> None:
    """Overwrite ``path`` (this dataset only) with ``columns`` of ``df``:
    one JSON object per line (``text``) or Parquet."""
    writer_input = df.select(json_line(*columns).alias("value")) if check_format(fmt) == "text" else df.select(*columns)
    writer = writer_input.write.mode("overwrite")
    if fmt == "text":
        writer.text(path)
    else:
        writer.parquet(path)


def write_outputs(parsed_logs: DataFrame, sessions: DataFrame, base: str, fmt: str = "text") -> int:
    """Write all parsed logs (every type, before cleaning) and the labelled
    sessions; return the number of sessions, observed during the write
    instead of by a separate counting job.

    Both are written beside their targets and exchanged at the end: a failure
    before that leaves both old datasets, one during the exchange brings them
    back.
    """
    check_format(fmt)
    spark, base = sessions.sparkSession, base.rstrip("/")
    beside = f"{base}/_publishing-{uuid.uuid4().hex[:12]}"
    try:
        write_dataset(parsed_logs, f"{beside}/{LOG_DIR}", LOG_COLUMNS, fmt)
        obs = Observation("sessions")
        observed = sessions.observe(obs, F.count(F.lit(1)).alias("session_total"))
        write_dataset(observed, f"{beside}/{SESSION_DIR}", SESSION_COLUMNS, fmt)
        total = int(obs.get["session_total"])
        publish(spark, beside, base, [LOG_DIR, SESSION_DIR])
    finally:
        remove(spark, beside)
    return total


def publish(spark: SparkSession, beside: str, base: str, names: list[str]) -> None:
    """Put ``beside/name`` in the place of ``base/name`` for all names, or leave all as they were."""
    undo: list[tuple[str, str]] = []

    def step(old: str, new: str) -> None:
        move(spark, old, new)
        undo.append((new, old))

    try:
        for name in names:
            if exists(spark, f"{base}/{name}"):
                step(f"{base}/{name}", f"{beside}/old/{name}")
            step(f"{beside}/{name}", f"{base}/{name}")
    except BaseException:
        for new, old in reversed(undo):
            move(spark, new, old)
        raise


def read_dataset(spark, path: str, kind: str, fmt: str) -> DataFrame:
    """Read an output dataset back with its declared schema."""
    schema = {"log": TRACKER_LOG, "session": TRACKER_SESSION}[kind]
    if check_format(fmt) == "text":
        return spark.read.schema(schema).json(path)
    return spark.read.parquet(path).select(*[f.name for f in schema.fields])
