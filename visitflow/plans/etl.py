"""The session ETL: logs → clean → sessions → labels → two datasets."""

from __future__ import annotations

import logging
import sys
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from visitflow.operators.clean import clean_log_types
from visitflow.operators.cut import CutRule, pageview_cut
from visitflow.operators.enrich import label_cookies, label_domains, session_record
from visitflow.operators.sessionize import ROWS_PER_CHUNK, build_sessions, heavy_cookies
from visitflow.schema import LOG_TYPES
from visitflow.sources.sinks import check_format, write_outputs
from visitflow.sources.staging import staged
from visitflow.sources.text import read_cookie_labels, read_track_log

# The job's configuration keys and their defaults, kept equal
# to the existing job's so the same spark-submit --conf settings work.
CONF_VISIT_LOG = "spark.SessionCutEtl.visitLogsInputPath"
CONF_COOKIE_LABELS = "spark.SessionCutEtl.cookieLogsLabelPath"
CONF_OUTPUT = "spark.SessionCutEtl.outputPath"
log = logging.getLogger("visitflow.etl")

DEFAULT_PATHS = {
    CONF_VISIT_LOG: "data/visit_log.txt",
    CONF_COOKIE_LABELS: "data/cookie_label.txt",
    CONF_OUTPUT: "data/output",
}


def session_etl(
    logs: DataFrame,
    labels: DataFrame,
    domains: DataFrame | None = None,
    *,
    cut: CutRule | None = None,
    types=LOG_TYPES,
    mode: str = "FAILFAST",
    num_partitions: int | None = None,
    rows_per_chunk: int = ROWS_PER_CHUNK,
    session_ids: str = "hash",
    unique_labels: bool = False,
) -> DataFrame:
    """Labelled sessions (ten columns) from parsed logs, as one lazy plan."""
    kept = clean_log_types(logs, types)
    sessions = build_sessions(
        kept, cut or pageview_cut(), mode=mode, num_partitions=num_partitions, rows_per_chunk=rows_per_chunk, session_ids=session_ids
    )
    sessions = label_domains(sessions, domains, mode=mode)
    heavy = heavy_cookies(kept, rows_per_chunk)
    return session_record(label_cookies(sessions, labels, unique_labels=unique_labels, heavy=heavy))


@dataclass
class EtlResult:
    session_total: int
    output_path: str
    fmt: str


def _qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system and without ``.``, as Hadoop writes it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString().rstrip("/") + "/"


def _under(spark: SparkSession, child: str, parent: str) -> bool:
    return _qualified(spark, child).startswith(_qualified(spark, parent))


def run_session_etl(
    spark: SparkSession,
    visit_log_path: str | None = None,
    cookie_label_path: str | None = None,
    output_path: str | None = None,
    fmt: str = "text",
    *,
    cut: CutRule | None = None,
    domains: DataFrame | None = None,
    mode: str = "FAILFAST",
    session_ids: str = "hash",
    unique_labels: bool = False,
) -> EtlResult:
    """Run the whole job.  Paths not given come from the session conf keys
    ``spark.SessionCutEtl.*`` (then the defaults).  Each output dataset is
    overwritten; nothing else under ``output_path`` is touched."""
    conf = spark.conf
    visit_log_path = visit_log_path or conf.get(CONF_VISIT_LOG, DEFAULT_PATHS[CONF_VISIT_LOG])
    cookie_label_path = cookie_label_path or conf.get(CONF_COOKIE_LABELS, DEFAULT_PATHS[CONF_COOKIE_LABELS])
    output_path = output_path or conf.get(CONF_OUTPUT, DEFAULT_PATHS[CONF_OUTPUT])
    check_format(fmt)
    for p in (visit_log_path, cookie_label_path):
        if _under(spark, p, output_path):
            raise ValueError(f"input {p} lies under the output path {output_path}")

    labels = read_cookie_labels(spark, cookie_label_path, mode)
    # The text is read once; the log dataset and the sessions read the staged rows.
    with staged(read_track_log(spark, visit_log_path, mode), "parsed-logs") as parsed:
        sessions = session_etl(
            parsed.df, labels, domains, cut=cut, mode=mode, session_ids=session_ids, unique_labels=unique_labels
        )
        # The count is observed during the single sessions write, so random
        # (uuid) ids are generated once and the total matches what is written.
        total = write_outputs(parsed.df, sessions, output_path, fmt)
    log.info("sessions written: %d (%s, %s)", total, output_path, fmt)
    return EtlResult(session_total=total, output_path=output_path, fmt=fmt)


def main(args: list[str] | None = None) -> EtlResult:
    """``spark-submit run_etl.py [text|parquet]``; paths come from the conf keys."""
    args = sys.argv[1:] if args is None else args
    if len(args) > 1:
        raise SystemExit("usage: run_etl.py [text|parquet]")
    spark = SparkSession.builder.appName("visitflow-etl").getOrCreate()
    result = run_session_etl(spark, fmt=check_format(args[0] if args else "text"))
    print(f"{result.session_total} sessions written to {result.output_path} as {result.fmt}")
    return result
