"""Run sessionization where every input task fails on its first attempt
(Spark retries it) and print whether the result equals an undisturbed run."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark.sql import SparkSession  # noqa: E402

from visitflow.operators.clean import clean_log_types  # noqa: E402
from visitflow.operators.cut import time_gap_cut  # noqa: E402
from visitflow.operators.sessionize import assign_sessions, build_sessions  # noqa: E402
from visitflow.sources.tables import track_log_from_events  # noqa: E402


def flaky(batches):
    from pyspark import TaskContext

    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("injected task failure")
    yield from batches


def main() -> None:
    spark = (
        SparkSession.builder.master("local[4,4]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    logs = clean_log_types(track_log_from_events(spark, sys.argv[1])).persist()
    rule = time_gap_cut("6 hours")
    ok = True
    for fn in (build_sessions, assign_sessions):
        expected = sorted(map(tuple, fn(logs, rule, num_partitions=7).collect()))
        got = sorted(map(tuple, fn(logs.mapInArrow(flaky, logs.schema), rule, num_partitions=7).collect()))
        ok &= got == expected and len(got) > 0
    print("RETRY_RESULT", ok)
    spark.stop()


if __name__ == "__main__":
    main()
