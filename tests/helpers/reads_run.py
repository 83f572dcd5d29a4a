"""Rows read from the text log, as the event log counts them, for one action.

Usage: reads_run.py (assign|build|job) <lines> ; prints ``READS <rows read / lines>``.
"""

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark.sql import SparkSession

from visitflow.operators.cut import time_gap_cut
from visitflow.operators.sessionize import assign_sessions, build_sessions
from visitflow.plans.etl import run_session_etl
from visitflow.sources.text import read_track_log

what, lines = sys.argv[1], int(sys.argv[2])
home = tempfile.mkdtemp(prefix="visitflow-reads-")
events = os.path.join(home, "events")
os.makedirs(events)
log = os.path.join(home, "log.txt")
with open(log, "w") as f:
    for i in range(lines):
        cookie = "hot" if i % 3 == 0 else f"c{i % 50}"
        f.write(f"{'pageview' if i % 4 == 0 else 'click'}|2024-01-01 {i % 24:02d}:{i % 60:02d}:00|{cookie}|1.1.1.1|http://a.com/{i}\n")
labels = os.path.join(home, "labels.txt")
with open(labels, "w") as f:
    f.write("hot|x")
spark = (
    SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
    .config("spark.eventLog.enabled", "true").config("spark.eventLog.compress", "false").config("spark.eventLog.dir", f"file://{events}").getOrCreate()
)
if what == "job":
    run_session_etl(spark, log, labels, os.path.join(home, "out"), "parquet")
    staged = glob.glob(os.path.join(spark.sparkContext.getCheckpointDir().removeprefix("file:"), "parsed-logs*"))
    print("STAGED LEFT", len(staged))
else:
    run = assign_sessions if what == "assign" else build_sessions
    out = run(read_track_log(spark, log), time_gap_cut(), rows_per_chunk=100)
    rows = out.collect()
    print("SORT AGGREGATE", "SortAggregate" in out._jdf.queryExecution().executedPlan().toString())
spark.stop()
text_stages, read = set(), 0
for path in glob.glob(os.path.join(events, "**", "*"), recursive=True):
    if not os.path.isfile(path) or path.endswith(".crc"):
        continue
    with open(path) as f:
        found = [json.loads(line) for line in f if line.startswith("{")]
    for e in found:
        if e["Event"] == "SparkListenerStageSubmitted":
            info = e["Stage Info"]
            if any("FileScan text" in r["Name"] or "Scan text" in str(r.get("Scope", "")) for r in info["RDD Info"]):
                text_stages.add(info["Stage ID"])
    for e in found:
        if e["Event"] == "SparkListenerTaskEnd" and e["Stage ID"] in text_stages:
            read += e["Task Metrics"]["Input Metrics"]["Records Read"]
print("READS", round(read / lines, 2))
