"""Slices of heavy cookies, reads of the log, staging, publishing and clean errors."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest
from conftest import SF_SMALL, lines_df
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from visitflow.operators.clean import clean_log_types
from visitflow.operators.cut import pageview_cut, time_gap_cut
from visitflow.operators.enrich import label_cookies
from visitflow.operators.sessionize import CHUNK, _chunked, assign_sessions, build_sessions, heavy_cookies
from visitflow.plans.etl import run_session_etl, session_etl
from visitflow.sources import sinks
from visitflow.sources.staging import staged
from visitflow.sources.tables import track_log_from_events
from visitflow.sources.text import parse_cookie_labels, parse_track_log

LOGS = "log_type string, log_server_time string, cookie string, ip string, url string, log_order long"


def _one_cookie(spark, n, time):
    rows = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "pageview").otherwise("click").alias("log_type"),
        time(F.col("id")).alias("log_server_time"),
        F.lit("c").alias("cookie"),
        F.lit("1.1.1.1").alias("ip"),
        F.concat(F.lit("http://a.com/"), F.col("id").cast("string")).alias("url"),
        F.col("id").alias("log_order"),
    )
    return rows


def _in_an_hour(i):
    late = F.date_format(F.timestamp_seconds(F.lit(1_700_000_000) + i % 3600), "yyyy-MM-dd HH:mm:ss")
    return F.when(i == 0, F.lit("2019-01-01 00:00:00")).otherwise(late)


def _in_a_second(i):
    return F.lit("2024-01-01 00:00:00")


def _unreadable(i):
    return F.concat(F.lit("t"), F.lpad(i.cast("string"), 9, "0"))


@pytest.mark.parametrize("time", [_in_an_hour, _in_a_second, _unreadable])
@pytest.mark.parametrize("per", [50, 1000])
def test_no_slice_is_much_larger_than_asked(spark, time, per):
    """Rows in a burst, in one second, or without readable times are divided by rank."""
    rows = _one_cookie(spark, 20_000, time)
    chunked = _chunked(rows, pageview_cut(), "FAILFAST", per, None).groupBy(CHUNK).count().collect()
    assert max(r["count"] for r in chunked) <= 2 * per
    assert len(chunked) <= 4 * 20_000 / per
    assert sum(r["count"] for r in chunked) == 20_000


@pytest.mark.parametrize("time", [_in_an_hour, _in_a_second])
@pytest.mark.parametrize("cut", [pageview_cut(), time_gap_cut("1 second"), time_gap_cut("100 days")], ids=["pageview", "second", "one"])
def test_sessions_do_not_depend_on_the_slices(spark, time, cut):
    """Also a session that runs through every slice (the last rule cuts once)."""
    rows = _one_cookie(spark, 600, time)
    found = []
    for per in (1, 7, 90, 1_000_000):
        found.append(sorted(map(tuple, build_sessions(rows, cut, rows_per_chunk=per).collect())))
        seqs = assign_sessions(rows, cut, rows_per_chunk=per).select("log_order", "session_seq").collect()
        found.append(sorted(map(tuple, seqs)))
    assert found[2::2] == found[:1] * 3
    assert found[3::2] == found[1:2] * 3


def test_borders_are_bounded_and_even(spark, monkeypatch):
    """With more borders than may be broadcast, all cookies get wider slices."""
    from visitflow.operators import sessionize

    monkeypatch.setattr(sessionize, "MOST_BORDERS", 10)
    rows = _one_cookie(spark, 1000, _in_an_hour)
    heavy = sessionize._heavy(rows, 20).select(F.size("borders").alias("n")).first()
    assert heavy.n == 10
    sizes = [r["count"] for r in _chunked(rows, pageview_cut(), "FAILFAST", 20, None).groupBy(CHUNK).count().collect()]
    assert len(sizes) == 11 and max(sizes) <= 160


@pytest.mark.parametrize("what", ["assign", "build", "job"])
def test_the_log_is_read_at_most_twice(what):
    helper = os.path.join(os.path.dirname(__file__), "helpers", "reads_run.py")
    out = subprocess.run([sys.executable, helper, what, "3000"], capture_output=True, text=True, timeout=600).stdout
    reads = float(out.split("READS ")[1].split()[0])
    assert 0 < reads <= (1 if what == "job" else 2), out[-2000:]
    if what == "job":
        assert "STAGED LEFT 0" in out
    else:
        assert "SORT AGGREGATE False" in out or what == "assign"


def test_edges_read_the_exchange_of_the_rows(spark):
    out = build_sessions(_one_cookie(spark, 500, _in_an_hour), rows_per_chunk=20)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in plan and "REPARTITION_BY_COL" in plan
    assert plan.count("REPARTITION_BY_COL") - plan.count("ReusedExchange") <= 1
    assert "SortAggregate" not in plan


def test_nothing_is_stitched_without_heavy_cookies(spark):
    out = build_sessions(_one_cookie(spark, 500, _in_an_hour))
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("REPARTITION_BY_COL") == 1


@pytest.mark.parametrize("run", range(5))
@pytest.mark.parametrize("build", [build_sessions, assign_sessions])
def test_an_unreadable_time_gives_one_clean_error(spark, run, build):
    good = "pageview|2017-09-04 12:00:00|c1|1.1.1.1|http://a.com/x"
    lines = [good] * (run + 1) + ["click|bad|c1|1.1.1.1|http://a.com/y"]
    with pytest.raises(PySparkException, match="readable time:.c1.bad"):
        build(parse_track_log(lines_df(spark, lines)), time_gap_cut(), rows_per_chunk=2).collect()


def test_a_malformed_line_gives_the_job_one_clean_error(spark, tmp_path):
    log, labels = tmp_path / "log.txt", tmp_path / "labels.txt"
    log.write_text("pageview|2017-09-04 12:00:00|c1|1.1.1.1|http://a.com/x\nbroken\n")
    labels.write_text("c1|x")
    with pytest.raises(PySparkException, match="malformed visit log line: broken"):
        run_session_etl(spark, str(log), str(labels), str(tmp_path / "out"))
    with pytest.raises(PySparkException, match="malformed cookie label line: x"):
        parse_cookie_labels(lines_df(spark, ["x"])).collect()


def test_heavy_labels_are_broadcast_and_the_rest_shuffled(spark):
    """The hot cookie's sessions meet no single task, whatever the thresholds of AQE; with and without labels."""
    kept = clean_log_types(track_log_from_events(spark, SF_SMALL))
    hot = kept.withColumn("cookie", F.when(F.col("log_order") % 3 == 0, "HOT").when(F.col("log_order") % 3 == 1, "BARE").otherwise(F.col("cookie")))
    labels = spark.createDataFrame(
        [("HOT", "a"), ("HOT", "b"), ("cookie5", "c"), ("gone", "d")] + [("BARE-not", "e")] * 3, "cookie string, cookie_label string"
    )
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.skewJoin.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
        sessions = build_sessions(hot, rows_per_chunk=20)
        heavy = heavy_cookies(hot, 20)
        assert {"HOT", "BARE"} <= {r.cookie for r in heavy.collect()}
        plain = label_cookies(sessions, labels)
        light = label_cookies(sessions, labels, heavy=heavy)
        assert sorted(map(tuple, light.select(plain.columns).collect())) == sorted(map(tuple, plain.collect()))
        many = labels.unionByName(spark.range(150).select(F.lit("HOT").alias("cookie"), F.col("id").cast("string").alias("cookie_label")))
        assert label_cookies(sessions, many, heavy=heavy).count() == label_cookies(sessions, many).count()
        plan = light._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" in plan
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_staged_sessions_keep_their_random_ids(spark):
    kept = clean_log_types(track_log_from_events(spark, SF_SMALL))
    with staged(build_sessions(kept, session_ids="uuid")) as held:
        first = {r.session_id for r in held.df.collect()}
        assert first == {r.session_id for r in held.df.repartition(3).collect()}  # a second action
        assert len(first) == held.df.count()
        path = held.path.removeprefix("file:")
        assert os.path.isdir(path)
    assert not os.path.exists(path)


def _names(base):
    return sorted(p for p in os.listdir(base) if not p.startswith("."))


@pytest.mark.parametrize("fails", ["write", "exchange"])
def test_a_failure_leaves_both_old_datasets(spark, tmp_path, monkeypatch, fails):
    logs = track_log_from_events(spark, SF_SMALL)
    labels = spark.createDataFrame([], "cookie string, cookie_label string")
    sessions = session_etl(logs, labels)
    base = str(tmp_path / "out")
    sinks.write_outputs(logs, sessions, base, "parquet")
    old = [spark.read.parquet(f"{base}/{d}").count() for d in (sinks.LOG_DIR, sinks.SESSION_DIR)]
    if fails == "write":
        broken = sessions.withColumn("ip", F.raise_error(F.lit("broken")).cast("string"))
    else:
        broken, moved = sessions.limit(3), []
        move = sinks.move

        def third_fails(spark, a, b):
            moved.append(a)
            if len(moved) == 4:
                raise OSError("broken")
            move(spark, a, b)

        monkeypatch.setattr(sinks, "move", third_fails)
    with pytest.raises(Exception, match="broken"):
        sinks.write_outputs(logs.limit(5), broken, base, "parquet")
    assert [spark.read.parquet(f"{base}/{d}").count() for d in (sinks.LOG_DIR, sinks.SESSION_DIR)] == old
    assert _names(base) == sorted([sinks.LOG_DIR, sinks.SESSION_DIR])
