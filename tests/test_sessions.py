"""Sessionization on the driver tables: oracle agreement, invariants,
partition-count invariance and a hot cookie holding a third of all rows."""

from __future__ import annotations

import duckdb
import pytest
from conftest import SF_MID, SF_SMALL
from pyspark.sql import functions as F

from visitflow.operators.clean import clean_log_types
from visitflow.operators.cut import pageview_cut, time_gap_cut
from visitflow.operators.sessionize import CHUNK, _chunked, assign_sessions, build_sessions
from visitflow.plans import catalog
from visitflow.sources.tables import track_log_from_events


@pytest.fixture(scope="module")
def kept(spark):
    return clean_log_types(track_log_from_events(spark, SF_MID)).persist()


def _key(rows):
    return sorted(tuple(r) for r in rows)


@pytest.mark.parametrize("cut", [pageview_cut(), time_gap_cut()], ids=["pageview", "gap30"])
def test_partition_count_invariance(kept, cut):
    ref = _key(build_sessions(kept, cut, num_partitions=1).collect())
    for parts in (7, 64, 300):
        got = build_sessions(kept, cut, num_partitions=parts, rows_per_chunk=5 if parts > 50 else 50)
        assert _key(got.collect()) == ref
    shuffled = kept.repartition(11)
    assert _key(build_sessions(shuffled, cut, num_partitions=29, rows_per_chunk=1).collect()) == ref


def test_counts_and_seq_invariants(kept):
    n_kept = kept.count()
    for cut in (pageview_cut(), time_gap_cut()):
        s = build_sessions(kept, cut, num_partitions=64)
        tot = s.agg(F.sum("pageview_count"), F.sum("click_count")).first()
        assert tot[0] + tot[1] == n_kept
        gaps = s.groupBy("cookie").agg(F.count("*").alias("n"), F.max("session_seq").alias("m"), F.min("session_seq").alias("lo"))
        assert gaps.where((F.col("n") != F.col("m")) | (F.col("lo") != 1)).count() == 0
    pv = build_sessions(kept, pageview_cut(), num_partitions=64)
    assert pv.where(F.col("pageview_count") > 1).count() == 0


def test_time_gap_invariants(kept):
    a = assign_sessions(kept, time_gap_cut(), num_partitions=50)
    from pyspark.sql import Window

    w = Window.partitionBy("cookie").orderBy("log_server_time", "log_order")
    ms = F.unix_millis(F.to_timestamp("log_server_time"))
    d = a.select("session_seq", (ms - F.lag(ms).over(w)).alias("gap"), (F.col("session_seq") - F.lag("session_seq").over(w)).alias("step"))
    d = d.where(F.col("gap").isNotNull())
    assert d.where((F.col("step") == 0) & (F.col("gap") >= 1_800_000)).count() == 0
    assert d.where((F.col("step") == 1) & (F.col("gap") < 1_800_000)).count() == 0
    assert d.where(~F.col("step").isin(0, 1)).count() == 0


def test_hot_cookie_is_split_and_exact(spark, kept):
    """A third of the users collapse into one cookie: its rows must be spread
    over many range partitions and the result must equal the oracle."""
    hot = kept.withColumn(
        "cookie", F.when(F.regexp_extract("cookie", "([0-9]+)$", 1).cast("int") % 3 == 0, F.lit("cookieHOT")).otherwise(F.col("cookie"))
    )
    chunked = _chunked(hot, pageview_cut(), "FAILFAST", 100, 24)
    chunks = chunked.where(F.col("cookie") == "cookieHOT").select(CHUNK).distinct().count()
    assert chunks >= 6
    got = _key(build_sessions(hot, pageview_cut(), num_partitions=24, rows_per_chunk=100).select("cookie", "session_seq", "session_server_time", "pageview_count", "click_count", "landing_url").collect())
    pdf = hot.toPandas()
    con = duckdb.connect()
    con.register("hot", pdf)
    exp = con.sql(
        """
        WITH f AS (SELECT *, CASE WHEN lag(cookie) OVER w IS NULL OR log_type = 'pageview' THEN 1 ELSE 0 END AS st
                   FROM hot WINDOW w AS (PARTITION BY cookie ORDER BY log_server_time, log_order)),
        s AS (SELECT *, sum(st) OVER (PARTITION BY cookie ORDER BY log_server_time, log_order ROWS UNBOUNDED PRECEDING) AS seq FROM f)
        SELECT cookie, CAST(seq AS INTEGER), min(log_server_time),
               CAST(count(*) FILTER (WHERE log_type='pageview') AS INTEGER),
               CAST(count(*) FILTER (WHERE log_type='click') AS INTEGER),
               coalesce(first(url ORDER BY log_server_time, log_order) FILTER (WHERE log_type='pageview'), '-')
        FROM s GROUP BY cookie, seq"""
    ).fetchall()
    assert got == sorted(exp)


@pytest.mark.parametrize(
    "name",
    ["parse_track_log", "clean_log_types", "assign_sessions_day_change", "build_sessions_time_gap_30m", "label_domains_default", "session_etl", "session_total"],
)
def test_catalog_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("events", "pages", "customer"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    got = catalog.queries()[name](spark, SF_SMALL).toPandas()
    exp = con.sql(catalog.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(exp.columns)
    cols = sorted(got.columns)
    assert sorted(map(tuple, got[cols].astype(str).values.tolist())) == sorted(map(tuple, exp[cols].astype(str).values.tolist()))


def test_entry_smoke(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() > 0
    assert set(catalog.queries()) == set(catalog.oracle_sql()) <= set(e.oracle_sql())


def test_plan_is_lazy_and_leaves_nothing_cached(spark, kept):
    """No job runs before the action, and no RDD stays in storage."""
    kept.count()
    tracker, sc = spark.sparkContext.statusTracker(), spark.sparkContext
    held = sc._jsc.getPersistentRDDs().size()
    sc.setJobGroup("lazy", "plan only")
    plans = [fn(kept, time_gap_cut(), rows_per_chunk=50) for fn in (assign_sessions, build_sessions)]
    assert not tracker.getJobIdsForGroup("lazy")
    sc.setJobGroup("other", "action")
    for p in plans:
        p.count()
    assert sc._jsc.getPersistentRDDs().size() == held


@pytest.mark.parametrize("reuse", ["true", "false"])
@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_result_does_not_depend_on_the_planner(spark, kept, reuse, adaptive):
    hot = kept.withColumn("cookie", F.when(F.col("cookie").rlike("[0369]$"), F.lit("HOT")).otherwise(F.col("cookie")))
    ref = _key(assign_sessions(hot, num_partitions=1).collect())
    conf = {"spark.sql.exchange.reuse": reuse, "spark.sql.adaptive.enabled": adaptive}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        assert _key(assign_sessions(hot, num_partitions=24, rows_per_chunk=40).collect()) == ref
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_gap_ignores_the_session_zone(spark, zone):
    """Two logs around a change of the clocks, 15 minutes apart on the wall."""
    rows = [("click", "2017-11-05 01:50:00", "a", "i", "http://x/", 0), ("click", "2017-11-05 02:05:00", "a", "i", "http://x/", 1)]
    df = spark.createDataFrame(rows, "log_type string, log_server_time string, cookie string, ip string, url string, log_order long")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        assert build_sessions(df, time_gap_cut()).count() == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


@pytest.mark.parametrize("parts", [1, 3])
@pytest.mark.parametrize("missing", ["cookie", "log_server_time"])
def test_null_keys_raise_or_drop(spark, parts, missing):
    rows = [("click", "2017-09-04 10:00:00", "a", "i", "http://x/", 0), ("pageview", "2017-09-04 10:00:01", "a", "i", "http://x/", 1)]
    df = spark.createDataFrame(rows, "log_type string, log_server_time string, cookie string, ip string, url string, log_order long")
    bad = df.unionByName(df.limit(1).withColumn(missing, F.lit(None).cast("string")))
    with pytest.raises(Exception, match="without cookie or readable time"):
        build_sessions(bad, num_partitions=parts).collect()
    got = build_sessions(bad, mode="DROPMALFORMED", num_partitions=parts)
    assert _key(got.collect()) == _key(build_sessions(df).collect())


def test_ties_across_files_follow_the_files(spark, tmp_path):
    """Equal times in two files keep file order whatever the files' sizes and splits."""
    from visitflow.sources.text import read_track_log

    line = "{}|2017-09-04 10:00:00|c1|1.1.1.1|http://x.com/"
    filler = ["click|2017-09-04 11:00:00|z%d|1.1.1.1|http://x.com/" % i for i in range(400)]
    found = set()
    for name, first, second in (("a", [], filler), ("b", filler, [])):
        d = tmp_path / name
        d.mkdir()
        (d / "part-0.txt").write_text("\n".join([line.format("click"), *first]) + "\n")
        (d / "part-1.txt").write_text("\n".join([line.format("pageview"), *second]) + "\n")
        for size in ("1k", "128m"):
            old = spark.conf.get("spark.sql.files.maxPartitionBytes")
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            try:
                logs = read_track_log(spark, str(d))
                found.add(build_sessions(logs).where("cookie = 'c1'").count())
            finally:
                spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert found == {2}  # the click of the first file, then the pageview


def test_domain_join_splits_a_hot_host(spark, kept):
    """A host of most sessions is split by AQE, and sessions without a host are spread."""
    from visitflow.operators.enrich import label_domains

    pages = kept.where("log_type = 'pageview'").withColumn(
        "url", F.when(F.col("log_order") % 5 > 0, F.lit("http://hot.com/x")).otherwise(F.col("url"))
    )
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        sessions = build_sessions(pages, num_partitions=16)
        dim = spark.createDataFrame([("hot.com", "h"), ("other.com", "o")], "domain string, domain_label string")
        out = label_domains(sessions, dim)
        rows = out.collect()
        assert "SortMergeJoin(skew=true)" in out._jdf.queryExecution().executedPlan().toString()
        assert len(rows) == sessions.count()
        assert {r.domain_label for r in rows if r.domain == "hot.com"} == {"h"}
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_label_join_splits_hot_cookie(spark, kept):
    """With the labels too big to broadcast, AQE splits the hot cookie's
    partition of the session side in the left join."""
    from visitflow.operators.enrich import label_cookies
    from visitflow.sources.tables import cookie_labels_from_customers

    hot = kept.withColumn(
        "cookie", F.when(F.regexp_extract("cookie", "([0-9]+)$", 1).cast("int") % 3 == 0, F.lit("cookie3")).otherwise(F.col("cookie"))
    )
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        # AQE splits a skewed partition along map tasks, so the session side
        # needs several of them (at scale it always has; this input is one
        # file split, which would give a single chunk by default).
        sessions = build_sessions(hot, num_partitions=16)
        out = label_cookies(sessions, cookie_labels_from_customers(spark, SF_MID))
        rows = out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
        assert len(rows) == sessions.count()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_result_survives_task_retries():
    """Every input task fails once and is retried: results are unchanged."""
    import os
    import subprocess
    import sys

    helper = os.path.join(os.path.dirname(__file__), "helpers", "retry_run.py")
    out = subprocess.run([sys.executable, helper, SF_SMALL], capture_output=True, text=True, timeout=600)
    assert "RETRY_RESULT True" in out.stdout, out.stdout[-2000:] + out.stderr[-2000:]
