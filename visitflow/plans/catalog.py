"""Registered queries over the driver tables, each with a DuckDB oracle.

Every query reads the whole tables (events, pages, customer) through the
adapter in :mod:`visitflow.sources.tables`.  The oracle SQL recomputes the
same result in DuckDB the textbook way (``lag`` + running ``sum`` over
``PARTITION BY cookie``), an independent path from the Spark plan.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from visitflow.operators.clean import clean_log_types
from visitflow.operators.cut import CutRule, day_change_cut, pageview_cut, time_gap_cut
from visitflow.operators.enrich import label_cookies, label_domains
from visitflow.operators.sessionize import assign_sessions, build_sessions, heavy_cookies
from visitflow.plans.etl import CONF_COOKIE_LABELS, CONF_OUTPUT, CONF_VISIT_LOG, main, run_session_etl, session_etl
from visitflow.schema import COOKIE, LOG_COLUMNS, LOG_TIME, ORDER
from visitflow.sources.sinks import LOG_DIR, SESSION_DIR, read_dataset, write_dataset, write_outputs
from visitflow.sources.staging import staged
from visitflow.sources.tables import (
    SQL_COOKIE_LABELS,
    SQL_DOMAIN_LABELS,
    SQL_TRACK_LOG,
    cookie_label_lines_from_customers,
    cookie_labels_from_customers,
    domain_labels_from_pages,
    track_log_from_events,
    track_log_lines_from_events,
)
from visitflow.sources.text import (
    parse_cookie_labels,
    parse_track_log,
    read_cookie_labels,
    read_track_log,
)
from visitflow.spark import shared_dir

Query = Callable[[SparkSession, str], DataFrame]

# ---------------------------------------------------------------- Spark side

HOT_CHUNK = 100  # rows

CUTS: dict[str, Callable[[], CutRule]] = {
    "pageview": pageview_cut,
    "time_gap_30m": lambda: time_gap_cut("30 minutes"),
    "time_gap_6h": lambda: time_gap_cut("6 hours"),
    "time_gap_24h": lambda: time_gap_cut("24 hours"),
    "day_change": day_change_cut,
}


def _kept(spark: SparkSession, d: str) -> DataFrame:
    return clean_log_types(track_log_from_events(spark, d))


def _sessions(spark: SparkSession, d: str, cut: str = "pageview") -> DataFrame:
    return build_sessions(_kept(spark, d), CUTS[cut]())


def _etl(spark: SparkSession, d: str, cut: str = "pageview") -> DataFrame:
    return session_etl(
        track_log_from_events(spark, d),
        cookie_labels_from_customers(spark, d),
        domain_labels_from_pages(spark, d),
        cut=CUTS[cut](),
    )


def _sink_roundtrip(fmt: str, kind: str) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        base = shared_dir(spark, f"sink-{fmt}")
        write_outputs(track_log_from_events(spark, d), _etl(spark, d), base, fmt)
        path = f"{base}/{SESSION_DIR if kind == 'session' else LOG_DIR}"
        return read_dataset(spark, path, kind, fmt)

    return run


def _text_inputs(spark: SparkSession, d: str) -> tuple[str, str]:
    """The two text inputs of the job, written in the shared folder; the log in the order of ``log_order``."""
    logs, labels = shared_dir(spark, "text-log"), shared_dir(spark, "text-label")
    lines = track_log_lines_from_events(spark, d).repartitionByRange(ORDER).sortWithinPartitions(ORDER)
    lines.select("value").write.mode("overwrite").text(logs)
    cookie_label_lines_from_customers(spark, d).write.mode("overwrite").text(labels)
    return logs, labels


def _job(fmt: str) -> Query:
    """The whole job from text files to its two datasets; the sessions, read back."""

    def run(spark: SparkSession, d: str) -> DataFrame:
        logs, labels = _text_inputs(spark, d)
        base = shared_dir(spark, f"job-{fmt}")
        run_session_etl(spark, logs, labels, base, fmt)
        return read_dataset(spark, f"{base}/{SESSION_DIR}", "session", fmt)

    return run


def _hot_labels(spark: SparkSession, d: str) -> DataFrame:
    """The customers' labels, and two labels of the hot cookie."""
    two = spark.createDataFrame([("cookieHOT", "hot"), ("cookieHOT", "twice")], "cookie string, cookie_label string")
    return cookie_labels_from_customers(spark, d).unionByName(two)


def _job_by_conf(spark: SparkSession, d: str) -> DataFrame:
    """The submitted job, its three paths taken from the session's conf keys; the sessions, read back."""
    logs, labels = _text_inputs(spark, d)
    base = shared_dir(spark, "job-conf")
    conf = {CONF_VISIT_LOG: logs, CONF_COOKIE_LABELS: labels, CONF_OUTPUT: base}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        main(["parquet"])
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return read_dataset(spark, f"{base}/{SESSION_DIR}", "session", "parquet")


def _staged_twice(spark: SparkSession, d: str) -> DataFrame:
    """Sessions with random ids, staged; two actions over the same handle must see equal ids."""
    kept = _kept(spark, d)
    held = staged(build_sessions(kept, session_ids="uuid"), "sessions")
    total = held.df.count()
    again = held.df.withColumnRenamed("session_id", "id")
    same = held.df.join(again, (F.col("session_id") == F.col("id")) & F.col("id").rlike("^[0-9a-f-]{36}$")).count()
    held.release()
    return spark.range(1).select(F.lit(total).alias("sessions"), F.lit(same).alias("same_ids"))


def _bursty(spark: SparkSession, d: str) -> DataFrame:
    """The kept logs with a third of the users behind one cookie whose logs lie in the first minutes
    of one hour, but for one log years before."""
    hot = _hot(spark, d)
    second = F.pmod(F.col(ORDER), F.lit(600))
    burst = F.concat(F.lit("2024-05-01 10:"), F.lpad((second / 60).cast("int").cast("string"), 2, "0"),
                     F.lit(":"), F.lpad((second % 60).cast("string"), 2, "0"))
    early = F.when(F.col(ORDER) < 10, F.lit("2019-01-01 00:00:00")).otherwise(burst)
    return hot.withColumn(LOG_TIME, F.when(F.col(COOKIE) == "cookieHOT", early).otherwise(F.col(LOG_TIME)))


def _one_second(spark: SparkSession, d: str) -> DataFrame:
    """The kept logs with a third of the users behind one cookie, all its logs in one second."""
    hot = _hot(spark, d)
    return hot.withColumn(
        LOG_TIME, F.when(F.col(COOKIE) == "cookieHOT", F.lit("2024-05-01 10:00:00")).otherwise(F.col(LOG_TIME))
    )


def _overwritten(spark: SparkSession, d: str) -> DataFrame:
    """The logs dataset written twice, first with all types, then cleaned; the second, read back."""
    path = shared_dir(spark, "overwrite")
    write_dataset(track_log_from_events(spark, d), path, LOG_COLUMNS, "parquet")
    write_dataset(_kept(spark, d), path, LOG_COLUMNS, "parquet")
    return read_dataset(spark, path, "log", "parquet")


def _daily(spark: SparkSession, d: str) -> DataFrame:
    """The kept logs with times cut to the day: nearly all rows of a cookie and day are ties."""
    return _kept(spark, d).withColumn(LOG_TIME, F.concat(F.substring(LOG_TIME, 1, 10), F.lit(" 00:00:00")))


def _hot(spark: SparkSession, d: str) -> DataFrame:
    """The kept logs with a third of the users behind one cookie."""
    number = F.regexp_extract(COOKIE, "([0-9]+)$", 1).cast("long")
    return _kept(spark, d).withColumn(COOKIE, F.when(number % 3 == 0, F.lit("cookieHOT")).otherwise(F.col(COOKIE)))


def _text_file_roundtrip(kind: str) -> Query:
    """Write the generated lines as text files, then read them with the text
    sources (``spark.read.text`` + parse), as the job does with its inputs."""

    def run(spark: SparkSession, d: str) -> DataFrame:
        logs, labels = _text_inputs(spark, d)
        if kind == "label":
            return read_cookie_labels(spark, labels)
        place = F.row_number().over(Window.partitionBy(COOKIE).orderBy(ORDER))
        return read_track_log(spark, logs).select(*LOG_COLUMNS, place.alias("place"))

    return run


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        "parse_track_log": lambda s, d: parse_track_log(track_log_lines_from_events(s, d)),
        "parse_cookie_labels": lambda s, d: parse_cookie_labels(cookie_label_lines_from_customers(s, d)),
        "clean_log_types": lambda s, d: _kept(s, d),
        "read_track_log_text": _text_file_roundtrip("log"),
        "read_cookie_labels_text": _text_file_roundtrip("label"),
    }
    for name, make in CUTS.items():
        q[f"assign_sessions_{name}"] = lambda s, d, make=make: assign_sessions(_kept(s, d), make())
    for name in ("pageview", "time_gap_30m"):
        q[f"build_sessions_{name}"] = lambda s, d, name=name: _sessions(s, d, name)
    q["label_domains"] = lambda s, d: label_domains(_sessions(s, d), domain_labels_from_pages(s, d))
    q["label_domains_default"] = lambda s, d: label_domains(_sessions(s, d))
    q["label_cookies"] = lambda s, d: label_cookies(
        _sessions(s, d), cookie_labels_from_customers(s, d), heavy=heavy_cookies(_kept(s, d))
    )
    q["session_etl"] = lambda s, d: _etl(s, d)
    q["session_etl_from_text"] = lambda s, d: session_etl(
        parse_track_log(track_log_lines_from_events(s, d)),
        parse_cookie_labels(cookie_label_lines_from_customers(s, d)),
        domain_labels_from_pages(s, d),
    )
    q["session_etl_time_gap"] = lambda s, d: _etl(s, d, "time_gap_30m")
    q["session_total"] = lambda s, d: _etl(s, d).agg(F.count(F.lit(1)).alias("session_total"))
    q["sink_text_sessions"] = _sink_roundtrip("text", "session")
    q["sink_parquet_sessions"] = _sink_roundtrip("parquet", "session")
    q["sink_text_logs"] = _sink_roundtrip("text", "log")
    q["sink_parquet_logs"] = _sink_roundtrip("parquet", "log")
    q["sink_overwrite"] = _overwritten
    q["etl_job_text"] = _job("text")
    q["etl_job_parquet"] = _job("parquet")
    q["assign_sessions_ties"] = lambda s, d: assign_sessions(_daily(s, d))
    # chunks this small divide the hot cookie (and others) at every size of the tables
    q["build_sessions_hot_cookie"] = lambda s, d: build_sessions(_hot(s, d), rows_per_chunk=HOT_CHUNK)
    q["assign_sessions_hot_cookie"] = lambda s, d: assign_sessions(
        _hot(s, d), time_gap_cut("6 hours"), rows_per_chunk=HOT_CHUNK
    )
    q["build_sessions_bursty_cookie"] = lambda s, d: build_sessions(
        _bursty(s, d), time_gap_cut("1 second"), rows_per_chunk=HOT_CHUNK
    )
    q["build_sessions_one_second"] = lambda s, d: build_sessions(_one_second(s, d), rows_per_chunk=HOT_CHUNK)
    q["session_etl_hot_cookie"] = lambda s, d: session_etl(
        _hot(s, d), _hot_labels(s, d), domain_labels_from_pages(s, d), rows_per_chunk=HOT_CHUNK
    )
    q["etl_job_conf"] = _job_by_conf
    q["staged_sessions"] = _staged_twice
    return q


# ---------------------------------------------------------------- DuckDB side

_LOGS = f"logs AS ({SQL_TRACK_LOG})"
_KEPT = "kept AS (SELECT * FROM logs WHERE log_type IN ('click', 'pageview'))"

# New-session condition against the previous log of the cookie (window w).
_STARTS = {
    "pageview": "log_type = 'pageview'",
    "time_gap_1s": "ms - lag(ms) OVER w >= 1000",
    "time_gap_30m": "ms - lag(ms) OVER w >= 1800000",
    "time_gap_6h": "ms - lag(ms) OVER w >= 21600000",
    "time_gap_24h": "ms - lag(ms) OVER w >= 86400000",
    "day_change": "substr(log_server_time, 1, 10) <> lag(substr(log_server_time, 1, 10)) OVER w",
}

_DAILY = """daily AS (SELECT * REPLACE (substr(log_server_time, 1, 10) || ' 00:00:00' AS log_server_time) FROM kept)"""
_HOT = """hot AS (SELECT * REPLACE (CASE WHEN CAST(regexp_extract(cookie, '[0-9]+$') AS BIGINT) % 3 = 0
                                  THEN 'cookieHOT' ELSE cookie END AS cookie) FROM kept)"""

_BURSTY = """bursty AS (SELECT * REPLACE (CASE WHEN cookie <> 'cookieHOT' THEN log_server_time
                                        WHEN log_order < 10 THEN '2019-01-01 00:00:00'
                                        ELSE strftime(TIMESTAMP '2024-05-01 10:00:00' + to_seconds(log_order % 600),
                                                      '%Y-%m-%d %H:%M:%S') END AS log_server_time) FROM hot)"""
_ONE_SECOND = """one_second AS (SELECT * REPLACE (CASE WHEN cookie = 'cookieHOT' THEN '2024-05-01 10:00:00'
                                                 ELSE log_server_time END AS log_server_time) FROM hot)"""

_HOST = r"regexp_extract(landing_url, '^(?i:https?|ftp)://(?:[^/?#]*@)?(\[[^\]/?#]*\]|[^:/?#]*)', 1)"


def _assigned_cte(cut: str, table: str = "kept") -> str:
    return f"""{_LOGS}, {_KEPT}, {_DAILY}, {_HOT}, {_BURSTY}, {_ONE_SECOND},
flagged AS (
  SELECT *, CASE WHEN lag(cookie) OVER w IS NULL OR ({_STARTS[cut]}) THEN 1 ELSE 0 END AS is_start
  FROM (SELECT *, epoch_ms(strptime(log_server_time, '%Y-%m-%d %H:%M:%S')) AS ms FROM {table})
  WINDOW w AS (PARTITION BY cookie ORDER BY log_server_time, log_order)),
assigned AS (
  SELECT *, CAST(sum(is_start) OVER (PARTITION BY cookie ORDER BY log_server_time, log_order
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS INTEGER) AS session_seq
  FROM flagged)"""


def _sessions_cte(cut: str, table: str = "kept") -> str:
    return f"""{_assigned_cte(cut, table)},
sessions AS (
  SELECT md5(concat_ws('|', cookie, min(log_server_time), CAST(session_seq AS VARCHAR))) AS session_id,
         min(log_server_time) AS session_server_time,
         cookie,
         first(ip ORDER BY log_server_time, log_order) AS ip,
         coalesce(first(url ORDER BY log_server_time, log_order) FILTER (WHERE log_type = 'pageview'), '-') AS landing_url,
         CAST(count(*) FILTER (WHERE log_type = 'pageview') AS INTEGER) AS pageview_count,
         CAST(count(*) FILTER (WHERE log_type = 'click') AS INTEGER) AS click_count,
         session_seq
  FROM assigned GROUP BY cookie, session_seq),
domains AS ({SQL_DOMAIN_LABELS}),
default_domains AS (SELECT * FROM (VALUES ('www.baidu.com', 'level1'), ('tieba.baidu.com', 'level2'),
                                          ('jd.com', 'level3'), ('youku.com', 'level4')) t(domain, domain_label)),
labels AS ({SQL_COOKIE_LABELS}),
with_domain AS (
  SELECT *, CASE WHEN landing_url = '-' THEN '-' ELSE {_HOST} END AS domain FROM sessions)"""


def _etl_sql(cut: str, domains: str = "domains", table: str = "kept", labels: str = "SELECT * FROM labels") -> str:
    return f"""WITH {_sessions_cte(cut, table)}
SELECT s.session_id, s.session_server_time, s.cookie, coalesce(l.cookie_label, '-') AS cookie_label,
       s.ip, s.landing_url, s.pageview_count, s.click_count, s.domain,
       coalesce(d.domain_label, '-') AS domain_label
FROM with_domain s
LEFT JOIN (SELECT domain, max(domain_label) AS domain_label FROM {domains} GROUP BY domain) d ON d.domain = s.domain
LEFT JOIN ({labels}) l ON l.cookie = s.cookie"""


def oracle_sql() -> dict[str, str]:
    cols = ", ".join(LOG_COLUMNS)
    o = {
        "parse_track_log": f"""WITH {_LOGS},
lines AS (SELECT concat_ws('|', {cols}) AS value, {ORDER} FROM logs
          UNION ALL
          SELECT '#visits of ' || cookie AS value, -min({ORDER}) - 1 AS {ORDER} FROM logs GROUP BY cookie)
SELECT split_part(value, '|', 1) AS log_type, split_part(value, '|', 2) AS log_server_time,
       split_part(value, '|', 3) AS cookie, split_part(value, '|', 4) AS ip,
       split_part(value, '|', 5) AS url, {ORDER}
FROM lines WHERE NOT starts_with(value, '#')""",
        "parse_cookie_labels": f"""WITH lines AS (SELECT concat_ws('|', cookie, cookie_label) AS value FROM ({SQL_COOKIE_LABELS}))
SELECT split_part(value, '|', 1) AS cookie, split_part(value, '|', 2) AS cookie_label FROM lines""",
        "clean_log_types": f"WITH {_LOGS}, {_KEPT} SELECT * FROM kept",
        "read_track_log_text": f"""WITH {_LOGS}
SELECT {cols}, row_number() OVER (PARTITION BY cookie ORDER BY {ORDER}) AS place FROM logs""",
        "read_cookie_labels_text": SQL_COOKIE_LABELS,
    }
    for cut in CUTS:
        o[f"assign_sessions_{cut}"] = f"WITH {_assigned_cte(cut)} SELECT {cols}, {ORDER}, session_seq FROM assigned"
    for cut in ("pageview", "time_gap_30m"):
        o[f"build_sessions_{cut}"] = f"WITH {_sessions_cte(cut)} SELECT * FROM sessions"
    o["label_domains"] = f"""WITH {_sessions_cte('pageview')}
SELECT s.*, coalesce(d.domain_label, '-') AS domain_label FROM with_domain s
LEFT JOIN (SELECT domain, max(domain_label) AS domain_label FROM domains GROUP BY domain) d ON d.domain = s.domain"""
    o["label_domains_default"] = f"""WITH {_sessions_cte('pageview')}
SELECT s.*, coalesce(d.domain_label, '-') AS domain_label FROM with_domain s
LEFT JOIN default_domains d ON d.domain = s.domain"""
    o["label_cookies"] = f"""WITH {_sessions_cte('pageview')}
SELECT s.*, coalesce(l.cookie_label, '-') AS cookie_label FROM sessions s LEFT JOIN labels l ON l.cookie = s.cookie"""
    o["session_etl"] = _etl_sql("pageview")
    o["session_etl_from_text"] = _etl_sql("pageview")
    o["session_etl_time_gap"] = _etl_sql("time_gap_30m")
    o["session_total"] = f"SELECT count(*) AS session_total FROM ({_etl_sql('pageview')})"
    o["sink_text_sessions"] = _etl_sql("pageview")
    o["sink_parquet_sessions"] = _etl_sql("pageview")
    o["sink_text_logs"] = o["sink_parquet_logs"] = f"WITH {_LOGS} SELECT {cols} FROM logs"
    o["sink_overwrite"] = f"WITH {_LOGS}, {_KEPT} SELECT {cols} FROM kept"
    o["etl_job_text"] = o["etl_job_parquet"] = _etl_sql("pageview", "default_domains")
    o["assign_sessions_ties"] = (
        f"WITH {_assigned_cte('pageview', 'daily')} SELECT {cols}, {ORDER}, session_seq FROM assigned"
    )
    o["build_sessions_hot_cookie"] = f"WITH {_sessions_cte('pageview', 'hot')} SELECT * FROM sessions"
    o["assign_sessions_hot_cookie"] = (
        f"WITH {_assigned_cte('time_gap_6h', 'hot')} SELECT {cols}, {ORDER}, session_seq FROM assigned"
    )
    o["build_sessions_bursty_cookie"] = f"WITH {_sessions_cte('time_gap_1s', 'bursty')} SELECT * FROM sessions"
    o["build_sessions_one_second"] = f"WITH {_sessions_cte('pageview', 'one_second')} SELECT * FROM sessions"
    two = "SELECT * FROM labels UNION ALL SELECT 'cookieHOT', 'hot' UNION ALL SELECT 'cookieHOT', 'twice'"
    o["session_etl_hot_cookie"] = _etl_sql("pageview", table="hot", labels=two)
    o["etl_job_conf"] = o["etl_job_text"]
    o["staged_sessions"] = f"""WITH {_sessions_cte('pageview')}
SELECT count(*) AS sessions, count(*) AS same_ids FROM sessions"""
    return o
