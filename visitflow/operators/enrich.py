"""Session enrichment: landing domain + domain label, cookie label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitflow.functions.columns import or_missing, url_host
from visitflow.schema import COOKIE, MISSING, SESSION_COLUMNS
from visitflow.sources.text import default_domain_labels

# Sessions without a host cannot match a dimension row; their join keys are
# spread over this many values, so that they do not meet in one task.
_NO_HOST_KEYS = 4096
_MOST_LABELS = 100  # label rows of one heavy cookie that are broadcast


def with_domain(sessions: DataFrame, mode: str = "FAILFAST") -> DataFrame:
    """``domain`` = host of the landing URL, ``"-"`` when there is none."""
    landing = F.col("landing_url")
    return sessions.withColumn("domain", F.when(landing == MISSING, F.lit(MISSING)).otherwise(url_host(landing, mode)))


def _host_key(domain: Column) -> Column:
    return F.concat(F.lit("host:"), domain)


def label_domains(sessions: DataFrame, domains: DataFrame | None = None, *, mode: str = "FAILFAST") -> DataFrame:
    """Exact-host lookup of ``domain_label`` (``"-"`` when absent).

    Without ``domains`` the four fixed entries are used, and broadcast.  Any
    other dimension is made unique on ``domain`` (a lookup map has one label per
    key) and left to the planner: broadcast if its measured size allows, else
    a shuffle join whose hot hosts AQE can split (the join key is derived after
    the grouping, so both sides have an exchange of their own).
    """
    if domains is None:
        dim = F.broadcast(default_domain_labels(sessions.sparkSession))  # four rows
    else:
        dim = domains.groupBy("domain").agg(F.max("domain_label").alias("domain_label"))
    dim = dim.select(_host_key(F.col("domain")).alias("_key"), "domain_label")
    found = with_domain(sessions, mode)
    spread = F.concat(F.lit("none:"), F.pmod(F.xxhash64(COOKIE, "session_server_time"), F.lit(_NO_HOST_KEYS)).cast("string"))
    none = F.col("domain").isin(MISSING, "")
    out = found.withColumn("_key", F.when(none, spread).otherwise(_host_key(F.col("domain")))).join(dim, "_key", "left")
    return out.drop("_key").withColumn("domain_label", or_missing(F.col("domain_label")))


def check_unique_labels(labels: DataFrame) -> None:
    """Raise when a cookie has more than one label row (one grouping of all labels)."""
    dup = labels.groupBy(COOKIE).count().where(F.col("count") > 1).limit(1).collect()
    if dup:
        raise ValueError(f"cookie {dup[0][COOKIE]!r} has {dup[0]['count']} label rows")


def _labels_of_heavy(labels: DataFrame, heavy: DataFrame) -> DataFrame:
    """``h_cookie, h_label``: the labels of heavy cookies, null for one without.

    Heavy cookies with more than ``_MOST_LABELS`` label rows are left to the
    shuffle join, so that the table has at most ``_MOST_LABELS`` rows a cookie.
    """
    heavy = heavy.select(F.col(COOKIE).alias("h_cookie"))
    found = labels.join(F.broadcast(heavy), F.col(COOKIE) == F.col("h_cookie"), "left_semi").select(COOKIE, F.col("cookie_label").alias("h_label"))
    rows = F.count("*").over(Window.partitionBy("h_cookie"))
    joined = heavy.join(found, F.col("h_cookie") == F.col(COOKIE), "left").select("h_cookie", "h_label")
    return joined.select("*", rows.alias("rows")).where(F.col("rows") <= _MOST_LABELS).select("h_cookie", "h_label")


def label_cookies(
    sessions: DataFrame, labels: DataFrame, *, unique_labels: bool = False, heavy: DataFrame | None = None
) -> DataFrame:
    """Left join on cookie; ``"-"`` when the cookie has no label.  Duplicate
    label rows multiply the session, as a left outer join does; with
    ``unique_labels=True`` they are an error instead.

    ``heavy`` names the cookies with very many sessions (``cookie``, a bounded
    table, as :func:`~visitflow.operators.sessionize.heavy_cookies` gives):
    their labels are broadcast, and their sessions get spread keys in the join
    of the rest, where they match nothing.  Without it the sessions are first
    dealt by cookie and start, so that a hot cookie's come from many tasks and
    AQE can split them; the planner broadcasts labels of a small measured size.
    """
    if unique_labels:
        check_unique_labels(labels)
    if heavy is None:
        tasks = int(sessions.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        dealt = sessions.repartition(tasks, COOKIE, "session_server_time")
        out = dealt.join(labels, COOKIE, "left").select(*sessions.columns, "cookie_label")
        return out.withColumn("cookie_label", or_missing(F.col("cookie_label")))
    of_heavy = F.broadcast(_labels_of_heavy(labels, heavy))
    out = sessions.join(of_heavy, F.col(COOKIE) == F.col("h_cookie"), "left")
    spread = F.concat(F.lit("heavy:"), F.pmod(F.xxhash64(COOKIE, "session_server_time", "session_seq"), F.lit(_NO_HOST_KEYS)).cast("string"))
    key = F.when(F.col("h_cookie").isNotNull(), spread).otherwise(F.concat(F.lit("cookie:"), F.col(COOKIE)))
    rest = labels.select(F.concat(F.lit("cookie:"), F.col(COOKIE)).alias("_key"), "cookie_label")
    out = out.withColumn("_key", key).join(rest, "_key", "left").drop("_key", "h_cookie")
    return out.withColumn("cookie_label", or_missing(F.coalesce("h_label", "cookie_label"))).drop("h_label")


def session_record(sessions: DataFrame) -> DataFrame:
    """The ten output columns in schema order."""
    return sessions.select(*SESSION_COLUMNS)
