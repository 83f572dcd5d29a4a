"""Adapter from the driver's parquet tables to the track-log data model.

``events(event_id, ts, user_id, event_type, ...)`` becomes the visit log:

* ``log_type``        event_type, with ``view`` renamed ``pageview``
* ``log_server_time`` ts formatted ``yyyy-MM-dd HH:mm:ss``
* ``cookie``          ``'cookie' || user_id``; every seventh user is anonymous,
  ``'anon' || user_id``, a cookie that no customer has
* ``ip``              ``'10.0.0.' || user_id mod 256``
* ``url``             url of page ``event_id mod count(pages)``; of ten pages,
  four lie on the four hosts of the default domain map
* ``log_order``       event_id (unique tiebreak for equal times)

Cookie labels come from ``customer`` (every customer's market segment); domain
labels from the hosts of ``pages`` (``www.`` / ``blog.`` / ``m.`` hosts get
``level1``-``level3``, other hosts ``level4``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitflow.functions.columns import URL_HOST_PATTERN
from visitflow.schema import COOKIE, DEFAULT_DOMAIN_LABELS, IP, LOG_TIME, LOG_TYPE, ORDER, TIME_FORMAT, URL


# Columns the adapter reads.  Declaring them skips the schema-inference job
# and prunes the scan to these columns by name.
TABLE_COLUMNS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string",
    "pages": "page_id bigint, url string",
    "customer": "c_custkey bigint, c_mktsegment string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_COLUMNS:
        reader = reader.schema(TABLE_COLUMNS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def track_log_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visit log (all event types) with a unique ``log_order``."""
    events = table(spark, sf_dir, "events")
    page = table(spark, sf_dir, "pages")
    url = F.col(URL)
    for i, (host, _) in enumerate(DEFAULT_DOMAIN_LABELS):
        on_host = F.concat(F.lit(f"http://{host}/p"), F.col("page_id").cast("string"))
        url = F.when(F.col("page_id") % 10 == i, on_host).otherwise(url)
    pages = page.select("page_id", url.alias(URL))
    n_pages = pages.select(F.count(F.lit(1))).scalar()
    logs = events.select(
        F.when(F.col("event_type") == "view", F.lit("pageview")).otherwise(F.col("event_type")).alias(LOG_TYPE),
        F.date_format("ts", TIME_FORMAT).alias(LOG_TIME),
        F.concat(
            F.when(F.col("user_id") % 7 == 0, F.lit("anon")).otherwise(F.lit("cookie")), F.col("user_id").cast("string")
        ).alias(COOKIE),
        F.concat(F.lit("10.0.0."), F.pmod("user_id", F.lit(256)).cast("string")).alias(IP),
        F.pmod("event_id", n_pages).alias("page_id"),
        F.col("event_id").alias(ORDER),
    )
    return logs.join(pages, "page_id", "left").select(LOG_TYPE, LOG_TIME, COOKIE, IP, URL, ORDER)


def track_log_lines_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The visit log as raw ``|``-separated text lines (``value``), with one
    ``#`` comment line per cookie, ready for :func:`parse_track_log`."""
    logs = track_log_from_events(spark, sf_dir)
    data = logs.select(
        F.concat_ws("|", LOG_TYPE, LOG_TIME, COOKIE, IP, URL).alias("value"), F.col(ORDER)
    )
    comments = logs.groupBy(COOKIE).agg(F.min(ORDER).alias(ORDER)).select(
        F.concat(F.lit("#visits of "), F.col(COOKIE)).alias("value"), (-F.col(ORDER) - 1).alias(ORDER)
    )
    return data.unionByName(comments)


def cookie_labels_from_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.concat(F.lit("cookie"), F.col("c_custkey").cast("string")).alias(COOKIE),
        F.col("c_mktsegment").alias("cookie_label"),
    )


def cookie_label_lines_from_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = cookie_labels_from_customers(spark, sf_dir)
    return labels.select(F.concat_ws("|", COOKIE, "cookie_label").alias("value"))


def domain_labels_from_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    host = F.regexp_extract(F.col(URL), URL_HOST_PATTERN, 1)
    hosts = table(spark, sf_dir, "pages").select(host.alias("domain")).distinct()
    label = (
        F.when(F.col("domain").startswith("www."), F.lit("level1"))
        .when(F.col("domain").startswith("blog."), F.lit("level2"))
        .when(F.col("domain").startswith("m."), F.lit("level3"))
        .otherwise(F.lit("level4"))
    )
    return hosts.select("domain", label.alias("domain_label"))


# Same adapter in DuckDB SQL, for the oracle queries.
SQL_TRACK_LOG = """
SELECT CASE WHEN e.event_type = 'view' THEN 'pageview' ELSE e.event_type END AS log_type,
       strftime(e.ts, '%Y-%m-%d %H:%M:%S') AS log_server_time,
       CASE WHEN e.user_id % 7 = 0 THEN 'anon' ELSE 'cookie' END || CAST(e.user_id AS VARCHAR) AS cookie,
       '10.0.0.' || CAST(e.user_id % 256 AS VARCHAR) AS ip,
       CASE p.page_id % 10 WHEN 0 THEN 'http://www.baidu.com/p' || CAST(p.page_id AS VARCHAR)
                           WHEN 1 THEN 'http://tieba.baidu.com/p' || CAST(p.page_id AS VARCHAR)
                           WHEN 2 THEN 'http://jd.com/p' || CAST(p.page_id AS VARCHAR)
                           WHEN 3 THEN 'http://youku.com/p' || CAST(p.page_id AS VARCHAR)
                           ELSE p.url END AS url,
       e.event_id AS log_order
FROM events e
LEFT JOIN pages p ON p.page_id = e.event_id % (SELECT count(*) FROM pages)
"""

SQL_COOKIE_LABELS = """
SELECT 'cookie' || CAST(c_custkey AS VARCHAR) AS cookie, c_mktsegment AS cookie_label
FROM customer
"""

SQL_DOMAIN_LABELS = """
SELECT domain,
       CASE WHEN starts_with(domain, 'www.') THEN 'level1'
            WHEN starts_with(domain, 'blog.') THEN 'level2'
            WHEN starts_with(domain, 'm.') THEN 'level3' ELSE 'level4' END AS domain_label
FROM (SELECT DISTINCT regexp_extract(url, '^(?i:https?|ftp)://(?:[^/?#]*@)?(\\[[^\\]/?#]*\\]|[^:/?#]*)', 1) AS domain
      FROM pages)
"""
