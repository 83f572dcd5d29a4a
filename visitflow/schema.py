"""Column names, schemas and fixed values of the track-log data model."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values that must equal the reference job's for identical results.
MISSING = "-"
LOG_TYPES = ("click", "pageview")
PAGEVIEW = "pageview"
CLICK = "click"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
DEFAULT_GAP_MS = 30 * 60 * 1000
DEFAULT_DOMAIN_LABELS = (
    ("www.baidu.com", "level1"),
    ("tieba.baidu.com", "level2"),
    ("jd.com", "level3"),
    ("youku.com", "level4"),
)

# Column names of one parsed log row.
LOG_TYPE = "log_type"
LOG_TIME = "log_server_time"
COOKIE = "cookie"
IP = "ip"
URL = "url"
# Tiebreak for logs with equal time: a unique, deterministic long per row.
ORDER = "log_order"

TRACKER_LOG = T.StructType(
    [
        T.StructField(LOG_TYPE, T.StringType(), False),
        T.StructField(LOG_TIME, T.StringType(), False),
        T.StructField(COOKIE, T.StringType(), False),
        T.StructField(IP, T.StringType(), False),
        T.StructField(URL, T.StringType(), False),
    ]
)

TRACKER_SESSION = T.StructType(
    [
        T.StructField("session_id", T.StringType(), False),
        T.StructField("session_server_time", T.StringType(), False),
        T.StructField("cookie", T.StringType(), False),
        T.StructField("cookie_label", T.StringType(), False),
        T.StructField("ip", T.StringType(), False),
        T.StructField("landing_url", T.StringType(), False),
        T.StructField("pageview_count", T.IntegerType(), False),
        T.StructField("click_count", T.IntegerType(), False),
        T.StructField("domain", T.StringType(), False),
        T.StructField("domain_label", T.StringType(), False),
    ]
)

LOG_COLUMNS = [f.name for f in TRACKER_LOG.fields]
SESSION_COLUMNS = [f.name for f in TRACKER_SESSION.fields]
