"""Scalar Column builders (all JVM-side built-ins, no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from visitflow.schema import MISSING

# Fixed pattern: host of an http(s)/ftp URL, without userinfo and port,
# case kept; IPv6 literals keep their brackets.
URL_HOST_PATTERN = r"^(?i:https?|ftp)://(?:[^/?#]*@)?(\[[^\]/?#]*\]|[^:/?#]*)"
URL_SCHEME_PATTERN = r"^(?i:https?|ftp)://"
# Fixed pattern: the shape of a log time.
TIME_SHAPE = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"

FAILFAST = "FAILFAST"
DROPMALFORMED = "DROPMALFORMED"
MODES = (FAILFAST, DROPMALFORMED)


def check_mode(mode: str) -> str:
    m = mode.upper()
    if m not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    return m


def split_fields(line: Column) -> Column:
    """Split a line on ``|`` the way Java's ``String.split`` does: trailing
    empty fields are dropped, inner empty fields kept."""
    return F.split(F.regexp_replace(line, r"\|+$", ""), r"\|", -1)


def field(fields: Column, i: int) -> Column:
    """0-based field ``i`` of a split line, null when absent."""
    return F.get(fields, i)


def log_time_ms(t: Column, strict: bool = True) -> Column:
    """Milliseconds of a ``yyyy-MM-dd HH:mm:ss`` wall-clock time, counted in UTC
    whatever the session's zone.  ``strict`` raises on a value that does not
    parse instead of yielding null."""

    def part(start: int, below: int) -> Column:
        value = F.substring(t, start, 2).try_cast("int")
        return F.when(value < below, value)

    day = F.to_date(F.try_to_timestamp(F.substring(t, 1, 10), F.lit("yyyy-MM-dd")))
    seconds = F.unix_date(day).cast("long") * 86400 + part(12, 24) * 3600 + part(15, 60) * 60 + part(18, 60)
    ms = F.when(t.rlike(TIME_SHAPE), seconds * 1000)
    if not strict:
        return ms
    return F.when(ms.isNull(), F.raise_error(F.concat(F.lit("unparseable log time: "), F.coalesce(t, F.lit("null"))))).otherwise(ms)


def url_host(url: Column, mode: str = FAILFAST) -> Column:
    """Host part of an http(s)/ftp URL (no port, no userinfo, case kept).
    A URL without such a scheme raises (``FAILFAST``) or gives ``""``."""
    host = F.regexp_extract(url, URL_HOST_PATTERN, 1)
    if check_mode(mode) == DROPMALFORMED:
        return host
    return F.when(url.rlike(URL_SCHEME_PATTERN), host).otherwise(
        F.raise_error(F.concat(F.lit("no host in landing url: "), F.coalesce(url, F.lit("null"))))
    )


def or_missing(c: Column) -> Column:
    """Null → ``"-"`` (the data model never holds nulls)."""
    return F.coalesce(c, F.lit(MISSING))


def json_line(*cols: str) -> Column:
    """One JSON object per row with the given columns in order."""
    return F.to_json(F.struct(*[F.col(c) for c in cols]))
