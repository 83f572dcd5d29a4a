"""Line parsing and malformed-input modes (FIXTURES.md §4)."""

from __future__ import annotations

import pytest
from conftest import lines_df
from pyspark.errors import PySparkException

from visitflow.operators.cut import _gap_ms, pageview_cut, time_gap_cut
from visitflow.operators.sessionize import build_sessions
from visitflow.plans.etl import session_etl
from visitflow.sources.text import parse_cookie_labels, parse_track_log

GOOD = "pageview|2017-09-04 12:00:00|c1|1.1.1.1|http://a.com/x"


def _parse(spark, lines, mode="FAILFAST"):
    return parse_track_log(lines_df(spark, lines), mode)


def test_split_rules(spark):
    rows = _parse(spark, [GOOD, "a|b|c|d||x", "a|b|c|d|e|f", "#comment", "##"]).collect()
    assert [r.url for r in rows] == ["http://a.com/x", "", "e"]
    assert rows[0].log_type == "pageview" and rows[0].cookie == "c1"


@pytest.mark.parametrize("bad", ["", "pageview|t|c|ip|", " #x", "a|b"])
def test_malformed_visit_line(spark, bad):
    with pytest.raises(PySparkException):
        _parse(spark, [GOOD, bad]).collect()
    assert len(_parse(spark, [GOOD, bad], "DROPMALFORMED").collect()) == 1


def test_malformed_label_line(spark):
    df = spark.createDataFrame([("cookie1|x",), ("cookie9|",)], "value string")
    with pytest.raises(PySparkException):
        parse_cookie_labels(df).collect()
    assert [tuple(r) for r in parse_cookie_labels(df, "DROPMALFORMED").collect()] == [("cookie1", "x")]


def test_bad_time(spark):
    lines = [GOOD, "click|bad|c1|1.1.1.1|http://a.com/y"]
    with pytest.raises(PySparkException):
        build_sessions(_parse(spark, lines), time_gap_cut()).collect()
    rows = build_sessions(_parse(spark, lines), time_gap_cut(), mode="DROPMALFORMED").collect()
    assert [(r.pageview_count, r.click_count) for r in rows] == [(1, 0)]
    # the pageview cut never parses the time
    rows = build_sessions(_parse(spark, lines), pageview_cut()).collect()
    assert sorted((r.pageview_count, r.click_count) for r in rows) == [(1, 1)]


def test_landing_without_scheme(spark):
    logs = _parse(spark, ["pageview|2017-09-04 12:00:00|c1|1.1.1.1|www.a.com/x"])
    labels = spark.createDataFrame([], "cookie string, cookie_label string")
    with pytest.raises(PySparkException):
        session_etl(logs, labels).collect()
    row = session_etl(logs, labels, mode="DROPMALFORMED").collect()[0]
    assert (row.domain, row.domain_label) == ("", "-")


def test_duplicate_labels_fan_out(spark):
    logs = _parse(spark, [GOOD])
    labels = spark.createDataFrame([("c1", "x"), ("c1", "y")], "cookie string, cookie_label string")
    got = sorted(r.cookie_label for r in session_etl(logs, labels).collect())
    assert got == ["x", "y"]


def test_url_hosts(spark):
    from pyspark.sql import functions as F

    from visitflow.functions.columns import url_host

    cases = {
        "https://www.baidu.com": "www.baidu.com",
        "http://u:p@tieba.baidu.com:8080/z?q=1": "tieba.baidu.com",
        "HTTP://Upper.Example.COM/x": "Upper.Example.COM",
        "http://[::1]:8080/x": "[::1]",
        "ftp://files.example.org": "files.example.org",
        "http://a_b.com/x": "a_b.com",
        "https://host.com?x=1": "host.com",
        "https://host.com#frag": "host.com",
    }
    df = spark.createDataFrame([(k,) for k in cases], "u string")
    got = {r.u: r.h for r in df.select("u", url_host(F.col("u")).alias("h")).collect()}
    assert got == cases


def test_gap_parsing():
    assert _gap_ms("30 minutes") == 1_800_000
    assert _gap_ms("6 hours") == 21_600_000
    assert _gap_ms(5) == 5


def _java_split(line):
    """Java ``line.split("\\\\|")``: trailing empty strings removed; an empty
    line gives one empty field; a line of pipes only gives no field."""
    if line == "":
        return [""]
    parts = line.split("|")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def test_split_matches_java_semantics(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st
    from pyspark.sql import functions as F

    from visitflow.functions.columns import split_fields

    @settings(max_examples=4, deadline=None)
    @given(st.lists(st.text(alphabet="ab|# ", max_size=12), min_size=1, max_size=300))
    def check(lines):
        df = spark.createDataFrame([(v,) for v in lines], "value string")
        got = [r.f for r in df.select(split_fields(F.col("value")).alias("f")).collect()]
        for line, fields in zip(lines, got):
            exp = _java_split(line)
            if exp == []:  # pipes only: malformed either way (1 field here, 0 in Java)
                assert fields == [""]
            else:
                assert fields == exp, line

    check()
