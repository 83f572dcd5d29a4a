"""Hand-made edge rows and the reconstructed golden run (see FIXTURES.md)."""

from __future__ import annotations

import pytest
from conftest import lines_df

from visitflow.operators.cut import pageview_cut, time_gap_cut
from visitflow.plans.etl import session_etl
from visitflow.sources.text import parse_cookie_labels, parse_track_log

EDGE_LINES = [
    "#type|time|cookie|ip|url",
    "pageview|2017-09-04 12:00:00|cookie1|10.0.0.1|https://www.baidu.com",
    "click|2017-09-04 12:29:59|cookie1|10.0.0.2|https://www.baidu.com/x",
    "exposure|2017-09-04 12:45:00|cookie1|10.0.0.9|https://jd.com/ad",
    "click|2017-09-04 12:59:59|cookie1|10.0.0.3|https://www.baidu.com/y",
    "pageview|2017-09-04 13:29:58|cookie1|10.0.0.4|http://u:p@tieba.baidu.com:8080/z?q=1",
    "pageview|2017-09-04 09:00:05|cookie2|10.0.0.6|http://www.jd.com/a_b c",
    "click|2017-09-04 09:00:00|cookie2|10.0.0.5|http://jd.com",
    "click|2017-09-04 08:00:00|cookie9|10.0.0.7|http://youku.com",
    "Click|2017-09-04 08:20:00|cookie9|10.0.0.7|http://youku.com",
    "click|2017-09-04 08:40:00|cookie9|10.0.0.8|http://youku.com",
    "pageview|2017-09-04 10:00:00|cookie3|10.0.0.1|http://youku.com/1",
    "click|2017-09-04 10:00:00|cookie3|10.0.0.1|http://youku.com/2",
    "pageview|2017-09-04 10:00:00|cookie3|10.0.0.1|http://youku.com/3|extra",
]
LABEL_LINES = ["cookie1|L1", "cookie2|L2", "cookie3|L3", "cookie4|L4"]

COLS = ["cookie", "session_server_time", "cookie_label", "ip", "landing_url", "pageview_count", "click_count", "domain", "domain_label"]

EXPECTED_TIME_GAP = [
    ("cookie1", "2017-09-04 12:00:00", "L1", "10.0.0.1", "https://www.baidu.com", 1, 1, "www.baidu.com", "level1"),
    ("cookie1", "2017-09-04 12:59:59", "L1", "10.0.0.3", "http://u:p@tieba.baidu.com:8080/z?q=1", 1, 1, "tieba.baidu.com", "level2"),
    ("cookie2", "2017-09-04 09:00:00", "L2", "10.0.0.5", "http://www.jd.com/a_b c", 1, 1, "www.jd.com", "-"),
    ("cookie3", "2017-09-04 10:00:00", "L3", "10.0.0.1", "http://youku.com/1", 2, 1, "youku.com", "level4"),
    ("cookie9", "2017-09-04 08:00:00", "-", "10.0.0.7", "-", 0, 1, "-", "-"),
    ("cookie9", "2017-09-04 08:40:00", "-", "10.0.0.8", "-", 0, 1, "-", "-"),
]

EXPECTED_PAGEVIEW = [
    ("cookie1", "2017-09-04 12:00:00", "L1", "10.0.0.1", "https://www.baidu.com", 1, 2, "www.baidu.com", "level1"),
    ("cookie1", "2017-09-04 13:29:58", "L1", "10.0.0.4", "http://u:p@tieba.baidu.com:8080/z?q=1", 1, 0, "tieba.baidu.com", "level2"),
    ("cookie2", "2017-09-04 09:00:00", "L2", "10.0.0.5", "-", 0, 1, "-", "-"),
    ("cookie2", "2017-09-04 09:00:05", "L2", "10.0.0.6", "http://www.jd.com/a_b c", 1, 0, "www.jd.com", "-"),
    ("cookie3", "2017-09-04 10:00:00", "L3", "10.0.0.1", "http://youku.com/1", 1, 1, "youku.com", "level4"),
    ("cookie3", "2017-09-04 10:00:00", "L3", "10.0.0.1", "http://youku.com/3", 1, 0, "youku.com", "level4"),
    ("cookie9", "2017-09-04 08:00:00", "-", "10.0.0.7", "-", 0, 2, "-", "-"),
]


def _run(spark, lines, cut, num_partitions=None):
    logs = parse_track_log(lines_df(spark, lines))
    labels = parse_cookie_labels(spark.createDataFrame([(v,) for v in LABEL_LINES], "value string"))
    out = session_etl(logs, labels, cut=cut, num_partitions=num_partitions)
    return sorted(tuple(r[c] for c in COLS) for r in out.collect()), out


@pytest.mark.parametrize("parts", [None, 1, 3, 13])
def test_edge_rows_time_gap(spark, parts):
    got, _ = _run(spark, EDGE_LINES, time_gap_cut(), parts)
    assert got == sorted(EXPECTED_TIME_GAP)


@pytest.mark.parametrize("parts", [None, 1, 3, 13])
def test_edge_rows_pageview(spark, parts):
    got, out = _run(spark, EDGE_LINES, pageview_cut(), parts)
    assert got == sorted(EXPECTED_PAGEVIEW)
    ids = [r.session_id for r in out.select("session_id").collect()]
    assert len(set(ids)) == len(ids)
    assert [f.name for f in out.schema.fields] == [
        "session_id", "session_server_time", "cookie", "cookie_label", "ip",
        "landing_url", "pageview_count", "click_count", "domain", "domain_label",
    ]


GOLDEN_BLOCK = [
    "pageview|2017-09-04 12:00:00|cookie1|127.0.0.3|https://www.baidu.com",
    "click|2017-09-04 12:00:02|cookie1|127.0.0.3|https://www.baidu.com",
    "click|2017-09-04 12:00:04|cookie1|127.0.0.3|https://www.baidu.com",
    "pageview|2017-09-04 12:45:01|cookie1|127.0.0.3|https://tieba.baidu.com/index.html",
    "click|2017-09-04 12:45:02|cookie1|127.0.0.3|https://tieba.baidu.com/index.html",
    "click|2017-09-04 12:45:03|cookie1|127.0.0.3|https://tieba.baidu.com/index.html",
]
GOLDEN_LABELS = ["cookie1|固执", "cookie2|有偏见", "cookie3|执着", "cookie4|执行力很强"]


def _golden(spark, cut, parts):
    logs = parse_track_log(lines_df(spark, GOLDEN_BLOCK * 840))
    labels = parse_cookie_labels(spark.createDataFrame([(v,) for v in GOLDEN_LABELS], "value string"))
    return session_etl(logs, labels, cut=cut, num_partitions=parts)


@pytest.mark.parametrize("parts", [None, 16])
def test_golden_pageview(spark, parts):
    out = _golden(spark, pageview_cut(), parts)
    groups = (
        out.groupBy("session_server_time", "landing_url", "pageview_count", "click_count", "domain", "domain_label", "cookie_label", "ip")
        .count()
        .collect()
    )
    got = sorted((r.session_server_time, r.domain, r.domain_label, r.pageview_count, r.click_count, r["count"]) for r in groups)
    assert got == [
        ("2017-09-04 12:00:00", "www.baidu.com", "level1", 1, 0, 839),
        ("2017-09-04 12:00:00", "www.baidu.com", "level1", 1, 1680, 1),
        ("2017-09-04 12:45:01", "tieba.baidu.com", "level2", 1, 0, 839),
        ("2017-09-04 12:45:01", "tieba.baidu.com", "level2", 1, 1680, 1),
    ]
    assert {r.cookie_label for r in groups} == {"固执"}
    assert {r.ip for r in groups} == {"127.0.0.3"}
    assert out.select("session_id").distinct().count() == 1680


@pytest.mark.parametrize("parts", [None, 16])
def test_golden_time_gap(spark, parts):
    out = _golden(spark, time_gap_cut(), parts).collect()
    got = sorted((r.session_server_time, r.pageview_count, r.click_count, r.domain) for r in out)
    assert got == [
        ("2017-09-04 12:00:00", 840, 1680, "www.baidu.com"),
        ("2017-09-04 12:45:01", 840, 1680, "tieba.baidu.com"),
    ]
