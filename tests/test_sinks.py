"""Output datasets and the whole job from text files."""

from __future__ import annotations

import json
import os
import tempfile

import pytest

from visitflow.plans.etl import CONF_COOKIE_LABELS, CONF_OUTPUT, CONF_VISIT_LOG, run_session_etl
from visitflow.sources.sinks import read_dataset

from test_fixtures import EDGE_LINES, EXPECTED_PAGEVIEW, LABEL_LINES


@pytest.fixture()
def inputs():
    d = tempfile.mkdtemp(prefix="visitflow-test-")
    visit = os.path.join(d, "visit_log.txt")
    labels = os.path.join(d, "cookie_label.txt")
    with open(visit, "w") as f:
        f.write("\n".join(EDGE_LINES) + "\n")
    with open(labels, "w") as f:
        f.write("\n".join(LABEL_LINES))  # no trailing newline, as the sample file
    return d, visit, labels


@pytest.mark.parametrize("fmt", ["text", "parquet"])
def test_run_session_etl(spark, inputs, fmt):
    d, visit, labels = inputs
    out = os.path.join(d, "output")
    os.makedirs(out)
    keep = os.path.join(out, "unrelated.txt")
    open(keep, "w").close()
    res = run_session_etl(spark, visit, labels, out, fmt)
    assert res.session_total == len(EXPECTED_PAGEVIEW)
    sessions = read_dataset(spark, f"{out}/trackerSession", "session", fmt).collect()
    assert sorted((r.cookie, r.session_server_time, r.click_count) for r in sessions) == sorted(
        (e[0], e[1], e[6]) for e in EXPECTED_PAGEVIEW
    )
    logs = read_dataset(spark, f"{out}/trackerlog", "log", fmt).collect()
    assert len(logs) == 13  # every parsed log, also types other than click/pageview
    assert {r.log_type for r in logs} == {"pageview", "click", "exposure", "Click"}
    assert os.path.exists(keep)  # only the two datasets are overwritten
    # a second run overwrites
    assert run_session_etl(spark, visit, labels, out, fmt).session_total == len(EXPECTED_PAGEVIEW)


def test_text_lines_are_json(spark, inputs):
    d, visit, labels = inputs
    out = os.path.join(d, "out-json")
    run_session_etl(spark, visit, labels, out, "text")
    parts = sorted(p for p in os.listdir(f"{out}/trackerSession") if p.startswith("part-"))
    lines = [ln for p in parts for ln in open(f"{out}/trackerSession/{p}", encoding="utf-8") if ln.strip()]
    assert len(lines) == len(EXPECTED_PAGEVIEW)
    rec = json.loads(lines[0])
    assert list(rec) == [
        "session_id", "session_server_time", "cookie", "cookie_label", "ip",
        "landing_url", "pageview_count", "click_count", "domain", "domain_label",
    ]


def test_conf_paths_and_guards(spark, inputs):
    d, visit, labels = inputs
    out = os.path.join(d, "conf-out")
    spark.conf.set(CONF_VISIT_LOG, visit)
    spark.conf.set(CONF_COOKIE_LABELS, labels)
    spark.conf.set(CONF_OUTPUT, out)
    try:
        assert run_session_etl(spark).session_total == len(EXPECTED_PAGEVIEW)
    finally:
        for k in (CONF_VISIT_LOG, CONF_COOKIE_LABELS, CONF_OUTPUT):
            spark.conf.unset(k)
    with pytest.raises(ValueError):
        run_session_etl(spark, visit, labels, out, "csv")
    with pytest.raises(ValueError):
        run_session_etl(spark, visit, labels, d, "text")  # input under output


def test_uuid_ids_and_unique_labels(spark, inputs):
    d, visit, labels = inputs
    out = os.path.join(d, "uuid-out")
    res = run_session_etl(spark, visit, labels, out, "parquet", session_ids="uuid", unique_labels=True)
    ids = [r.session_id for r in read_dataset(spark, f"{out}/trackerSession", "session", "parquet").collect()]
    assert res.session_total == len(ids) == len(set(ids)) == len(EXPECTED_PAGEVIEW)
    assert all(len(i) == 36 and i[14] == "4" for i in ids)  # UUID version 4
    dup = os.path.join(d, "dup_labels.txt")
    with open(dup, "w") as f:
        f.write("cookie1|a\ncookie1|b\n")
    with pytest.raises(ValueError):
        run_session_etl(spark, visit, dup, os.path.join(d, "dup-out"), "text", unique_labels=True)


def test_job_main_honours_conf_and_format(spark, tmp_path):
    from visitflow.plans import etl

    logs, labels, out = tmp_path / "log.txt", tmp_path / "label.txt", tmp_path / "out"
    logs.write_text("#comment\npageview|2017-09-04 10:00:00|c1|1.1.1.1|http://jd.com/x\nclick|2017-09-04 10:00:05|c1|1.1.1.1|http://jd.com/y\n")
    labels.write_text("c1|gold\n")
    conf = {etl.CONF_VISIT_LOG: str(logs), etl.CONF_COOKIE_LABELS: f"file://{labels}", etl.CONF_OUTPUT: str(out)}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        for fmt in ("text", "parquet"):
            result = etl.main([fmt])
            assert (result.session_total, result.fmt) == (1, fmt)
        assert spark.read.parquet(f"{out}/trackerSession").first().cookie_label == "gold"
        spark.conf.set(etl.CONF_OUTPUT, f"file://{tmp_path}/")
        with pytest.raises(ValueError, match="under the output path"):
            etl.main([])
    finally:
        for k in conf:
            spark.conf.unset(k)
