"""Secret scan: the scope is the gap between two parts, however long they are."""

from __future__ import annotations

import random

from visitflow.llm import secrets

TEXTS = "doc_id long, text string"


def test_long_parts_that_touch_are_linked(spark):
    url = "https://h.example/" + "x." * 400  # no bare token inside
    key = "Zz09+/" * 60
    far = ". " * 130
    rows = [
        (1, key + "\nclient_id=abc9"),
        (2, "client_id=abc9 " + key),
        (3, url + " " + key),
        (4, key + far + "client_id=abc9"),
    ]
    got = {r.doc_id: r.spans for r in secrets.secret_scan(spark.createDataFrame(rows, TEXTS)).collect()}
    assert got[1] == f"token:0:{len(key)},identifier:{len(key) + 1}:{len(key) + 15}"
    assert got[2] == f"identifier:0:14,token:15:{15 + len(key)}"
    assert got[3].split(",")[0] == f"endpoint:0:{len(url)}" and f"token:{len(url) + 1}:{len(url) + 1 + len(key)}" in got[3]
    assert got[4] == ""


def test_links_match_every_pair(spark):
    rnd = random.Random(3)
    parts = []
    for key in "abc":
        at = 0
        for _ in range(60):
            at += rnd.choice([0, 5, 255, 256, 257, 900])
            size = rnd.choice([1, 40, 256, 300, 2000])
            kind, part, weak = rnd.choice([("token", "secret", True), ("endpoint", "endpoint", True), ("hex", "secret", False)])
            parts.append((key, kind, part, weak, at, at + size))
            at += size
    df = spark.createDataFrame(parts, "key string, kind string, class string, weak boolean, start int, end int")
    for scope in (256, 10):
        want = {
            p
            for p in parts
            for o in parts
            if p[3] and p[0] == o[0] and (p[2] == "secret") != (o[2] == "secret") and max(p[4], o[4]) - min(p[5], o[5]) <= scope
        }
        got = [tuple(r) for r in secrets.linked(df, scope).select("key", "kind", "class", "weak", "start", "end").collect()]
        assert len(got) == len(want) < len(parts) and set(got) == want
