"""Random logs against a plain-Python sessionizer written from the rules:
sort each cookie by (time string, order), cut, summarise."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest

from visitflow.operators.cut import day_change_cut, pageview_cut, time_gap_cut
from visitflow.operators.sessionize import assign_sessions, build_sessions

GAP = 30 * 60


def _brute(logs, rule):
    by_cookie = {}
    for row in logs:
        if row[0] in ("click", "pageview"):
            by_cookie.setdefault(row[2], []).append(row)
    out = []
    for cookie, rows in by_cookie.items():
        rows.sort(key=lambda r: (r[1], r[5]))
        sessions, prev = [], None
        for r in rows:
            t = datetime.strptime(r[1], "%Y-%m-%d %H:%M:%S")
            if prev is None:
                new = True
            elif rule == "pageview":
                new = r[0] == "pageview"
            elif rule == "gap":
                new = (t - prev).total_seconds() >= GAP
            else:
                new = r[1][:10] != prev_day
            if new:
                sessions.append([])
            sessions[-1].append(r)
            prev, prev_day = t, r[1][:10]
        for seq, s in enumerate(sessions, 1):
            pvs = [r for r in s if r[0] == "pageview"]
            out.append(
                (cookie, seq, s[0][1], s[0][3], pvs[0][4] if pvs else "-", len(pvs), sum(r[0] == "click" for r in s))
            )
    return sorted(out)


def _random_logs(seed):
    rnd = random.Random(seed)
    base = datetime(2017, 9, 4, 23, 0, 0)
    cookies = ["hot"] * 6 + [f"c{i}" for i in range(12)]  # one cookie with a third of the rows or more
    steps = [0, 1, 29 * 60 + 59, 30 * 60, 30 * 60 + 1, 3600, 7200]
    logs, clock = [], {c: base + timedelta(seconds=rnd.randrange(0, 4000)) for c in set(cookies)}
    for order in range(rnd.randrange(150, 400)):
        c = rnd.choice(cookies)
        clock[c] += timedelta(seconds=rnd.choice(steps))
        t = clock[c] - timedelta(seconds=rnd.choice([0, 0, 0, 5]))  # some out-of-order arrivals
        kind = rnd.choice(["click", "click", "pageview", "exposure"])
        logs.append((kind, t.strftime("%Y-%m-%d %H:%M:%S"), c, f"10.0.{order % 7}.1", f"http://h{order % 5}.com/{order}", order))
    return logs


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("rule", ["pageview", "gap", "day"])
def test_random_logs_match_brute_force(spark, seed, rule):
    logs = _random_logs(seed)
    df = spark.createDataFrame(logs, "log_type string, log_server_time string, cookie string, ip string, url string, log_order long")
    df = df.where(df.log_type.isin("click", "pageview"))
    cut = {"pageview": pageview_cut(), "gap": time_gap_cut(), "day": day_change_cut()}[rule]
    parts = random.Random(seed).choice([1, 3, 9, 40])
    got = sorted(
        (r.cookie, r.session_seq, r.session_server_time, r.ip, r.landing_url, r.pageview_count, r.click_count)
        for r in build_sessions(df, cut, num_partitions=parts).collect()
    )
    exp = _brute(logs, rule)
    assert got == exp
    rows = assign_sessions(df, cut, num_partitions=parts + 2).collect()
    per_cookie = {}
    for r in rows:
        per_cookie[r.cookie] = max(per_cookie.get(r.cookie, 0), r.session_seq)
    assert per_cookie == {c: max(e[1] for e in exp if e[0] == c) for c in {e[0] for e in exp}}
