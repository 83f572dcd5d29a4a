"""URL filter: a host's distrust does not shrink with the number of hosts that link as it does."""

from __future__ import annotations

import random

import duckdb
import numpy as np

from visitflow.llm import urls

PAGES = "page_id long, url string, html string"


def _links(*hosts):
    return "".join(f"<a href='http://{h}/x'>x</a>" for h in hosts)


def _farm():
    rows = [(0, "http://bad.com/de/1", None), (1, "http://good.org/a", _links("liked.net", *[f"n{i}.net" for i in range(9)]))]
    rows += [(100 + i, f"http://farm{i}.net/p", _links("bad.com")) for i in range(30)]
    rows += [(200, "http://above.net/p", _links("farm1.net", "farm2.net"))]
    rows += [(300, "http://list.net/p", _links("bad.com", *[f"n{i}.net" for i in range(9)]))]
    rows += [(301, "http://liked.net/p", _links("n1.net")), (302, "http://alone.net/p", None)]
    return rows


def test_farm_on_one_blocked_host_is_blocked(spark):
    got = {r.page_id: r.verdict for r in urls.url_filter(spark.createDataFrame(_farm(), PAGES)).collect()}
    assert [i for i, v in sorted(got.items()) if v == "block"] == [0, *range(100, 130), 200]


def _linked(seed):
    """Made pages of hosts that link to allowed and blocked ones at random."""
    rnd = random.Random(seed)
    names = ["a.org", "B.org", "x.com", "y.com", "example.org"] + [f"n{i}.net" for i in range(25)]
    rows = []
    for i in range(120):
        host, path = rnd.choice(names), rnd.choice(["de/1", "fr/2", "es/3", "en/1", "q"])
        near = rnd.choices(names, k=rnd.randrange(6))
        if host == "x.com":
            path = "de/1"
        if host in ("n1.net", "n2.net", "n3.net", "n4.net"):  # mostly link to blocked pages
            near = near[:1] + ["x.com"] * 6
        rows.append((i, f"http://{host}/{path}", _links(*near) if i % 9 else None))
    return [*rows, (900, None, None), (901, "no host", _links("x.com"))]


def test_sql_states_the_walks(spark):
    for rows in (_linked(4), _farm(), [(1, "http://x.net/a", None)]):
        pages = spark.createDataFrame(rows, PAGES)
        con = duckdb.connect()
        con.register("pages", pages.toPandas())
        want = sorted(con.execute(urls.oracle()).fetchall(), key=repr)
        got = sorted(map(tuple, urls.query(pages).collect()), key=repr)
        assert got == want
        if len(rows) > 1:
            assert {v for *_, rule, v in got if rule is None} == {"allow", "block"}


def test_walks_reach_their_limits(spark):
    rnd = random.Random(8)
    names = [f"h{i}" for i in range(14)]
    edges = {(a, b): rnd.randrange(1, 5) for a in names for b in rnd.sample(names, rnd.randrange(4)) if a != b} | {("h0", "h1"): 1, ("h1", "h0"): 1}
    df = spark.createDataFrame([(a, b, n) for (a, b), n in edges.items()], "src string, dst string, n long")
    bad, good = {"h1": 1.0, "h5": 0.25}, {"h2": 1.0, "h3": 0.5}
    seeds = spark.createDataFrame([(h, good.get(h, 0.0), bad.get(h, 0.0)) for h in names], "host string, trust double, distrust double")
    at = {h: i for i, h in enumerate(names)}
    step = np.zeros((14, 14))
    for (a, b), n in edges.items():
        step[at[a], at[b]] = n
    out = step.sum(axis=1, keepdims=True)
    step = np.divide(step, out, out=np.zeros_like(step), where=out > 0)
    s = np.array([bad.get(h, 0.0) for h in names])
    exact = np.linalg.solve(np.eye(14) - (1 - s)[:, None] * urls.DAMPING * step, s)
    got = {r.host: r.distrust for r in urls.reach(seeds, df).collect()}
    assert all(abs(got.get(h, 0.0) - exact[i]) < 1e-3 for h, i in at.items())
    g = np.array([good.get(h, 0.0) for h in names])
    rank = g.copy()
    for _ in range(400):
        moved = urls.DAMPING * rank @ step
        rank = moved + g * (1 - moved.sum() / g.sum())
    got = {r.host: r.trust for r in urls.propagate(seeds, df, tolerance=1e-4).collect()}
    assert all(abs(got.get(h, 0.0) - rank[i]) < 2e-3 for h, i in at.items())
