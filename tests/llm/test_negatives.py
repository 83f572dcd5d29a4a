"""Hard negatives against all pairs in plain Python, and the parts of the index."""

from __future__ import annotations

import math
import random

import numpy as np

from visitflow.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


def _brute(rows):
    kept = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        row = (label, [math.floor(256 * float(np.float32(x))) for x in v])
        kept[i] = min(kept.get(i, row), row)

    def score(a, b):
        return sum(x * y for x, y in zip(kept[a][1], kept[b][1]))

    out = []
    for a in kept:
        if a % 50:
            continue
        pos = sorted((b for b in kept if b != a and kept[b][0] == kept[a][0]), key=lambda b: (-score(a, b), b))[:5]
        neg = sorted((b for b in kept if kept[b][0] != kept[a][0]), key=lambda b: (-score(a, b), b))
        for p in pos:
            fit = [b for b in neg if 50 * score(a, p) <= 100 * score(a, b) <= 95 * score(a, p)][:3]
            out += [(a, p, k, b, score(a, p), score(a, b)) for k, b in enumerate(fit, 1)]
    return sorted(out)


def _rows(seed, n, dims=12):
    rnd = random.Random(seed)
    centres = [[rnd.gauss(0, 0.4) for _ in range(dims)] for _ in range(6)]
    rows = []
    for i in range(n):
        c = rnd.randrange(6)
        rows.append((i, [x + rnd.gauss(0, 0.2) for x in centres[c]], c))
    rows += [(n, None, 1), (n + 1, [None] * dims, 1), (n + 2, [float("nan")] * dims, 1), (n + 3, [float("inf")] * dims, 1)]
    rows += [(n + 4, rows[0][1], None), (None, rows[0][1], 1), rows[5], rows[0], (n + 5, [], 2), (n + 6, rows[3][1][:4], 2)]
    rows += [(n + 10 + k, rows[50][1], k % 3) for k in range(30)]  # one common vector
    return rows


def _got(df):
    return sorted(map(tuple, df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()))


def test_matches_all_pairs(spark, monkeypatch):
    rows = _rows(1, 400)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as id", "'x' as place", "2 as v")
    want = _brute(rows)
    assert len(want) > 40
    assert _got(negatives.query(df)) == want
    monkeypatch.setattr(negatives, "BLOCK", 16)
    monkeypatch.setattr(negatives, "QUERIES", 3)
    monkeypatch.setattr(negatives, "ZONES", 4)
    assert _got(negatives.query(df)) == want


def test_empty_and_lonely(spark):
    assert negatives.query(spark.createDataFrame([], SCHEMA)).count() == 0
    assert negatives.query(spark.createDataFrame([(0, [1.0], 1), (1, None, 1)], SCHEMA)).count() == 0
    big = [(i, [1e4 * (i + 1), -3e5], i % 2) for i in range(60)]
    assert _got(negatives.query(spark.createDataFrame(big, SCHEMA))) == _brute(big)


def test_bounds_hold_and_leave_blocks_unread(spark):
    rnd = np.random.default_rng(5)
    v = rnd.integers(-300, 300, (20, 7))
    box = rnd.integers(-300, 300, (6, 40, 7))
    least, most = negatives.bounds(v, box.min(axis=1), box.max(axis=1))
    for k in range(6):
        scores = negatives.products(v, box[k])
        assert (scores >= least[:, k : k + 1]).all() and (scores <= most[:, k : k + 1]).all()
    # clusters far apart: most blocks are not met
    centres = rnd.normal(0, 40, (8, 16))
    near = np.concatenate([c + rnd.normal(0, 0.1, (50, 16)) for c in centres])
    places = negatives.Curve(near).places((near * 1).astype(np.int64))
    assert len(np.unique(places // max(1, places.max() // 64))) >= 4


def test_hilbert_neighbours_touch():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), axis=-1).reshape(-1, 3)
    order = grid[np.argsort(negatives.hilbert(grid, 3))]
    assert sorted(negatives.hilbert(grid, 3)) == list(range(512))
    assert (np.abs(np.diff(order, axis=0)).sum(axis=1) == 1).all()
