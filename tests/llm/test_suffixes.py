"""Suffix-array dedup against a table of all 50-byte strings, and its parts against plain sorting."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from visitflow.llm import suffixes


def _brute(rows):
    least = {}
    for doc, text in rows:
        data = (text or "").encode()
        doc = -(2**63) if doc is None else doc
        for i in range(len(data) - 49):
            w = data[i : i + 50]
            least[w] = min(least.get(w, doc), doc)
    out = []
    for doc, text in rows:
        data = (text or "").encode()
        own = -(2**63) if doc is None else doc
        gone = [False] * len(data)
        for i in range(len(data) - 49):
            if least[data[i : i + 50]] < own:
                gone[i : i + 50] = [True] * 50
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out.append((doc, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def _got(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _texts(seed):
    rnd = random.Random(seed)

    def prose(n):
        return " ".join(rnd.choice(["ab", "the", "é", "word", "long", "x", "日本"]) for _ in range(n))

    passages = [prose(rnd.randrange(12, 60)) for _ in range(6)]
    rows = []
    for doc in range(60):
        parts = [prose(rnd.randrange(0, 40))]
        for _ in range(rnd.randrange(0, 4)):
            p = rnd.choice(passages)
            if rnd.random() < 0.3:
                at = rnd.randrange(len(p))
                p = p[:at] + "#" + p[at:]
            parts += [p, prose(rnd.randrange(0, 20))]
        rows.append((rnd.randrange(1000) if rnd.random() < 0.9 else doc, " ".join(parts)))
    rows += [rows[0], (5000, rows[1][1]), (5001, rows[1][1]), (None, rows[2][1][:200]), (None, passages[0] * 2)]
    rows += [(6000, None), (6001, ""), (6002, "short"), (6003, "a" * 400), (6004, "a" * 300), (6005, "ab" * 200), (6006, "a" * 50), (6006, "a" * 50 + "b")]
    rows += [(6007, "x" * 49), (6008, "x" * 49), (6009, "\0" * 120), (6010, "q" + "\0" * 90)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_a_table_of_all_strings(spark, monkeypatch, seed):
    rows = _texts(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as doc", "'x' as h1", "2 as shard")
    want = _brute(rows)
    assert sum(r[2] for r in want) > 1000
    monkeypatch.setattr(suffixes, "SHARD", 3000)
    assert _got(suffixes.query(docs)) == want
    monkeypatch.setattr(suffixes, "HOT", 2)  # most minimizers take the path of single windows
    monkeypatch.setattr(suffixes, "BLOCK", 300)
    assert _got(suffixes.query(docs)) == want


def test_empty_table(spark):
    assert suffixes.query(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_shards_made_of_copies_alone(spark, monkeypatch):
    text = " ".join(f"word{i}" for i in range(40))
    rows = [(doc, text) for doc in range(30)] + [(50, text + " and an end of its own"), (0, text)]
    monkeypatch.setattr(suffixes, "SHARD", 700)  # two texts in a shard
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert _got(suffixes.query(docs)) == _brute(rows)
    packs = suffixes.shards(docs).select("docs", "copies").collect()
    assert sum(len(p["copies"] or []) for p in packs) == 29
    assert any(len(p["copies"] or []) == len(p["docs"]) // 8 for p in packs)


def test_suffix_array_and_prefixes_match_plain_sorting():
    rnd = random.Random(4)
    strings = [bytes(rnd.choice(b"ab") for _ in range(rnd.randrange(5, 90))) for _ in range(60)] + [b"a" * 80, b"a" * 70, b"a" * 80]
    data = np.frombuffer(b"\xff".join(strings) + b"\xff", np.uint8)
    ends = np.cumsum([len(s) + 1 for s in strings]) - 1
    starts = ends - [len(s) for s in strings]
    order = suffixes.suffix_array(data, ends)
    of = np.searchsorted(ends, np.arange(len(data)))
    plain = sorted(range(len(data)), key=lambda i: (data[i : ends[of[i]]].tobytes() + b"\xff", of[i]))
    assert order.tolist() == plain
    shared = suffixes.common_prefixes(data, order, starts, ends, 5)
    for a, b in zip(plain, plain[1:]):
        if ends[of[b]] - b >= 5:
            x, y = data[a : ends[of[a]]].tobytes(), data[b : ends[of[b]]].tobytes()
            n = next((k for k, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
            assert shared[b] == min(n, 5)
