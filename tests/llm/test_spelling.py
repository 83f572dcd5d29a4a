"""Spelling variants against all pairs, compared in plain Python."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from visitflow.llm import spelling


def _near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def _brute(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'null' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    near = {w: [x for x in words if _near(w, x)] for w in words}
    form = {}
    for w in words:
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 10 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out, key=lambda r: r[0])


def _got(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[0])


def _texts(seed, n):
    rnd = random.Random(seed)
    stems = ["".join(rnd.choice("abcdeéÀ") for _ in range(rnd.randrange(6, 11))) for _ in range(25)]
    rows = []
    for doc in range(n):
        out = []
        for _ in range(rnd.randrange(0, 60)):
            w = rnd.choice(stems[:3] * 25 + stems)
            for _ in range(rnd.choice([0] * 12 + [1, 2])):
                at, c = rnd.randrange(len(w)), rnd.choice("abcdeéÀZ")
                w = rnd.choice([w[:at] + c + w[at:], w[:at] + w[at + 1 :], w[:at] + c + w[at + 1 :]])
            out.append(w.upper() if rnd.random() < 0.1 else w)
        rows.append((doc, rnd.choice([" ", ", ", "1", "\n"]).join(out)))
    return rows + [(None, "Abcdefgh abcdefgh"), (7, None), (8, ""), (9, "one two"), (9, rows[0][1]), (9, rows[0][1])]


def test_matches_all_pairs_whatever_the_tree(spark, monkeypatch):
    rows = _texts(1, 120)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit("clash")).withColumn("n", F.lit(5))
    want = _brute(rows)
    assert any(r[1] for r in want)
    assert _got(spelling.query(docs)) == want
    # many small leaves and buckets
    monkeypatch.setattr(spelling, "LEAF", 20)
    monkeypatch.setattr(spelling, "BUCKET", 4)
    assert _got(spelling.query(docs)) == want


def test_empty_table_and_ties(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.query(empty).count() == 0
    rows = [(i, "aaaaaaab aaaaaaac") for i in range(40)] + [(99, "aaaaaaad aaaaaaad")]
    got = {r.word: r for r in spelling.query(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = {r[0]: r for r in _brute(rows)}
    assert {w: tuple(r) for w, r in got.items()} == want


def test_chain_of_forms_and_long_words(spark):
    long_word = "x" * 3000 + "y"
    rows = [(i, "abcdefgh") for i in range(300)] + [(1000 + i, "abcdefgi") for i in range(20)]
    rows += [(2000 + i, "abcdefgii") for i in range(2)] + [(3000, f"{long_word} {long_word} {long_word}z {long_word}z")]
    got = _got(spelling.query(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == _brute(rows)


def test_one_edit_pairs_are_found_in_one_leaf():
    rnd = random.Random(3)
    words = sorted({"".join(rnd.choice("abcz") for _ in range(8)) for _ in range(600)})
    other = sorted({"".join(rnd.choice("abcz") for _ in range(rnd.choice([7, 8, 9]))) for _ in range(300)})
    i, j = spelling.near_in_leaf(words, other)
    assert sorted((other[a], words[b]) for a, b in zip(i, j)) == sorted((a, b) for a in other for b in words if _near(a, b))


def test_a_leaf_is_cut_without_a_search_by_dimension(monkeypatch):
    """The search over each dimension's values, which took most of a leaf's time, is for high counts alone."""
    rnd = random.Random(4)
    words = sorted({"".join(rnd.choice("abcdefghijklmnopqrst") for _ in range(9)) for _ in range(3000)})
    searched, search = [], spelling._best_cut
    monkeypatch.setattr(spelling, "_best_cut", lambda v: searched.append(len(v)) or search(v))
    groups = spelling._buckets(spelling.vectors(spelling.letters(words, 9)), np.arange(len(words)))
    assert not searched
    assert sorted(np.concatenate(groups).tolist()) == list(range(len(words)))
    assert max(map(len, groups)) <= spelling.BUCKET and len(groups) < 4 * len(words) / spelling.BUCKET


def test_a_leaf_of_words_that_differ_in_high_counts_alone():
    words = sorted({"a" * k + "b" * (60 - k) for k in range(4, 57)} | {"a" * k + "c" + "b" * (59 - k) for k in range(4, 56)})
    other = words[::2] + [w[1:] for w in words[::3]] + [w + "b" for w in words[::5]]
    assert len(spelling._buckets(spelling.vectors(spelling.letters(words, 60)), np.arange(len(words)))) > 2
    i, j = spelling.near_in_leaf(words, other)
    assert sorted((other[a], words[b]) for a, b in zip(i, j)) == sorted((a, b) for a in other for b in words if _near(a, b))
