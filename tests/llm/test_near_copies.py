"""N-gram join, components and decontamination against plain Python."""

from __future__ import annotations

import collections
import random
import re

import pytest
from pyspark.sql import functions as F

from visitflow.llm import decontaminate, ngram_join
from visitflow.llm.components import components

SCHEMA = "doc_id long, text string, source string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _vary(rnd, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rnd.randrange(len(words))] = f"edit{rnd.randrange(10**6)}"
    return words


def _corpus(seed):
    rnd = random.Random(seed)
    passage = [f"p{i}" for i in range(60)]
    docs = []
    for _ in range(12):
        base = [f"w{rnd.randrange(5000)}" for _ in range(rnd.choice([3, 6, 12, 40, 150]))]
        for _ in range(rnd.choice([1, 2, 3, 25])):
            docs.append(_vary(rnd, base, rnd.choice([0, 0, 1, 2, 4])))
    for _ in range(40):  # a passage shared by unlike documents
        own = [f"w{rnd.randrange(50000)}" for _ in range(rnd.choice([5, 15, 80]))]
        docs.append(own + passage if rnd.random() < 0.8 else passage + own[:2])
    rows = [(i, " ".join(d) if i % 3 else " ".join(d).upper() + "\n", "s") for i, d in enumerate(docs)]
    rnd.shuffle(rows)
    return rows + [(900, None, "s"), (901, "", None), (902, " \n", "s"), (903, "One two", "s"), (904, "one  TWO", "s"), (None, "one two", "s"), rows[0]]


def _sets(rows):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = {}
    for i, text, _ in rows:
        w = WORD.findall((text or "").translate(low))
        found[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    return found


def _brute(rows, percent=75):
    sets = _sets([r for r in rows if r[0] is not None])
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("seed", [1, 2])
def test_components_match_brute_force(spark, seed):
    rows = _corpus(seed)
    exp = _brute(rows)
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"node": F.lit(1), "key": F.lit("x")})
    got = ngram_join.jaccard_components(df).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.n_shingles == 1
        else:
            assert (r.n_shingles, r.component_id) == exp[r.doc_id]
    kept = ngram_join.deduplicated(df)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {c for _, c in exp.values()} | {None}


def test_join_of_an_empty_table(spark):
    assert ngram_join.query(spark.createDataFrame([], SCHEMA)).count() == 0


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7), (200, 201), (201, 200)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(60)}, 200: 200, 201: 200}


def test_prefix_length_is_exact():
    for n in range(1, 300):
        need = -(-75 * n // 100)
        assert ngram_join.prefix_length(n) == n - need + 1


# ---------------------------------------------------------- decontamination

PLAIN = re.compile(r"[^\W_]+")


def _plain(text):
    return PLAIN.findall((text or "").lower())


def _count(words):
    return collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def _leaks(docs, items):
    out = {}
    for d, text, _ in docs:
        w = _plain(text)
        for i, item in items:
            x = _plain(item)
            if len(x) < 5:
                continue
            want = _count(x)
            for s in range(max(1, len(w) - len(x) + 1)):
                have = _count(w[s : s + len(x)])
                both, all_ = sum((have & want).values()), sum((have | want).values())
                if 100 * both >= 75 * all_:
                    out[d, i] = max(out.get((d, i), 0), both / all_)
    return out


@pytest.fixture(scope="module")
def leaking():
    rnd = random.Random(11)
    items = [(i, " ".join(f"Item{rnd.randrange(400)}" for _ in range(rnd.choice([5, 9, 20, 35, 60])))) for i in range(12)]
    items += [(50, None), (51, ""), (52, "too short"), (53, items[3][1]), (54, "a b a b a b a b a b a b a b")]
    docs = []
    for d in range(60):
        own = [f"w{rnd.randrange(900)}" for _ in range(rnd.choice([0, 10, 200]))]
        if d % 3 == 0:
            part = _vary(rnd, items[d % 12][1].split(), rnd.choice([0, 0, 1, 2, 3]))
            part = part[rnd.choice([0, 0, 1, 4]) :]
            at = rnd.randrange(len(own) + 1)
            own[at:at] = [x + rnd.choice(["", "!!", ","]) for x in part]
        docs.append((d, " ".join(own), "s"))
    docs += [(900, None, "s"), (901, "a b a b a b a b a b a b a b a b a b", None), docs[0], (None, docs[0][1], "s")]
    return docs, items


def test_decontamination_matches_brute_force(spark, leaking):
    docs, items = leaking
    df = spark.createDataFrame(docs, SCHEMA).withColumns({"size": F.lit(1), "start": F.lit(2), "w": F.lit("x")})
    bench = spark.createDataFrame(items, "item_id long, text string")
    exp = _leaks(docs, items)
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.query(df, bench).collect()}
    assert got.keys() == exp.keys()
    assert all(abs(got[k] - v) < 1e-9 for k, v in exp.items())
    left = decontaminate.decontaminated(df, bench)
    assert left.columns == df.columns
    assert {r.doc_id for r in left.collect()} == {d for d, *_ in docs} - {d for d, _ in exp}
    assert decontaminate.query(df.limit(0), bench).count() == 0
    assert decontaminate.query(df, bench.limit(0)).count() == 0


def test_multi_index_misses_none_within_the_radius(spark):
    rnd = random.Random(2)
    pairs = []
    for _ in range(300):
        a = rnd.getrandbits(64)
        b = a
        for bit in rnd.sample(range(64), rnd.randrange(0, 30)):
            b ^= 1 << bit
        pairs.append((a - 2**63, b - 2**63))
    near = decontaminate._neighbours()
    for a, b in pairs:
        x, y = a & (2**64 - 1), b & (2**64 - 1)
        blocks = [((x >> 8 * k) ^ (y >> 8 * k)) & 255 for k in range(8)]
        if bin(x ^ y).count("1") <= decontaminate.RADIUS:
            assert any(d in near for d in blocks)


@pytest.mark.parametrize("percent", [50, 60, 90])
def test_no_link_is_lost_at_other_similarities(spark, percent):
    rows = _corpus(3)
    exp = _brute(rows, percent)
    got = ngram_join.jaccard_components(spark.createDataFrame(rows, SCHEMA), percent).where("doc_id is not null").collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == exp
