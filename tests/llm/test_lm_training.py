"""LM scoring: every document trains the network."""

from __future__ import annotations

import dataclasses
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from visitflow.llm import lm_score


def test_documents_of_any_hash_train(spark):
    texts = [(i, " ".join("a b c d".split()[(i + k) % 4] for k in range(60))) for i in range(400)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    turn = F.pmod(F.xxhash64("doc_id", "text"), F.lit(48))
    column = pa.array([t for _, t in texts])
    before = lm_score.initial()
    for part in (turn >= 9, turn % 16 >= 3, turn % 16 == 15):
        some = df.where(part)
        known = lm_score.vocabulary(lm_score.word_counts(some))
        after = lm_score.trained(some, known)
        assert all(not np.array_equal(a, b) for a, b in zip(before, after))
        _, plain, _ = lm_score.parts(before, known, column)
        _, learned, _ = lm_score.parts(after, known, column)
        assert learned.sum() > plain.sum()


def _corpus(rnd, n):
    common = [f"w{k}" for k in range(30)]
    return [(i, " ".join(rnd.choice(common) if rnd.random() < 0.9 else f"r{rnd.randrange(5000)}" for _ in range(rnd.randrange(1, 120)))) for i in range(n)]


def test_scores_do_not_depend_on_partitions_or_order(spark, monkeypatch):
    rnd = random.Random(3)
    docs = _corpus(rnd, 600) + [(7000, None), (None, "w1 w2 w3")]
    monkeypatch.setattr(lm_score, "SHARD", 2000)  # several shards
    monkeypatch.setattr(lm_score, "FREQUENT", 400)  # most words are joined
    found = []
    for parts in (1, 8):
        rnd.shuffle(docs)
        df = spark.createDataFrame(docs, "doc_id long, text string").repartition(parts)
        known = lm_score.vocabulary(lm_score.word_counts(df))
        weights = lm_score.trained(df, known)
        found.append((weights, {r.doc_id: r.per_token for r in lm_score.lm_scores(df).collect()}))
    (w, a), (v, b) = found
    assert all(np.array_equal(x, y) for x, y in zip(w, v))
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-4 for k in a)


def test_joined_and_broadcast_counts_give_the_same_scores(spark, monkeypatch):
    df = spark.createDataFrame(_corpus(random.Random(5), 300), "doc_id long, text string")
    known = lm_score.vocabulary(lm_score.word_counts(df))
    weights = lm_score.trained(df, known)
    monkeypatch.setattr(lm_score, "trained", lambda *_: weights)
    want = {r.doc_id: r.log_likelihood for r in lm_score.lm_scores(df).collect()}
    # the classes stay as they are, only the counts of the frequent words are fewer
    few = dataclasses.replace(known, keys=known.own, log_n=known.log_n[np.isin(known.keys, known.own)])
    monkeypatch.setattr(lm_score, "vocabulary", lambda _: few)
    got = {r.doc_id: r.log_likelihood for r in lm_score.lm_scores(df).collect()}
    assert len(known.keys) > len(few.keys) and got.keys() == want.keys()
    assert all(abs(got[k] - v) < 1e-6 * max(1, abs(v)) for k, v in want.items())


def test_words_are_counted_one_by_one(spark):
    """Every distinct word has its own count, however many there are."""
    docs = [(i, " ".join(f"word{i * 50 + k}x{k % 7}" for k in range(50)) + " The the THE") for i in range(2000)]
    counts = lm_score.word_counts(spark.createDataFrame(docs, "doc_id long, text string"))
    assert counts.count() == 100_001
    assert sorted(r.n for r in counts.orderBy(F.desc("n")).limit(2).collect()) == [1, 6000]


def test_copies_score_above_documents_that_occur_once(spark):
    rnd = random.Random(8)

    def text():
        return " ".join(rnd.choice(["the", "of", "and", "in"]) if k % 3 else f"n{rnd.randrange(10**9)}" for k in range(60))

    docs = [(i, text()) for i in range(400)]
    docs += [(1000 + i, docs[i][1]) for i in range(40)]
    got = {r.doc_id: r.per_token for r in lm_score.query(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert min(got[i] for i in range(40)) > max(got[i] for i in range(40, 400))
