"""Decontamination: passages whose sentences stand in another order."""

from __future__ import annotations

import collections
import random

import duckdb
import pandas as pd

from visitflow.llm import decontaminate


def _count(words):
    return collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def test_swapped_sentences_match_every_position(spark):
    rnd = random.Random(12)
    items = [(i, [f"q{rnd.randrange(900)}" for _ in range(n)]) for i, n in enumerate((60, 60, 61, 90, 40, 120, 12))]
    docs = []
    for d in range(40):
        own = [f"w{rnd.randrange(900)}" for _ in range(rnd.choice([0, 3, 40, 200]))]
        part = list(items[d % 7][1])
        cut = rnd.choice([len(part) // 2, len(part) // 3, 2, 7])
        part = part[cut:] + part[:cut]
        if d % 4 == 0:
            part = part[: -rnd.randrange(1, 8)]
        at = rnd.randrange(len(own) + 1)
        docs.append((d, own[:at] + part + own[at:]))
    want = {}
    for d, w in docs:
        for i, x in items:
            for s in range(max(1, len(w) - len(x) + 1)):
                have = _count(w[s : s + len(x)])
                both, all_ = sum((have & _count(x)).values()), sum((have | _count(x)).values())
                if 100 * both >= 75 * all_:
                    want[d, i] = max(want.get((d, i), 0), both / all_)
    df = spark.createDataFrame([(d, " ".join(w)) for d, w in docs], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(x)) for i, x in items], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.query(df, bench).collect()}
    assert len(want) > 20 and got.keys() == want.keys()
    assert all(abs(got[k] - v) < 1e-9 for k, v in want.items())
    con = duckdb.connect()
    con.register("documents", df.toPandas())
    con.register("benchmark", bench.toPandas())
    assert {tuple(r) for r in con.sql(decontaminate.ORACLE).fetchall()} == {tuple(r) for r in decontaminate.query(df, bench).collect()}


def test_given_tables_give_the_results_of_the_sql(spark):
    at = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.register(t, pd.read_parquet(f"{at}/{t}.parquet"))
    want = {tuple(r) for r in con.sql(decontaminate.ORACLE).fetchall()}
    got = {tuple(r) for r in decontaminate.query(*(spark.read.parquet(f"{at}/{t}.parquet") for t in ("documents", "benchmark"))).collect()}
    assert want and got == want
