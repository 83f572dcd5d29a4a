"""Spelling variants: words that differ by one inserted, deleted or replaced letter.

Method: a word becomes the vector of its letter counts.  One replaced letter
moves two counts by one (L1 distance two at most, equal lengths), one inserted
letter moves one count (L1 distance one, lengths that differ by one).  The words
of each length are the points of a k-d tree.  Its upper levels are fitted on a
bounded sample and cut the points into leaves of about ``LEAF`` words; every
word goes, as a query, to the leaves of its own length and of its two
neighbouring lengths whose box lies within the distance.  A task gets one leaf
and one part of its queries, goes on with the tree over the leaf's points, and
compares by box, by vector, then letter by letter.  What leaves a task is one
row per query: its number of near words there and the most frequent of them.

The sample only places the cuts; any cuts give the same pairs.

Words: maximal runs of ``[A-Za-z\\u00C0-\\u00FF]``, A-Z lower-cased.  A run whose
crc32 of ``<doc_id>:<run>`` is a multiple of 31 loses its code point at that
crc32 modulo its length (a planted misspelling).  Words of fewer than
``MIN_CHARS`` code points or ``MIN_COUNT`` occurrences take no part.

Defined results: a null or empty text has no words; a null ``doc_id`` is the
text ``null`` in the crc32; rows that repeat count again; an empty table gives an
empty result; other columns are ignored.  The form of a word is its near word of
largest count (ties: the smallest in code-point order), if that count is at
least ``TIMES`` times its own.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitflow.llm.common import LOWER, UPPER, text_or_empty, written

MIN_CHARS = 7
MIN_COUNT = 2
TIMES = 10
SPOIL = 31
DIMS = 32  # letters share counts modulo this: one edit still moves two of them at most
LEAF = 20_000  # words of one leaf of the upper tree
SAMPLE = 200_000  # words that place the upper tree's cuts
BUCKET = 32  # words of a bucket inside a leaf
SPAN = 16  # neighbouring buckets whose boxes are tested as one first
PARTS = 8  # parts of a leaf's queries
FLUSH = 500_000  # distinct runs held before they are handed on

_TO_LOWER = str.maketrans(UPPER, LOWER)


# ------------------------------------------------------------------ words


def doc_words(doc_id: str, text: str, min_chars: int = MIN_CHARS) -> Counter:
    """The words of one text with their counts."""
    runs: Counter = Counter()
    # a run of at least so many letters is found whole, a shorter one not at all
    for run, n in Counter(re.findall(f"[A-Za-z\u00c0-\u00ff]{{{min_chars},}}", text)).items():
        runs[run.lower() if run.isascii() else run.translate(_TO_LOWER)] += n
    found: Counter = Counter()
    for run, n in runs.items():
        h = zlib.crc32(f"{doc_id}:{run}".encode())
        if h % SPOIL == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < min_chars:
                continue
        found[run] += n
    return found


def _count_words(min_chars: int):
    def rows(counts: Counter):
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"]
        )

    def count(batches):
        held: Counter = Counter()
        for batch in batches:
            for doc, text in zip(batch.column("doc"), batch.column("text")):
                held.update(doc_words(doc.as_py(), text.as_py(), min_chars))
                if len(held) >= FLUSH:
                    yield rows(held)
                    held = Counter()
        yield rows(held)

    return count


def word_counts(documents: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """``word, n, len`` of all words that take part."""
    doc = F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("doc")
    counted = documents.select(doc, text_or_empty().alias("text")).mapInArrow(_count_words(min_chars), "word string, n long")
    words = counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)
    return words.select("word", "n", F.char_length("word").alias("len"))


# ------------------------------------------------------------------ vectors and trees


def letters(words: list[str], width: int) -> np.ndarray:
    """Code points of the words, one row each, zeros after the end."""
    return np.array(words, dtype=f"<U{max(width, 1)}").view(np.uint32).reshape(len(words), max(width, 1))


def vectors(points: np.ndarray) -> np.ndarray:
    """Letter counts, the code points taken modulo ``DIMS``; counts stop at 120 (far beyond any distance that matters)."""
    found = np.zeros((len(points), DIMS), dtype=np.int16)
    rows = np.arange(len(points))
    for column in points.T:
        used = column > 0
        found[rows[used], column[used] % DIMS] += 1
    return np.minimum(found, 120).astype(np.int8)


def codes(v: np.ndarray) -> np.ndarray:
    """Counts up to two, two bits each: unequal bits are the L1 distance of the counts so cut, a lower bound of the distance."""
    once = np.uint64(1) << np.arange(DIMS, dtype=np.uint64)
    return ((v > 0) @ once) | (((v > 1) @ once) << np.uint64(DIMS))


def _best_cut(v: np.ndarray) -> tuple[int, int] | None:
    """Dimension and value: points at or above the value go right; the most even cut."""
    n, best, cut = len(v), 0, None
    for d in range(v.shape[1]):
        middle = int(np.partition(v[:, d], n // 2)[n // 2])
        for value in (middle, middle + 1):
            right = int(np.count_nonzero(v[:, d] >= value))
            if min(right, n - right) > best:
                best, cut = min(right, n - right), (d, value)
    return cut


class Tree:
    """Upper k-d tree of one length: cuts, and boxes of its leaves."""

    def __init__(self, v: np.ndarray, leaves: int):
        self.low, self.high = [], []

        def grow(part, low, high, wanted):
            cut = _best_cut(part) if wanted > 1 and len(part) > 1 else None
            if cut is None:
                self.low.append(low)
                self.high.append(high)
                return
            d, value = cut
            right = part[:, d] >= value
            below, above = high.copy(), low.copy()
            below[d], above[d] = value - 1, value
            grow(part[~right], low, below, wanted // 2)
            grow(part[right], above, high, wanted - wanted // 2)

        grow(v, np.zeros(DIMS, np.int8), np.full(DIMS, 120, np.int8), leaves)
        self.low, self.high = np.array(self.low), np.array(self.high)

    def within(self, v: np.ndarray, radius: int):
        """``(rows, leaf)`` pairs: leaves whose box is within ``radius`` of the vectors."""
        for leaf, (low, high) in enumerate(zip(self.low, self.high)):
            away = (np.maximum(low - v, 0) + np.maximum(v - high, 0)).sum(axis=1, dtype=np.int32)
            yield np.flatnonzero(away <= radius), leaf


def _low_cut(reached: np.ndarray) -> tuple[int, int] | None:
    """The most even cut at a value of 1 to 3, from the rows that reach these values in each dimension."""
    right = reached.sum(axis=0, dtype=np.int32)
    even = np.minimum(right, len(reached) - right)
    best = int(even.argmax())
    return (best % DIMS, best // DIMS + 1) if even[best] else None


def _buckets(v: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
    """The leaf's tree goes on down to buckets of at most ``BUCKET`` rows (or of equal vectors); neighbours come in a row."""
    reached = np.concatenate([v >= value for value in (1, 2, 3)], axis=1).view(np.uint8)
    done, open_ = [], [rows]
    while open_:
        part = open_.pop()
        # nearly all counts are that low; rows that differ in higher ones alone take the search over all values
        cut = (_low_cut(reached[part]) or _best_cut(v[part])) if len(part) > BUCKET else None
        if cut is None:
            done.extend(part[i : i + BUCKET] for i in range(0, len(part), BUCKET))
        else:
            right = v[part, cut[0]] >= cut[1]
            open_ += [part[~right], part[right]]
    return done


def one_edit(a: np.ndarray, la: np.ndarray, b: np.ndarray, lb: np.ndarray) -> np.ndarray:
    """Whether the words, given as code points and lengths, differ by exactly one edit."""
    same_length = la == lb
    differs = a != b
    found = same_length & (differs.sum(axis=1) == 1)
    rest = np.flatnonzero(np.abs(la - lb) == 1)
    if len(rest):
        longer = la[rest] > lb[rest]
        long_ = np.where(longer[:, None], a[rest], b[rest])
        short = np.where(longer[:, None], b[rest], a[rest])
        unequal = long_ != short
        first = unequal.argmax(axis=1)
        after = np.arange(unequal.shape[1] - 1)[None, :] >= first[:, None]
        found[rest] = ~((long_[:, 1:] != short[:, :-1]) & after).any(axis=1)
    return found


def _away(low: np.ndarray, high: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Lower bound of the distance of a coded vector to a box."""
    return np.bitwise_count(low & ~code) + np.bitwise_count(code & ~high)


def near_in_leaf(points: list[str], queries: list[str]):
    """Pairs (query row, point row) that differ by one edit; the points have one length."""
    if not points or not queries:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    width = max(len(points[0]), max(map(len, queries))) + 1
    p, q = letters(points, width), letters(queries, width)
    pv, qv = vectors(p), vectors(q)
    pl, ql = np.full(len(p), len(points[0])), np.array([len(w) for w in queries])
    radius = np.where(ql == len(points[0]), 2, 1)
    p_code, q_code = codes(pv), codes(qv)
    groups = _buckets(pv, np.arange(len(p)))
    members = np.full((-(-len(groups) // SPAN) * SPAN, BUCKET), -1)
    for k, group in enumerate(groups):
        members[k, : len(group)] = group
    held = members >= 0
    # the box of a bucket, in the same code: what all its members hold, and what any of them holds
    low = np.bitwise_and.reduce(np.where(held, p_code[members], ~np.uint64(0)), axis=1)
    high = np.bitwise_or.reduce(np.where(held, p_code[members], np.uint64(0)), axis=1)
    low, high = low.reshape(-1, SPAN), high.reshape(-1, SPAN)
    all_low, all_high = np.bitwise_and.reduce(low, axis=1), np.bitwise_or.reduce(high, axis=1)
    of_q, of_p = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for at in range(0, len(q), 512):
        code, far = q_code[at : at + 512, None], radius[at : at + 512, None]
        i, span = np.nonzero(_away(all_low, all_high, code) <= far)
        k, place = np.nonzero(_away(low[span], high[span], code[i]) <= far[i])
        i, box = i[k], span[k] * SPAN + place
        close = (np.bitwise_count(p_code[members[box]] ^ code[i]) <= far[i]) & held[box]
        k, place = np.nonzero(close)
        i, j = at + i[k], members[box[k], place]
        exact = np.abs(qv[i] - pv[j]).sum(axis=1, dtype=np.int32) <= radius[i]
        i, j = i[exact], j[exact]
        good = one_edit(q[i], ql[i], p[j], pl[j])
        of_q.append(i[good])
        of_p.append(j[good])
    return np.concatenate(of_q), np.concatenate(of_p)


# ------------------------------------------------------------------ Spark


def upper_trees(words: DataFrame) -> dict[int, Tree]:
    """A tree for each length, from at most ``SAMPLE`` words; one node for each ``LEAF`` words."""
    sizes = {r["len"]: r["count"] for r in words.groupBy("len").count().collect()}  # one row per length
    total = sum(sizes.values())
    if not total:
        return {}
    share = max(1, -(-total // SAMPLE))
    picked = words.where(F.pmod(F.xxhash64("word", F.lit("tree")), F.lit(share)) == 0).select("word", "len").limit(2 * SAMPLE)
    sample: dict[int, list[str]] = {}
    for r in picked.collect():
        sample.setdefault(r["len"], []).append(r["word"])
    return {
        n: Tree(vectors(letters(sorted(sample.get(n, [])), n)), -(-count // LEAF))
        for n, count in sizes.items()
    }


def _router(trees):
    """Rows ``leaf_len, leaf, part, role, word, n``: each word at home once, and as a query wherever it may be near."""

    def route(batches):
        for batch in batches:
            words = np.array(batch.column("word").to_pylist(), dtype=object)
            n = batch.column("n").to_numpy()
            lengths = batch.column("len").to_numpy()
            out = []
            for own in np.unique(lengths):
                rows = np.flatnonzero(lengths == own)
                v = vectors(letters(list(words[rows]), int(own)))
                for other in (own - 1, own, own + 1):
                    tree = trees.value.get(int(other))
                    if tree is None:
                        continue
                    for hit, leaf in tree.within(v, 2 if other == own else 1):
                        out.append((other, leaf, "q", rows[hit]))
                    if other == own:
                        for hit, leaf in tree.within(v, 0):
                            out.append((other, leaf, "p", rows[hit]))
            for leaf_len, leaf, role, rows in out:
                if not len(rows):
                    continue
                k = len(rows) * (PARTS if role == "p" else 1)
                part = np.tile(np.arange(PARTS), len(rows)) if role == "p" else np.array([zlib.crc32(w.encode()) % PARTS for w in words[rows]])
                rows = np.repeat(rows, PARTS) if role == "p" else rows
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(k, leaf_len, np.int32)),
                        pa.array(np.full(k, leaf, np.int32)),
                        pa.array(part.astype(np.int32)),
                        pa.array(np.full(k, role == "p")),
                        pa.array(list(words[rows]), pa.string()),
                        pa.array(n[rows]),
                    ],
                    ["leaf_len", "leaf", "part", "home", "word", "n"],
                )

    return route


def _search(table: pa.Table) -> pa.Table:
    """One leaf and one part of its queries: ``word, n_near, form, form_n`` of the queries with a near word."""
    home = table.column("home").to_numpy(zero_copy_only=False)
    points, queries = table.filter(pa.array(home)), table.filter(pa.array(~home))
    p_words, q_words = points.column("word").to_pylist(), queries.column("word").to_pylist()
    i, j = near_in_leaf(p_words, q_words)
    n = points.column("n").to_numpy()
    by_word = np.empty(len(p_words), dtype=np.int64)
    by_word[sorted(range(len(p_words)), key=p_words.__getitem__)] = np.arange(len(p_words))
    order = np.lexsort((by_word[j], -n[j], i))
    i, j = i[order], j[order]
    who, first, count = np.unique(i, return_index=True, return_counts=True)
    best = j[first]
    return pa.table(
        {
            "word": pa.array([q_words[k] for k in who], pa.string()),
            "n_near": pa.array(count.astype(np.int64)),
            "form": pa.array([p_words[k] for k in best], pa.string()),
            "form_n": pa.array(n[best].astype(np.int64)),
        }
    )


def near_words(words: DataFrame) -> DataFrame:
    """``word, n_near, form, form_n``: near words and the most frequent of them, for each word that has one.

    ``words`` (word, n, len) is a written table.
    """
    trees = words.sparkSession.sparkContext.broadcast(upper_trees(words))  # a node for each LEAF words
    routed = words.mapInArrow(_router(trees), "leaf_len int, leaf int, part int, home boolean, word string, n long")
    found = routed.groupBy("leaf_len", "leaf", "part").applyInArrow(_search, "word string, n_near long, form string, form_n long")
    best = F.min(F.struct((-F.col("form_n")).alias("least"), "form"))
    merged = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return merged.select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.least")).alias("form_n"))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of the words with a form (``word, form``): the end of the chain of forms.

    Each step multiplies the count by ``TIMES`` at least, so that a chain has
    fewer than 64 words; doubling the step six times reaches its end.  A form has
    a bounded number of near words, so that no join key is hot.
    """
    jumps = written(forms.select("word", F.col("form").alias("root")), "spelling-forms")
    for _ in range(6):
        nxt = jumps.select(F.col("word").alias("mid"), F.col("root").alias("far"))
        joined = jumps.join(nxt, F.col("root") == F.col("mid"), "left")
        moved = written(joined.select("word", "root", "far"), "spelling-roots")
        jumps = moved.select("word", F.coalesce("far", "root").alias("root"))
        if moved.where("far is not null").isEmpty():
            break
    return jumps


def variants(documents: DataFrame) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of all words that take part."""
    words = written(word_counts(documents), "spelling-words")
    near = near_words(words)
    all_ = written(words.join(near, "word", "left").select("word", "n", "n_near", "form", "form_n"), "spelling-near")
    big = F.col("form_n") >= F.lit(TIMES) * F.col("n")
    shaped = all_.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(big, F.col("form")).alias("form"),
        F.when(big, F.col("form_n")).alias("form_n"),
    )
    ends = roots(shaped.where("form is not null"))
    return shaped.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))


def query(documents: DataFrame) -> DataFrame:
    return variants(documents.select("doc_id", "text")).select("word", "form", "root", "n", "n_near", "form_n")
