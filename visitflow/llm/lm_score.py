"""LM scoring by masked pseudo-likelihood.

A small network, trained in numpy, predicts every token from the two tokens on
either side of it, itself masked; a document's score is the sum of the
conditional log-probabilities of its tokens.

* A token is a word (A-Z in lower case), known by a 64-bit key whose low five bits
  tell its shape (ending and length).  All words of all documents are counted in
  Spark, so the vocabulary grows with the corpus.
* The network predicts the token's class: the most frequent words have a class of
  their own, the others that of their shape; within a class a word has its share
  of the corpus counts.  Both parts together are a proper distribution over all
  words of the corpus.
* Counts of words with more than one in ``FREQUENT`` of all tokens (fewer than
  ``FREQUENT`` words) are broadcast; the others, none of which is hot, are joined
  by key.
* Training reads every document once: a hash of id and text deals the documents
  over the rounds and over shards of about ``SHARD`` tokens.  In a round Adam runs
  over each shard, in the order of the hashes, and the weights are averaged by
  tokens in Spark, in fixed point.  So neither partitioning nor order matter.

Defined results: a null or empty text has no tokens and log-likelihood 0;
repeated rows are scored one by one, train as one document if equal in id and
text, and all count; without any token in the corpus all scores are 0; an empty
table gives an empty result; only ``doc_id`` and ``text`` are used.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitflow.llm.common import text_or_empty, written
from visitflow.llm.vector import LOWER, chunks, range_hash, word_ranges

SHAPES = 32  # eight endings by four lengths
OWN = 96  # classes of a single word
CLASSES = OWN + SHAPES
FREQUENT = 1 << 20
SHARD = 500_000
TASKS = 10_000  # of a round, at most: shards are few bytes and much work, so their number is not left to their bytes
HELD = 1 << 20  # distinct words that a task holds before it passes them on
HIDDEN = 24
REACH = 2  # tokens seen on each side
ROUNDS = 3
BATCH = 2048
BLOCK = 16384
RATE = 0.01
FIXED = 2.0**16
_OFFSETS = tuple(d for d in range(-REACH, REACH + 1) if d)


# ---------------------------------------------------------------- network


def initial() -> list[np.ndarray]:
    """Embeddings by place and class (one more class: beyond the text), output weights, output bias."""
    rng = np.random.default_rng(7)
    return [
        rng.normal(0, 0.1, (len(_OFFSETS), CLASSES + 1, HIDDEN)).astype(np.float32),
        rng.normal(0, 0.1, (HIDDEN, CLASSES)).astype(np.float32),
        np.zeros(CLASSES, dtype=np.float32),
    ]


def contexts(classes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The classes around each token; ``CLASSES`` beyond its text."""
    n = len(classes)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    out = np.full((len(_OFFSETS), n), CLASSES, dtype=np.uint8)
    for k, d in enumerate(_OFFSETS):
        a, b = max(0, -d), min(n, n - d)
        if b > a:
            same = text[a:b] == text[a + d : b + d]
            out[k, a:b] = np.where(same, classes[a + d : b + d], CLASSES)
    return out


def forward(weights, around: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hidden values and log-probabilities of the classes."""
    embed, out, bias = weights
    hidden = np.tanh(sum(embed[k][around[k]] for k in range(len(_OFFSETS))))
    logits = hidden @ out + bias
    logits -= logits.max(axis=1, keepdims=True)
    logits -= np.log(np.exp(logits).sum(axis=1, keepdims=True))
    return hidden, logits


def gradients(weights, around: np.ndarray, classes: np.ndarray) -> list[np.ndarray]:
    """Of the mean negative log-probability of ``classes``."""
    embed, out, _ = weights
    hidden, logp = forward(weights, around)
    delta = np.exp(logp)
    delta[np.arange(len(classes)), classes] -= 1
    delta /= len(classes)
    back = (delta @ out.T) * (1 - hidden * hidden)
    grad = np.zeros_like(embed)
    for k in range(len(_OFFSETS)):
        order = np.argsort(around[k], kind="stable")
        values, starts = np.unique(around[k][order], return_index=True)
        grad[k][values] = np.add.reduceat(back[order], starts, axis=0)
    return [grad, hidden.T @ delta, delta.sum(axis=0)]


class Adam:
    def __init__(self, weights):
        self.weights = [w.copy() for w in weights]
        self.mean = [np.zeros_like(w) for w in weights]
        self.square = [np.zeros_like(w) for w in weights]
        self.steps = 0

    def step(self, grads) -> None:
        self.steps += 1
        for w, m, s, g in zip(self.weights, self.mean, self.square, grads):
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            w -= RATE * (m / (1 - 0.9**self.steps)) / (np.sqrt(s / (1 - 0.99**self.steps)) + 1e-6)


# ----------------------------------------------------------------- corpus

# Groups of last letters; digits, signs and bytes beyond ASCII are groups too.
_LAST = ["aou", "eiy", "s", "dtngr"]
_ENDING = np.zeros(256, dtype=np.uint64)  # other letters: 0
_ENDING[48:58] = 1
_ENDING[[b for b in range(128) if not chr(b).isalnum()]] = 2
_ENDING[128:] = 3
for _k, _letters in enumerate(_LAST):
    _ENDING[[ord(c) for c in _letters]] = 4 + _k
_LENGTHS = np.array([5, 8, 11])  # bytes at which the next length begins


def words(column: pa.Array):
    """``(first row, keys of the words, first word of each text)`` of runs of texts."""
    for row, offsets, data in chunks(column):
        lower = LOWER[data]
        starts, ends, first = word_ranges(lower, offsets)
        length = np.searchsorted(_LENGTHS, ends - starts, side="right").astype(np.uint64)
        shape = _ENDING[lower[ends - 1]] * np.uint64(4) + length
        key = (range_hash(lower, starts, ends) & ~np.uint64(SHAPES - 1)) | shape
        yield row, key.view(np.int64), first


def _merged(keys: list, counts: list) -> tuple[np.ndarray, np.ndarray]:
    key, n = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, dtype=np.int64)
    return key[first], np.add.reduceat(n, first) if len(first) else n


def _count(batches):
    keys, counts, held = [], [], 0

    def flushed():
        return pa.RecordBatch.from_arrays([pa.array(x) for x in _merged(keys, counts)], ["key", "n"])

    for batch in batches:
        for _, found, _ in words(batch.column("text")):
            found = np.sort(found)
            first = np.flatnonzero(np.append(True, found[1:] != found[:-1])) if len(found) else found
            keys.append(found[first])
            counts.append(np.diff(np.append(first, len(found))))
            held += len(first)
            if held > HELD:
                keys, counts = ([x] for x in _merged(keys, counts))
                held = len(keys[0])
                if held > HELD // 2:
                    yield flushed()
                    keys, counts, held = [], [], 0
    if held:
        yield flushed()


def word_counts(documents: DataFrame) -> DataFrame:
    """``key, n`` of every word of all documents, as a written table."""
    rows = documents.select(text_or_empty().alias("text")).mapInArrow(_count, "key long, n long")
    return written(rows.groupBy("key").agg(F.sum("n").alias("n")), "lm-words")


@dataclass
class Vocabulary:
    """What every task knows of the words; ``keys`` are the frequent ones, in order."""

    total: int
    keys: np.ndarray
    log_n: np.ndarray
    own: np.ndarray  # keys with a class of their own, in order
    own_class: np.ndarray
    log_size: np.ndarray  # of each class, in tokens

    def classes(self, keys: np.ndarray) -> np.ndarray:
        shape = (OWN + (keys & (SHAPES - 1))).astype(np.uint8)
        if not len(self.own):
            return shape
        at = np.minimum(np.searchsorted(self.own, keys), len(self.own) - 1)
        return np.where(self.own[at] == keys, self.own_class[at], shape)


def vocabulary(counts: DataFrame) -> Vocabulary:
    """From 32 sums and fewer than ``FREQUENT`` rows, whatever the corpus."""
    size = np.zeros(CLASSES)
    for r in counts.groupBy(F.col("key").bitwiseAND(F.lit(SHAPES - 1).cast("long")).alias("shape")).agg(F.sum("n").alias("n")).collect():
        size[OWN + r["shape"]] = r["n"]
    total = int(size.sum())
    frequent = counts.where(F.col("n") > F.lit(total // FREQUENT)).toArrow()
    keys, n = (frequent.column(c).to_numpy() for c in ("key", "n"))
    order = np.argsort(keys)
    keys, n = keys[order], n[order]
    own = np.sort(np.lexsort((keys, -n))[:OWN])  # places of the most frequent words
    size[: len(own)] = n[own]
    np.subtract.at(size, OWN + (keys[own] & (SHAPES - 1)), n[own])
    return Vocabulary(
        total, keys, np.log(n), keys[own], np.arange(len(own), dtype=np.uint8), np.log(np.maximum(size, 1))
    )


# --------------------------------------------------------------- training


def _encoder(shared):
    def encode(batches):
        for batch in batches:
            hashes = batch.column("hash")
            for row, keys, first in words(batch.column("text")):
                classes = shared.value.classes(keys)
                some = np.flatnonzero(np.diff(first))
                texts = [classes[first[i] : first[i + 1]].tobytes() for i in some]
                columns = [hashes.take(pa.array(row + some)), pa.array(texts, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["hash", "classes"])

    return encode


def shard_count(known: Vocabulary) -> int:
    return max(1, known.total // (ROUNDS * SHARD))


def class_rows(documents: DataFrame, known: Vocabulary) -> DataFrame:
    """``turn, shard, hash, classes``: each document's classes, one byte a token, as a written table."""
    shared = documents.sparkSession.sparkContext.broadcast(known)
    text = text_or_empty()
    rows = documents.select(F.xxhash64("doc_id", text).alias("hash"), text.alias("text"))
    rows = rows.mapInArrow(_encoder(shared), "hash long, classes binary").groupBy("hash").agg(F.first("classes").alias("classes"))
    turn = F.pmod("hash", F.lit(ROUNDS)).alias("turn")
    shard = F.pmod(F.xxhash64("hash"), F.lit(shard_count(known))).alias("shard")
    return written(rows.select(turn, shard, "hash", "classes"), "lm-classes")


def _trainer(shared):
    def train(table: pa.Table) -> pa.Table:
        adam = Adam(shared.value)
        table = table.sort_by("hash")
        texts = [x.as_buffer() for x in table.column("classes")]
        classes = np.concatenate([np.frombuffer(x, dtype=np.uint8) for x in texts])
        first = np.concatenate([[0], np.cumsum([x.size for x in texts])])
        around = contexts(classes, first)
        for a in range(0, len(classes), BATCH):
            b = slice(a, a + BATCH)
            adam.step(gradients(adam.weights, around[:, b], classes[b]))
        weight = max(1, len(classes) // 1000)
        flat = np.concatenate([w.ravel() for w in adam.weights]).astype(np.float64)
        fixed = np.rint(flat * FIXED * weight).astype(np.int64)
        places = np.arange(len(fixed) + 1, dtype=np.int32)
        return pa.table({"place": pa.array(places), "value": pa.array(np.append(fixed, weight))})

    return train


def trained(documents: DataFrame, known: Vocabulary) -> list[np.ndarray]:
    spark = documents.sparkSession
    weights = initial()
    rows = class_rows(documents, known)
    tasks = min(shard_count(known), TASKS)
    for turn in range(ROUNDS):
        shared = spark.sparkContext.broadcast(weights)
        part = rows.where(F.col("turn") == turn).repartition(tasks, "shard").groupBy("shard").applyInArrow(_trainer(shared), "place int, value long")
        found = part.groupBy("place").agg(F.sum("value").alias("value"))
        sums = {r["place"]: r["value"] for r in found.collect()}  # one row per weight of the network
        size = sum(w.size for w in weights)
        if size in sums:
            flat = np.array([sums[i] for i in range(size)], dtype=np.float64) / (FIXED * sums[size])
            at = 0
            new = []
            for w in weights:
                new.append(flat[at : at + w.size].reshape(w.shape).astype(np.float32))
                at += w.size
            weights = new
    return weights


# ---------------------------------------------------------------- scoring


def parts(weights, known: Vocabulary, column: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Of each text: tokens, log-likelihood without the counts of the words that are
    not frequent, and the keys of these words."""
    n, total = np.zeros(len(column), dtype=np.int64), np.zeros(len(column))
    ends, rare = [np.zeros(1, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    for row, keys, first in words(column):
        classes = known.classes(keys)
        around = contexts(classes, first)
        at = np.minimum(np.searchsorted(known.keys, keys), len(known.keys) - 1)
        frequent = known.keys[at] == keys if len(known.keys) else np.zeros(len(keys), dtype=bool)
        value = -known.log_size[classes]
        value[frequent] += known.log_n[at[frequent]]
        for a in range(0, len(classes), BLOCK):
            b = slice(a, a + BLOCK)
            _, logp = forward(weights, around[:, b])
            value[b] += logp[np.arange(logp.shape[0]), classes[b]]
        sums = np.concatenate([[0.0], np.cumsum(value)])
        counts = np.diff(first)
        n[row : row + len(counts)] = counts
        total[row : row + len(counts)] = np.where(counts > 0, sums[first[1:]] - sums[first[:-1]], 0.0)
        before = np.concatenate([[0], np.cumsum(~frequent)])
        ends.append(ends[-1][-1] + before[first[1:]])
        rare.append(keys[~frequent])
    return n, total, pa.LargeListArray.from_arrays(np.concatenate(ends), np.concatenate(rare)).cast(pa.list_(pa.int64()))


def lm_scores(documents: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, log_likelihood, per_token`` of every document."""
    counts = word_counts(documents)
    known = vocabulary(counts)
    model = documents.sparkSession.sparkContext.broadcast((trained(documents, known), known))
    names = ["row", "doc_id", "n_tokens", "part", "rare"]

    def score(batches):
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            n, part, rare = parts(*model.value, batch.column("text"))
            rows = pa.array(np.arange(row, row + len(n)))
            row += len(n)
            yield pa.RecordBatch.from_arrays([rows, batch.column("doc_id"), pa.array(n), pa.array(part), rare], names)

    kind = documents.schema["doc_id"].dataType.simpleString()
    scored = documents.select("doc_id", text_or_empty().alias("text")).mapInArrow(
        score, f"row long, doc_id {kind}, n_tokens long, part double, rare array<long>"
    )
    scored = written(scored, "lm-parts")
    logs = (
        scored.select("row", F.explode("rare").alias("key"))
        .join(counts, "key")
        .groupBy("row")
        .agg(F.sum(F.log("n")).alias("logs"))
    )
    value = F.col("part") + F.coalesce("logs", F.lit(0.0))
    return scored.drop("rare").join(logs, "row", "left").select(
        "doc_id",
        "n_tokens",
        value.alias("log_likelihood"),
        (value / F.greatest("n_tokens", F.lit(1))).alias("per_token"),
    )


def query(documents: DataFrame) -> DataFrame:
    return lm_scores(documents.select("doc_id", "text"))
