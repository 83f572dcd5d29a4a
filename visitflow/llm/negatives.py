"""Hard-negative mining over a Hilbert-ordered table of vector blocks with zone maps.

Method: vectors are placed on a Hilbert curve over their ``AXES`` main
directions (fitted on a bounded sample), range-partitioned along it, and packed
``BLOCK`` rows to a Parquet row that also holds each dimension's smallest and
largest component (the zone map).  Queries (an anchor, the label that its rows
must or must not have, and a range of scores) are packed along the same curve.
Interval arithmetic over a zone map bounds every inner product with its block,
and only the blocks whose bounds meet a query's range are read for it.

1. Positives: an anchor's own block gives a score that its fifth positive at
   least reaches; blocks whose upper bound is below it are not read.
2. Negatives: the range of each (anchor, positive) is
   ``50 * positive <= 100 * negative <= 95 * positive``.

A task keeps the best rows of its queries over the blocks it reads and hands on
these alone; a window over them gives the ranks.  Scores are exact integers.
Sample, curve and blocks decide what is read, never what is returned.

Defined results: rows with a null id, label or vector, or with a null or
non-finite component, take no part; of rows that share an id the smallest
(label, vector) counts; vectors of other lengths are padded with zeros; an
anchor without positives, or a positive without negatives, gives no row; an
empty table gives an empty result; other columns are ignored.  Scores must fit
in a long.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from visitflow.llm.common import written

AXES = 8  # directions of the curve
BITS = 6  # bits of the curve in each of them
SAMPLE = 4096  # vectors that place the directions
BLOCK = 1024  # vectors of a block
QUERIES = 512  # queries of a block of queries
ZONES = 256  # zone maps compared with a block of queries at once
PARTS = 16  # tasks that share a block of queries
POSITIVES = 5
NEGATIVES = 3
ANCHOR_EVERY = 50
LOWEST, HIGHEST = -(2**62), 2**62
EXACT = 2**52  # sums below this are exact in double arithmetic


# ------------------------------------------------------------------ the curve


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of integer cells (n, axes), ``axes * bits`` below 63."""
    x = cells.astype(np.int64).copy()
    n, axes = x.shape
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(axes):
            set_ = (x[:, i] & q) > 0
            swap = np.where(set_, 0, (x[:, 0] ^ x[:, i]) & p)
            x[:, 0] ^= np.where(set_, p, swap)
            x[:, i] ^= swap
        q >>= 1
    for i in range(1, axes):
        x[:, i] ^= x[:, i - 1]
    flip = np.zeros(n, dtype=np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        flip ^= np.where((x[:, -1] & q) > 0, q - 1, 0)
        q >>= 1
    x ^= flip[:, None]
    place = np.zeros(n, dtype=np.int64)
    for b in reversed(range(bits)):
        for i in range(axes):
            place = (place << 1) | ((x[:, i] >> b) & 1)
    return place


class Curve:
    """Main directions and ranges of a sample, and the places of vectors along the curve."""

    def __init__(self, sample: np.ndarray):
        self.mean = sample.mean(axis=0)
        centred = sample - self.mean
        values, directions = np.linalg.eigh(centred.T @ centred)
        self.directions = directions[:, np.argsort(values)[::-1][:AXES]]
        along = centred @ self.directions
        self.low, high = along.min(axis=0), along.max(axis=0)
        self.step = np.maximum(high - self.low, 1e-9) / (1 << BITS)

    def places(self, v: np.ndarray) -> np.ndarray:
        along = (fitted(v, len(self.mean)) - self.mean) @ self.directions
        cells = np.clip(np.floor((along - self.low) / self.step), 0, (1 << BITS) - 1)
        return hilbert(cells, BITS)


def fitted(v: np.ndarray, width: int) -> np.ndarray:
    """The vectors with ``width`` dimensions, zeros in place of missing ones."""
    if v.shape[1] < width:
        return np.pad(v, ((0, 0), (0, width - v.shape[1])))
    return v[:, :width]


def stacked(column: pa.Array) -> np.ndarray:
    """Lists of longs as one matrix, shorter ones padded with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    ends = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    width = int(ends.max(initial=0))
    if (ends == width).all():
        return flat.reshape(len(ends), width)
    found = np.zeros((len(ends), width), dtype=np.int64)
    found[np.arange(width)[None, :] < ends[:, None]] = flat
    return found


# ------------------------------------------------------------------ blocks


def _bytes(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a, dtype=np.int64).tobytes()


def _matrix(raw: bytes, rows: int) -> np.ndarray:
    return np.frombuffer(raw, dtype=np.int64).reshape(rows, -1)


def _rows_of(batches, size: int):
    """Tables of ``size`` rows (the last: what is left) of a partition's batches."""
    held, count = [], 0
    for batch in batches:
        held.append(batch)
        count += batch.num_rows
        while count >= size:
            table = pa.Table.from_batches(held)
            yield table.slice(0, size)
            rest = table.slice(size)
            held, count = rest.to_batches(), rest.num_rows
    if count:
        yield pa.Table.from_batches(held)


BLOCKS = "block long, rows int, ids binary, labels binary, v binary, low binary, high binary"


def _pack_blocks(batches):
    for k, table in enumerate(_rows_of(batches, BLOCK)):
        ids = table.column("id").to_numpy()
        order = np.argsort(ids)  # ties of a score fall to the smaller id by a stable sort
        v = stacked(table.column("v"))[order]
        labels = table.column("label").to_numpy()[order]
        block = (TaskContext.get().partitionId() << 32) + k
        row = [block, len(ids), _bytes(ids[order]), _bytes(labels), _bytes(v), _bytes(v.min(axis=0)), _bytes(v.max(axis=0))]
        kinds = [pa.int64(), pa.int32()] + [pa.binary()] * 5
        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds)], [c.split()[0] for c in BLOCKS.split(", ")])


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two integer matrices."""
    width = max(a.shape[1], b.shape[1])
    a, b = fitted(a, width), fitted(b, width)
    largest = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * width
    if largest < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def bounds(v: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the inner products of each vector with every vector in each box, by interval arithmetic."""
    width = max(v.shape[1], low.shape[1])
    v = fitted(v, width).astype(np.float64)
    up, down = np.maximum(v, 0), np.minimum(v, 0)
    low, high = fitted(low, width).astype(np.float64).T, fitted(high, width).astype(np.float64).T
    most, least = up @ high + down @ low, up @ low + down @ high
    slack = 1e-9 * (np.abs(most) + np.abs(least)) + 1
    return least - slack, most + slack


def points(embeddings: DataFrame) -> DataFrame:
    """``id, label, v``: the rows that take part, with integer components."""
    x = F.col("embedding")
    fine = F.forall(x, lambda c: F.coalesce(~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")), F.lit(False)))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).cast("long")
    v = F.transform(x, lambda c: F.floor(c.cast("double") * 256).cast("long"))
    rows = embeddings.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(fine, F.lit(False)))
    rows = rows.select(F.col("vec_id").cast("long").alias("id"), F.struct(label.alias("label"), v.alias("v")).alias("row"))
    one = rows.groupBy("id").agg(F.min("row").alias("row"))
    return one.select("id", "row.label", "row.v")


def _along(curve):
    def place(batches):
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(curve.value.places(stacked(batch.column("v")))), *batch.columns], ["place", *batch.schema.names])

    return place


def curve_of(rows: DataFrame):
    """The curve fitted on ``SAMPLE`` vectors at most, those of the smallest hashes; None for an empty table."""
    picked = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").toArrow().column("v")
    if not len(picked):
        return None
    v = stacked(picked).astype(np.float64)
    return rows.sparkSession.sparkContext.broadcast(Curve(v if v.shape[1] else np.zeros((len(v), 1))))


def packed(rows: DataFrame, curve) -> DataFrame:
    """The Hilbert-ordered blocks of ``id, label, v``, written."""
    placed = rows.mapInArrow(_along(curve), "place long, id long, label long, v array<long>")
    ordered = placed.repartitionByRange("place", "id").sortWithinPartitions("place", "id")
    return written(ordered.mapInArrow(_pack_blocks, BLOCKS), "vector-blocks")


# ------------------------------------------------------------------ queries

QUERY = "anchor long, partner long, partner_score long, label long, low long, high long, v binary, place long"
NUMBERS = ["anchor", "partner", "partner_score", "label", "low", "high"]


def _anchor_queries(curve, every: int, wanted: int):
    """Anchors of each block, with the score that the last of their positives reaches at least."""

    def make(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids, labels = (np.frombuffer(row[c], np.int64) for c in ("ids", "labels"))
                v = _matrix(row["v"], len(ids))
                own = np.flatnonzero(ids % every == 0)
                if not len(own):
                    continue
                score = np.where((labels[own][:, None] == labels) & (ids[own][:, None] != ids), products(v[own], v), LOWEST)
                reached = np.sort(score, axis=1)[:, -wanted] if score.shape[1] >= wanted else np.full(len(own), LOWEST)
                none = np.zeros(len(own), np.int64)
                columns = [ids[own], none, none, labels[own], reached, none + HIGHEST]
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, columns), pa.array([_bytes(x) for x in v[own]], pa.binary()), pa.array(curve.value.places(v[own]))],
                    [c.split()[0] for c in QUERY.split(", ")],
                )

    return make


QUERY_BLOCK = "qblock long, queries int, numbers binary, v binary"


def _pack_queries(batches):
    for k, table in enumerate(_rows_of(batches, QUERIES)):
        numbers = np.stack([table.column(c).to_numpy() for c in NUMBERS])
        rows = [np.frombuffer(x, np.int64) for x in table.column("v").to_pylist()]
        width = max(map(len, rows))
        v = np.stack([np.pad(x, (0, width - len(x))) for x in rows])
        row = [(TaskContext.get().partitionId() << 32) + k, len(rows), _bytes(numbers), _bytes(v)]
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds)], [c.split()[0] for c in QUERY_BLOCK.split(", ")])


def _meetings(batches):
    """``qblock, block`` of the blocks whose bounds meet the range of one of the queries."""
    for batch in batches:
        for row in batch.to_pylist():
            numbers, v = _matrix(row["numbers"], len(NUMBERS)), _matrix(row["v"], row["queries"])
            zones = row["zones"]
            width = max(len(z["low"]) for z in zones) // 8
            low, high = (np.stack([fitted(_matrix(z[c], 1), width)[0] for z in zones]) for c in ("low", "high"))
            least, most = bounds(v, low, high)
            meets = ((most >= numbers[4][:, None]) & (least <= numbers[5][:, None])).any(axis=0)
            found = np.array([z["block"] for z in zones], np.int64)[meets]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), row["qblock"])), pa.array(found)], ["qblock", "block"])


BEST = "anchor long, partner long, partner_score long, id long, score long"


def _scan(same: bool, wanted: int):
    """The best rows of each query over the blocks that the task reads for its block of queries."""

    def best_of(queries: np.ndarray, kept: list) -> pa.RecordBatch:
        q, score, ids = (np.concatenate(x) for x in zip(*kept)) if kept else (np.zeros(0, np.int64),) * 3
        order = np.lexsort((ids, -score, q))
        q, score, ids = q[order], score[order], ids[order]
        first = np.searchsorted(q, q)
        top = np.arange(len(q)) - first < wanted
        q, score, ids = q[top], score[top], ids[top]
        return q, score, ids

    def out(numbers, kept):
        q, score, ids = best_of(numbers, kept)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (numbers[0][q], numbers[1][q], numbers[2][q], ids, score)], [c.split()[0] for c in BEST.split(", ")])

    def scan(batches):
        current, numbers, kept = None, None, []
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                if row["qblock"] != current:
                    if current is not None:
                        yield out(numbers, kept)
                    current, kept = row["qblock"], []
                    numbers, v = _matrix(row["numbers"], len(NUMBERS)), _matrix(row["qv"], row["queries"])
                    anchors, of = np.unique(numbers[0], return_inverse=True)
                    one = v[np.unique(of, return_index=True)[1]]
                ids, labels = (np.frombuffer(row[c], np.int64) for c in ("ids", "labels"))
                score = products(one, _matrix(row["v"], row["rows"]))
                order = np.argsort(-score, axis=1, kind="stable")
                score = np.take_along_axis(score, order, axis=1)[of]
                order = order[of]
                equal = labels[order] == numbers[3][:, None]
                fits = (score >= numbers[4][:, None]) & (score <= numbers[5][:, None])
                fits &= (equal & (ids[order] != numbers[0][:, None])) if same else ~equal
                fits &= np.cumsum(fits, axis=1) <= wanted
                q, at = np.nonzero(fits)
                kept.append((q, score[q, at], ids[order[q, at]]))
                kept = [best_of(numbers, kept)]
        if current is not None:
            yield out(numbers, kept)

    return scan


def best(queries: DataFrame, blocks: DataFrame, same: bool, wanted: int) -> DataFrame:
    """``anchor, partner, partner_score, id, score, rank``: the best ``wanted`` rows of each query.

    ``queries`` (QUERY) name the label and range of scores; ``blocks`` is a packed table.
    """
    ordered = queries.repartitionByRange("place", "anchor", "partner").sortWithinPartitions("place", "anchor", "partner")
    packs = written(ordered.mapInArrow(_pack_queries, QUERY_BLOCK), "query-blocks")
    tiles = max(1, -(-blocks.count() // ZONES))
    tile = F.pmod(F.xxhash64("block"), F.lit(tiles))
    zones = blocks.groupBy(tile.alias("tile")).agg(F.collect_list(F.struct("block", "low", "high")).alias("zones"))
    asked = packs.withColumn("tile", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(tiles - 1).cast("long"))))
    met = written(asked.join(zones, "tile").mapInArrow(_meetings, "qblock long, block long"), "query-meetings")
    read = met.join(blocks.drop("low", "high"), "block").join(packs.withColumnRenamed("v", "qv"), "qblock")
    dealt = read.repartition("qblock", F.pmod("block", F.lit(PARTS))).sortWithinPartitions("qblock")
    found = dealt.mapInArrow(_scan(same, wanted), BEST)
    rank = F.row_number().over(Window.partitionBy("anchor", "partner").orderBy(F.desc("score"), "id"))
    return found.select("*", rank.alias("rank")).where(F.col("rank") <= wanted)


def hard_negatives(
    embeddings: DataFrame, every: int = ANCHOR_EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``."""
    names = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    rows = written(points(embeddings), "vector-points")
    curve = curve_of(rows)
    if curve is None:
        return rows.sparkSession.createDataFrame([], names)
    blocks = packed(rows, curve)
    anchors = written(blocks.mapInArrow(_anchor_queries(curve, every, positives), QUERY), "anchors")
    near = best(anchors, blocks, True, positives).select("anchor", F.col("id").alias("partner"), F.col("score").alias("partner_score"))
    score = F.col("partner_score")
    ranges = near.join(anchors.select("anchor", "label", "v", "place"), "anchor").select(
        "anchor", "partner", "partner_score", "label",
        (-F.floor(-score / F.lit(2).cast("decimal(1,0)"))).cast("long").alias("low"),
        F.floor(score.cast("decimal(20,0)") * 95 / 100).cast("long").alias("high"),
        "v", "place",
    )
    found = best(ranges.where("low <= high"), blocks, False, negatives)
    return found.select(
        F.col("anchor").alias("anchor_id"),
        F.col("partner").alias("positive_id"),
        "rank",
        F.col("id").alias("negative_id"),
        F.col("partner_score").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )


def query(embeddings: DataFrame) -> DataFrame:
    return hard_negatives(embeddings)


ORACLE = """
WITH r AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(x::DOUBLE * 256)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.id AS anchor, b.id AS id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM r a JOIN r b ON a.id <> b.id WHERE a.id % 50 = 0),
p AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) AS place FROM s WHERE same)
  WHERE place <= 5),
n AS (
  SELECT p.anchor AS anchor_id, p.id AS positive_id, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor, p.id ORDER BY s.score DESC, s.id) AS rank
  FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same
   AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""
