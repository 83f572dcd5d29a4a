"""Line dedup: keep a frequent line only in the largest document that holds it.

Method: the line keys are hashed (128 bit), and the rows ``(hash, document,
position)`` are range-partitioned by the whole row, with the largest document
first, so that a line held by a third of all documents spreads over many
partitions.  Each partition is streamed once in that order, batch by batch, for
first occurrences; one edge row per partition (not per key) tells how the runs
continue across partition borders.  The result is one compressed keep bitmap for each document that
loses lines; no text is shuffled until the bitmaps are applied.

The sorted rows are checkpointed, so both passes see the same partitions
whatever the planner or a lost executor does.

Defined results: a null or empty text is one empty line; a null ``doc_id``
counts as one document, smaller than all others; rows that repeat an id count
as the same document, and each row gets its own bitmap (rows equal in id and
text share one); an empty table gives an empty result; other columns pass
through, and one named like an added column is replaced.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitflow.llm.common import let, shared_folder, text_or_empty, written
from visitflow.llm.vector import BASE, BASE2, IS_SPACE, LOWER, chunks, range_hash

MIN_CHARS = 20
MIN_DOCUMENTS = 3
NULL_ID = -(2**63)
ROW = "h1 long, h2 long, doc long, th long, pos int"


def _text_hash() -> Column:
    return F.xxhash64(text_or_empty())


def _lines() -> Column:
    return F.split(text_or_empty(), "\n", -1)


def _line_hashes(min_chars: int):
    def hashes(batches):
        for batch in batches:
            doc, th = (batch.column(c).to_numpy() for c in ("doc", "th"))
            for row, offsets, data in chunks(batch.column("text")):
                n = len(data)
                cuts = np.flatnonzero(data == 10)
                text_of = np.concatenate([np.searchsorted(offsets, cuts, side="right") - 1, np.arange(len(offsets) - 1)])
                starts = np.concatenate([cuts + 1, offsets[:-1]])
                # by text, then place: an empty text shares its offset with the next one
                order = np.lexsort((starts, text_of))
                starts, text_of = starts[order], text_of[order]
                last = np.append(text_of[1:] != text_of[:-1], True)
                ends = np.where(last, offsets[text_of + 1], np.append(starts[1:], 0) - 1)
                first_line = np.searchsorted(text_of, np.arange(len(offsets) - 1))
                pos = np.arange(len(starts)) - first_line[text_of]
                solid = np.flatnonzero(~IS_SPACE[data])
                a, b = np.searchsorted(solid, starts), np.searchsorted(solid, ends)
                some = b > a
                starts, ends, pos, text_of = solid[a[some]], solid[b[some] - 1] + 1, pos[some], text_of[some]
                points = np.zeros(n + 1, dtype=np.int64)
                np.cumsum((data & 0xC0) != 0x80, out=points[1:])
                long = points[ends] - points[starts] >= min_chars
                starts, ends, pos, text_of = starts[long], ends[long], pos[long], row + text_of[long]
                lower = LOWER[data]
                columns = [
                    range_hash(lower, starts, ends, BASE).view(np.int64),
                    range_hash(lower, starts, ends, BASE2).view(np.int64),
                    doc[text_of],
                    th[text_of],
                    pos.astype(np.int32),
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["h1", "h2", "doc", "th", "pos"])

    return hashes


def line_rows(documents: DataFrame, min_chars: int) -> DataFrame:
    """One row per line whose key is long enough; ``doc`` is never null."""
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID))
    rows = documents.select(doc.alias("doc"), _text_hash().alias("th"), text_or_empty().alias("text"))
    return rows.mapInArrow(_line_hashes(min_chars), ROW)


def _runs(batch, last) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, bool]:
    """The batch's columns, the starts of its runs of one hash, flags of rows that begin a
    document in their run, and whether the first run goes on from the row ``last``."""
    part = {c: batch.column(c).to_numpy() for c in ("h1", "h2", "doc")}
    h1, h2, doc = part["h1"], part["h2"], part["doc"]
    first = np.ones(len(h1), dtype=bool)
    first[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
    new_doc = first.copy()
    new_doc[1:] |= doc[1:] != doc[:-1]
    goes_on = last is not None and (h1[0], h2[0]) == last[:2]
    if goes_on and doc[0] == last[2]:
        new_doc[0] = False
    return part, np.flatnonzero(first), new_doc, goes_on


EDGE = "pid int, head1 long, head2 long, head_first long, head_last long, head_docs long, tail1 long, tail2 long, tail_first long, tail_last long, tail_docs long, whole boolean"


def _edges(batches):
    """The partition's first and last run: hash, first and last document, documents."""
    head = run = last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        part, starts, new_doc, goes_on = _runs(batch, last)
        ends = np.append(starts[1:], batch.num_rows)
        for k in sorted({0, len(starts) - 1}):  # a run between them neither begins nor ends the partition
            a, b = starts[k], ends[k]
            docs = int(new_doc[a:b].sum())
            if k == 0 and goes_on:
                run[3:] = [int(part["doc"][b - 1]), run[4] + docs]
                continue
            if run is not None and head is None:
                head = run
            run = [int(part["h1"][a]), int(part["h2"][a]), int(part["doc"][a]), int(part["doc"][b - 1]), docs]
        last = (part["h1"][-1], part["h2"][-1], part["doc"][-1])
    if run is None:
        return
    row = [TaskContext.get().partitionId(), *(head or run), *run, head is None]
    names = [x.split()[0] for x in EDGE.split(", ")]
    types = {"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_()}
    kinds = [types[x.split()[1]] for x in EDGE.split(", ")]
    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds)], names)


def _continued(edges) -> dict[int, tuple]:
    """Per partition: keeper and document count of its head run and of its tail run.

    ``edges`` has one row per partition, so this loop is bounded by the
    partition count.
    """
    groups: list[list] = []  # one entry per run that touches a border: [hash, keeper, last doc, docs, members]
    for e in sorted(edges, key=lambda x: x["pid"]):
        head = (e["head1"], e["head2"])
        if groups and groups[-1][0] == head:
            g = groups[-1]
            g[3] += e["head_docs"] - (g[2] == e["head_first"])
            g[2] = e["head_last"]
            g[4].append((e["pid"], "head"))
        else:
            groups.append([head, e["head_first"], e["head_last"], e["head_docs"], [(e["pid"], "head")]])
        if e["whole"]:
            groups[-1][4].append((e["pid"], "tail"))
        else:
            groups.append(
                [(e["tail1"], e["tail2"]), e["tail_first"], e["tail_last"], e["tail_docs"], [(e["pid"], "tail")]]
            )
    found: dict[int, dict] = {}
    for _, keeper, _, docs, members in groups:
        for pid, end in members:
            found.setdefault(pid, {})[end] = (keeper, docs)
    return {pid: (*x["head"], *x["tail"]) for pid, x in found.items()}


def _dropper(borders, min_documents: int):
    """Emits the lines to drop batch by batch.

    A run's first row holds its keeper.  Rows wait only until their run has
    ``min_documents`` documents, so what is held is the lines of fewer documents
    than that, whatever the size of the run or of the partition.
    """

    def drop(batches):
        last, keeper, docs, waiting, first_run = None, None, 0, [], True
        head_keeper = head_docs = tail_docs = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if last is None:
                head_keeper, head_docs, _, tail_docs = borders.value[TaskContext.get().partitionId()]
            part, starts, new_doc, goes_on = _runs(batch, last)
            total = np.add.reduceat(new_doc.astype(np.int64), starts)
            keepers = part["doc"][starts]
            if last is None:
                keepers[0] = head_keeper
            elif goes_on:
                total[0] += docs
                keepers[0] = keeper
            else:
                waiting, first_run = [], False
            if first_run:
                total[0] = head_docs
            lengths = np.diff(np.append(starts, batch.num_rows))
            lost = part["doc"] != np.repeat(keepers, lengths)
            gone = lost & np.repeat(total >= min_documents, lengths)
            if total[0] >= min_documents:
                yield from waiting
                waiting = []
            if len(starts) > 1:
                waiting, first_run = [], False
            if gone.any():
                yield _positions(batch, gone)
            open_run = np.zeros(batch.num_rows, dtype=bool)
            open_run[starts[-1] :] = total[-1] < min_documents
            if (lost & open_run).any():
                waiting.append(_positions(batch, lost & open_run))
            keeper, docs = keepers[-1], total[-1]
            last = (part["h1"][-1], part["h2"][-1], part["doc"][-1])
        if last is not None and tail_docs >= min_documents:
            yield from waiting

    return drop


def _positions(batch, rows: np.ndarray):
    picked = batch.filter(pa.array(rows))
    return pa.RecordBatch.from_arrays([picked.column(c) for c in ("doc", "th", "pos")], ["doc", "th", "pos"])


def pack(positions) -> bytes:
    """Compressed keep bitmap: bit i is 0 if line i goes; lines beyond its end stay."""
    keep = np.ones(int(max(positions)) + 1, dtype=np.uint8)
    keep[np.asarray(positions)] = 0
    return len(keep).to_bytes(4, "little") + zlib.compress(np.packbits(keep).tobytes())


def unpack(bitmap: bytes) -> bytes:
    """One byte per line: 1 keep, 0 drop."""
    bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap[4:]), dtype=np.uint8))
    return bits[: int.from_bytes(bitmap[:4], "little")].tobytes()


def _pack(column: pd.Series) -> pd.Series:
    return column.map(pack)


def _unpack(column: pd.Series) -> pd.Series:
    return column.map(unpack)


def keep_bitmaps(
    documents: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS
) -> DataFrame:
    """``doc, th, bitmap`` of the documents that lose lines (``th``: hash of the text)."""
    spark = documents.sparkSession
    shared_folder(spark)
    order = [F.col("h1"), F.col("h2"), F.col("doc").desc(), F.col("th"), F.col("pos")]
    rows = line_rows(documents, min_chars).repartitionByRange(*order).sortWithinPartitions(*order).checkpoint()
    edges = rows.mapInArrow(_edges, EDGE).collect()
    borders = spark.sparkContext.broadcast(_continued(edges))
    dropped = rows.mapInArrow(_dropper(borders, min_documents), "doc long, th long, pos int")
    positions = dropped.groupBy("doc", "th").agg(F.collect_set("pos").alias("gone"))
    return written(
        positions.select("doc", "th", F.pandas_udf(_pack, "binary")("gone").alias("bitmap")), "line-bitmaps"
    )


def line_dedup(documents: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """``documents`` with ``text`` replaced by its kept lines, and ``n_lines, n_dropped``."""
    maps = keep_bitmaps(documents, min_chars, min_documents).select(
        F.col("doc").alias("_l_doc"), F.col("th").alias("_l_th"), F.pandas_udf(_unpack, "binary")("bitmap").alias("_l_keep")
    )
    keyed = documents.drop("n_lines", "n_dropped")
    on = (F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)) == F.col("_l_doc")) & (_text_hash() == F.col("_l_th"))
    joined = keyed.join(maps.hint("merge"), on, "left")  # one plan at every size
    past = F.octet_length("_l_keep")

    def kept(lines: Column) -> Column:
        def stays(line: Column, i: Column) -> Column:
            return (i >= past) | (F.substring(F.col("_l_keep"), i + 1, F.lit(1)) == F.lit(b"\x01"))

        return F.array_join(F.filter(lines, stays), "\n")

    text = F.when(F.col("_l_keep").isNull(), text_or_empty()).otherwise(let(_lines(), kept))
    zeros = F.octet_length(F.translate(F.hex("_l_keep"), "0", "")) # one digit 1 for each kept line
    return joined.withColumns(
        {
            "n_lines": F.size(_lines()).cast("long"),
            "n_dropped": F.coalesce(past - zeros, F.lit(0)).cast("long"),
            "text": text,
        }
    ).select(*keyed.columns, "n_lines", "n_dropped")


def query(documents: DataFrame) -> DataFrame:
    return line_dedup(documents.select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    )


ORACLE = r"""
WITH l AS (
  SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
e AS (
  SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM l),
k AS (
  SELECT doc_id, pos, line,
         translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM e),
f AS (
  SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (
  SELECT k.doc_id, k.pos, k.line, coalesce(f.keeper <> k.doc_id, FALSE) AS gone FROM k LEFT JOIN f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
