"""Suffix-array dedup: removes each byte covered by a 50-byte string that also starts in a smaller document.

1. The texts are packed where they are read into shards of about ``SHARD``
   bytes, one Parquet row each.  Texts that occur more than once count once, for
   their smallest document; the other copies go as a whole: only hashes are
   shuffled to find them, and each shard is told the places of its copies.
2. Each 50-byte window belongs to its minimizer, the smallest hash of its
   24-byte strings; windows in a row with one minimizer form a passage.  About
   four words long, few of these strings meet by chance.  Every
   shard hands on its minimizers sorted, cut into ranges of hashes; a range is
   merged by binary search of each shard's run in the others', which leaves the
   minimizers that two shards, or two documents of one, have in common.
3. The passages of these minimizers, each once per shard, are dealt by
   minimizer, so that equal windows meet.  A task builds the suffix array of its
   passages by Larsson-Sadakane refinement (order by 8 bytes, then only tied
   groups by doubled prefixes) and the common prefixes of neighbours by Kasai's
   rule (all passages in step).  Neighbours with 50 bytes in common form a
   group, and the smallest document of a group decides for its windows.
4. The decisions return to the shards, which mark the bytes and digest the rest.

A minimizer with more than ``HOT`` passages is not given to one task: its windows
are grouped one by one, with a partial minimum before the shuffle.

Defined results: a null or empty text has no bytes and loses none; a null
``doc_id`` is one document, smaller than all others; rows that repeat an id are
the same document, whose strings do not remove each other; rows equal in id and
text get equal results; an empty table gives an empty result; other columns
are ignored.  Long texts are worked on in blocks, whole.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitflow.llm.common import text_or_empty, written
from visitflow.llm.vector import BASE, MIX1, MIX2, mix, power_table

SPAN = 50  # bytes of a string that must not repeat
GRAM = 24  # bytes hashed for a minimizer, a multiple of 8
DROPPED = 16  # bits of a minimizer's hash not kept; equal ones by chance only add candidates
SHARD = 4 << 20  # bytes of a shard; one longer text is a shard of its own
BLOCK = 1 << 17  # window starts worked on at once
LONGEST = 64  # windows of a passage
HOT = 20_000  # passages of a minimizer that one task may get
GROUP = 1 << 20  # bytes of passages in a suffix array
RANGE = 32 << 20  # bytes of minimizers merged by one task
NULL_ID = -(2**63)
SEPARATOR = 0xFF  # no byte of UTF-8
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


# ------------------------------------------------------------------ passages


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position, first byte lowest; the last seven positions are left out."""
    x = data.astype(np.uint64)
    for k in (1, 2, 4):
        x = x[:-k] | (x[k:] << np.uint64(8 * k))
    return x


def _block_passages(data: np.ndarray, valid: np.ndarray):
    """Passages of a block: start, stop (window starts), minimizer and a hash of the bytes."""
    n = len(valid)
    x = _words(data)
    wide = len(x) - GRAM + 8
    gram = np.zeros(wide, dtype=np.uint64)
    for k in range(GRAM - 8, -1, -8):
        gram = mix(x[k : k + wide] * MIX1 + gram * MIX2)
    least, width = gram, 1
    wanted = SPAN - GRAM + 1
    while width * 2 <= wanted:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = wanted - width
    least = (np.minimum(least[: len(least) - rest], least[rest:]) if rest else least)[:n]
    begin = valid.copy()
    begin[1:] &= ~valid[:-1] | (least[1:] != least[:-1])
    end = valid.copy()
    end[:-1] &= ~valid[1:] | (least[1:] != least[:-1])
    start, stop = np.flatnonzero(begin), np.flatnonzero(end) + 1
    pieces = (stop - start + LONGEST - 1) // LONGEST
    if (pieces > 1).any():
        place = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        first, last = np.repeat(start, pieces) + place * LONGEST, np.repeat(stop, pieces)
        start, stop = first, np.minimum(first + LONGEST, last)
    powers = power_table(BASE, len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=sums[1:])
    inverse = power_table(pow(BASE, -1, 1 << 64), len(data) + 1)
    content = mix((sums[stop + SPAN - 1] - sums[start]) * inverse[start] + (stop - start).astype(np.uint64))
    return start, stop, mix(least[start]) >> np.uint64(DROPPED), content


def passages(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """All passages of a shard: ``start, stop`` (window starts in ``data``), ``doc`` (index), ``h`` (minimizer)
    and ``u`` (hash of the bytes); the two hashes together name a passage."""
    n = len(data)
    change = np.zeros(n + 1, dtype=np.int32)
    starts, ends = offsets[:-1], offsets[1:]
    some = ends > starts
    np.add.at(change, np.maximum(starts[some], ends[some] - SPAN + 1), 1)
    np.add.at(change, ends[some], -1)
    valid = np.cumsum(change[:-1]) == 0
    names = ["start", "stop", "h", "u"]
    found: list[list] = [[] for _ in names]
    for at in range(0, n, BLOCK):
        part = valid[at : at + BLOCK]
        if not part.any():
            continue
        block = data[at : at + BLOCK + SPAN - 1]
        missing = len(part) + SPAN - 1 - len(block)
        block = np.pad(block, (0, missing)) if missing else block
        start, stop, *hashes = _block_passages(block, part)
        for held, values in zip(found, (start + at, stop + at, *hashes)):
            held.append(values)
    held = {name: np.concatenate(x).view(np.int64) if x else np.zeros(0, np.int64) for name, x in zip(names, found)}
    return held | {"doc": np.searchsorted(offsets, held["start"], side="right") - 1}


# ------------------------------------------------------------------ suffix array


def suffix_array(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sorted suffixes of passages that end with a separator each (``ends``: their places).

    Larsson-Sadakane: order by the first eight bytes, then by twice as many in
    each round, in the groups that are still tied.  Separators count as
    different, in order of place.
    """
    n = len(data)
    passage = np.searchsorted(ends, np.arange(n))
    left = ends[passage] - np.arange(n)  # bytes before the separator
    x = np.zeros(n, dtype=np.uint64)
    padded = np.pad(data, (0, 8)).astype(np.uint64)
    for k in range(8):
        x = (x << np.uint64(8)) | padded[k : k + n]
    over = np.clip(7 - left, 0, 7).astype(np.uint64) * np.uint64(8)
    x = (x >> over) << over
    order = np.argsort(x, kind="stable")
    x = x[order]
    first = np.ones(n, dtype=bool)
    first[1:] = x[1:] != x[:-1]
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    h, tied = 8, np.flatnonzero(~(first & np.append(first[1:], True)))
    while len(tied):
        members = order[tied]
        beyond = left[members] < h
        key = np.where(beyond, n + passage[members], rank[np.minimum(members + h, n - 1)])
        both = rank[members] * (2 * n + 1) + key
        by = np.argsort(both, kind="stable")
        members, both = members[by], both[by]
        order[tied] = members
        first = np.ones(len(both), dtype=bool)
        first[1:] = both[1:] != both[:-1]
        rank[members] = tied[np.maximum.accumulate(np.where(first, np.arange(len(both)), 0))]
        tied = tied[~(first & np.append(first[1:], True))]
        h *= 2
    return order


def common_prefixes(data: np.ndarray, order: np.ndarray, starts: np.ndarray, ends: np.ndarray, most: int) -> np.ndarray:
    """For the suffixes with ``most`` bytes or more: bytes in common with the suffix before them in order, ``most`` at most.

    Kasai: what a suffix shares, the next one of its passage shares but for one
    byte.  All passages advance together.  Other suffixes are left at 0.
    """
    before = np.full(len(data), -1, dtype=np.int64)
    before[order[1:]] = order[:-1]
    shared = np.zeros(len(data), dtype=np.int64)
    alive = np.argsort(starts - ends, kind="stable")  # longest first
    lengths = (ends - starts)[alive]
    h = np.zeros(len(starts), dtype=np.int64)
    limit = len(data) - 1
    for j in range(int(lengths.max(initial=0)) - most + 1):
        alive = alive[: np.searchsorted(-lengths, -(most + j), side="right")]
        at = starts[alive] + j
        other = before[at]
        now = np.maximum(h[alive] - 1, 0)
        now[other < 0] = 0
        open_ = np.flatnonzero(other >= 0)
        while len(open_):
            reach = now[open_]
            more = (reach < most) & (data[np.minimum(at[open_] + reach, limit)] == data[np.minimum(other[open_] + reach, limit)])
            open_ = open_[more]
            now[open_] += 1
        h[alive] = now
        shared[at] = now
    return shared


def window_minima(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """For the place of each window of the passages, the smallest document of equal ones; the largest long elsewhere."""
    order = suffix_array(data, ends)
    shared = common_prefixes(data, order, starts, ends, SPAN)
    passage = np.searchsorted(ends, order)
    whole = ends[passage] - order >= SPAN
    order, passage = order[whole], passage[whole]
    first = shared[order] < SPAN
    first[:1] = True
    least = np.minimum.reduceat(docs[passage], np.flatnonzero(first))
    by_place = np.full(len(data), np.iinfo(np.int64).max)
    by_place[order] = least[np.cumsum(first) - 1]
    return by_place


def gathered(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, room: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The byte ranges one after the other, each followed by ``room`` separators, and their offsets (with an end)."""
    offsets = np.concatenate([[0], np.cumsum(lengths + room)])
    at = np.arange(offsets[-1]) - np.repeat(offsets[:-1] - starts, lengths + room)
    out = data[np.minimum(at, len(data) - 1)]
    for k in range(room):
        out[offsets[1:] - 1 - k] = SEPARATOR
    return out, offsets


# ------------------------------------------------------------------ shards


def _array(a, kind=np.int64) -> bytes:
    return np.ascontiguousarray(a, dtype=kind).tobytes()


SHARDS = "shard long, n_bytes long, docs binary, h1 binary, h2 binary, offsets binary, data binary"


def _pack(batches):
    held, size, k = [], 0, 0

    def row(k):
        docs, h1, h2, texts = zip(*held)
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        values = [(TaskContext.get().partitionId() << 32) + k, size, _array(docs), _array(h1), _array(h2), _array(offsets), zstandard.ZstdCompressor(level=1).compress(b"".join(texts))]
        kinds = [pa.int64()] * 2 + [pa.binary()] * 5
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds)], [c.split()[0] for c in SHARDS.split(", ")])

    for batch in batches:
        columns = [batch.column(c) for c in ("doc", "h1", "h2", "text")]
        for i in range(batch.num_rows):
            doc, h1, h2, text = (c[i].as_py() for c in columns)
            text = text.encode()
            if held and size + len(text) > SHARD:
                yield row(k)
                held, size, k = [], 0, k + 1
            held.append((doc, h1, h2, text))
            size += len(text)
    if held:
        yield row(k)


def _keyed(documents: DataFrame) -> DataFrame:
    text = text_or_empty()
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID))
    hashes = [F.xxhash64(text).alias("h1"), F.xxhash64(text, F.lit("second")).alias("h2")]
    return documents.select("doc_id", doc.alias("doc"), *hashes, F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))


HEADS = "shard long, at int, doc long, h1 long, h2 long"


def _heads(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            docs, h1, h2 = (np.frombuffer(batch.column(c)[i].as_py(), np.int64) for c in ("docs", "h1", "h2"))
            shard = np.full(len(docs), batch.column("shard")[i].as_py(), np.int64)
            values = [shard, np.arange(len(docs), dtype=np.int32), docs, h1, h2]
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in values], [c.split()[0] for c in HEADS.split(", ")])


def copies(packs: DataFrame) -> DataFrame:
    """``shard, copies``: the places of the texts that a smaller document has too; written."""
    heads = packs.select("shard", "docs", "h1", "h2").mapInArrow(_heads, HEADS)
    least = heads.groupBy("h1", "h2").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where("least < most")
    found = heads.join(least, ["h1", "h2"]).where("doc > least")
    return written(found.groupBy("shard").agg(F.collect_list("at").alias("copies")), "suffix-copies")


def shards(documents: DataFrame) -> DataFrame:
    """The texts of ``SPAN`` bytes or more in written shards, and the places of copies in each."""
    texts = _keyed(documents).where(F.col("n_bytes") >= SPAN).select("doc", "h1", "h2", "text")
    packs = written(texts.mapInArrow(_pack, SHARDS), "suffix-shards")
    return packs.join(copies(packs), "shard", "left")


def _kept(row) -> np.ndarray:
    keep = np.ones(len(row["docs"]) // 8, dtype=bool)
    keep[np.array(row["copies"] or [], dtype=np.int64)] = False
    return keep


def _shard(row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, offsets and documents of a shard's texts without the copies."""
    data = zstandard.ZstdDecompressor().decompress(row["data"])
    offsets, docs = (np.frombuffer(row[c], np.int64) for c in ("offsets", "docs"))
    if row["copies"]:
        keep, view = _kept(row), memoryview(data)
        data = b"".join(view[a:b] for a, b in zip(offsets[:-1][keep].tolist(), offsets[1:][keep].tolist()))
        offsets, docs = np.concatenate([[0], np.cumsum(np.diff(offsets)[keep])]), docs[keep]
    return np.frombuffer(data, np.uint8), offsets, docs


def _only(table: pa.Table) -> dict | None:
    return {c: table.column(c)[0].as_py() for c in table.column_names} if table.num_rows else None


def _distinct(found: dict, docs: np.ndarray):
    """Order of the passages by ``h, u``, starts of equal ones, smallest and largest document of each."""
    order = np.lexsort((found["u"], found["h"]))
    h, u = (found[c][order] for c in ("h", "u"))
    first = np.ones(len(order), dtype=bool)
    first[1:] = (h[1:] != h[:-1]) | (u[1:] != u[:-1])
    at = np.flatnonzero(first)
    doc = docs[found["doc"][order]]
    if not len(at):
        return order, at, doc, doc
    return order, at, np.minimum.reduceat(doc, at), np.maximum.reduceat(doc, at)


def _planes(a: np.ndarray) -> bytes:
    """Sorted hashes, compressed byte by byte: the high bytes of neighbours are mostly equal."""
    planes = np.ascontiguousarray(a, dtype=np.int64).view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _from_planes(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(np.int64).ravel()


MINIMIZERS = "range int, shard long, hashes binary, passages binary, many binary"


def _minimizers(ranges: int):
    def send(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in ("shard", "docs", "offsets", "data", "copies")}
                data, offsets, docs = _shard(row)
                found = passages(data, offsets)
                order, at, low, high = _distinct(found, docs)
                h = found["h"][order][at]
                first = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else at
                count = np.diff(np.append(first, len(h)))
                many = np.minimum.reduceat(low, first) < np.maximum.reduceat(high, first) if len(h) else first > 0
                h = h[first]
                place = ((h.view(np.uint64) >> np.uint64(32 - DROPPED)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int32)
                by = np.lexsort((h, place))
                h, count, many, place = h[by], count[by], many[by], place[by]
                used, begin = np.unique(place, return_index=True)
                ends = np.append(begin[1:], len(h))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(used),
                        pa.array(np.full(len(used), row["shard"], np.int64)),
                        pa.array([_planes(h[a:b]) for a, b in zip(begin, ends)], pa.binary()),
                        pa.array([_array(count[a:b], np.int32) for a, b in zip(begin, ends)], pa.binary()),
                        pa.array([_array(many[a:b], np.uint8) for a, b in zip(begin, ends)], pa.binary()),
                    ],
                    [c.split()[0] for c in MINIMIZERS.split(", ")],
                )

    return send


SHARED = "shard long, hashes binary, hot binary, size long, n_hot long"


def _merge(table: pa.Table) -> pa.Table:
    """One range of hashes: for each shard the minimizers that it shares, and those of too many passages."""
    runs = [_from_planes(x) for x in table.column("hashes").to_pylist()]
    counts = [np.frombuffer(x, np.int32) for x in table.column("passages").to_pylist()]
    many = [np.frombuffer(x, np.uint8) > 0 for x in table.column("many").to_pylist()]
    every = np.concatenate(runs)
    order = np.argsort(every, kind="stable")
    sorted_ = every[order]
    first = np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1]))
    shared = (np.diff(np.append(first, len(sorted_))) > 1) | np.maximum.reduceat(np.concatenate(many)[order], first)
    total = np.add.reduceat(np.concatenate(counts)[order].astype(np.int64), first)
    keys, hot = sorted_[first][shared], total[shared] > HOT
    out = []
    for shard, run, count in zip(table.column("shard").to_pylist(), runs, counts):
        at = np.searchsorted(keys, run)
        hit = (at < len(keys)) & (keys[np.minimum(at, len(keys) - 1)] == run) if len(keys) else np.zeros(len(run), bool)
        is_hot = hot[at[hit]]
        mine = run[hit]
        out.append((shard, _array(mine[~is_hot]), _array(mine[is_hot]), int(count[hit][~is_hot].sum()), int(is_hot.sum())))
    names = [c.split()[0] for c in SHARED.split(", ")]
    kinds = [pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
    return pa.table({n: pa.array(list(v), t) for n, v, t in zip(names, zip(*out), kinds)})


def shared_minimizers(packs: DataFrame) -> DataFrame:
    """``shard, hashes, hot``: what each shard has in common with others; written."""
    size = packs.select(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    tasks = int(packs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(tasks, -(-size // RANGE))
    sent = packs.select("shard", "docs", "offsets", "data", "copies").mapInArrow(_minimizers(ranges), MINIMIZERS)
    return written(sent.groupBy("range").applyInArrow(_merge, SHARED), "suffix-minimizers")


PASSAGES = "shard long, h long, u long, low long, high long, body binary"


def _passages_of(column: str):
    """The passages of a shard whose minimizer is among its shared ones, each once."""

    def emit(left: pa.Table, right: pa.Table) -> pa.Table:
        row = _only(left)
        names = [c.split()[0] for c in PASSAGES.split(", ")]
        kinds = [pa.int64()] * 5 + [pa.binary()]
        wanted = [np.frombuffer(x, np.int64) for x in right.column(column).to_pylist()] if right.num_rows else []
        wanted = np.sort(np.concatenate(wanted)) if wanted else np.zeros(0, np.int64)
        if row is None or not len(wanted):
            return pa.table({n: pa.array([], t) for n, t in zip(names, kinds)})
        data, offsets, docs = _shard(row)
        found = passages(data, offsets)
        at = np.minimum(np.searchsorted(wanted, found["h"]), len(wanted) - 1)
        hit = wanted[at] == found["h"]
        found = {c: v[hit] for c, v in found.items()}
        order, first, low, high = _distinct(found, docs)
        one = order[first]
        body, ends = gathered(data, found["start"][one], found["stop"][one] - found["start"][one] + SPAN - 1)
        body = pa.Array.from_buffers(pa.binary(), len(one), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(body)])
        values = [np.full(len(one), row["shard"], np.int64), found["h"][one], found["u"][one], low, high]
        return pa.table({n: pa.array(v, t) for n, v, t in zip(names, [*values, body], kinds)})

    return emit


DECISIONS = "shard long, h long, u long, least long, gone binary"


def _decide(table: pa.Table) -> pa.Table:
    """One group of minimizers: for each passage of each shard its smallest document, and the windows
    (offsets) that this document loses too; only where a document of the shard loses something.

    Equal windows have one minimizer, so that a minimizer with one passage, or
    one document, needs no suffix array.
    """
    h, u, low, high = (table.column(c).to_numpy() for c in ("h", "u", "low", "high"))
    order = np.lexsort((u, h))
    h, u, low, high = (x[order] for x in (h, u, low, high))
    new = np.append(True, h[1:] != h[:-1])
    first = new.copy()
    first[1:] |= u[1:] != u[:-1]
    at, kind = np.flatnonzero(first), np.cumsum(first) - 1
    least = np.minimum.reduceat(low, at)
    by_h = np.flatnonzero(new)
    alone = np.minimum.reduceat(low, by_h) == np.maximum.reduceat(high, by_h)
    several = (np.add.reduceat(first.astype(np.int64), by_h) > 1) & ~alone
    asked = np.flatnonzero(several[np.cumsum(new) - 1][at])  # passages for the suffix array
    gone: dict[int, bytes] = {}
    if len(asked):
        body = table.column("body").combine_chunks().cast(pa.large_binary())
        cuts = np.frombuffer(body.buffers()[1], np.int64)[body.offset : body.offset + len(body) + 1]
        rows = order[at[asked]]
        data, offsets = gathered(np.frombuffer(body.buffers()[2], np.uint8), cuts[rows], cuts[rows + 1] - cuts[rows], room=1)
        starts, ends = offsets[:-1], offsets[1:] - 1
        minima = window_minima(data, starts, ends, least[asked])
        place = np.flatnonzero(minima < np.repeat(least[asked], offsets[1:] - starts))
        of = np.searchsorted(ends, place)
        off = (place - starts[of]).astype(np.int32)
        some, begin = np.unique(of, return_index=True)
        for k, a, b in zip(asked[some].tolist(), begin.tolist(), [*begin[1:].tolist(), len(of)]):
            gone[k] = off[a:b].tobytes()
    loses = np.zeros(len(at), dtype=bool)
    loses[list(gone)] = True
    rows = np.flatnonzero((high > least[kind]) | ((low == least[kind]) & loses[kind]))
    kind = kind[rows]
    return pa.table(
        {
            "shard": pa.array(table.column("shard").to_numpy()[order[rows]]),
            "h": pa.array(h[rows]),
            "u": pa.array(u[rows]),
            "least": pa.array(least[kind]),
            "gone": pa.array([gone.get(k, b"") for k in kind.tolist()], pa.binary()),
        }
    )


def _hot_decisions(rows: DataFrame) -> DataFrame:
    """The same for minimizers of very many passages: each window of a passage is a row, and the
    smallest document of equal ones is taken before and after the shuffle."""
    rows = written(rows, "suffix-hot-passages")
    one = rows.groupBy("h", "u").agg(F.min("low").alias("least"), F.max("high").alias("most"), F.min("body").alias("body"))
    at = F.posexplode(F.expr(f"transform(sequence(1, length(body) - {SPAN - 1}), i -> substring(body, i, {SPAN}))")).alias("off", "w")
    windows = one.select("h", "u", "least", "most", at)
    keyed = written(windows.withColumns({"w1": F.xxhash64("w"), "w2": F.xxhash64("w", F.lit("second"))}).drop("w"), "suffix-hot-windows")
    least = keyed.groupBy("w1", "w2").agg(F.min("least").alias("first"))
    lost = F.collect_list(F.when(F.col("first") < F.col("least"), F.col("off")))
    told = keyed.join(least, ["w1", "w2"]).groupBy("h", "u", "least", "most").agg(lost.alias("offs"))
    told = told.where((F.col("least") < F.col("most")) | (F.size("offs") > 0))
    # offsets as little-endian integers
    digits = "lpad(hex(x & 255), 2, '0') || lpad(hex(shiftright(x, 8) & 255), 2, '0') || '0000'"
    gone = F.expr(f"unhex(array_join(transform(offs, x -> {digits}), ''))")
    loses = (F.col("high") > F.col("least")) | ((F.col("low") == F.col("least")) & (F.size("offs") > 0))
    return rows.drop("body").join(told, ["h", "u"]).where(loses).select("shard", "h", "u", "least", gone.alias("gone"))


def decisions(packs: DataFrame) -> DataFrame:
    """``shard, h, u, least, gone`` of the passages that some document of the shard loses."""
    shared = shared_minimizers(packs)
    size, n_hot = shared.select(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.sum("n_hot"), F.lit(0))).first()
    by_shard = packs.groupBy("shard").cogroup(shared.groupBy("shard"))
    groups = max(int(packs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size * (SPAN + 20) // GROUP))
    cold = by_shard.applyInArrow(_passages_of("hashes"), PASSAGES)
    found = cold.groupBy(F.pmod("h", F.lit(groups)).alias("group")).applyInArrow(_decide, DECISIONS)
    if n_hot:  # a count over the written table; no minimizer is dropped either way
        found = found.unionByName(_hot_decisions(by_shard.applyInArrow(_passages_of("hot"), PASSAGES)))
    return found


RESULT = "doc long, h1 long, h2 long, n_removed long, n_spans long, kept_sha256 string"


def _apply(left: pa.Table, right: pa.Table) -> pa.Table:
    """Marks a shard's bytes and digests what is left of its texts."""
    row = _only(left)
    names = [c.split()[0] for c in RESULT.split(", ")]
    kinds = [pa.int64()] * 5 + [pa.string()]
    if row is None:
        return pa.table({n: pa.array([], t) for n, t in zip(names, kinds)})
    data, offsets, docs = _shard(row)
    gone = np.zeros(len(data) + 1, dtype=np.int32)
    if right.num_rows:
        found = passages(data, offsets)
        h, u, least = (right.column(c).to_numpy() for c in ("h", "u", "least"))
        order = np.argsort(u, kind="stable")
        h, u, least = h[order], u[order], least[order]
        at = np.searchsorted(u, found["u"])
        hit = np.zeros(len(at), dtype=bool)
        while True:  # past entries that share one of the two hashes
            here = np.minimum(at, len(u) - 1)
            same = (at < len(u)) & (u[here] == found["u"])
            equal = same & (h[here] == found["h"])
            hit |= equal
            if not (same & ~equal).any():
                break
            at = at + (same & ~equal)
        rows = np.flatnonzero(hit)
        at = at[rows]
        later = docs[found["doc"][rows]] > least[at]
        start, stop = found["start"][rows], found["stop"][rows]
        np.add.at(gone, start[later], 1)
        np.add.at(gone, stop[later] + SPAN - 1, -1)
        column = right.column("gone")
        for r, k in zip(rows[~later].tolist(), at[~later].tolist()):
            off = np.frombuffer(column[int(order[k])].as_py(), np.int32) + found["start"][r]
            np.add.at(gone, off, 1)
            np.add.at(gone, off + SPAN, -1)
    mask = np.cumsum(gone[:-1]) > 0
    starts, ends = offsets[:-1], offsets[1:]
    rise = mask.copy()
    rise[1:] &= ~mask[:-1]
    rise[starts] = mask[starts]
    total = np.concatenate([[0], np.cumsum(mask)])
    spans = np.concatenate([[0], np.cumsum(rise)])
    removed = total[ends] - total[starts]
    view = memoryview(data)
    sha = [
        hashlib.sha256(data[a:b][~mask[a:b]].tobytes() if k else view[a:b]).hexdigest()
        for a, b, k in zip(starts.tolist(), ends.tolist(), removed.tolist())
    ]
    h1, h2 = (np.frombuffer(row[c], np.int64)[_kept(row)] for c in ("h1", "h2"))
    values = [docs, h1, h2, removed, spans[ends] - spans[starts], sha]
    return pa.table({n: pa.array(v, t) for n, v, t in zip(names, values, kinds)})


def suffix_dedup(documents: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row of ``documents``."""
    packs = shards(documents)
    told = decisions(packs)
    results = packs.groupBy("shard").cogroup(told.groupBy("shard")).applyInArrow(_apply, RESULT)
    results = results.dropDuplicates(["doc", "h1", "h2"])
    short = F.when(F.col("n_bytes") < SPAN, F.sha2(F.col("text").cast("binary"), 256))
    rows = _keyed(documents).select("doc_id", "doc", "h1", "h2", "n_bytes", short.alias("short_sha"))
    joined = rows.join(results, ["doc", "h1", "h2"], "left")
    copy = F.col("short_sha").isNull()  # a copy of a smaller document's text goes as a whole
    return joined.select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", F.when(copy, F.col("n_bytes")).otherwise(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.when(copy, 1).otherwise(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", "short_sha", F.lit(EMPTY_SHA)).alias("kept_sha256"),
    )


def query(documents: DataFrame) -> DataFrame:
    return suffix_dedup(documents.select("doc_id", "text"))
