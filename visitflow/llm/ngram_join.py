"""N-gram Jaccard join: a size-aware heavy-light join over word-shingle sets.

Two documents link when ``100 * |A & B| >= percent * |A | B|``.  Under one
global order of the shingles (rare first), linked sets share one shingle among
the first ``p = n - ceil(percent * n / 100) + 1`` of each, and two among the
first ``p + 1``.  Large sets are posted once under each of their first ``p``
shingles (inverted lists); small sets once under each two-element subset of
their first ``p + 1``; sets near the boundary under both.  The boundary is
chosen by cost, from the measured lengths of the lists.

* Order: counted shingles by their number of documents, then uncounted ones by
  hash, then the heavy ones by hash.  Any fixed order gives the same links; this
  one keeps frequent passages out of the prefixes.  Shingles in one document only
  are dropped where they are counted.  A first pass counts the shingles with hash
  under ``FIRST_CUT`` and finds the documents that can have a partner; a second
  pass counts all shingles of those documents, so that the ones of their own
  bound what they can share with any other.
* Heavy shingles (in a share of ``HEAVY`` of all documents of a task, and of all
  tasks together) are at most ``mean set size / HEAVY`` many, so that list is
  small at any corpus size and is broadcast; their inverted lists are split over
  ``SALTS`` parts.
* Equal sets become one node first.  Only connectivity is wanted, so the
  members of a list are first compared with the list's smallest member; further
  rounds and the closing full round compare only members of one list that are
  still in different components.  No link between components is lost, and a
  group of near copies costs a few comparisons per member, not all pairs.

Candidates are verified on the whole texts.  Set hashes are 64 bit per shingle
and 128 bit per set.

Defined results: a document without words or text has an empty set and is its
own component; a null ``doc_id`` gets a null component and links nothing; rows
that repeat an id are one document, linked by any of its texts; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitflow.llm.common import shared_folder, text_or_empty, written
from visitflow.llm.components import components
from visitflow.llm.vector import BASE2, LOWER, chunks, mix, range_hash, shingle_sets, word_ranges

SIZE = 5
PERCENT = 75
FIRST_CUT = 1 / 3
HEAVY = 0.01
SALTS = 64
STAR_ROUNDS = 2
LONG_RUN = 1 << 20


def _limit(cut: float) -> int:
    """The hash value below which a share ``cut`` of all shingles lies."""
    return min(int(-(2**63) + cut * 2**64), 2**63 - 1)


def prefix_length(n, percent: int = PERCENT):
    return n + (-n * percent // 100) + 1


def _sets(column: pa.Array):
    """Row number and sorted distinct shingle hashes of each text of an Arrow column."""
    for row, offsets, data in chunks(column):
        lower = LOWER[data]
        starts, ends, first = word_ranges(lower, offsets)
        for i, found in enumerate(shingle_sets(range_hash(lower, starts, ends), first, SIZE)):
            yield row + i, found


# ------------------------------------------------------------------ sets


def _prints(found: np.ndarray) -> tuple[int, int]:
    """Two independent 64-bit hashes of a set."""
    one = mix(np.array([np.bitwise_xor.reduce(mix(found))]) + np.uint64(len(found)) + found.sum())
    two = mix(np.array([mix(found * np.uint64(BASE2)).sum()]))
    return int(one.view(np.int64)[0]), int(two.view(np.int64)[0])


class _Frequent:
    """Counts the shingles that are frequent among some hundreds of documents at a time."""

    def __init__(self):
        self.counts: Counter[int] = Counter()
        self.docs = self.open_docs = self.open_size = 0
        self.open: list[np.ndarray] = []

    def add(self, found: np.ndarray) -> None:
        self.open.append(found)
        self.open_docs += 1
        self.open_size += len(found)
        if self.open_size >= 500_000:
            self.close()

    def close(self) -> None:
        if self.open:
            values, times = np.unique(np.concatenate(self.open), return_counts=True)
            often = times >= max(2, HEAVY * self.open_docs / 2)
            self.counts.update(dict(zip(values[often].view(np.int64).tolist(), times[often].tolist())))
        self.docs += self.open_docs
        self.open, self.open_docs, self.open_size = [], 0, 0

    def heavy(self) -> list[tuple[int, int]]:
        self.close()
        return [(k, c) for k, c in self.counts.items() if c >= max(2, HEAVY * self.docs / 2)]


def _summaries(batches):
    """Per row: id, set size, set hashes.  At the end the task's heavy shingles (in f1, their count in n)."""
    frequent = _Frequent()
    names = ["heavy", "doc_id", "n", "f1", "f2"]
    for batch in batches:
        n, f1, f2 = (np.zeros(batch.num_rows, dtype=np.int64) for _ in range(3))
        for i, found in _sets(batch.column("text")):
            n[i] = len(found)
            if len(found):
                f1[i], f2[i] = _prints(found)
                frequent.add(found)
        no = pa.array(np.zeros(batch.num_rows, dtype=bool))
        yield pa.RecordBatch.from_arrays([no, batch.column("doc_id"), pa.array(n), pa.array(f1), pa.array(f2)], names)
    if heavy := frequent.heavy():
        nothing = pa.nulls(len(heavy), pa.int64())
        tokens, times = (pa.array(x, pa.int64()) for x in zip(*heavy))
        yes = pa.array(np.ones(len(heavy), dtype=bool))
        yield pa.RecordBatch.from_arrays([yes, nothing, times, tokens, nothing], names)


def shingle_summaries(documents: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """The table ``doc_id, n, f1, f2`` of all rows, and the heavy shingles."""
    table = written(_texts(documents).mapInArrow(_summaries, "heavy boolean, doc_id long, n long, f1 long, f2 long"), "shingle-sets")
    sets = table.where("not heavy").drop("heavy")
    least = max(2, int(HEAVY * sets.count()))
    heavy = table.where("heavy").groupBy("f1").agg(F.sum("n").alias("c")).where(F.col("c") >= least)
    # at most (mean set size / HEAVY) rows: each stands for a share HEAVY of all documents
    return sets, np.sort(np.array([r["f1"] for r in heavy.select("f1").collect()], dtype=np.int64))


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))


# -------------------------------------------------------------- postings

TOKENS = "token long, salt int, owner long, n int, m int"


def _emitter(heavy, limit: int, percent: int):
    """Per text the shingles that its prefix may hold: hash under the limit, or the first p + 1; heavy ones last.

    ``owner`` is the set's hash, ``n`` its size, ``m`` its plain shingles under the limit.
    """

    def emit(batches):
        hot = heavy.value
        names = ["token", "salt", "owner", "n", "m"]
        rows: list[list[np.ndarray]] = []
        held = 0

        def out():
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*rows)], names)

        for batch in batches:
            for _, found in _sets(batch.column("text")):
                if len(found) < 2:  # a set of one can only link to its equals
                    continue
                values = np.sort(found.view(np.int64))
                is_hot = hot[np.minimum(np.searchsorted(hot, values), len(hot) - 1)] == values if len(hot) else np.zeros(len(values), bool)
                plain, last = values[~is_hot], values[is_hot]
                need = prefix_length(len(values), percent) + 1
                under = int(np.searchsorted(plain, limit, side="right" if limit == 2**63 - 1 else "left"))
                plain = plain[: max(need, under)]
                last = last[: max(0, need - len(plain))]
                owner = _prints(found)[0]
                k = len(plain) + len(last)
                salt = np.zeros(k, dtype=np.int32)
                salt[len(plain) :] = 1 + owner % SALTS
                rows.append([np.concatenate([plain, last]), salt, np.full(k, owner), np.full(k, len(values), np.int32), np.full(k, under, np.int32)])
                held += k
                if held >= 100_000:
                    yield out()
                    rows, held = [], 0
        if rows:
            yield out()

    return emit


def _shared(batches):
    """Rows sorted by (token, salt, owner): drops repeats and plain tokens of one set only, adds the list length.

    Streams: only the last, unfinished list is held back; a list over
    ``LONG_RUN`` members passes on with that length.
    """
    held: pa.Table | None = None
    long_token = None

    def flush(table: pa.Table, final: bool):
        nonlocal held, long_token
        token, salt, owner = (table.column(c).to_numpy() for c in ("token", "salt", "owner"))
        new = np.ones(len(token), dtype=bool)
        new[1:] = (token[1:] != token[:-1]) | (salt[1:] != salt[:-1])
        starts = np.flatnonzero(new)
        first = new.copy()
        first[1:] |= owner[1:] != owner[:-1]
        count = np.add.reduceat(first.astype(np.int64), starts)
        if long_token == (token[0], salt[0]):
            count[0] = LONG_RUN
        cut = len(token)
        long_token = None
        if not final:
            if cut - starts[-1] >= LONG_RUN:
                count[-1], long_token = LONG_RUN, (token[-1], salt[-1])
            else:
                cut = starts[-1]
        held = table.slice(cut)
        count = np.repeat(np.minimum(count, LONG_RUN), np.diff(np.append(starts, len(token))))
        keep = first & ((count > 1) | (salt > 0))
        keep[cut:] = False
        out = table.append_column("count", pa.array(count)).filter(pa.array(keep))
        yield from out.to_batches(max_chunksize=200_000)

    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([held, table]) if held is not None and held.num_rows else table
        held = table
        if table.num_rows >= 100_000:
            yield from flush(table, False)
    if held is not None and held.num_rows:
        yield from flush(held, True)


def listed(texts: DataFrame, heavy: np.ndarray, cut: float, name: str, percent: int = PERCENT) -> DataFrame:
    """The shingles under the cut that two or more of the ``texts`` share, with their ``place`` in the order.

    ``place`` is the rank of the shingle in its set, for those beyond the cut and
    the heavy ones the lowest rank possible.
    """
    limit = _limit(cut)
    hot = texts.sparkSession.sparkContext.broadcast(heavy)
    rows = texts.select("text").mapInArrow(_emitter(hot, limit, percent), TOKENS)
    rows = rows.repartition("token", "salt").sortWithinPartitions("token", "salt", "owner")
    rows = rows.mapInArrow(_shared, TOKENS + ", count long")
    under = (F.col("salt") == 0) & (F.col("token") <= limit if cut >= 1 else F.col("token") < limit)
    part = F.when(under, 0).when(F.col("salt") == 0, 1).otherwise(2)
    of_part = Window.partitionBy("owner", part)
    rank = F.row_number().over(of_part.orderBy(F.when(under, F.col("count")).otherwise(0), "token"))
    single = F.col("m") - F.count("*").over(of_part)
    place = F.when(part == 0, single + rank).when(part == 1, F.col("m")).otherwise(F.col("m") + rank)
    return written(rows.withColumn("place", place.cast("int")), name)


def in_prefix(extra: int = 0, percent: int = PERCENT) -> Column:
    p = F.col("n") + F.floor(-F.col("n") * percent / 100) + 1
    return (F.col("place") <= p + extra) | (F.col("salt") > 0)


def boundary(rows: DataFrame, percent: int = PERCENT) -> int:
    """The largest set size for which posting two-element subsets costs no more than inverted lists.

    Subsets of a prefix of p + 1 cost p * (p + 1) / 2 rows; p list entries cost one
    row each and a comparison with each center or, in shorter lists, each
    member.
    """
    typical = rows.where("salt = 0").agg(F.percentile_approx("count", 0.5).alias("c")).collect()[0]["c"] or 0
    entry = 1 + min(typical, STAR_ROUNDS + 1)
    size = 0
    while (prefix_length(size + 1, percent) + 1) / 2 <= entry:
        size += 1
    return size


def postings(texts: DataFrame, nodes: DataFrame, heavy: np.ndarray, percent: int = PERCENT) -> DataFrame:
    """``key, salt, node, n, place`` of the ``texts``, with all their shingles counted among them."""
    rows = listed(texts, heavy, 1.0, "shingle-lists", percent)
    small = boundary(rows, percent)
    single = rows.where((100 * F.col("n") >= percent * (small + 1)) & in_prefix(0, percent)).select(
        "owner", F.col("token").alias("key"), "salt", "n", "place"
    )
    chosen = rows.where((F.col("n") <= small) & in_prefix(1, percent))
    first = chosen.groupBy("owner", "n").agg(F.sort_array(F.collect_set(F.struct("token", "salt"))).alias("t"))
    pairs = F.flatten(
        F.transform(
            "t",
            lambda x, i: F.transform(
                F.slice("t", i + 2, F.size("t")),
                lambda y: F.struct(
                    F.xxhash64(x["token"], y["token"]).alias("key"), F.greatest(x["salt"], y["salt"]).alias("salt")
                ),
            ),
        )
    )
    subset = first.select("owner", "n", F.explode(pairs).alias("k")).select(
        "owner", "k.key", "k.salt", "n", F.lit(1).alias("place")
    )
    keys = single.unionByName(subset)
    return written(keys.join(nodes, "owner").select("key", "salt", "node", "n", "place"), "shingle-postings")


# ------------------------------------------------------------ candidates


def _possible(n1, n2, place1, place2, percent: int):
    """Whether sets of these sizes that first meet at these places can still reach the similarity (numpy)."""
    n1, n2 = n1.astype(np.int64), n2.astype(np.int64)
    alike = 100 * np.minimum(n1, n2) >= percent * np.maximum(n1, n2)
    most = 1 + np.minimum(n1 - place1, n2 - place2)
    return alike & ((100 + percent) * most >= percent * (n1 + n2))


def _lists(batches):
    """The lists of a partition sorted by key, each as arrays; the last one is held back until it ends."""
    held: pa.Table | None = None

    def split(table: pa.Table, final: bool):
        nonlocal held
        part = {c: table.column(c).to_numpy() for c in table.column_names}
        new = np.ones(table.num_rows, dtype=bool)
        new[1:] = part["key"][1:] != part["key"][:-1]
        bounds = np.append(np.flatnonzero(new), table.num_rows)
        held = table.slice(bounds[-2]) if not final else None
        for a, b in zip(bounds[: len(bounds) - 1 - (not final)].tolist(), bounds[1:].tolist()):
            if b - a > 1 and (part["comp"][a:b] != part["comp"][a]).any():
                yield {c: v[a:b] for c, v in part.items()}

    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = pa.concat_tables([held, table]).combine_chunks() if held is not None else table
        if held.num_rows >= 50_000:
            yield from split(held, False)
    if held is not None and held.num_rows:
        yield from split(held, True)


def _pair_batch(a: list[np.ndarray], b: list[np.ndarray]) -> pa.RecordBatch:
    a, b = np.concatenate(a), np.concatenate(b)
    pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pairs[:, i])) for i in (0, 1)], ["a", "b"])


def _star(percent: int):
    """Each member of a list with the list's first row (its center), if in another component."""

    def star(batches):
        a, b, held = [], [], 0
        for x in _lists(batches):
            ok = (x["comp"] != x["comp"][0]) & _possible(x["n"], x["n"][0], x["place"], x["place"][0], percent)
            a.append(x["node"][ok])
            b.append(np.full(int(ok.sum()), x["node"][0]))
            held += len(a[-1])
            if held >= 200_000:
                yield _pair_batch(a, b)
                a, b, held = [], [], 0
        if held:
            yield _pair_batch(a, b)

    return star


def _rest(percent: int):
    """All pairs of a list's members that are in different components and can reach the similarity."""

    def rest(batches):
        a, b, held = [], [], 0
        for x in _lists(batches):
            for i in range(len(x["node"]) - 1):
                y = slice(i + 1, None)
                ok = (x["comp"][y] != x["comp"][i]) & _possible(x["n"][y], x["n"][i], x["place"][y], x["place"][i], percent)
                a.append(x["node"][y][ok])
                b.append(np.full(int(ok.sum()), x["node"][i]))
                held += len(a[-1])
                if held >= 200_000:
                    yield _pair_batch(a, b)
                    a, b, held = [], [], 0
        if held:
            yield _pair_batch(a, b)

    return rest


def _rank(turn: int) -> Column:
    """Sort key of the center of a list: first the member with the fewest rare shingles, in later rounds others by hash.

    The original of a group of near copies has none of the copies' own shingles,
    so it comes first.
    """
    chance = F.xxhash64("node", F.lit(turn))
    return F.struct(F.col("place"), chance) if turn == 0 else F.struct(chance)


def star_pairs(live: DataFrame, turn: int, percent: int = PERCENT) -> DataFrame:
    """Each list member with its list's center, where they are in different components and can link."""
    plain = live.where("salt = 0").repartition("key").sortWithinPartitions("key", _rank(turn))
    pairs = plain.mapInArrow(_star(percent), "a long, b long")
    # Heavy lists lie in parts; their centers are found with map-side combine, one row per heavy key.
    heavy = live.where("salt > 0")
    center = heavy.groupBy("key").agg(F.min_by(F.struct("node", "n", "place", "comp"), _rank(turn)).alias("c"))
    center = center.select("key", *[F.col(f"c.{c}").alias(f"o_{c}") for c in ("node", "n", "place", "comp")])
    return pairs.union(_joined(heavy, written(center, f"shingle-centers-{turn}"), percent))


def _joined(members: DataFrame, others: DataFrame, percent: int) -> DataFrame:
    """Pairs of a key's members and others (``o_...``) in different components that can link.

    Both sides are written tables, so that the planner measures them and can
    split the members of a hot key.
    """
    most = 1 + F.least(F.col("n") - F.col("place"), F.col("o_n") - F.col("o_place"))
    able = (
        (F.col("comp") != F.col("o_comp"))
        & (100 * F.least("n", "o_n") >= percent * F.greatest("n", "o_n"))
        & ((100 + percent) * most >= percent * (F.col("n") + F.col("o_n")))
    )
    both = members.join(others.withColumnRenamed("key", "o_key"), (F.col("key") == F.col("o_key")) & able)
    return both.select(F.least("node", "o_node").alias("a"), F.greatest("node", "o_node").alias("b"))


def rest_pairs(live: DataFrame, percent: int = PERCENT) -> DataFrame:
    """All pairs of a list's members in different components that can link.

    In a heavy list most members are in one component; the others are joined
    with all members.
    """
    plain = live.where("salt = 0").repartition("key").sortWithinPartitions("key", "node")
    heavy = live.where("salt > 0")
    by_comp = heavy.groupBy("key", "comp").agg(F.count("*").alias("size"))
    major = by_comp.groupBy("key").agg(F.max_by("comp", F.struct("size", "comp")).alias("major"))
    out = heavy.join(major.withColumnRenamed("key", "m_key"), F.col("key") == F.col("m_key")).where("comp <> major")
    out = out.select("key", *[F.col(c).alias(f"o_{c}") for c in ("node", "n", "place", "comp")])
    return plain.mapInArrow(_rest(percent), "a long, b long").union(_joined(heavy, written(out, "shingle-outside"), percent))


# ---------------------------------------------------------- verification


def _verifier(percent: int):
    def verify(batches):
        for batch in batches:
            right = dict(_sets(batch.column("text_b")))
            linked = np.zeros(batch.num_rows, dtype=bool)
            for i, x in _sets(batch.column("text_a")):
                y = right.pop(i)
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked[i] = both > 0 and 100 * both >= percent * (len(x) + len(y) - both)
            yield batch.select(["a", "b"]).filter(pa.array(linked))

    return verify


def verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs whose whole texts reach the similarity."""
    one = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    two = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    return pairs.hint("merge").join(one, "a").hint("merge").join(two, "b").select("a", "b", "text_a", "text_b").mapInArrow(_verifier(percent), "a long, b long").distinct()


def _still_open(posted: DataFrame, labels: DataFrame) -> DataFrame:
    """The postings with their components, of the lists that hold more than one component."""
    now = posted.join(labels.withColumnRenamed("node", "l"), F.col("node") == F.col("l"), "left")
    now = written(now.select(*posted.columns, F.coalesce("label", "node").alias("comp")), "shingle-comps")
    span = now.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high")
    return now.join(span.select("key"), "key", "left_semi")


def links_of(posted: DataFrame, texts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links that connect whatever the full set of links connects.

    Star rounds with changing centers first; then, in the lists that still hold
    several components, every pair across components.
    """
    live = posted.withColumn("comp", F.col("node"))
    tested = links = None
    for turn in range(STAR_ROUNDS + 1):
        if turn < STAR_ROUNDS:
            pairs = star_pairs(live, turn, percent)
        else:
            pairs = rest_pairs(live, percent)
        pairs = pairs.distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = written(pairs, f"shingle-pairs-{turn}")
        found = written(verified(pairs, texts, percent), f"shingle-links-{turn}")
        tested = pairs if tested is None else tested.union(pairs)
        links = found if links is None else links.union(found)
        if turn < STAR_ROUNDS:
            live = written(_still_open(posted, components(links)), f"shingle-live-{turn}")
            if live.isEmpty():
                break
    return links


def jaccard_components(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per document row: ``doc_id, n_shingles, component_id`` (the smallest id that links reach)."""
    shared_folder(documents.sparkSession)
    sets, heavy = shingle_summaries(documents)
    named = sets.where("n > 0 and doc_id is not null")
    nodes = named.groupBy("f1", "f2").agg(F.min("doc_id").alias("node"))
    nodes = written(nodes.select(F.col("f1").alias("owner"), "node"), "shingle-nodes")
    whole = _texts(documents).where("doc_id is not null")
    # First pass: which documents have a shared shingle in their prefix at all, from a third of the shingles.
    first = listed(whole, heavy, FIRST_CUT, "shingle-first", percent).where(in_prefix(1, percent)).select("owner").distinct()
    able = first.join(nodes, "owner").select(F.col("node").alias("doc_id")).distinct()
    texts = written(whole.join(able.hint("merge"), "doc_id", "left_semi"), "shingle-texts")
    # Second pass: the lists of those documents, from all their shingles.
    links = links_of(postings(texts, nodes, heavy, percent), texts, percent)
    least = written(named.groupBy("f1", "f2").agg(F.min("doc_id").alias("rep")), "shingle-equal")
    placed = sets.join(least, ["f1", "f2"], "left").withColumn("rep", F.coalesce("rep", "doc_id"))
    # rows that repeat an id with other texts belong together
    several = placed.where("doc_id is not null").groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("z"), F.collect_set("rep").alias("b"))
    several = several.where("a <> z").select("a", F.explode("b").alias("b")).where("a <> b")
    labels = written(components(links.union(several)), "shingle-labels")
    rows = placed.join(labels, F.col("rep") == F.col("node"), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "rep"))
    return rows.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def deduplicated(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``documents`` with one document of each component: the one with the smallest id.

    Rows without an id stay; of rows that repeat an id all stay or go together.
    """
    gone = jaccard_components(documents, percent).where("component_id <> doc_id").select("doc_id").distinct()
    return documents.join(written(gone, "shingle-gone").hint("merge"), "doc_id", "left_anti").select(*documents.columns)


def query(documents: DataFrame) -> DataFrame:
    return jaccard_components(documents.select("doc_id", "text"))


# All pairs that share a shingle, then all that links reach: for small tables.
ORACLE = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[pos : pos + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS pos FROM t WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
l AS (
  SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (
  SELECT doc_id, doc_id AS reach FROM documents
  UNION
  SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.reach)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id
FROM documents d
LEFT JOIN n ON n.doc_id = d.doc_id
JOIN (SELECT doc_id, min(reach) AS component_id FROM r GROUP BY doc_id) m ON m.doc_id = d.doc_id
"""
