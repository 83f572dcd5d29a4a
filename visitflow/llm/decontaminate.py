"""Benchmark decontamination (DataFrame operations only).

Every benchmark item gets a 64-bit SimHash of its words.  Windows of an item's
size are laid over the documents, each is fingerprinted the same way, and a
multi-index finds the items of that size within ``RADIUS`` bits: with
``BLOCKS`` blocks, two fingerprints within the radius agree in some block up to
``RADIUS // BLOCKS`` bits, so an index of each item block and its neighbours
misses none.  Candidates are then verified by exact weighted Jaccard similarity
of the five-word shingles (weight: number of occurrences).

Only windows that can reach the similarity are laid out: those at any position
that hold as many shingles of items of their size as the similarity needs.  The
sentences of a passage may stand in another order than in the item.  Of equally
similar windows, one that a shared shingle aligns with the item is reported,
then the first.

The item tables are broadcast only up to ``BROADCAST_ROWS`` rows, counted
first; a larger benchmark is joined by shuffle.

Words are runs of letters and digits in lower case.  Defined results: a null or
empty text contains nothing; an item that is null or has fewer than five words
is too weak as evidence and never matches; a document shorter than an item is
compared as a whole; repeated items are each reported; rows equal in id are one
document in the result; an empty table on either side gives an empty result;
other columns are ignored (:func:`decontaminated` passes them through).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitflow.llm.common import let, text_or_empty, written

SHINGLE = 5
PERCENT = 75
BLOCKS = 8
BITS = 8  # of a block
RADIUS = 23
BROADCAST_ROWS = 500_000
_EMPTY = "array<string>"


def plain_words(text: Column) -> Column:
    spaced = F.btrim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    return F.when(spaced == "", F.array().cast(_EMPTY)).otherwise(F.split(spaced, " "))


def shingles(word_list: Column) -> Column:
    """64-bit hashes of the five-word shingles in order; empty below five words."""

    def of(w: Column) -> Column:
        two = F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1)))
        return let(
            two,
            lambda t: F.slice(
                F.transform(t, lambda x, i: F.xxhash64(x, F.get(t, i + 2), F.get(w, i + 4))), 1, F.size(w) - (SHINGLE - 1)
            ),
        )

    return F.when(F.size(word_list) < SHINGLE, F.array().cast("array<long>")).otherwise(let(word_list, of))


def occurrences(hashes: Column) -> Column:
    """The multiset as a set: each hash with the number of its occurrence."""

    def numbered(s: Column) -> Column:
        return F.transform(s, lambda x, i: F.xxhash64(x, i - F.array_position(s, x)))

    return let(F.sort_array(hashes), numbered)


def simhash(word_list: Column) -> Column:
    """Bit b is set if more than half of the word hashes have it set."""

    def bits(h: Column) -> Column:
        def bit(b: Column) -> Column:
            ones = F.aggregate(h, F.lit(0), lambda a, x: a + F.call_function("getbit", x, b).cast("int"))
            return F.when(2 * ones > F.size(h), F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(
                F.lit(0).cast("long")
            )

        set_bits = F.transform(F.sequence(F.lit(0), F.lit(63)), bit)
        return F.aggregate(set_bits, F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x))

    return let(F.transform(word_list, lambda w: F.xxhash64(w)), bits)


def _block(fingerprint: Column, block: Column) -> Column:
    return F.call_function("shiftrightunsigned", fingerprint, block * BITS).bitwiseAND(F.lit(2**BITS - 1).cast("long"))


def _neighbours() -> list[int]:
    near = RADIUS // BLOCKS
    return [m for m in range(2**BITS) if bin(m).count("1") <= near]


def _guarded(df: DataFrame) -> DataFrame:
    """``df`` (a written table) with a broadcast hint if its counted rows are under the bound."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def prepared_items(benchmark: DataFrame) -> DataFrame:
    words = benchmark.select("item_id", plain_words(text_or_empty()).alias("w")).where(F.size("w") >= SHINGLE)
    return written(
        words.select("item_id", F.size("w").alias("size"), shingles(F.col("w")).alias("s"), simhash(F.col("w")).alias("print")),
        "bench-items",
    )


def windows(documents: DataFrame, items: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id, th, at``: the item-sized windows (start, size, aligned) that can reach the similarity.

    A window of ``width`` shingles needs ``need`` of an item.  It holds that many
    shared shingles if, for some i, it reaches from the i-th shared place or
    before to the place ``need - 1`` shared ones on.
    """
    aligned = written(
        items.select(F.posexplode("s").alias("at", "h"), "size").distinct(), "bench-shingles"
    )
    placed = documents.select(
        "doc_id", F.xxhash64(text_or_empty()).alias("th"), plain_words(text_or_empty()).alias("w")
    ).select("doc_id", "th", F.size("w").alias("n"), F.posexplode(shingles(F.col("w"))).alias("pos", "h"))
    last = F.greatest(F.col("n") - F.col("size"), F.lit(0))
    start = F.greatest(F.least(F.col("pos") - F.col("at"), last), F.lit(0)).alias("start")
    hits = placed.join(_guarded(aligned), "h").select("doc_id", "th", "n", "size", "pos", start)
    by_size = hits.groupBy("doc_id", "th", "n", "size").agg(
        F.sort_array(F.collect_set("pos")).alias("p"), F.collect_set("start").alias("fit")
    )
    width = F.least("n", "size") - (SHINGLE - 1)
    need = F.ceil(percent * (width + F.col("size") - (SHINGLE - 1)) / (100 + percent)).cast("int")
    by_size = by_size.select("*", width.alias("width"), need.alias("need"), last.alias("last")).where(F.size("p") >= F.col("need"))

    def around(i: Column) -> Column:
        low = F.greatest(F.get("p", i + F.col("need") - 1) - F.col("width") + 1, F.lit(0))
        high = F.least(F.get("p", i), F.col("last"))
        return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))

    starts = F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(0), F.size("p") - F.col("need")), around)))
    laid = F.transform(
        starts, lambda x: F.struct(x.alias("start"), F.col("size").alias("size"), F.array_contains("fit", x).alias("aligned"))
    )
    return by_size.select("doc_id", "th", laid.alias("at")).groupBy("doc_id", "th").agg(F.flatten(F.collect_list("at")).alias("at"))


def contaminated(documents: DataFrame, benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id, th, item_id, similarity, start_word, n_words``: the best window of each document and item.

    ``th`` is the hash of the document's text.
    """
    items = prepared_items(benchmark)
    laid = written(windows(documents, items, percent), "bench-windows")
    laid = laid.select(F.col("doc_id").alias("w_doc"), F.col("th").alias("w_th"), "at")
    texts = documents.select("doc_id", text_or_empty().alias("text")).withColumn("th", F.xxhash64("text"))
    found = texts.join(laid.hint("merge"), F.col("doc_id").eqNullSafe(F.col("w_doc")) & (F.col("th") == F.col("w_th")))
    found = found.dropDuplicates(["doc_id", "th"]).select(
        "doc_id", "th", plain_words(F.col("text")).alias("w"), F.explode("at").alias("at")
    )
    found = found.select(
        "doc_id", "th", "at.start", "at.size", "at.aligned", F.slice("w", F.col("at.start") + 1, F.col("at.size")).alias("w")
    )
    prints = written(
        found.select(
            "doc_id", "th", "start", "size", "aligned", occurrences(shingles(F.col("w"))).alias("keys"), simhash(F.col("w")).alias("print")
        ),
        "bench-prints",
    )
    block = F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1))).alias("block")
    index = items.select("item_id", "size", "print", occurrences(F.col("s")).alias("item_keys"), block).select(
        "item_id",
        "size",
        F.col("print").alias("item_print"),
        "item_keys",
        "block",
        F.explode(F.array(*[F.lit(m).cast("long") for m in _neighbours()])).alias("flip"),
    )
    index = index.withColumn("value", _block(F.col("item_print"), F.col("block")).bitwiseXOR(F.col("flip")))
    index = written(index.drop("flip"), "bench-index")
    probes = prints.select("*", block).withColumn("value", _block(F.col("print"), F.col("block")))
    near = probes.join(_guarded(index), ["size", "block", "value"]).where(
        F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= RADIUS
    )
    shared = F.size(F.array_intersect("keys", "item_keys"))
    scored = near.withColumn("shared", shared).withColumn("all", F.size("keys") + F.size("item_keys") - F.col("shared"))
    scored = scored.where(100 * F.col("shared") >= percent * F.col("all"))
    best = F.max(F.struct((F.col("shared") / F.col("all")).alias("similarity"), "aligned", (-F.col("start")).alias("start"), "size"))
    return scored.groupBy("doc_id", "th", "item_id").agg(best.alias("b")).select(
        "doc_id", "th", "item_id", "b.similarity", (-F.col("b.start")).alias("start_word"), F.col("b.size").alias("n_words")
    )


def decontaminated(documents: DataFrame, benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``documents`` without the rows whose text contains a benchmark passage."""
    found = contaminated(documents, benchmark, percent).select(
        F.col("doc_id").alias("_c_doc"), F.col("th").alias("_c_th")
    )
    found = written(found.distinct(), "bench-found")
    same = F.col("doc_id").eqNullSafe(F.col("_c_doc")) & (F.xxhash64(text_or_empty()) == F.col("_c_th"))
    return documents.join(found.hint("merge"), same, "left_anti")


def query(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = contaminated(documents.select("doc_id", "text"), benchmark)
    best = F.max(F.struct("similarity", (-F.col("start_word")).alias("start"), "n_words")).alias("b")
    return found.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", "b.similarity", (-F.col("b.start")).alias("start_word"), "b.n_words"
    )


# Every window that holds a shared shingle against every item of its size, without fingerprints.
ORACLE = r"""
WITH i AS (
  SELECT item_id, w, len(w) AS size
  FROM (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM benchmark) WHERE len(w) >= 5),
ish AS (
  SELECT item_id, size, pos - 1 AS at, array_to_string(w[pos : pos + 4], ' ') AS g
  FROM (SELECT *, unnest(range(1, size - 3)) AS pos FROM i)),
d AS (
  SELECT doc_id, w, len(w) AS n
  FROM (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents) WHERE len(w) >= 5),
dsh AS (
  SELECT doc_id, n, pos - 1 AS pos, array_to_string(w[pos : pos + 4], ' ') AS g
  FROM (SELECT *, unnest(range(1, n - 3)) AS pos FROM d)),
fit AS (
  SELECT DISTINCT doc_id, size, greatest(least(dsh.pos - ish.at, n - size), 0) AS start, 1 AS aligned FROM dsh JOIN ish USING (g)),
hits AS (
  SELECT doc_id, n, size, pos, g FROM dsh JOIN (SELECT DISTINCT size, g FROM ish) USING (g)),
near AS (
  SELECT doc_id, size FROM hits GROUP BY doc_id, n, size HAVING 175 * count(*) >= 75 * (least(n, size) + size - 8)),
win AS (
  SELECT doc_id, n, size, g,
         unnest(range(greatest(pos - least(n, size) + 5, 0), least(pos, greatest(n - size, 0)) + 1)) AS start
  FROM hits SEMI JOIN near USING (doc_id, size)),
wsh AS (SELECT doc_id, n, size, start, g, count(*) AS c FROM win GROUP BY ALL),
ic AS (SELECT item_id, size, g, count(*) AS c FROM ish GROUP BY ALL),
k AS (
  SELECT w.doc_id, ic.item_id, w.size, w.start, sum(least(w.c, ic.c)) AS k, least(w.size, w.n) + w.size - 8 AS total
  FROM wsh w JOIN ic ON w.size = ic.size AND w.g = ic.g GROUP BY ALL),
hit AS (
  SELECT *, k::DOUBLE / (total - k)::DOUBLE AS similarity FROM k WHERE 100 * k >= 75 * (total - k))
SELECT doc_id, item_id, similarity, CAST(start AS INTEGER) AS start_word, CAST(size AS INTEGER) AS n_words
FROM hit LEFT JOIN fit USING (doc_id, size, start)
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, coalesce(aligned, 0) DESC, start) = 1
"""
