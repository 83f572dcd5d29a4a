"""Mixing sources to target weights (DataFrame operations only).

Words are summed per source, target shares are water-filled under a cap of
``max_rate`` times the source's own size, and each document is emitted
``floor(rate)`` times plus one more time with probability ``rate - floor``,
decided by a hash of its id.

Defined results: a null text has size 0; a null source is a source of its own,
weighed last; repeated rows are mixed one by one (equal ids draw equally); a
source without words has target 0 and its documents are not taken; an empty
table gives an empty result.  Columns other than ``doc_id``, ``text`` and
``source`` pass through; an input column named like one that the operator adds
is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitflow.llm.common import SPACE, SPACE_CHARS, written

CYCLE = (1, 2, 3)
MAX_RATE = 3
SEED = "mix-1"
ADDED = ("size", "source_size", "target", "rate", "copies")


def word_count(text: Column) -> Column:
    """Number of words, from the spaces that end them: one pass, no word array."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.regexp_count(trimmed, F.lit(SPACE + "+")) + 1).cast("long")


def source_targets(sizes: DataFrame, cycle=CYCLE, max_rate: int = MAX_RATE) -> DataFrame:
    """One row per source: ``source, source_size, target, rate``.

    ``sizes`` has ``source, size``.  With sources sorted by cap / weight, the
    capped ones are a prefix; the level of the rest follows from running sums.
    The windows here run over one row per source, never over documents.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = Window.orderBy(F.col("source").isNull(), F.col("source"))
    per = per.select(
        "source",
        "source_size",
        F.element_at(
            F.array(*[F.lit(w) for w in cycle]), (F.row_number().over(everything) - 1) % len(cycle) + 1
        ).alias("weight"),
        (F.lit(max_rate) * F.col("source_size")).alias("cap"),
    )
    rising = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    rest = rising.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    per = per.withColumn("level", left / F.sum("weight").over(rest))
    # The first source, in this order, whose share at its level is within its cap sets the level.
    per = per.withColumn("level", F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), F.col("level").alias("level")))).over(whole)["level"])
    target = F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight"))
    return per.select(
        "source",
        "source_size",
        target.alias("target"),
        F.when(F.col("source_size") > 0, F.least(F.lit(float(max_rate)), target / F.col("source_size"))).otherwise(0.0).alias("rate"),
    )


def draw(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) that depends on the seed and the id alone, or without an id on the text."""
    of_text = F.concat(F.lit("null:"), F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), of_text)))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / F.lit(float(16**12))


def mixing_plan(documents: DataFrame, cycle=CYCLE, max_rate: int = MAX_RATE, seed: str = SEED) -> DataFrame:
    """``documents`` with ``size, source_size, target, rate, copies``.

    The per-source table is written to the shared folder: the planner
    broadcasts it only if its measured size is under the threshold, else it
    shuffles both sides and splits a hot source.
    """
    sized = documents.drop(*ADDED).withColumn("size", word_count(F.col("text")))
    targets = written(source_targets(sized.select("source", "size"), cycle, max_rate), "mix-targets")
    targets = targets.withColumnRenamed("source", "_mix_source")
    joined = sized.join(targets, F.col("source").eqNullSafe(F.col("_mix_source")), "left").drop("_mix_source")
    whole = F.floor("rate")
    extra = (draw(F.col("doc_id"), F.col("text"), seed) < F.col("rate") - whole).cast("long")
    return joined.withColumn("copies", whole + extra)


def mix(documents: DataFrame, cycle=CYCLE, max_rate: int = MAX_RATE, seed: str = SEED) -> DataFrame:
    """The mixed corpus: every document repeated ``copies`` times, in the columns of ``documents``."""
    plan = mixing_plan(documents, cycle, max_rate, seed).where("copies > 0")
    copied = plan.withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return copied.select(*documents.columns)


def query(documents: DataFrame) -> DataFrame:
    return mixing_plan(documents.select("doc_id", "text", "source")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, text, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
per AS (
  SELECT source, sum(size) AS source_size,
         1 + (row_number() OVER (ORDER BY source IS NULL, source COLLATE "C") - 1) % 3 AS weight
  FROM sized GROUP BY source),
lev AS (
  SELECT *, 3 * source_size AS cap,
         (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
         / (sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM per WINDOW o AS (ORDER BY (3 * source_size)::DOUBLE / weight::DOUBLE, source IS NULL, source)),
chosen AS (
  SELECT arg_min(level, cap::DOUBLE / weight::DOUBLE) AS level FROM lev WHERE level * weight <= cap),
tgt AS (
  SELECT lev.source, lev.source_size, least(cap::DOUBLE, chosen.level * weight) AS target
  FROM lev, chosen),
r AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(3.0::DOUBLE, target / source_size::DOUBLE) ELSE 0 END AS rate FROM tgt),
d AS (
  SELECT s.doc_id, s.size, r.source_size, r.target, r.rate,
         ('0x' || substr(md5('mix-1:' || coalesce(CAST(s.doc_id AS VARCHAR), 'null:' || md5(coalesce(s.text, '')))), 1, 12))::BIGINT::DOUBLE / 281474976710656.0::DOUBLE AS draw
  FROM sized s JOIN r ON s.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target,
       CAST(size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM d
"""
