"""Quality rules: a threshold table compiled into one projection.

All counts come from built-in expressions over the row itself: no user
function, no shuffle.  Repeated 8-word windows are found from the sorted
window hashes (64 bit) of the text, so the work is n log n in its words.

Defined results: a null or empty text has no words, so it fails; repeated rows
are judged one by one; an empty table gives an empty result; other columns
pass through, and one named like an added column is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitflow.llm.common import NOT_SPACE, let, text_or_empty, words

WINDOW = 8
SYMBOLS = "#*$%&|<>"
# Frequent function words of the corpus languages, counted in lower case.
STOP_WORDS = tuple(
    "the and of to in is that it for on with as are was be this by from or an a "
    "der die das und ist nicht mit den von zu ein eine im dem des sich auf für auch als "
    "le la les et de des un une est que pour dans qui sur par pas avec elle du au "
    "el los las en del por con para se una no su lo al es como".split()
)

# (name, metric, lower bound, upper bound): a document is kept when every
# metric lies within its bounds; None leaves a side open.  Bounds are loose:
# only text that no prose comes near is rejected.
RULES: tuple[tuple[str, str, float | None, float | None], ...] = (
    ("mean word length", "mean_word", 1.5, 25.0),
    ("symbols per word", "symbol_ratio", None, 0.2),
    ("stop words per word", "stop_ratio", 0.01, None),
    ("repeated lines per line", "dup_line_ratio", None, 0.5),
)
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
ADDED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def _window_hashes(word_list: Column) -> Column:
    """64-bit hashes of the 8-word windows, doubling the window three times."""

    def doubled(hashes: Column, gap: int) -> Column:
        return F.transform(hashes, lambda x, i: F.xxhash64(x, F.get(hashes, i + gap)))

    return let(
        doubled(word_list, 1),
        lambda a: let(doubled(a, 2), lambda b: F.slice(doubled(b, 4), 1, F.size(b) - (WINDOW - 1))),
    )


def _covered(hashes: Column) -> Column:
    """Words in windows whose hash occurs twice or more: sort, compare neighbours, add up."""
    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def repeated(p: Column) -> Column:
        return F.filter(
            p,
            lambda x, i: ((i > 0) & (F.get(p, i - 1)["h"] == x["h"]))
            | ((i < F.size(p) - 1) & (F.get(p, i + 1)["h"] == x["h"])),
        )

    def added(starts: Column) -> Column:
        new = F.transform(
            starts, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, i + 1) - x, F.lit(WINDOW)))
        )
        return F.aggregate(new, F.lit(0).cast("long"), lambda a, x: a + x)

    return let(F.sort_array(F.transform(let(pairs, repeated), lambda x: x["i"])), added)


def _repeat_words(word_list: Column) -> Column:
    none = F.lit(0).cast("long")

    def counted(w: Column) -> Column:
        return let(
            _window_hashes(w), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), none).otherwise(_covered(h))
        )

    return F.when(F.size(word_list) <= WINDOW, none).otherwise(let(word_list, counted))


def metrics(text: Column, word_list: Column) -> dict[str, Column]:
    symbols = "[" + SYMBOLS + "]"
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(NOT_SPACE))
    return {
        "n_words": F.size(word_list).cast("long"),
        "word_chars": F.char_length(F.array_join(word_list, "")).cast("long"),
        "n_symbols": F.when(text.rlike(symbols), F.regexp_count(text, F.lit(symbols))).otherwise(0).cast("long"),
        "_q_lines": F.size(lines).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "_q_stop": F.size(F.filter(word_list, lambda w: w.isin(*STOP_WORDS))).cast("long"),
        "n_repeat_words": _repeat_words(word_list),
    }


def quality_rules(documents: DataFrame, rules=RULES) -> DataFrame:
    """``documents`` with the counts, ``base_failed`` and ``kept``.

    A base failure (fewer than ``MIN_WORDS`` words, or more than
    ``MAX_REPEAT_PERCENT`` percent of the words in repeated windows) is never
    kept; other documents follow the rule table.
    """
    text = text_or_empty()
    counted = documents.drop(*ADDED).withColumn("_q_words", words(text))
    counted = counted.withColumns(metrics(text, F.col("_q_words"))).drop("_q_words")
    per_word = F.greatest(F.col("n_words"), F.lit(1))
    values = {
        "mean_word": F.col("word_chars") / per_word,
        "symbol_ratio": F.col("n_symbols") / per_word,
        "stop_ratio": F.col("_q_stop") / per_word,
        "dup_line_ratio": F.col("n_dup_lines") / F.greatest(F.col("_q_lines"), F.lit(1)),
    }
    passed = F.lit(True)
    for _, metric, low, high in rules:
        if low is not None:
            passed = passed & (values[metric] >= low)
        if high is not None:
            passed = passed & (values[metric] <= high)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return counted.withColumns({"base_failed": failed, "kept": ~failed & passed}).drop("_q_lines", "_q_stop")


def query(documents: DataFrame) -> DataFrame:
    return quality_rules(documents.select("doc_id", "text")).drop("text")


def oracle(rules=RULES) -> str:
    """DuckDB SQL for :func:`query`: counts by joins and groups instead of arrays."""
    words = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
    stop = ", ".join("'" + w + "'" for w in dict.fromkeys(STOP_WORDS))
    sides = []
    for _, metric, low, high in rules:
        sides += [f"{metric} >= {low}"] * (low is not None) + [f"{metric} <= {high}"] * (high is not None)
    return rf"""
WITH t AS (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS text, {words} AS w FROM documents),
win AS (
  SELECT id, pos, array_to_string(w[pos : pos + {WINDOW - 1}], ' ') AS win
  FROM (SELECT id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS pos FROM t WHERE len(w) >= {WINDOW})),
rep AS (
  SELECT id, pos FROM (SELECT id, pos, count(*) OVER (PARTITION BY id, win) AS n FROM win) WHERE n > 1),
cov AS (
  SELECT id, sum(least({WINDOW}, coalesce(nxt - pos, {WINDOW}))) AS n_repeat
  FROM (SELECT id, pos, lead(pos) OVER (PARTITION BY id ORDER BY pos) AS nxt FROM rep) GROUP BY id),
ln AS (
  SELECT id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup
  FROM (SELECT id, unnest(string_split(text, chr(10))) AS line FROM t)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY id),
c AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         len(regexp_extract_all(text, '[{SYMBOLS}]')) AS n_symbols, coalesce(n_dup, 0) AS n_dup_lines,
         coalesce(n_lines, 0) AS n_lines, coalesce(n_repeat, 0) AS n_repeat_words,
         len(list_filter(w, lambda x: x IN ({stop}))) AS n_stop
  FROM t LEFT JOIN cov USING (id) LEFT JOIN ln USING (id)),
m AS (
  SELECT *, word_chars / greatest(n_words, 1)::DOUBLE AS mean_word, n_symbols / greatest(n_words, 1)::DOUBLE AS symbol_ratio,
         n_stop / greatest(n_words, 1)::DOUBLE AS stop_ratio, n_dup_lines / greatest(n_lines, 1)::DOUBLE AS dup_line_ratio,
         n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed
  FROM c)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND {" AND ".join(sides)} AS kept
FROM m
"""
