"""Secret scan with multipart credential linking (DataFrame operations only).

Base spans are regular-expression matches, reported as they are.  Weak
candidates (user or client names, service endpoints, bare base64-like tokens)
are common in clean text, so one is reported only if a complementary part
stands within ``scope`` code points: a secret for an identifier or endpoint, an
identifier or endpoint for a bare token.  Base matches take part as strong
identifiers (access) and secrets (assign, hex).  The linking is an interval
join in Spark, binned by document and scope cell.

Positions are code points, end exclusive.  Defined results: a null text is
empty; an empty text has no spans; repeated rows each get their spans; an empty
table gives an empty result; other columns pass through, and one named like an
added column is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitflow.llm.common import text_or_empty, written

# The base patterns, as (kind, pattern, group measured, least length, part class).
ASSIGN = r"""((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = (
    ("assign", ASSIGN, 2, 6, "secret"),
    ("access", r"AKIA[A-Z0-9]+", 0, 20, "identifier"),
    ("hex", r"[0-9a-f]+", 0, 24, "secret"),
)
# For the kinds measured as a whole, a bounded pattern finds the same spans
# without visiting every short match: their matches are whole character runs.
SEARCH = {"access": r"AKIA[A-Z0-9]{16,}", "hex": r"[0-9a-f]{24,}"}
WEAK = (
    (
        "identifier",
        r"""(?i:access_?key_?id|client_?id|account_?id|user_?name|user|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}""",
        "identifier",
    ),
    ("endpoint", r"""(?i:https?|ftp|s3|jdbc|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\s"'<>]+""", "endpoint"),
    ("token", r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{32,}={0,2}", "secret"),
)
SCOPE = 256
MARK = "\x01"
ADDED = ("n_assign", "n_access", "n_hex", "base_sha256", "spans")
ORDER = {name: i for i, name in enumerate([b[0] for b in BASE] + [w[0] for w in WEAK])}
SPAN = "array<struct<start:int,end:int>>"


def find_spans(text: Column, pattern: str, full: str, group: int, least: int) -> Column:
    """Start and end of each leftmost, non-overlapping match of ``pattern``.

    The matches are bracketed by a control character (first replaced in the
    text by another), and the running lengths of the pieces give the places.
    """
    marked = F.regexp_replace(F.translate(text, MARK, "\x02"), pattern, MARK + "$0" + MARK)
    start = F.struct(
        F.lit(0).alias("at"), F.lit(False).alias("match"), F.array().cast(SPAN).alias("found")
    )

    def step(acc: Column, piece: Column) -> Column:
        end = acc["at"] + F.char_length(piece)
        measured = piece if group == 0 else F.regexp_extract(piece, full, group)
        taken = acc["match"] & (F.char_length(measured) >= least)
        span = F.array(F.struct(acc["at"].alias("start"), end.alias("end")))
        return F.struct(
            end.alias("at"),
            (~acc["match"]).alias("match"),
            F.when(taken, F.concat(acc["found"], span)).otherwise(acc["found"]).alias("found"),
        )

    found = F.aggregate(F.split(marked, MARK, -1), start, step, lambda acc: acc["found"])
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(SPAN))


def _joined(parts: Column) -> Column:
    """``kind:start:end`` of structs (start, place, kind, end), in order."""
    return F.array_join(
        F.transform(
            F.sort_array(parts),
            lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string")),
        ),
        ",",
    )


def _listed(kind: str, spans: Column) -> Column:
    return F.transform(
        spans,
        lambda x: F.struct(
            x["start"].alias("start"), F.lit(ORDER[kind]).alias("place"), F.lit(kind).alias("kind"), x["end"].alias("end")
        ),
    )


def _parts(kind: str, part: str, spans: Column, weak: bool) -> Column:
    fixed = (F.lit(kind).alias("kind"), F.lit(part).alias("class"), F.lit(weak).alias("weak"))
    return F.transform(spans, lambda x: F.struct(*fixed, x["start"].alias("start"), x["end"].alias("end")))


def linked(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The weak ones of ``parts`` (key, kind, class, start, end, weak) that have a complement within ``scope``.

    Interval join: a weak part lies in every cell of ``scope`` code points that
    it touches, a complement in every cell within ``scope`` of it, and the gap
    from the end of the one to the start of the other is tested exactly.
    """

    def cells(first: Column, last: Column) -> Column:
        return F.explode(F.sequence(F.floor(first / scope), F.floor(last / scope)))

    start, end = F.col("start"), F.col("end")
    weak = parts.where("weak").withColumn("cell", cells(start, end))
    other = parts.select(
        F.col("key").alias("o_key"),
        F.col("class").alias("o_class"),
        start.alias("o_start"),
        end.alias("o_end"),
        cells(start - scope, end + scope).alias("o_cell"),
    )
    near = (
        (F.col("key") == F.col("o_key"))
        & (F.col("cell") == F.col("o_cell"))
        & (F.greatest(start, F.col("o_start")) - F.least(end, F.col("o_end")) <= scope)
        & ((F.col("class") == "secret") != (F.col("o_class") == "secret"))
    )
    return weak.join(other, near, "left_semi").drop("cell").distinct()


def secret_scan(documents: DataFrame, scope: int = SCOPE) -> DataFrame:
    """``documents`` with span counts, ``base_sha256`` and ``spans``."""
    text = text_or_empty()
    kept = [c for c in documents.columns if c not in ADDED]
    # The key joins rows to their parts: rows equal in text share the parts.
    key = F.concat_ws(":", F.xxhash64(text).cast("string"), F.xxhash64(F.lit("second"), text).cast("string"))
    found = {kind: find_spans(text, SEARCH.get(kind, full), full, group, least) for kind, full, group, least, _ in BASE}
    found |= {kind: find_spans(text, pattern, pattern, 0, 1) for kind, pattern, _ in WEAK}
    spans = written(documents.select(key.alias("key"), *[c.alias(k) for k, c in found.items()]).dropDuplicates(["key"]), "secret-spans")
    base = F.concat(*[F.col(k) for k, *_ in BASE])
    rows = []
    for kind, *_, part in BASE:
        rows.append((kind, part, F.col(kind), False))
    for kind, _, part in WEAK:
        free = F.filter(kind, lambda w: ~F.exists(base, lambda b: (b["start"] < w["end"]) & (w["start"] < b["end"])))
        rows.append((kind, part, free, True))
    listed = F.concat(*[_parts(*row) for row in rows])
    parts = written(spans.select("key", F.explode(listed).alias("p")).select("key", "p.*"), "secret-parts")
    place = F.lit(0)
    for kind, i in ORDER.items():
        place = F.when(F.col("kind") == kind, i).otherwise(place)
    added = linked(parts, scope).groupBy("key").agg(
        F.collect_set(F.struct("start", place.alias("place"), "kind", "end")).alias("added")
    )
    strong = F.concat(*[_listed(k, F.col(k)) for k, *_ in BASE])
    result = written(
        spans.join(added, "key", "left").select(
            F.col("key").alias("_s_key"),
            *[F.size(k).cast("long").alias(f"n_{k}") for k, *_ in BASE],
            F.sha2(_joined(strong).cast("binary"), 256).alias("base_sha256"),
            _joined(F.when(F.col("added").isNull(), strong).otherwise(F.concat(strong, F.col("added")))).alias("spans"),
        ),
        "secret-result",
    )
    joined = documents.select(*kept, key.alias("_s_row")).join(result, F.col("_s_row") == F.col("_s_key"), "left")
    return joined.select(*kept, *ADDED)


def query(documents: DataFrame) -> DataFrame:
    return secret_scan(documents.select("doc_id", "text")).drop("text")
