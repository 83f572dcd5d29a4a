"""Sessionization: cut each cookie's time-ordered logs into sessions.

One lazy plan; nothing runs before an action and nothing is cached.  The logs
are read twice, once for the sample and once for the rows.

1. Heavy cookies are found in a hash sample of the logs, about ``SAMPLES`` rows
   for each ``rows_per_chunk`` rows (every row, when that is fewer).  Ranks of
   a cookie's sampled rows in (time, order) give the borders of slices of about
   half ``rows_per_chunk`` rows, however its logs lie in time: a burst, or one
   second, is divided like anything else.  At most ``MOST_BORDERS`` borders are
   broadcast; with more, every second, fourth, ... border of all cookies goes.
2. The logs are shuffled once, by (cookie, slice).  The slice of a row follows
   from the row and the borders, so every evaluation of the plan agrees.
3. A window over each slice in time order cuts it.  Sessions come out of the
   same sorted pass: read backwards, the row that opens a session has seen all
   of it, so that running counts and the last pageview seen make its summary.
   There is no aggregation of rows.
4. One row per slice of a heavy cookie is stitched in time order: whether its
   first session continues the slice before, where its numbers start, and what
   later slices add to its last session.  These rows read the exchange of step
   2 again, and nothing when no cookie is heavy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from visitflow.functions.columns import DROPMALFORMED, check_mode
from visitflow.operators.cut import CutRule, pageview_cut
from visitflow.schema import CLICK, COOKIE, IP, LOG_TIME, LOG_TYPE, MISSING, ORDER, PAGEVIEW, URL

ROWS_PER_CHUNK = 1_000_000
SAMPLES = 64  # sampled rows for each rows_per_chunk rows
MOST_BORDERS = 100_000  # bound of the broadcast
CHUNK = "_chunk"  # slice of a heavy cookie, -1 for a cookie that is one chunk
_CUR, _LOCAL = "_cur", "_local"
SEQ = "session_seq"
_SEARCH = [1 << b for b in reversed(range(MOST_BORDERS.bit_length()))]


class _Fields:
    """Attribute access on a struct Column: ``ns.ms`` → ``struct.ms``."""

    def __init__(self, struct: Column):
        self._struct = struct

    def __getattr__(self, name: str) -> Column:
        if name.startswith("__"):
            raise AttributeError(name)
        return self._struct.getField(name)


def _starts(rule: CutRule, cur: str, prev: str) -> Column:
    return F.coalesce(rule.starts(_Fields(F.col(cur)), _Fields(F.col(prev))), F.lit(False))


def _with_inputs(logs: DataFrame, rule: CutRule, mode: str) -> DataFrame:
    """Logs and, as one struct, the columns that the rule reads, each computed once.

    Rows without cookie or time, or whose time the rule cannot read, go under
    ``DROPMALFORMED``.  Otherwise their struct says why they are refused, and
    ``_refused`` raises it in one place, after the exchange: a stage that several
    branches read would report its failure once for each of them.
    """
    made = rule.input_columns()
    ok = F.col(COOKIE).isNotNull() & F.col(LOG_TIME).isNotNull()
    if rule.parses_time:
        for c in made.values():
            ok = ok & c.isNotNull()
    inputs = [c.alias(name) for name, c in made.items()]
    if check_mode(mode) == DROPMALFORMED:
        return logs.where(ok).withColumn(_CUR, F.struct(*inputs, F.lit(None).cast("string").alias("refused")))
    said = F.concat_ws("|", F.lit("log without cookie or readable time:"), COOKIE, LOG_TIME)
    return logs.withColumn(_CUR, F.struct(*inputs, F.when(~ok, said).alias("refused")))


def _refused(rows: DataFrame) -> DataFrame:
    why = F.col(_CUR).getField("refused")
    return rows.withColumn(_CUR, F.when(why.isNull(), F.col(_CUR)).otherwise(F.raise_error(why)))


def _heavy(logs: DataFrame, rows_per_chunk: int) -> DataFrame:
    """``h_cookie, borders`` of the cookies to divide; ``MOST_BORDERS`` borders in all at most.

    The sample only balances: any borders give the same sessions.
    """
    every = max(1, rows_per_chunk // SAMPLES)
    width = max(1, rows_per_chunk // 2 // every)  # sampled rows of a slice
    picked = logs.where(F.col(COOKIE).isNotNull() & F.col(LOG_TIME).isNotNull())
    if every > 1:
        picked = picked.where(F.pmod(F.xxhash64(COOKIE, LOG_TIME, ORDER), F.lit(every)) == 0)
    picked = picked.select(F.col(COOKIE).alias("h_cookie"), F.struct(F.col(LOG_TIME).alias("t"), F.col(ORDER).alias("o")).alias("border"))
    by_time = Window.partitionBy("h_cookie").orderBy("border")
    ranked = picked.select(
        "*", F.row_number().over(by_time).alias("rank"), F.count("*").over(Window.partitionBy("h_cookie")).alias("n")
    )
    ranked = ranked.where((F.col("n") * 2 >= 3 * width) & (F.col("rank") % width == 0))
    place = (F.col("rank") / width).cast("long")
    evenly = place.bitwiseAND(-place)  # every second place before the rest, every fourth before these, ...
    kept = ranked.orderBy(evenly.desc(), "h_cookie", "border").limit(MOST_BORDERS)
    return kept.groupBy("h_cookie").agg(F.sort_array(F.collect_list("border")).alias("borders"))


def heavy_cookies(logs: DataFrame, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """``cookie``: the cookies that are divided, at most ``MOST_BORDERS`` rows."""
    return _heavy(logs, rows_per_chunk).select(F.col("h_cookie").alias(COOKIE))


def _slice(borders: Column, row: Column) -> Column:
    """Number of borders below the row, by binary search."""

    def step(at: Column, jump: Column) -> Column:
        return F.when(F.get(borders, at + jump - 1) < row, at + jump).otherwise(at)

    return F.aggregate(F.array(*[F.lit(j) for j in _SEARCH]), F.lit(0), step)


def _chunked(
    logs: DataFrame, rule: CutRule, mode: str, rows_per_chunk: int, num_partitions: int | None, columns: list[str] | None = None
) -> DataFrame:
    """Logs with their slice and the rule's inputs, dealt by (cookie, slice)."""
    heavy = F.broadcast(_heavy(logs, rows_per_chunk))
    row = F.struct(F.col(LOG_TIME).alias("t"), F.col(ORDER).alias("o"))
    chunk = F.when(F.col("h_cookie").isNull(), -1).otherwise(_slice(F.col("borders"), row))
    rows = _with_inputs(logs, rule, mode).join(heavy, F.col(COOKIE) == F.col("h_cookie"), "left")
    rows = rows.select(*(columns or logs.columns), _CUR, chunk.alias(CHUNK))
    return rows.repartition(num_partitions, COOKIE, CHUNK) if num_partitions else rows.repartition(COOKIE, CHUNK)


def _divided(rows: DataFrame, logs: DataFrame, rows_per_chunk: int) -> DataFrame:
    """The dealt rows of heavy cookies, from the exchange that the rows themselves read.

    The condition names every column and is not deterministic, so that neither
    it nor a column selection moves below the exchange and makes another of it.
    Without heavy cookies the semi join is empty and reads nothing.
    """
    all_columns = [F.size(f.name) if isinstance(f.dataType, MapType) else F.col(f.name) for f in rows.schema.fields]
    stay = F.when(F.spark_partition_id() >= 0, F.col(CHUNK) >= 0).otherwise(F.xxhash64(*all_columns) == 0)
    heavy = F.broadcast(_heavy(logs, rows_per_chunk).select("h_cookie"))
    return rows.where(stay).join(heavy, F.col(COOKIE) == F.col("h_cookie"), "left_semi")


def _stitched(ends: DataFrame, rule: CutRule) -> DataFrame:
    """``e_cookie, e_chunk, joins, base``, and what later slices add to the slice's last session.

    ``ends`` has one row per slice of a heavy cookie: inputs of its first and
    last row (``head``, ``tail``), sessions (``n``), and of its first session
    ``pv``, ``clicks`` and ``land``.  ``base`` is added to the slice's session
    numbers; ``joins`` says that its first session goes on from the slice before.
    """
    in_time = Window.partitionBy(COOKIE).orderBy(CHUNK)
    ends = ends.select("*", F.lag("tail").over(in_time).alias("before"), F.row_number().over(in_time).alias("place"))
    ends = ends.withColumn("joins", F.when((F.col("place") == 1) | _starts(rule, "head", "before"), 0).otherwise(1))
    so_far = F.sum(F.col("n") - F.col("joins")).over(in_time.rowsBetween(Window.unboundedPreceding, -1))
    ends = ends.withColumn("base", F.coalesce(so_far, F.lit(0)) - F.col("joins"))
    session = Window.partitionBy(COOKIE, "base").orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    later = F.col("joins") == 1
    added = {
        "pv": F.sum(F.when(later, F.col("pv")).otherwise(0)),
        "clicks": F.sum(F.when(later, F.col("clicks")).otherwise(0)),
        "land": F.first(F.when(later, F.col("land")), ignorenulls=True),
    }
    # slices of one session share its number, base + 1, by their first session
    ends = ends.select("*", *[c.over(session).alias(f"all_{name}") for name, c in added.items()])
    goes_on = F.lead("joins").over(in_time) == 1
    return ends.select(
        F.col(COOKIE).alias("e_cookie"),
        F.col(CHUNK).alias("e_chunk"),
        "joins",
        "base",
        *[F.when(goes_on, F.lead(f"all_{name}").over(in_time)).alias(f"more_{name}") for name in added],
    )


def _numbered(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """Adds the columns of ``edges`` and ``session_seq``; one edge for each slice of a heavy cookie."""
    same = (F.col(COOKIE) == F.col("e_cookie")) & (F.col(CHUNK) == F.col("e_chunk"))
    joined = rows.join(F.broadcast(edges), same, "left")  # at most twice MOST_BORDERS rows
    return joined.withColumn(SEQ, (F.col(_LOCAL) + F.coalesce("base", F.lit(0))).cast("int"))


def _cut(rows: DataFrame, rule: CutRule) -> DataFrame:
    """Adds the session number within the slice; a slice's first log always opens one."""
    in_time = Window.partitionBy(COOKIE, CHUNK).orderBy(LOG_TIME, ORDER)
    marked = rows.select(
        "*",
        F.lag(_CUR).over(in_time).alias("_prev"),
        F.row_number().over(in_time).alias("_row"),
        F.lead(F.lit(1)).over(in_time).isNull().alias("_last"),
    )
    marked = marked.withColumn("_opens", F.when((F.col("_row") == 1) | _starts(rule, _CUR, "_prev"), 1).otherwise(0))
    so_far = in_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return marked.select("*", F.sum("_opens").over(so_far).alias(_LOCAL), F.first(_CUR).over(so_far).alias("_head"))


def assign_sessions(
    logs: DataFrame,
    cut: CutRule | None = None,
    *,
    mode: str = "FAILFAST",
    num_partitions: int | None = None,
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """Input logs plus ``session_seq``: 1-based session number within the cookie.

    ``logs`` needs columns cookie, log_server_time, log_type and ``log_order``
    (a unique tiebreak for equal times, of any type that sorts).  Rows without
    cookie or time raise, or are dropped under ``DROPMALFORMED``.
    """
    rule = cut or pageview_cut()
    rows = _chunked(logs, rule, mode, rows_per_chunk, num_partitions)
    ends = _cut(_divided(rows, logs, rows_per_chunk), rule).where("_last")
    nothing = [F.lit(0).alias("pv"), F.lit(0).alias("clicks"), F.lit(None).cast("string").alias("land")]
    edges = _stitched(
        ends.select(COOKIE, CHUNK, F.col("_head").alias("head"), F.col(_CUR).alias("tail"), F.col(_LOCAL).alias("n"), *nothing), rule
    ).select("e_cookie", "e_chunk", "base")
    return _numbered(_cut(_refused(rows), rule), edges).select(*logs.columns, SEQ)


def _pieces(rows: DataFrame, rule: CutRule) -> DataFrame:
    """One row for each session of a slice, from the log that opens it.

    The slice is read backwards in time: at an opening row the running counts
    less those at the opening row before are the session's, and the pageview
    seen last is its first.
    """
    back = Window.partitionBy(COOKIE, CHUNK).orderBy(F.desc(LOG_TIME), F.desc(ORDER))
    seen = back.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    is_pageview = F.col(LOG_TYPE) == PAGEVIEW
    marked = rows.select(
        COOKIE, CHUNK, LOG_TIME, ORDER, LOG_TYPE, IP, URL, _CUR,
        F.lead(_CUR).over(back).alias("_prev"),
        F.lead(F.lit(1)).over(back).isNull().alias("_first"),
    )
    marked = marked.withColumn("_opens", F.when(F.col("_first") | _starts(rule, _CUR, "_prev"), 1).otherwise(0))
    summed = marked.select(
        COOKIE, CHUNK, LOG_TIME, ORDER, IP, "_opens", F.col(_CUR).alias("head"),
        F.first(_CUR).over(seen).alias("tail"),
        F.sum("_opens").over(seen).alias("_from_end"),
        F.sum(F.when(is_pageview, 1).otherwise(0)).over(seen).alias("_pv"),
        F.sum(F.when(F.col(LOG_TYPE) == CLICK, 1).otherwise(0)).over(seen).alias("_clicks"),
        F.last(F.when(is_pageview, F.col(URL)), ignorenulls=True).over(seen).alias("_land"),
    ).where("_opens = 1")
    whole = back.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def own(count: str) -> Column:
        return F.col(count) - F.coalesce(F.lag(count).over(back), F.lit(0))

    pieces = summed.select("*", own("_pv").alias("pv"), own("_clicks").alias("clicks"), F.max("_from_end").over(whole).alias("n"))
    return pieces.select(
        COOKIE, CHUNK, LOG_TIME, IP, "head", "tail", "n", "pv", "clicks",
        F.when(F.col("pv") > 0, F.col("_land")).alias("land"),
        (F.col("n") - F.col("_from_end") + 1).alias(_LOCAL),
    )


def build_sessions(
    logs: DataFrame,
    cut: CutRule | None = None,
    *,
    mode: str = "FAILFAST",
    num_partitions: int | None = None,
    rows_per_chunk: int = ROWS_PER_CHUNK,
    session_ids: str = "hash",
) -> DataFrame:
    """One row per session: id, start, cookie, ip, landing url, counts, seq.

    ``session_ids="hash"`` (default) gives ``md5(cookie|start|seq)``, equal on
    every run and retry; ``"uuid"`` gives a random UUID per session (stage the
    result, :func:`visitflow.sources.staging.staged`, before using it in more
    than one action).
    """
    if session_ids not in ("hash", "uuid"):
        raise ValueError(f"session_ids must be 'hash' or 'uuid', got {session_ids!r}")
    rule = cut or pageview_cut()
    rows = _chunked(logs, rule, mode, rows_per_chunk, num_partitions, [COOKIE, LOG_TIME, ORDER, LOG_TYPE, IP, URL])
    edges = _stitched(_pieces(_divided(rows, logs, rows_per_chunk), rule).where(F.col(_LOCAL) == 1), rule)
    pieces = _pieces(_refused(rows), rule).drop("head", "tail")
    found = _numbered(pieces, edges).where(~((F.col(_LOCAL) == 1) & (F.coalesce("joins", F.lit(0)) == 1)))
    ends = F.col(_LOCAL) == F.col("n")

    def total(name: str) -> Column:
        return (F.col(name) + F.when(ends, F.coalesce(f"more_{name}", F.lit(0))).otherwise(0)).cast("int")

    landing = F.coalesce(F.col("land"), F.when(ends, F.col("more_land")), F.lit(MISSING))
    session_id = F.md5(F.concat_ws("|", COOKIE, LOG_TIME, F.col(SEQ).cast("string"))) if session_ids == "hash" else F.uuid()
    return found.select(
        session_id.alias("session_id"),
        F.col(LOG_TIME).alias("session_server_time"),
        COOKIE,
        IP,
        landing.alias("landing_url"),
        total("pv").alias("pageview_count"),
        total("clicks").alias("click_count"),
        SEQ,
    )
