"""URL filter: path rules, and link-graph propagation for what no rule decides (DataFrame operations only).

A rule ``host/path`` fits its host and all subdomains if the url's path starts
with the rule's path; the longest fitting rule decides.  Hosts are judged
over the host link graph, counted from the pages' absolute links.  Trust is
personalised PageRank from the hosts whose pages rules allow, along the links.
Distrust goes against the links: of a damped walk that starts at the host and
follows its links, it is the share that reaches a blocked page.  A host divides
only its own links, so its distrust does not depend on how many others link to
the same blocked host.  A host's seed is the share of its pages that rules allow
(or block).  A page without a rule is blocked if its host's distrust exceeds its
trust by more than ``threshold``.  Both are iterated to ``TOLERANCE``.

Defined results: a null url, or one without ``://``, has empty host and path,
fits no rule and is allowed; null html has no links; repeated rows count as
pages of their own; an empty table gives an empty result; equally long rules
that both fit: block wins; other columns pass through, and one named like an
added column is replaced.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitflow.llm.common import LOWER, UPPER, lower_ascii, written

# The rules of the registered query.
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
DAMPING = 0.85
ROUNDS = 12
THRESHOLD = 0.5
TOLERANCE = 1e-4
SQL_ROUNDS = 80  # steps of the SQL form: DAMPING**80 is far below the tolerance
ADDED = ("host", "path", "rule", "verdict", "trust", "distrust")
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LINK = r"""(?i)href\s*=\s*["']?(?:https?:)?//([^/?#"'\s>]+)"""


def host(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def rule_of(rules, host_name: Column, url_path: Column) -> Column:
    """The longest fitting rule, as text; null if none fits."""
    found = F.lit(None).cast("string")
    for _, text in sorted(rules, key=lambda r: (len(r[1]), r[0] == "block")):
        name, _, rest = text.partition("/")
        fits = ((host_name == name) | host_name.endswith("." + name)) & url_path.startswith("/" + rest)
        found = F.when(fits, F.lit(text)).otherwise(found)
    return found


def verdict_of(rules, rule: Column) -> Column:
    verdict = F.lit(None).cast("string")
    for kind, text in sorted(rules):  # block after allow
        verdict = F.when(rule == text, F.lit(kind)).otherwise(verdict)
    return verdict


def host_edges(pages: DataFrame) -> DataFrame:
    """``src, dst, n``: links between different hosts, counted with map-side combine."""
    links = pages.select("host", F.explode(F.regexp_extract_all("html", F.lit(LINK), 1)).alias("dst"))
    links = links.select(F.col("host").alias("src"), lower_ascii(F.col("dst")).alias("dst"))
    return links.where("src <> '' and src <> dst").groupBy("src", "dst").agg(F.count("*").alias("n"))


def propagate(
    seeds: DataFrame, edges: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS, tolerance: float | None = None
) -> DataFrame:
    """``host, trust, distrust`` after ``rounds`` steps of both walks, or when a step moves at most ``tolerance`` of their mass.

    ``seeds`` has ``host, trust, distrust``; ``edges`` has ``src, dst, n``.
    Both walks run in one loop, as rows of different ``walk``.  Mass that has
    no link to follow returns to the seeds.  Every round is checkpointed.
    A step shrinks the difference to the limit by ``damping`` at least, so the
    tolerance is reached.
    """
    seeds = written(
        seeds.select(
            "host",
            F.explode(F.map_from_arrays(F.array(F.lit("trust"), F.lit("distrust")), F.array("trust", "distrust"))).alias(
                "walk", "seed"
            ),
        ).where("seed > 0"),
        "host-seeds",
    )
    both = edges.select(F.lit("trust").alias("walk"), "src", "dst", "n").unionByName(
        edges.select(F.lit("distrust").alias("walk"), F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    )
    out = both.groupBy("walk", "src").agg(F.sum("n").alias("out"))
    share = both.join(out, ["walk", "src"]).select(
        F.col("walk").alias("s_walk"), "src", "dst", (F.col("n") / F.col("out")).alias("share")
    )
    share = written(share, "host-links")
    total = {r["walk"]: r["s"] for r in seeds.groupBy("walk").agg(F.sum("seed").alias("s")).collect()}  # two rows
    rank = seeds.withColumnRenamed("seed", "rank")
    steps = itertools.count() if tolerance is not None else range(rounds)
    for _ in steps if total and not share.isEmpty() else ():  # without links the walks stay at their seeds
        step = rank.join(share, (F.col("walk") == F.col("s_walk")) & (F.col("host") == F.col("src"))).select(
            "walk", F.col("dst").alias("host"), (F.lit(damping) * F.col("rank") * F.col("share")).alias("rank")
        )
        step = step.groupBy("walk", "host").agg(F.sum("rank").alias("rank")).checkpoint()
        moved = {r["walk"]: r["s"] for r in step.groupBy("walk").agg(F.sum("rank").alias("s")).collect()}
        back = F.lit(0.0)
        for walk, mass in total.items():
            back = F.when(F.col("walk") == walk, F.lit(1 - moved.get(walk, 0.0) / mass)).otherwise(back)
        new = step.unionByName(seeds.select("walk", "host", (F.col("seed") * back).alias("rank")))
        old, rank = rank, new.groupBy("walk", "host").agg(F.sum("rank").alias("rank")).checkpoint()
        if tolerance is not None:
            change = rank.unionByName(old.withColumn("rank", -F.col("rank"))).groupBy("walk", "host").agg(F.sum("rank").alias("by"))
            by = {r["walk"]: r["s"] for r in change.groupBy("walk").agg(F.sum(F.abs("by")).alias("s")).collect()}
            if all(by[walk] <= tolerance * mass for walk, mass in total.items()):
                break

    def of(walk: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("walk") == walk, F.col("rank"))), F.lit(0.0)).alias(walk)

    return rank.groupBy("host").agg(of("trust"), of("distrust"))


def reach(seeds: DataFrame, edges: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """``host, distrust``: the share of a damped walk along the links from the host that reaches a blocked page.

    ``seeds`` has ``host, distrust``, the share of the host's pages that are
    blocked; ``edges`` has ``src, dst, n``.  Steps until no host changes by more
    than ``tolerance``, which ``damping`` ensures; each is checkpointed.
    """
    seeds = written(seeds.where("distrust > 0").select("host", F.col("distrust").alias("seed")), "host-blocked")
    out = edges.groupBy(F.col("src").alias("o_src")).agg(F.sum("n").alias("out"))
    share = edges.join(out, F.col("src") == F.col("o_src")).select("src", "dst", (F.col("n") / F.col("out")).alias("share"))
    share = written(share, "host-shares")
    now = seeds.select("host", F.col("seed").alias("distrust"))
    change = 0.0 if seeds.isEmpty() or share.isEmpty() else 1.0
    while change > tolerance:
        met = now.join(share, F.col("host") == F.col("dst")).select(F.col("src").alias("host"), (F.col("distrust") * F.col("share")).alias("met"))
        met = met.groupBy("host").agg((damping * F.sum("met")).alias("met"))
        seed, met_share = F.coalesce("seed", F.lit(0.0)), F.coalesce("met", F.lit(0.0))
        new = seeds.join(met, "host", "full").select("host", (seed + (1 - seed) * met_share).alias("distrust")).checkpoint()
        both = new.unionByName(now.withColumn("distrust", -F.col("distrust"))).groupBy("host").agg(F.sum("distrust").alias("by"))
        change = both.agg(F.max(F.abs("by")).alias("c")).first()["c"]
        now = new
    return now


def url_filter(pages: DataFrame, rules=RULES, threshold: float = THRESHOLD) -> DataFrame:
    """``pages`` with ``host, path, rule, verdict, trust, distrust``."""
    url = F.col("url")
    ruled = pages.drop(*ADDED).withColumns({"host": host(url), "path": path(url)})
    ruled = ruled.withColumn("rule", rule_of(rules, F.col("host"), F.col("path")))
    ruled = ruled.withColumn("verdict", verdict_of(rules, F.col("rule")))

    def pages_with(verdict: str) -> Column:
        return (F.count_if(F.col("verdict") == verdict) / F.count("*")).alias({"allow": "trust", "block": "distrust"}[verdict])

    seeds = ruled.where("host <> ''").groupBy("host").agg(pages_with("allow"), pages_with("block"))
    seeds = written(seeds, "host-rules")
    edges = written(host_edges(ruled), "host-edges")
    trust = propagate(seeds.withColumn("distrust", F.lit(0.0)), edges, tolerance=TOLERANCE).select("host", "trust")
    judged = written(trust.join(reach(seeds, edges), "host", "full"), "host-trust").withColumnRenamed("host", "_u_host")
    joined = ruled.join(judged, F.col("host") == F.col("_u_host"), "left").drop("_u_host")
    zero = F.lit(0.0)
    joined = joined.withColumns({c: F.coalesce(F.col(c), zero) for c in ("trust", "distrust")})
    by_host = F.when(F.col("distrust") - F.col("trust") > threshold, F.lit("block")).otherwise(F.lit("allow"))
    return joined.withColumn("verdict", F.coalesce(F.col("verdict"), by_host))


def query(pages: DataFrame) -> DataFrame:
    return url_filter(pages.select("page_id", "url", "html")).select("page_id", "host", "path", "rule", "verdict")


def oracle(rules=RULES, threshold: float = THRESHOLD) -> str:
    """DuckDB SQL for :func:`query`: both walks as recursive queries of ``SQL_ROUNDS`` steps."""
    link = LINK.replace("'", "''")
    longest_first = sorted(rules, key=lambda r: (len(r[1]), r[0] == "block"), reverse=True)

    def fits(text: str) -> str:
        name, _, rest = text.partition("/")
        return f"(host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '/{rest}')"

    rule = " ".join(f"WHEN {fits(text)} THEN '{text}'" for _, text in longest_first)
    verdict = " ".join(f"WHEN '{text}' THEN '{kind}'" for kind, text in longest_first)
    lower = f"'{UPPER}', '{LOWER}'"
    return rf"""
WITH RECURSIVE p AS (
  SELECT page_id, html, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), {lower}) AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
ruled AS (SELECT *, CASE {rule} END AS rule FROM p),
judged AS (SELECT *, CASE rule {verdict} END AS said FROM ruled),
hosts AS (
  SELECT host, count(*) FILTER (said = 'allow') / count(*)::DOUBLE AS t, count(*) FILTER (said = 'block') / count(*)::DOUBLE AS d
  FROM judged WHERE host <> '' GROUP BY host),
edges AS (
  SELECT src, dst, count(*) AS n
  FROM (SELECT host AS src, translate(unnest(regexp_extract_all(html, '{link}', 1)), {lower}) AS dst FROM p)
  WHERE src <> '' AND src <> dst GROUP BY ALL),
sh AS MATERIALIZED (SELECT src, dst, n / (sum(n) OVER (PARTITION BY src))::DOUBLE AS share FROM edges),
node AS MATERIALIZED (
  SELECT host, coalesce(max(t), 0) AS t, coalesce(max(d), 0) AS d
  FROM (SELECT host, t, d FROM hosts UNION ALL SELECT src, NULL, NULL FROM edges UNION ALL SELECT dst, NULL, NULL FROM edges)
  GROUP BY host),
walk AS (
  SELECT 0 AS k, host, t AS trust, d AS distrust, t, d FROM node
  UNION ALL
  SELECT w.k + 1, w.host, coalesce(i.got, 0) + w.t * coalesce(1 - m.moved / nullif(m.mass, 0), 0),
         w.d + (1 - w.d) * coalesce(o.met, 0), w.t, w.d
  FROM walk w
  LEFT JOIN (SELECT sh.dst, sum({DAMPING}::DOUBLE * x.trust * sh.share) AS got
             FROM walk x JOIN sh ON sh.src = x.host GROUP BY sh.dst) i ON i.dst = w.host
  LEFT JOIN (SELECT sh.src, sum({DAMPING}::DOUBLE * x.distrust * sh.share) AS met
             FROM walk x JOIN sh ON sh.dst = x.host GROUP BY sh.src) o ON o.src = w.host
  CROSS JOIN (SELECT coalesce(sum({DAMPING}::DOUBLE * x.trust * q.links), 0) AS moved, sum(x.t) AS mass
              FROM walk x LEFT JOIN (SELECT src, sum(share) AS links FROM sh GROUP BY src) q ON q.src = x.host) m
  WHERE w.k < {SQL_ROUNDS})
SELECT page_id, judged.host, path, rule,
       coalesce(said, CASE WHEN coalesce(distrust - trust, 0) > {threshold} THEN 'block' ELSE 'allow' END) AS verdict
FROM judged LEFT JOIN (SELECT * FROM walk WHERE k = {SQL_ROUNDS}) w ON w.host = judged.host
"""
