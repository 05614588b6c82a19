"""URL filters: rules, and trust and distrust propagated over the links between hosts.

Rules name a host and the start of a path.  Where none fits a page, its host decides: trust starts
at hosts in the share of their pages that rules allow and follows links; distrust starts at hosts
in the share of their pages that rules block and follows links backwards.  Both are personalised
PageRank on the weighted host graph.  A host whose distrust exceeds its trust by more than the
threshold is blocked.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, table

#: (host and start of the path, verdict)
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
DAMPING, ROUNDS, THRESHOLD = 0.85, 28, 0.5
SALTS = 32
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: str) -> Column:
    at = F.instr(F.col(url), "://")
    return F.when(at > 0, F.expr(f"substr({url}, instr({url}, '://') + 3)")).otherwise(F.lit(""))


def host_of(url: str) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: str) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, null where none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule, said in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        of, _, begins = rule.partition("/")
        fits = ((host == of) | host.endswith("." + of)) & path.startswith("/" + begins)
        name, verdict = F.when(fits, F.lit(rule)).otherwise(name), F.when(fits, F.lit(said)).otherwise(verdict)
    return name, verdict


def host_links(pages: DataFrame) -> DataFrame:
    """``src, dst, n``: links from pages of one host to another."""
    targets = F.regexp_extract_all(F.coalesce(F.col("html").cast("string"), F.lit("")), F.lit(r"""(?i)href\s*=\s*["']?(?:https?:)?//([^/?#"'\s>]+)"""), F.lit(1))
    found = pages.select(host_of("url").alias("src"), F.explode(targets).alias("dst")).select("src", F.translate("dst", UPPER, LOWER).alias("dst"))
    return found.where("src <> dst and src <> '' and dst <> ''").groupBy("src", "dst").agg(F.count("*").alias("n"))


def propagate(links: DataFrame, seeds: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """``kind, host, mass``: PageRank of kind 'trust' along and 'distrust' against the links.

    ``seeds`` are (kind, host, mass).  The rank is the sum over k of damping^k times the seeds
    spread k times; ``rounds`` terms leave under damping^rounds (one in a hundred) of the seeds.
    What is spread is one row for each host reached, checkpointed each round, and rounds end when
    nothing is left to spread.  Shares are summed before each shuffle.  A host with very many
    links is split by adaptive execution in the join.

    Repeated links and seeds add up.  Links with a null end spread nothing, and a seed with a null host
    or kind stays where it is.  No links: the seeds' own share.  No seeds: empty result.  Other columns
    are dropped.
    """
    ahead = links.select(F.lit("trust").alias("kind"), "src", "dst", "n")
    back = links.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    both = ahead.union(back)
    out = both.groupBy("kind", "src").agg(F.sum("n").alias("total"))
    steps = cut(both.join(out, ["kind", "src"]).select("kind", "src", "dst", (F.col("n") / F.col("total")).alias("share")))
    front = cut(seeds.select("kind", "host", (F.col("mass") * (1 - damping)).alias("mass")))
    parts = [front]
    if not steps.isEmpty():
        for _ in range(rounds):
            moved = front.join(steps, (front.kind == steps.kind) & (front.host == steps.src)).select(front.kind, F.col("dst").alias("host"), (F.col("mass") * F.col("share") * damping).alias("mass"))
            front = cut(moved.groupBy("kind", "host").agg(F.sum("mass").alias("mass")))
            if front.isEmpty():
                break
            parts.append(front)
    return reduce(DataFrame.union, parts).groupBy("kind", "host").agg(F.sum("mass").alias("mass"))


def judge(pages: DataFrame, rules=RULES, threshold: float = THRESHOLD) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` for each row of ``pages``.

    ``score`` is the host's trust less its distrust, 0 for a host that nothing reaches.  A page
    that no rule fits is blocked where it is under ``-threshold * (1 - damping)``, that is, where
    the host's own pages or what it links to weigh more than half for blocking.

    Null url or one without ``://``: host and path empty, no links and no evidence, so allowed
    unless a rule says otherwise.  Null html: no links.  Repeated rows: a row each.  Empty table:
    empty result.  Other columns are dropped.  Hosts with many pages: scores are joined over
    salted keys.
    """
    host, path = host_of("url"), path_of("url")
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    rule, said = rule_for(F.col("host"), F.col("path"), rules)
    ruled = base.select("page_id", "host", "path", rule.alias("rule"), said.alias("said"))
    share = lambda verdict: F.avg(F.when(F.col("said") == verdict, 1.0).otherwise(0.0))
    per = ruled.where("host <> ''").groupBy("host").agg(share("allow").alias("trust"), share("block").alias("distrust"))
    seeds = per.select("host", F.expr("stack(2, 'trust', trust, 'distrust', distrust) as (kind, mass)")).where("mass > 0")
    mass = propagate(host_links(pages), seeds)
    scores = mass.groupBy("host").agg(F.sum(F.when(F.col("kind") == "trust", F.col("mass")).otherwise(-F.col("mass"))).alias("score"))
    salted = scores.select("host", "score", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    keyed = ruled.withColumn("salt", F.pmod(F.xxhash64("page_id", "path"), F.lit(SALTS)).cast("int"))
    bound = -threshold * (1 - DAMPING)
    own = F.when(F.col("score") < bound, F.lit("block")).otherwise(F.lit("allow"))
    return keyed.join(salted, ["host", "salt"], "left").select(
        "page_id", "host", "path", "rule", F.coalesce("said", own).alias("verdict"), (F.round(F.coalesce("score", F.lit(0.0)), 9) + 0.0).alias("score")
    )


def run(spark, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"))


def verdict_sql() -> str:
    """The same verdicts in SQL (DuckDB), spreading by a recursive query."""
    fits = "(host = '{0}' OR ends_with(host, '.{0}')) AND starts_with(path, '/{1}')"
    cases = [(rule, said, fits.format(*rule.split("/", 1))) for rule, said in sorted(RULES, key=lambda r: (-len(r[0]), r[0]))]
    rule = " ".join(f"WHEN {cond} THEN '{name}'" for name, _, cond in cases)
    said = " ".join(f"WHEN {cond} THEN '{verdict}'" for _, verdict, cond in cases)
    return rf"""
WITH RECURSIVE r AS (SELECT row_number() OVER () AS n, page_id, html, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT n, page_id, html, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
p AS (SELECT *, CASE {rule} END AS rule, CASE {said} END AS said FROM h),
l AS (SELECT host AS src, translate(unnest(regexp_extract_all(coalesce(html, ''), '(?i)href\s*=\s*["'']?(?:https?:)?//([^/?#"''\s>]+)', 1)), '{UPPER}', '{LOWER}') AS dst FROM p),
e AS (SELECT src, dst, count(*) AS n FROM l WHERE src <> dst AND src <> '' AND dst <> '' GROUP BY ALL),
b AS (SELECT 'trust' AS kind, src, dst, n FROM e UNION ALL SELECT 'distrust', dst, src, n FROM e),
s AS (SELECT kind, src, dst, n / sum(n) OVER (PARTITION BY kind, src) AS share FROM b),
q AS (SELECT host, avg(CASE WHEN said = 'allow' THEN 1.0 ELSE 0 END) AS t, avg(CASE WHEN said = 'block' THEN 1.0 ELSE 0 END) AS d FROM p WHERE host <> '' GROUP BY host),
f AS (SELECT 0 AS k, kind, host, mass * {1 - DAMPING!r}::DOUBLE AS mass FROM (SELECT 'trust' AS kind, host, t AS mass FROM q WHERE t > 0 UNION ALL SELECT 'distrust', host, d FROM q WHERE d > 0)
  UNION ALL SELECT f.k + 1, f.kind, s.dst, sum(f.mass * s.share * {DAMPING}) FROM f JOIN s ON f.kind = s.kind AND f.host = s.src WHERE f.k < {ROUNDS} GROUP BY f.k, f.kind, s.dst),
c AS (SELECT host, sum(CASE WHEN kind = 'trust' THEN mass ELSE -mass END) AS score FROM f GROUP BY host)
SELECT page_id, p.host, path, rule, coalesce(said, CASE WHEN score < {-THRESHOLD * (1 - DAMPING)!r} THEN 'block' ELSE 'allow' END) AS verdict, round(coalesce(score, 0), 9) + 0.0 AS score
FROM p LEFT JOIN c ON c.host = p.host
"""
