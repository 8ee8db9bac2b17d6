"""URL filter: path rules first, then trust and distrust over the host graph.

Rules decide a url by the longest fitting (host, path) prefix. Every other url
gets the verdict of its host: personalised PageRank spreads trust from hosts
whose pages are mostly allowed by a rule along the links, distrust spreads
from mostly blocked hosts against the links, and a host whose distrust exceeds
its trust (and a floor) is blocked; a tie is allowed. Every seed starts with a
mass of 1, so floor and tolerance are shares of one seed and a verdict does not
depend on how many other seeds the table holds. All of it is DataFrame work on
host pairs; a round shuffles the mass that moved in the round before, no more.

Null url or a url without ``://``: empty host and path, no rule, allowed.
Null html has no links. Repeated rows count as pages of their own.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustlens.llm.common import ascii_lower
from trustlens.session import materialize

# The rules of the contract, (verdict, host, path).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"),
         ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?(?:https?:)?//([^/?#"'\s>]+)"""
# Least distrust of a blocked host, and the mass of all hosts together at which the walk ends.
DAMPING, FLOOR, TOLERANCE = 0.85, 1e-6, 1e-7


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return (ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)),
            F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def longest_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule text, its verdict); null where none fits."""
    text = verdict = F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        text = F.when(fits, F.lit(h + p)).otherwise(text)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return text, verdict


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, n): links between different hosts, counted before the shuffle."""
    links = pages.where("host <> ''").select(
        F.col("host").alias("src"),
        F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit(LINK), 1))).alias("dst"))
    links = links.select("src", ascii_lower(F.col("dst")).alias("dst")).where("src <> dst")
    return links.groupBy("src", "dst").agg(F.count("*").alias("n"))


def propagate(seeds: DataFrame, edges: DataFrame, damping: float = DAMPING,
              tolerance: float = TOLERANCE) -> DataFrame:
    """Personalised PageRank as the sum of its walks by length.

    seeds: (kind, host, mass); edges: (kind, src, dst, n). What a round moved is
    written and is all that the next one reads. The moved mass shrinks by
    ``damping`` at least; rounds end when all of it is under ``tolerance`` (no host
    then misses tolerance * damping / (1 - damping) or more) or nothing is left to
    move. Mass of hosts without links leaves the walk.
    """
    total = edges.groupBy("kind", "src").agg(F.sum("n").alias("total"))
    step = materialize(edges.join(total, ["kind", "src"])
                       .select("kind", "src", "dst", (F.col("n") / F.col("total")).alias("w")), "op9-step")
    moved = materialize(seeds.select("kind", "host", (F.lit(1 - damping) * F.col("mass")).alias("mass")), "op9-walk")
    walks = [moved]
    while (moved.agg(F.sum("mass")).first()[0] or 0.0) >= tolerance:
        moved = materialize(moved.withColumnRenamed("host", "src").join(step, ["kind", "src"])
                            .groupBy("kind", F.col("dst").alias("host"))
                            .agg(F.sum(F.lit(damping) * F.col("mass") * F.col("w")).alias("mass")), "op9-walk")
        walks.append(moved)
    return reduce(DataFrame.unionByName, walks).groupBy("kind", "host").agg(F.sum("mass").alias("mass"))


def judge_urls(df: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict of every row."""
    host, path = split_url(F.col("url"))
    rule, ruled = longest_rule(F.col("host"), F.col("path"), rules)
    pages = (df.select("page_id", "url", "html").withColumn("host", host).withColumn("path", path)
               .withColumn("rule", rule).withColumn("ruled", ruled))
    # One pass over the html: the hosts' page counts and links are written once.
    per_host = (pages.where("host <> ''").groupBy("host")
                .agg(F.count("*").alias("n"),
                     F.count_if(F.col("ruled") == "allow").alias("allowed"),
                     F.count_if(F.col("ruled") == "block").alias("blocked")))
    seeds = per_host.select("host", F.explode(F.array(
        F.struct(F.lit("trust").alias("kind"), (2 * F.col("allowed") > F.col("n")).alias("on")),
        F.struct(F.lit("distrust").alias("kind"), (2 * F.col("blocked") > F.col("n")).alias("on")))).alias("s"))
    seeds = seeds.where("s.on").select("s.kind", "host", F.lit(1.0).alias("mass"))
    edges = materialize(host_edges(pages), "op9-edges")
    both = (edges.select(F.lit("trust").alias("kind"), "src", "dst", "n")
            .unionByName(edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"),
                                      F.col("src").alias("dst"), "n")))
    rank = propagate(seeds, both)
    score = rank.groupBy("host").agg(
        F.sum(F.when(F.col("kind") == "distrust", F.col("mass")).otherwise(0.0)).alias("distrust"),
        F.sum(F.when(F.col("kind") == "trust", F.col("mass")).otherwise(0.0)).alias("trust"))
    bad = score.where((F.col("distrust") > F.col("trust")) & (F.col("distrust") > FLOOR)).select("host")
    return (pages.drop("html", "url").join(bad.withColumn("bad", F.lit(True)), "host", "left")
            .select("page_id", "host", "path", "rule",
                    F.coalesce("ruled", F.when(F.col("bad"), "block").otherwise("allow")).alias("verdict")))


def _oracle() -> str:
    fits = [(h + p, v, f"((host = '{h}' OR host LIKE '%.{h}') AND starts_with(path, '{p}'))") for v, h, p in
            sorted(RULES, key=lambda r: -len(r[1] + r[2]))]
    rule = "CASE " + " ".join(f"WHEN {f} THEN '{t}'" for t, _, f in fits) + " END"
    ruled = "CASE " + " ".join(f"WHEN {f} THEN '{v}'" for _, v, f in fits) + " END"
    return rf"""
WITH RECURSIVE u AS (SELECT page_id, html, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, html, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
      regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
p AS MATERIALIZED (SELECT *, {rule} AS rule, {ruled} AS ruled FROM h),
per AS (SELECT host, count(*) AS n, count(*) FILTER (ruled = 'allow') AS a, count(*) FILTER (ruled = 'block') AS b
        FROM p WHERE host <> '' GROUP BY host),
s0 AS (SELECT 'trust' AS kind, host FROM per WHERE 2 * a > n UNION ALL SELECT 'distrust', host FROM per WHERE 2 * b > n),
raw AS (SELECT host AS src, unnest(list_distinct(regexp_extract_all(html, '(?i)<a\s[^>]*?href\s*=\s*["'']?(?:https?:)?//([^/?#"''\s>]+)', 1))) AS dst FROM p WHERE host <> ''),
e AS (SELECT src, translate(dst, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS dst FROM raw),
ec AS MATERIALIZED (SELECT src, dst, count(*) AS n FROM e WHERE src <> dst GROUP BY src, dst),
e2 AS (SELECT 'trust' AS kind, src, dst, n FROM ec UNION ALL SELECT 'distrust', dst, src, n FROM ec),
step AS MATERIALIZED (SELECT kind, src, dst, n / sum(n) OVER (PARTITION BY kind, src) AS w FROM e2),
walk AS (SELECT kind, host, {1 - DAMPING:.2f}::DOUBLE AS mass FROM s0
  UNION ALL SELECT w.kind, s.dst, sum({DAMPING}::DOUBLE * w.mass * s.w)
  FROM (SELECT *, sum(mass) OVER () AS whole FROM walk) w JOIN step s ON s.kind = w.kind AND s.src = w.host
  WHERE w.whole >= {TOLERANCE} GROUP BY w.kind, s.dst),
bad AS (SELECT host FROM walk GROUP BY host
  HAVING sum(CASE WHEN kind = 'distrust' THEN mass ELSE 0 END) > sum(CASE WHEN kind = 'trust' THEN mass ELSE 0 END)
  AND sum(CASE WHEN kind = 'distrust' THEN mass ELSE 0 END) > {FLOOR})
SELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN bad.host IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN bad USING (host)"""


ORACLE = _oracle()
