"""URL rules, and for what no rule fits, trust and distrust spread over the graph of hosts.

The longest rule that fits a URL decides. Hosts whose pages are allowed by rule are the trusted
seeds, hosts whose pages are blocked by rule the distrusted ones, weighed by their pages. Trust
follows links (personalised PageRank), distrust goes against them: who links to a blocked host is
suspect. Edges are the absolute links in the pages' HTML, folded to one weighted edge per pair of
hosts, and edges between a host and its parent domain, so that hosts without links hang on their
siblings. A host whose distrust exceeds its trust is blocked.

Both walks are one table (walk, host, rank) joined to one edge table (walk, source, target, share)
per step, on (walk, host): flows are summed before they are shuffled, and a hub's edges can be
split by Spark. Lineage is cut by a written table every other step. Mass of hosts without edges
goes back to nobody, which changes both walks alike.

A null URL, or one without `://`, has empty host and path; the empty host takes no part in the
graph and is allowed if no rule fits. Null HTML has no links. Repeated page ids are judged row by
row. No pages give no rows. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.llm.common import ascii_lower, table, written

# The rules of the registered query, as (verdict, rule).
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
         ("block", "net/es/"), ("block", "net/fr/"))
STEPS, DAMPING = 8, 0.85
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LINK = r"""(?is)\bhref\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s<>]+)"""


def with_host_and_path(pages: DataFrame, url_col: str = "url") -> DataFrame:
    url = F.coalesce(F.col(url_col), F.lit(""))
    return pages.withColumns({"host": ascii_lower(F.regexp_extract(url, URL, 1)),
                              "path": F.regexp_extract(url, URL, 2)})


def fitting_rule(rules=RULES, host: str = "host", path: str = "path") -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls. `rules` is a short list."""
    rule = verdict = F.lit(None).cast("string")
    for action, text in sorted(rules, key=lambda r: len(r[1])):
        name, _, rest = text.partition("/")
        fits = ((F.col(host) == name) | F.col(host).endswith(f".{name}")) \
            & F.col(path).startswith(f"/{rest}")
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(action)).otherwise(verdict)
    return rule, verdict


def host_edges(judged: DataFrame, html_col: str = "html") -> DataFrame:
    """(source, target, weight) between different hosts."""
    links = judged.filter("host != ''").select("host", F.explode(
        F.regexp_extract_all(F.col(html_col), F.lit(LINK), F.lit(1))).alias("found"))
    links = links.select(F.col("host").alias("source"), ascii_lower(F.col("found")).alias("target"))
    links = links.groupBy("source", "target").agg(F.count(F.lit(1)).alias("weight"))
    hosts = judged.select("host").union(links.select("target")).distinct()
    parent = F.regexp_extract("host", r"^[^.]+\.(.+\..+)$", 1)
    up = hosts.select(F.col("host").alias("source"), parent.alias("target"),
                      F.lit(1).cast("long").alias("weight")).filter("target != ''")
    down = up.select(F.col("target").alias("source"), F.col("source").alias("target"), "weight")
    return links.union(up).union(down).filter("source != target").groupBy(
        "source", "target").agg(F.sum("weight").alias("weight"))


def host_scores(judged: DataFrame, html_col: str = "html", steps: int = STEPS,
                damping: float = DAMPING) -> DataFrame:
    """(host, trust, distrust); `judged` has host and verdict (null where no rule fits)."""
    seeds = judged.filter("host != '' and verdict is not null").groupBy("verdict", "host").agg(
        F.count(F.lit(1)).alias("pages"))
    totals = seeds.groupBy("verdict").agg(F.sum("pages").alias("total"))
    seeds = written(seeds.join(totals, "verdict").select(
        F.when(F.col("verdict") == "allow", "trust").otherwise("distrust").alias("walk"), "host",
        (F.col("pages") / F.col("total")).alias("seed")), "seeds")

    edges = host_edges(judged, html_col)
    both = edges.withColumn("walk", F.lit("trust")).unionByName(edges.select(
        F.col("target").alias("source"), F.col("source").alias("target"), "weight",
        F.lit("distrust").alias("walk")))
    both = written(both, "host-edges")
    out = both.groupBy("walk", "source").agg(F.sum("weight").alias("out"))
    both = written(both.join(out, ["walk", "source"]).select(
        "walk", F.col("source").alias("host"), "target",
        (F.col("weight") / F.col("out") * damping).alias("share")), "host-shares")

    ranks = seeds.select("walk", "host", F.col("seed").alias("rank"))
    for step in range(1, steps + 1):
        flows = ranks.join(both, ["walk", "host"]).select(
            "walk", F.col("target").alias("host"), (F.col("rank") * F.col("share")).alias("rank"))
        fresh = seeds.select("walk", "host", (F.col("seed") * (1 - damping)).alias("rank"))
        ranks = flows.union(fresh).groupBy("walk", "host").agg(F.sum("rank").alias("rank"))
        if step % 2 == 0:
            ranks = written(ranks, "host-ranks")

    def rank(walk: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("walk") == walk, F.col("rank"))), F.lit(0.0))

    return ranks.groupBy("host").agg(rank("trust").alias("trust"),
                                     rank("distrust").alias("distrust"))


def judge(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url",
          html_col: str = "html", steps: int = STEPS, damping: float = DAMPING) -> DataFrame:
    """page_id, host, path, rule, verdict, trust and distrust of every page."""
    named = with_host_and_path(
        pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                     F.col(html_col).alias("html")))
    rule, verdict = fitting_rule(rules)
    judged = named.withColumns({"rule": rule, "verdict": verdict})
    scores = host_scores(judged, "html", steps, damping)
    # A host with a third of all pages would fill one task; spread over salts it does not.
    salts = 32
    scores = scores.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = judged.drop("html", "url").withColumn(
        "salt", F.pmod(F.xxhash64("page_id", "path"), F.lit(salts)).cast("int"))
    found = salted.join(scores, ["host", "salt"], "left")
    by_graph = F.when(F.col("distrust") > F.col("trust"), "block").otherwise("allow")
    return found.select("page_id", "host", "path", "rule",
                        F.coalesce("verdict", by_graph).alias("verdict"), "trust", "distrust")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages")).drop("trust", "distrust")


def _rank_sql(steps: int = STEPS, damping: float = DAMPING) -> str:
    parts, last = [], "SELECT walk, host, seed AS rank FROM seeds"
    for step in range(steps):
        parts.append(f"""r{step} AS (SELECT walk, host, sum(rank) AS rank FROM (
  SELECT e.walk, e.target AS host, r.rank * e.share AS rank
  FROM ({last}) r JOIN shares e ON e.walk = r.walk AND e.source = r.host
  UNION ALL SELECT walk, host, seed * {1 - damping} FROM seeds) GROUP BY walk, host)""")
        last = f"SELECT * FROM r{step}"
    return ",\n".join(parts)


OP7_SQL = rf"""
WITH named AS (
  SELECT page_id, html, coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), '') AS h,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
hosted AS (
  SELECT page_id, html, path, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                        'abcdefghijklmnopqrstuvwxyz') AS host FROM named),
judged AS (
  SELECT *, CASE
    WHEN ('.' || host) LIKE '%.www.example.com' AND path LIKE '/en/%' THEN 'www.example.com/en/'
    WHEN ('.' || host) LIKE '%.example.com' AND path LIKE '/en/%' THEN 'example.com/en/'
    WHEN ('.' || host) LIKE '%.net' AND path LIKE '/es/%' THEN 'net/es/'
    WHEN ('.' || host) LIKE '%.net' AND path LIKE '/fr/%' THEN 'net/fr/'
    WHEN ('.' || host) LIKE '%.com' AND path LIKE '/%' THEN 'com/' END AS rule FROM hosted),
ruled AS (
  SELECT *, CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'trust'
                 WHEN rule IS NOT NULL THEN 'distrust' END AS walk FROM judged),
seeds AS (
  SELECT walk, host, count(*) / sum(count(*)) OVER (PARTITION BY walk) AS seed
  FROM ruled WHERE walk IS NOT NULL AND host <> '' GROUP BY walk, host),
links AS (
  SELECT host AS source, translate(unnest(regexp_extract_all(html,
           '(?is)\bhref\s*=\s*["'']?\s*(?:https?:)?//([^/?#"''\s<>]+)', 1)),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS target
  FROM ruled WHERE host <> ''),
up AS (
  SELECT host AS source, regexp_extract(host, '^[^.]+\.(.+\..+)$', 1) AS target
  FROM (SELECT host FROM ruled UNION SELECT target FROM links)),
edges AS (
  SELECT source, target, count(*) AS weight FROM (
    SELECT * FROM links UNION ALL SELECT * FROM up WHERE target <> ''
    UNION ALL SELECT target, source FROM up WHERE target <> '')
  WHERE source <> target GROUP BY source, target),
walks AS (
  SELECT 'trust' AS walk, source, target, weight FROM edges
  UNION ALL SELECT 'distrust', target, source, weight FROM edges),
shares AS (
  SELECT walk, source, target,
         weight / sum(weight) OVER (PARTITION BY walk, source) * {DAMPING} AS share FROM walks),
{_rank_sql()},
scores AS (
  SELECT host, coalesce(sum(rank) FILTER (walk = 'trust'), 0) AS trust,
         coalesce(sum(rank) FILTER (walk = 'distrust'), 0) AS distrust
  FROM r{STEPS - 1} GROUP BY host)
SELECT p.page_id, p.host, p.path, p.rule,
       CASE WHEN p.walk = 'trust' THEN 'allow' WHEN p.walk = 'distrust' THEN 'block'
            WHEN s.distrust > s.trust THEN 'block' ELSE 'allow' END AS verdict
FROM ruled p LEFT JOIN scores s ON s.host = p.host
"""
