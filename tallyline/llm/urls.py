"""URL filters: allow and block rules, and a path-template tree for the rest.

Rules fit a host and its subdomains and a path prefix; the longest wins. The
urls that no rule fits are judged by the tree, which learns from those that
a rule does fit:

1. Per host, paths are segments. A segment that holds a digit is variable;
   and level by level, a branch whose children are mostly distinct
   (``VARIETY``) is generalised to a wildcard. Levels below ``DEPTH`` fold
   into one wildcard.
2. Branches of one parent whose labelled block rate does not differ
   significantly from the parent's (``Z``) merge with it: their urls are
   judged by the parent's counts.
3. A template's purity is its block rate, smoothed towards the rate of the
   same first branch over all hosts, and that towards the overall rate. At
   ``THRESHOLD`` or more the template is rejected.

Only counts per (host, template) pass the joins; urls of a hot host meet
their template's verdict in a join that Spark can split.

Defined results: a null url, or one without ``://``, has empty host and
path, fits no rule and gets the verdict of the empty template; repeated rows
are judged each; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage

#: host, path prefix, verdict
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
DEPTH = 3
VARIETY = 0.5
MIN_CHILDREN = 8
Z = 1.96
PRIOR = 4.0
THRESHOLD = 0.5


def parse(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    host = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def with_rules(urls: DataFrame, rules=RULES) -> DataFrame:
    """Add ``rule`` and ``rule_verdict`` to rows with host and path; null
    where no rule fits. Rules meet the distinct hosts, by every suffix."""
    spark = urls.sparkSession
    table = spark.createDataFrame(list(rules), "rule_host string, prefix string, verdict string")
    table = table.groupBy("rule_host").agg(
        F.collect_list(F.struct((F.length("rule_host") + F.length("prefix")).alias("n"), F.concat("rule_host", "prefix").alias("rule"), "prefix", "verdict")).alias("rules")
    )
    parts = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    hosts = urls.select("host").distinct().withColumn("rule_host", F.explode(suffixes))
    hosts = hosts.join(table, "rule_host").groupBy("host").agg(F.flatten(F.collect_list("rules")).alias("rules"))
    best = F.array_max(F.filter("rules", lambda r: F.startswith(F.col("path"), r["prefix"])))
    return (
        urls.join(hosts, "host", "left")
        .withColumn("best", best)
        .withColumn("rule", F.col("best.rule"))
        .withColumn("rule_verdict", F.col("best.verdict"))
        .drop("rules", "best")
    )


def segments(path: Column) -> list[Column]:
    """The first ``DEPTH`` segments and what is below, '' where missing; a
    segment with a digit is a wildcard."""
    segs = F.filter(F.split(path, "/"), lambda s: s != "")
    own = [F.coalesce(F.get(segs, F.lit(i)), F.lit("")) for i in range(DEPTH)]
    own = [F.when(s.rlike("[0-9]"), F.lit("*")).otherwise(s) for s in own]
    return [*own, F.when(F.size(segs) > DEPTH, F.lit("**")).otherwise(F.lit(""))]


def template_verdicts(counts: DataFrame) -> DataFrame:
    """host, s0..s<DEPTH>, template, purity, from counts (host, s0..s<DEPTH>,
    n urls, lab of them labelled, bad of those blocked)."""
    leaf = counts
    names = [f"s{i}" for i in range(DEPTH + 1)]
    known = ["host"]
    for i in range(DEPTH):  # generalise level by level, from the host down
        children = leaf.groupBy(*known, f"s{i}").agg(F.sum("n").alias("n"))
        parents = children.groupBy(*known).agg(F.count(F.lit(1)).alias("_kids"), F.sum("n").alias("_urls"))
        wide = (F.col("_kids") >= MIN_CHILDREN) & (F.col("_kids") >= VARIETY * F.col("_urls"))
        g = F.when(wide & (F.col(f"s{i}") != ""), F.lit("*")).otherwise(F.col(f"s{i}"))
        leaf = leaf.join(parents, known).withColumn(f"g{i}", g).drop("_kids", "_urls")
        known.append(f"g{i}")
    leaf = stage(leaf, "url-leaves")

    for d in range(DEPTH + 1):  # counts of the node at each depth
        keys = ["host", *[f"g{i}" for i in range(d)]]
        node = leaf.groupBy(*keys).agg(F.sum("lab").alias(f"lab{d}"), F.sum("bad").alias(f"bad{d}"))
        if d:
            lab = F.col(f"lab{d}")
            rate = F.try_divide(F.col(f"bad{d - 1}"), F.col(f"lab{d - 1}"))
            diff = F.try_divide(F.col(f"bad{d}"), lab) - rate
            own = F.when((lab > 0) & (diff * diff * lab > Z * Z * rate * (1 - rate)), d).otherwise(F.col("level"))
            up = nodes.select(*keys[:-1], f"lab{d - 1}", f"bad{d - 1}", "level", "lab", "bad", "template")
            nodes = node.join(up, keys[:-1]).withColumn("own", own)
            nodes = (
                nodes.withColumn("lab", F.when(F.col("own") == d, F.col(f"lab{d}")).otherwise(F.col("lab")))
                .withColumn("bad", F.when(F.col("own") == d, F.col(f"bad{d}")).otherwise(F.col("bad")))
                .withColumn("template", F.when(F.col("own") == d, F.concat(F.lit("/"), F.concat_ws("/", *keys[1:]))).otherwise(F.col("template")))
                .withColumn("level", F.col("own"))
                .drop("own", f"lab{d - 1}", f"bad{d - 1}")
            )
        else:
            nodes = node.select("host", "lab0", "bad0", F.lit(0).alias("level"), F.col("lab0").alias("lab"), F.col("bad0").alias("bad"), F.lit("/").alias("template"))
    nodes = stage(nodes.drop(f"lab{DEPTH}", f"bad{DEPTH}"), "url-nodes")

    pooled = leaf.groupBy("g0").agg(F.sum("lab").alias("all_lab"), F.sum("bad").alias("all_bad"))
    total = counts.agg((F.coalesce(F.sum("bad"), F.lit(0)) + 1).alias("b"), (F.coalesce(F.sum("lab"), F.lit(0)) + 2).alias("n")).first()
    base = F.lit(float(total.b)) / F.lit(float(total.n))
    wide = (F.col("all_bad") + PRIOR * base) / (F.col("all_lab") + PRIOR)
    purity = (F.col("bad") + PRIOR * wide) / (F.col("lab") + PRIOR)
    judged = nodes.join(pooled, "g0").withColumn("purity", purity)
    return leaf.join(judged, ["host", *[f"g{i}" for i in range(DEPTH)]]).select("host", *names, "template", "purity")


def filter_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES) -> DataFrame:
    """id, host, path, rule, verdict, template, purity of every row."""
    host, path = parse(F.col(url_col).cast("string"))
    urls = pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
    urls = with_rules(urls, rules)
    names = [f"s{i}" for i in range(DEPTH + 1)]
    urls = urls.select("*", *[s.alias(n) for s, n in zip(segments(F.col("path")), names, strict=True)])
    urls = stage(urls, "urls")
    counts = urls.groupBy("host", *names).agg(
        F.count(F.lit(1)).alias("n"),
        F.count("rule_verdict").alias("lab"),
        F.sum((F.coalesce(F.col("rule_verdict"), F.lit("")) == "block").cast("long")).alias("bad"),
    )
    counts = stage(counts, "url-counts")
    out = urls.join(template_verdicts(counts), ["host", *names], "left")
    verdict = F.coalesce(F.col("rule_verdict"), F.when(F.col("purity") >= THRESHOLD, F.lit("block")).otherwise(F.lit("allow")))
    return out.select(id_col, "host", "path", "rule", verdict.alias("verdict"), "template", "purity")


def _sql() -> str:
    rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
    seg = [f"coalesce(segs[{i + 1}], '')" for i in range(DEPTH)]
    seg = [f"CASE WHEN regexp_matches({s}, '[0-9]') THEN '*' ELSE {s} END AS s{i}" for i, s in enumerate(seg)]
    names = ", ".join(f"s{i}" for i in range(DEPTH + 1))
    out = f"""
WITH raw AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), rules(rule_host, prefix, verdict) AS (VALUES {rules}),
urls AS (
  SELECT *, {", ".join(seg)}, CASE WHEN len(segs) > {DEPTH} THEN '**' ELSE '' END AS s{DEPTH}
  FROM (SELECT *, list_filter(string_split(path, '/'), lambda x: x <> '') AS segs,
    (SELECT max(row(length(rule_host || prefix), rule_host || prefix, verdict)) FROM rules
     WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, prefix)) AS best FROM raw)
), t0 AS (
  SELECT host, {names}, count(*) AS n, count(best) AS lab, count(*) FILTER (best[3] = 'block') AS bad
  FROM urls GROUP BY ALL
)"""
    known = "host"
    for i in range(DEPTH):
        out += f""", k{i} AS (
  SELECT {known}, count(DISTINCT s{i}) AS kids, sum(n) AS total FROM t{i} GROUP BY {known}
), t{i + 1} AS (
  SELECT t{i}.*, CASE WHEN kids >= {MIN_CHILDREN} AND kids >= {VARIETY} * total AND s{i} <> '' THEN '*' ELSE s{i} END AS g{i}
  FROM t{i} JOIN k{i} USING ({known})
)"""
        known += f", g{i}"
    out += f", n0 AS (SELECT host, sum(lab) AS lab0, sum(bad) AS bad0, sum(lab) AS lab, sum(bad) AS bad, '/' AS template FROM t{DEPTH} GROUP BY host)"
    for d in range(1, DEPTH + 1):
        keys = ["host", *[f"g{i}" for i in range(d)]]
        up, k = ", ".join(keys[:-1]), ", ".join(keys)
        rate = f"(bad{d - 1} / lab{d - 1})"
        sig = f"(c > 0 AND (b / c - {rate}) * (b / c - {rate}) * c > {Z} * {Z} * {rate} * (1 - {rate}))"
        name = " || '/' || ".join(keys[1:])
        out += f""", n{d} AS (
  SELECT {k}, c AS lab{d}, b AS bad{d}, CASE WHEN {sig} THEN c ELSE lab END AS lab,
    CASE WHEN {sig} THEN b ELSE bad END AS bad, CASE WHEN {sig} THEN '/' || {name} ELSE template END AS template
  FROM (SELECT {k}, CAST(sum(lab) AS DOUBLE) AS c, CAST(sum(bad) AS DOUBLE) AS b FROM t{DEPTH} GROUP BY {k}) JOIN n{d - 1} USING ({up})
)"""
    return out + f""", pooled AS (
  SELECT g0, sum(lab) AS all_lab, sum(bad) AS all_bad FROM t{DEPTH} GROUP BY g0
), base AS (SELECT (sum(bad) + 1.0) / (sum(lab) + 2.0) AS p FROM t0),
judged AS (
  SELECT n.*, (n.bad + {PRIOR} * ((all_bad + {PRIOR} * p) / (all_lab + {PRIOR}))) / (n.lab + {PRIOR}) AS purity
  FROM n{DEPTH} n JOIN pooled USING (g0), base
)
SELECT page_id, u.host, path, best[2] AS rule,
  coalesce(best[3], CASE WHEN purity >= {THRESHOLD} THEN 'block' ELSE 'allow' END) AS verdict, template
FROM urls u JOIN t{DEPTH} t USING (host, {names}) JOIN judged j USING ({known})
"""


ORACLE_SQL = _sql()
