"""URL filter by rules and link-graph propagation (operator 6), in DataFrame operations only.

Rules decide the urls they fit. All others are judged by their host: trust
spreads along links from hosts with allowed pages (personalised PageRank),
distrust against the links from hosts with blocked pages (the same on the
reversed edges); a host with more distrust than trust is blocked.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from upswing.llm.common import store

DAMPING = 0.85
TOLERANCE = 1e-6  # what the scores may be away from their limit, all hosts together
#: (rule, verdict); a rule is a host and a path.
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_LINK = r"(?i)href\s*=\s*[\"']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#\"'\s>]+)"


def with_host(pages: DataFrame) -> DataFrame:
    """Adds host (after the first ://, A-Z lower-cased) and path (up to ? or #); both empty without ://."""
    url = F.coalesce(F.col("url"), F.lit(""))
    return pages.withColumn("host", F.translate(F.regexp_extract(url, _URL, 1), _UPPER, _LOWER)).withColumn("path", F.regexp_extract(url, _URL, 2))


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    """(rule, verdict, rule_host, rule_path) from (rule, verdict) pairs; the host ends before the first slash."""
    rows = spark.createDataFrame([tuple(r) for r in rules], "rule string, verdict string")
    return rows.select(
        "rule", "verdict", F.substring_index("rule", "/", 1).alias("rule_host"), F.expr("substring(rule, instr(rule, '/'))").alias("rule_path")
    )


def host_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, rules): those whose host is the host or a domain above it, an array by length of the rule."""
    labels = F.split("host", r"\.")
    above = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    return (
        hosts.select("host", F.explode(above).alias("rule_host"))
        .join(rules, "rule_host")
        .groupBy("host")
        .agg(F.sort_array(F.collect_list(F.struct(F.length("rule").alias("size"), "rule", "verdict", "rule_path")), asc=False).alias("rules"))
    )


def judge_by_rules(pages: DataFrame, by_host: DataFrame) -> DataFrame:
    """Adds rule and rule_verdict of the longest fitting rule (null if none) to rows with host and path."""
    fits = F.filter("rules", lambda r: F.col("path").startswith(r["rule_path"]))
    return pages.join(by_host, "host", "left").withColumn("hit", F.get(fits, F.lit(0))).select(
        *pages.columns, F.col("hit.rule").alias("rule"), F.col("hit.verdict").alias("rule_verdict")
    )


def host_links(pages: DataFrame) -> DataFrame:
    """(src, dst, weight): numbers of pages of a host that link to another host; links inside a host are left out."""
    found = F.array_distinct(F.transform(F.regexp_extract_all("html", F.lit(_LINK), 1), lambda h: F.translate(h, _UPPER, _LOWER)))
    links = pages.where("instr(html, '//') > 0").select(F.col("host").alias("src"), F.explode(found).alias("dst"))
    return links.where("src <> '' and dst <> '' and src <> dst").groupBy("src", "dst").agg(F.count("*").alias("weight"))


def rounds_to(tolerance: float, damping: float = DAMPING) -> int:
    """Rounds after which the scores of any graph are within ``tolerance``: each round shrinks what is left by ``damping``."""
    return max(1, math.ceil(math.log(tolerance) / math.log(damping)))


def personalised_pagerank(edges: DataFrame, seeds: DataFrame, what: str, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """(host, score) by rounds of score = (1 - damping) * seed + damping * what comes in over ``edges`` (src, dst, weight).

    ``seeds`` (host, seed) is scaled to add up to one. What would leave a host
    without edges is lost, as in a walk that ends there. A round that moves the
    scores by m in all leaves at most m * damping / (1 - damping) to come; rounds
    stop when that is below ``tolerance``, which ``rounds_to`` of them reach on
    every graph, cycles included. Only that sum reaches the driver.
    """
    whole = seeds.agg(F.sum("seed").alias("whole"))
    seeds = store(seeds.crossJoin(F.broadcast(whole)).select("host", (F.col("seed") / F.col("whole")).alias("seed")), f"{what}_seeds")  # one row
    out = edges.groupBy("src").agg(F.sum("weight").alias("out"))
    edges = store(edges.join(out, "src").select("src", "dst", (F.col("weight") / F.col("out")).alias("share")), f"{what}_edges")
    scores = seeds.select("host", (F.col("seed") * (1 - damping)).alias("score"))
    if edges.isEmpty():
        return scores
    scores = store(scores, f"{what}_scores")
    for _ in range(rounds_to(tolerance, damping)):
        came = edges.join(scores.withColumnRenamed("host", "src"), "src").select(F.col("dst").alias("host"), (F.col("share") * F.col("score") * damping).alias("s"))
        given = seeds.select("host", (F.col("seed") * (1 - damping)).alias("s"))
        new = came.unionAll(given).groupBy("host").agg(F.sum("s").alias("score"))
        was = scores.select("host", F.col("score").alias("was"))
        new = store(new.join(was, "host", "left").select("host", "score", F.coalesce("was", F.lit(0.0)).alias("was")), f"{what}_scores")
        scores = new.select("host", "score")
        moved = new.agg(F.sum(F.abs(F.col("score") - F.col("was")))).first()[0] or 0.0
        if moved * damping / (1 - damping) < tolerance:
            break
    return scores


def filter_urls(pages: DataFrame, rules=RULES, margin: float = 1.0) -> DataFrame:
    """Judge all ``pages`` (page_id, url, html): page_id, host, path, rule, verdict.

    Null urls and those without :// have an empty host and path, no rule, and are
    allowed. A host is blocked by the method if its distrust is above ``margin``
    times its trust, each as a share of all; equal or no scores allow. Null html
    has no links. Repeated rows are judged alike. Other columns are not read.
    """
    spark = pages.sparkSession
    judged = with_host(pages.select("page_id", "url"))
    hosts = judged.select("host").where("host <> ''").distinct()
    by_host = store(host_rules(hosts, rule_table(spark, rules)), "host_rules")
    judged = judge_by_rules(judged.select("page_id", "host", "path"), by_host)
    edges = store(host_links(with_host(pages.select("url", "html"))), "links")
    verdicts = store(
        judged.where("rule_verdict is not null").groupBy("host").agg(
            F.count(F.when(F.col("rule_verdict") == "allow", 1)).alias("allowed"), F.count(F.when(F.col("rule_verdict") == "block", 1)).alias("blocked")
        ),
        "seeds",
    )
    trust = personalised_pagerank(edges, verdicts.where("allowed > 0").select("host", F.col("allowed").alias("seed")), "trust")
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    distrust = personalised_pagerank(back, verdicts.where("blocked > 0").select("host", F.col("blocked").alias("seed")), "distrust")
    bad = (
        distrust.withColumnRenamed("score", "distrust").join(trust.withColumnRenamed("score", "trust"), "host", "left")
        .where(F.col("distrust") > F.coalesce("trust", F.lit(0.0)) * margin).select("host", F.lit("block").alias("host_verdict"))
    )
    return judged.join(bad, "host", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("rule_verdict", "host_verdict", F.lit("allow")).alias("verdict")
    )
