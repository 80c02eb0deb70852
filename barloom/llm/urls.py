"""URL verdicts from rules, and from trust propagated over the host graph.

Rules name a host and a path. A rule fits its host and all subdomains if the URL's
path starts with the rule's path; the longest rule that fits decides.

Elsewhere the link graph decides. A host with pages that a rule allows is a trusted
seed, one with pages that a rule blocks a distrusted seed, and one with both is both:
its weight in either walk is the share of its pages that the rules allow or block. Trust
is a personalised PageRank from the trusted seeds along the links between hosts,
distrust one from the blocked seeds against the links' direction, so that it reaches
hosts that link to bad ones. A host is blocked if its distrust is above its trust
and above ``LEAST`` of what an evenly distrusted host would have. The distrust that a
host starts with itself counts in this verdict if most of its pages are blocked: a rule
for some paths of a host doesn't block its other paths.

Links are reduced to weighted host pairs before the first round. Both walks run as
one table keyed by (walk, host); every few rounds it is written to the shared
folder, and the walks end when the ranks rest: when no rank moved by ``REST`` of
what each host of its walk would have if all had the same. What moves shrinks by
``DAMPING`` in each round, so the rounds grow with the logarithm of the number of hosts.
Rank that reaches a host without links leaves the walk. A seed without incoming rank
holds ``1 - DAMPING`` of its weight, with or without links elsewhere.

Defined cases: a null url, or one without ``://``, has an empty host and path, fits
no rule and is allowed unless rules say otherwise; a null html has no links; links
that are relative or stay on their host are no edges; without seeds or links the
method allows; two equally long rules: the one last in text order; repeated rows
return as often as they come; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, discard, stage

DAMPING = 0.85
EVERY = 5
REST = 1e-4
LEAST = 0.1
LINK = r"""(?is)<a\s[^>]*?href\s*=\s*["']?\s*((?:[a-z][a-z0-9+.\-]*:)?//[^"'\s>]+)"""


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return ascii_lower(host)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_table(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """(rule, rule_host, rule_path, rule_verdict) of (verdict, rule) pairs."""
    frame = spark.createDataFrame(rules, "rule_verdict string, rule string")
    host = F.substring_index("rule", "/", 1)
    return frame.select(
        "rule",
        ascii_lower(host).alias("rule_host"),
        F.expr("substring(rule, length(substring_index(rule, '/', 1)) + 1)").alias("rule_path"),
        "rule_verdict",
    )


def fitting_rules(places: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, rule_verdict): the longest rule of each place that has one."""
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."),
    )
    rank = F.struct(
        F.length("rule").alias("length"),
        "rule",
        "rule_verdict",
    )
    return (
        places.select("host", "path", F.explode(suffixes).alias("suffix"))
        .join(rules, (F.col("suffix") == F.col("rule_host")) & F.col("path").startswith(F.col("rule_path")))
        .groupBy("host", "path")
        .agg(F.max(rank).alias("best"))
        .select("host", "path", "best.rule", "best.rule_verdict")
    )


def host_links(pages: DataFrame) -> DataFrame:
    """(src, dst, n): links between different hosts."""
    links = F.explode(F.regexp_extract_all("html", F.lit(LINK), F.lit(1)))
    found = pages.where("html is not null").select(host_of(F.col("url")).alias("src"), links.alias("url"))
    absolute = F.when(F.col("url").startswith("//"), F.concat(F.lit("x:"), "url")).otherwise(F.col("url"))
    return (
        found.select("src", host_of(absolute).alias("dst"))
        .where("src <> '' and dst <> '' and src <> dst")
        .groupBy("src", "dst")
        .agg(F.count("*").alias("n"))
    )


def propagate(seeds: DataFrame, links: DataFrame, damping: float = DAMPING) -> DataFrame:
    """(walk, host, rank) from (walk, host, weight): trust along links, distrust against."""
    both = links.select(F.lit("trust").alias("walk"), F.col("src").alias("host"), F.col("dst").alias("to"), "n")
    both = both.unionByName(
        links.select(F.lit("distrust").alias("walk"), F.col("dst").alias("host"), F.col("src").alias("to"), "n")
    )
    total = both.groupBy("walk", "host").agg(F.sum("n").alias("total"))
    edges = stage(
        both.join(total, ["walk", "host"]).select("walk", "host", "to", (F.col("n") / F.col("total")).alias("share")),
        "edges",
    )
    sums = seeds.groupBy("walk").agg(F.sum("weight").alias("all"))
    own = (1 - damping) * F.col("weight") / F.col("all")
    base = stage(seeds.join(sums, "walk").select("walk", "host", own.alias("rank")), "seeds")
    if not edges.take(1):
        return base
    before = ranks = base
    while True:
        for _ in range(EVERY):
            sent = edges.join(ranks, ["walk", "host"]).select(
                "walk", F.col("to").alias("host"), (damping * F.col("share") * F.col("rank")).alias("rank")
            )
            ranks = base.unionByName(sent).groupBy("walk", "host").agg(F.sum("rank").alias("rank"))
        ranks = stage(ranks, "ranks")
        moved = (
            ranks.unionByName(before.select("walk", "host", (-F.col("rank")).alias("rank")))
            .groupBy("walk", "host")
            .agg(F.abs(F.sum("rank")).alias("moved"))
            .groupBy("walk")
            .agg((F.max("moved") * F.count("*")).alias("moved"))
            .agg(F.max("moved"))
            .first()[0]
        )
        if before is not base:
            discard(before)
        before = ranks
        if moved is None or moved < REST:
            return ranks


def seeds_of(share: DataFrame) -> DataFrame:
    """(walk, host, weight) from pages, allowed and blocked of each host."""
    walks = F.array(
        F.struct(F.lit("trust").alias("walk"), (F.col("allowed") / F.col("pages")).alias("weight")),
        F.struct(F.lit("distrust").alias("walk"), (F.col("blocked") / F.col("pages")).alias("weight")),
    )
    each = share.where("host <> ''").select("host", F.explode(walks).alias("one"))
    return each.select("one.walk", "host", "one.weight").where("weight > 0")


def judge(pages: DataFrame, rules: DataFrame, least: float = LEAST) -> DataFrame:
    """page_id, host, path, rule and verdict of every page, with trust and distrust."""
    url = F.col("url")
    placed = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    places = stage(placed.groupBy("host", "path").agg(F.count("*").alias("pages")), "places")
    ruled = stage(fitting_rules(places, rules), "ruled")
    share = places.join(ruled, ["host", "path"], "left").groupBy("host").agg(
        F.sum("pages").alias("pages"),
        F.sum(F.when(F.col("rule_verdict") == "allow", F.col("pages")).otherwise(0)).alias("allowed"),
        F.sum(F.when(F.col("rule_verdict") == "block", F.col("pages")).otherwise(0)).alias("blocked"),
    )
    seeds = stage(seeds_of(share), "weights")
    ranks = propagate(seeds, host_links(pages))
    some = seeds.where("walk = 'distrust'")
    total = some.agg(F.sum("weight")).first()[0] or 1.0
    own = some.where("weight <= 0.5").select(
        "host", ((1 - DAMPING) / total * F.col("weight")).alias("own")
    )
    hosts = ranks.groupBy("host").agg(
        F.sum(F.when(F.col("walk") == "trust", F.col("rank")).otherwise(0.0)).alias("trust"),
        F.sum(F.when(F.col("walk") == "distrust", F.col("rank")).otherwise(0.0)).alias("distrust"),
    )
    spread = ranks.where("walk = 'distrust'").agg(F.count("*").alias("hosts"))
    even = least / max(1, spread.first()[0])
    sent = F.col("distrust") - F.coalesce("own", F.lit(0.0))
    bad = F.coalesce((sent > F.col("trust")) & (sent > even), F.lit(False))
    hosts = stage(hosts.join(own, "host", "left").withColumn("bad", bad).drop("own"), "hosts")
    return (
        placed.join(ruled, ["host", "path"], "left")
        .join(hosts, "host", "left")
        .select(
            "page_id",
            "host",
            "path",
            "rule",
            F.coalesce("rule_verdict", F.when(F.col("bad"), "block").otherwise("allow")).alias("verdict"),
            F.coalesce("trust", F.lit(0.0)).alias("trust"),
            F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
        )
    )
