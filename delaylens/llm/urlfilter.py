"""URL filtering by rules and by trust that flows along the link graph.

Built-in functions only. A rule names a host (with all its subdomains) and the
start of a path; the longest that fits decides. Where none fits, the host
decides: hosts whose pages rules allow are trusted seeds, those whose pages rules
block are distrusted ones, by the share of their pages. Trust follows links
(personalised PageRank from the trusted seeds), distrust goes back along them
(from the blocked seeds over reversed links). What a host gets of another's
distrust is the share of its own links that go there, so it doesn't matter how
many others link there too. A host is blocked when its distrust exceeds its trust
by more than a threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from delaylens.llm.decontaminate import LOWER, UPPER
from delaylens.session import stage

DAMPING = 0.85
ROUNDS = 15
#: Distrust over trust that blocks a host, as a share of a full seed's own.
THRESHOLD = 0.5
AFTER_SCHEME = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: Hosts of absolute and scheme-relative links.
LINK_HOST = r"""(?i)(?:href|src)\s*=\s*["']?\s*(?:[a-z][a-z0-9+.\-]*:)?//([^/?#"'\s<>]+)"""


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def host(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, AFTER_SCHEME, 1)), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, AFTER_SCHEME, 2), F.lit(""))


def suffixes(host_column: Column) -> Column:
    """The host itself and every domain above it."""
    labels = F.split(host_column, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat_ws(".", F.slice(labels, i, F.size(labels))))


def rule_table(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """(verdict, rule) pairs as a table; a rule is host + path."""
    rows = [(verdict, rule, *rule.split("/", 1)) for verdict, rule in rules]
    table = spark.createDataFrame(rows, "rule_verdict string, rule string, rule_host string, rest string")
    return table.select("rule_verdict", "rule", "rule_host", F.concat(F.lit("/"), "rest").alias("rule_path"))


def rules_of_hosts(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, rules): each host's rules, longest first, equal lengths by text."""
    at = hosts.select("host", F.explode(suffixes(F.col("host"))).alias("rule_host"))
    entry = F.struct((-F.length("rule")).alias("order"), "rule", "rule_path", "rule_verdict")
    return at.join(rules, "rule_host").groupBy("host").agg(F.array_sort(F.collect_set(entry)).alias("rules"))


def host_edges(pages: DataFrame) -> DataFrame:
    """(source, target, weight): pages of `source` that link to another host."""
    targets = F.array_distinct(F.transform(F.regexp_extract_all("html", F.lit(LINK_HOST), F.lit(1)), ascii_lower))
    linked = pages.select(F.col("host").alias("source"), F.explode(targets).alias("target"))
    return linked.where("source <> target and source <> ''").groupBy("source", "target").agg(F.count("*").cast("double").alias("weight"))


def propagate(seeds: DataFrame, edges: DataFrame, rounds: int = ROUNDS, damping: float = DAMPING, by_own_links: bool = False) -> DataFrame:
    """(host, trust, distrust) from seeds(host, trust, distrust): each round a
    host keeps (1 - damping) of its seed and gets damping of what its neighbours
    spread over their links, trust forwards and distrust backwards. Distrust is
    split over the hosts that link to the distrusted one, or `by_own_links` each
    of them gets it whole times the share of its own links that go there. Every
    round is written to the shared folder. Hosts that nothing reaches are left out."""
    own = seeds.select("host", F.explode(F.map_from_arrays(F.array(F.lit("trust"), F.lit("distrust")), F.array("trust", "distrust"))).alias("kind", "value"))
    own = stage(own.where("value > 0").withColumn("value", F.col("value") * (1 - damping)), "seeds")
    both = edges.select(F.lit("trust").alias("kind"), "source", "target", F.col("source").alias("of"), "weight").union(
        edges.select(F.lit("distrust"), F.col("target"), F.col("source"), F.col("source" if by_own_links else "target"), "weight")
    )
    out = both.groupBy("kind", "of").agg(F.sum("weight").alias("total"))
    share = stage(both.join(out, ["kind", "of"]).select("kind", "source", "target", (F.col("weight") / F.col("total") * damping).alias("share")), "shares")
    rank = own
    for _ in range(0 if share.isEmpty() else rounds):
        flow = share.join(rank.withColumnRenamed("host", "source"), ["kind", "source"]).select(F.col("target").alias("host"), "kind", (F.col("share") * F.col("value")).alias("value"))
        rank = stage(own.unionByName(flow).groupBy("host", "kind").agg(F.sum("value").alias("value")), "ranks")

    def of(kind: str) -> Column:
        return F.sum(F.when(F.col("kind") == kind, F.col("value")).otherwise(0.0)).alias(kind)

    return rank.groupBy("host").agg(of("trust"), of("distrust"))


def judge(pages: DataFrame, rules: list[tuple[str, str]], key: str, url: str, html: str, threshold: float = THRESHOLD, rounds: int = ROUNDS) -> DataFrame:
    """Per row: key, host, path, rule, verdict.

    Null urls and urls without `://` have empty host and path and no rule; a host
    without seeds or links (also the empty one) is allowed. Without rules every
    page is allowed. Null pages link to nothing. Repeated rows stay, and count as
    pages. Other columns are not read."""
    spark = pages.sparkSession
    parsed = pages.select(key, host(F.col(url)).alias("host"), path(F.col(url)).alias("path"))
    of_host = rules_of_hosts(parsed.select("host").distinct(), rule_table(spark, rules))
    fitting = F.get(F.filter("rules", lambda r: F.col("path").startswith(r["rule_path"])), F.lit(0))
    ruled = stage(parsed.join(of_host, "host", "left").withColumn("found", fitting).select(key, "host", "path", F.col("found.rule").alias("rule"), F.col("found.rule_verdict").alias("verdict")), "ruled")

    def part(verdict: str) -> Column:
        return F.avg(F.when(F.col("verdict") == verdict, 1.0).otherwise(0.0))

    seeds = ruled.where("host <> ''").groupBy("host").agg(part("allow").alias("trust"), part("block").alias("distrust"))
    edges = host_edges(pages.select(host(F.col(url)).alias("host"), F.col(html).alias("html")))
    ranks = propagate(seeds, edges, rounds, by_own_links=True)
    blocked = ranks.where(F.col("distrust") - F.col("trust") > threshold * (1 - DAMPING)).select("host", F.lit("block").alias("of_host"))
    final = F.coalesce("verdict", "of_host", F.lit("allow")).alias("verdict")
    return ruled.join(blocked, "host", "left").select(key, "host", "path", "rule", final)
