"""URL filters: path rules, and PageRank of trust and distrust over the links between hosts.

Pages that a rule allows or blocks are seeds. Trust flows from hosts with allowed pages only, along links; distrust flows from hosts
with mostly blocked pages, against links (who links to blocked hosts is distrusted). Both are personalised PageRanks over
the host graph, in units of seed pages and not as shares of all, so pages elsewhere do not change what a link means. A page without a
rule is blocked if its host's distrust exceeds its trust.

Everything is made of DataFrame functions. Pages are reduced to hosts and distinct host pairs before anything is joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gradlake.llm.common import pick, table
from gradlake.session import discard, materialise

#: verdict, host, path of the rules of the contract. Fixed values.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DAMPING = 0.85
#: Ranks that differ by no more than this part are equal but for rounding.
ROUNDING = 1e-9
#: Rounds between two writes of the ranks to the shared folder, which are also held against each other.
WRITE_EVERY = 5


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null or without ``://``."""
    rest = F.when(url.contains("://"), F.regexp_replace(url, r"(?s)^.*?://", ""))
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def matching_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, null without one; of two equal rules the first listed counts."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, name, start in sorted(rules, key=lambda r: len(r[1] + r[2]), reverse=True)[::-1]:
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        rule, verdict = F.when(fits, F.lit(name + start)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def linked_hosts(html: Column) -> Column:
    """The distinct hosts that a page names in the href attributes of its elements; relative links lead to no other host."""
    links = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(r"""(?i)<[a-z][^<>]*?\shref\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""), 1)
    return F.array_distinct(F.transform(links, lambda h: F.translate(h, UPPER, LOWER)))


def rank_hosts(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, rounds: int | None = None, shares: bool = True) -> DataFrame:
    """Personalised PageRank: ``host`` and ``rank`` of the hosts that rank flows to.

    ``edges`` (``source``, ``target``) are distinct; ``seeds`` have ``host`` and ``weight``, of which each gets its share of the start, or all
    of it without ``shares``: the ranks then add up to the weights, and what stands elsewhere in the graph has no part in them. A host
    without links keeps nothing for others. Ranks of a round are summed per target before they travel. Rounds go on until no new host is
    reached and no rank changes by more than rounding, or for the given number of ``rounds``.
    """
    total = seeds.agg((F.sum("weight") if shares else F.lit(1)).alias("total"))
    start = materialise(seeds.join(F.broadcast(total), how="cross").select("host", (F.col("weight") / F.col("total")).alias("start")), "seeds")
    degrees = edges.groupBy("source").agg(F.count("*").alias("degree"))
    links = materialise(edges.join(degrees, "source").select("source", "target", "degree"), "edges")
    ranks = before = materialise(start.select("host", F.col("start").alias("rank")), "ranks")
    done = 0
    while rounds is None or done < rounds:
        for _ in range(WRITE_EVERY if rounds is None else min(WRITE_EVERY, rounds - done)):
            given = links.join(ranks, F.col("source") == F.col("host")).groupBy(F.col("target").alias("host")).agg(F.sum(F.lit(damping) * F.col("rank") / F.col("degree")).alias("rank"))
            own = start.select("host", (F.lit(1 - damping) * F.col("start")).alias("rank"))
            ranks = given.union(own).groupBy("host").agg(F.sum("rank").alias("rank"))
            done += 1
        ranks = materialise(ranks, "ranks")
        last = before.select(F.col("host").alias("same"), F.col("rank").alias("last"))
        moved = ranks.join(last, F.col("host") == F.col("same"), "left").filter(F.col("last").isNull() | (F.abs(F.col("rank") - F.col("last")) > F.lit(ROUNDING) * F.col("rank")))
        settled = rounds is None and not moved.limit(1).count()
        discard(before)
        before = ranks
        if settled:
            break
    return ranks


def judge_urls(df: DataFrame, id_column: str = "page_id", url: str = "url", html: str = "html", rules=RULES, damping: float = DAMPING, rounds: int | None = None) -> DataFrame:
    """Every page's id, ``host``, ``path``, ``rule`` (null without one) and ``verdict``, with the ``trust`` and ``distrust`` of its host.

    A null or malformed URL has an empty host, fits no rule, and is allowed. A null html holds no links. Repeated rows give
    repeated verdicts and count repeatedly in the share of blocked pages. Other columns are left out.
    """
    pages = pick(df, id=id_column, url=url, html=html)
    host, path = host_and_path(F.col("url"))
    pages = pages.select("id", host.alias("host"), path.alias("path"), "html")
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    judged = pages.select("id", "host", "path", rule.alias("rule"), verdict.alias("own"))
    edges = pages.filter("host <> ''").select(F.col("host").alias("source"), F.explode(linked_hosts(F.col("html"))).alias("target"))
    edges = materialise(edges.filter("target <> '' and source <> target").distinct(), "edges")
    hosts = judged.filter("host <> ''").groupBy("host").agg(
        F.count("*").alias("n"), F.count(F.when(F.col("own") == "allow", 1)).alias("allowed"), F.count(F.when(F.col("own") == "block", 1)).alias("blocked")
    )
    hosts = materialise(hosts, "hosts")
    trust = rank_hosts(edges, hosts.filter("allowed > 0 and blocked = 0").select("host", F.col("allowed").alias("weight")), damping, rounds, shares=False)
    back = edges.select(F.col("target").alias("source"), F.col("source").alias("target"))
    distrust = rank_hosts(back, hosts.filter("2 * blocked > n").select("host", F.col("blocked").alias("weight")), damping, rounds, shares=False)
    scores = hosts.select("host").join(trust.withColumnRenamed("rank", "trust"), "host", "left").join(distrust.withColumnRenamed("rank", "distrust"), "host", "left")
    scores = materialise(scores.select("host", F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust")), "scores")
    bad = F.col("distrust") > F.col("trust") * (1 + ROUNDING)
    found = judged.join(scores, "host", "left")
    return found.select(
        F.col("id").alias(id_column), "host", "path", "rule", F.coalesce("own", F.when(bad, "block").otherwise("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )


def op7_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page."""
    return judge_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")
