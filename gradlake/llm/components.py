"""Linking rows that share a key, and connected components of the links, without listing the pairs of a group."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradlake.session import discard, materialise


def connected(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) for every node of the links ``a``, ``b``.

    Every round hangs the larger neighbours of a node, and then the smaller ones, on its smallest neighbour; the number of rounds
    grows with the logarithm of the longest path. Each round is written to the shared folder, so no lineage piles up.
    """
    current = materialise(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = None
    while True:
        found = tuple(current.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if found == state or not found[0]:
            result = current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(current.select("b", "b").distinct())
            result.written_to = current.written_to
            return result
        state, before = found, current
        both = current.union(current.select("b", "a"))
        smallest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = materialise(both.filter("b > a").join(smallest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "links")
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(smallest, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        current = materialise(small.union(smallest).distinct(), "links")
        discard(before, large)


def link(keyed: DataFrame, similar: Callable[[Column, Column, Column], Column]) -> DataFrame:
    """Components of nodes that share a key and are similar: ``node`` and ``root``, for linked nodes only.

    ``keyed`` has ``key``, ``node`` and ``value``; ``similar(key, value, value)`` tests a pair. First every node is held against one node of each of its keys, another one for each key. That joins dense
    groups without listing their pairs, and settles the keys of two nodes, which most chance meetings are. Then, for keys of three or more,
    only nodes that lie outside the commonest component of a key are held against the others with that key, so no link between
    two components is missed.
    """
    order = F.xxhash64("node", "key")
    hubs = keyed.groupBy("key").agg(F.min_by("node", order).alias("hub"), F.min_by("value", order).alias("hub_value"), F.count("*").alias("n")).filter("n > 1")
    near = (F.col("node") != F.col("hub")) & similar(F.col("key"), F.col("value"), F.col("hub_value"))
    met = materialise(keyed.join(hubs, "key").filter((F.col("n") > 2) | near).withColumn("near", near), "met")
    shared = met.filter("n > 2")

    def distinct(pairs: DataFrame) -> DataFrame:
        return materialise(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")

    first = distinct(met.filter("near").select(F.col("node").alias("a"), F.col("hub").alias("b")))
    roots = connected(first)
    rooted = shared.select("key", "node", "value").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = rooted.groupBy("key", "root").agg(F.count("*").alias("n")).groupBy("key").agg(F.max_by("root", F.struct("n", "root")).alias("common"), F.count("*").alias("roots")).filter("roots > 1")
    rooted = materialise(rooted.join(mixed, "key").select("key", "node", "value", "root", "common"), "rooted")
    left = rooted.filter("root <> common").select("key", F.col("node").alias("a"), F.col("value").alias("x"), F.col("root").alias("p"), "common")
    right = rooted.select("key", F.col("node").alias("b"), F.col("value").alias("y"), F.col("root").alias("q"))
    # a pair of two nodes that both lie outside the commonest component is met twice, once is enough
    across = left.join(right, "key").filter("p <> q and (q = common or a > b)").filter(similar(F.col("key"), F.col("x"), F.col("y")))
    second = distinct(across.select("a", "b"))
    # the components of the first links are stars now, which takes fewer rounds than those links again
    result = connected(roots.toDF("a", "b").union(second))
    discard(met, first, roots, rooted, second)
    return result
