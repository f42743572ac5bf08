"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendweave.sources.store import materialise


def _mark(edges: DataFrame) -> tuple:
    """Changes if the set of edges does."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node that an edge (u, v) of longs names; the smallest node names the component.

    Each round hangs every node on the smallest node that it or a neighbour knows, which
    takes a number of rounds logarithmic in the number of nodes. A round aggregates before
    its shuffle, and joins a node's neighbours with one row, so that a hot node can be split.
    Rounds are written to the shared folder, so a lost executor costs one round at most.
    Self-loops, repeated edges and null ends have no effect.
    """
    links = edges.where("u <> v").selectExpr("greatest(u, v) AS u", "least(u, v) AS v").distinct()
    links, _ = materialise(links, "links")
    before = None
    while (now := _mark(links)) != before:
        before = now
        both = links.union(links.selectExpr("v AS u", "u AS v"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        # large star: larger neighbours go to the smallest node around
        large = both.where("v > u").join(least, "u").selectExpr("v AS u", "m AS v").distinct()
        # small star: what a node hangs on, and the node itself, go to the smallest of these
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").selectExpr("explode(array(struct(u, m AS v), struct(v AS u, m AS v))) AS e")
        links, _ = materialise(small.select("e.u", "e.v").where("u <> v").distinct(), "links")
    return links.selectExpr("u AS node", "v AS component").union(links.selectExpr("v", "v").distinct())
