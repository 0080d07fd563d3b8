"""Connected components by alternating large-star and small-star, on edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star operation on edges (u, v), u > v: neighbours of each node go to the smallest one.

    large: the larger neighbours of a node; else the smaller ones and the node itself. Minima are combined before the
    shuffle, and the join that brings them back can be split where a node has very many neighbours.
    """
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        found = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        moved = edges.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        found = moved.unionByName(least.select("u", F.col("m").alias("v")))
    return found.filter("u != v").distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether edges (u, v), u > v, are stars already: a larger end has one edge alone, and is no smaller end of another.

    Stars are what both operations leave as they are, so no further round is needed to see that nothing changes.
    """
    end = lambda c, up: edges.select(F.col(c).alias("node"), F.lit(up).alias("up"), F.lit(1 - up).alias("down"))
    ends = end("u", 1).unionByName(end("v", 0)).groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not ends.filter("up > 1 or up = 1 and down = 1").agg(F.count("*")).first()[0]


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """node, label for each node of links (a, b): label is the smallest node of its component.

    Each round is written to the shared folder, so lineage stays short. An empty table gives an empty one; loops and
    repeated links change nothing; nulls are ignored.
    """
    edges = common.written(links.filter("a is not null and b is not null and a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    for done in range(rounds + 1):
        if _settled(edges):
            break
        if done == rounds:
            raise RuntimeError(f"components did not settle in {rounds} rounds")
        step = common.written(_star(_star(edges, True), False))
        common.drop_written(edges)
        edges = step
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())


def grown(labels: DataFrame, links: DataFrame) -> DataFrame:
    """labels (see components) after more links (a, b) came; the stars that labels are stand for all links before.

    Without new links they are labels as they were. Both should be written tables.
    """
    if links.isEmpty():
        return labels
    return components(labels.select(F.col("node").alias("a"), F.col("label").alias("b")).unionByName(links))
