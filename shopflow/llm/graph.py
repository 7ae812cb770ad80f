"""Connected components of an edge table, by large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopflow.llm.common import materialise


def _least_neighbour(edges: DataFrame, name: str) -> DataFrame:
    """Smallest v of each u; written, so that joining it back is a plain shuffle join
    whose hot nodes Spark can split."""
    return materialise(edges.groupBy("u").agg(F.min("v").alias("m")), name)


def _canonical(edges: DataFrame) -> DataFrame:
    return (edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
            .distinct())


def components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node of its component) for every node of ``edges`` (u, v long).

    Each round links every node's larger neighbours, then its smaller ones, to the
    smallest of them; paths shorten geometrically until only stars are left.
    No node's neighbours meet in one task.  No edges: no rows.
    """
    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    edges = materialise(_canonical(edges), "edges")
    before = mark(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _least_neighbour(both, "large-star")
        large = materialise(_canonical(
            both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))), "edges")
        least = _least_neighbour(large, "small-star")
        edges = materialise(_canonical(
            large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v")))), "edges")
        after = mark(edges)
        if after == before:
            break
        before = after
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))
