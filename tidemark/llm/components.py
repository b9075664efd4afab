"""Connected components of links between ids, by rounds of large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _stars(neighbours: DataFrame, large: bool) -> DataFrame:
    """Hang neighbours on the smallest id around: the larger ones of a large star, the smaller ones of a small one."""
    near = neighbours if large else neighbours.where(F.col("v") < F.col("u"))
    least = near.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select(F.col("u").alias("centre"), F.least("u", "m").alias("m"))
    hung = near.join(least, near["u"] == least["centre"])
    moved = hung.where(F.col("v") > F.col("u")) if large else hung
    out = moved.select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        out = out.union(least.select(F.col("centre").alias("u"), F.col("m").alias("v")))
    return out.where("u <> v").groupBy("u", "v").agg(F.lit(1).alias("one")).select("u", "v")


def _print(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """(node, root) for every id of edges (u, v): root is the smallest id of its component.

    A node's links are never gathered into one row, and each round's links are a table in the shared folder. Rounds grow
    with the logarithm of the largest component; two are enough for stars. Loops and repeated links are allowed.
    """
    links = cut(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct())
    seen = _print(links)
    for _ in range(rounds):
        if not seen[0]:
            break
        links = cut(_stars(_both_ways(_stars(_both_ways(links), large=True)), large=False))
        now = _print(links)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("the components did not settle")
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
