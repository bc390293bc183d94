"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def _large(e: DataFrame) -> DataFrame:
    both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return both.join(low, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small(e: DataFrame) -> DataFrame:
    e = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = e.groupBy("u").agg(F.min("v").alias("m"))
    rest = e.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.union(low.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, scratch: Scratch, name: str = "cc") -> DataFrame:
    """(node, component) of every node with an edge other than to itself; component is its smallest node.

    ``edges`` has two columns of one ordered type. Each round ends in a written table. Only counts come to
    the driver. Large groups meet as minima (combined before the shuffle) and as joins that Spark can split.
    """
    u, v = edges.columns
    e = scratch.keep(edges.select(F.col(u).alias("u"), F.col(v).alias("v")).where("u <> v").distinct(), f"{name}0")
    sign = (F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"))
    before, rows = None, None
    for k in count(1):  # ends, as each round shortens what is left of some path
        e = scratch.keep(_small(_large(e)), f"{name}{k}", rows)
        scratch.drop(f"{name}{k - 1}")
        now = tuple(e.agg(*sign).first())
        rows = now[0]
        if now == before or not now[0]:
            break
        before = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
