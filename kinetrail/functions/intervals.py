"""Frame masks, closed intervals [t0, t1] and run lengths, as window and set operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def islands(frames: DataFrame, keys: list[str], t: str = "t") -> DataFrame:
    """keys, t0, t1: the maximal runs of consecutive frames."""
    w = Window.partitionBy(*keys).orderBy(t)
    g = frames.select(*keys, t).distinct().withColumn("_g", F.col(t) - F.row_number().over(w))
    return g.groupBy(*keys, "_g").agg(F.min(t).alias("t0"), F.max(t).alias("t1")).drop("_g")


def coalesce_intervals(iv: DataFrame, keys: list[str], max_gap: int = 0) -> DataFrame:
    """Merges intervals that touch, overlap or lie at most ``max_gap`` frames apart."""
    w = Window.partitionBy(*keys).orderBy("t0", "t1")
    before = F.max("t1").over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = iv.withColumn("_new", F.when(F.col("t0") <= before + 1 + max_gap, 0).otherwise(1))
    g = new.withColumn("_g", F.sum("_new").over(w))
    return g.groupBy(*keys, "_g").agg(F.min("t0").alias("t0"), F.max("t1").alias("t1")).drop("_g")


def interval_frames(iv: DataFrame, keys: list[str]) -> DataFrame:
    """keys, t of every frame that some interval holds."""
    return iv.select(*keys, F.explode(F.sequence("t0", "t1")).alias("t")).distinct()


def union_masks(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    return islands(a.select(*keys, "t").union(b.select(*keys, "t")), keys)


def intersect_masks(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    return islands(a.select(*keys, "t").intersect(b.select(*keys, "t")), keys)


def min_run(iv: DataFrame, least: int) -> DataFrame:
    return iv.where(F.col("t1") - F.col("t0") + 1 >= least)


def longest_run(frames: DataFrame, keys: list[str]) -> DataFrame:
    return islands(frames, keys).groupBy(*keys).agg(F.max(F.col("t1") - F.col("t0") + 1).alias("run"))


def next_true(cond: Column, keys: list[str], t: str = "t") -> Column:
    """The first frame from this one on where ``cond`` holds; null if none does."""
    w = Window.partitionBy(*keys).orderBy(t).rowsBetween(0, Window.unboundedFollowing)
    return F.min(F.when(cond, F.col(t))).over(w)


def run_end(cond: Column, keys: list[str], t: str = "t") -> Column:
    """The last frame of the run of ``cond`` that starts at this frame; this frame minus 1 where it doesn't hold."""
    w = Window.partitionBy(*keys).orderBy(t)
    last = F.max(t).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return F.coalesce(next_true(~F.coalesce(cond, F.lit(False)), keys, t) - 1, last)


def dilate(cond: Column, keys: list[str], slop: int, t: str = "t") -> Column:
    """Whether ``cond`` holds within ``slop`` frames."""
    return F.coalesce(F.max(cond).over(Window.partitionBy(*keys).orderBy(t).rangeBetween(-slop, slop)), F.lit(False))


def running(cond: Column, keys: list[str], t: str = "t") -> Column:
    """How many frames up to this one have ``cond``."""
    return F.sum(F.when(cond, 1).otherwise(0)).over(Window.partitionBy(*keys).orderBy(t).rowsBetween(Window.unboundedPreceding, 0))


def possible_windows(frames: Column, least: int, most: int) -> Column:
    """How many windows of ``least`` to ``most`` frames fit in a run of ``frames``: in closed form."""
    full = F.greatest(frames - most + 1, F.lit(0))  # starts where the longest window fits
    span = most - least + 1
    rest = F.least(frames - least + 1, F.lit(span - 1))
    part = F.when(frames >= most, F.lit(span * (span - 1) // 2)).when(rest > 0, F.floor(rest * (rest + 1) / 2)).otherwise(F.lit(0))
    return (full * span + part).cast("long")
