"""Window search in one call and in blocks of calls."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.intervals import coalesce_intervals, islands, run_end, running


def candidates(frames: DataFrame, keys: list[str], start: str, end: str, during: str, min_len: int, max_len: int | None) -> DataFrame:
    """keys, t0, t1: a start frame, an end frame min_len to max_len frames long behind it, and ``during`` on every frame between.

    frames has a row for every frame of a binding. ``during`` is checked with a running count of the frames
    that break it.
    """
    bad = F.coalesce(~F.expr(during), F.lit(True))
    f = frames.withColumn("_bad", running(bad, keys)).withColumn("_own", F.when(bad, 1).otherwise(0))
    s = f.where(start).select(*keys, F.col("t").alias("t0"), (F.col("_bad") - F.col("_own")).alias("_b0"))
    e = f.where(end).select(*keys, F.col("t").alias("t1"), F.col("_bad").alias("_b1"))
    near = F.col("t1") >= F.col("t0") + min_len - 1
    if max_len is not None:
        near &= F.col("t1") <= F.col("t0") + max_len - 1
    return s.join(e, keys).where(near & (F.col("_b0") == F.col("_b1"))).drop("_b0", "_b1")


def first_end(windows: DataFrame, keys: list[str]) -> DataFrame:
    """The first feasible end for each start, and how many ends there are."""
    return windows.groupBy(*keys, "t0").agg(F.min("t1").alias("t1"), F.count("*").alias("n_windows"))


def end_ranges(windows: DataFrame, keys: list[str]) -> DataFrame:
    """For each start, the runs of feasible ends: t1_lo, t1_hi."""
    w = windows.withColumnRenamed("t0", "start").withColumnRenamed("t1", "t")
    return islands(w, [*keys, "start"]).select(*keys, F.col("start").alias("t0"), F.col("t0").alias("t1_lo"), F.col("t1").alias("t1_hi"))


def greedy(hits: DataFrame, keys: list[str]) -> DataFrame:
    """Hits in order of t0 that don't overlap the last one taken: a fold over a binding's sorted hits."""
    kind = "struct<last:bigint,hits:array<struct<t0:bigint,t1:bigint>>>"
    sorted_ = F.sort_array(F.collect_list(F.struct(F.col("t0").cast("long").alias("t0"), F.col("t1").cast("long").alias("t1"))))
    g = hits.groupBy(*keys).agg(sorted_.alias("_h"))
    fold = F.expr(f"aggregate(_h, cast(struct(-1L, array()) as {kind}), (a, x) -> if(x.t0 > a.last, cast(struct(x.t1, concat(a.hits, array(x))) as {kind}), a)).hits")
    return g.select(*keys, F.explode(fold).alias("h")).select(*keys, "h.t0", "h.t1")


def grown(frames: DataFrame, keys: list[str], check: str | None) -> DataFrame:
    """keys, t0, t1: from each frame on as long as the check holds; without a check to the last frame, whatever else a call asks for."""
    ok = F.expr(check) if check is not None else F.lit(True)
    return frames.select(*keys, F.col("t").alias("t0"), run_end(ok, keys).alias("t1")).where("t1 >= t0")


def first_pair(windows: DataFrame) -> DataFrame:
    """Of windows of pairs (scene_id, ego, npc, t0, t1), for each scene and start the first pair's with its first end."""
    return windows.groupBy("scene_id", "t0").agg(F.min(F.struct("ego", "npc", "t1")).alias("m")).select("scene_id", "m.ego", "m.npc", "t0", "m.t1")


def hit_table(windows: DataFrame, keys: list[str]) -> DataFrame:
    """One row a binding: its first start t0, and t1, the end of that start's first run of ends; n_windows, the ends of that start."""
    first = windows.groupBy(*keys).agg(F.min("t0").alias("t0"))
    w = windows.join(first, [*keys, "t0"])
    run = end_ranges(w, keys).groupBy(*keys, "t0").agg(F.min_by("t1_hi", "t1_lo").alias("t1"))
    return run.join(w.groupBy(*keys, "t0").agg(F.count("*").alias("n_windows")), [*keys, "t0"])


def signals(hits: DataFrame, keys: list[str]) -> DataFrame:
    """What is kept of a call's hits (keys, t0, t1) for a binding: intervals (merged), frames_on, n_hits, and end, the last frame of the hit where there is only one."""
    n = hits.groupBy(*keys).agg(F.count("*").alias("n_hits"), F.max("t1").alias("_last"))
    iv = coalesce_intervals(hits.select(*keys, "t0", "t1"), keys).groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("t0", "t1"))).alias("intervals"), F.sum(F.col("t1") - F.col("t0") + 1).alias("frames_on"))
    return iv.join(n, keys).select(*keys, "intervals", "frames_on", "n_hits", F.when(F.col("n_hits") == 1, F.col("_last")).alias("end"))


def check_statistics(frames: DataFrame, keys: list[str], checks: dict[str, str]) -> DataFrame:
    """keys, check, true_frames, frames, runs of each frame check."""
    out = None
    for name, cond in checks.items():
        hit = F.coalesce(F.expr(cond), F.lit(False))
        rise = frames.withColumn("_h", hit).withColumn("_r", F.col("_h") & ~F.coalesce(F.lag("_h").over(Window.partitionBy(*keys).orderBy("t")), F.lit(False)))
        one = rise.groupBy(*keys).agg(F.sum(F.col("_h").cast("long")).alias("true_frames"), F.count("*").alias("frames"), F.sum(F.col("_r").cast("long")).alias("runs")).withColumn("check", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out.select(*keys, "check", "true_frames", "frames", "runs")


def block_search(masks: DataFrame, ends: DataFrame, keys: list[str], n_calls: int, min_len: int, max_len: int, overlap: str = "start") -> DataFrame:
    """The first window of a parallel block, one row for each binding.

    masks: keys, call, t of the frames each call's hits cover; ends: keys, call, t of its end frames. At t0
    (overlap "start") or at some frame up to the last end (any) all calls hold; t1 is an end of every call,
    min_len to max_len frames long. Columns: t0, t1 (the first such end), n_windows (such ends of that t0),
    t1_greedy (the last of the run of ends from t1 on).
    """
    all_on = masks.groupBy(*keys, "t").agg(F.countDistinct("call").alias("n")).where(F.col("n") == n_calls).select(*keys, "t")
    common = ends.groupBy(*keys, "t").agg(F.countDistinct("call").alias("n")).where(F.col("n") == n_calls).select(*keys, F.col("t").alias("t1"))
    on = all_on.withColumnRenamed("t", "on")
    if overlap == "start":
        starts = on.select(*keys, F.col("on").alias("t0"), F.col("on").alias("need"))
    else:
        any_ = masks.select(*keys, F.col("t").alias("t0")).distinct()
        starts = any_.join(on, keys).where("on >= t0").groupBy(*keys, "t0").agg(F.min("on").alias("need"))
        starts = starts.where(F.col("need") <= F.col("t0") + max_len - 1)
    j = starts.join(common, keys).where(F.col("t1").between(F.greatest(F.col("t0") + min_len - 1, F.col("need")), F.col("t0") + max_len - 1))
    g = j.groupBy(*keys, "t0").agg(F.min("t1").alias("t1"), F.count("*").alias("n_windows"), F.collect_set("t1").alias("_e"))
    best = g.groupBy(*keys).agg(F.min_by(F.struct("t0", "t1", "n_windows", "_e"), "t0").alias("b")).select(*keys, "b.*")
    run = F.aggregate(F.array_sort("_e"), F.lit(-1).cast("long"), lambda a, x: F.when(a < 0, x.cast("long")).when(x == a + 1, x.cast("long")).otherwise(a))
    return best.withColumn("t1_greedy", run).drop("_e")


def one_of(hits: list[DataFrame], keys: list[str]) -> DataFrame:
    """Any of the alternatives: the union of their hits."""
    out = hits[0].select(*keys, "t0", "t1")
    for h in hits[1:]:
        out = out.union(h.select(*keys, "t0", "t1"))
    return out.distinct()

