"""Roles and actors: typed domains, pair overlaps, bindings, and joins of call hits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.intervals import longest_run

SYNONYMS = {"pedestrian": "person", "car": "vehicle"}


def type_of(actor_id: str) -> Column:
    """An actor's type by its id's prefix; unknown prefixes are null."""
    p = F.lower(F.split(F.col(actor_id).cast("string"), "_")[0])
    return F.when(p.isin("vehicle", "cyclist"), p).when(p.isin("pedestrian", "person"), "person")


def domain(frames: DataFrame, role_type: str | None, min_frames: int = 1, lane_limit: int | None = 3) -> DataFrame:
    """scene_id, actor_id of the type with a long enough run of frames that are present and in a lane within the limit."""
    d = frames.where("present")
    if role_type is not None:
        d = d.where(F.col("actor_type") == SYNONYMS.get(role_type, role_type))
    if lane_limit is not None:
        d = d.where(F.abs("lane_id") <= lane_limit)
    return longest_run(d.where(F.col("speed").isNotNull()), ["scene_id", "actor_id"]).where(F.col("run") >= min_frames).select("scene_id", "actor_id")


def overlaps(frames: DataFrame, min_frames: int, a_in: DataFrame | None = None, b_in: DataFrame | None = None) -> DataFrame:
    """scene_id, a, b, run: ordered pairs of actors that are present together for enough consecutive frames."""
    f = frames.where("present").select("scene_id", "actor_id", "t")
    a = (f if a_in is None else f.join(a_in, ["scene_id", "actor_id"], "left_semi")).withColumnRenamed("actor_id", "a")
    b = (f if b_in is None else f.join(b_in, ["scene_id", "actor_id"], "left_semi")).withColumnRenamed("actor_id", "b")
    both = a.join(b, ["scene_id", "t"]).where("a <> b")
    return longest_run(both, ["scene_id", "a", "b"]).where(F.col("run") >= min_frames)


def bindings(domains: dict[str, DataFrame], frames: DataFrame, min_frames: int, ego: str, limit: int | None = None) -> DataFrame:
    """scene_id and one column for each role: all assignments of different actors, gated by the ego's overlap with each other role."""
    roles = [ego, *sorted(r for r in domains if r != ego)]
    out = domains[ego].select("scene_id", F.col("actor_id").alias(ego))
    for r in roles[1:]:
        gate = overlaps(frames, min_frames, domains[ego], domains[r]).select("scene_id", F.col("a").alias(ego), F.col("b").alias(r))
        out = out.join(gate, ["scene_id", ego])
        for other in roles[1 : roles.index(r)]:
            out = out.where(F.col(r) != F.col(other))
    if limit is not None:
        from pyspark.sql import Window

        w = Window.partitionBy("scene_id").orderBy(*roles)
        out = out.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= limit).drop("_n")
    return out


def assignments(domains: dict[str, DataFrame], limit: int | None = None) -> DataFrame:
    """scene_id and one column a role: all assignments of different actors, with no condition on when they are there."""
    out = None
    for r, d in domains.items():
        d = d.select("scene_id", F.col("actor_id").alias(r))
        known = [] if out is None else [c for c in out.columns if c != "scene_id"]
        out = d if out is None else out.join(d, "scene_id")
        for o in known:
            out = out.where(F.col(o) != F.col(r))
    if limit is not None:
        from pyspark.sql import Window

        w = Window.partitionBy("scene_id").orderBy(*domains)
        out = out.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= limit).drop("_n")
    return out


def symmetric_lookup(pairs: DataFrame, wanted: DataFrame, value: str) -> DataFrame:
    """wanted (scene_id, t, a, b) with the value of (a, b), or else of (b, a)."""
    v = pairs.select("scene_id", "t", F.col("ego").alias("a"), F.col("npc").alias("b"), F.col(value).alias("_1"))
    r = pairs.select("scene_id", "t", F.col("npc").alias("a"), F.col("ego").alias("b"), F.col(value).alias("_2"))
    return wanted.join(v, ["scene_id", "t", "a", "b"], "left").join(r, ["scene_id", "t", "a", "b"], "left").withColumn(value, F.coalesce("_1", "_2")).drop("_1", "_2")


def combine_calls(calls: list[DataFrame], keep: list[str] = []) -> DataFrame:
    """A natural join of the calls' signals on the scene and the roles they share; the call with the most roles leads (the first of equal ones), and others that share no role with it are any.

    calls: scene_id, the roles, and the columns ``keep``, which get the call's number.
    """
    roles = [[c for c in df.columns if c != "scene_id" and c not in keep] for df in calls]
    order = sorted(range(len(calls)), key=lambda i: -len(roles[i]))
    out, known = None, []
    for i in order:
        df = calls[i].withColumnsRenamed({k: f"{k}_{i}" for k in keep})
        out = df if out is None else out.join(df, ["scene_id", *[r for r in roles[i] if r in known]])
        known += [r for r in roles[i] if r not in known]
    return out.select("scene_id", *known, *[f"{k}_{i}" for i in range(len(calls)) for k in keep])


def equal_windows(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Hits of two calls with the same window, the first of each call and key."""
    first = [x.groupBy(*keys).agg(F.min(F.struct("t0", "t1")).alias(n)) for x, n in ((a, "x"), (b, "y"))]
    return first[0].join(first[1], keys).where("x = y").select(*keys, F.col("x.t0").alias("t0"), F.col("x.t1").alias("t1"))


def equal_windows_by_role(calls: list[DataFrame]) -> DataFrame:
    """Windows (scene_id, t0, t1) that every call has, with the union of the calls' roles; calls that give one role different actors don't meet, and different roles may be one actor."""
    out = calls[0]
    for c in calls[1:]:
        out = out.join(c, [x for x in c.columns if x in out.columns])
    return out.select("scene_id", *[c for c in out.columns if c not in ("scene_id", "t0", "t1")], "t0", "t1")


def overlapping(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """The intervals of a that overlap one of b (closed ends)."""
    o = b.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("t0").alias("_t0"), F.col("t1").alias("_t1"))
    return a.join(o, [F.col(k) == F.col(f"_{k}") for k in keys] + [F.col("t0") <= F.col("_t1"), F.col("_t0") <= F.col("t1")], "left_semi")


def stitch(a: DataFrame, b: DataFrame, keys: list[str], min_gap: int = 0, max_gap: int = 0) -> DataFrame:
    """b follows a: it starts min_gap to max_gap frames behind the frame after a's end."""
    o = b.select(*keys, F.col("t0").alias("u0"), F.col("t1").alias("u1"))
    return a.join(o, keys).where(F.col("u0").between(F.col("t1") + 1 + min_gap, F.col("t1") + 1 + max_gap))


def chain(a: DataFrame, b: DataFrame, keys: list[str], allow_overlap: bool = True) -> DataFrame:
    """b starts at a's end or later (or behind it): [a.t0, b.t1], coalesced."""
    from ..functions.intervals import coalesce_intervals

    o = b.select(*keys, F.col("t0").alias("u0"), F.col("t1").alias("u1"))
    j = a.join(o, keys).where(F.col("u0") >= F.col("t1") + (0 if allow_overlap else 1))
    return coalesce_intervals(j.select(*keys, "t0", F.col("u1").alias("t1")), keys)


def run_intersections(left: DataFrame, right: DataFrame, keys: list[str], least: int) -> DataFrame:
    """Intersections of half-open runs [lo, hi) with at least ``least`` members."""
    r = right.select(*keys, F.col("lo").alias("rlo"), F.col("hi").alias("rhi"))
    j = left.join(r, keys).select(*keys, F.greatest("lo", "rlo").alias("lo"), F.least("hi", "rhi").alias("hi"))
    return j.where(F.col("hi") - F.col("lo") >= least)

