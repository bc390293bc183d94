"""Series derived along the frames of an actor or an ordered pair. Unknown values are null."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEYS = ["scene_id", "actor_id"]


def along(keys: list[str] = KEYS, t: str = "t"):
    return Window.partitionBy(*keys).orderBy(t)


def known(x: Column) -> Column:
    """NaN as null."""
    return F.when(~F.isnan(x.cast("double")), x)


def central_difference(x: str, keys: list[str] = KEYS, dt: float = 1.0) -> Column:
    """Central in the middle, one-sided at the first and last frame, null next to an unknown value."""
    w = along(keys)
    a, b, c = F.lag(x).over(w), F.col(x), F.lead(x).over(w)
    first, last = F.lag("t").over(w).isNull(), F.lead("t").over(w).isNull()
    return F.when(first & last, None).when(first, (c - b) / dt).when(last, (b - a) / dt).otherwise((c - a) / (2 * dt))


def second_difference(x: str, keys: list[str] = KEYS, dt: float = 1.0) -> Column:
    w = along(keys)
    return (F.lead(x).over(w) - 2 * F.col(x) + F.lag(x).over(w)) / (dt * dt)


def backward_difference(x: str, keys: list[str] = KEYS, fps: float = 1.0) -> Column:
    return (F.col(x) - F.lag(x).over(along(keys))) * fps


def jerk(accel: str = "accel", keys: list[str] = KEYS, fps: float = 1.0) -> Column:
    """Change of acceleration between frames where the actor is present."""
    w = along(keys)
    return F.when(F.col("present") & F.lag("present").over(w), (F.col(accel) - F.lag(accel).over(w)) * fps)


def series_length(lane: Column, s: Column, speed: Column, order: Column, default: int = 91) -> Column:
    """The number of frames of a scene, as an aggregate over its actors' arrays: the longest of lanes and positions, else of the first actor (in order) with speeds, else the default."""
    size = lambda x: F.max(F.when(F.size(x) > 0, F.size(x)))
    return F.coalesce(F.greatest(size(lane), size(s)), F.min_by(F.size(speed), F.when(F.size(speed) > 0, order)), F.lit(default))


def condensed(frames: DataFrame, keys: list[str], where: str, least: int) -> DataFrame:
    """keys, n_frames: the actors with at least so many present frames under a condition."""
    return frames.where(where).groupBy(*keys).agg(F.count_if("present").alias("n_frames")).where(F.col("n_frames") >= least)


def type_counts(frames: DataFrame) -> DataFrame:
    """actor_type, actors."""
    return frames.groupBy("actor_type").agg(F.countDistinct("scene_id", "actor_id").alias("actors"))


def sanity(frames: DataFrame, most: float) -> DataFrame:
    """actor_type, n, s_mismatch, out_of_bounds, worst: how far the way between frames departs from the speed (in units a frame)."""
    d = frames.withColumn("_d", F.col("s") - F.lag("s").over(along()))
    off = F.abs(F.col("_d") - F.col("speed"))
    return d.groupBy("actor_type").agg(F.count("*").alias("n"), F.count_if(off > 0).alias("s_mismatch"), F.count_if((F.col("speed") < 0) | (F.col("speed") > most)).alias("out_of_bounds"), F.max(off).alias("worst"))


def chain_lane_ids(frames: DataFrame, chains: DataFrame, spans: DataFrame) -> DataFrame:
    """frames (scene_id, actor_id, t, lane_id) with osc_lane_id: the lane's id in its chain, by chains (scene_id, lane_id, osc_lane_id); null where there is none, or outside the actor's spans (scene_id, actor_id, valid_start, valid_end)."""
    j = frames.join(chains, ["scene_id", "lane_id"], "left").join(spans, ["scene_id", "actor_id"], "left")
    return j.withColumn("osc_lane_id", F.when(F.col("t").between(F.col("valid_start"), F.col("valid_end")), F.col("osc_lane_id"))).drop("valid_start", "valid_end")


def yaw_or_heading(yaw: str = "yaw", x: str = "x", y: str = "y", keys: list[str] = KEYS) -> Column:
    """The yaw, or where it is unknown the direction from the frame before (on the first frame: to the next)."""
    w = along(keys)
    back = F.atan2(F.col(y) - F.lag(y).over(w), F.col(x) - F.lag(x).over(w))
    ahead = F.atan2(F.lead(y).over(w) - F.col(y), F.lead(x).over(w) - F.col(x))
    return F.coalesce(known(F.col(yaw)), back, ahead)


def with_way(frames: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """frames with way (metres from the first frame on with x and y, along those where the actor is present), way_next (way at the next such frame, this one included) and way_n (such frames so far)."""
    w = along(keys)
    before, upto, on = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    seen = F.coalesce(F.col("present") & known(F.col("x")).isNotNull() & known(F.col("y")).isNotNull(), F.lit(False))
    f = frames.withColumns({"_px": F.last(F.when(seen, F.col("x")), True).over(before), "_py": F.last(F.when(seen, F.col("y")), True).over(before)})
    f = f.withColumn("_step", F.when(seen, F.coalesce(F.hypot(F.col("x") - F.col("_px"), F.col("y") - F.col("_py")), F.lit(0.0))).otherwise(0.0))
    f = f.withColumns({"way": F.sum("_step").over(upto), "way_n": F.sum(F.when(seen, 1).otherwise(0)).over(upto)})
    return f.withColumn("way_next", F.first(F.when(seen, F.col("way")), True).over(on)).drop("_px", "_py", "_step")


def lane_presence(lane: str = "lane_id") -> Column:
    return F.coalesce(F.rint(F.col(lane).cast("double")) != 0, F.lit(False))


def position_presence(s: str = "s") -> Column:
    return F.col(s).isNotNull()


def lateral_relation(npc_lane: Column, ego_lane: Column) -> Column:
    """The larger lane id is "right": with negative ids this is mirrored against the driving direction."""
    return F.when(npc_lane > ego_lane, "right").when(npc_lane < ego_lane, "left").when(npc_lane == ego_lane, "same").otherwise("unknown")


def relation_from_s(npc_s: Column, ego_s: Column) -> Column:
    return F.when(npc_s > ego_s, "front").when(npc_s <= ego_s, "back").otherwise("unknown")


def clean_relation(x: Column) -> Column:
    return F.when(x.isin("front", "back"), x).otherwise("unknown")


def clean_distance(x: Column) -> Column:
    return F.when(x.isNotNull(), F.greatest(x, F.lit(0)))


def clean_ttc(ttc: Column, distance: Column, far: float = 1e8) -> Column:
    """Negative is 0, beyond ``far`` infinite; unknown where the pair has no distance."""
    return F.when(distance.isNull() | ttc.isNull(), None).when(ttc < 0, 0.0).when(ttc > far, float("inf")).otherwise(ttc.cast("double"))


def wrap_angle(x: Column) -> Column:
    return F.pmod(x + math.pi, F.lit(2 * math.pi)) - math.pi


def yaw_to_parallel(yaw: Column) -> Column:
    """Distance to the direction of the road, whichever way."""
    y = F.abs(wrap_angle(yaw))
    return F.least(y, math.pi - y)


def yaw_to_perpendicular(yaw: Column) -> Column:
    return F.abs(F.abs(wrap_angle(yaw)) - math.pi / 2)


def lane_direction(lane: Column) -> Column:
    return F.when(lane < 0, 0.0).when(lane > 0, math.pi)


def headway(gap: Column, speed: Column, least: float) -> Column:
    """Seconds (or frames) of gap at this speed; unknown below ``least``."""
    return F.when(F.abs(speed) >= least, F.abs(gap) / F.abs(speed))


def pairs(frames: DataFrame) -> DataFrame:
    """Ordered pairs of different actors of a scene at a frame: ego_*, npc_*, ds, dt, lat_rel, rel_position, rel_distance2."""
    base = ["scene_id", "t"]
    e = frames.select(*base, *[F.col(c).alias("ego" if c == "actor_id" else f"ego_{c}") for c in frames.columns if c not in base])
    n = frames.select(*base, *[F.col(c).alias("npc" if c == "actor_id" else f"npc_{c}") for c in frames.columns if c not in base])
    p = e.join(n, base).where("ego <> npc")
    ds, dt = F.col("npc_s") - F.col("ego_s"), F.col("npc_t_lat") - F.col("ego_t_lat")
    return p.withColumns({"ds": ds, "dt": dt, "rel_distance2": ds * ds + dt * dt, "lat_rel": lateral_relation(F.col("npc_lane_id"), F.col("ego_lane_id")), "rel_position": relation_from_s(F.col("npc_s"), F.col("ego_s"))})


def encode_sparse(frames: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, intervals, data: runs of known values, closed, and the values one after the other. Keys without any are dropped."""
    v = frames.where(F.col(value).isNotNull())
    if dict(frames.dtypes)[value] == "string":
        v = v.where(~F.col(value).isin("", "unknown"))
    g = v.select(*keys, "t", value).withColumn("_g", F.col("t") - F.row_number().over(Window.partitionBy(*keys).orderBy("t")))
    per = g.groupBy(*keys, "_g").agg(F.min("t").alias("lo"), F.max("t").alias("hi"), F.sort_array(F.collect_list(F.struct("t", value))).alias("v"))
    out = per.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("lo", "hi", "v"))).alias("runs"))
    return out.select(*keys, F.transform("runs", lambda r: F.array(r["lo"], r["hi"])).alias("intervals"), F.flatten(F.transform("runs", lambda r: F.transform(r["v"], lambda x: x[value]))).alias("data"))


def decode_sparse(encoded: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, t, value of an encoded series; data that ends early leaves nulls."""
    t = F.flatten(F.transform("intervals", lambda i: F.sequence(i[0], i[1])))
    return encoded.select(*keys, F.posexplode(t).alias("_i", "t"), "data").select(*keys, "t", F.get("data", F.col("_i")).alias(value))


def pad(values: Column, frames: Column) -> Column:
    """An array cut or filled with nulls to a number of frames."""
    return F.transform(F.sequence(F.lit(0), frames - 1), lambda i: F.get(values, i.cast("int")))
