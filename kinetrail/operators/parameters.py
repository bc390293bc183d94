"""Parameters of found windows: which ones a scenario's calls name, their values, and how they are distributed."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..units import Quantity

#: Fixed value: bins of a parameter that has a range.
BINS = 20


@dataclass(frozen=True)
class Parameter:
    """A quantity that a call bounds: of a role (and another), at the start, the end or the middle of a window; lo and hi in SI."""

    name: str
    actor: str
    other: str | None
    quantity: str  # speed, distance, lane
    at: str
    lo: float
    hi: float
    bins: int


def parameters_of(calls: list[dict]) -> list[Parameter]:
    """The parameters of a flat call list; of two with one name the later holds. Only ranges count, and lanes given by number."""
    found: dict[str, Parameter] = {}
    for call in calls:
        for m in call["modifiers"]:
            args, actor = m["args"], call["actor"]
            at = args.get("at")
            end = f"_{at}" if at else ""
            other = args.get("ahead_of") or args.get("behind")
            ranged = next((q for q in (args.get("value"), args.get("distance")) if isinstance(q, Quantity) and not q.single), None)
            p = None
            if m["name"] == "speed" and ranged:
                p = Parameter(f"{actor}_speed{end}", actor, None, "speed", at or "middle", ranged.lo, ranged.hi, BINS)
            elif m["name"] == "position" and ranged and other:
                p = Parameter(f"{actor}_distance_to_{other}{end}", actor, other, "distance", at or "middle", ranged.lo, ranged.hi, BINS)
            elif m["name"] == "lane" and isinstance(args.get("lane"), Quantity) and not args.get("same_as"):
                lane = args["lane"].lo
                p = Parameter(f"{actor}_lane{end}", actor, None, "lane", at or "middle", lane - 0.5, lane + 0.5, 2 * abs(int(lane)) + 1)
            if p:
                found[p.name] = p
    return list(found.values())


def window_parameters(windows: DataFrame, frames: DataFrame, parameters: list[Parameter]) -> DataFrame:
    """scene_id, t0, t1, the roles, name, value: a row for each window (scene_id, roles, t0, t1) and parameter with a known value.

    A window becomes one row a parameter, which meets the actor's frame and the other's by key.
    """
    roles = list(dict.fromkeys(r for p in parameters for r in (p.actor, p.other) if r))
    when = {"start": F.col("t0"), "end": F.col("t1"), "middle": F.expr("(t0 + t1) div 2")}
    of = lambda p: F.struct(F.lit(p.name).alias("name"), F.lit(p.quantity).alias("quantity"), when[p.at].alias("t"), F.col(p.actor).alias("a"), (F.col(p.other) if p.other else F.lit(None).cast("long")).alias("b"))
    asked = windows.select("scene_id", "t0", "t1", *roles, F.explode(F.array(*map(of, parameters))).alias("p")).select("scene_id", "t0", "t1", *roles, "p.*")
    own = frames.select("scene_id", "t", F.col("actor_id").alias("a"), F.col("speed").cast("double").alias("speed"), F.col("lane_id").cast("double").alias("lane"), F.col("s").alias("s1"), F.col("t_lat").alias("l1"))
    far = frames.select("scene_id", "t", F.col("actor_id").alias("b"), F.col("s").alias("s2"), F.col("t_lat").alias("l2"))
    j = asked.join(own, ["scene_id", "t", "a"]).join(far, ["scene_id", "t", "b"], "left")
    gap = F.hypot((F.col("s2") - F.col("s1")).cast("double"), (F.col("l2") - F.col("l1")).cast("double"))
    value = F.when(F.col("quantity") == "speed", F.col("speed")).when(F.col("quantity") == "lane", F.col("lane")).otherwise(gap)
    return j.select("scene_id", "t0", "t1", *roles, "name", value.alias("value")).where("value is not null and not isnan(value) and abs(value) <> double('infinity')")


def parameter_histograms(values: DataFrame, parameters: list[Parameter], scale: float = 1.0) -> DataFrame:
    """name, bin, n over each parameter's range; bin -1 holds what lies outside. scale: table units for one SI unit (lanes have none)."""
    b = F.lit(-1)
    for p in parameters:
        k = 1.0 if p.quantity == "lane" else scale
        lo, hi = p.lo * k, p.hi * k
        inside = (F.col("name") == p.name) & (F.col("value") >= lo) & (F.col("value") < hi)
        b = F.when(inside, F.floor((F.col("value") - lo) * p.bins / (hi - lo)).cast("int")).otherwise(b)
    return values.groupBy("name", b.alias("bin")).agg(F.count("*").alias("n"))


def start_distributions(hits: DataFrame, frames: DataFrame, roles: list[str], role: str, value: str, width: float, least: int, most: int) -> DataFrame:
    """bin, hit, base: a role's value at the start of the hit windows and of all admissible windows of the bindings with hits.

    Both are whole counts, not samples. Windows are not made: a frame stands for the windows that start there
    (least(most, length - t) - least + 1 of a scene), and bindings are counted by role before they meet frames.
    """
    scene = frames.groupBy("scene_id").agg((F.max("t") + 1).alias("length"))
    hit = hits.groupBy("scene_id", F.col(role).alias("actor_id"), F.col("t0").alias("t")).agg(F.sum("n_windows").alias("hit"))
    bound = hits.select("scene_id", *roles).distinct().groupBy("scene_id", F.col(role).alias("actor_id")).agg(F.count("*").alias("bindings"))
    f = frames.select("scene_id", "actor_id", "t", F.col(value).cast("double").alias("x")).where("x is not null")
    j = f.join(bound, ["scene_id", "actor_id"]).join(scene, "scene_id").join(hit, ["scene_id", "actor_id", "t"], "left")
    from_here = F.greatest(F.lit(0), F.least(F.lit(most), F.col("length") - F.col("t")) - least + 1)
    g = j.groupBy(F.floor(F.col("x") / width).cast("long").alias("bin")).agg(F.sum(F.coalesce("hit", F.lit(0))).alias("hit"), F.sum(from_here * F.col("bindings")).alias("base"))
    return g.where("hit > 0 or base > 0")


def actors_in_segments(frames: DataFrame, segment_lanes: DataFrame) -> DataFrame:
    """scene_id, segment_id, actor_id, n_frames: present frames of an actor on a lane of a segment (scene_id, segment_id, lane_id)."""
    lanes = segment_lanes.select("scene_id", "segment_id", "lane_id").distinct()
    on = frames.where("present").groupBy("scene_id", "actor_id", "lane_id").agg(F.count("*").alias("n"))
    return on.join(lanes, ["scene_id", "lane_id"]).groupBy("scene_id", "segment_id", "actor_id").agg(F.sum("n").alias("n_frames"))
