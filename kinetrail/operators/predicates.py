"""Predicates over windows [t0, t1] of an actor or an ordered pair.

A window predicate becomes columns of frames that are computed once, plus a test on the rows of the window's
two ends, so that no window looks at its inner frames:

* endpoint: the test reads values at t0 and t1;
* prefix: running counts or sums, whose difference covers the window;
* run: the end of the run that starts at t0, or the next frame with a property, against t1;
* envelope: the first frame from t0 on that breaks a relation with t0's value, against t1.

``evaluate`` joins the windows with the two rows. Bounds are closed. Unknown never holds.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.intervals import next_true, run_end, running

ACTOR, PAIR = ["scene_id", "actor_id"], ["scene_id", "ego", "npc"]


@dataclass(frozen=True)
class Predicate:
    """columns: name -> (frame column of keys). test: from a(name) at t0 and b(name) at t1, first(name): the value just before t0's running count."""

    name: str
    columns: dict[str, Callable[[list[str]], Column]]
    test: Callable[[Callable[[str], Column], Callable[[str], Column]], Column]
    breaks: dict[str, Column] = field(default_factory=dict)


def between(x: Column, lo: float | None, hi: float | None) -> Column:
    ok = x.isNotNull()
    if lo is not None:
        ok &= x >= lo
    if hi is not None:
        ok &= x <= hi
    return ok


def bounds(value=None, range_=None, tol=0):
    """(lo, hi) of a value with its tolerance, or of a range without one."""
    if range_ is not None:
        return range_
    return (None, None) if value is None else (value - tol, value + tol)


def with_breaks(frames: DataFrame, keys: list[str], conds: dict[str, Column], starts: DataFrame, reach: int | None = None) -> DataFrame:
    """starts (keys, t) with, for each name, the first frame q.t >= t where the condition over columns p.* (there) and q.* (here) isn't surely true.

    reach: frames behind a start that matter. A start then meets only the one or two buckets of so many frames.
    """
    p, q = frames.join(starts.select(*keys, "t").distinct(), [*keys, "t"], "left_semi"), frames
    near = F.col("q.t") >= F.col("p.t")
    on = list(keys)
    if reach is not None:
        width = max(reach, 1)
        p = p.withColumn("_k", F.explode(F.sequence(F.floor(F.col("t") / width), F.floor((F.col("t") + reach) / width))))
        q = q.withColumn("_k", F.floor(F.col("t") / width))
        near &= F.col("q.t") <= F.col("p.t") + reach
        on.append("_k")
    agg = [F.min(F.when(~F.coalesce(c, F.lit(False)), F.col("q.t"))).alias(n) for n, c in conds.items()]
    j = p.alias("p").join(q.alias("q"), [F.col(f"p.{k}") == F.col(f"q.{k}") for k in on] + [near])
    return j.groupBy(*[F.col(f"p.{k}").alias(k) for k in keys], F.col("p.t").alias("t")).agg(*agg)


def evaluate(frames: DataFrame, windows: DataFrame, keys: list[str], predicates: list[Predicate], reach: int | None = None) -> DataFrame:
    """windows with one boolean column for each predicate. reach: t1 - t0 of the longest window, where that is known."""
    cols = {f"{p.name}__{n}": make(keys) for p in predicates for n, make in p.columns.items()}
    f = frames.join(windows.select(*keys).distinct(), keys, "left_semi")
    f = f.withColumns(cols) if cols else f
    breaks = {f"{p.name}__{n}": c for p in predicates for n, c in p.breaks.items()}
    first = f
    if breaks:
        first = f.join(with_breaks(f, keys, breaks, windows.select(*keys, F.col("t0").alias("t")), reach), [*keys, "t"])
    a, b, w = first.alias("a"), f.alias("b"), windows.alias("w")
    j = w.join(a, [F.col(f"w.{k}") == F.col(f"a.{k}") for k in keys] + [F.col("a.t") == F.col("w.t0")]).join(b, [F.col(f"w.{k}") == F.col(f"b.{k}") for k in keys] + [F.col("b.t") == F.col("w.t1")])
    own = {p.name: set(p.columns) | set(p.breaks) for p in predicates}

    def get(side, p):
        return lambda n: F.col("w.t0") if n == "t0" else F.col("w.t1") if n == "t1" else F.col(f"{side}.{p.name}__{n}" if n in own[p.name] else f"{side}.{n}")

    return j.select(*[F.col(f"w.{c}") for c in windows.columns], *[F.coalesce(p.test(get("a", p), get("b", p)), F.lit(False)).alias(p.name) for p in predicates])


def _count(cond: Column, name: str) -> dict:
    """Running count and the frame's own share, whose difference counts a window."""
    return {name: lambda keys: running(cond, keys), f"{name}_own": lambda keys: F.when(cond, 1).otherwise(0)}


def _in(a, b, name: str) -> Column:
    return b(name) - a(name) + a(f"{name}_own")


def _frames(a, b) -> Column:
    return b("t1") - a("t0") + 1


def presence(share: float = 0.9, missing: int = 0) -> Predicate:
    def test(a, b):
        n = _in(a, b, "n")
        return (n >= share * _frames(a, b)) | (_frames(a, b) - n <= missing)

    return Predicate("presence", _count(F.col("present"), "n"), test)


def in_range_always(x: str, lo, hi, name: str = "during", max_false: int = 0) -> Predicate:
    """Every present frame with a value lies in the bounds, and there is one."""
    seen = F.col("present") & F.col(x).isNotNull()
    cols = _count(seen, "seen") | _count(seen & ~between(F.col(x), lo, hi), "bad")
    return Predicate(name, cols, lambda a, b: (_in(a, b, "bad") <= max_false) & (_in(a, b, "seen") > 0))


def in_range_share(x: str, lo, hi, share: float = 0.9, name: str = "coverage") -> Predicate:
    cols = _count(F.col(x).isNotNull(), "seen") | _count(between(F.col(x), lo, hi), "good")
    return Predicate(name, cols, lambda a, b: (_in(a, b, "seen") > 0) & (_in(a, b, "good") >= share * _in(a, b, "seen")))


def value_at(x: str, lo, hi, at: str = "start", name: str | None = None) -> Predicate:
    return Predicate(name or f"{x}_{at}", {}, lambda a, b: between((b if at == "end" else a)(x), lo, hi))


def mean_in_range(x: str, lo, hi, name: str = "mean") -> Predicate:
    cols = {"sum": lambda keys: F.sum(F.coalesce(F.col(x), F.lit(0))).over(_upto(keys)), "sum_own": lambda keys: F.coalesce(F.col(x), F.lit(0))} | _count(F.col(x).isNotNull(), "seen")

    def test(a, b):
        n, total = _in(a, b, "seen"), _in(a, b, "sum")
        return (n > 0) & (total >= lo * n if lo is not None else F.lit(True)) & (total <= hi * n if hi is not None else F.lit(True))

    return Predicate(name, cols, test)


def _upto(keys):
    from pyspark.sql import Window

    return Window.partitionBy(*keys).orderBy("t").rowsBetween(Window.unboundedPreceding, 0)


def change(x: str, lo, hi, name: str = "change") -> Predicate:
    return Predicate(name, {}, lambda a, b: between(b(x) - a(x), lo, hi))


def step_lane(lane: Column, steps: int) -> Column:
    """Lanes are numbered ... -2 -1 1 2 ...: a step skips 0."""
    to = lane + steps
    return F.when((lane < 0) & (to >= 0), to + 1).when((lane > 0) & (to <= 0), to - 1).otherwise(to)


def lane_change(steps: int = 1, side: str | None = None, min_shift: float | None = None, target: int | None = None) -> Predicate:
    """Present at both ends, in lanes that differ; the end lane is ``steps`` to the side (left up, right down), or ``target``."""

    def test(a, b):
        l0, l1 = a("lane_id"), b("lane_id")
        ok = a("present") & b("present") & (l0 != 0) & (l1 != 0) & (l0 != l1)
        if target is not None:
            ok &= l1 == target
        else:
            ends = [step_lane(l0, d * steps) for d in ((1,) if side == "left" else (-1,) if side == "right" else (1, -1) if side is None else ())]
            hit = F.lit(False)
            for e in ends:
                hit = hit | (l1 == e)
            ok &= hit
        return ok if min_shift is None else ok & (F.abs(b("t_lat") - a("t_lat")) >= min_shift)

    return Predicate("change_lane", {}, test)


def lane_change_from(steps: int, side: str) -> Predicate:
    """For an ordered pair: the ego ends in the lane that lies ``steps`` to the side of the npc's lane at the start."""

    def test(a, b):
        l0, base = a("ego_lane_id"), a("npc_lane_id")
        there = step_lane(base, steps if side == "left" else -steps)
        return a("ego_present") & b("ego_present") & (l0 != 0) & (base != 0) & (b("ego_lane_id") == there)

    return Predicate("change_lane", {}, test)


def keep_lane(target: int | None = None, share: float | None = None) -> Predicate:
    """Present on every frame, in t0's lane (or the target). share: on that share of the frames instead, of the target lane, which must be given."""
    if share is not None:
        cols = _count(F.col("present") & (F.col("lane_id") == target), "in")
        return Predicate("keep_lane", cols, lambda a, b: _in(a, b, "in") >= share * _frames(a, b))
    cols = {
        "end": lambda keys: run_end(F.col("present") & F.col("lane_id").isNotNull(), keys),
        "moves": lambda keys: running(F.coalesce(F.col("lane_id") != _before("lane_id", keys), F.lit(False)), keys),
    }

    def test(a, b):
        same = (a("lane_id") == target) if target is not None else F.lit(True)
        return same & (a("end") >= b("t1")) & (b("moves") == a("moves"))

    return Predicate("keep_lane", cols, test)


def _before(x, keys):
    from pyspark.sql import Window

    return F.lag(x).over(Window.partitionBy(*keys).orderBy("t"))


def keep(x: str, tol: float, name: str = "keep") -> Predicate:
    """|x(t) - x(t0)| <= tol on every frame; unknown breaks it."""
    return Predicate(name, {}, lambda a, b: a("stop").isNull() | (a("stop") > b("t1")), {"stop": F.abs(F.col(f"q.{x}") - F.col(f"p.{x}")) <= tol})


def keep_gap(tol: float, gap: str = "ds", label: str = "rel_position") -> Predicate:
    """||gap(t)| - |gap(t0)|| <= tol, on the same side or near zero, with the same label where both are known."""
    g, g0 = F.col(f"q.{gap}"), F.col(f"p.{gap}")
    side = (g * g0 > 0) | ((F.abs(g) <= tol) & (F.abs(g0) <= tol)) | (g == 0) | (g0 == 0)
    lab = (F.col(f"q.{label}") == F.col(f"p.{label}")) | (F.col(f"q.{label}") == "unknown") | (F.col(f"p.{label}") == "unknown")
    return Predicate("keep_gap", {}, lambda a, b: a("stop").isNull() | (a("stop") > b("t1")), {"stop": (F.abs(F.abs(g) - F.abs(g0)) <= tol) & side & lab})


def keep_headway(tol: float, speed: str, least: float, gap: str = "ds") -> Predicate:
    def h(side):
        v = F.col(f"{side}.{speed}")
        return F.when(F.abs(v) >= least, F.abs(F.col(f"{side}.{gap}")) / F.abs(v))

    same = F.signum(F.col(f"q.{gap}")) == F.signum(F.col(f"p.{gap}"))
    return Predicate("keep_headway", {}, lambda a, b: a("stop").isNull() | (a("stop") > b("t1")), {"stop": (F.abs(h("q") - h("p")) <= tol) & same})


def distance_traveled(lo, hi, way: bool = False) -> Predicate:
    """|s(te) - s(t0)| with te the frame behind t1 where there is one, present at both.

    way: where that is unknown, the length of the way along the window's frames up to te, if two at least are known
    (frames from series.with_way).
    """
    from pyspark.sql import Window

    def nxt(x):
        return lambda keys: F.coalesce(F.lead(x).over(Window.partitionBy(*keys).orderBy("t")), F.col(x))

    def last(x):  # the next frame's own value, null too, where there is one
        def make(keys):
            w = Window.partitionBy(*keys).orderBy("t")
            return F.when(F.lead("t").over(w).isNull(), F.col(x)).otherwise(F.lead(x).over(w))

        return make

    if not way:
        return Predicate("distance", {"s_end": nxt("s"), "p_end": nxt("present")}, lambda a, b: a("present") & b("p_end") & between(F.abs(b("s_end") - a("s")), lo, hi))

    def test(a, b):
        direct = F.when(a("present") & b("p_end"), F.abs(b("s_end") - a("s")))
        own = F.when(a("present") & a("x").isNotNull() & a("y").isNotNull(), 1).otherwise(0)
        along = F.when(b("n_end") - a("way_n") + own >= 2, b("way_end") - a("way_next"))
        return between(F.coalesce(direct, along), lo, hi)

    return Predicate("distance", {"s_end": last("s"), "p_end": last("present"), "way_end": last("way"), "n_end": last("way_n")}, test)


def stationary(limit: float, speed: str = "speed") -> Predicate:
    cols = _count(F.col("present"), "seen") | _count(F.col("present") & (F.abs(F.col(speed)) > limit), "bad")
    return Predicate("stationary", cols, lambda a, b: (_in(a, b, "seen") > 0) & (_in(a, b, "bad") == 0))


def until_below(x: str, limit: float, name: str = "until") -> Predicate:
    """Some frame of the window has both actors present and a value under the limit; no edge is asked for."""
    cond = F.col("ego_present") & F.col("npc_present") & F.col(x).isNotNull() & (F.col(x) < limit)
    return Predicate(name, {"next": lambda keys: next_true(cond, keys)}, lambda a, b: a("next") <= b("t1"))


def position(side: str, lo=None, hi=None, tol: float = 50, at: str = "start") -> Predicate:
    """The ego is ahead of the npc ("ahead") or behind it, by a gap in bounds; the ego's lane must be known."""

    def test(a, b):
        r = b if at == "end" else a
        delta = -r("ds")
        ok = (delta > tol) if side == "ahead" else (delta < -tol)
        return ok & r("ego_lane_id").isNotNull() & between(F.abs(delta), lo, hi)

    return Predicate(f"position_{side}_{at}", {}, test)


def lateral(side: str, lo=None, hi=None, at: str = "start", allow_missing: bool = True) -> Predicate:
    def test(a, b):
        r = b if at == "end" else a
        gap = between(F.abs(r("dt")), lo, hi) if lo is not None or hi is not None else F.lit(True)
        return (r("lat_rel") == side) & (F.coalesce(gap | r("dt").isNull(), F.lit(True)) if allow_missing else gap)

    return Predicate(f"lateral_{side}_{at}", {}, test)


def same_lane(at: str = "start") -> Predicate:
    return Predicate(f"same_lane_{at}", {}, lambda a, b: (lambda r: r("ego_lane_id") == r("npc_lane_id"))(b if at == "end" else a))


def same_speed(tol: float, at: str = "start") -> Predicate:
    return Predicate(f"same_speed_{at}", {}, lambda a, b: (lambda r: F.abs(r("ego_speed") - r("npc_speed")) <= tol)(b if at == "end" else a))


def change_gap(side: str, lo, hi, tol: float = 200) -> Predicate:
    """At t1 the npc is where the side says, with the gap in the bounds widened by tol."""

    def test(a, b):
        if side in ("ahead", "behind"):
            gap = b("ds") if side == "ahead" else -b("ds")
            return (b("rel_position") == ("front" if side == "ahead" else "back")) & between(gap, lo - tol, hi + tol)
        return (b("lat_rel") == side) & between(F.abs(b("dt")), lo - tol, hi + tol)

    return Predicate(f"change_gap_{side}", {}, test)


def change_headway(lo, hi, side: str, speed: str, least: float, tol: float) -> Predicate:
    def test(a, b):
        h = F.when(F.abs(b(speed)) >= least, F.abs(b("ds")) / F.abs(b(speed)))
        return (b("rel_position") == ("front" if side == "ahead" else "back")) & between(h, lo - tol, hi + tol)

    return Predicate("change_headway", {}, test)


def assign_position(s: float, t: float | None, ds: float, dt: float) -> Predicate:
    return Predicate("assign_position", {}, lambda a, b: (F.abs(b("s") - s) <= ds) & ((F.abs(b("t_lat") - t) <= dt) if t is not None else F.lit(True)))


def assign_point(x: float, y: float, radius: float) -> Predicate:
    return Predicate("assign_point", {}, lambda a, b: F.hypot(b("x") - x, b("y") - y) <= radius)


def assign_orientation(yaw: float, tol: float = 0.05) -> Predicate:
    from ..functions.series import wrap_angle

    return Predicate("assign_orientation", {}, lambda a, b: F.abs(wrap_angle(b("yaw") - yaw)) <= tol)


def change_acceleration(lo, hi, min_jerk=None, tol: float = 0.2) -> Predicate:
    """accel(t1) in bounds and, if asked, a jerk of at least min_jerk - tol on some frame of the window."""
    cond = F.abs(F.col("jerk")) >= (min_jerk or 0) - tol
    cols = {"next": lambda keys: next_true(cond, keys)} if min_jerk is not None else {}
    return Predicate("change_acceleration", cols, lambda a, b: between(b("accel"), lo, hi) & ((a("next") <= b("t1")) if min_jerk is not None else F.lit(True)))


def moving_across(lo, hi, side: str | None, tol: float, yaw: str = "yaw_delta", rate: str = "t_dot") -> Predicate:
    """Crossing: on every present frame about perpendicular to the lane, with the lateral speed to the side in bounds. Without a side, either way counts."""
    from ..functions.series import yaw_to_perpendicular

    v = F.abs(F.col(rate)) if side is None else F.col(rate) * (1 if side == "left" else -1)
    bad = F.col("present") & ~F.coalesce((yaw_to_perpendicular(F.col(yaw)) <= tol) & between(v, lo, hi), F.lit(False))
    return Predicate("cross", _count(F.col("present"), "seen") | _count(bad, "bad"), lambda a, b: (_in(a, b, "seen") > 0) & (_in(a, b, "bad") == 0))


def moving_along(lo, hi, tol: float, yaw: str = "yaw_delta", rate: str = "s_dot") -> Predicate:
    """Walking: on every present frame about parallel to the lane, with the speed in the lane's direction in bounds (at least 0)."""
    from ..functions.series import yaw_to_parallel

    v = F.col(rate) * F.when(F.col("lane_id") > 0, -1).otherwise(1)
    bad = F.col("present") & ~F.coalesce((yaw_to_parallel(F.col(yaw)) <= tol) & between(v, max(lo or 0, 0), hi), F.lit(False))
    return Predicate("walk", _count(F.col("present"), "seen") | _count(bad, "bad"), lambda a, b: (_in(a, b, "seen") > 0) & (_in(a, b, "bad") == 0))
