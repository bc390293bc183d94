"""A compiled scenario as a DataFrame plan.

A block of calls asks for windows [t0, t1] of admissible length in which every call holds: its conditions at the
start on t0, those at the end on t1, those on all frames in between, and its window predicates. The plan:

1. each role's frames, filtered by its type, with running counts of the frames that break the conditions of
   that role alone (present, its lane, its speed, ...); no other role is needed for that;
2. the frames on which a role may start, and those on which it may end, meet those of the other roles on
   (scene, frame), where the conditions between roles are asked; so a frame that cannot start or end a window
   meets no other;
3. starts meet ends of the same binding by (scene, binding, bucket of frames as wide as the longest window); equal
   counts mean that no frame between breaks a condition;
4. conditions between roles on all frames: running counts over the frames of the bindings that are left;
5. window predicates for each role, or ordered pair of roles, on their distinct windows, as semi-joins;
6. the first end of each start.

Alternatives (one_of) are matched one by one and united. Everything up to the windows has the key (scene, binding).
A call or modifier that the language knows is a condition here, or an error; only those in FREE add none.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.intervals import coalesce_intervals, running
from ..functions.series import along, lateral_relation, pairs as pair_series, with_way
from ..operators import predicates as P
from ..operators.binding import SYNONYMS
from ..operators.windows import first_end, greedy
from ..units import Quantity
from .dsl import Block, Call, Program, Until, roles_of

#: Calls and modifiers that only say what moves, and add no condition.
FREE = {"drive", "move", "along", "along_trajectory", "follow_path", "follow_trajectory", "assign_route", "connect_trailer", "disconnect_trailer"}
VALUES = ["lane_id", "speed", "s", "t_lat", "present", "accel", "x", "y", "yaw", "yaw_delta", "s_dot", "t_dot"]


@dataclass(frozen=True)
class Config:
    """fps: frames a second; scale: table units for one SI unit of length; tolerances in SI."""

    fps: float = 10.0
    scale: float = 1.0
    tol_speed: float = 0.1
    tol_gap: float = 2.0
    min_ahead: float = 0.5
    tol_change_speed: float = 0.3
    tol_keep_speed: float = 0.2
    tol_accel: float = 0.2
    tol_headway: float = 0.3
    least_headway_speed: float = 0.5
    tol_position: float = 1.0
    tol_lateral: float = 0.5
    tol_yaw: float = 0.05
    perpendicular: float = 0.4363
    parallel: float = 0.3491
    stationary: float = 0.15
    default_duration: tuple[float, float] = (1.0, 5.0)
    non_overlapping: bool = False
    duration_policy: str = "prefer_block"


Get = Callable[[str, str], Column]


class Conditions:
    """What calls ask of one role's frames, of two roles' frames, and of windows.

    own[at][role] and between[at]: functions from an accessor (role, column) to a condition; at is start, end or
    during. needs: columns that the frames must have.
    """

    def __init__(self, calls: list[Call], roles: list[str], cfg: Config, way_known: bool = False):
        self.cfg, self.way_known = cfg, way_known
        self.own: dict[str, dict[str, list]] = {at: {r: [] for r in roles} for at in ("start", "end", "during")}
        self.between: dict[str, list[tuple[str, str, Callable[[Get], Column]]]] = {"start": [], "end": [], "during": []}
        self.windows: dict[str, list[P.Predicate]] = {}
        self.pair_windows: dict[tuple[str, str], list[P.Predicate]] = {}
        self.needs: set[str] = {"present"}
        for r in roles:
            self.put(None, [r], lambda g, r=r: g(r, "present"))
        for c in calls:
            self.action(c)
            for name, args, line in c.modifiers:
                self.modifier(c.actor, name, args, line)

    def put(self, at: str | None, roles: list[str], make: Callable[[Get], Column], *needs: str) -> None:
        at = at if at in ("start", "end") else "during"
        self.needs.update(needs)
        if len(set(roles)) == 1:
            self.own[at][roles[0]].append(make)
        else:
            self.between[at].append((roles[0], roles[1], make))

    def window(self, roles: list[str], p: P.Predicate, *needs: str) -> None:
        """A predicate gets a name of its own, as a role may have several of a kind."""
        self.needs.update(needs)
        mine = self.windows.setdefault(roles[0], []) if len(roles) == 1 else self.pair_windows.setdefault((roles[0], roles[1]), [])
        mine.append(replace(p, name=f"{p.name}_{len(mine)}"))

    # calls
    def action(self, c: Call) -> None:
        k, a, r, cfg = self.cfg.scale, c.args, c.actor, self.cfg
        q, other = a.get("target"), a.get("reference")

        def need(*names):
            for n in names:
                if a.get(n) is None:
                    raise ValueError(f"line {c.line}: {c.action} needs {n}")

        if c.action in FREE:
            return
        if c.action == "change_lane":
            n = int(a["num_of_lanes"].lo) if isinstance(a.get("num_of_lanes"), Quantity) else 1
            target = int(q.lo) if isinstance(q, Quantity) else None
            if target is None and a.get("side") not in ("left", "right"):
                raise ValueError(f"line {c.line}: change_lane needs a side, left or right, or a target")
            if target is None and other not in (None, r):
                self.window([r, other], P.lane_change_from(n, a["side"]), "lane_id")
            else:
                self.window([r], P.lane_change(n, a.get("side"), None, target), "lane_id")
        elif c.action == "follow_lane":
            self.window([r], P.keep_lane(int(q.lo) if isinstance(q, Quantity) else None), "lane_id")
        elif c.action == "keep_speed":
            self.window([r], P.keep("speed", cfg.tol_keep_speed * k, "keep_speed"), "speed")
        elif c.action == "keep_acceleration":
            self.window([r], P.keep("accel", cfg.tol_accel * k, "keep_acceleration"), "accel")
        elif c.action == "remain_stationary":
            self.window([r], P.stationary(cfg.stationary * k), "speed")
        elif c.action == "assign_speed":
            need("target")
            self.put("end", [r], lambda g: P.between(g(r, "speed"), *q.bounds(cfg.tol_speed, k)), "speed")
        elif c.action == "assign_acceleration":
            need("target")
            self.put("end", [r], lambda g: P.between(g(r, "accel"), *q.bounds(cfg.tol_accel, k)), "accel")
        elif c.action == "change_acceleration":
            need("target")
            peak = a.get("rate_peak")
            self.window([r], P.change_acceleration(*q.bounds(cfg.tol_accel, k), peak.hi * k if isinstance(peak, Quantity) else None, cfg.tol_accel * k), "accel", *(["jerk"] if peak else []))
        elif c.action == "assign_orientation":
            need("target")
            yaw = q.get("yaw") if isinstance(q, dict) else q
            self.window([r], P.assign_orientation(yaw.lo, cfg.tol_yaw), "yaw")
        elif c.action == "assign_position":
            self.place(c)
        elif c.action == "change_space_gap":
            need("target", "direction", "reference")
            self.window([r, other], P.change_gap(self.way(c), *q.bounds(0, k), cfg.tol_gap * k), "s", "t_lat")
        elif c.action == "keep_space_gap":
            need("reference")
            gap = "dt" if a.get("direction") in ("lateral", "lat", "t") else "ds"
            self.window([r, other], P.keep_gap(cfg.tol_gap * k, gap, "lat_rel" if gap == "dt" else "rel_position"), "s", "t_lat", "lane_id")
        elif c.action == "change_time_headway":
            need("target", "direction", "reference")
            lo, hi = (x * cfg.fps for x in (q.lo, q.hi))
            self.window([r, other], P.change_headway(lo, hi, self.way(c), "ego_speed", cfg.least_headway_speed * k, cfg.tol_headway * cfg.fps), "s", "speed")
        elif c.action == "keep_time_headway":
            need("reference")
            self.window([r, other], P.keep_headway(cfg.tol_headway * cfg.fps, "ego_speed", cfg.least_headway_speed * k), "s", "speed")
        elif c.action in ("cross", "cross_lane", "walk"):
            v = a.get("speed")
            lo, hi = v.bounds(cfg.tol_speed, k) if isinstance(v, Quantity) else (0, None)
            if c.action == "walk":
                self.window([r], P.moving_along(lo, hi, cfg.parallel), "yaw_delta", "s_dot", "lane_id")
            else:
                self.window([r], P.moving_across(lo, hi, a.get("side"), cfg.perpendicular), "yaw_delta", "t_dot")
        else:
            raise ValueError(f"line {c.line}: {c.action} has no plan")

    @staticmethod
    def way(c: Call) -> str:
        if c.args["direction"] not in ("ahead", "behind", "left", "right"):
            raise ValueError(f"line {c.line}: unknown direction {c.args['direction']!r}")
        return c.args["direction"]

    def place(self, c: Call) -> None:
        """assign_position: by x and y, or along and across the road."""
        k, given = self.cfg.scale, [c.args[n] for n in ("position", "odr_point", "route_point") if c.args.get(n) is not None]
        if len(given) != 1 or not isinstance(given[0], dict):
            raise ValueError(f"line {c.line}: assign_position needs one of position, odr_point, route_point")
        at = {n: v.lo * k for n, v in given[0].items() if isinstance(v, Quantity)}
        if "x" in at and "y" in at:
            self.window([c.actor], P.assign_point(at["x"], at["y"], self.cfg.tol_position * k), "x", "y")
        elif "s" in at:
            self.window([c.actor], P.assign_position(at["s"], at.get("t"), self.cfg.tol_position * k, self.cfg.tol_lateral * k), "s", "t_lat")
        else:
            raise ValueError(f"line {c.line}: assign_position needs x and y, or s")

    # modifiers
    def modifier(self, r: str, name: str, a: dict, line: int) -> None:
        k, at, cfg = self.cfg.scale, a.get("at"), self.cfg
        v, other = a.get("value"), a.get("same_as")
        if name == "speed":
            for word, sign in (("faster_than", 1), ("slower_than", -1)):
                if word in a:
                    by = v.lo * k if isinstance(v, Quantity) else 0
                    self.put(at, [r, a[word]], lambda g, o=a[word], sign=sign, by=by: (g(r, "speed") - g(o, "speed")) * sign > by, "speed")
                    return
            if other:
                self.put(at, [r, other], lambda g: F.abs(g(r, "speed") - g(other, "speed")) <= cfg.tol_speed * k, "speed")
            elif isinstance(v, Quantity):
                self.put(at, [r], lambda g: P.between(g(r, "speed"), *v.bounds(cfg.tol_speed, k)), "speed")
        elif name == "position":
            side = "ahead_of" if "ahead_of" in a else "behind"
            o, sign, d = a[side], 1 if side == "ahead_of" else -1, a.get("distance")

            def ok(g):
                delta = (g(r, "s") - g(o, "s")) * sign
                out = (delta > cfg.min_ahead * k) & g(r, "lane_id").isNotNull()
                return out & P.between(delta, *d.bounds(cfg.tol_gap, k)) if isinstance(d, Quantity) else out

            self.put(at or "start", [r, o], ok, "s", "lane_id")
        elif name == "lateral":
            o, side, d = a["side_of"], a.get("side"), a.get("distance")

            def ok(g):
                out = self.side(g, r, o, side)
                if isinstance(d, Quantity):
                    gap = F.abs(g(r, "t_lat") - g(o, "t_lat"))
                    out &= F.coalesce(P.between(gap, *d.bounds(cfg.tol_gap, k)) | gap.isNull(), F.lit(True))
                return out

            self.put(at or "start", [r, o], ok, "lane_id", "t_lat")
        elif name == "lane":
            if other:
                self.put(at, [r, other], lambda g: g(r, "lane_id") == g(other, "lane_id"), "lane_id")
            if "side_of" in a:
                self.put(at, [r, a["side_of"]], lambda g: self.side(g, r, a["side_of"], a.get("side")), "lane_id")
            if isinstance(a.get("lane"), Quantity):
                self.put(at, [r], lambda g: g(r, "lane_id") == int(a["lane"].lo), "lane_id")
        elif name == "change_lane":
            n = a.get("lane")
            steps = range(int(n.lo), int(n.hi) + 1) if isinstance(n, Quantity) else [1]
            ps = [P.lane_change(s, a.get("side")) for s in steps]
            self.window([r], P.Predicate("change_lane", {}, lambda x, y: reduce(lambda u, w: u | w, [p.test(x, y) for p in ps])), "lane_id")
        elif name == "change_speed" and isinstance(v, Quantity):
            self.window([r], P.change("speed", *v.bounds(cfg.tol_change_speed, k), "change_speed"), "speed")
        elif name == "acceleration" and isinstance(v, Quantity):
            lo, hi = v.bounds(0, k)
            if at in ("start", "end"):
                self.put(at, [r], lambda g: P.between(g(r, "accel"), lo, hi), "accel")
            else:
                self.window([r], P.mean_in_range("accel", lo, hi, "acceleration"), "accel")
        elif name in ("yaw", "yaw_delta") and isinstance(v, Quantity):
            self.put(at, [r], lambda g: P.between(g(r, name), *v.bounds(0, 1)), name)
        elif name == "distance" and isinstance(v, Quantity):
            self.window([r], P.distance_traveled(*v.bounds(cfg.tol_gap, k), way=self.way_known), "s")
        elif name == "keep_lane":
            self.window([r], P.keep_lane(), "lane_id")
        elif name == "keep_speed":
            self.window([r], P.keep("speed", cfg.tol_keep_speed * k, "keep_speed"), "speed")
        elif name == "keep_position":
            self.window([r], P.keep("s", cfg.tol_position * k, "keep_s"), "s")
            self.window([r], P.keep("t_lat", cfg.tol_lateral * k, "keep_t"), "t_lat")
        elif name == "until":
            u = a["until"]
            if not isinstance(u, Until):
                raise ValueError(f"line {line}: only a time to collision under a limit can be waited for")
            self.window([r, u.reference], P.until_below("ttc", u.limit.hi), "ttc")
        elif name not in FREE:
            raise ValueError(f"line {line}: {name} has no plan for these arguments")

    @staticmethod
    def side(g: Get, r: str, other: str, side) -> Column:
        """The actor's lane lies on that side of the other's (see lateral_relation)."""
        return lateral_relation(g(r, "lane_id"), g(other, "lane_id")) == (side if isinstance(side, str) else "same")


def _all(conds: list[Column]) -> Column:
    """All hold for sure."""
    return reduce(lambda a, b: a & b, [F.coalesce(c, F.lit(False)) for c in conds], F.lit(True))


def _joint(role: str, name: str) -> Column:
    return F.col(f"{role}__{name}")


def _role_frames(frames: DataFrame, role: str, kind: str | None, con: Conditions) -> DataFrame:
    """scene_id, t, the role, its values, _n (its frames so far) and _b (those so far that break a condition of its own)."""
    f = frames if kind is None else frames.where(F.col("actor_type") == SYNONYMS.get(kind, kind))
    keys = ["scene_id", "actor_id"]
    bad = ~_all([make(lambda _, name: F.col(name)) for make in con.own["during"][role]])
    return f.withColumns({"_bad": bad, "_b": running(bad, keys), "_n": F.row_number().over(along(keys))})


def _ends(frames: dict[str, DataFrame], roles: list[str], at: str, con: Conditions, name: str) -> DataFrame:
    """One row for each frame on which a window of a binding may begin (or end): scene_id, roles, name, and each role's _b and _n."""
    out = None
    for r in roles:
        f = frames[r].where(_all([make(lambda _, n: F.col(n)) for make in con.own[at][r]]) & ~F.col("_bad"))
        have = [v for v in VALUES if v in f.columns]
        f = f.select("scene_id", F.col("t").alias(name), F.col("actor_id").alias(r), *[F.col(v).alias(f"{r}__{v}") for v in [*have, "_b", "_n"]])
        if out is None:
            out = f
        else:
            out = out.join(f, ["scene_id", name])
            for o in roles[: roles.index(r)]:
                out = out.where(F.col(o) != F.col(r))
        known = roles[: roles.index(r) + 1]
        for a, b, make in [*con.between[at], *con.between["during"]]:
            if r in (a, b) and a in known and b in known:
                out = out.where(F.coalesce(make(_joint), F.lit(False)))
    return out.select("scene_id", *roles, name, *[F.col(f"{r}__{v}").alias(f"{r}{v}") for r in roles for v in ("_b", "_n")])


def pair_frames(frames: DataFrame, bindings: DataFrame, ttc: DataFrame | None = None) -> DataFrame:
    """The pair series of ordered pairs (scene_id, ego, npc) on all frames they share; with ttc of a table (scene_id, ego, npc, t, ttc)."""
    one = frames.join(bindings.select("scene_id", F.col("ego").alias("actor_id")).union(bindings.select("scene_id", F.col("npc").alias("actor_id"))).distinct(), ["scene_id", "actor_id"], "left_semi")
    p = pair_series(one).join(bindings.select("scene_id", "ego", "npc").distinct(), ["scene_id", "ego", "npc"], "left_semi")
    return p if ttc is None else p.join(ttc.select("scene_id", "ego", "npc", "t", "ttc"), ["scene_id", "ego", "npc", "t"], "left")


def _during_between(w: DataFrame, frames: DataFrame, keys: list[str], con: Conditions) -> DataFrame:
    """The windows in which no frame breaks a condition between two roles that holds throughout."""
    groups: dict[tuple[str, str], list] = {}
    for a, b, make in con.between["during"]:
        groups.setdefault(tuple(sorted((a, b))), []).append(make)
    for (a, b), makes in groups.items():
        own = w.select("scene_id", F.col(a).alias("ego"), F.col(b).alias("npc")).distinct()
        p = pair_frames(frames, own)
        bad = ~_all([make(lambda r, n: F.col(f"{'ego' if r == a else 'npc'}_{n}")) for make in makes])
        p = p.select("scene_id", F.col("ego").alias(a), F.col("npc").alias(b), "t", running(bad, ["scene_id", "ego", "npc"]).alias("_x"))
        ends = [p.withColumnsRenamed({"t": t, "_x": x}) for t, x in (("t0", "_x0"), ("t1", "_x1"))]
        # t0 itself was asked already, so equal counts mean no break up to t1
        w = w.join(ends[0], ["scene_id", a, b, "t0"]).join(ends[1], ["scene_id", a, b, "t1"]).where("_x0 = _x1").drop("_x0", "_x1")
    return w.select("scene_id", *keys[1:], "t0", "t1")


def call_windows(calls: list[Call], program_roles: dict[str, str | None], frames: DataFrame, cfg: Config, duration: Quantity | None, pairs: DataFrame | None = None) -> DataFrame:
    """scene_id, one column a role, t0, t1 of all windows in which all calls hold at once."""
    roles = roles_of(calls)
    way_known = {"x", "y"} <= set(frames.columns)
    con = Conditions(calls, roles, cfg, way_known)
    lack = sorted(n for n in con.needs if n not in frames.columns and n != "ttc")
    if lack:
        raise ValueError(f"the frames have no {', '.join(lack)}")
    if "ttc" in con.needs and pairs is None:
        raise ValueError("until needs the pairs' times to collision")
    keys = ["scene_id", *roles]
    lo, hi = (duration or Quantity(*cfg.default_duration)).frames(cfg.fps)
    per = {r: _role_frames(frames, r, program_roles.get(r), con) for r in roles}
    s, e = _ends(per, roles, "start", con, "t0"), _ends(per, roles, "end", con, "t1")
    bucket = lambda t: F.floor(t / hi)
    s = s.withColumn("_k", F.explode(F.sequence(bucket(F.col("t0") + lo - 1), bucket(F.col("t0") + hi - 1))))
    e = e.withColumn("_k", bucket(F.col("t1"))).withColumnsRenamed({f"{r}{v}": f"{r}{v}_end" for r in roles for v in ("_b", "_n")})
    j = s.join(e, [*keys, "_k"]).where(F.col("t1").between(F.col("t0") + lo - 1, F.col("t0") + hi - 1))
    for r in roles:  # no broken frame between, and none that is missing
        j = j.where((F.col(f"{r}_b") == F.col(f"{r}_b_end")) & (F.col(f"{r}_n_end") - F.col(f"{r}_n") == F.col("t1") - F.col("t0")))
    w = _during_between(j.select(*keys, "t0", "t1"), frames, keys, con)
    for r, ps in con.windows.items():
        ways = way_known and any("way_end" in p.columns for p in ps)
        w = _holding(w, {r: "actor_id"}, with_way(frames) if ways else frames, P.ACTOR, ps, hi)
    for (a, b), ps in con.pair_windows.items():
        own = w.select("scene_id", F.col(a).alias("ego"), F.col(b).alias("npc")).distinct()
        w = _holding(w, {a: "ego", b: "npc"}, pair_frames(frames, own, pairs), P.PAIR, ps, hi)
    return w


def _holding(w: DataFrame, roles: dict[str, str], frames: DataFrame, keys: list[str], ps: list[P.Predicate], most: int) -> DataFrame:
    """The windows in which the predicates hold for the roles."""
    own = w.select("scene_id", *[F.col(r).alias(k) for r, k in roles.items()], "t0", "t1").distinct()
    ok = P.evaluate(frames, own, keys, ps, most - 1)
    ok = ok.where(_all([F.col(p.name) for p in ps])).select("scene_id", *[F.col(k).alias(r) for r, k in roles.items()], "t0", "t1")
    return w.join(ok, ["scene_id", *roles, "t0", "t1"], "left_semi")


def block_windows(block: Block, program: Program, frames: DataFrame, cfg: Config, pairs: DataFrame | None = None) -> DataFrame:
    """All windows of a block. The calls of a serial or parallel block hold at once; of a one_of block's calls and blocks any one does, and roles that it doesn't name are null."""
    calls = [c for c in block.children if isinstance(c, Call)]
    if block.kind != "one_of":
        return call_windows(calls, program.roles, frames, cfg, block.effective(calls, cfg.duration_policy), pairs)
    out = None
    for child in block.children:
        if isinstance(child, Call):
            one = call_windows([child], program.roles, frames, cfg, block.effective([child], cfg.duration_policy), pairs)
        else:
            one = block_windows(child if child.duration is not None else replace(child, duration=block.duration), program, frames, cfg, pairs)
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out.distinct()


def match_block(block: Block, program: Program, frames: DataFrame, cfg: Config, pairs: DataFrame | None = None) -> DataFrame:
    """scene_id, one column a role, t0, t1 (first end), n_windows: the hits of a block.

    frames: scene_id, actor_id, actor_type, t, present and those of VALUES (and jerk) that the calls ask for, else
    ValueError; with num_lanes, a path's min_lanes is asked of them. pairs (for until): scene_id, ego, npc, t, ttc.
    """
    if program.min_lanes is not None and "num_lanes" in frames.columns:
        frames = frames.where(F.col("num_lanes") >= program.min_lanes)
    w = block_windows(block, program, frames, cfg, pairs)
    keys = [c for c in w.columns if c not in ("t0", "t1")]
    hits = first_end(w, keys)
    return hits.join(greedy(hits, keys), [*keys, "t0", "t1"], "left_semi") if cfg.non_overlapping else hits


def match(program: Program, frames: DataFrame, cfg: Config | None = None, pairs: DataFrame | None = None, compat: bool = False) -> dict[str, DataFrame]:
    """The hits of each block by label.

    compat: as in engines that number a block's calls anew but look them up by their number in the scenario, blocks
    behind the first find no call and have no hits.
    """
    cfg = cfg or Config()
    hits = {b.label: match_block(b, program, frames, cfg, pairs) for b in program.blocks()}
    return {label: df if i == 0 or not compat else df.limit(0) for i, (label, df) in enumerate(hits.items())}


def chained(program: Program, hits: dict[str, DataFrame], allow_overlap: bool = True) -> DataFrame:
    """scene_id, roles, t0, t1 of the blocks in order, each starting at the end of the one before it or later (or behind it); roles that blocks share are the same actors."""
    labels = [b.label for b in program.blocks()]
    out = hits[labels[0]].drop("n_windows")
    for label in labels[1:]:
        b = hits[label].drop("n_windows").withColumnsRenamed({"t0": "u0", "t1": "u1"})
        common = [c for c in out.columns if c in b.columns]
        j = out.join(b, common).where(F.col("u0") >= F.col("t1") + (0 if allow_overlap else 1))
        keys = [*dict.fromkeys(c for c in [*out.columns, *b.columns] if c not in ("t0", "t1", "u0", "u1"))]
        out = coalesce_intervals(j.select(*keys, "t0", F.col("u1").alias("t1")), keys)
    return out
