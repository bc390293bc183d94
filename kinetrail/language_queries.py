"""Scenarios written in the language, one for each call and modifier it knows, over the trajectory table, and the same in SQL.

Each asks for windows of 2 to 4 frames; the SQL tests every window on its own frames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .functions import series as S
from .plans import dsl, matcher
from .sources.traj import PAIRS_SQL, RICH_SQL, TRAJ_SQL, rich, traj

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}
#: A frame is a second, a table unit a hundredth; tolerances that suit the table's jumps.
UNITS = matcher.Config(fps=1.0, scale=100.0, tol_gap=100.0, min_ahead=0.5, tol_accel=100.0, tol_keep_speed=60.0, tol_headway=20.0, least_headway_speed=1.0, tol_position=600.0, tol_lateral=0.4, stationary=200.0, tol_speed=20.0)

_ACTOR = f"""with {TRAJ_SQL}, {RICH_SQL}, win as (select a.scene_id, a.actor_id, a.t as t0, b.t as t1 from rich a join rich b on a.actor_id = b.actor_id and b.t between a.t + 1 and a.t + 3 where a.actor_type = 'vehicle'),
 fr as (select w.*, f.t, f.present, f.speed, f.s, f.t_lat, f.lane_id, f.yaw_delta, f.s_dot, f.t_dot, f.accel, f.jerk, a.speed as v0, b.speed as v1, a.s as s0, b.s as s1, a.t_lat as k0, b.t_lat as k1, a.lane_id as l0, b.lane_id as l1,
               a.accel as a0, b.accel as a1, a.yaw as y0, b.yaw as y1, n.s as s2, n.present as p2
        from win w join rich f on f.actor_id = w.actor_id and f.t between w.t0 and w.t1 join rich a on a.actor_id = w.actor_id and a.t = w.t0 join rich b on b.actor_id = w.actor_id and b.t = w.t1
        left join rich n on n.actor_id = w.actor_id and n.t = w.t1 + 1),
 w as (select scene_id, actor_id as a, t0, t1 from fr group by scene_id, actor_id, t0, t1 having bool_and(present) and coalesce({{}}, false))"""
_PAIR = f"""with {TRAJ_SQL}, {PAIRS_SQL}, kinds as (select distinct actor_id, actor_type from traj), own as (select p.* from pairs p join kinds k on k.actor_id = p.ego and k.actor_type = 'vehicle' join kinds m on m.actor_id = p.npc and m.actor_type = 'vehicle'),
 win as (select a.scene_id, a.ego, a.npc, a.t as t0, b.t as t1 from own a join own b on a.ego = b.ego and a.npc = b.npc and b.t between a.t + 1 and a.t + 3),
 fr as (select w.*, f.t, f.ds, f.dt, f.lat_rel, f.rel_position, f.ego_speed, f.npc_speed, f.ego_lane_id, f.npc_lane_id, f.ego_present, f.npc_present, a.ds as ds0, b.ds as ds1, a.dt as dt0, b.dt as dt1, a.rel_position as rp0, b.rel_position as rp1,
               a.lat_rel as lr0, b.lat_rel as lr1, a.ego_lane_id as el0, b.ego_lane_id as el1, a.npc_lane_id as nl0, b.npc_lane_id as nl1, a.ego_speed as ev0, b.ego_speed as ev1, a.npc_speed as nv0, b.npc_speed as nv1
        from win w join own f on f.ego = w.ego and f.npc = w.npc and f.t between w.t0 and w.t1 join own a on a.ego = w.ego and a.npc = w.npc and a.t = w.t0 join own b on b.ego = w.ego and b.npc = w.npc and b.t = w.t1),
 w as (select scene_id, ego as a, npc as b, t0, t1 from fr group by scene_id, ego, npc, t0, t1 having bool_and(ego_present and npc_present) and coalesce({{}}, false))"""
_FIRST = " select scene_id, {}, t0, min(t1) as t1, count(*) as n_windows from {} group by all"


def ttc(pairs: DataFrame) -> DataFrame:
    return pairs.select("scene_id", "ego", "npc", "t", (F.abs("ds") / 1000.0).alias("ttc"))


def program(body: str, roles: str = "a: vehicle") -> dsl.Program:
    lines = "".join(f"    {r.strip()}\n" for r in roles.split(","))
    p = dsl.compile_text(f"scenario top:\n    path: path\n    path.min_lanes(2)\n{lines}    do {body}\n")
    if p.errors:
        raise ValueError("; ".join(p.errors))
    return p


def hits(p: dsl.Program, spark, sf_dir: str) -> dict[str, DataFrame]:
    t = traj(spark, sf_dir)
    return matcher.match(p, rich(t), UNITS, ttc(S.pairs(t)))


def scenario(name: str, call: str, cond: str, *modifiers: str, pair: bool = False) -> None:
    """Registers a scenario of one call of a (with its modifiers), which names b if it is of a pair."""
    with_ = " with:\n" + "".join(f"            {m}\n" for m in modifiers) if modifiers else ""
    p = program(f"parallel(duration: [2s..4s]):\n        a.{call}{with_}", "a: vehicle, b: vehicle" if pair else "a: vehicle")
    QUERIES[name] = lambda spark, sf_dir: next(iter(hits(p, spark, sf_dir).values()))
    ORACLE_SQL[name] = (_PAIR if pair else _ACTOR).format(cond) + _FIRST.format("a, b" if pair else "a", "w")


def every(cond: str) -> str:
    return f"bool_and(coalesce({cond}, false))"


def at(cond: str) -> str:
    return f"any_value({cond})"


scenario("dsl_cross", "cross(path, speed: [0.05mps..1.2mps])", every("abs(abs(yaw_delta + pi() - floor((yaw_delta + pi()) / (2 * pi())) * 2 * pi() - pi()) - pi() / 2) <= 0.4363 and abs(t_dot) between 5 and 120"))
scenario("dsl_cross_left", "cross(speed: [0.05mps..1.2mps], side: left)", every("abs(abs(yaw_delta + pi() - floor((yaw_delta + pi()) / (2 * pi())) * 2 * pi() - pi()) - pi() / 2) <= 0.4363 and t_dot between 5 and 120"))
_PARALLEL = "least(abs(yaw_delta + pi() - floor((yaw_delta + pi()) / (2 * pi())) * 2 * pi() - pi()), pi() - abs(yaw_delta + pi() - floor((yaw_delta + pi()) / (2 * pi())) * 2 * pi() - pi()))"
scenario("dsl_walk", "walk(path, speed: [1mps..300mps])", every(f"{_PARALLEL} <= 0.3491 and s_dot between 100 and 30000"))
scenario("dsl_keep_acceleration", "keep_acceleration()", every("abs(accel - a0) <= 10000"))
scenario("dsl_keep_speed", "keep_speed()", every("abs(speed - v0) <= 6000"))
scenario("dsl_change_acceleration", "change_acceleration(target: [1mpss..200mpss])", at("a1 between 100 and 20000"))
scenario("dsl_change_acceleration_peak", "change_acceleration([1mpss..200mpss], rate_peak: 250mpsss)", f"{at('a1 between 100 and 20000')} and bool_or(abs(jerk) >= 25000 - 10000)")
scenario("dsl_assign_position", "assign_position(position: position_3d(x: 1km, y: 0.5m))", at("sqrt((s1 - 100000.0) ** 2 + (k1 - 50) ** 2) <= 60000"))
scenario("dsl_assign_odr_point", "assign_position(odr_point(road: '1', lane: -1, s: 1km, t: 0.5m))", at("abs(s1 - 100000) <= 60000 and abs(k1 - 50) <= 40"))
scenario("dsl_assign_orientation", "assign_orientation(orientation_3d(yaw: 90deg))", at("abs(y1 - pi() / 2 + pi() - floor((y1 - pi() / 2 + pi()) / (2 * pi())) * 2 * pi() - pi()) <= 0.05"))
scenario("dsl_assign_speed", "assign_speed([10mps..90mps])", at("v1 between 1000 and 9000"))
scenario("dsl_assign_acceleration", "assign_acceleration(acceleration: [10mpss..90mpss])", at("a1 between 1000 and 9000"))
scenario("dsl_follow_lane", "follow_lane(target: -2)", every("lane_id = -2"))
scenario("dsl_remain_stationary", "remain_stationary()", "count(*) filter (where abs(speed) > 20000) = 0")
scenario("dsl_change_lane", "change_lane(1, left)", at("l0 = -2 and l1 = -1 or l0 = -1 and l1 = 1"))
scenario("dsl_change_lane_target", "change_lane(target: -1)", at("l0 <> l1 and l1 = -1"))
scenario("dsl_change_lane_reference", "change_lane(num_of_lanes: 1, side: left, reference: b)", at("el1 = case when nl0 = -1 then 1 else nl0 + 1 end"), pair=True)
scenario("dsl_keep_space_gap", "keep_space_gap(reference: b, direction: longitudinal)", every("abs(abs(ds) - abs(ds0)) <= 10000 and (ds * ds0 > 0 or abs(ds) <= 10000 and abs(ds0) <= 10000 or ds = 0 or ds0 = 0) and rel_position = rp0"), pair=True)
scenario("dsl_keep_space_gap_lateral", "keep_space_gap(b, lateral)", every("abs(abs(dt) - abs(dt0)) <= 10000 and (dt * dt0 > 0 or abs(dt) <= 10000 and abs(dt0) <= 10000 or dt = 0 or dt0 = 0) and lat_rel = lr0"), pair=True)
scenario("dsl_change_space_gap", "change_space_gap([50m..400m], ahead, b)", at("rp1 = 'front' and ds1 between 5000 - 10000 and 40000 + 10000"), pair=True)
scenario("dsl_change_time_headway", "change_time_headway([1s..8s], behind, b)", at("rp1 = 'back' and abs(ev1) >= 100 and abs(ds1) / cast(abs(ev1) as double) between 1 - 20 and 8 + 20"), pair=True)
scenario("dsl_keep_time_headway", "keep_time_headway(b)", every("abs(ego_speed) >= 100 and abs(ev0) >= 100 and abs(abs(ds) / cast(abs(ego_speed) as double) - abs(ds0) / cast(abs(ev0) as double)) <= 20 and sign(ds) = sign(ds0)"), pair=True)
scenario("dsl_yaw", "drive(path)", at("y0 between 1 and 4"), "yaw([1rad..4rad], at: start)")
scenario("dsl_yaw_delta", "drive(path)", every("yaw_delta between 1 and 8"), "yaw_delta(angle: [1rad..8rad])")
scenario("dsl_keep_position", "drive()", every("abs(s - s0) <= 60000 and abs(t_lat - k0) <= 40"), "keep_position()")
scenario("dsl_faster_than", "drive()", every("ego_speed - npc_speed > 1000"), "speed(10mps, faster_than: b)", pair=True)
scenario("dsl_slower_than", "drive()", at("npc_speed - ego_speed > 0"), "speed(slower_than: b, at: end)", pair=True)
ORACLE_SQL["dsl_slower_than"] = _PAIR.format("any_value(nv1 - ev1 > 0)") + _FIRST.format("a, b", "w")
scenario("dsl_speed_same_as", "drive()", at("abs(ev0 - nv0) <= 2000"), "speed(same_as: b, at: start)", pair=True)
scenario("dsl_lane_same_as", "drive()", every("ego_lane_id = npc_lane_id"), "lane(same_as: b)", pair=True)
scenario("dsl_lane_left_of", "drive()", every("ego_lane_id < npc_lane_id"), "lane(left_of: b)", pair=True)
scenario("dsl_lateral", "drive()", at("el1 > nl1 and abs(dt1) between 10 and 60"), "lateral([0.1m..0.6m], side: right, side_of: b, at: end)", pair=True)
scenario("dsl_position_behind", "drive()", at("ds0 > 50 and ds0 between 1000 and 60000"), "position([10m..600m], behind: b)", pair=True)
scenario("dsl_change_speed", "drive()", at("v1 - v0 between 1000 and 30000"), "change_speed([10mps..300mps])")
scenario("dsl_acceleration", "drive()", "sum(accel) >= 100 * count(accel) and sum(accel) <= 20000 * count(accel) and count(accel) > 0", "acceleration([1mpss..200mpss])")
scenario("dsl_acceleration_end", "drive()", at("a1 between -20000 and -100"), "acceleration([-200mpss..-1mpss], at: end)")
scenario("dsl_distance", "drive()", "coalesce(any_value(case when coalesce(p2, true) then abs(coalesce(s2, s1) - s0) end), case when count(*) >= 2 then sum(sqrt(pow(s_dot, 2) + pow(t_dot, 2))) filter (where t > t0) end) between 10000 and 50000", "distance([100m..500m])")
scenario("dsl_modifier_change_lane", "drive()", at("l0 = -1 and l1 = -2 or l0 = 1 and l1 = -1"), "change_lane(side: right)")
scenario("dsl_until", "drive()", "bool_or(abs(ds) / 1000.0 < 5)", "until rise(a.time_to_collision(reference: b) < 5s)", pair=True)


def put(name: str, body: str, sql: str, roles: str = "a: vehicle, b: vehicle", of=None) -> None:
    p = program(body, roles)
    QUERIES[name] = lambda spark, sf_dir: (of or (lambda p, h: next(iter(h.values()))))(p, hits(p, spark, sf_dir))
    ORACLE_SQL[name] = sql


_ALONE = "a: vehicle"
_TWO = _ACTOR.format(every("lane_id = -2")).replace(" w as (", " w1 as (") + ", w2 as (select scene_id, actor_id as a, t0, t1 from fr group by scene_id, actor_id, t0, t1 having bool_and(present) and any_value(v1 between 1000 and 9000))"
put(
    "dsl_one_of",
    """one_of(duration: [2s..4s]):
        a.follow_lane(target: -2)
        a.assign_speed([10mps..90mps])""",
    _TWO + ", w as (select * from w1 union select * from w2)" + _FIRST.format("a", "w"),
    _ALONE,
)
put(
    "dsl_one_of_blocks",
    """one_of:
        parallel(duration: [2s..4s]):
            a.follow_lane(target: -2)
        serial(duration: [2s..4s]):
            a.assign_speed([10mps..90mps])""",
    _TWO + ", w as (select * from w1 union select * from w2)" + _FIRST.format("a", "w"),
    _ALONE,
)
put(
    "jn10_serial_block",
    """serial(duration: [2s..4s]):
        a.follow_lane(target: -2)
        a.assign_speed([10mps..90mps])""",
    _TWO + ", w as (select * from w1 intersect select * from w2)" + _FIRST.format("a", "w"),
    _ALONE,
)
_CHAIN = """serial:
        first: parallel(duration: [2s..4s]):
            a.follow_lane(target: -2)
        second: parallel(duration: [2s..4s]):
            a.assign_speed([10mps..90mps])"""
put(
    "jn14_block_chain",
    _CHAIN,
    _TWO + """, h1 as (select scene_id, a, t0, min(t1) as t1 from w1 group by all), h2 as (select scene_id, a, t0, min(t1) as t1 from w2 group by all), j as (select h1.scene_id, h1.a, h1.t0, h2.t1 from h1 join h2 on h1.scene_id = h2.scene_id and h1.a = h2.a and h2.t0 >= h1.t1),
 m as (select *, max(t1) over (partition by scene_id, a order by t0, t1 rows between unbounded preceding and 1 preceding) as b from j), g as (select *, sum(case when t0 <= b + 1 then 0 else 1 end) over (partition by scene_id, a order by t0, t1 rows between unbounded preceding and current row) as g from m)
 select scene_id, a, min(t0) as t0, max(t1) as t1 from g group by scene_id, a, g""",
    _ALONE,
    lambda p, h: matcher.chained(p, h),
)
put("blk_second_block", _CHAIN, _TWO + _FIRST.format("a", "w2"), _ALONE, lambda p, h: h["second"])


def blk9_compat(spark, sf_dir):
    """As blk_second_block in the mode that loses blocks behind the first: the number of hits by block."""
    p = program(_CHAIN, _ALONE)
    out = None
    for label, h in matcher.match(p, rich(traj(spark, sf_dir)), UNITS, compat=True).items():
        n = h.agg(F.count("*").alias("n")).select(F.lit(label).alias("block"), "n")
        out = n if out is None else out.union(n)
    return out


QUERIES["blk9_compat"] = blk9_compat
ORACLE_SQL["blk9_compat"] = _TWO + " select 'first' as block, count(*) as n from (select distinct scene_id, a, t0 from w1) union all select 'second', 0"
