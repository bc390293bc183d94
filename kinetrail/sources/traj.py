"""A trajectory table made from the events table: five users are a scene, a user's events its frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def traj(spark: SparkSession, sf_dir: str) -> DataFrame:
    """scene_id, actor_id, actor_type, t, lane_id, speed, s, t_lat, present; lengths in hundredths."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "user_id",
        (F.row_number().over(w) - 1).cast("long").alias("t"),
        "event_type",
        F.round(F.col("value") * 100).cast("long").alias("speed"),
        F.get_json_object("props", "$.k").cast("int").alias("t_lat"),
    )
    kind = F.col("user_id") % 5
    lane = -(1 + (F.floor(F.col("t") / (6 + kind)) + F.col("user_id")) % 2)
    s = F.sum("speed").over(Window.partitionBy("user_id").orderBy("t").rowsBetween(Window.unboundedPreceding, 0))
    return e.select(
        F.expr("user_id div 5").alias("scene_id"),
        F.col("user_id").alias("actor_id"),
        F.when(kind == 0, "person").when(kind == 1, "cyclist").otherwise("vehicle").alias("actor_type"),
        "t",
        lane.cast("long").alias("lane_id"),
        "speed",
        s.cast("long").alias("s"),
        "t_lat",
        (F.col("event_type") != "error").alias("present"),
    )


#: The same for DuckDB.
TRAJ_SQL = """traj as (
  select user_id // 5 as scene_id, user_id as actor_id,
         case when user_id % 5 = 0 then 'person' when user_id % 5 = 1 then 'cyclist' else 'vehicle' end as actor_type,
         t, cast(-(1 + ((t // (6 + user_id % 5)) + user_id) % 2) as bigint) as lane_id, v_c as speed,
         cast(sum(v_c) over (partition by user_id order by t) as bigint) as s, k as t_lat, event_type <> 'error' as present
  from (select user_id, row_number() over (partition by user_id order by ts, event_id) - 1 as t, event_type,
               cast(round(value * 100) as bigint) as v_c, cast(json_extract_string(props, '$.k') as int) as k from events))"""
PAIRS_SQL = """pairs as (
  select e.scene_id, e.t, e.actor_id as ego, n.actor_id as npc, e.lane_id as ego_lane_id, n.lane_id as npc_lane_id, e.speed as ego_speed, n.speed as npc_speed,
         e.s as ego_s, n.s as npc_s, e.present as ego_present, n.present as npc_present, n.s - e.s as ds, n.t_lat - e.t_lat as dt,
         (n.s - e.s) * (n.s - e.s) + (n.t_lat - e.t_lat) * (n.t_lat - e.t_lat) as rel_distance2,
         case when n.lane_id > e.lane_id then 'right' when n.lane_id < e.lane_id then 'left' when n.lane_id = e.lane_id then 'same' else 'unknown' end as lat_rel,
         case when n.s > e.s then 'front' when n.s <= e.s then 'back' else 'unknown' end as rel_position
  from traj e join traj n on e.scene_id = n.scene_id and e.t = n.t and e.actor_id <> n.actor_id)"""


def rich(frames: DataFrame) -> DataFrame:
    """The trajectory table with x, y, yaw, yaw_delta, s_dot, t_dot, accel and jerk made of its columns."""
    w = Window.partitionBy("actor_id").orderBy("t")
    f = frames.withColumns({
        "x": F.col("s").cast("double"), "y": F.col("t_lat").cast("double"), "yaw": F.col("t_lat") / 10.0, "yaw_delta": F.col("t_lat") / 10.0, "s_dot": F.col("speed"),
        "t_dot": F.col("t_lat") - F.lag("t_lat").over(w), "accel": F.col("speed") - F.lag("speed").over(w),
    })
    return f.withColumn("jerk", F.col("accel") - F.lag("accel").over(w))


def gaps(frames: DataFrame) -> DataFrame:
    """The trajectory table with lanes on both sides of 0 and unknown values: none where the actor is absent, no speed on some frames, no lane on others."""
    lane = F.when((F.col("actor_id") % 2 == 1) != (F.floor(F.col("t") / 10) % 3 == 0), -F.col("lane_id")).otherwise(F.col("lane_id"))
    return frames.withColumns({
        "lane_id": F.when(F.col("present") & (F.col("t") % 13 != 4), lane), "speed": F.when(F.col("present") & (F.col("t") % 11 != 5), F.col("speed")),
        "s": F.when(F.col("present"), F.col("s")), "t_lat": F.when(F.col("present"), F.col("t_lat")),
    })


RICH_SQL = """rich as (select *, accel - lag(accel) over (partition by actor_id order by t) as jerk from (
  select *, cast(s as double) as x, cast(t_lat as double) as y, t_lat / 10.0 as yaw, t_lat / 10.0 as yaw_delta, speed as s_dot,
         t_lat - lag(t_lat) over (partition by actor_id order by t) as t_dot, speed - lag(speed) over (partition by actor_id order by t) as accel from traj))"""
#: traj with gaps: to be put behind a traj named plain.
GAPS_SQL = """traj as (select scene_id, actor_id, actor_type, t, case when present and t % 13 <> 4 then case when (actor_id % 2 = 1) <> ((t // 10) % 3 = 0) then -lane_id else lane_id end end as lane_id,
  case when present and t % 11 <> 5 then speed end as speed, case when present then s end as s, case when present then t_lat end as t_lat, present from plain)"""
