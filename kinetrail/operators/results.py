"""Result tables: hits, the actors' values and the pairs' values at the ends of each hit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HIT_KEYS = ["scene_id", "hit_id", "t0", "t1"]


def finite(x: Column) -> Column:
    """NaN and infinities are null in result tables."""
    d = x.cast("double")
    return F.when(~F.isnan(d) & (F.abs(d) != float("inf")), d)


def hit_rows(block_hits: DataFrame, roles: list[str]) -> DataFrame:
    """Adds hit_id (a number for each hit that depends on its values alone) and roles_json."""
    return block_hits.withColumn("hit_id", F.xxhash64("scene_id", *roles, "t0", "t1")).withColumn("roles_json", F.to_json(F.struct(*[F.col(r).cast("string").alias(r) for r in roles])))


def _ends(hits: DataFrame) -> DataFrame:
    return hits.withColumn("_e", F.explode(F.array(F.struct(F.lit("start").alias("frame"), F.col("t0").alias("t")), F.struct(F.lit("end").alias("frame"), F.col("t1").alias("t"))))).select("*", "_e.frame", "_e.t").drop("_e")


def _roles(hits: DataFrame, roles: list[str]) -> Column:
    return F.array(*[F.struct(F.lit(r).alias("role"), F.col(r).alias("actor_id")) for r in roles])


def actor_frames(hits: DataFrame, frames: DataFrame, roles: list[str], values: list[str]) -> DataFrame:
    """Two rows for each hit and role: the actor's values at the start and at the end."""
    h = _ends(hits).withColumn("_r", F.explode(_roles(hits, roles))).select(*HIT_KEYS, "frame", "t", "_r.role", "_r.actor_id")
    return h.join(frames.select("scene_id", "actor_id", "t", *values), ["scene_id", "actor_id", "t"], "left")


def pair_frames(hits: DataFrame, pairs: DataFrame, roles: list[str], values: list[str]) -> DataFrame:
    """Two rows for each hit and ordered pair of roles."""
    both = F.array(*[F.struct(F.lit(a).alias("role_a"), F.lit(b).alias("role_b"), F.col(a).alias("actor_a"), F.col(b).alias("actor_b")) for a in roles for b in roles if a != b])
    h = _ends(hits).withColumn("_r", F.explode(both)).select(*HIT_KEYS, "frame", "t", "_r.*")
    p = pairs.select("scene_id", "t", F.col("ego").alias("actor_a"), F.col("npc").alias("actor_b"), *values)
    return h.join(p, ["scene_id", "t", "actor_a", "actor_b"], "left")


def hit_series(hits: DataFrame, frames: DataFrame, role: str, values: list[str]) -> DataFrame:
    """The role's values on every frame of each hit."""
    f = frames.select("scene_id", F.col("actor_id").alias(role), "t", *values)
    return hits.select(*HIT_KEYS, role).join(f, ["scene_id", role]).where("t between t0 and t1")
