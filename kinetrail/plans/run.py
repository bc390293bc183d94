"""A program's run over scenes: the calls' signals, and the three result tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.intervals import possible_windows
from ..operators import results as R
from ..operators.windows import first_end, hit_table, signals
from ..sources.scenes import write_results
from ..units import Quantity
from .dsl import Call, Program
from .matcher import Config, block_windows, call_windows, pair_frames


def call_signals(program: Program, frames: DataFrame, cfg: Config, pairs: DataFrame | None = None) -> DataFrame:
    """block, call (its number in the block), scene_id, binding (JSON of the roles' actors), intervals, frames_on, n_hits, end: what each call alone finds."""
    out = []
    for b in program.blocks():
        for i, c in enumerate(x for x in b.children if isinstance(x, Call)):
            w = call_windows([c], program.roles, frames, cfg, b.effective([c], cfg.duration_policy), pairs)
            keys = [k for k in w.columns if k not in ("t0", "t1")]
            s = signals(first_end(w, keys), keys)
            binding = F.to_json(F.struct(*[F.col(k).cast("string").alias(k) for k in keys[1:]]))
            out.append(s.select(F.lit(b.label).alias("block"), F.lit(i).alias("call"), "scene_id", binding.alias("binding"), "intervals", "frames_on", "n_hits", "end"))
    return reduce(DataFrame.unionByName, out)


def tables(program: Program, frames: DataFrame, scenario: str, run_id: str, cfg: Config | None = None, pairs: DataFrame | None = None, values: list[str] = [], pair_values: list[str] = []) -> dict[str, DataFrame]:
    """hits, actor_frames and pair_frames of all blocks, with scenario, run_id and block_label.

    A hit is a binding's first start with the end of its first run of ends; n_windows are the ends of that start,
    n_possible_windows the windows of admissible length in the scene. Values are doubles; NaN and infinities are null.
    """
    cfg = cfg or Config()
    lengths = frames.groupBy("scene_id").agg((F.max("t") + 1).alias("_T"))
    out: dict[str, list[DataFrame]] = {"hits": [], "actor_frames": [], "pair_frames": []}
    for b in program.blocks():
        w = block_windows(b, program, frames, cfg, pairs)
        roles = [c for c in w.columns if c not in ("scene_id", "t0", "t1")]
        h = R.hit_rows(hit_table(w, ["scene_id", *roles]), roles)
        calls = [c for c in b.children if isinstance(c, Call)]
        lo, hi = (b.effective(calls, cfg.duration_policy) or Quantity(*cfg.default_duration)).frames(cfg.fps)
        names = (F.lit(scenario).alias("scenario"), F.lit(run_id).alias("run_id"), F.lit(b.label).alias("block_label"))
        n = h.join(lengths, "scene_id").withColumn("n_possible_windows", possible_windows(F.col("_T"), lo, hi))
        out["hits"].append(n.select(*names, "scene_id", "hit_id", "roles_json", "t0", "t1", "n_windows", "n_possible_windows"))
        a = R.actor_frames(h, frames, roles, values)
        out["actor_frames"].append(a.select(*names, *R.HIT_KEYS, "frame", "t", "role", F.col("actor_id").cast("string").alias("actor_id"), *[R.finite(F.col(v)).alias(v) for v in values]))
        if len(roles) > 1:
            both = reduce(DataFrame.union, [h.select("scene_id", F.col(x).alias("ego"), F.col(y).alias("npc")) for x in roles for y in roles if x != y]).distinct()
            p = R.pair_frames(h, pair_frames(frames, both, pairs), roles, pair_values)
            out["pair_frames"].append(p.select(*names, *R.HIT_KEYS, "frame", "t", "role_a", "role_b", *[F.col(c).cast("string").alias(c) for c in ("actor_a", "actor_b")], *[R.finite(F.col(v)) if dict(p.dtypes)[v] != "string" else F.col(v) for v in pair_values]))
    return {k: reduce(DataFrame.unionByName, v) for k, v in out.items() if v}


def write(result: dict[str, DataFrame], folder: str) -> None:
    """Each table that has rows, by scenario and run."""
    for name, table in result.items():
        write_results(table, f"{folder}/{name}")
