"""Polyline geometry: lane resampling, Frenet coordinates, headings, sides, chains."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Half-widths in metres by lane type, the piece length, and the distance that joins two ends.
HALF_WIDTH = {1: 1.75, 2: 1.75, 3: 0.75, 18: 0.1}
DEFAULT_HALF_WIDTH, PIECE, SNAP = 1.5, 5.0, 0.001


def half_width(lane_type):
    out = F.lit(DEFAULT_HALF_WIDTH)
    for k, w in HALF_WIDTH.items():
        out = F.when(lane_type == k, w).otherwise(out)
    return out


def resample(xy: np.ndarray, least: float = PIECE) -> list[np.ndarray]:
    """Pieces of at least ``least`` metres; what is left at the end is a piece of its own."""
    out, a, run = [], 0, 0.0
    steps = np.hypot(*np.diff(xy, axis=0).T)
    for i, d in enumerate(steps):
        run += d
        if run >= least:
            out.append(xy[a : i + 2])
            a, run = i + 1, 0.0
    if a < len(xy) - 1:
        out.append(xy[a:])
    return out


def project(line: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """s and signed left offset of points on a polyline; NaN before its start and behind its end."""
    a, d = line[:-1], np.diff(line, axis=0)
    size = np.hypot(*d.T)
    keep = size > 0
    a, d, size = a[keep], d[keep], size[keep]
    at = np.concatenate(([0.0], np.cumsum(size)))
    u = d / size[:, None]
    rel = p[:, None, :] - a
    along = np.einsum("pij,ij->pi", rel, u)
    foot = np.clip(along, 0, size)
    gap = np.hypot(*np.moveaxis(rel - foot[..., None] * u, 2, 0))
    k = gap.argmin(axis=1)
    i = np.arange(len(p))
    s = at[k] + foot[i, k]
    side = u[k, 0] * rel[i, k, 1] - u[k, 1] * rel[i, k, 0]
    t = np.where(side >= 0, 1.0, -1.0) * gap[i, k]
    outside = ((k == 0) & (along[:, 0] < 0)) | ((k == len(size) - 1) & (along[:, -1] > size[-1]))
    return np.where(outside, np.nan, s), np.where(outside, np.nan, t)


def frenet(points: DataFrame, lines: DataFrame) -> DataFrame:
    """points (segment_id, actor_id, t, x, y) with s, t_lat on their segment's reference line (segment_id, xs, ys). A segment's points and its line, sent once, are one group."""

    def run(key, p: pd.DataFrame, line: pd.DataFrame) -> pd.DataFrame:
        out = p[["segment_id", "actor_id", "t", "x", "y"]].copy()
        out["s"] = out["t_lat"] = np.nan
        ok = (out["x"].notna() & out["y"].notna()).to_numpy()
        if len(line) and ok.any():
            s, t = project(np.column_stack([line["xs"].iloc[0], line["ys"].iloc[0]]).astype(float), out.loc[ok, ["x", "y"]].to_numpy(float))
            out.loc[ok, "s"], out.loc[ok, "t_lat"] = s, t
        return out.astype({"s": object, "t_lat": object}).where(out.notna(), None)

    return points.groupBy("segment_id").cogroup(lines.groupBy("segment_id")).applyInPandas(run, "segment_id string, actor_id string, t int, x double, y double, s double, t_lat double")


def lanes(roadgraph: DataFrame, kinds: list[int]) -> DataFrame:
    """scene_id, lane, type, start and end points, heading of valid lanes of some types (rows idx, lane, type, valid, x, y)."""
    r = roadgraph.where(F.col("valid") & F.col("type").isin(kinds))
    g = r.groupBy("scene_id", "lane").agg(F.first("type").alias("type"), F.min_by(F.struct("x", "y"), "idx").alias("a"), F.max_by(F.struct("x", "y"), "idx").alias("b"))
    return g.withColumn("heading", F.atan2(F.col("b.y") - F.col("a.y"), F.col("b.x") - F.col("a.x")))


def lane_edges(lanes_: DataFrame) -> DataFrame:
    """scene_id, src, dst: src ends where dst starts, to SNAP metres. An equi-join on the cells around a point, then the exact distance."""
    cell = lambda c: F.floor(c / SNAP)
    near = F.explode(F.flatten(F.transform(F.sequence(F.lit(-1), F.lit(1)), lambda i: F.transform(F.sequence(F.lit(-1), F.lit(1)), lambda j: F.struct((cell(F.col("b.x")) + i).alias("cx"), (cell(F.col("b.y")) + j).alias("cy"))))))
    s = lanes_.select("scene_id", F.col("lane").alias("src"), "b", near.alias("c")).select("scene_id", "src", "b", "c.cx", "c.cy")
    d = lanes_.select("scene_id", F.col("lane").alias("dst"), "a", cell(F.col("a.x")).alias("cx"), cell(F.col("a.y")).alias("cy"))
    j = s.join(d, ["scene_id", "cx", "cy"]).where("src <> dst")
    return j.where(F.hypot(F.col("a.x") - F.col("b.x"), F.col("a.y") - F.col("b.y")) <= SNAP).select("scene_id", "src", "dst").distinct()


def neighbour_kind(heading_a, heading_b):
    """same under 45 degrees, opposite over 135, else null."""
    from .series import wrap_angle

    d = F.degrees(F.abs(wrap_angle(heading_b - heading_a)))
    return F.when(d < 45, "same").when(d > 135, "opposite")


def side_of(ax, ay, heading, px, py):
    """left or right of a direction, by the cross product."""
    return F.when(F.cos(heading) * (py - ay) - F.sin(heading) * (px - ax) >= 0, "left").otherwise("right")


def chain_index(pieces: DataFrame) -> DataFrame:
    """The place of each piece along its chain (chain_id, lane_order, piece)."""
    return pieces.withColumn("g", F.row_number().over(Window.partitionBy("scene_id", "chain_id").orderBy("lane_order", "piece")) - 1)


def neighbour_runs(neighbours: DataFrame, least: int) -> DataFrame:
    """scene_id, chain_id, side, other, lo, hi (half-open): runs of pieces with the same neighbour chain, long enough."""
    from .intervals import islands

    r = islands(neighbours.withColumnRenamed("g", "t"), ["scene_id", "chain_id", "side", "other"])
    return r.select("scene_id", "chain_id", "side", "other", F.col("t0").alias("lo"), (F.col("t1") + 1).alias("hi")).where(F.col("hi") - F.col("lo") >= least)


#: The lane ids (left, target, right) and the reference line by the neighbours' directions; None: no valid segment.
REFERENCE = {
    ("same", "same"): ("left.left", -1, -2, -3),
    ("opposite", "same"): ("target.left", 1, -1, -2),
    ("same", None): ("left.left", -1, -2, None),
    ("opposite", None): ("target.left", 1, -1, None),
    (None, "same"): ("target.left", None, -1, -2),
}


def reference_rule(left, right):
    """struct<line, l, t, r> of a segment by the directions of its neighbours; null where it isn't valid."""
    out = F.lit(None).cast("struct<line:string,l:int,t:int,r:int>")
    for (a, b), (line, *ids) in REFERENCE.items():
        cond = left.eqNullSafe(F.lit(a).cast("string")) & right.eqNullSafe(F.lit(b).cast("string"))
        out = F.when(cond, F.struct(F.lit(line).alias("line"), *[F.lit(v).cast("int").alias(n) for v, n in zip(ids, "ltr")])).otherwise(out)
    return out
