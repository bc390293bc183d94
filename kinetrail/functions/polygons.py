"""Polygons of lanes: buffers, overlap, neighbours, stitched chains, and what stands in a lane. Pure numpy below, used by Arrow functions."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .geometry import neighbour_kind, project, side_of

#: Metres of a grid cell, how much wider than a lane its neighbours are looked for, the gap that stitching
#: bridges, how much a chain's polygon is widened and simplified, and the margins and shares of lights and crossings.
CELL, WIDER, BRIDGE = 10.0, 1.2, 0.75
INFLATE, SIMPLIFY = 1.1, 0.05
LIGHT_MARGIN, CROSSING_MARGIN, CROSSING_SHARE = 0.5, 0.2, 0.1


def offset(line: np.ndarray, d: float) -> np.ndarray:
    """The line moved d to its left, with mitred corners (at most four times d from the line)."""
    step = np.diff(line, axis=0)
    size = np.hypot(*step.T)
    keep = np.concatenate(([True], size > 0))
    line = line[keep]
    if len(line) < 2:
        return line.copy()
    u = np.diff(line, axis=0)
    u /= np.hypot(*u.T)[:, None]
    normal = np.column_stack((-u[:, 1], u[:, 0]))
    at = np.vstack((normal[:1], normal[:-1] + normal[1:], normal[-1:]))
    length = np.hypot(*at.T)
    at = np.where(length[:, None] > 1e-9, at / np.maximum(length, 1e-9)[:, None], np.vstack((normal, normal[-1:])))
    cos = np.concatenate(([1.0], (at[1:-1] * normal[1:]).sum(axis=1), [1.0]))
    return line + at * (d / np.maximum(cos, 0.25))[:, None]


def buffer(line: np.ndarray, half: float) -> np.ndarray:
    """The polygon half a width to either side: the left line, then the right one backwards."""
    return np.vstack((offset(line, half), offset(line, -half)[::-1]))


def area(poly: np.ndarray) -> float:
    x, y = poly.T
    return abs(float(x @ np.roll(y, -1) - y @ np.roll(x, -1))) / 2


def inside(poly: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Which points lie in the polygon, by the crossings of a ray."""
    a, b = poly, np.roll(poly, -1, axis=0)
    px, py = points[:, :1], points[:, 1:]
    cross = (a[:, 1] > py) != (b[:, 1] > py)
    with np.errstate(divide="ignore", invalid="ignore"):
        x = a[:, 0] + (py - a[:, 1]) / (b[:, 1] - a[:, 1]) * (b[:, 0] - a[:, 0])
    return (cross & (px < x)).sum(axis=1) % 2 == 1


def _turn(a, b, c):
    return (b[..., 0] - a[..., 0]) * (c[..., 1] - a[..., 1]) - (b[..., 1] - a[..., 1]) * (c[..., 0] - a[..., 0])


def meet(p: np.ndarray, q: np.ndarray) -> bool:
    """Whether two polygons share a point: sides that cross, or one inside the other."""
    if (p.max(axis=0) < q.min(axis=0)).any() or (q.max(axis=0) < p.min(axis=0)).any():
        return False
    a, b = p[:, None], np.roll(p, -1, axis=0)[:, None]
    c, d = q[None], np.roll(q, -1, axis=0)[None]
    cross = (_turn(a, b, c) * _turn(a, b, d) <= 0) & (_turn(c, d, a) * _turn(c, d, b) <= 0)
    near = (np.minimum(a, b) <= np.maximum(c, d)).all(axis=-1) & (np.minimum(c, d) <= np.maximum(a, b)).all(axis=-1)
    return bool((cross & near).any() or inside(q, p[:1])[0] or inside(p, q[:1])[0])


def clipped(poly: np.ndarray, convex: np.ndarray) -> np.ndarray:
    """The part of a polygon inside a convex one, side by side."""
    if _turn(convex[0], convex[1], convex[2]) < 0:
        convex = convex[::-1]
    out = poly
    for a, b in zip(convex, np.roll(convex, -1, axis=0)):
        if not len(out):
            break
        nxt, keep = np.roll(out, -1, axis=0), []
        for p, q in zip(out, nxt):
            u, v = _turn(a, b, p), _turn(a, b, q)
            if u >= 0:
                keep.append(p)
            if (u >= 0) != (v >= 0):
                keep.append(p + (q - p) * (u / (u - v)))
        out = np.array(keep).reshape(-1, 2)
    return out


def overlap(line: np.ndarray, half: float, convex: np.ndarray) -> float:
    """The area of a convex polygon that a buffered line covers, piece by piece of the line (its corners' overlap counts twice, which is little for lanes)."""
    total = 0.0
    left, right = offset(line, half), offset(line, -half)
    for i in range(min(len(left), len(right)) - 1):
        quad = np.vstack((left[i], left[i + 1], right[i + 1], right[i]))
        part = clipped(quad, convex)
        total += area(part) if len(part) > 2 else 0.0
    return total


def simplified(line: np.ndarray, tolerance: float = SIMPLIFY) -> np.ndarray:
    """The line without points that lie closer than the tolerance to what is left (Douglas and Peucker)."""
    keep, todo = {0, len(line) - 1}, [(0, len(line) - 1)]
    while todo:
        a, b = todo.pop()
        if b - a < 2:
            continue
        u, p = line[b] - line[a], line[a + 1 : b] - line[a]
        size = np.hypot(*u)
        d = np.abs(u[0] * p[:, 1] - u[1] * p[:, 0]) / size if size > 0 else np.hypot(*p.T)
        i = int(d.argmax())
        if d[i] > tolerance:
            keep.add(a + 1 + i)
            todo += [(a, a + 1 + i), (a + 1 + i, b)]
    return line[sorted(keep)]


def between(line: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The part of a line from the foot of one point to that of another; backwards if they lie so."""
    feet = [_foot(line, p) for p in (start, end)]
    (s0, p0), (s1, p1) = sorted(feet, key=lambda f: f[0])
    at = np.concatenate(([0.0], np.cumsum(np.hypot(*np.diff(line, axis=0).T))))
    out = np.vstack((p0, line[(at > s0) & (at < s1)], p1))
    return out if feet[0][0] <= feet[1][0] else out[::-1]


def _foot(line: np.ndarray, p: np.ndarray) -> tuple[float, np.ndarray]:
    a, d = line[:-1], np.diff(line, axis=0)
    size2 = (d * d).sum(axis=1)
    u = np.clip(((p - a) * d).sum(axis=1) / np.where(size2 > 0, size2, 1), 0, 1)
    foot = a + u[:, None] * d
    k = int(np.hypot(*(foot - p).T).argmin())
    return float(np.sqrt(size2[:k]).sum() + u[k] * np.sqrt(size2[k])), foot[k]


def stitched(lines: list[np.ndarray], gap: float = BRIDGE) -> list[np.ndarray]:
    """The lines put end to end in order, each turned round if its other end lies closer. A gap up to ``gap`` is bridged; a wider one begins a new line. The first line is turned if its start lies closer to the second."""
    out: list[np.ndarray] = []
    for i, line in enumerate(lines):
        line = np.asarray(line, float)
        if not out:
            if len(lines) > 1:
                ends = np.asarray(lines[1], float)[[0, -1]]
                d = np.hypot(*np.moveaxis(line[[0, -1]][:, None] - ends, 2, 0)).min(axis=1)
                line = line[::-1] if d[0] < d[1] else line
            out.append(line)
            continue
        last = out[-1][-1]
        if np.hypot(*(line[-1] - last)) < np.hypot(*(line[0] - last)):
            line = line[::-1]
        d = np.hypot(*(line[0] - last))
        if d <= gap:
            out[-1] = np.vstack((out[-1], line[1:] if d == 0 else line))
        else:
            out.append(line)
    return out


def chain_polygons(lines: list[np.ndarray], half: float) -> list[np.ndarray]:
    """The polygons of a chain of lanes: its stitched lines, simplified and buffered a little wider."""
    return [buffer(simplified(x), half * INFLATE) for x in stitched(lines) if len(x) > 1]


# ---- tables --------------------------------------------------------------------------------


def _xy(xs, ys) -> np.ndarray:
    return np.column_stack((xs, ys)).astype(float)


def with_polygon(pieces: DataFrame, half: str = "half", factor: float = 1.0) -> DataFrame:
    """pieces (xs, ys and half a width) with px, py: the buffer polygon."""
    fields = pieces.schema.fields

    def run(batches):
        for batch in batches:
            polys = [buffer(_xy(x, y), h * factor) for x, y, h in zip(*(batch.column(c).to_pylist() for c in ("xs", "ys", half)))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array([p[:, i].tolist() for p in polys], pa.list_(pa.float64())) for i in (0, 1))], [*batch.schema.names, "px", "py"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    return pieces.mapInArrow(run, f"{schema}, px array<double>, py array<double>")


def meeting(polygons: DataFrame, others: DataFrame | None = None) -> DataFrame:
    """scene_id, a, b: pairs of polygons (scene_id, id, px, py) that share a point; with ``others``, one of each table.

    Polygons meet by the grid cells of their bounding boxes, so a pair that is far apart is never formed; what
    shares a cell is then tested exactly.
    """

    def cells(df, name):
        box = [F.floor(f(c) / CELL) for c, f in (("px", F.array_min), ("px", F.array_max), ("py", F.array_min), ("py", F.array_max))]
        at = F.flatten(F.transform(F.sequence(box[0], box[1]), lambda x: F.transform(F.sequence(box[2], box[3]), lambda y: F.struct(x.alias("cx"), y.alias("cy")))))
        return df.select("scene_id", F.col("id").alias(name), F.explode(at).alias("c")).select("scene_id", name, "c.cx", "c.cy")

    a, b = cells(polygons, "a"), cells(polygons if others is None else others, "b")
    pairs = a.join(b, ["scene_id", "cx", "cy"])
    pairs = (pairs.where("a < b") if others is None else pairs).select("scene_id", "a", "b").distinct()
    p = polygons.select("scene_id", F.col("id").alias("a"), F.col("px").alias("ax"), F.col("py").alias("ay"))
    q = (polygons if others is None else others).select("scene_id", F.col("id").alias("b"), F.col("px").alias("bx"), F.col("py").alias("by"))
    j = pairs.join(p, ["scene_id", "a"]).join(q, ["scene_id", "b"])

    def run(batches):
        for batch in batches:
            ok = [meet(_xy(ax, ay), _xy(bx, by)) for ax, ay, bx, by in zip(*(batch.column(c).to_pylist() for c in ("ax", "ay", "bx", "by")))]
            yield batch.filter(pa.array(ok, pa.bool_())).select(["scene_id", "a", "b"])

    kinds = dict(j.dtypes)
    return j.select("scene_id", "a", "b", "ax", "ay", "bx", "by").mapInArrow(run, f"scene_id {kinds['scene_id']}, a {kinds['a']}, b {kinds['b']}")


def neighbours(pieces: DataFrame, edges: DataFrame) -> DataFrame:
    """scene_id, lane, g, side, other, other_g, direction (same, opposite): the pieces of other lanes beside a lane's piece.

    pieces: scene_id, lane, g (place along the lane), xs, ys, half. Pieces of the same lane, of a successor or a
    predecessor (edges: scene_id, src, dst), and of directions between 45 and 135 degrees are no neighbours.
    """
    p = pieces.withColumn("id", F.concat_ws("|", "lane", "g"))
    p = p.withColumns({"ax": F.element_at("xs", 1), "ay": F.element_at("ys", 1), "bx": F.element_at("xs", -1), "by": F.element_at("ys", -1)})
    p = p.withColumns({"heading": F.atan2(F.col("by") - F.col("ay"), F.col("bx") - F.col("ax")), "cx": F.aggregate("xs", F.lit(0.0), lambda s, v: s + v) / F.size("xs"), "cy": F.aggregate("ys", F.lit(0.0), lambda s, v: s + v) / F.size("ys")})
    m = meeting(with_polygon(p.select("scene_id", "id", "xs", "ys", "half"), factor=WIDER))
    m = m.union(m.select("scene_id", F.col("b").alias("a"), F.col("a").alias("b")))
    one = p.select("scene_id", F.col("id").alias("a"), "lane", "g", "ax", "ay", "heading")
    two = p.select("scene_id", F.col("id").alias("b"), F.col("lane").alias("other"), F.col("g").alias("other_g"), F.col("heading").alias("h2"), "cx", "cy")
    j = m.join(one, ["scene_id", "a"]).join(two, ["scene_id", "b"]).where("lane <> other")
    linked = edges.select("scene_id", F.col("src").alias("lane"), F.col("dst").alias("other")).union(edges.select("scene_id", F.col("dst").alias("lane"), F.col("src").alias("other"))).distinct()
    j = j.join(linked, ["scene_id", "lane", "other"], "left_anti").withColumn("direction", neighbour_kind(F.col("heading"), F.col("h2"))).where("direction is not null")
    return j.select("scene_id", "lane", "g", side_of(F.col("ax"), F.col("ay"), F.col("heading"), F.col("cx"), F.col("cy")).alias("side"), "other", "other_g", "direction")


def run_endpoints(runs: DataFrame, pieces: DataFrame, neighbour_pieces: DataFrame) -> DataFrame:
    """runs (scene_id, chain_id, side, other, lo, hi; half-open) with start and end (x, y) of the chain's pieces in the run, and direction: same, opposite, mixed or unknown, of the neighbour's pieces there.

    pieces: scene_id, chain_id, g, xs, ys. neighbour_pieces: scene_id, chain_id, side, other, g, direction.
    """
    from .lane_chains import direction_summary

    keys = ["scene_id", "chain_id", "side", "other", "lo", "hi"]
    ends = runs.join(pieces.select("scene_id", "chain_id", "g", F.struct(F.element_at("xs", 1).alias("x"), F.element_at("ys", 1).alias("y")).alias("a"), F.struct(F.element_at("xs", -1).alias("x"), F.element_at("ys", -1).alias("y")).alias("b")), ["scene_id", "chain_id"]).where("g >= lo and g < hi")
    ends = ends.groupBy(*keys).agg(F.min_by("a", "g").alias("start"), F.max_by("b", "g").alias("end"))
    way = runs.join(neighbour_pieces, ["scene_id", "chain_id", "side", "other"], "left").withColumn("direction", F.when((F.col("g") >= F.col("lo")) & (F.col("g") < F.col("hi")), F.col("direction")))
    return ends.join(way.groupBy(*keys).agg(direction_summary("direction").alias("direction")), keys)


def lights_in_lanes(lights: DataFrame, lanes: DataFrame) -> DataFrame:
    """scene_id, light, id, s, t_lat: lights (scene_id, light, x, y) in a lane (scene_id, id, xs, ys, half) widened by LIGHT_MARGIN, with their foot on its line."""
    wide = with_polygon(lanes.withColumn("_h", F.col("half") + LIGHT_MARGIN), "_h")
    point = lights.select("scene_id", F.col("light").alias("id"), F.array("x", "x", "x").alias("px"), F.array("y", "y", "y").alias("py"))
    near = meeting(point, wide.select("scene_id", "id", "px", "py"))
    j = near.join(lights.select("scene_id", F.col("light").alias("a"), "x", "y"), ["scene_id", "a"]).join(lanes.select("scene_id", F.col("id").alias("b"), "xs", "ys"), ["scene_id", "b"])

    def run(batches):
        for batch in batches:
            st = [project(_xy(xs, ys), np.array([[x, y]], float)) for xs, ys, x, y in zip(*(batch.column(c).to_pylist() for c in ("xs", "ys", "x", "y")))]
            s, t = (pa.array([None if np.isnan(v[i][0]) else float(v[i][0]) for v in st], pa.float64()) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([batch.column("scene_id"), batch.column("a"), batch.column("b"), s, t], ["scene_id", "light", "id", "s", "t_lat"])

    k = dict(j.dtypes)
    return j.select("scene_id", "a", "b", "xs", "ys", "x", "y").mapInArrow(run, f"scene_id {k['scene_id']}, light {k['a']}, id {k['b']}, s double, t_lat double")


def crossings_in_lanes(crossings: DataFrame, lanes: DataFrame) -> DataFrame:
    """scene_id, crossing, id, share, s_from, s_to: crossings (scene_id, id, px, py; convex) of which a lane widened by CROSSING_MARGIN covers at least CROSSING_SHARE, and the part of the lane's line beside them."""
    wide = with_polygon(lanes.withColumn("_h", F.col("half") + CROSSING_MARGIN), "_h")
    near = meeting(crossings.select("scene_id", "id", "px", "py"), wide.select("scene_id", "id", "px", "py"))
    j = near.join(crossings.select("scene_id", F.col("id").alias("a"), "px", "py"), ["scene_id", "a"]).join(lanes.select("scene_id", F.col("id").alias("b"), "xs", "ys", "half"), ["scene_id", "b"])

    def run(batches):
        for batch in batches:
            out = []
            for scene, a, b, px, py, xs, ys, half in zip(*(batch.column(c).to_pylist() for c in ("scene_id", "a", "b", "px", "py", "xs", "ys", "half"))):
                poly, line = _xy(px, py), _xy(xs, ys)
                share = overlap(line, half + CROSSING_MARGIN, poly) / max(area(poly), 1e-9)
                if share >= CROSSING_SHARE:
                    s = [_foot(line, p)[0] for p in poly]
                    out.append((scene, a, b, min(share, 1.0), min(s), max(s)))
            types = [batch.schema.field("scene_id").type, batch.schema.field("a").type, batch.schema.field("b").type, *[pa.float64()] * 3]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], ["scene_id", "crossing", "id", "share", "s_from", "s_to"])

    k = dict(j.dtypes)
    return j.select("scene_id", "a", "b", "px", "py", "xs", "ys", "half").mapInArrow(run, f"scene_id {k['scene_id']}, crossing {k['a']}, id {k['b']}, share double, s_from double, s_to double")
