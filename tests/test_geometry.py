"""Lane geometry on small maps."""

import math

import numpy as np

from kinetrail.functions import geometry as G
from kinetrail.functions import polygons as P


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_buffer_area_and_inside():
    line = np.array([[0, 0], [10, 0], [10, 10]], float)
    poly = P.buffer(line, 1.0)
    assert abs(P.area(poly) - 40) < 1e-9  # two arms of 10 by 2 with a mitred corner
    assert P.inside(poly, np.array([[5, 0.9], [5, 1.1], [10.9, -0.9], [9.5, 9], [8, 8]], float)).tolist() == [True, False, True, True, False]
    assert np.allclose(P.offset(np.array([[0, 0], [0, 0], [4, 0]], float), 2), [[0, 2], [4, 2]])


def test_meet():
    a = np.array([[0, 0], [4, 0], [4, 4], [0, 4]], float)
    assert P.meet(a, a + 2) and P.meet(a, a / 4 + 1) and P.meet(a / 4 + 1, a) and P.meet(a, a + [4, 0])
    assert not P.meet(a, a + [5, 0]) and not P.meet(a, a + [0, -4.1])


def test_clipped():
    a = np.array([[0, 0], [4, 0], [4, 4], [0, 4]], float)
    assert abs(P.area(P.clipped(a, a + 2)) - 4) < 1e-9 and abs(P.area(P.clipped(a, (a + 2)[::-1])) - 4) < 1e-9
    assert len(P.clipped(a, a + 9)) == 0
    assert abs(P.overlap(np.array([[-5, 2], [9, 2]], float), 1.0, a) - 8) < 1e-9


def test_simplified_between_and_stitched():
    line = np.array([[0, 0], [1, 0.01], [2, 0], [3, 2], [4, 0]], float)
    assert P.simplified(line).tolist() == [[0, 0], [2, 0], [3, 2], [4, 0]]
    straight = np.array([[0, 0], [5, 0], [10, 0]], float)
    assert P.between(straight, np.array([2, 1.0]), np.array([8, -1.0])).tolist() == [[2, 0], [5, 0], [8, 0]]
    assert P.between(straight, np.array([8, 1.0]), np.array([2, 0.0])).tolist() == [[8, 0], [5, 0], [2, 0]]
    a, b, c = np.array([[5, 0], [0, 0]]), np.array([[10, 0], [5.5, 0]]), np.array([[20, 0], [30, 0]])
    got = P.stitched([a, b, c])
    assert [g.tolist() for g in got] == [[[0, 0], [5, 0], [5.5, 0], [10, 0]], [[20, 0], [30, 0]]]
    assert len(P.chain_polygons([a, b, c], 1.75)) == 2
    assert abs(P.area(P.chain_polygons([c], 1.75)[0]) - 10 * 2 * 1.75 * 1.1) < 1e-9


def test_frenet(spark):
    lines = spark.createDataFrame([("a", [0.0, 10.0], [0.0, 0.0]), ("b", [0.0, 0.0], [0.0, 10.0])], "segment_id string, xs array<double>, ys array<double>")
    pts = spark.createDataFrame([("a", "v", 0, 3.0, 2.0), ("a", "v", 1, 12.0, 0.0), ("b", "v", 0, 1.0, 4.0), ("a", "v", 2, None, 1.0), ("z", "v", 0, 1.0, 1.0)], "segment_id string, actor_id string, t int, x double, y double")
    got = {(r.segment_id, r.t): (r.s, r.t_lat) for r in G.frenet(pts, lines).collect()}
    assert got == {("a", 0): (3.0, 2.0), ("a", 1): (None, None), ("b", 0): (4.0, -1.0), ("a", 2): (None, None), ("z", 0): (None, None)}


def test_lanes_edges_and_pieces(spark):
    pts = [(1, "s", k, lane, x, y) for lane, line in {1: [(0, 0), (6, 0), (12, 0)], 2: [(12.0004, 0), (20, 0)], 3: [(12, 0.5), (20, 1)], 4: [(12, 0), (12, 9)]}.items() for k, (x, y) in enumerate(line)]
    road = spark.createDataFrame([(s, lane, k, 18 if lane == 4 else 2, True, float(x), float(y)) for _, s, k, lane, x, y in pts] + [("s", 9, 0, 2, False, 0.0, 0.0)], "scene_id string, lane int, idx int, type int, valid boolean, x double, y double")
    lanes = G.lanes(road, [1, 2, 18])
    assert rows(lanes, "lane", "type") == [(1, 2), (2, 2), (3, 2), (4, 18)]
    assert rows(G.lane_edges(lanes), "src", "dst") == [(1, 2), (1, 4)]
    assert rows(lanes.select("lane", G.half_width(lanes["type"]).alias("h")), "lane", "h") == [(1, 1.75), (2, 1.75), (3, 1.75), (4, 0.1)]
    assert [len(p) for p in G.resample(np.array([[0, 0], [3, 0], [6, 0], [7, 0]], float))] == [3, 2]


def street(spark):
    """Three parallel lanes along x (the third runs back), a crossing one, and lane 5 that follows lane 1."""
    out = []
    for lane, y, back in ((1, 0.0, False), (2, 3.5, False), (3, -3.5, True)):
        for g in range(4):
            xs = [5.0 * g, 5.0 * g + 5]
            out.append(("s", lane, 3 - g if back else g, xs[::-1] if back else xs, [y, y], 1.75))
    out += [("s", 4, 0, [8.0, 8.0], [-10.0, 10.0], 1.75), ("s", 5, 0, [20.0, 25.0], [0.0, 0.0], 1.75)]
    return spark.createDataFrame(out, "scene_id string, lane int, g int, xs array<double>, ys array<double>, half double")


def test_neighbours(spark):
    pieces, edges = street(spark), spark.createDataFrame([("s", 1, 5)], "scene_id string, src int, dst int")
    got = rows(P.neighbours(pieces, edges), "lane", "g", "side", "other", "other_g", "direction")
    assert {(x[0], x[3], x[2], x[5]) for x in got} == {(1, 2, "left", "same"), (2, 1, "right", "same"), (1, 3, "right", "opposite"), (3, 1, "right", "opposite"), (2, 5, "right", "same"), (5, 2, "left", "same"), (3, 5, "right", "opposite"), (5, 3, "right", "opposite")}
    assert (1, 2, "left", 2, 2, "same") in got and (1, 1, "right", 3, 2, "opposite") in got
    assert not any(4 in (x[0], x[3]) or {x[0], x[3]} == {1, 5} for x in got)


def test_meeting_by_cells(spark):
    """Against all pairs of random boxes."""
    rng = np.random.default_rng(3)
    boxes = []
    for i in range(60):
        x, y, w, h = map(float, (*rng.uniform(-60, 60, 2), *rng.uniform(1, 25, 2)))
        boxes.append(("s" if i < 50 else "t", f"b{i:02d}", [x, x + w, x + w, x], [y, y, y + h, y + h]))
    got = rows(P.meeting(spark.createDataFrame(boxes, "scene_id string, id string, px array<double>, py array<double>")), "a", "b")
    want = sorted((a[1], b[1]) for a in boxes for b in boxes if a[0] == b[0] and a[1] < b[1] and P.meet(np.column_stack(a[2:]), np.column_stack(b[2:])))
    assert got == want and want


def test_run_endpoints(spark):
    pieces = street(spark).where("lane = 1").selectExpr("scene_id", "lane as chain_id", "g", "xs", "ys")
    runs = spark.createDataFrame([("s", 1, "left", 2, 0, 3), ("s", 1, "right", 3, 1, 4)], "scene_id string, chain_id int, side string, other int, lo int, hi int")
    near = spark.createDataFrame([("s", 1, "left", 2, g, "same") for g in range(4)] + [("s", 1, "right", 3, g, d) for g, d in ((0, "same"), (1, "opposite"), (2, "opposite"))], "scene_id string, chain_id int, side string, other int, g int, direction string")
    got = {r.side: r for r in P.run_endpoints(runs, pieces, near).collect()}
    assert (got["left"].start.x, got["left"].end.x, got["left"].direction) == (0.0, 15.0, "same")
    assert (got["right"].start.x, got["right"].end.x, got["right"].direction) == (5.0, 20.0, "opposite")


def test_lights_and_crossings(spark):
    lanes = spark.createDataFrame([("s", "a", [0.0, 20.0], [0.0, 0.0], 1.75), ("s", "b", [0.0, 20.0], [10.0, 10.0], 1.75)], "scene_id string, id string, xs array<double>, ys array<double>, half double")
    lights = spark.createDataFrame([("s", "l1", 4.0, 2.2), ("s", "l2", 4.0, 2.4), ("s", "l3", 7.0, 9.0)], "scene_id string, light string, x double, y double")
    assert rows(P.lights_in_lanes(lights, lanes), "light", "id", "s", "t_lat") == [("l1", "a", 4.0, 2.2), ("l3", "b", 7.0, -1.0)]
    cross = spark.createDataFrame([("s", "c", [5.0, 8.0, 8.0, 5.0], [-3.0, -3.0, 3.0, 3.0]), ("s", "d", [5.0, 8.0, 8.0, 5.0], [1.9, 1.9, 7.0, 7.0])], "scene_id string, id string, px array<double>, py array<double>")
    (r,) = P.crossings_in_lanes(cross, lanes).collect()
    assert (r.crossing, r.id, r.s_from, r.s_to) == ("c", "a", 5.0, 8.0) and math.isclose(r.share, 3.9 / 6)


def test_headings_and_sides(spark):
    df = spark.createDataFrame([(0.0, 0.2), (0.0, 3.1), (0.0, 1.5), (3.1, -3.1)], "a double, b double")
    assert [r.k for r in df.select(G.neighbour_kind(df.a, df.b).alias("k")).collect()] == ["same", "opposite", None, "same"]


def test_chain_index_and_runs(spark):
    p = spark.createDataFrame([("s", 1, o, q) for o in range(2) for q in range(3)], "scene_id string, chain_id int, lane_order int, piece int")
    assert [r.g for r in G.chain_index(p).orderBy("lane_order", "piece").collect()] == list(range(6))
    n = spark.createDataFrame([("s", 1, "left", 2, g) for g in (0, 1, 2, 5, 6)] + [("s", 1, "left", 3, g) for g in (1, 2, 3)], "scene_id string, chain_id int, side string, other int, g int")
    assert rows(G.neighbour_runs(n, 3), "other", "lo", "hi") == [(2, 0, 3), (3, 1, 4)]
