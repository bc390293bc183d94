"""Lane chains and road segments on small maps."""

from kinetrail.functions import lane_chains as L


def test_fork_goes_straight_on():
    heading = {1: 0.0, 2: 1.0, 3: 0.1, 4: 0.1, 5: 1.0, 9: 0.0}
    after = {1: [2, 3], 2: [5], 3: [4]}
    assert L.sequences(heading, after) == [([1, 3, 4], None), ([9], None), ([2, 5], 0)]


def test_merge_and_cycle():
    assert L.sequences({1: 0.0, 2: 0.0, 3: 0.0}, {1: [3], 2: [3]}) == [([1, 3], None), ([2], None)]
    assert L.sequences({1: 0.0, 2: 0.0}, {1: [2], 2: [1]}) == []
    assert L.sequences({}, {}) == []


def test_lane_sequences(spark):
    lanes = spark.createDataFrame([("a", 1, 0.0), ("a", 2, 1.0), ("a", 3, 0.1), ("b", 7, 0.0)], "scene_id string, lane int, heading double")
    edges = spark.createDataFrame([("a", 1, 2), ("a", 1, 3)], "scene_id string, src int, dst int")
    got = sorted(map(tuple, L.lane_sequences(lanes, edges).collect()), key=str)
    assert got == [("a", 0, 0, 1, None), ("a", 0, 1, 3, None), ("a", 1, 0, 2, 0), ("b", 0, 0, 7, None)]


def test_both_sides_and_directions(spark):
    row = "scene_id string, chain_id int, other int, lo int, hi int"
    left = spark.createDataFrame([("a", 1, 2, 0, 40), ("a", 1, 3, 50, 60)], row)
    right = spark.createDataFrame([("a", 1, 4, 10, 55)], row)
    assert [tuple(r) for r in L.both_sides(left, right, 20).collect()] == [("a", 1, 2, 4, 10, 40)]
    kinds = spark.createDataFrame([(1, "same"), (1, None), (2, "same"), (2, "opposite"), (3, None), (4, "opposite")], "k int, kind string")
    got = kinds.groupBy("k").agg(L.direction_summary("kind").alias("d")).collect()
    assert {r.k: r.d for r in got} == {1: "same", 2: "mixed", 3: "unknown", 4: "opposite"}


def test_distinct_segments():
    a, b = [1, 2], [8, 9]
    assert L.distinct_segments([(a, None, b, 20), (b, a, None, 20)]) == [0]  # mirrored
    assert L.distinct_segments([([1], None, [8], 20), (b, a, None, 30)]) == [1]  # covered by a longer one
    assert L.distinct_segments([(b, a, None, 30), ([1], None, [8], 20)]) == [0]
    assert L.distinct_segments([(a, None, b, 20), (b, a, None, 25)]) == [1]  # as long: the first leaves
    assert L.distinct_segments([(a, [5], b, 20), (a, [5], b, 20), (b, None, [3], 9)]) == [2, 0]


def test_road_segments(spark):
    s = spark.createDataFrame([("a", 0, [1], [5], [8], 20), ("a", 1, [2], None, [3], 21), ("a", 2, [3], [2], None, 21), ("a", 3, [4], None, None, 30)], "scene_id string, place int, target array<long>, left array<long>, right array<long>, n_pieces int")
    got = sorted(map(tuple, L.road_segments(s).collect()))
    assert got == [("a", "seg_0", 2, 21, [[2], [3]]), ("a", "seg_1", 3, 20, [[5], [1], [8]])]
