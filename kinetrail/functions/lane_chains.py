"""Lane chains and road segments of a scene. Both depend on an order, so a scene's rows (bounded by its map) are one group."""

from __future__ import annotations

from collections import deque

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sequences(heading: dict[int, float], after: dict[int, list[int]]) -> list[tuple[list[int], int | None]]:
    """(lanes, number of the sequence it branched from) from each lane without a predecessor on, in rising order.

    At a fork the successor closest in heading goes on; the others wait as starts of branches. A sequence ends
    at a lane that is taken. Lanes that only a cycle reaches are in none.
    """
    entered = {d for ds in after.values() for d in ds}
    waiting = deque((lane, None) for lane in sorted(heading) if lane not in entered)
    taken: set[int] = set()
    out: list[tuple[list[int], int | None]] = []
    while waiting:
        lane, origin = waiting.popleft()
        if lane in taken:
            continue
        path: list[int] = []
        while lane is not None and lane not in taken:
            taken.add(lane)
            path.append(lane)
            ahead = sorted(after.get(lane, []), key=lambda d: -np.cos(heading[d] - heading[lane]))
            waiting.extend((d, len(out)) for d in ahead[1:] if d not in taken)
            lane = ahead[0] if ahead else None
        out.append((path, origin))
    return out


def lane_sequences(lanes: DataFrame, edges: DataFrame) -> DataFrame:
    """scene_id, sequence, place, lane, origin (the sequence it branched from, else null) for lanes (scene_id, lane, heading) and edges (scene_id, src, dst)."""
    after = edges.groupBy("scene_id", F.col("src").alias("lane")).agg(F.sort_array(F.collect_set("dst")).alias("after"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        heading = dict(zip(pdf["lane"].tolist(), pdf["heading"].tolist()))
        nxt = {a: [d for d in b if d in heading] for a, b in zip(pdf["lane"].tolist(), pdf["after"]) if b is not None}
        rows = [(pdf["scene_id"].iloc[0], k, i, lane, origin) for k, (path, origin) in enumerate(sequences(heading, nxt)) for i, lane in enumerate(path)]
        out = pd.DataFrame(rows, columns=["scene_id", "sequence", "place", "lane", "origin"])
        return out.astype({"origin": "Int64"})

    j = lanes.select("scene_id", F.col("lane").cast("long").alias("lane"), "heading").join(after, ["scene_id", "lane"], "left")
    return j.groupBy("scene_id").applyInPandas(run, f"scene_id {dict(lanes.dtypes)['scene_id']}, sequence int, place int, lane long, origin int")


def both_sides(left: DataFrame, right: DataFrame, least: int) -> DataFrame:
    """Runs (scene_id, chain_id, other, lo, hi; half-open) with a neighbour on both sides at once, long enough."""
    a = left.select("scene_id", "chain_id", F.col("other").alias("left"), F.col("lo").alias("a0"), F.col("hi").alias("a1"))
    b = right.select("scene_id", "chain_id", F.col("other").alias("right"), F.col("lo").alias("b0"), F.col("hi").alias("b1"))
    j = a.join(b, ["scene_id", "chain_id"]).select("scene_id", "chain_id", "left", "right", F.greatest("a0", "b0").alias("lo"), F.least("a1", "b1").alias("hi"))
    return j.where(F.col("hi") - F.col("lo") >= least)


def direction_summary(kind: str):
    """same, opposite, mixed or unknown, as an aggregate of the neighbour directions of a run's pieces."""
    n = lambda v: F.count_if(F.col(kind) == v)
    return F.when((n("same") > 0) & (n("opposite") > 0), "mixed").when(n("same") > 0, "same").when(n("opposite") > 0, "opposite").otherwise("unknown")


def distinct_segments(rows: list[tuple]) -> list[int]:
    """Places of the road segments (target, left, right, n_pieces; lane lists, None where a side has no neighbour) that stay, three lanes last.

    A two-lane segment leaves if its mirror image came before, or if a later one covers it crosswise and is no
    shorter; a shorter one that comes later leaves. Three-lane segments leave only if all is equal.
    """
    seen, two, three = set(), [], []
    for i, (target, left, right, n) in enumerate(rows):
        sides = [tuple(x) for x in (left, right) if x is not None]
        key = (tuple(sorted([tuple(target), *sides])), n) if len(sides) == 1 else (tuple(target), *sides, n)
        if key not in seen:
            seen.add(key)
            (two if len(sides) == 1 else three).append(i)
    parts = {i: (set(rows[i][0]), set(rows[i][1] if rows[i][1] is not None else rows[i][2])) for i in two}
    size = {i: len(rows[i][0]) + len(rows[i][1] if rows[i][1] is not None else rows[i][2]) for i in two}
    gone: set[int] = set()
    for at, i in enumerate(two):
        if i in gone:
            continue
        for j in two[at + 1 :]:
            (a, b), (c, d) = parts[i], parts[j]
            if (a <= d and b <= c) or (c <= b and d <= a):
                if size[i] <= size[j]:
                    gone.add(i)
                    break
                gone.add(j)
    return [i for i in two if i not in gone] + three


def road_segments(segments: DataFrame) -> DataFrame:
    """scene_id, segment_id (seg_0 ...), n_lanes, n_pieces, chains (lane lists from left to right) of segments (scene_id, place, target, left, right, n_pieces)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("place")
        lists = lambda c: [None if x is None else [int(v) for v in x] for x in pdf[c]]
        rows = list(zip(lists("target"), lists("left"), lists("right"), pdf["n_pieces"].tolist()))
        out = []
        for k, i in enumerate(distinct_segments(rows)):
            target, left, right, n = rows[i]
            chains = [x for x in (left, target, right) if x is not None]
            out.append((pdf["scene_id"].iloc[0], f"seg_{k}", len(chains), n, chains))
        return pd.DataFrame(out, columns=["scene_id", "segment_id", "n_lanes", "n_pieces", "chains"])

    s = segments.where("left is not null or right is not null")
    return s.groupBy("scene_id").applyInPandas(run, f"scene_id {dict(segments.dtypes)['scene_id']}, segment_id string, n_lanes int, n_pieces int, chains array<array<long>>")
