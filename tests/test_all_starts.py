"""Predicate queries test every start of a window."""

import pytest
from test_queries import DIR

from kinetrail import queries as core
from kinetrail.functions import series as S
from kinetrail.sources.traj import gaps, traj


def test_no_query_thins_its_rows():
    assert all(" % 4 = 0" not in sql and " % 6 = 0" not in sql for sql in core.ORACLE_SQL.values())


@pytest.mark.parametrize("name, keys, more", [("prd2_speed_start", core.KEYS, 7), ("prd7_same_lane", core.PAIR, 5), ("prd7_same_lane_gaps", core.PAIR, 5)])
def test_starts(spark, name, keys, more):
    t = gaps(traj(spark, DIR)) if name.endswith("gaps") else traj(spark, DIR)
    frames = t if keys == core.KEYS else S.pairs(t)
    have = {tuple(r) for r in frames.select(*keys, "t").collect()}
    want = sorted((*k, t0, t0 + more) for *k, t0 in have if (*k, t0 + more) in have)
    got = core.QUERIES[name](spark, DIR).select(*keys, "t0", "t1")
    assert sorted(map(tuple, got.collect())) == want
