"""Sources and sinks: round trips of scene tables, logs, statistics and TFRecord files, compared with DuckDB where it reads the files."""

import json
import os
import struct

import duckdb
import pytest

from kinetrail.operators import stats as A
from kinetrail.sources import scenes as S
from kinetrail.streaming import scenes as stream


def varint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def field(number, data):
    return varint(number << 3 | 2) + varint(len(data)) + data


def example(features):
    out = b""
    for name, values in features.items():
        if isinstance(values[0], bytes):
            kind = field(1, b"".join(field(1, v) for v in values))
        elif isinstance(values[0], float):
            kind = field(2, field(1, struct.pack(f"<{len(values)}f", *values)))
        else:
            kind = field(3, field(1, b"".join(varint(v & (1 << 64) - 1) for v in values)))
        out += field(1, field(1, name.encode()) + field(2, kind))
    return field(1, out)


def record(data):
    n = struct.pack("<Q", len(data))
    return n + struct.pack("<I", S.masked_crc(n)) + data + struct.pack("<I", S.masked_crc(data))


def test_crc32c():
    assert S.crc32c(b"123456789") == 0xE3069283

    def slow(data):
        c = 0xFFFFFFFF
        for b in data:
            c = (c >> 8) ^ int(S._CRC[(c ^ b) & 255])
        return c ^ 0xFFFFFFFF

    for n in (0, 1, 3, 4, 5, 100, 16 * S.LANES, 16 * S.LANES + 1, 50_000):
        data = os.urandom(n)
        assert S.crc32c(data) == slow(data)


def test_tfrecords(spark, tmp_path):
    feats = [{"scenario/id": [f"s{i}".encode()], "state/current/x": [1.5, float(i)], "state/current/valid": [1, 0, -3]} for i in range(20)]
    (tmp_path / "training_tfexample.tfrecord-00003-of-00010").write_bytes(b"".join(record(example(f)) for f in feats))
    path = S.shard_paths(spark, [str(tmp_path / "other"), f"file://{tmp_path}"], [3], 10)
    rows = S.read_tfrecords(spark, path).collect()
    assert [r.scenario_id for r in rows] == [f"s{i}" for i in range(20)]
    assert rows[7].floats["state/current/x"] == [1.5, 7.0] and rows[7].longs["state/current/valid"] == [1, 0, -3]
    with pytest.raises(FileNotFoundError):
        S.shard_paths(spark, [str(tmp_path)], [4], 10)
    with pytest.raises(ValueError):
        S.shard_paths(spark, [str(tmp_path)], [10], 10)


def test_broken_records():
    good = record(b"abcdef") + record(b"xyz")
    assert list(S.records(good)) == [b"abcdef", b"xyz"] and list(S.records(b"")) == []
    for bad in (good[:-1], good[:5], good[:-9] + b"?" + good[-8:], b"\x01" + good[1:]):
        with pytest.raises(ValueError):
            list(S.records(bad))
    assert list(S.records(good[:-1] + b"?", verify=False)) == [b"abcdef", b"xyz"]


def test_agent_states_run_over_past_current_and_future(spark):
    floats = {f"state/{p}/{k}": [float(a * 100 + i) for a in range(2) for i in range(n)] for p, n in (("past", 10), ("current", 1), ("future", 80)) for k in ("x", "y", "bbox_yaw", "velocity_x", "velocity_y")}
    floats["state/type"] = [1.0, 2.0]
    longs = {f"state/{p}/valid": [1] * (2 * n) for p, n in (("past", 10), ("current", 1), ("future", 80))}
    raw = spark.createDataFrame([("u", "s", floats, longs)], "source_uri string, scenario_id string, floats map<string,array<float>>, longs map<string,array<bigint>>")
    st = S.agent_states(raw)
    assert st.count() == 2 * 91 and sorted(r.t for r in st.where("agent = 1").collect()) == list(range(91))
    assert {(r.agent, r.actor_id) for r in S.actor_names(st).collect()} == {(0, "vehicle_0"), (1, "pedestrian_0")}


def tidy(spark):
    seg = spark.createDataFrame([("sc", "seg_0", 2, 7, True), ("sc", "seg_2", 3, 4, True), ("sc", "seg_10", 2, 1, False)], "scene_id string, segment_id string, num_lanes int, num_segments int, valid boolean")
    world = spark.createDataFrame([("sc", a, t, float(t), 1.0, 0.1, 5.0 + t, 9) for a in ("vehicle_0", "pedestrian_0") for t in range(3, 20)] + [("sc", "vehicle_0", 20, float("nan"), 1.0, 0.1, None, 9)], "scene_id string, actor_id string, t int, x double, y double, yaw double, long_v double, lane_id long")
    local = spark.createDataFrame(
        [("sc", s, "vehicle_0", t, t * 2.0, 0.5, 0.0, 2.0, 0.0, -1) for s in ("seg_0", "seg_2") for t in range(3, 12) if t != 6] + [("sc", "seg_0", "pedestrian_0", t, 9.0, -0.5, 0.0, 0.0, 0.0, -2) for t in range(5, 9)],
        "scene_id string, segment_id string, actor_id string, t int, s double, t_lat double, yaw_delta double, s_dot double, t_dot double, osc_lane_id int",
    )
    pairs = spark.createDataFrame([("sc", "vehicle_0", "pedestrian_0", t, 3.0 if t != 7 else float("inf"), float(t), "front" if t < 8 else "unknown") for t in (5, 6, 7, 9)], "scene_id string, ego string, npc string, t int, ttc double, eucl_distance double, position string")
    return seg, world, local, pairs


def test_scene_rows_round_trip(spark, tmp_path):
    seg, world, local, pairs = tidy(spark)
    rows = S.scene_rows(seg, world, local, pairs)
    assert [f.name for f in rows.schema] == [f.split(" ")[0] for f in S.SCENE_SCHEMA.split(", ")]
    S.write_scenes(rows, f"{tmp_path}/scenes")
    back = S.read_scenes(spark, f"{tmp_path}/scenes")
    assert back.count() == 3 and S.lane_filter(back, 2).count() == 2 and S.lane_filter(back, 2, "at_least").count() == 3
    con = duckdb.connect()
    files = f"{tmp_path}/scenes/**/*.parquet"
    n = con.execute(f"select segment_id, num_lanes, json_array_length(actors_json, '$.actor_ids'), json_extract(actors_json, '$.inter_actor') from '{files}' order by 1").fetchall()
    assert [(r[0], r[1], r[2]) for r in n] == [("seg_0", 2, 2), ("seg_10", 2, 0), ("seg_2", 3, 1)]
    sparse = json.loads(n[0][3])["vehicle_0|pedestrian_0"]
    assert sparse["eucl_distance"] == {"intervals": [[5, 7], [9, 9]], "data": [5.0, 6.0, 7.0, 9.0]}
    assert sparse["ttc"] == {"intervals": [[5, 6], [9, 9]], "data": [3.0] * 3} and sparse["position"] == {"intervals": [[5, 7]], "data": ["front"] * 3}
    assert json.loads(n[2][3]) == {}
    x = json.loads(con.execute(f"select json_extract(actors_json, '$.actor_ts.vehicle_0') from '{files}' where segment_id = 'seg_2'").fetchone()[0])
    assert (x["valid_start"], x["valid_end"], len(x["x"]), x["x"][:4], x["x"][20], x["long_v"][19]) == (3, 20, 91, [None, None, None, 3.0], None, 24.0)

    f = S.actor_frames(back)
    assert {(r.segment_id, r.actor_id) for r in f.collect()} == {("seg_0", "vehicle_0"), ("seg_0", "pedestrian_0"), ("seg_2", "vehicle_0")}
    got = {r.t: r for r in f.where("segment_id = 'seg_0' and actor_id = 'vehicle_0'").collect()}
    assert len(got) == 91 and got[4].s == 8.0 and got[4].present and not got[6].present and got[6].s is None and got[4].lane_id == -1 and got[4].speed == 9.0 and got[20].x is None
    assert got[4].actor_type == "vehicle" and f.where("actor_id = 'pedestrian_0'").first().actor_type == "person"
    p = {r.t: r for r in S.pair_frames(back, f).where("segment_id = 'seg_0'").collect()}
    assert sorted(p) == [5, 6, 7, 9] and p[6].rel_position == "front" and p[9].rel_position == "unknown" and p[7].ttc is None and p[5].lat_rel == "left"


def test_world_series_of_the_first_segment(spark):
    seg, world, local, pairs = tidy(spark)
    rows = S.scene_rows(seg, world, local, pairs).toPandas()
    blob = json.loads(rows.loc[rows.segment_id == "seg_2", "actors_json"].iloc[0])
    blob["actor_ts"]["vehicle_0"]["x"] = [77.0] * 91
    rows.loc[rows.segment_id == "seg_10", "actors_json"] = json.dumps(blob)  # seg_10 comes behind seg_2 by number, not by name
    rows.loc[rows.segment_id == "seg_0", "actors_json"] = json.dumps({"actor_ids": [], "actor_ts": {}, "seg_actor_ts": {}, "inter_actor": {}})
    f = S.actor_frames(spark.createDataFrame(rows.astype(object).where(rows.notna(), None), S.SCENE_SCHEMA))
    assert f.where("segment_id = 'seg_10' and t = 5").first().x == 5.0


def test_batch_log(spark, tmp_path):
    hits = spark.createDataFrame([("s3://b/00012/ab\"c.pkl", "seg_0", "A", {"b": "v_1", "a": "v_0"}, 3, 9), ("s3://b/00012/ab\"c.pkl", "seg_1", "A", {"a": "v_0"}, 1, 2)], "source_uri string, segment_id string, block string, roles map<string,string>, t0 int, t1 int")
    calls = spark.createDataFrame(
        [("s3://b/00012/ab\"c.pkl", "seg_0", "A", 0, {"a": "v_0", "b": "v_1"}, 9, 12), ("s3://b/00012/ab\"c.pkl", "seg_0", "A", 1, {"a": "v_0", "b": "v_1"}, 10, 12), ("s3://b/00012/ab\"c.pkl", "seg_0", "A", 1, {"a": "v_7"}, 3, 9), ("s3://b/00012/ab\"c.pkl", "seg_5", "A", 1, {"a": "v_7"}, 3, 9)],
        "source_uri string, segment_id string, block string, call int, roles map<string,string>, t0 int, t1 int",
    )
    S.write_batch_log(hits, f"{tmp_path}/log", calls, {"run": 1}, restrict=True)
    lines = [json.loads(x) for f in os.listdir(tmp_path / "log") if f.startswith("part") for x in open(tmp_path / "log" / f)]
    assert sorted(x["type"] for x in lines) == ["batch", "header"]
    batch = next(x for x in lines if x["type"] == "batch")
    assert set(batch["segments"]) == {"seg_0", "seg_1"} and [c["call"] for c in batch["segments"]["seg_0"]["calls"]] == [0]
    got = S.read_batch_log(spark, f"{tmp_path}/log", "A").collect()
    assert sorted((r.segment_id, tuple(sorted(r.roles.items())), r.t0, r.t1) for r in got) == [("seg_0", (("a", "v_0"), ("b", "v_1")), 3, 9), ("seg_1", (("a", "v_0"),), 1, 2)]
    S.write_batch_log(hits.limit(0), f"{tmp_path}/none", calls)
    assert S.read_batch_log(spark, f"{tmp_path}/none").count() == 0
    S.write_batch_log(hits, f"{tmp_path}/all", calls)
    assert "seg_5" in open(next((tmp_path / "all").glob("part-*.txt"))).read() or any("seg_5" in open(f).read() for f in (tmp_path / "all").glob("part-*"))


def test_results_examples_and_summary(spark, tmp_path):
    hits = spark.createDataFrame([("x", "r1", 1), ("y", "r1", 2)], "scenario string, run_id string, t0 int")
    S.write_results(hits, f"{tmp_path}/hits")
    S.write_results(hits.limit(0), f"{tmp_path}/empty")
    assert sorted(os.listdir(tmp_path)) == ["hits"] and (tmp_path / "hits/scenario=x/run_id=r1").is_dir()
    e = spark.createDataFrame([("b", "s", "r", 5, 2, 99, 10), ("b", "s", "r", 6, 7, 8, 10)], "block string, segment_id string, roles string, t0 int, t1_first int, t1_greedy int, T int")
    p = spark.createDataFrame([("b", "s", "r", "speed", 3.5), ("b", "s", "r", "t0", 99.0), ("b", "s", "r", "gap", float("nan"))], "block string, segment_id string, roles string, name string, value double")
    S.write_examples(e, f"{tmp_path}/examples", p)
    (row,) = [json.loads(x) for f in (tmp_path / "examples").glob("part-*.json") for x in open(f)]
    assert (row["t0"], row["t1_first"], row["t1_greedy"], row["parameters"]["speed"]) == (5, 5, 9, 3.5) and "t0" not in row["parameters"]
    seg, world, local, pairs = tidy(spark)
    S.write_scenes(S.scene_rows(seg, world, local, pairs), f"{tmp_path}/scenes")
    for _ in range(2):
        S.write_summary(S.read_scenes(spark, f"{tmp_path}/scenes"), f"{tmp_path}/summary")
    assert sorted(r[0] for r in duckdb.sql(f"select length_m from read_json_auto('{tmp_path}/summary/*.json')").fetchall()) == [5, 5, 20, 20, 35, 35]


def test_statistics_documents(spark, tmp_path):
    docs = [{"a": 1, "h": [1, 2, 3], "n": {"x": 2.5, "s": "one"}, "u": [1]}, {"a": 2, "h": [10, 0, 1], "n": {"x": 1, "s": "two", "y": 4}, "u": [1, 2]}]
    (tmp_path / "sub").mkdir()
    for i, d in enumerate(docs):
        (tmp_path / ("sub" if i else "") / f"stats-{i}.json").write_text(json.dumps(d))
    (tmp_path / "broken.json").write_text("{")
    (tmp_path / "other.txt").write_text("{}")
    m = A.merged_stats(A.flat_stats(S.read_documents(spark, str(tmp_path)))).collect()
    got = {tuple(r.path): (r.number, r.other) for r in m}
    assert got["a",][0] == 3 and got["n", "x"][0] == 3.5 and got["n", "y"][0] == 4 and [got["h", "[3]", str(i)][0] for i in range(3)] == [11, 2, 4]
    assert got["u", "[1]", "0"][0] == 1 and got["u", "[2]", "1"][0] == 2 and got["n", "s"][1] in ('"one"', '"two"')
    t = spark.createDataFrame([(1, 2.0), (0, float("nan"))], "bin int, n double")
    (doc,) = S.stats_document({"speed": t}).collect()
    assert doc.name == "speed" and json.loads(doc.value) == [{"bin": 0}, {"bin": 1, "n": 2.0}]


def test_json_lines_and_tags(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"k": 1}\n\nnot json\n{"k": 2}\n')
    assert sorted(r.k for r in S.read_json_lines(spark, str(tmp_path), "k int").collect()) == [1, 2]
    (tmp_path / "scene7.json").write_text(json.dumps({"road_segments": {"seg_0": {"num_lanes": 2, "num_segments": 3}, "seg_1": {"num_lanes": 3}}, "segment_actor_data": {"seg_0": {"v_1": {"s": [1]}, "v_0": {}}}}, indent=1))
    (r,) = S.read_tag_json(spark, f"{tmp_path}/scene7.json").collect()
    assert (r.scene_id, r.segment_id, r.num_lanes, r.num_segments, r.actors) == ("scene7", "seg_0", 2, 3, ["v_0", "v_1"])


def test_pretty(spark):
    h = spark.createDataFrame([("b", "seg_0", {"ego": "v_0"}, 2, 4, 8)], "block string, segment_id string, roles map<string,string>, t0 int, t1 int, T int")
    assert S.pretty(h, "T").first().line == "b seg_0 [2..4] ego=v_0 ..###..."
    assert len(S.pretty(h.withColumn("T", h["T"] * 100), "T", 10).first().line.split(" ")[-1]) == 10


def test_stream(spark, tmp_path):
    seg, world, local, pairs = tidy(spark)
    rows = S.scene_rows(seg, world, local, pairs)
    S.write_scenes(rows, f"{tmp_path}/in")
    find = lambda df: df.where("num_lanes = 2").selectExpr("'x' as scenario", "'r' as run_id", "segment_id")
    for more in (0, 1):
        if more:
            S.write_scenes(rows.where("segment_id = 'seg_0'"), f"{tmp_path}/in")
        q = stream.match_stream(stream.scene_stream(spark, f"{tmp_path}/in"), find, f"{tmp_path}/out", f"{tmp_path}/check")
        q.awaitTermination(120)
        assert spark.read.parquet(f"{tmp_path}/out").count() == 2 + more
