"""Scene tables: the storage schema, its typed form, JSON and TFRecord input, JSON-lines logs, and sinks."""

from __future__ import annotations

import struct

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Columns and fields of the storage format (SCENE_SCHEMA, ACTORS_SCHEMA, HITS_SCHEMA, BATCH_SCHEMA), frames of a scene and metres of a piece.
SCENE_SCHEMA = (
    "scene_id string, segment_id string, num_lanes int, num_segments int, target_chain_id int, valid boolean, reference_line_source string, reference_line_json string, "
    "target_polygon_json string, left_polygon_json string, right_polygon_json string, centerlines_json string, tl_results_json string, cw_results_json string, actors_json string"
)
_SPARSE = "struct<intervals:array<array<int>>,data:array<{}>>"
ACTORS_SCHEMA = (
    "actor_ids array<string>, "
    "actor_ts map<string,struct<x:array<double>,y:array<double>,yaw:array<double>,long_v:array<double>,lane_id:array<bigint>,valid_start:int,valid_end:int>>, "
    "seg_actor_ts map<string,struct<s:array<double>,t:array<double>,yaw_delta:array<double>,s_dot:array<double>,t_dot:array<double>,osc_lane_id:array<int>,valid_start:int,valid_end:int>>, "
    f"inter_actor map<string,struct<ttc:{_SPARSE.format('double')},eucl_distance:{_SPARSE.format('double')},position:{_SPARSE.format('string')}>>"
)
HITS_SCHEMA = "run_id string, scenario string, shard_index int, scene_id string, segment_id string, block_label string, roles_json string, t0 int, t1 int, n_windows int, n_possible_windows int, source_uri string"
FRAMES = 91
SEGMENT_METRES = 5.0


def read_scenes(spark: SparkSession, path: str) -> DataFrame:
    """Scene rows with source_uri; scene_id is the file's stem. Unreadable files are skipped where the session says so (spark.sql.files.ignoreCorruptFiles)."""
    df = spark.read.schema(SCENE_SCHEMA).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").parquet(path)
    uri = F.col("_metadata.file_path")
    return df.withColumn("source_uri", uri).withColumn("scene_id", F.regexp_extract(uri, r"([^/]+)\.[^./]+$", 1))


def lane_filter(scenes: DataFrame, lanes: int, mode: str = "exact") -> DataFrame:
    """Exactly so many lanes, or at least; the filter reaches the Parquet scan."""
    return scenes.where(F.col("num_lanes") == lanes if mode == "exact" else F.col("num_lanes") >= lanes)


def typed(scenes: DataFrame) -> DataFrame:
    return scenes.withColumn("a", F.from_json("actors_json", ACTORS_SCHEMA)).withColumn("length_m", F.col("num_segments") * F.lit(SEGMENT_METRES))


def _at(col: str, i: str = "t"):
    v = F.get(F.col(col), F.col(i))
    return v


def _ordinal(segment_id: str):
    """Segments are written in the order of their numbers (seg_0, seg_1, ..., seg_10)."""
    return F.struct(F.coalesce(F.regexp_extract(segment_id, r"(\d+)$", 1).try_cast("long"), F.lit(2**62)), F.col(segment_id))


def actor_frames(scenes: DataFrame, frames: int = FRAMES) -> DataFrame:
    """scene_id, segment_id, actor_id, t and the actor's values; unknown is null. An actor's world series comes from the first segment of its scene that has it; a segment without actors has no rows."""
    a = typed(scenes)
    world = a.select("scene_id", "segment_id", F.explode("a.actor_ts").alias("actor_id", "w")).groupBy("scene_id", "actor_id").agg(F.min_by("w", _ordinal("segment_id")).alias("w"))
    seg = a.select("scene_id", "segment_id", F.explode("a.seg_actor_ts").alias("actor_id", "g"))
    j = seg.join(world, ["scene_id", "actor_id"], "left").withColumn("t", F.explode(F.sequence(F.lit(0), F.lit(frames - 1))))
    num = lambda c: F.when(~F.isnan(_at(c)), _at(c))
    lane = F.get("g.osc_lane_id", F.col("t"))
    out = j.select(
        "scene_id", "segment_id", "actor_id", "t", num("w.x").alias("x"), num("w.y").alias("y"), num("w.yaw").alias("yaw"), num("w.long_v").alias("speed"), num("g.s").alias("s"), num("g.t").alias("t_lat"),
        num("g.yaw_delta").alias("yaw_delta"), num("g.s_dot").alias("s_dot"), num("g.t_dot").alias("t_dot"), lane.alias("lane_id"),
    )
    from ..functions.series import central_difference
    from ..operators.binding import type_of

    return out.withColumn("present", F.col("s").isNotNull()).withColumn("accel", central_difference("speed", ["scene_id", "segment_id", "actor_id"], 0.1)).withColumn("actor_type", type_of("actor_id"))


def pair_frames(scenes: DataFrame, actors: DataFrame) -> DataFrame:
    """scene_id, segment_id, ego, npc, t, rel_position, rel_distance, ttc, lat_rel."""
    from ..functions.series import clean_distance, clean_relation, clean_ttc, decode_sparse, lateral_relation

    keys = ["scene_id", "segment_id", "ego", "npc"]
    p = typed(scenes).select("scene_id", "segment_id", F.explode("a.inter_actor").alias("pair", "v"))
    p = p.select("scene_id", "segment_id", F.split("pair", r"\|", 2)[0].alias("ego"), F.split("pair", r"\|", 2)[1].alias("npc"), "v")

    def field(name, to):
        return decode_sparse(p.select(*keys, f"v.{name}.intervals", f"v.{name}.data"), keys, to)

    j = field("eucl_distance", "d").join(field("ttc", "c"), [*keys, "t"], "left").join(field("position", "p"), [*keys, "t"], "left")
    lane = actors.select("scene_id", "segment_id", "actor_id", "t", "lane_id")
    e, n = lane.withColumnsRenamed({"actor_id": "ego", "lane_id": "le"}), lane.withColumnsRenamed({"actor_id": "npc", "lane_id": "ln"})
    j = j.join(e, ["scene_id", "segment_id", "ego", "t"], "left").join(n, ["scene_id", "segment_id", "npc", "t"], "left")
    return j.select(*keys, "t", clean_relation(F.col("p")).alias("rel_position"), clean_distance(F.col("d")).alias("rel_distance"), clean_ttc(F.col("c"), F.col("d")).alias("ttc"), lateral_relation(F.col("ln"), F.col("le")).alias("lat_rel"))


def write_scenes(rows: DataFrame, path: str, one_file_a_scene: bool = False) -> None:
    """Scene rows as Snappy Parquet; by scene in one file each only where another reader asks for it."""
    out = rows.repartition("scene_id")
    (out.write.partitionBy("scene_id") if one_file_a_scene else out.write).option("compression", "snappy").mode("append").parquet(path)


def write_results(table: DataFrame, path: str) -> None:
    """A result table by scenario and run; an empty one isn't written."""
    if not table.isEmpty():
        table.write.mode("append").partitionBy("scenario", "run_id").parquet(path)


def segment_summary(scenes: DataFrame) -> DataFrame:
    return scenes.select("source_uri", F.col("segment_id").alias("seg_id"), "num_lanes", (F.col("num_segments") * F.lit(SEGMENT_METRES)).alias("length_m"))


def json_safe(x):
    """NaN and infinities as null, for to_json."""
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)


BATCH_SCHEMA = "type string, source_uri string, segments map<string,struct<blocks:array<struct<label:string,roles:map<string,string>,t0:int,t1:int>>>>"


def read_batch_log(spark: SparkSession, path: str, block: str | None = None) -> DataFrame:
    """Flat block hits of JSON-lines logs; blank, broken and other lines are left out."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    b = lines.select(F.from_json("value", BATCH_SCHEMA).alias("j")).select("j.*").where(F.col("type") == "batch")
    h = b.select("source_uri", F.regexp_extract("source_uri", r"/(\d{5})/([A-Za-z0-9]+)\.pkl$", 1).alias("shard"), F.regexp_extract("source_uri", r"/(\d{5})/([A-Za-z0-9]+)\.pkl$", 2).alias("scene_id"), F.explode("segments").alias("segment_id", "v"))
    h = h.select("source_uri", "shard", "scene_id", "segment_id", F.explode("v.blocks").alias("b")).select("source_uri", "shard", "scene_id", "segment_id", F.col("b.label").alias("block"), "b.roles", "b.t0", "b.t1")
    return h if block is None else h.where(F.col("block") == block)


def write_batch_log(hits: DataFrame, path: str, calls: DataFrame | None = None, header: dict | None = None, restrict: bool = False, overlap: bool = True) -> None:
    """JSON lines: a header if given, then one line a source with its segments' block hits and call signals.

    hits: source_uri, segment_id, block, roles (map of strings), t0, t1. calls: the same with call, its number.
    restrict: only calls that take part in a block hit of the same block, segment and roles, whose intervals overlap
    it (unless ``overlap`` is false), and only segments with block hits. A source with nothing to say has no line.
    """
    spark = hits.sparkSession
    key = F.to_json(F.map_from_entries(F.array_sort(F.map_entries("roles"))))
    h = hits.withColumn("_r", key)
    blocks = h.groupBy("source_uri", "segment_id").agg(F.sort_array(F.collect_list(F.struct(F.col("block").alias("label"), "t0", "t1", F.col("_r").alias("roles_json")))).alias("b"))
    roles = lambda x: F.from_json(x["roles_json"], "map<string,string>").alias("roles")
    blocks = blocks.select("source_uri", "segment_id", F.transform("b", lambda x: F.struct(x["label"].alias("label"), roles(x), x["t0"].alias("t0"), x["t1"].alias("t1"))).alias("blocks"))
    per = blocks.withColumn("calls", F.lit(None).cast("array<struct<label:string,call:int,roles:map<string,string>,t0:int,t1:int>>"))
    if calls is not None:
        c = calls.withColumn("_r", key)
        if restrict:
            on = ["source_uri", "segment_id", "block", "_r"]
            o = h.select(*[F.col(x).alias(f"_{x}") for x in on], F.col("t0").alias("_t0"), F.col("t1").alias("_t1"))
            cond = [F.col(x) == F.col(f"_{x}") for x in on]
            c = c.join(o, cond + ([F.col("t0") <= F.col("_t1"), F.col("_t0") <= F.col("t1")] if overlap else []), "left_semi")
        c = c.groupBy("source_uri", "segment_id").agg(F.sort_array(F.collect_list(F.struct(F.col("block").alias("label"), "call", "t0", "t1", F.col("_r").alias("roles_json")))).alias("c"))
        c = c.select("source_uri", "segment_id", F.transform("c", lambda x: F.struct(x["label"].alias("label"), x["call"].alias("call"), roles(x), x["t0"].alias("t0"), x["t1"].alias("t1"))).alias("calls"))
        per = blocks.join(c, ["source_uri", "segment_id"], "left" if restrict else "full")
    b = per.groupBy("source_uri").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("segment_id", F.to_json(F.struct("blocks", "calls")).alias("v"))))).alias("s"))
    body = F.concat_ws(",", F.transform(F.map_entries("s"), lambda e: F.concat(_quoted(e["key"]), F.lit(":"), e["value"])))
    lines = b.select(F.concat(F.lit('{"type":"batch","source_uri":'), _quoted(F.col("source_uri")), F.lit(',"segments":{'), body, F.lit("}}")).alias("value"))
    if header is not None:
        import json

        spark.createDataFrame([(json.dumps({"type": "header", **header}),)], "value string").coalesce(1).write.mode("append").text(path)
    lines.write.mode("append").text(path)


def timeline(t0, t1, frames, width: int = 100):
    """A row of signs for a series of frames: # for those of [t0, t1], a dot for others, shortened to a width."""
    cells = F.least(frames, F.lit(width))
    hit = lambda i: (F.floor((i + 1) * frames / cells) > t0) & (F.floor(i * frames / cells) <= t1)
    return F.when(frames > 0, F.concat_ws("", F.transform(F.sequence(F.lit(0), (cells - 1).cast("int")), lambda i: F.when(hit(i), "#").otherwise(".")))).otherwise("")


def pretty(hits: DataFrame, frames: str, width: int = 60) -> DataFrame:
    """One line of text a hit (block, segment_id, roles, t0, t1 and a column of the scene's frames), for reading."""
    who = F.concat_ws(", ", F.transform(F.array_sort(F.map_entries("roles")), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return hits.select(F.concat_ws(" ", "block", "segment_id", F.concat(F.lit("["), F.col("t0"), F.lit(".."), F.col("t1"), F.lit("]")), who, timeline(F.col("t0"), F.col("t1"), F.col(frames), width)).alias("line"))


def write_examples(examples: DataFrame, path: str, parameters: DataFrame | None = None) -> None:
    """Example windows as JSON lines, one a block, segment and roles (see dedupe_examples); parameters (block, segment_id, roles, name, value) are further keys of a line and never replace one of its own."""
    from ..operators.stats import dedupe_examples

    e = dedupe_examples(examples)
    if parameters is not None:
        own = F.array(*[F.lit(c) for c in e.columns])
        p = parameters.where(~F.array_contains(own, F.col("name"))).groupBy("block", "segment_id", "roles").agg(F.map_from_entries(F.sort_array(F.collect_set(F.struct("name", json_safe(F.col("value")).alias("value"))))).alias("parameters"))
        e = e.join(p, ["block", "segment_id", "roles"], "left")
    e.write.mode("append").json(path)


def write_summary(scenes: DataFrame, path: str) -> None:
    """The segment summary as JSON lines, appended."""
    segment_summary(scenes).write.mode("append").json(path)


def stats_document(tables: dict[str, DataFrame]) -> DataFrame:
    """name, value: each table of counters or histogram bins as one JSON array of its rows, in order. Tables of statistics have as many rows as there are blocks, checks or bins."""
    out = None
    for name, t in tables.items():
        rows = F.sort_array(F.collect_list(F.to_json(F.struct(*[json_safe(F.col(c)).alias(c) if k in ("double", "float") else F.col(c) for c, k in t.dtypes]))))
        one = t.agg(F.concat(F.lit("["), F.array_join(rows, ","), F.lit("]")).alias("value")).select(F.lit(name).alias("name"), "value")
        out = one if out is None else out.union(one)
    return out


# ---- reading JSON --------------------------------------------------------------------------


def read_tag_json(spark: SparkSession, path: str) -> DataFrame:
    """scene_id (the file's stem), segment_id, num_lanes, num_segments, actors (ids) of the segments of tag files, one JSON object each: road_segments by id, and segment_actor_data by segment and actor."""
    schema = "road_segments map<string,struct<num_lanes:int,num_segments:int>>, segment_actor_data map<string,map<string,string>>"
    df = spark.read.schema(schema).option("multiLine", "true").json(path)
    df = df.withColumn("scene_id", F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.[^./]+$", 1))
    rows = df.select("scene_id", "segment_actor_data", F.explode("road_segments").alias("segment_id", "r"))
    actors = F.coalesce(F.sort_array(F.map_keys(F.element_at("segment_actor_data", F.col("segment_id")))), F.array().cast("array<string>"))
    return rows.select("scene_id", "segment_id", F.coalesce("r.num_lanes", F.lit(0)).alias("num_lanes"), F.coalesce("r.num_segments", F.lit(0)).alias("num_segments"), actors.alias("actors")).where(F.size("actors") > 0)


def read_documents(spark: SparkSession, folder: str, suffix: str = ".json") -> DataFrame:
    """document (its path), value (its text) of all files below a folder with an ending: statistics of shards."""
    df = spark.read.option("wholetext", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{suffix}").text(folder)
    return df.select(F.col("_metadata.file_path").alias("document"), "value")


def read_json_lines(spark: SparkSession, folder: str, schema: str, suffix: str = ".jsonl") -> DataFrame:
    """The rows of all JSON-lines files below a folder; blank and broken lines are left out."""
    df = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{suffix}").text(folder).where(F.trim("value") != "")
    j = F.from_json("value", f"{schema}, _broken string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"})
    return df.select(j.alias("j")).where("j is not null and j._broken is null").select("j.*").drop("_broken")


# ---- scenes to rows ------------------------------------------------------------------------


def scene_rows(segments: DataFrame, world: DataFrame, local: DataFrame, pairs: DataFrame, frames: int = FRAMES) -> DataFrame:
    """Rows of the storage schema, one a segment, from tidy tables.

    segments: scene_id, segment_id and any of the schema's scalar and geometry columns (text, else null);
    world: scene_id, actor_id, t, x, y, yaw, long_v, lane_id; local: scene_id, segment_id, actor_id, t, s, t_lat,
    yaw_delta, s_dot, t_dot, osc_lane_id; pairs: scene_id, ego, npc, t, ttc, eucl_distance, position. An actor is in
    a segment where local has it. Series have a value for each frame, null where unknown (NaN and infinities too);
    pairs are kept sparsely, and only if both actors are in the segment and something is known of them.
    """

    def series(df, keys, names, to):
        at = F.filter(F.collect_list(F.struct("t", *[(json_safe(F.col(c)) if k in ("double", "float") else F.col(c)).alias(c) for c, k in df.dtypes if c in names])), lambda x: x["t"].isNotNull())
        g = df.groupBy(*keys).agg(F.map_from_entries(F.transform(at, lambda x: F.struct(x["t"].cast("int"), x))).alias("m"), F.min("t").cast("int").alias("lo"), F.max("t").cast("int").alias("hi"))
        grid = F.sequence(F.lit(0), F.lit(frames - 1))
        value = lambda c: lambda i: F.try_element_at("m", i)[c]
        return g.select(*keys, F.struct(*[F.transform(grid, value(c)).alias(n) for c, n in zip(names, to)], F.col("lo").alias("valid_start"), F.col("hi").alias("valid_end")).alias("v"))

    g = series(world, ["scene_id", "actor_id"], ["x", "y", "yaw", "long_v", "lane_id"], ["x", "y", "yaw", "long_v", "lane_id"])
    own = series(local, ["scene_id", "segment_id", "actor_id"], ["s", "t_lat", "yaw_delta", "s_dot", "t_dot", "osc_lane_id"], ["s", "t", "yaw_delta", "s_dot", "t_dot", "osc_lane_id"])
    members = own.select("scene_id", "segment_id", "actor_id")
    by = ["scene_id", "segment_id"]

    def table(df, name, value="v", key="actor_id"):
        return df.groupBy(*by).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(key, F.to_json(value).alias("v"))))).alias(name))

    from ..functions.series import encode_sparse

    p = pairs.join(members.withColumnRenamed("actor_id", "ego"), ["scene_id", "ego"]).join(members.withColumnRenamed("actor_id", "npc"), ["scene_id", "segment_id", "npc"])
    keys = ["scene_id", "segment_id", "ego", "npc"]
    sparse = None
    for c, k in (("ttc", "double"), ("eucl_distance", "double"), ("position", "string")):
        v = p.withColumn(c, json_safe(F.col(c)) if k == "double" else F.col(c))
        e = encode_sparse(v, keys, c).select(*keys, F.struct("intervals", "data").alias(c))
        sparse = e if sparse is None else sparse.join(e, keys, "full")
    none = lambda k: F.struct(F.array().cast("array<array<int>>").alias("intervals"), F.array().cast(f"array<{k}>").alias("data"))
    sparse = sparse.select(*by, F.concat("ego", F.lit("|"), "npc").alias("pair"), F.struct(*[F.coalesce(F.col(c), none(k)).alias(c) for c, k in (("ttc", "double"), ("eucl_distance", "double"), ("position", "string"))]).alias("v"))
    parts = [
        members.groupBy(*by).agg(F.sort_array(F.collect_list("actor_id")).alias("ids")),
        table(members.join(g, ["scene_id", "actor_id"]), "actor_ts"), table(own, "seg_actor_ts"), table(sparse, "inter_actor", key="pair"),
    ]
    out = segments
    for t in parts:
        out = out.join(t, by, "left")

    def entries(name):
        """A map of JSON values as a JSON object."""
        one = lambda e: F.concat(_quoted(e["key"]), F.lit(":"), e["value"])
        return F.concat(F.lit(f'"{name}":{{'), F.coalesce(F.array_join(F.transform(F.map_entries(name), one), ","), F.lit("")), F.lit("}"))

    ids = F.to_json(F.coalesce("ids", F.array().cast("array<string>")))
    blob = F.concat(F.lit('{"actor_ids":'), ids, F.lit(","), entries("actor_ts"), F.lit(","), entries("seg_actor_ts"), F.lit(","), entries("inter_actor"), F.lit("}"))
    out = out.withColumn("actors_json", blob)
    fields = [f.strip().split(" ") for f in SCENE_SCHEMA.split(", ")]
    return out.select(*[(F.col(n) if n in out.columns else F.lit(None)).cast(k).alias(n) for n, k in fields])


def _quoted(x):
    """A string as JSON."""
    j = F.to_json(F.struct(x.alias("k")))
    return j.substr(F.lit(6), F.length(j) - 6)


# ---- TFRecord ------------------------------------------------------------------------------


def _varint(b: bytes, i: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        n |= (b[i] & 127) << shift
        shift, i = shift + 7, i + 1
        if b[i - 1] < 128:
            return n, i


def _fields(b: bytes):
    """(number, value) of a protobuf message: integers, or bytes of a length-delimited field."""
    i = 0
    while i < len(b):
        tag, i = _varint(b, i)
        kind = tag & 7
        if kind == 0:
            v, i = _varint(b, i)
        elif kind == 2:
            n, i = _varint(b, i)
            v, i = b[i : i + n], i + n
        else:
            n = 4 if kind == 5 else 8
            v, i = b[i : i + n], i + n
        yield tag >> 3, v


def decode_example(b: bytes) -> dict[str, list]:
    """The features of a serialized example: lists of bytes, floats or integers by name."""
    out: dict[str, list] = {}
    for _, features in _fields(b):
        for _, entry in _fields(features):
            name, value = "", b""
            for n, v in _fields(entry):
                name, value = (v.decode(), value) if n == 1 else (name, v)
            for kind, packed in _fields(value):
                vals: list = out.setdefault(name, [])
                for _, v in _fields(packed):
                    if kind == 1:
                        vals.append(v)
                    elif kind == 2:
                        vals += struct.unpack(f"<{len(v) // 4}f", v)
                    elif isinstance(v, int):
                        vals.append(v - (1 << 64) if v >> 63 else v)
                    else:
                        i = 0
                        while i < len(v):
                            x, i = _varint(v, i)
                            vals.append(x - (1 << 64) if x >> 63 else x)
    return out


def _crc_table() -> np.ndarray:
    """Of the Castagnoli polynomial, reflected."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0x82F63B78), t >> 1)
    return t


_CRC = _crc_table()
LANES = 1024


def _applied(columns: np.ndarray, v: np.ndarray) -> np.ndarray:
    """A linear map of 32 bits, by the images of the bits."""
    out = np.zeros_like(v)
    for i in range(32):
        out ^= np.where((v >> np.uint32(i)) & 1, columns[i], np.uint32(0))
    return out


def crc32c(data: bytes) -> int:
    """The checksum, for many lanes of the data at a time; neighbouring lanes are then put together two by two."""
    x = np.frombuffer(data, np.uint8).copy()
    lanes = LANES if len(x) > 16 * LANES else 1
    pad = -len(x) % lanes  # zeros in front change nothing in a sum that starts at zero
    ones = np.full(len(x), 0, np.uint8)
    ones[:4] = 255
    if len(x) < 4:
        state = np.uint32(0xFFFFFFFF)
        for c in x:
            state = (state >> np.uint32(8)) ^ _CRC[(state ^ c) & np.uint32(255)]
        return int(state) ^ 0xFFFFFFFF
    x = np.concatenate((np.zeros(pad, np.uint8), x ^ ones)).reshape(lanes, -1)
    state = np.zeros(lanes, np.uint32)
    for j in range(x.shape[1]):
        state = (state >> np.uint32(8)) ^ _CRC[(state ^ x[:, j]) & np.uint32(255)]
    if lanes > 1:
        bits = np.uint32(1) << np.arange(32, dtype=np.uint32)
        shift = bits  # behind as many zero bytes as a lane is long, by squaring
        square, n = (bits >> np.uint32(8)) ^ _CRC[bits & np.uint32(255)], x.shape[1]
        while n:
            if n & 1:
                shift = _applied(square, shift)
            square, n = _applied(square, square), n >> 1
        while len(state) > 1:
            state = _applied(shift, state[0::2]) ^ state[1::2]
            shift = _applied(shift, shift)
    return int(state[0]) ^ 0xFFFFFFFF


def masked_crc(data: bytes) -> int:
    """A checksum as TFRecord files store it."""
    c = crc32c(data)
    return (((c >> 15) | (c << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def records(data: bytes, verify: bool = True):
    """The records of a TFRecord file: length, its checksum, data, its checksum. A record that is cut off or doesn't fit its checksum is an error."""
    i = 0
    while i < len(data):
        if i + 12 > len(data):
            raise ValueError(f"a record is cut off at byte {i}")
        n, head = struct.unpack_from("<QI", data, i)
        if head != masked_crc(data[i : i + 8]):
            raise ValueError(f"a length at byte {i} doesn't fit its checksum")
        if i + 16 + n > len(data):
            raise ValueError(f"a record is cut off at byte {i}")
        body = data[i + 12 : i + 12 + n]
        if verify and struct.unpack_from("<I", data, i + 12 + n)[0] != masked_crc(body):
            raise ValueError(f"a record at byte {i} doesn't fit its checksum")
        yield body
        i += 16 + n


def shard_paths(spark: SparkSession, folders: list[str], shards: list[int], n: int, stem: str = "training_tfexample.tfrecord") -> list[str]:
    """The path of each shard (stem-00007-of-01000) in the first of the folders that has it; any store that Spark reads. A shard that none has is an error."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for k in shards:
        if not 0 <= k < n:
            raise ValueError(f"no shard {k} of {n}")
        for folder in folders:
            path = jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{stem}-{k:05d}-of-{n:05d}")
            if path.getFileSystem(conf).exists(path):
                out.append(path.toString())
                break
        else:
            raise FileNotFoundError(f"shard {k} of {n} is in none of {folders}")
    return out


def read_tfrecords(spark: SparkSession, path: str | list[str], verify: bool = True, step: int = 8) -> DataFrame:
    """source_uri, scenario_id, floats, longs (maps from feature to values) of each record. A file is one task's, as its records are found one after the other; ``step`` records at a time leave it."""

    def run(batches):
        import pandas as pd

        names = ["source_uri", "scenario_id", "floats", "longs"]
        for pdf in batches:
            for uri, data in zip(pdf["path"], pdf["content"]):
                rows = []
                for r in records(data, verify):
                    f = decode_example(r)
                    sid = f.get("scenario/id", [b""])[0]
                    rows.append((uri, sid.decode() if isinstance(sid, bytes) else str(sid), {k: v for k, v in f.items() if v and isinstance(v[0], float)}, {k: v for k, v in f.items() if v and isinstance(v[0], int)}))
                    if len(rows) == step:
                        yield pd.DataFrame(rows, columns=names)
                        rows = []
                yield pd.DataFrame(rows, columns=names)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "source_uri string, scenario_id string, floats map<string,array<float>>, longs map<string,array<bigint>>")


def agent_states(raw: DataFrame) -> DataFrame:
    """scenario_id, agent, t, x, y, yaw, vx, vy, valid, type from past, current and future features (time runs on over the three)."""
    parts, start = [], 0
    for name, n in (("past", 10), ("current", 1), ("future", 80)):
        f = lambda k, name=name: F.col("floats")[f"state/{name}/{k}"]
        p = raw.select("scenario_id", F.col("floats")["state/type"].alias("types"), *[f(k).alias(k) for k in ("x", "y", "bbox_yaw", "velocity_x", "velocity_y")], F.col("longs")[f"state/{name}/valid"].alias("ok"))
        p = p.select("*", F.posexplode("x").alias("i", "px"))
        i = F.col("i")
        parts.append(p.select("scenario_id", F.expr(f"i div {n}").cast("int").alias("agent"), (i % n + start).cast("int").alias("t"), F.col("px").cast("double").alias("x"), *[F.get(c, i).cast("double").alias(a) for c, a in (("y", "y"), ("bbox_yaw", "yaw"), ("velocity_x", "vx"), ("velocity_y", "vy"))], (F.get("ok", i) == 1).alias("valid"), F.get("types", F.expr(f"cast(i div {n} as int)")).cast("int").alias("type")))
        start += n
    return parts[0].union(parts[1]).union(parts[2])


TYPES = ["Unset", "Vehicle", "Pedestrian", "Cyclist", "Other"]


def actor_names(states: DataFrame) -> DataFrame:
    """scenario_id, agent, actor_id: the type and the agent's place among its type."""
    a = states.select("scenario_id", "agent", "type").distinct()
    w = Window.partitionBy("scenario_id", "type").orderBy("agent")
    name = F.lower(F.get(F.array(*map(F.lit, TYPES)), F.col("type")))
    return a.select("scenario_id", "agent", F.concat(name, F.lit("_"), (F.row_number().over(w) - 1).cast("string")).alias("actor_id"))

