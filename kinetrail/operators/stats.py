"""Mergeable counters, histograms, probabilities, window counts and sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.intervals import islands, possible_windows


def ratio(a: Column, b: Column) -> Column:
    """a / b, 0 for an empty denominator."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def block_counters(hits: DataFrame, by: list[str]) -> DataFrame:
    return hits.groupBy(*by).agg(F.count("*").alias("bindings_with_hits"), F.sum("n_windows").alias("hit_windows"))


def probabilities(counters: DataFrame) -> DataFrame:
    """Adds p_win_cond, p_win_uncond and p_binding to a table of counters."""
    return counters.withColumns({
        "p_win_cond": ratio(F.col("hit_windows"), F.col("possible_windows_cond")),
        "p_win_uncond": ratio(F.col("hit_windows"), F.col("possible_windows_uncond")),
        "p_binding": ratio(F.col("bindings_with_hits"), F.col("bindings")),
    })


def windows_in_runs(frames: DataFrame, keys: list[str], least: int, most: int) -> DataFrame:
    """keys, n_possible: windows of admissible length inside the runs of frames."""
    r = islands(frames, keys)
    return r.groupBy(*keys).agg(F.sum(possible_windows((F.col("t1") - F.col("t0") + 1), least, most)).alias("n_possible"))


def unconditional(frames: DataFrame, roles: dict[str, str | None], least: int, most: int, limit: int | None = None) -> DataFrame:
    """scene_id, bindings, bindings_valid, possible_windows, cap_reached: of all assignments of actors to roles, whatever they do.

    An actor that fits a role is present, with a speed, on enough consecutive frames; a valid binding has a run of
    frames, least or longer, on which all its actors are present, and as many possible windows as fit in its runs.
    limit: bindings of a scene that are looked at, the first in order of their actors.
    """
    from .binding import assignments, domain

    b = assignments({r: domain(frames, kind, least, None) for r, kind in roles.items()}, limit)
    here, joint = frames.where("present").select("scene_id", "actor_id", "t"), b
    for i, r in enumerate(roles):
        joint = joint.join(here.withColumnRenamed("actor_id", r), ["scene_id", r, *(["t"] if i else [])])
    valid = windows_in_runs(joint, ["scene_id", *roles], least, most).where("n_possible > 0")
    per = valid.groupBy("scene_id").agg(F.count("*").alias("bindings_valid"), F.sum("n_possible").alias("possible_windows"))
    all_ = b.groupBy("scene_id").agg(F.count("*").alias("bindings")).join(per, "scene_id", "left").na.fill(0)
    return all_.withColumn("cap_reached", F.lit(False) if limit is None else F.col("bindings") >= limit)


def call_counters(signals: DataFrame) -> DataFrame:
    """block, call, bindings_with_hits, frames_on: of signals (block, call, frames_on and the binding)."""
    return signals.groupBy("block", "call").agg(F.count("*").alias("bindings_with_hits"), F.sum("frames_on").alias("frames_on"))


def check_counters(checks: DataFrame, by: list[str] = []) -> DataFrame:
    """check, true_frames, total_frames, signals, true_frac: summed over bindings (rows check, true_frames, frames)."""
    c = checks.groupBy(*by, "check").agg(F.sum("true_frames").alias("true_frames"), F.sum("frames").alias("total_frames"), F.count("*").alias("signals"))
    return c.withColumn("true_frac", ratio(F.col("true_frames"), F.col("total_frames")))


def by_category(rows: DataFrame, category: str, value: str) -> DataFrame:
    """category, n, total, mean, low, high, and the values that occur with their numbers, in order (bounded by the distinct values, not by the rows)."""
    per = rows.groupBy(category, value).agg(F.count("*").alias("k"))
    values = F.sort_array(F.collect_list(F.struct(F.col(value).alias("value"), F.col("k").alias("n"))))
    return per.groupBy(category).agg(F.sum("k").alias("n"), F.sum(F.col(value) * F.col("k")).alias("total"), (F.sum(F.col(value) * F.col("k")) / F.sum(F.when(F.col(value).isNotNull(), F.col("k")))).alias("mean"), F.min(value).alias("low"), F.max(value).alias("high"), values.alias("values"))


def flat_stats(documents: DataFrame, text: str = "value") -> DataFrame:
    """document, path (keys and places from the root), number, other (JSON of what isn't a number) of the leaves of JSON documents (document, text)."""
    import pyarrow as pa

    def leaves(x, at):
        if isinstance(x, dict) and x:
            for k, v in x.items():
                yield from leaves(v, [*at, k])
        elif isinstance(x, list) and x and all(isinstance(v, (int, float)) and not isinstance(v, bool) for v in x):
            yield [*at, f"[{len(x)}]"], None, None  # lists add up only if they are as long
            for i, v in enumerate(x):
                yield [*at, f"[{len(x)}]", str(i)], float(v), None
        elif isinstance(x, (int, float)) and not isinstance(x, bool):
            yield at, float(x), None
        else:
            import json

            yield at, None, json.dumps(x, sort_keys=True)

    def run(batches):
        import json

        for batch in batches:
            out = []
            for d, t in zip(batch.column("document").to_pylist(), batch.column("text").to_pylist()):
                try:
                    out += [(d, *x) for x in leaves(json.loads(t), [])]
                except (TypeError, ValueError):
                    continue  # a broken document is left out
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.string(), pa.list_(pa.string()), pa.float64(), pa.string()))], ["document", "path", "number", "other"])

    return documents.select(F.col("document").cast("string").alias("document"), F.col(text).alias("text")).mapInArrow(run, "document string, path array<string>, number double, other string")


def merged_stats(leaves: DataFrame) -> DataFrame:
    """path, number, other of all documents' leaves: numbers add up, lists of one length by place, of anything else the first document's (in order of its name) stays."""
    return leaves.groupBy("path").agg(F.sum("number").alias("number"), F.min_by("other", "document").alias("other"))


def value_counts(values: DataFrame, by: list[str], value: str) -> DataFrame:
    """Counts by category; a null value counts as invalid."""
    return values.groupBy(*by, F.coalesce(F.col(value).cast("string"), F.lit("invalid")).alias("category")).agg(F.count("*").alias("n"))


def histogram(values: DataFrame, value: str, edges: list[float], by: list[str] = []) -> DataFrame:
    """bin, n over fixed edges; bins are open on the right, and a value outside (the last edge included) or unknown is in bin -1."""
    x = F.col(value).cast("double")
    b = F.lit(-1)
    for i in range(len(edges) - 1):
        b = F.when((x >= edges[i]) & (x < edges[i + 1]), i).otherwise(b)
    return values.groupBy(*by, b.alias("bin")).agg(F.count("*").alias("n"))


def merge_counts(a: DataFrame, b: DataFrame, by: list[str], n: str = "n") -> DataFrame:
    """Sums of counters of two shards."""
    return a.unionByName(b).groupBy(*by).agg(F.sum(n).alias(n))


def equal_width_histogram(values: DataFrame, value: str, bins: int) -> DataFrame:
    """bin, n between the data's minimum and maximum; the last bin is closed; one bin where all are equal."""
    v = values.where(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("x"))
    m = v.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    b = F.when(F.col("hi") == F.col("lo"), 0).otherwise(F.least(F.floor((F.col("x") - F.col("lo")) * bins / (F.col("hi") - F.col("lo"))), F.lit(bins - 1)))
    return v.join(F.broadcast(m)).groupBy(b.cast("int").alias("bin")).agg(F.count("*").alias("n"))  # m is one row


def summary(values: DataFrame, value: str, by: list[str] = []) -> DataFrame:
    return values.groupBy(*by).agg(F.count(value).alias("n"), F.sum(value).alias("total"), F.min(value).alias("low"), F.max(value).alias("high"), F.avg(value).alias("mean"))


def tightness(checks: DataFrame, k: int) -> DataFrame:
    """The k calls with the lowest share of true frames: a report of fixed size."""
    share = ratio(F.col("true_frames"), F.col("frames"))
    g = checks.withColumn("share", share).groupBy("name").agg(F.min("share").alias("tightness"))
    return g.orderBy(F.col("tightness").asc_nulls_last(), "name").limit(k)


def sample_windows(windows: DataFrame, keys: list[str], k: int) -> DataFrame:
    """k windows, uniformly and the same every time: the lowest hashes of the keys and the window, written with blanks between."""
    h = F.md5(F.concat_ws(" ", *[F.col(c).cast("string") for c in (*keys, "t0", "t1")]))
    return windows.orderBy(h, *keys, "t0", "t1").limit(k)


def weighted_pick(windows: DataFrame, by: list[str], k: int) -> DataFrame:
    """k windows of each group."""
    w = Window.partitionBy(*by).orderBy(F.xxhash64(*windows.columns), *windows.columns)
    return windows.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= k).drop("_n")


def dedupe_examples(examples: DataFrame) -> DataFrame:
    """One example a block, segment and roles, with t0 <= t1_first <= t1_greedy inside the series."""
    e = examples.groupBy("block", "segment_id", "roles").agg(F.min_by(F.struct(*[c for c in examples.columns if c not in ("block", "segment_id", "roles")]), F.struct("t0", "t1_first", "t1_greedy")).alias("e")).select("block", "segment_id", "roles", "e.*")
    last = F.col("T") - 1
    t0 = F.greatest(F.lit(0), F.least("t0", last))
    t1 = F.least(F.greatest("t1_first", t0), last)
    return e.withColumn("_a", t0).withColumn("_b", t1).withColumn("t1_greedy", F.least(F.greatest("t1_greedy", "_b"), last)).withColumn("t0", F.col("_a")).withColumn("t1_first", F.col("_b")).drop("_a", "_b")


def lane_change_parameters(windows: DataFrame, frames: DataFrame) -> DataFrame:
    """For windows (scene_id, ego, npc, t0, t1): the npc's first change into another lane, how long before t1 it is, its speeds at t0 and there, and the gap to the ego there."""
    w = Window.partitionBy("scene_id", "actor_id").orderBy("t")
    n = frames.withColumn("moved", F.col("lane_id") != F.lag("lane_id").over(w)).select("scene_id", F.col("actor_id").alias("npc"), "t", F.col("speed").alias("v"), F.col("s").alias("ns"), F.col("lane_id").alias("to"), "moved")
    e = frames.select("scene_id", F.col("actor_id").alias("ego"), "t", F.col("s").alias("es"))
    j = windows.join(n, ["scene_id", "npc"]).where("t between t0 and t1").join(e, ["scene_id", "ego", "t"], "left")
    first = F.min(F.when(F.col("moved") & (F.col("t") > F.col("t0")), F.struct("t", "to", "v", (F.col("ns") - F.col("es")).alias("gap"))))
    g = j.groupBy("scene_id", "ego", "npc", "t0", "t1").agg(F.max(F.when(F.col("t") == F.col("t0"), F.col("v"))).alias("speed_start"), first.alias("c"))
    return g.select("scene_id", "ego", "npc", "t0", "t1", "speed_start", F.col("c.t").alias("t_change"), F.col("c.to").alias("to_lane"), F.col("c.v").alias("speed_change"), F.col("c.gap").alias("gap_change"), (F.col("t1") - F.col("c.t")).alias("frames_left"))


def quantise(x: Column, step: float) -> Column:
    """The nearest multiple of the step, halves to even."""
    return F.rint(x / step) * step


def cut_in_parameters(windows: DataFrame, frames: DataFrame) -> DataFrame:
    """For windows (scene_id, ego, npc, t0, t1): speeds at both ends, the first frame where the npc changes from lane -2 to -1, and the gap there."""
    e = frames.select("scene_id", F.col("actor_id").alias("ego"), "t", F.col("speed").alias("ego_speed"), F.col("s").alias("ego_s"))
    w = Window.partitionBy("scene_id", "actor_id").orderBy("t")
    n = frames.withColumn("moved", (F.lag("lane_id").over(w) == -2) & (F.col("lane_id") == -1)).select("scene_id", F.col("actor_id").alias("npc"), "t", F.col("speed").alias("npc_speed"), F.col("s").alias("npc_s"), "moved")
    j = windows.join(e, ["scene_id", "ego"]).where("t between t0 and t1").join(n, ["scene_id", "npc", "t"])
    at = lambda c, t: F.max(F.when(F.col("t") == F.col(t), F.col(c)))
    cut = F.min(F.when(F.col("moved"), F.struct("t", (F.col("npc_s") - F.col("ego_s")).alias("gap"))))
    g = j.groupBy("scene_id", "ego", "npc", "t0", "t1").agg(at("ego_speed", "t0").alias("ego_speed_start"), at("npc_speed", "t1").alias("npc_speed_end"), cut.alias("c"))
    return g.select("scene_id", "ego", "npc", "t0", "t1", "ego_speed_start", "npc_speed_end", F.col("c.t").alias("t_cut"), F.col("c.gap").alias("gap_cut"))


def braking_parameters(windows: DataFrame, frames: DataFrame) -> DataFrame:
    """Mean ego speed over present frames, and the least squared distance in the same lane."""
    e = frames.select("scene_id", F.col("actor_id").alias("ego"), "t", F.col("speed").alias("es"), F.col("s").alias("ss"), F.col("t_lat").alias("tt"), F.col("lane_id").alias("le"), F.col("present").alias("pe"))
    n = frames.select("scene_id", F.col("actor_id").alias("npc"), "t", F.col("s").alias("ns"), F.col("t_lat").alias("nt"), F.col("lane_id").alias("ln"))
    j = windows.join(e, ["scene_id", "ego"]).where("t between t0 and t1").join(n, ["scene_id", "npc", "t"])
    d = (F.col("ns") - F.col("ss")) * (F.col("ns") - F.col("ss")) + (F.col("nt") - F.col("tt")) * (F.col("nt") - F.col("tt"))
    return j.groupBy("scene_id", "ego", "npc", "t0", "t1").agg(F.sum(F.when(F.col("pe"), F.col("es"))).alias("speed_sum"), F.sum(F.col("pe").cast("long")).alias("n_present"), F.min(F.when(F.col("le") == F.col("ln"), d)).alias("least_same_lane"))


def crossing_parameters(windows: DataFrame, frames: DataFrame) -> DataFrame:
    """The least |ds| + |dt| in the window and its first frame."""
    e = frames.select("scene_id", F.col("actor_id").alias("ego"), "t", F.col("s").alias("ss"), F.col("t_lat").alias("tt"))
    n = frames.select("scene_id", F.col("actor_id").alias("npc"), "t", F.col("s").alias("ns"), F.col("t_lat").alias("nt"))
    j = windows.join(e, ["scene_id", "ego"]).where("t between t0 and t1").join(n, ["scene_id", "npc", "t"])
    d = F.abs(F.col("ns") - F.col("ss")) + F.abs(F.col("nt") - F.col("tt"))
    return j.groupBy("scene_id", "ego", "npc", "t0", "t1").agg(F.min(F.struct(d.alias("d"), "t")).alias("m")).select("scene_id", "ego", "npc", "t0", "t1", F.col("m.d").alias("least"), F.col("m.t").alias("t_least"))
