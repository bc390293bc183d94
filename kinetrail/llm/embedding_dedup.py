"""Embedding near-dedup by sorted projection passes.

Each pass concatenates the signs of random projections to one hash, orders the vectors by it and compares
each vector with the ``NEAR`` that follow. Vectors with equal components travel once, as one class. The number
of passes follows from the counted vectors of a length (``passes``), so that at any size at most ``MISSED`` of
the isolated pairs at the least cosine are expected to meet in no window.

What travels in a pass is a vector of one byte a component, with the length of its rounding error. That bounds
the cosine of a pair from both sides: most pairs are links for sure or no links for sure. Of the sure links of
a window a spanning forest is enough; the few pairs between are compared in double precision, if their ends do
not lie in one component anyway.

A window bounds what a pass compares, so a group of more near vectors than a window holds isn't listed pair
by pair there. It need not be: it is one component, and the links inside each component are then counted by
comparing the component's vectors in blocks (``BLOCK`` by ``BLOCK``, each pair of blocks in a task of its own,
only counts leave it). So a link is missed only if no path of found pairs joins its two ends.

The cosine is taken in double precision. Defined cases: a vector that is null, empty, zero or has null or
non-finite components, and one with a null id, links with nothing; vectors of different lengths don't link;
rows that repeat a vec_id are vectors of their own. Classes are told apart by a 64-bit hash of their components:
if two classes share one, which is not expected below some 10**9 classes, both take part under that name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .graph import components

LEAST_PASSES, NEAR, HASH_BITS = 14, 48, 62
COSINE, MISSED = 0.9, 0.01
BLOCK, STRIP = 8192, 512
#: Sure links that a task gathers before it turns them into a forest.
_FLUSH = 400_000


def _matrix(col: pa.Array) -> np.ndarray:
    values = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(col), -1) if len(col) else np.zeros((0, 1))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow or underflow in the squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def projections(dim: int, p: int) -> np.ndarray:
    return np.random.default_rng(1000 + p).standard_normal((dim, HASH_BITS))


def passes(n: int, dim: int) -> int:
    """Passes after which a pair at cosine COSINE among n vectors in random directions is missed with probability MISSED.

    A pair meets when its ends agree in so many leading signs, k, that at most NEAR of the n agree in them with one
    end. An end agrees in a sign with probability 1 - angle / pi. In fewer than 16 dimensions tables of a size that
    matters have no isolated pairs; they get the passes of 16.
    """
    angle = np.linspace(0, np.pi, 20001)[1:-1]
    density = np.sin(angle) ** (max(dim, 16) - 2)
    density /= density.sum()
    k, agree = 0, 1 - angle / np.pi
    while n * (density @ agree**k) > NEAR:
        k += 1
    meet = (1 - np.arccos(COSINE) / np.pi) ** k
    return LEAST_PASSES if meet == 1 else max(LEAST_PASSES, int(np.ceil(np.log(MISSED) / np.log1p(-meet))))


def rounded(x: np.ndarray) -> np.ndarray:
    """Unit vectors as bytes: a signed byte a component, then their scale and the length of the rounding error as 32-bit floats."""
    scale = (np.abs(x).max(axis=1) / 127).astype(np.float32)
    q = np.rint(x / scale[:, None].astype(np.float64)).clip(-127, 127).astype(np.int8)
    off = np.sqrt(((x - q * scale[:, None].astype(np.float64)) ** 2).sum(axis=1)) * (1 + 1e-6)
    return np.concatenate((q.view(np.uint8), scale[:, None].view(np.uint8), off.astype(np.float32)[:, None].view(np.uint8)), axis=1)


def _restored(col: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """The rounded vectors and the lengths of their errors."""
    at = np.frombuffer(col.buffers()[1], np.int32)[col.offset : col.offset + 1]
    raw = np.frombuffer(col.buffers()[2], np.uint8)[at[0] : at[0] + len(col) * (dim + 8)].reshape(len(col), dim + 8)
    scale, off = (np.ascontiguousarray(raw[:, i : i + 4]).view(np.float32)[:, 0] for i in (dim, dim + 4))
    return raw[:, :dim].view(np.int8) * scale[:, None], off


def _judge(estimate, e1, e2, dim):
    """Which pairs are links for sure, and which may be: the error of a product is bounded by those of its sides."""
    bound = e1 + e2 + e1 * e2 + np.float32(1e-6 + 1.2e-7 * dim)
    return estimate - bound >= COSINE, estimate + bound >= COSINE


def _pairs(rid, x, off):
    """(a, b, sure) of rows with one of the NEAR rows behind that may link."""
    out = []
    for d in range(1, min(NEAR, len(x) - 1) + 1):
        sure, maybe = _judge(np.einsum("ij,ij->i", x[:-d], x[d:]), off[:-d], off[d:], x.shape[1])
        i = np.flatnonzero(maybe)
        out.append((rid[i], rid[i + d], sure[i]))
    return [np.concatenate(z) for z in zip(*out)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)]


def _forest(a, b, sure):
    """The same pairs with a star for each group of sure links, and of the others those between groups."""
    ids, ends = np.unique(np.concatenate((a, b)), return_inverse=True)
    u, v = ends[: len(a)], ends[len(a) :]
    low = np.arange(len(ids))
    while True:
        new = low.copy()
        np.minimum.at(new, u[sure], low[v[sure]])
        np.minimum.at(new, v[sure], low[u[sure]])
        new = np.minimum(new, new[new])
        if (new == low).all():
            break
        low = new
    star = np.flatnonzero(low != np.arange(len(ids)))
    open_ = np.flatnonzero(~sure & (low[u] != low[v]))
    return np.concatenate((ids[low[star]], a[open_])), np.concatenate((ids[star], b[open_])), np.concatenate((np.ones(len(star), bool), np.zeros(len(open_), bool)))


def near_pairs(reps: DataFrame) -> DataFrame:
    """(a, b, sure) for reps (rid, dim, embedding): links that span what meets in the windows, and pairs that may link (sure: false)."""
    rounds = {r.dim: passes(r.n, r.dim) for r in reps.groupBy("dim").agg(F.count("*").alias("n")).collect()}

    def spread(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                x = _unit(_matrix(part.column("embedding")))
                packed = rounded(x)
                q = pa.BinaryArray.from_buffers(pa.binary(), len(x), [None, pa.py_buffer((np.arange(len(x) + 1) * packed.shape[1]).astype(np.int32).tobytes()), pa.py_buffer(packed.tobytes())])
                for p in range(rounds[int(dim)]):
                    bits = (x @ projections(int(dim), p) > 0).astype(np.int64)
                    h = bits @ (1 << np.arange(HASH_BITS - 1, -1, -1, dtype=np.int64))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), p, np.int32)), part.column("dim"), pa.array(h), part.column("rid"), q], ["pass", "dim", "h", "rid", "q"])

    names = ["place", "pass", "dim", "a", "b", "sure", "q"]
    types = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]

    def slide(batches):
        """Windows inside a partition; its first and last vectors go on as the ends that meet its neighbours'."""
        from pyspark import TaskContext

        pid = TaskContext.get().partitionId()
        key, rid, x, off, q, seen, held, size = None, None, None, None, None, 0, [], 0

        def rows(place, a, b, sure, q):
            n = len(a)
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip((np.full(n, place), np.full(n, key[0]), np.full(n, key[1]), a, b, sure, q), types)], names)

        def ends(place, rid, q):
            return rows(place, rid, [None] * len(rid), [None] * len(rid), q)

        def flush():
            a, b, sure = _forest(*(np.concatenate(z) for z in zip(*held)))
            return rows(0, a, b, sure, [None] * len(a))

        for batch in batches:
            ps, ds, ids = (batch.column(c).to_numpy() for c in ("pass", "dim", "rid"))
            cut = np.flatnonzero(np.concatenate(([True], (ps[1:] != ps[:-1]) | (ds[1:] != ds[:-1]), [True]))) if len(ps) else [0]
            for s, e in zip(cut, cut[1:]):
                col = batch.column("q").slice(s, e - s)
                now, err = _restored(col, int(ds[s]))
                if key != (ps[s], ds[s]):
                    if key is not None:
                        if held:
                            yield flush()
                        yield ends(2 * pid + 2, rid[-NEAR:], q[-NEAR:])
                    key, rid, x, off, q, seen, held, size = (ps[s], ds[s]), ids[s:e], now, err, col[-NEAR:].to_pylist(), 0, [], 0
                else:
                    rid, x, off = np.concatenate((rid[-NEAR:], ids[s:e])), np.concatenate((x[-NEAR:], now)), np.concatenate((off[-NEAR:], err))
                    q = (q + col[-NEAR:].to_pylist())[-NEAR:]
                if seen < NEAR:
                    k = min(NEAR - seen, e - s)
                    seen += k
                    yield ends(2 * pid + 1, ids[s : s + k], col[:k].to_pylist())
                held.append(_pairs(rid, x, off))
                size += len(held[-1][0])
                if size > _FLUSH:
                    yield flush()
                    held, size = [], 0
        if key is not None:
            if held:
                yield flush()
            yield ends(2 * pid + 2, rid[-NEAR:], q[-NEAR:])

    def meet(t: pa.Table) -> pa.Table:
        """The last vectors of one partition with the first of the next: odd places are firsts."""
        place, rid = t.column("place").to_numpy(), t.column("a").to_numpy()
        x, off = _restored(t.column("q").combine_chunks(), int(t.column("dim")[0].as_py()))
        i, j = np.flatnonzero(place % 2 == 0), np.flatnonzero(place % 2 == 1)
        sure, maybe = _judge(x[i] @ x[j].T, off[i][:, None], off[j], x.shape[1])
        r, c = np.nonzero(maybe)
        return pa.table({"a": rid[i][r], "b": rid[j][c], "sure": sure[r, c]})

    order = ["pass", "dim", "h", "rid"]
    dealt = reps.mapInArrow(C.batchwise(spread), "pass int, dim int, h long, rid long, q binary").repartitionByRange(*order).sortWithinPartitions(*order)
    scratch = C.Scratch(reps.sparkSession, "windows")
    found = scratch.keep(dealt.mapInArrow(C.batchwise(slide), "place int, pass int, dim int, a long, b long, sure boolean, q binary"), "found")
    # A partition's last vectors (2 p + 2) and its successor's first (2 (p + 1) + 1) have the same half.
    border = found.where("place > 0").withColumn("gap", F.expr("place div 2")).select("gap", "pass", "dim", "place", "a", "q")
    met = border.groupBy("gap", "pass", "dim").applyInArrow(meet, "a long, b long, sure boolean")
    both = found.where("place = 0").select("a", "b", "sure").union(met)
    return both.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.max("sure").alias("sure"))


def compared(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """The pairs (a, b) whose cosine, in double precision, is enough."""
    x, y = (reps.select(F.col("rid").alias(c), F.col("embedding").alias(f"x{c}")) for c in "ab")

    def run(batches):
        for batch in batches:
            a, b = batch.column("a").to_numpy(), batch.column("b").to_numpy()
            size = [batch.column(c).value_lengths().to_numpy() for c in ("xa", "xb")]
            ok = np.zeros(len(a), bool)
            for dim in np.unique(size[0]):
                i = np.flatnonzero((size[0] == dim) & (size[1] == dim))
                u, v = (_unit(_matrix(batch.column(c).take(pa.array(i)))) for c in ("xa", "xb"))
                ok[i] = (u * v).sum(axis=1) >= COSINE
            yield pa.RecordBatch.from_arrays([pa.array(a[ok]), pa.array(b[ok])], ["a", "b"])

    return pairs.join(x, "a").join(y, "b").select("a", "b", "xa", "xb").mapInArrow(C.batchwise(run), "a long, b long")


def count_links(members: DataFrame) -> DataFrame:
    """(rid, n) with n the members of other classes that a class links with, for members (component, rid, copies, dim, embedding)."""
    sizes = members.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    m = members.join(sizes, "component").withColumn("i", F.pmod(F.xxhash64("rid"), "blocks").cast("int"))
    m = m.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    m = m.withColumn("lo", F.least("i", "j")).withColumn("hi", F.greatest("i", "j"))
    m = m.withColumn("key", F.when(F.col("blocks") > 1, F.xxhash64("component", "lo", "hi")).otherwise(F.pmod(F.xxhash64("component"), F.lit(256))))

    def count(t: pa.Table) -> pa.Table:
        comp, lo, hi, i, rid, copies = (t.column(c).to_numpy() for c in ("component", "lo", "hi", "i", "rid", "copies"))
        order = np.lexsort((hi, lo, comp))
        cut = np.flatnonzero(np.concatenate(([True], (comp[order][1:] != comp[order][:-1]) | (lo[order][1:] != lo[order][:-1]) | (hi[order][1:] != hi[order][:-1]), [True])))
        emb = t.column("embedding").combine_chunks()
        out_r, out_n = [], []
        for s, e in zip(cut, cut[1:]):
            o = order[s:e]
            x = _unit(_matrix(emb.take(pa.array(o))))
            a, b = np.flatnonzero(i[o] == lo[o[0]]), np.flatnonzero(i[o] == hi[o[0]])
            one, other = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
            for i0 in range(0, len(a), STRIP):
                strip = np.arange(i0, min(i0 + STRIP, len(a)))
                same = x[a[strip]] @ x[b].T >= COSINE
                if lo[o[0]] == hi[o[0]]:
                    same[np.arange(len(strip)), strip] = False
                one[strip] = same @ copies[o[b]]
                other += copies[o[a[strip]]] @ same
            out_r.append(rid[o[a]])
            out_n.append(one)
            if lo[o[0]] != hi[o[0]]:
                out_r.append(rid[o[b]])
                out_n.append(other)
        return pa.table({"rid": np.concatenate(out_r), "n": np.concatenate(out_n).astype(np.int64)})

    part = m.select("key", "component", "lo", "hi", "i", "rid", "copies", "embedding").groupBy("key").applyInArrow(C.groupwise(count), "rid long, n long")
    return part.groupBy("rid").agg(F.sum("n").alias("n"))


def embedding_dedup(vectors: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of ``vectors`` (vec_id, embedding)."""
    spark = vectors.sparkSession
    C.small_batches(spark)
    scratch = C.Scratch(spark, "embeddings")
    e = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(F.col("embedding"), lambda v: v.cast("double") + F.lit(0.0)).alias("embedding"))
    sound = F.expr("vec_id is not null and embedding is not null and size(embedding) > 0 and forall(embedding, v -> v is not null and not isnan(v) and abs(v) <= 1.7e308D) and exists(embedding, v -> v <> 0)")
    e = e.withColumn("sound", F.coalesce(sound, F.lit(False)))
    good = e.where("sound")
    classes = good.groupBy("embedding").agg(F.min("vec_id").alias("low"), F.count("*").alias("copies"))
    reps = scratch.keep(classes.select(F.xxhash64("embedding").alias("rid"), F.size("embedding").alias("dim"), "embedding", "low", "copies"), "classes")
    pairs = scratch.keep(near_pairs(reps.select("rid", "dim", "embedding")), "pairs")
    label = scratch.keep(components(pairs.where("sure").select("a", "b"), scratch), "label")

    def own(c):
        return label.select(F.col("node").alias(c), F.col("component").alias(f"l{c}"))

    between = pairs.where("not sure").join(own("a"), "a", "left").join(own("b"), "b", "left")
    between = scratch.keep(between.where(F.coalesce("la", "a") != F.coalesce("lb", "b")).select("a", "b"), "between")
    late = scratch.keep(compared(between, reps.select("rid", "embedding")), "late")
    if not late.isEmpty():
        label = scratch.keep(components(label.select(F.col("component").alias("a"), F.col("node").alias("b")).union(late), scratch, "second"), "label2")
    members = reps.join(label.withColumnRenamed("node", "rid"), "rid")
    links = count_links(members.select("component", "rid", "copies", "dim", "embedding"))
    low = members.groupBy("component").agg(F.min("low").alias("component_id"))
    per = reps.select("rid", "low", "copies").join(label.withColumnRenamed("node", "rid"), "rid", "left").join(low, "component", "left").join(links, "rid", "left")
    per = per.select("rid", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component_id", "low").alias("component_id"))
    a = good.withColumn("rid", F.xxhash64("embedding")).select("vec_id", "rid").join(per, "rid").select("vec_id", "n_links", "component_id")
    b = e.where("not sound").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return a.union(b).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
