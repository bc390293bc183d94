"""N-gram Jaccard join: a size-aware heavy-light set join.

A document's set is its distinct k-word shingles. Two sets of sizes r <= s link when their overlap is at
least c(r, s), the least overlap that reaches the similarity. The join has two sides, after Deng, Tao and
Li's size-aware overlap join:

* light sets (size up to a boundary) enumerate, for every admissible partner size, all subsets of c(r, s)
  members; sets that share such a subset link, with no further check;
* heavy sets are found by scanning inverted lists. A list holds only sets that have the token in their
  prefix (the size - ceil(t * size) + 1 first members in one global order that puts frequent tokens last),
  which loses no link. Lists of up to ``SHORT_LIST`` sets are scanned pair by pair, and the matches of a
  pair are counted against the least number that a link needs. Longer lists link each set to one leader
  first; after that, whatever still lies in different components is compared pair by pair.

The boundary is the size at which enumerating subsets costs more than scanning lists, from the size
histogram and the mean list length of the corpus.

Only sets travel once: equal sets are one node (64-bit fingerprint), and copies join again at the end.
Every candidate of the inverted lists is verified on the whole sets, so the result is exact up to 64-bit
hash collisions. Cost: the text is scanned three times, and once more for the sets in a candidate pair;
what is shuffled is 4 bytes for 2 in 5 shingles (frequencies), 16 bytes for 1 in 4 (lists), and the whole
sets of candidates.

Defined cases: a null or empty text has an empty set, links with nothing and is its own component. A null
doc_id keeps its row and its links; it counts as larger than any id, so a component of null ids alone is null.
Rows that repeat a doc_id are documents of their own. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from itertools import combinations
from math import ceil, comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .graph import components

#: Sets in a list that is scanned pair by pair.
SHORT_LIST = 64
#: Documents a token is in before it counts as frequent.
FREQUENT = 24
#: Frequent tokens that are sent to the tasks (4 bytes each), the most frequent first. Any choice is right.
MOST_FREQUENT = 1_000_000
#: List entries of a bucket, which is one group of a reduce task: some MB, as the JVM keeps buffers of the largest group.
BUCKET_ENTRIES = 250_000
#: Output rows that one blob batch carries.
ROWS_AT_ONCE = 50_000
#: Largest size that subsets are considered for.
LIGHT_MOST = 12
#: Candidate sets that are sent to the tasks instead of being joined by shuffle.
SENT_MOST = 300_000
#: Sets of a family's block.
FAMILY_BLOCK = 700
#: Members of a leader that one verifying task compares.
VERIFY_GROUP = 1_000


def _least(r, s, pct):
    """The least overlap of sets of r and s members with 100 * overlap >= pct * union."""
    return -((-pct * (r + s)) // (100 + pct))


def _prefix(n, pct):
    return n + (-pct * n) // 100 + 1  # n - ceil(pct / 100 * n) + 1


def _fingerprints(row, tok, n_rows):
    at = C.row_bounds(row, n_rows)
    total = np.concatenate(([np.uint64(0)], np.cumsum(C.mix(tok ^ np.uint64(0x5851F42D4C957F2D)))))
    n = np.diff(at)
    fp = C.mix((total[at[1:]] - total[at[:-1]]) + n.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return at, n, C.as_long(fp)


def _sets(batches, k, extra=()):
    """For each slice of texts: its other columns, and its shingle sets."""
    for batch in batches:
        text, off = C.utf8(batch.column("text"))
        for a, b in C.spans(off):
            row, tok = C.shingle_sets(text[off[a] : off[b]], off[a : b + 1] - off[a], k)
            yield batch.slice(a, b - a), row, tok, *_fingerprints(row, tok, b - a)


def _texts(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) with th, a hash of the text: what a set is fetched by, whatever the row's id."""
    return docs.select("doc_id", "text", F.xxhash64("text").alias("th"))


def signatures(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, n_shingles, fp, th of every row of docs (doc_id, text)."""

    def run(batches):
        for part, _, _, _, n, fp in _sets(batches, k):
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n.astype(np.int64)), pa.array(fp), part.column("th")], ["doc_id", "n_shingles", "fp", "th"])

    return _texts(docs).mapInArrow(C.batchwise(run), "doc_id long, n_shingles long, fp long, th long")


def fetch(docs: DataFrame, sig: DataFrame, wanted: DataFrame, few: bool, k: int, extra: str) -> DataFrame:
    """wanted (fp and the columns of ``extra``, a schema) with data: the set of fp, as 64-bit integers. wanted has no two equal rows.

    A set comes from the row of the least text hash, and of those of the least id, that has it. Rows that
    repeat both can give a set more than once; a task gives it once.
    """
    first = sig.join(wanted.select("fp").distinct(), "fp", "left_semi").groupBy("fp").agg(F.min(F.struct("th", "doc_id")).alias("r"))
    met = wanted.join(first.select("fp", F.col("r.th").alias("th"), F.col("r.doc_id").alias("low")), "fp")
    texts = _texts(docs)
    met = F.broadcast(met) if few else met
    names = [x.split()[0] for x in extra.split(", ")]
    texts = texts.join(met, "th").where(F.col("doc_id").eqNullSafe(F.col("low"))).select("text", "fp", *names)

    def sets(batches):
        given: set = set()
        for part, row, tok, at, n, fp in _sets(batches, k):
            mine, rows = [], zip(*(part.column(c).to_pylist() for c in ("fp", *names)))
            for i, r in enumerate(rows):
                if r[0] == fp[i] and r not in given:
                    mine.append(i)
                    given.add(r)
            if len(given) > 200_000:
                given.clear()
            yield pa.RecordBatch.from_arrays([part.column(c).take(pa.array(mine, pa.int64())) for c in ("fp", *names)] + [pa.array([tok[at[i] : at[i + 1]].tobytes() for i in mine], pa.binary())], ["fp", *names, "data"])

    return texts.mapInArrow(C.batchwise(sets), f"fp long, {extra}, data binary")


#: What travels, packed: an entry of a list or of a subset, a token's count in a flush, and a row for the output.
_ENTRY = np.dtype([("key", "<u4"), ("fp", "<i8"), ("n", "<i4")])
_SUBSET = np.dtype([("key", "<u8"), ("fp", "<i8"), ("n", "<i4")])
_COUNT = np.dtype([("key", "<u4"), ("n", "<i4")])
_ROW = np.dtype([(c, "<i8") for c in ("kind", "a", "na", "b", "nb", "m")])
_KINDS = (_ENTRY, _SUBSET, _ROW)
_BLOB = "bucket int, kind int, data binary"
_FLUSH = 400_000


def _pack(dtype, *columns):
    out = np.empty(len(columns[0]), dtype)
    for name, c in zip(dtype.names, columns):
        out[name] = c
    return out


def _blobs(bucket, entries, kind):
    """One row for each bucket that has entries: its entries' bytes, one after the other. The time depends on the entries alone."""
    order = np.argsort(bucket, kind="stable")
    b = bucket[order]
    at = np.flatnonzero(np.concatenate(([True], b[1:] != b[:-1], [True]))) if len(b) else np.zeros(1, np.int64)
    data = pa.BinaryArray.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer((at * entries.itemsize).astype(np.int32).tobytes()), pa.py_buffer(entries[order].tobytes())])
    full = b[at[:-1]] if len(b) else b
    return pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(np.full(len(full), kind, np.int32)), data], ["bucket", "kind", "data"])


def _entries(t: pa.Table, kind: int, dtype) -> np.ndarray:
    """All entries of a kind in a group's blobs."""
    rows = t.filter(pa.array(t.column("kind").to_numpy() == kind)).column("data").combine_chunks()
    if not len(rows):
        return np.zeros(0, dtype)
    at = np.frombuffer(rows.buffers()[1], np.int32)[rows.offset : rows.offset + len(rows) + 1]
    return np.frombuffer(np.frombuffer(rows.buffers()[2], np.uint8)[at[0] : at[-1]].tobytes(), dtype)


def _bucket(x, n):
    return ((x & np.uint64(0xFFFFFFFF)) % np.uint64(n)).astype(np.int64)


class _Recent:
    """Which fingerprints a task has met lately, in a table of fixed size. Forgetting one only costs time."""

    def __init__(self, bits: int = 18):
        self.table, self.mask = np.zeros(1 << bits, np.int64), (1 << bits) - 1

    def fresh(self, fp: np.ndarray) -> np.ndarray:
        out = np.zeros(len(fp), bool)
        first = np.unique(fp, return_index=True)[1]
        at = fp[first] & self.mask
        out[first] = self.table[at] != fp[first]
        self.table[at] = fp[first]
        return out


def frequent_tokens(docs: DataFrame, k: int, n_buckets: int) -> DataFrame:
    """token (its high 32 bits), df of tokens that more than FREQUENT documents have, among the two fifths of tokens with the lowest hashes; with n_all and square, the bucket's number of tokens and sum of df * df."""

    def emit(batches):
        held, size = [], 0

        for _, _, tok, *_ in _sets(batches, k):
            low = tok[tok < np.uint64(int(0.4 * 2**64))]
            held.append(low)
            size += len(low)
            if size >= 2 * _FLUSH:
                yield from _counted(np.concatenate(held), n_buckets)
                held, size = [], 0
        if held:
            yield from _counted(np.concatenate(held), n_buckets)

    def count(t: pa.Table) -> pa.Table:
        once, more = _entries(t, 0, np.dtype("<u4")), _entries(t, 1, _COUNT)
        x, back = np.unique(np.concatenate((once, more["key"])), return_inverse=True)
        df = np.bincount(back, np.concatenate((np.ones(len(once)), more["n"]))).astype(np.int64)
        hot = df > FREQUENT
        token = np.concatenate((x[hot].astype(np.int64), [-1]))
        return pa.table({"token": token, "df": np.concatenate((df[hot], [len(x)])), "square": np.concatenate((np.zeros(hot.sum()), [float(np.sum(df.astype(float) ** 2))]))})

    return docs.select("text").mapInArrow(C.batchwise(emit), _BLOB).groupBy("bucket").applyInArrow(C.groupwise(count), "token long, df long, square double")


def _counted(tok, n_buckets):
    """Blobs of the tokens that occur once, and of the others with their counts."""
    x, n = np.unique(tok, return_counts=True)
    bucket, top = _bucket(x, n_buckets), (x >> np.uint64(32)).astype(np.uint32)
    yield _blobs(bucket[n == 1], top[n == 1], 0)
    yield _blobs(bucket[n > 1], _pack(_COUNT, top[n > 1], n[n > 1]), 1)


def light_boundary(sizes: dict[int, int], list_length: float, pct: int) -> int:
    """The size up to which enumerating subsets is cheaper than scanning lists."""

    def subsets(s):
        return sum(comb(s, c) for r in range(1, 2 * s + 2) if (c := _least(r, s, pct)) <= min(r, s))

    def cost(b):
        least = ceil(pct * (b + 1) / 100)
        return sum(n * subsets(s) for s, n in sizes.items() if s <= b) + sum(n * _prefix(s, pct) * (1 + list_length) for s, n in sizes.items() if s >= least)

    return min(range(LIGHT_MOST + 1), key=cost)


def _subset_entries(row, tok, at, n, fp, pct, boundary):
    """key, fp, 2 * size + (1 if it is the smaller size of the key) for each subset of each light set."""
    out = []
    for s in range(1, boundary + 1):
        rows = np.flatnonzero(n == s)
        if not len(rows):
            continue
        members = C.mix(tok[at[rows][:, None] + np.arange(s)] ^ np.uint64(0x2545F4914F6CDD1D))
        for r in range(1, min(2 * s + 2, boundary + 1)):
            c = _least(r, s, pct)
            if c > min(r, s):
                continue
            pick = np.array(list(combinations(range(s), c)))
            key = C.mix(members[:, pick].sum(axis=2, dtype=np.uint64) + C.stream(1000 * min(r, s) + max(r, s), 1)[0]).ravel()
            out.append((key, np.repeat(fp[rows], len(pick)), np.full(len(key), 2 * s + (s <= r), np.int32)))
    return [np.concatenate(x) for x in zip(*out)] if out else None


def inverted_lists(docs: DataFrame, k: int, pct: int, boundary: int, n_buckets: int, frequent) -> DataFrame:
    """kind, a, na, b, nb, m from scanning the lists.

    kind 0: sets a < b that share m prefix tokens of short lists. 1: a set and a leader of a long list.
    2: a link found by a shared subset. 3: set a stands in the long list b.
    """
    least_listed = ceil(pct * (boundary + 1) / 100)

    def emit(batches):
        hot = frequent.value
        table = np.zeros(1 << 20, bool)
        table[hot >> np.uint32(12)] = True
        recent = _Recent()
        held, size, light = [], 0, []

        def flush():
            if held:
                tok, fp, n = (np.concatenate(x) for x in zip(*held))
                bucket, key = _bucket(tok, n_buckets), (tok >> np.uint64(32)).astype(np.uint32)
                keep, rows = _long_here(bucket, key, fp, n, pct, boundary)
                n = np.where(keep == 2, n | _IS_LONG, n)
                some = keep > 0
                yield _blobs(bucket[some], _pack(_ENTRY, key[some], fp[some], n[some]), 0)
                for i in range(0, len(rows), ROWS_AT_ONCE):
                    few = rows[i : i + ROWS_AT_ONCE]
                    yield _blobs(_bucket(C.mix(few["a"].astype(np.uint64)) + C.mix(few["b"].astype(np.uint64)), n_buckets), few, 2)
            if light:
                key, fp, n = (np.concatenate(x) for x in zip(*light))
                yield _blobs(_bucket(key, n_buckets), _pack(_SUBSET, key, fp, n), 1)

        for _, row, tok, at, n, fp in _sets(batches, k):
            fresh = recent.fresh(fp)
            if boundary and (x := _subset_entries(row, tok, at, np.where(fresh, n, 0), fp, pct, boundary)):
                light.append(x)
                size += len(x[0])
            top = (tok >> np.uint64(32)).astype(np.uint32)
            often = table[top >> np.uint32(12)]
            if often.any():
                i = np.flatnonzero(often)
                j = np.minimum(np.searchsorted(hot, top[i]), len(hot) - 1)
                often[i] = hot[j] == top[i]
                order = np.lexsort((tok, often, row))
                tok, row = tok[order], row[order]
            rank = np.arange(len(tok)) - at[row]
            use = (rank < _prefix(n, pct)[row]) & (fresh & (n >= least_listed))[row]
            held.append((tok[use], fp[row[use]], n[row[use]].astype(np.int32)))
            size += int(use.sum())
            if size >= _FLUSH:
                yield from flush()
                held, size, light = [], 0, []
        yield from flush()

    def scan(t: pa.Table) -> pa.Table:
        bucket = t.column("bucket")[0].as_py()
        lists, subsets, rows = (_entries(t, kind, dtype) for kind, dtype in enumerate(_KINDS))
        out = [tuple(rows[c] for c in _ROW.names)]
        if len(lists):
            out += _scan_lists(lists["key"], lists["fp"], lists["n"], pct, boundary, bucket)
        if len(subsets):
            out += _scan_subsets(subsets["key"], subsets["fp"], subsets["n"])
        return pa.table({c: np.concatenate(x).astype(np.int64) for c, x in zip(_ROW.names, zip(*out))})

    return docs.select("text").mapInArrow(C.batchwise(emit), _BLOB).groupBy("bucket").applyInArrow(C.groupwise(scan), "kind long, a long, na long, b long, nb long, m long")


#: Set in an entry's size if its list is known to be long.
_IS_LONG = np.int32(1 << 30)


def _long_here(bucket, key, fp, n, pct, boundary):
    """What a task does with lists that are long by its own sets alone, before they travel.

    keep, by entry: 1 if it travels as it is, 2 if it is a leader of a list that is long already, 0 if it stays
    behind; and the output rows of those lists. So a token that very many sets have brings a few leaders a
    flush to its bucket, and no more.
    """
    order = np.lexsort((key, bucket))
    b, k = bucket[order], key[order]
    at = np.flatnonzero(np.concatenate(([True], (b[1:] != b[:-1]) | (k[1:] != k[:-1]), [True])))
    keep, out = np.ones(len(key), np.int8), []
    for s in np.flatnonzero(np.diff(at) > 2 * SHORT_LIST):
        i = order[at[s] : at[s + 1]]
        f, first = np.unique(fp[i], return_index=True)
        if len(f) <= SHORT_LIST:
            continue
        i = i[first]
        rows, lead = _long_list(f, n[i], int(bucket[i[0]]), int(key[i[0]]), boundary, pct)
        out += rows
        keep[order[at[s] : at[s + 1]]] = 0
        keep[i[lead]] = 2
    return keep, np.concatenate([_pack(_ROW, *r) for r in out]) if out else np.zeros(0, _ROW)


def _long_list(f, m, bucket, key, boundary, pct):
    """Rows of one long list, (kind, a, na, b, nb, m): that each set stands in it, and its link with a leader of about its size; and which sets lead."""
    name = np.full(len(f), (bucket << 32) | key, np.int64)
    step = np.floor(np.log(m) / np.log(100 / pct) * 2).astype(np.int64)  # sizes of one class are close enough to link
    order = np.lexsort((f, step))
    first = np.flatnonzero(np.concatenate(([True], step[order][1:] != step[order][:-1])))
    lead = np.empty(len(f), np.int64)
    lead[order] = np.repeat(order[first], np.diff(np.concatenate((first, [len(f)]))))
    rest = np.flatnonzero((lead != np.arange(len(f))) & (np.maximum(m, m[lead]) > boundary))
    return [(np.full(len(f), 3), f, m, name, m, m), (np.ones(len(rest)), f[lead[rest]], m[lead[rest]], f[rest], m[rest], m[rest])], np.unique(lead)


def _unique_lists(key, fp, n):
    order = np.lexsort((fp, key))
    key, fp, n = key[order], fp[order], n[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (fp[1:] != fp[:-1])
    key, fp, n = key[new], fp[new], n[new]
    at = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True])))
    return key, fp, n, at, np.diff(at)


def _scan_lists(key, fp, n, pct, boundary, bucket):
    long_keys = np.unique(key[(n & _IS_LONG) != 0])
    key, fp, n, at, size = _unique_lists(key, fp, n & ~_IS_LONG)
    long = size > SHORT_LIST
    if len(long_keys):
        long |= long_keys[np.minimum(np.searchsorted(long_keys, key[at[:-1]]), len(long_keys) - 1)] == key[at[:-1]]
    pairs = []
    for m in range(2, SHORT_LIST + 1):
        lists = at[:-1][(size == m) & ~long]
        if len(lists):
            i, j = np.triu_indices(m, 1)
            a, b = (lists[:, None] + i).ravel(), (lists[:, None] + j).ravel()
            ok = (100 * np.minimum(n[a], n[b]) >= pct * np.maximum(n[a], n[b])) & (np.maximum(n[a], n[b]) > boundary)
            pairs.append((fp[a[ok]], n[a[ok]], fp[b[ok]], n[b[ok]]))
    out, stars = [], []
    if pairs:
        a, na, b, nb = (np.concatenate(x) for x in zip(*pairs))
        if len(a):
            order = np.lexsort((b, a))
            a, na, b, nb = a[order], na[order], b[order], nb[order]
            first = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))))
            out.append((np.zeros(len(first)), a[first], na[first], b[first], nb[first], np.diff(np.concatenate((first, [len(a)])))))
    for s in np.flatnonzero(long):
        (stands, star), _ = _long_list(fp[at[s] : at[s + 1]], n[at[s] : at[s + 1]], bucket, int(key[at[s]]), boundary, pct)
        out.append(stands)
        stars.append(star)
    if stars:  # a set meets the same leader in many lists
        cols = [np.concatenate(x) for x in zip(*stars)]
        order = np.lexsort((cols[3], cols[1]))
        cols = [c[order] for c in cols]
        keep = np.ones(len(order), bool)
        keep[1:] = (cols[1][1:] != cols[1][:-1]) | (cols[3][1:] != cols[3][:-1])
        out.append(tuple(c[keep] for c in cols))
    return out


def _scan_subsets(key, fp, n):
    key, fp, n, at, size = _unique_lists(key, fp, n)
    small = (n & 1) == 1
    group = np.repeat(np.arange(len(size)), size)
    lead = np.full(len(size), -1)
    i = np.flatnonzero(small)[::-1]
    lead[group[i]] = i  # the smallest fingerprint of the smaller size
    rest = np.flatnonzero((lead[group] >= 0) & (lead[group] != np.arange(len(fp))))
    a = lead[group[rest]]
    return [(np.full(len(rest), 2), fp[a], n[a] >> 1, fp[rest], n[rest] >> 1, n[rest] * 0)]


def verified(pairs: DataFrame, docs: DataFrame, sig: DataFrame, k: int, pct: int) -> DataFrame:
    """The pairs (a, b) of fingerprints whose whole sets link.

    A set travels once for each pair, to its leader a; the members of a leader are dealt over tasks by a
    salt, and each of those gets the leader's set.
    """
    member = pairs.select(F.col("a").alias("g"), F.col("b").alias("fp"), F.lit(1).alias("role"))
    groups = pairs.groupBy("a").agg(F.ceil(F.count("*") / VERIFY_GROUP).cast("int").alias("salts"))
    lead = groups.select(F.col("a").alias("g"), F.col("a").alias("fp"), F.lit(0).alias("role"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    member = member.join(groups.withColumnRenamed("a", "g"), "g").select("g", "fp", "role", F.pmod(F.xxhash64("fp"), "salts").cast("int").alias("salt"))
    met = lead.union(member).select("fp", "g", "salt", "role")

    def compare(batches):
        now, own, last = None, None, None
        for batch in batches:
            out = []
            for g, salt, role, fp, d in zip(*(batch.column(c).to_pylist() for c in ("g", "salt", "role", "fp", "data"))):
                if last == (last := (g, salt, fp)):
                    continue
                x = np.frombuffer(d, np.uint64)
                if role == 0:
                    now, own = (g, salt), x
                elif now == (g, salt):
                    i = np.searchsorted(own, x)
                    same = int(np.count_nonzero(own[np.minimum(i, len(own) - 1)] == x))
                    if 100 * same >= pct * (len(own) + len(x) - same):
                        out.append((g, fp))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64())], ["a", "b"])

    dealt = fetch(docs, sig, met, pairs.count() <= SENT_MOST, k, "g long, salt int, role int").repartition("g", "salt").sortWithinPartitions("g", "salt", "role", "fp")
    return dealt.mapInArrow(C.batchwise(compare), "a long, b long")


def family_blocks(stands: DataFrame, scratch: C.Scratch) -> DataFrame:
    """fp, label, family, lo, hi, side: the sets of families with several components, by pair of blocks."""
    lead = stands.groupBy("list").agg(F.min("a").alias("lead"))
    edges = stands.join(lead, "list").select(F.col("lead").alias("u"), F.col("a").alias("v")).distinct()
    family = scratch.keep(components(edges, scratch, "family"), "families")
    sets = stands.select(F.col("a").alias("fp"), F.col("la").alias("label")).distinct().join(family.select(F.col("node").alias("fp"), F.col("component").alias("family")), "fp")
    size = sets.groupBy("family", "label").agg(F.count("*").alias("n"))
    large = F.col("n") >= FAMILY_BLOCK
    shape = size.groupBy("family").agg(F.count("*").alias("labels"), F.sum(F.when(large, 0).otherwise(F.col("n"))).alias("mixed")).where("labels > 1")
    s = sets.join(size, ["family", "label"]).join(shape, "family")
    parts = F.ceil(F.when(large, F.col("n")).otherwise(F.col("mixed")) / FAMILY_BLOCK)
    s = s.withColumn("own", F.when(large, F.col("label"))).withColumn("part", F.pmod(F.xxhash64("fp"), parts))
    s = scratch.keep(s.withColumn("block", F.xxhash64("family", F.coalesce("own", F.lit(0)), F.col("own").isNull(), "part")).select("fp", "label", "family", "own", "block"), "blocks")
    b = s.select("family", "own", "block").distinct()
    o = b.select("family", F.col("own").alias("own2"), F.col("block").alias("block2"))
    pairs = b.join(o, "family").where("block <= block2 and (own is null or own2 is null or own <> own2)").select(F.col("block").alias("lo"), F.col("block2").alias("hi"))
    sides = pairs.select("lo", "hi", F.lit(0).alias("side"), F.col("lo").alias("block")).union(pairs.where("lo <> hi").select("lo", "hi", F.lit(1).alias("side"), F.col("hi").alias("block")))
    return sides.join(s.select("fp", "label", "block"), "block").select("fp", "label", "lo", "hi", "side")


def _overlaps(tok: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """(n, n) sizes of the intersections of n sets."""
    order = np.argsort(tok, kind="stable")
    tok, row = tok[order], row[order]
    at = np.flatnonzero(np.concatenate(([True], tok[1:] != tok[:-1], [True])))
    size = np.diff(at)
    out = np.zeros((n, n), np.float32)
    for m in range(2, 9):  # rare members pair by pair
        first = at[:-1][size == m]
        if len(first):
            i, j = np.triu_indices(m, 1)
            key, k = np.unique((row[first[:, None] + i] * n + row[first[:, None] + j]).ravel(), return_counts=True)
            out.ravel()[key] += k
    out += out.T
    common = np.flatnonzero(size > 8)
    for c in range(0, len(common), 2000):
        x = np.zeros((n, min(2000, len(common) - c)), np.float32)
        for k, i in enumerate(common[c : c + 2000]):
            x[row[at[i] : at[i + 1]], k] = 1
        out += x @ x.T
    return out


def family_links(blocks: DataFrame, docs: DataFrame, sig: DataFrame, k: int, pct: int) -> DataFrame:
    """(a, b): stars that span the links in each pair of blocks."""
    own = blocks.select("fp").distinct()
    sets = fetch(docs, sig, own.withColumn("one", F.lit(1)), own.count() <= SENT_MOST, k, "one int").groupBy("fp").agg(F.first("data").alias("data"))

    def compare(t: pa.Table) -> pa.Table:
        fp, label, side = (t.column(c).to_numpy() for c in ("fp", "label", "side"))
        data = t.column("data").to_pylist()
        size = np.array([len(d) // 8 for d in data], np.float32)
        same = _overlaps(np.concatenate([np.frombuffer(d, np.uint64) for d in data]), np.repeat(np.arange(len(fp)), size.astype(np.int64)), len(fp))
        link = 100 * same >= pct * (size[:, None] + size - same)
        link |= label[:, None] == label
        low = np.arange(len(fp))
        while True:
            new = np.where(link, low, len(fp)).min(axis=1)
            new = np.minimum(low, np.minimum(new, new[new]))
            if (new == low).all():
                return pa.table({"a": fp[low], "b": fp})
            low = new

    met = blocks.join(sets, "fp")
    return met.groupBy("lo", "hi").applyInArrow(C.groupwise(compare), "a long, b long").where("a <> b")


def _labelled(docs: DataFrame, k: int, pct: int) -> tuple[C.Scratch, DataFrame, DataFrame]:
    """The signatures of all rows, and fp, component_id of the sets."""
    spark = docs.sparkSession
    C.small_batches(spark)
    scratch = C.Scratch(spark, "jaccard")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sig = scratch.keep(signatures(docs, k), "sig")
    histogram = {r.s: r.n for r in sig.groupBy(F.least("n_shingles", F.lit(2 * LIGHT_MOST + 2)).alias("s")).agg(F.count("*").alias("n")).collect()}
    total, n_docs = sig.agg(F.sum("n_shingles")).first()[0] or 0, sum(histogram.values())
    n_buckets = max(4, ceil(0.26 * total / BUCKET_ENTRIES))
    found = scratch.keep(frequent_tokens(docs, k, n_buckets), "frequent")
    spread = found.where("token = -1").agg(F.sum("square"), F.sum("df")).first()
    often = found.where("token >= 0")
    if often.count() > MOST_FREQUENT:
        often = often.orderBy(F.desc("df"), "token").limit(MOST_FREQUENT)
    frequent = np.unique(np.array([r.token for r in often.select("token").distinct().collect()], np.uint32))
    boundary = light_boundary({s: n for s, n in histogram.items() if s}, (spread[0] or 0) / max(spread[1] or 1, 1), pct)
    shared = spark.sparkContext.broadcast(frequent if len(frequent) else np.array([0xFFFFFFFF], np.uint32))
    lists = scratch.keep(inverted_lists(docs, k, pct, boundary, n_buckets, shared), "lists")

    need = F.expr(f"({pct} * (na + nb) + {99 + pct}) div {100 + pct} - ({pct} * greatest(na, nb) + 99) div 100 + 1")
    counts = lists.where("kind = 0").groupBy("a", "na", "b", "nb").agg(F.sum("m").alias("m"))
    counted = counts.where(F.col("m") >= need).select("a", "b", "m")
    stars = lists.where("kind = 1").select("a", "b", "m").distinct()
    cand = scratch.keep(counted.union(stars).groupBy("a", "b").agg(F.max("m").alias("m")), "candidates", 4 * n_docs)
    first = cand.groupBy("b").agg(F.max_by("a", F.struct("m", (-F.col("a")).alias("o"))).alias("a")).select("a", "b")
    links = scratch.keep(verified(first, docs, sig, k, pct).union(lists.where("kind = 2").select("a", "b")), "links", n_docs)
    label = scratch.keep(components(links, scratch, "first"), "label", n_docs)

    def labelled(df, col, to):
        return df.join(label.select(F.col("node").alias(col), F.col("component").alias(to)), col, "left").withColumn(to, F.coalesce(to, col))

    rest = labelled(labelled(cand.select("a", "b"), "a", "la"), "b", "lb").where("la <> lb").select("a", "b")
    stands = labelled(lists.where("kind = 3").select(F.col("a"), F.col("na"), F.col("b").alias("list")).distinct(), "a", "la")
    stands = scratch.keep(stands, "stands", 4 * n_docs)
    rest = scratch.keep(rest.distinct(), "rest", n_docs)
    late = verified(rest, docs, sig, k, pct)
    if not stands.isEmpty():
        blocks = scratch.keep(family_blocks(stands, scratch), "pairs")
        late = late.union(family_links(blocks, docs, sig, k, pct))
    late = scratch.keep(late, "late", n_docs)
    if not late.isEmpty():
        star = label.select(F.col("node").alias("a"), F.col("component").alias("b"))
        label = scratch.keep(components(star.union(late), scratch, "second"), "label2", n_docs)
    own = sig.where("n_shingles > 0").groupBy("fp").agg(F.min("doc_id").alias("low"))
    ids = own.join(label.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    low = ids.groupBy("component").agg(F.min("low").alias("component_id"))
    ids = ids.join(low, "component").select("fp", "component", "component_id")
    return scratch, sig, scratch.keep(ids, "ids", n_docs)  # written, so that the join with a hot fingerprint can be split


def jaccard_components(docs: DataFrame, k: int = 5, pct: int = 75) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs`` (doc_id, text)."""
    _, sig, ids = _labelled(docs, k, pct)
    full, empty = sig.where("n_shingles > 0"), sig.where("n_shingles = 0")
    return full.join(ids, "fp").select("doc_id", "n_shingles", "component_id").union(empty.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def keep_one(docs: DataFrame, k: int = 5, pct: int = 75) -> DataFrame:
    """docs (doc_id, text and more) with one row of each component: one that has its least id, and of those the least text hash.

    Rows without a shingle stay. Of rows that are equal in id and text one stays, whichever.
    """
    scratch, sig, ids = _labelled(docs, k, pct)
    rows = sig.where("n_shingles > 0").join(ids.select("fp", "component"), "fp")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "th")).alias("r")
    best = rows.groupBy("component").agg(best).select("component", F.col("r.doc_id").alias("low"), F.col("r.th").alias("first"))
    per = rows.groupBy("component", "doc_id", "th").agg(F.count("*").alias("n")).join(best, "component")
    stays = F.col("doc_id").eqNullSafe(F.col("low")) & (F.col("th") == F.col("first"))
    marked = scratch.keep(per.select(F.col("doc_id").alias("_id"), F.col("th").alias("_th"), stays.alias("_stays")).where("not _stays").union(per.where(stays & (F.col("n") > 1)).select("doc_id", "th", stays)), "marked")
    gone, again = C.sent(marked.where("not _stays")), C.sent(marked.where("_stays"))
    same = F.xxhash64(F.col("text").cast("string")) == F.col("_th")
    mine = F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & same
    left = docs.join(gone, mine, "left_anti")
    if marked.where("_stays").isEmpty():
        return left
    return left.join(again, mine, "left_anti").union(left.join(again, mine, "left_semi").dropDuplicates(["doc_id", "text"]))
