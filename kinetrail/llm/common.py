"""Plumbing that the operators share: scratch tables, Arrow text buffers, word hashes."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one numpy pass works on; a longer text is worked on alone.
SLICE_BYTES = 1 << 20


#: Files of a scratch table whose rows are known, at least, and rows of each.
LEAST_FILES, FILE_ROWS = 8, 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bounds an Arrow batch of texts for the rest of the session: 1,000 rows, and 4 MB where Spark knows that setting."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def give_back() -> None:
    """Returns a worker's free memory to the system: the next task may be another operator's, in another worker."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library keeps what it has
        pass


def batchwise(run, *forget):
    """``run`` for mapInArrow, after which the worker calls the functions ``forget`` and gives its memory back."""

    def task(batches):
        try:
            yield from run(batches)
        finally:
            for f in (*forget, forget_powers):
                f()
            give_back()

    return task


def groupwise(run):
    """``run`` for applyInArrow on tables, each group's memory given back when it was more than a few MB."""

    def task(t: pa.Table) -> pa.Table:
        size, out = t.nbytes, run(t)
        if size > 4 << 20:
            give_back()
        return out

    return task


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Only a local master may do without: its executors are the driver's own process."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
    return f"file://{tempfile.gettempdir()}/kinetrail-{spark.sparkContext.applicationId}"


class Scratch:
    """Tables written to the shared folder: they cut lineage and outlive executors."""

    def __init__(self, spark: SparkSession, what: str):
        self.spark, self.at = spark, f"{shared_folder(spark)}/kinetrail/{what}-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
        """The table, written and read again. rows: about how many it has, so that a small one isn't written as a file a shuffle partition."""
        path = f"{self.at}/{name}"
        if rows is not None:
            df = df.coalesce(max(LEAST_FILES, rows // FILE_ROWS))
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.at}/{name}")
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def sent(df: DataFrame, most: int = 500_000) -> DataFrame:
    """A table as a side to send to all tasks if it has at most ``most`` rows, else as it is, to be joined by shuffle. df: a written table."""
    return F.broadcast(df) if df.count() <= most else df


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until no column of df has them."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n in taken:
            n += "_"
        out.append(n)
    return out


def low_hash(share: float) -> int:
    """The largest signed 64-bit hash of the lowest ``share`` of all."""
    return min(int(share * 2**64), 2**64 - 1) - 2**63


def held_out(doc_id: str = "doc_id"):
    """crc32 of the id as text leaves remainder 2 when divided by 4. False for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


# ---- Arrow text as numpy bytes -------------------------------------------------------------


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets of its rows; null rows are empty."""
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if col.null_count:
        col = col.fill_null("")
    width = np.int64 if pa.types.is_large_string(col.type) else np.int32
    _, offsets, data = col.buffers()
    at = np.frombuffer(offsets, width)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    text = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return text, at - at[0]


def spans(offsets: np.ndarray, limit: int = SLICE_BYTES):
    """Row ranges of at most ``limit`` bytes, or of one row."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        yield a, b
        a = b


def long_column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).fill_null(0).to_numpy(zero_copy_only=False)


# ---- hashes --------------------------------------------------------------------------------


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (splitmix64's finalizer)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def stream(seed: int, n: int) -> np.ndarray:
    """n pseudo-random 64-bit integers."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


_BYTE = stream(11, 256)
_BASE = int(stream(12, 1)[0]) | 1
_powers: list[np.ndarray] = [np.zeros(0, np.uint64)] * 2
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def forget_powers() -> None:
    _powers[:] = [np.zeros(0, np.uint64)] * 2


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base ** i and base ** -i modulo 2 ** 64 for i <= n."""
    if len(_powers[0]) <= n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            x = np.full(max(n, SLICE_BYTES) + 1, base, np.uint64)
            x[0] = 1
            _powers[k] = np.multiply.accumulate(x)
    return _powers[0], _powers[1]


def segment_hashes(text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte segment, from one running sum over the text."""
    up, down = powers(len(text))
    total = np.zeros(len(text) + 1, np.uint64)
    np.cumsum(_BYTE[text] * up[: len(text)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts])


def words(text: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each run of bytes other than ASCII white space."""
    if not len(text):
        z = np.zeros(0, np.int64)
        return z, z, z
    solid = ~_SPACE[text]
    head = solid.copy()
    head[1:] &= ~solid[:-1]
    first = offsets[:-1][offsets[:-1] < len(text)]
    head[first] = solid[first]
    tail = solid.copy()
    tail[:-1] &= ~solid[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    tail[last] |= solid[last]
    starts, ends = np.flatnonzero(head), np.flatnonzero(tail) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def bare(text: np.ndarray, start: np.ndarray, end: np.ndarray, mark: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of words without the marks (a table by byte) at their ends; of a word of marks alone the last one is left."""
    if not len(start):
        return start, end
    at, solid = np.arange(len(text)), ~mark[text]
    behind = np.minimum.accumulate(np.where(solid, at, len(text))[::-1])[::-1]
    before = np.maximum.accumulate(np.where(solid, at, -1))
    first = np.minimum(behind[start], end - 1)
    return first, np.maximum(before[end - 1], first) + 1


def row_bounds(rows: np.ndarray, n: int) -> np.ndarray:
    """Where each of n rows begins in a sorted row column, and its end."""
    return np.searchsorted(rows, np.arange(n + 1))


def shingle_sets(text: np.ndarray, offsets: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct k-word shingles of each row, sorted; A-Z are lower-cased.

    A row of fewer than k words has its whole word sequence as one shingle; one without words has none.
    """
    text = LOWER[text]
    starts, ends, rows = words(text, offsets)
    h = segment_hashes(text, starts, ends)
    salt = stream(13, 2 * k)
    m = len(h)
    if not m:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = row_bounds(rows, len(offsets) - 1)
    full = np.zeros(max(m - k + 1, 0), np.uint64)
    for j in range(k):
        full += h[j : j + len(full)] * (salt[j] | np.uint64(1))
    ok = rows[: len(full)] == rows[k - 1 : k - 1 + len(full)] if len(full) else np.zeros(0, bool)
    tok, row = [mix(full[ok])], [rows[: len(full)][ok]]
    counts = np.diff(at)
    for n in range(1, k):
        short = np.flatnonzero(counts == n)
        if len(short):
            x = np.full(len(short), salt[k + n], np.uint64)
            for j in range(n):
                x += h[at[short] + j] * (salt[j] | np.uint64(1))
            tok.append(mix(x))
            row.append(short)
    tok, row = np.concatenate(tok), np.concatenate(row)
    order = np.lexsort((tok, row))
    tok, row = tok[order], row[order]
    new = np.ones(len(tok), bool)
    new[1:] = (tok[1:] != tok[:-1]) | (row[1:] != row[:-1])
    return row[new], tok[new]


def as_long(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
