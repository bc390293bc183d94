"""Benchmark decontamination by template canonicalisation.

Words lose marks at either end. A word with a digit becomes <NUM> (a written-out number too), a unit behind
a number <UNIT>, and a capitalised word that doesn't begin a sentence <NAME>; any other word stands in lower
case. A window is ``WINDOW`` canonical words of an item (the whole item if it is shorter, but at least
``SHORTEST`` words) with at least ``LITERALS`` plain words, so that placeholders alone never match. A window
with names stands in a second form too, its names as plain words, so that copies in upper or lower case, or
behind text without a stop, meet as well. Windows of documents and items meet by hash.

Meetings are then checked for slot consistency: along one alignment (the windows of a document and an item that
lie equally far apart) an item's slot value must map to one document value and back, and equal values must be
slots of one kind. So the same question with other numbers and names is caught, and a text that only has the
same shape is not. Of an alignment whose mapping breaks, only the windows without any change count.

A document is contaminated by an item when windows that count cover at least ``COVER`` of the item's words.

Documents' windows are dropped where they stand unless an item may have their hash: by the sorted hashes of the
items' windows where these are at most ``SENT_MOST``, else by a bit table of fixed size. Defined cases: null or
empty texts and items match nothing; repeated rows match each (n_windows counts their windows once); items of
fewer than SHORTEST words are not looked for; a row without an id is reported without one; other columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

WINDOW, SHORTEST, LITERALS, COVER = 8, 5, 4, 0.5
SENT_MOST = 2_000_000
#: Bits of the table that stands for more hashes: 8 MB.
TABLE_BITS = 26
#: Words that stand for numbers, and units of measure.
NUMBERS = "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion dozen".split()
UNITS = "mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers centimeter centimeters mg g kg lb lbs oz gram grams kilogram kilograms pound pounds ounce ounces ton tons ml l liter liters litre litres gallon gallons cup cups s sec secs second seconds min mins minute minutes h hr hrs hour hours day days week weeks month months year years mph kph dollar dollars cent cents euro euros usd eur percent degree degrees celsius fahrenheit watt watts kw volt volts hz".split()
LITERAL, NUMBER, UNIT, NAME = range(4)
_MARK = np.zeros(256, bool)
_MARK[[c for c in range(33, 127) if not chr(c).isalnum()]] = True
_DIGIT, _UPPER, _STOP = (np.zeros(256, bool) for _ in range(3))
_DIGIT[48:58] = True
_UPPER[65:91] = True
_STOP[[ord(c) for c in ".!?:;"]] = True


def _table(words: list[str]) -> np.ndarray:
    raw = np.frombuffer(" ".join(words).encode(), np.uint8)
    s, e, _ = C.words(raw, np.array([0, len(raw)]))
    return np.sort(C.segment_hashes(raw, s, e))


def _in(x: np.ndarray, table: np.ndarray) -> np.ndarray:
    return table[np.minimum(np.searchsorted(table, x), len(table) - 1)] == x


def canonical(text: np.ndarray, off: np.ndarray):
    """For each word: its row, kind, the hash of its value and of its canonical form, and the form with capitals as plain words."""
    start, end, row = C.words(text, off)
    if not len(start):
        z = np.zeros(0, np.uint64)
        return row, np.zeros(0, np.int8), z, z, z
    gap = np.concatenate(([True], row[1:] != row[:-1]))
    stop = np.concatenate(([True], _STOP[text[end[:-1] - 1]]))
    feeds = np.concatenate(([0], np.cumsum(text == 10)))
    line = np.concatenate(([True], feeds[start[1:]] > feeds[end[:-1]]))
    start, end = C.bare(text, start, end, _MARK)
    low = C.LOWER[text]
    # the two-byte capitals from À to Þ, as in ``upper`` below
    low[1:] += ((text[:-1] == 0xC3) & (text[1:] >= 0x80) & (text[1:] <= 0x9E) & (text[1:] != 0x97)).astype(np.uint8) << 5
    value = C.segment_hashes(low, start, end)
    digits = np.concatenate(([0], np.cumsum(_DIGIT[text])))
    number = (digits[end] > digits[start]) | _in(value, _table(NUMBERS))
    second = text[np.minimum(start + 1, len(text) - 1)]
    upper = _UPPER[text[start]] | ((text[start] == 0xC3) & (second >= 0x80) & (second <= 0x9E) & (second != 0x97))
    kind = np.zeros(len(start), np.int8)
    kind[upper & ~(gap | stop | line)] = NAME
    kind[number] = NUMBER
    unit = _in(value, _table(UNITS)) & np.concatenate(([False], number[:-1])) & ~gap & ~number
    kind[unit] = UNIT
    form = np.where(kind == LITERAL, value, C.stream(77, 4)[kind])
    return row, kind, value, form, np.where(kind == NAME, value, form)


def _windows(row, kind, form, plain, size: int):
    """Starts, hashes, whether in the second form, and caps of the windows of ``size`` words with enough plain ones.

    caps: in the second form, the places of the names, as bits, where the window stands in the first form too;
    else 0. Two windows of equal caps, not 0, that meet in the second form also meet in the first.
    """
    m = len(form) - size + 1
    if m <= 0:
        z = np.zeros(0, np.int64)
        return z, np.zeros(0, np.uint64), np.zeros(0, bool), z
    salt = C.stream(78, size) | np.uint64(1)
    first, second = np.full((2, m), np.uint64(size))
    names = np.zeros(m, np.int64)
    for j in range(size):
        first += form[j : j + m] * salt[j]
        second += plain[j : j + m] * salt[j]
        names |= (kind[j : j + m] == NAME).astype(np.int64) << j
    inside = row[:m] == row[size - 1 :]

    def enough(literal):
        n = np.concatenate(([0], np.cumsum(literal)))
        return inside & (n[size:] - n[:m] >= min(LITERALS, size))

    one = enough(kind == LITERAL)
    a, b = np.flatnonzero(one), np.flatnonzero(enough((kind == LITERAL) | (kind == NAME)) & (names > 0))
    return np.concatenate((a, b)), C.mix(np.concatenate((first[a], second[b]))), np.arange(len(a) + len(b)) >= len(a), np.concatenate((np.zeros(len(a), np.int64), np.where(one[b], names[b], 0)))


def _kinds(kind, span, second):
    """The kinds of windows' words; in the second form a name is a plain word."""
    k = kind[span]
    return np.where(second[:, None] & (k == NAME), LITERAL, k).astype(np.int32)


def item_windows(items: DataFrame) -> DataFrame:
    """item_id, words (of the item), size, place, h, kinds, vals, caps of each window."""
    C.small_batches(items.sparkSession)

    def run(batches):
        for batch in batches:
            text, off = C.utf8(batch.column("text"))
            row, kind, value, form, plain = canonical(text, off)
            at = C.row_bounds(row, batch.num_rows)
            ids = batch.column("item_id").to_pylist()
            out = []
            for r in range(batch.num_rows):
                n = int(at[r + 1] - at[r])
                if n < SHORTEST:
                    continue
                s, size = slice(at[r], at[r + 1]), min(n, WINDOW)
                i, h, second, caps = _windows(row[s], kind[s], form[s], plain[s], size)
                span = at[r] + i[:, None] + np.arange(size)
                kinds, vals = _kinds(kind, span, second).tolist(), C.as_long(value[span]).tolist()
                out += zip([ids[r]] * len(i), [n] * len(i), [size] * len(i), i.tolist(), C.as_long(h).tolist(), kinds, vals, caps.tolist())
            yield pa.RecordBatch.from_pylist([dict(zip(("item_id", "words", "size", "place", "h", "kinds", "vals", "caps"), x)) for x in out], pa.schema([("item_id", pa.int64()), ("words", pa.int32()), ("size", pa.int32()), ("place", pa.int32()), ("h", pa.int64()), ("kinds", pa.list_(pa.int32())), ("vals", pa.list_(pa.int64())), ("caps", pa.int64())]))

    return items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).mapInArrow(C.batchwise(run), "item_id long, words int, size int, place int, h long, kinds array<int>, vals array<long>, caps long")


class Wanted:
    """Which hashes the items' windows may have: exactly (a sorted array), or by a bit table."""

    def __init__(self, known: DataFrame):
        self.hashes = self.bits = None
        if known.count() <= SENT_MOST:
            self.hashes = np.unique(np.array([r.h for r in known.select("h").distinct().collect()], np.int64).view(np.uint64))
        else:
            place = F.shiftrightunsigned("h", 64 - TABLE_BITS)
            words = known.groupBy(F.shiftright(place, 6).alias("i")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(h, {64 - TABLE_BITS}) & 63 as int))")).alias("w")).collect()
            self.bits = np.zeros(1 << (TABLE_BITS - 6), np.uint64)
            self.bits[[r.i for r in words]] = np.array([r.w for r in words], np.int64).view(np.uint64)

    def has(self, h: np.ndarray) -> np.ndarray:
        """The indices of the hashes that may be wanted."""
        if self.bits is not None:
            at = h >> np.uint64(64 - TABLE_BITS)
            return np.flatnonzero((self.bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1))
        if not len(self.hashes):
            return np.zeros(0, np.int64)
        few = np.flatnonzero(self.first()[h >> np.uint64(44)])
        return few[_in(h[few], self.hashes)]

    def first(self) -> np.ndarray:
        """By the first 20 bits, whether a hash begins so."""
        if not hasattr(self, "begins"):
            self.begins = np.zeros(1 << 20, bool)
            self.begins[self.hashes >> np.uint64(44)] = True
        return self.begins


def document_windows(docs: DataFrame, sizes: list[int], hashes) -> DataFrame:
    """doc_id, size, at, h, kinds, vals, caps of the documents' windows that ``hashes``, a broadcast Wanted, may have."""

    def run(batches):
        wanted = hashes.value
        for batch in batches:
            text, off = C.utf8(batch.column("text"))
            ids = batch.column("doc_id")
            for a, b in C.spans(off):
                row, kind, value, form, plain = canonical(text[off[a] : off[b]], off[a : b + 1] - off[a])
                at = C.row_bounds(row, b - a)
                for size in sizes:
                    i, h, second, caps = _windows(row, kind, form, plain, size)
                    few = wanted.has(h)
                    i, h, second, caps = i[few], h[few], second[few], caps[few]
                    if not len(i):
                        continue
                    span = i[:, None] + np.arange(size)
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(a + row[i])), pa.array(np.full(len(i), size, np.int32)), pa.array((i - at[row[i]]).astype(np.int64)), pa.array(C.as_long(h)), pa.array(list(_kinds(kind, span, second)), pa.list_(pa.int32())), pa.array(list(C.as_long(value[span])), pa.list_(pa.int64())), pa.array(caps)],
                        ["doc_id", "size", "at", "h", "kinds", "vals", "caps"],
                    )

    return docs.mapInArrow(C.batchwise(run), "doc_id long, size int, at long, h long, kinds array<int>, vals array<long>, caps long")


def contaminations(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id, n_windows, covered, altered of each document and item that meet.

    covered: the share of the item's words in consistent windows. altered: whether a slot's value differs.
    """
    spark = docs.sparkSession
    scratch = C.Scratch(spark, "decontaminate")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = scratch.keep(item_windows(items), "items")
    sizes = sorted(r["size"] for r in known.select("size").distinct().collect()) or [WINDOW]
    sent = spark.sparkContext.broadcast(Wanted(known))
    mine = document_windows(docs, sizes, sent).withColumnsRenamed({"kinds": "dk", "vals": "dv", "caps": "dc"})
    met = mine.join(known, ["h", "size"]).where("caps = 0 or caps <> dc")
    pairs = F.arrays_zip(F.col("kinds").alias("k"), F.col("dk").alias("q"), F.col("vals").alias("v"), F.col("dv").alias("w"))
    same = F.coalesce(F.forall(pairs, lambda x: (x["k"] == x["q"]) & ((x["k"] != 0) | (x["v"] == x["w"]))), F.lit(False))
    slots = F.transform(F.filter(pairs, lambda x: x["k"] != 0), lambda x: F.struct(x["k"], x["v"], x["w"]))
    met = met.where(same).select("doc_id", "item_id", "words", (F.col("at") - F.col("place")).alias("shift"), "place", "size", slots.alias("slots"))
    met = met.withColumn("altered", F.exists("slots", lambda x: x["v"] != x["w"]))
    # One mapping for each alignment.
    lines = met.groupBy("doc_id", "item_id", "words", "shift").agg(F.array_distinct(F.flatten(F.collect_list("slots"))).alias("slots"), F.collect_set(F.struct("place", "size", "altered")).alias("places"))
    item = F.size(F.array_distinct(F.transform("slots", lambda x: F.struct(x["k"], x["v"]))))
    document = F.size(F.array_distinct(F.transform("slots", lambda x: F.struct(x["k"], x["w"]))))
    sound = (item == F.size("slots")) & (document == F.size("slots"))
    lines = lines.withColumn("places", F.when(sound, F.col("places")).otherwise(F.filter("places", lambda x: ~x["altered"])))
    lines = lines.where(F.size("places") > 0)
    per = lines.groupBy("doc_id", "item_id", "words").agg(F.sum(F.size("places")).alias("n_windows"), F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"))
    words = F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(p["place"], p["place"] + p["size"] - 1))))
    covered = (F.size(words) / F.col("words")).alias("covered")
    return per.select("doc_id", "item_id", "n_windows", covered, F.exists("places", lambda x: x["altered"]).alias("altered")).where(F.col("covered") >= COVER)
