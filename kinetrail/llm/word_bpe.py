"""BPE encoding and decoding with batched numpy merge rounds, and binary token files.

The tokenizer file describes a BPE over words; its words end in a suffix. A batch of texts is one flat
array of code points, cut into words as the file's pattern does, and each distinct word is encoded once
and kept in a bounded cache. The words that the cache lacks are encoded together: all of them lie in one
flat array of symbols; a round looks up each neighbouring pair by binary search over the sorted pair keys,
takes each word's lowest rank, and merges that pair wherever the word has it; words without a pair left
leave the array. Words are first cut where no token of the vocabulary spans the cut; a piece that is still
longer than ROUND_BYTES (a text without blanks) takes its pairs from a queue instead, as rounds over it would
take a time that grows with its square. The file's normaliser and classes of characters are the library's own.

Defined cases: a null or empty text has no tokens; control characters U+001C to U+001F are not white space
here, as in the tokenizers library; rows that repeat a doc_id are encoded each.
"""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .flat_words import PASS, Known, code_points, hashes, take

_NONE = np.int64(1 << 40)
WHITE, LETTER, NUMBER, OTHER, _UNSEEN = 0, 1, 2, 3, 255
#: Texts of code points below this need no normaliser.
PLAIN = 0x250
_PLAIN = regex.compile(r"[\x00-\u024f]*")
#: Bytes of a word up to which words are merged together in rounds; a longer one is merged by a queue of its own.
ROUND_BYTES = 400
#: The pattern that words() cuts by; a file with another one is refused.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in shown else next(spare)) for b in range(256)]


class Library:
    """The tokenizers library's own normaliser and pre-tokeniser: what a code point is, and what a text becomes.

    They stand without the vocabulary, which takes much memory; ``whole`` reads it where it is asked for.
    """

    def __init__(self, path: str, spec: dict | None = None):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        if spec is None:
            with open(path, encoding="utf-8") as f:
                spec = json.load(f)
        none = {"vocab": {}, "merges": []}
        self.path, self.rules = path, json.dumps(spec | {"added_tokens": [], "truncation": None, "padding": None, "model": spec["model"] | none})
        self.cutter, self._whole = Tokenizer.from_str(self.rules), None
        self.kind = np.full(0x110000, _UNSEEN, np.uint8)
        self.kind[0xD800:0xE000] = OTHER
        self.ask(np.arange(PLAIN))

    def __reduce__(self):
        return Library, (self.path, json.loads(self.rules))

    @property
    def whole(self):
        if self._whole is None:
            from tokenizers import Tokenizer

            self._whole = Tokenizer.from_file(self.path)
            self._whole.no_truncation()
            self._whole.no_padding()
        return self._whole

    def ask(self, points: np.ndarray) -> None:
        """Learns the classes of code points: a letter joins a letter in front, another sign joins a sign, a number stands alone, white space is left out."""
        chars = [chr(c) for c in points.tolist()]
        cut = self.cutter.pre_tokenizer.pre_tokenize_str
        ends = [{a: b for _, (a, b) in cut("".join(f"{x}{c}\n" for c in chars))} for x in "a!"]
        at = 3 * np.arange(len(chars))
        letter, other = (np.array([e.get(i) == i + 2 for i in at.tolist()], bool) for e in ends)
        alone = np.array([i + 1 in ends[0] for i in at.tolist()], bool)
        self.kind[points] = np.where(letter, LETTER, np.where(other, OTHER, np.where(alone, NUMBER, WHITE)))

    def kinds(self, cp: np.ndarray) -> np.ndarray:
        """For each code point: white space, letter, number or other. Those not met before are asked for, once a worker."""
        out = self.kind[cp]
        if (out == _UNSEEN).any():
            self.ask(np.unique(cp[out == _UNSEEN]))
            out = self.kind[cp]
        return out

    def normal(self, text: str) -> str:
        """The normalised text but for its white space. Below PLAIN no character combines with another, and lower() does what the library does."""
        return text.lower() if text.isascii() or _PLAIN.fullmatch(text) else self.cutter.normalizer.normalize_str(text)


def words(cp: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words that PATTERN finds in code points of normal texts, with their classes; the last one is a blank."""
    start = kind != 0
    start[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == 2)
    q = np.flatnonzero(start & (cp == ord("'")))
    q = q[kind[q + 1] == 1]
    if len(q):
        x, y = cp[q + 1], cp[q + 2 - (q + 2 == len(cp))]
        two = np.isin((x.astype(np.int64) << 32) | y, [(ord(a) << 32) | ord(b) for a, b in ("re", "ve", "ll")])
        one = np.isin(x, [ord(c) for c in "stmd"])
        size = np.where(one, 1, np.where(two, 2, 0))
        q, size = q[size > 0], size[size > 0]
        start[q + 1] = False
        start[q + 1 + size] = kind[q + 1 + size] != 0
    end = kind[:-1] != 0
    end &= start[1:] | (kind[1:] == 0)
    return np.flatnonzero(start), np.flatnonzero(end) + 1


class WordBPE:
    """encode() and decode() as the tokenizers library does with the file, without special tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.library = Library(path, spec)
        model = spec["model"]
        suffix, vocab = model["end_of_word_suffix"], model["vocab"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = {i: t for t, i in (vocab | self.added).items()}
        shown = [names.get(i, "").encode() for i in range(max(names) + 1)]
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        if split["pattern"]["Regex"] != PATTERN:
            raise ValueError("the file cuts words by another pattern")
        self.special = regex.compile("(" + "|".join(map(regex.escape, self.added)) + ")")
        letters = byte_symbols()
        self.first = np.array([vocab[c] for c in letters], np.int64)
        self.last = np.array([vocab[c + suffix] for c in letters], np.int64)
        self.size = np.int64(max(vocab.values()) + 1)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([vocab[a] * int(self.size) + vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.known = Known(np.int32)
        self.by_pair: dict[int, int] = {}
        self.into: list[int] = []
        # The tokens' shown bytes, a blank behind each.
        self.shown_size = np.array([len(x) + 1 for x in shown], np.int64)
        self.shown_start = np.cumsum(self.shown_size) - self.shown_size
        self.shown_bytes = np.frombuffer(b"".join(x + b" " for x in shown), np.uint8)
        # Which bytes stand side by side inside some token: a word can be cut between all others.
        byte = {c: i for i, c in enumerate(letters)}
        self.beside = np.zeros((256, 256), bool)
        for t in vocab:
            inner = [byte[c] for c in t.removesuffix(suffix) if c in byte]
            self.beside[inner[:-1], inner[1:]] = True

    def forget(self) -> None:
        """Drops what is known of words."""
        self.known.clear()
        self.by_pair, self.into = {}, []

    def merge(self, data: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words given by their bytes and sizes, and how many each word has.

        Words are cut where no token spans the cut, as no merge reaches over it; then the pieces are merged
        together round by round, but for those of more than ROUND_BYTES, which would need a round for each of
        their ranks.
        """
        end = np.cumsum(size) - 1
        sym = self.first[data]
        sym[end] = self.last[data[end]]
        first = np.ones(len(data), bool)
        first[1:] = ~self.beside[data[:-1], data[1:]]
        first[end[:-1] + 1] = True
        start = np.flatnonzero(first)
        span = np.diff(np.concatenate((start, [len(data)])))
        owner = np.searchsorted(end, start)
        short = span <= ROUND_BYTES
        ids, n = self.rounds(sym[take(start[short], span[short])], span[short])
        if not short.all():
            count = np.zeros(len(span), np.int64)
            count[short] = n
            long = {i: self.queue(sym[start[i] : start[i] + span[i]]) for i in np.flatnonzero(~short).tolist()}
            for i, x in long.items():
                count[i] = len(x)
            out, to = np.empty(count.sum(), np.int64), np.cumsum(count) - count
            out[take(to[short], n)] = ids
            for i, x in long.items():
                out[to[i] : to[i] + len(x)] = x
            ids, n = out, count
        return ids, np.bincount(owner, n, len(size)).astype(np.int64)

    def queue(self, sym: np.ndarray) -> list[int]:
        """The ids of one long piece: its pairs leave a queue by rank and place, in time n log n."""
        n, size = len(sym), int(self.size)
        key = sym[:-1] * size + sym[1:]
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        known = self.keys[at] == key
        place = np.flatnonzero(known)
        heap = list(zip(self.ranks[at[place]].tolist(), place.tolist(), sym[place].tolist(), sym[place + 1].tolist()))
        heapify(heap)
        if not self.by_pair:
            self.by_pair, self.into = dict(zip(self.keys.tolist(), self.ranks.tolist())), self.merged.tolist()
        rank_of, merged = self.by_pair.get, self.into
        val, after, before = sym.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
        while heap:
            rank, i, a, b = heappop(heap)
            j = after[i]
            if val[i] != a or j >= n or val[j] != b:
                continue  # one of the two has been merged since
            val[i], val[j] = merged[rank], -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := rank_of(val[i] * size + val[k])) is not None:
                    heappush(heap, (r, i, val[i], val[k]))
            h = before[i]
            if h >= 0 and (r := rank_of(val[h] * size + val[i])) is not None:
                heappush(heap, (r, h, val[h], val[i]))
        return [x for x in val if x >= 0]

    def rounds(self, sym: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces given by their symbols and sizes, merged together round by round, and how many each piece has."""
        word = np.repeat(np.arange(len(size)), size)
        done_sym, done_word = [], []
        while len(sym) > 1:
            key = sym[:-1] * self.size + sym[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank = np.full(len(sym), _NONE)
            rank[:-1] = np.where((self.keys[at] == key) & (word[:-1] == word[1:]), self.ranks[at], _NONE)
            start = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            low = np.minimum.reduceat(rank, start)
            span = np.diff(np.concatenate((start, [len(sym)])))
            low = np.repeat(low, span)
            open_ = low < _NONE
            if not open_.all():
                done_sym.append(sym[~open_])
                done_word.append(word[~open_])
                sym, word, rank, low = sym[open_], word[open_], rank[open_], low[open_]
                if not len(sym):
                    break
            hit = rank == low
            # Of pairs that overlap, the first, third, ... of a run merge.
            i = np.arange(len(sym))
            run = hit & ~np.concatenate(([False], hit[:-1]))
            begin = np.maximum.accumulate(np.where(run, i, 0))
            hit &= (i - begin) % 2 == 0
            sym[hit] = self.merged[rank[hit]]
            keep = np.ones(len(sym), bool)
            keep[1:] = ~hit[:-1]
            sym, word = sym[keep], word[keep]
        sym, word = np.concatenate([*done_sym, sym]), np.concatenate([*done_word, word])
        order = np.argsort(word, kind="stable")
        return sym[order], np.bincount(word, minlength=len(size))

    def ids_of(self, lines: str) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and their numbers, for words that each end in a line feed."""
        data = np.frombuffer(lines.encode(), np.uint8)
        stop = np.flatnonzero(data == 10)
        return self.merge(data[data != 10], np.diff(np.concatenate(([-1], stop))) - 1)

    def flat_ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and n + 1 bounds. No text has an added token."""
        cp, at = code_points([self.library.normal(t) for t in texts])
        start, end = words(cp, self.library.kinds(cp))

        def make(i):
            size = end[i] - start[i] + 1
            flat = cp[take(start[i], size)]
            flat[np.cumsum(size) - 1] = 10
            return self.ids_of(flat.tobytes().decode("utf-32-le"))

        if not len(start):
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        a, n = self.known.rows(hashes(cp, start, end), make)
        total = np.concatenate(([0], np.cumsum(n)))
        return self.known.store[take(a, n)], total[np.searchsorted(start, at)]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """UTF-8 bytes of the tokens with a blank behind each: without the last, what a file without a decoder yields."""
        return self.shown_bytes[take(self.shown_start[ids], self.shown_size[ids])]

    def batches(self, texts: list[str]):
        """(ids, bounds) for runs of texts."""
        for a, b in C.spans(np.concatenate(([0], np.cumsum([len(t) for t in texts]))), PASS):
            part = texts[a:b]
            if not any(x in t for t in part for x in self.added):
                yield self.flat_ids(part)
                continue
            for t in part:
                parts = self.special.split(t)
                ids, at = self.flat_ids(parts)
                ids = np.concatenate([np.array([self.added[p]], np.int32) if p in self.added else ids[i:j] for p, i, j in zip(parts, at, at[1:])])
                yield ids, np.array([0, len(ids)])


class LibraryBPE(WordBPE):
    """The same, with the distinct words encoded by the library itself."""

    def ids_of(self, lines: str) -> tuple[np.ndarray, np.ndarray]:
        got = [e.ids for e in self.library.whole.encode_batch_fast(lines.split("\n")[:-1], add_special_tokens=False)]
        return np.fromiter((i for x in got for i in x), np.int32), np.fromiter(map(len, got), np.int64, len(got))


def _texts(batch: pa.RecordBatch) -> list[str]:
    return batch.column("text").fill_null("").to_pylist()


_held: dict = {}


def tokenizer(path: str, kind=WordBPE):
    if (kind, path) not in _held:
        _held[kind, path] = kind(path)
    return _held[kind, path]


def _sent(docs: DataFrame, path: str | None, kind):
    """The tokenizer's tables (a few MB), read on the driver and sent to the tasks."""
    C.small_batches(docs.sparkSession)
    return docs.sparkSession.sparkContext.broadcast(tokenizer(path or default_vocabulary(), kind))


def encode(docs: DataFrame, path: str | None = None, digests: bool = False) -> DataFrame:
    """doc_id, ids array<int>, decoded string of every row; with ``digests``, encode_digest()'s columns too."""
    shared = _sent(docs, path, WordBPE)

    def run(batches):
        bpe = shared.value
        for batch in batches:
            ids, decoded = [], []
            for flat, at in bpe.batches(_texts(batch)):
                ids += [flat[a:b] for a, b in zip(at, at[1:])]
                decoded += [bpe.decode(flat[a:b]).tobytes()[:-1].decode() for a, b in zip(at, at[1:])]
            columns = {"doc_id": batch.column("doc_id"), "ids": pa.array(ids, pa.list_(pa.int32())), "decoded": pa.array(decoded, pa.string())}
            if digests:
                columns["n_tokens"] = pa.array([len(x) for x in ids], pa.int64())
                columns["ids_sha256"] = pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in ids], pa.string())
                columns["decoded_sha256"] = pa.array([hashlib.sha256(x.encode()).hexdigest() for x in decoded], pa.string())
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    more = ", n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else ""
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(C.batchwise(run, lambda: shared.value.forget()), f"doc_id {dict(docs.dtypes)['doc_id']}, ids array<int>, decoded string{more}")


def encode_digest(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row: digests of encode()'s columns, which don't leave the task."""
    shared = _sent(docs, path, WordBPE)

    def run(batches):
        bpe = shared.value
        for batch in batches:
            n, ids, decoded = [], [], []
            for flat, at in bpe.batches(_texts(batch)):
                raw, at = flat.astype("<u4"), at.tolist()
                shown, end = bpe.decode(flat), np.concatenate(([0], np.cumsum(bpe.shown_size[flat])))[at].tolist()
                n += [b - a for a, b in zip(at, at[1:])]
                ids += [hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(at, at[1:])]
                decoded += [hashlib.sha256(shown[a : max(a, b - 1)]).hexdigest() for a, b in zip(end, end[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(C.batchwise(run, lambda: shared.value.forget()), f"doc_id {dict(docs.dtypes)['doc_id']}, n_tokens long, ids_sha256 string, decoded_sha256 string")


# ---- binary token files --------------------------------------------------------------------

def shared_uri(spark, folder: str) -> str:
    """The folder as a URI that all tasks open alike: a bare path is one of the cluster's default file system."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(folder)
    return at.getFileSystem(conf).makeQualified(at).toString()


def _store(uri: str):
    """A file system and the path in it. uri: from shared_uri()."""
    from pyarrow import fs

    scheme, colon, rest = uri.partition(":")
    if not colon:
        raise ValueError(f"no file system is named: {uri}")
    return (fs.LocalFileSystem(), "/" + rest.lstrip("/")) if scheme == "file" else fs.FileSystem.from_uri(uri)


def _open(uri: str) -> pa.Buffer:
    """The bytes of a file: mapped into memory where the store is a mounted folder, else read."""
    from pyarrow import fs

    store, path = _store(uri)
    if isinstance(store, fs.LocalFileSystem):
        with pa.memory_map(path) as f:
            return f.read_buffer()
    with store.open_input_file(path) as f:
        return f.read_buffer()


def write_token_files(docs: DataFrame, folder: str, path: str | None = None, end_id: int | None = 2, kind: str = "<u2") -> list[dict]:
    """Writes the ids of all texts in ascending doc_id order and returns the manifest, one entry a part.

    A part has three flat files: .ids (unsigned integers of ``kind``), .off (n + 1 offsets into it, 64-bit
    unsigned) and .doc (doc ids, 64-bit). Parts follow each other in doc_id order; an entry has the number
    of ids before it (prefix sums of the parts' totals). manifest.json in ``folder`` holds the same. The library
    encodes each distinct word once; texts are cut into words by its own normaliser and classes of characters,
    which gives the ids of whole texts at a fraction of the time. Each attempt of a task writes files of its own
    name, and the manifest names those of the attempt that counted, so a lost executor or a second attempt leaves
    no half-written part in use. Only totals of parts come to the driver. Null doc ids come first and are written
    as the least 64-bit integer; equal ones are ordered by a hash of their text.
    """
    spark = docs.sparkSession
    folder, shared = shared_uri(spark, folder), _sent(docs, path, LibraryBPE)

    def run(batches):
        from pyspark import TaskContext

        bpe = shared.value
        name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}"
        store, base = _store(folder)
        store.create_dir(base, recursive=True)
        at, n = 0, 0
        with store.open_output_stream(f"{base}/{name}.ids") as f, store.open_output_stream(f"{base}/{name}.off") as g, store.open_output_stream(f"{base}/{name}.doc") as h:
            g.write(np.zeros(1, "<u8").tobytes())
            for batch in batches:
                ends = []
                for flat, bounds in bpe.batches(_texts(batch)):
                    if end_id is not None:
                        flat = np.insert(flat, bounds[1:], end_id)
                        bounds = bounds + np.arange(len(bounds))
                    f.write(flat.astype(kind).tobytes())
                    ends += (bounds[1:] + at).tolist()
                    at += len(flat)
                n += len(ends)
                g.write(np.array(ends, "<u8").tobytes())
                h.write(batch.column("doc_id").fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([name]), pa.array([n], pa.int64()), pa.array([at], pa.int64())], ["part", "name", "n_docs", "n_tokens"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    parts = C.Scratch(spark, "tokens").keep(ordered.mapInArrow(C.batchwise(run, lambda: shared.value.forget()), "part long, name string, n_docs long, n_tokens long"), "parts").where("n_docs > 0").orderBy("part").collect()
    bases = np.concatenate(([0], np.cumsum([p.n_tokens for p in parts], dtype=np.int64)))
    manifest = [{"uri": f"{folder}/{p.name}", "base": int(b), "n_docs": p.n_docs, "n_tokens": p.n_tokens} for p, b in zip(parts, bases)]
    store, base = _store(folder)
    store.create_dir(base, recursive=True)
    with store.open_output_stream(f"{base}/manifest.json") as f:
        f.write(json.dumps({"kind": kind, "parts": manifest}).encode())
    return manifest


def read_token_files(spark, manifest: list[dict], kind: str = "<u2", step: int = 20_000) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files."""

    def run(batches):
        for batch in batches:
            for uri, base in zip(batch.column("uri").to_pylist(), batch.column("base").to_pylist()):
                ids, off, doc = np.frombuffer(_open(f"{uri}.ids"), kind), np.frombuffer(_open(f"{uri}.off"), "<u8").astype(np.int64), np.frombuffer(_open(f"{uri}.doc"), "<i8")
                for a in range(0, len(doc), step):
                    b = min(a + step, len(doc))
                    crc = [zlib.crc32(ids[i:j].astype("<u4").tobytes()) for i, j in zip(off[a:b].tolist(), off[a + 1 : b + 1].tolist())]
                    known = doc[a:b] != np.iinfo(np.int64).min
                    yield pa.RecordBatch.from_arrays([pa.array(doc[a:b], mask=~known), pa.array(off[a:b] + base), pa.array(off[a + 1 : b + 1] - off[a:b]), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    rows = spark.createDataFrame([(p["uri"], p["base"]) for p in manifest], "uri string, base long")
    return rows.repartition(max(1, len(manifest)), "uri").mapInArrow(C.batchwise(run), "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, path: str | None = None) -> DataFrame:
    folder = f"{C.shared_folder(docs.sparkSession)}/kinetrail/token-files-{uuid.uuid4().hex}"
    return read_token_files(docs.sparkSession, write_token_files(docs, folder, path))
