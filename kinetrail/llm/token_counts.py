"""Token counts under a unigram model: forward scores over a trie of distinct pre-tokens.

The model is a vocabulary file's pieces and scores. A text's tokens are the segmentation of highest total
score; a character that no piece has counts as its UTF-8 bytes (byte fallback). Pieces hold the space mark
only in front, so a text falls into pre-tokens (a run of marks and what follows up to the next) whose best
segmentations are independent.

The distinct pre-tokens of a batch that a bounded cache lacks are sorted; words with a common prefix then
share the trie's nodes, and the forward score and token count of a node are computed once for all of them,
level by level for all nodes of a level in numpy. The node where a pre-token ends (its terminal) has its
count. Ties go to the longest last piece, as in the usual implementation.

Defined cases: a null or empty text has 0 tokens; rows that repeat a doc_id count each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .flat_words import PASS, Known, code_points, hashes, take

MARK = "▁"
#: Pre-tokens up to this length go through the trie's matrices. A longer one (a text without blanks) shares little; its forward scores are computed along it.
WIDE = 48
_BASE = np.uint64(0x9E3779B97F4A7C15)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def pretokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the texts, marks for blanks, each text with a blank in front (as the vocabulary's
    trainer gave it); starts and ends of the pre-tokens; and where each text's pre-tokens begin."""
    cp, at = code_points([" " + t for t in texts])
    cp = np.where(cp == 32, np.uint32(ord(MARK)), cp)
    mark = cp == ord(MARK)
    start = mark.copy()
    start[1:] &= ~mark[:-1]
    start[at[:-1]] = True
    starts = np.flatnonzero(start)
    ends = np.concatenate((starts[1:], [len(cp)]))
    last = np.searchsorted(starts, at[1:]) - 1
    ends[last] = at[1:] - 1  # without the blank behind the text
    return cp, starts, ends, np.concatenate(([0], last + 1))


def _codes(word: str) -> np.ndarray:
    return np.frombuffer(word.encode("utf-32-le"), np.uint32)


class UnigramCounter:
    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        pieces = [(sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.longest = max(len(p) for p, _ in pieces)
        self.power = np.array([pow(int(_BASE), i, 1 << 64) for i in range(self.longest + 1)], np.uint64)
        h = np.array([self._hash(_codes(p)) for p, _ in pieces], np.uint64)
        order = np.argsort(h)
        self.keys, self.score = h[order], np.array([s for _, s in pieces])[order]
        assert (self.keys[1:] != self.keys[:-1]).all()
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[self.keys >> np.uint64(44)] = True
        self.unknown = min(s for _, s in pieces) - 10.0
        self.known = Known(np.int64, 600_000)
        self.piece = dict(pieces)
        self.reach: dict[str, int] = {}  # the longest piece that ends in a character
        for p in self.piece:
            self.reach[p[-1]] = max(self.reach.get(p[-1], 0), len(p))

    def forget(self) -> None:
        self.known.clear()

    @staticmethod
    def _hash(codes: np.ndarray) -> np.uint64:
        h = np.uint64(0)
        with np.errstate(over="ignore"):
            for c in codes:
                h = h * _BASE + C.mix(np.array([c + 1], np.uint64))[0]
        return h

    def counts(self, words: list[str]) -> np.ndarray:
        """The number of tokens of each word."""
        out = np.zeros(len(words), np.int64)
        order = sorted(range(len(words)), key=words.__getitem__)
        narrow = [i for i in order if len(words[i]) <= WIDE]
        for a in range(0, len(narrow), 8_000):
            part = narrow[a : a + 8_000]
            out[part] = self._trie([words[i] for i in part])
        for i in order:
            if len(words[i]) > WIDE:
                out[i] = self._along(words[i])
        return out

    def _along(self, word: str) -> int:
        best, count, score, reach = [0.0], [0], self.piece.get, self.reach.get
        for e, c in enumerate(word, 1):
            top, number = -np.inf, 0
            for s in range(max(0, e - reach(c, 1)), e):  # the longest last piece first: ties go to it
                x = score(word[s:e])
                if x is not None and best[s] + x > top:
                    top, number = best[s] + x, count[s] + 1
            if c not in self.piece and best[-1] + self.unknown > top:
                top, number = best[-1] + self.unknown, count[-1] + len(c.encode())
            best.append(top)
            count.append(number)
        return count[-1]

    def _trie(self, words: list[str]) -> np.ndarray:
        """words: sorted. Row i of a matrix is word i; a node is named by the first word that passes it."""
        n, size = len(words), np.fromiter(map(len, words), np.int64, len(words))
        width = int(size.max())
        m = np.zeros((n, width), np.uint32)
        m[np.arange(width) < size[:, None]] = _codes("".join(words))
        new = np.ones((n, width), bool)
        new[1:] = np.logical_or.accumulate(m[1:] != m[:-1], axis=1)
        h = np.zeros((width + 1, n), np.uint64)
        mixed = C.mix(m.T.astype(np.uint64) + np.uint64(1))
        for d in range(width):
            h[d + 1] = h[d] * _BASE + mixed[d]
        utf8 = 1 + (m >= 0x80) + (m >= 0x800) + (m >= 0x10000)
        best, count, node = [np.zeros(1)], [np.zeros(1, np.int64)], [np.zeros(n, np.int64)]
        out = np.zeros(n, np.int64)
        for e in range(1, width + 1):
            first = new[:, e - 1] & (size >= e)
            rows = np.flatnonzero(first)
            top, number = np.full(len(rows), -np.inf), np.zeros(len(rows), np.int64)
            for length in range(min(e, self.longest), 0, -1):
                k = h[e][rows] - h[e - length][rows] * self.power[length]
                i = np.flatnonzero(self.maybe[k >> np.uint64(44)])
                j = np.minimum(np.searchsorted(self.keys, k[i]), len(self.keys) - 1)
                ok = self.keys[j] == k[i]
                i, s = i[ok], self.score[j[ok]]
                at = node[e - length][rows[i]]
                s = best[e - length][at] + s
                better = s > top[i]
                top[i[better]], number[i[better]] = s[better], count[e - length][at[better]] + 1
                if length == 1:
                    lone = np.ones(len(rows), bool)
                    lone[i] = False
                    i = np.flatnonzero(lone)
                    at = node[e - 1][rows[i]]
                    s = best[e - 1][at] + self.unknown
                    better = s > top[i]
                    i, at = i[better], at[better]
                    top[i], number[i] = s[better], count[e - 1][at] + utf8[rows[i], e - 1]
            best.append(top)
            count.append(number)
            node.append(np.maximum(np.cumsum(first) - 1, 0))
            ends = np.flatnonzero(size == e)
            out[ends] = number[node[e][ends]]
        return out

    def count_texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens and pre-tokens of each text."""
        out, number = [], []
        for a, b in C.spans(np.concatenate(([0], np.cumsum([len(t) for t in texts]))), PASS):
            cp, start, end, at = pretokens(texts[a:b])

            def make(i):
                size = end[i] - start[i]
                flat, stop = cp[take(start[i], size)].tobytes().decode("utf-32-le"), np.cumsum(size).tolist()
                return self.counts([flat[x:y] for x, y in zip([0, *stop], stop)]), np.ones(len(i), np.int64)

            row, _ = self.known.rows(hashes(cp, start, end), make)
            full = np.fromiter(map(bool, texts[a:b]), bool, b - a)
            out.append(np.where(full, np.add.reduceat(self.known.store[row], at[:-1]), 0))
            number.append(np.where(full, np.diff(at), 0))
        return (np.concatenate(out), np.concatenate(number)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64))


_held: dict[str, UnigramCounter] = {}


def forget() -> None:
    for c in _held.values():
        c.forget()


def token_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, n_pretokens of every row of ``docs`` (doc_id, text)."""
    path = path or default_vocabulary()
    C.small_batches(docs.sparkSession)

    def run(batches):
        if path not in _held:
            _held[path] = UnigramCounter(path)
        for batch in batches:
            n, number = _held[path].count_texts(batch.column("text").fill_null("").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n), pa.array(number)], ["doc_id", "n_tokens", "n_pretokens"])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(C.batchwise(run, forget), f"doc_id {dict(docs.dtypes)['doc_id']}, n_tokens long, n_pretokens long")
