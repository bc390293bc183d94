"""Language ID: a bidirectional gated recurrent network over bytes, trained in numpy.

A text's UTF-8 bytes are cut into windows of ``WINDOW``; both directions run over each window from a zero
state, every position gets language probabilities from the two states there, and a document's probabilities
are the mean over all its positions. Training is backpropagation through time with Adam on windows of a
bounded, balanced sample of labelled rows (``PER_LANGUAGE`` different texts a language, those of the
lowest hashes, and parts from all over each of them). The sample and the weights are all that the driver holds.

Defined cases: a null text or one without a letter is ``und`` with score 0. Rows without a language, a text
or an id are never learned from (a null id counts as not held out). With no labelled row at all, every text
is ``und``. A learned language named ``und`` is as any other.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

WINDOW = 64
HIDDEN = 10
#: Different labelled texts a language that are learned from, and of all languages together (but LEAST a language);
#: from each, PARTS parts of PART_CHARS characters, from all over the text.
PER_LANGUAGE, ALL_TEXTS, LEAST = 400, 51_200, 20
PARTS, PART_CHARS = 4, 300
STEPS, BATCH = 260, 192
_LETTER = regex.compile(r"\p{L}")


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


class ByteGRU:
    """p: x (2, 3H, 256) input gates by byte, u (2, 3H, H) recurrent, b (2, H) on the candidate's recurrent part, v (2, K, H) and c (K) for the output. Gates stand as update, reset, candidate."""

    def __init__(self, languages: list[str], seed: int = 7):
        rng, h, k = np.random.default_rng(seed), HIDDEN, len(languages)
        self.languages = languages
        self.p = {
            "x": rng.normal(0, 0.3, (2, 3 * h, 256)),
            "u": rng.normal(0, h**-0.5, (2, 3 * h, h)),
            "b": np.zeros((2, h, 1)),
            "v": rng.normal(0, h**-0.5, (2, k, h)),
            "c": np.zeros((k, 1)),
        }
        self.p = {n: w.astype(np.float32) for n, w in self.p.items()}

    def states(self, seq: np.ndarray, keep: bool):
        """seq: (T, B) bytes. The states (T, 2, H, B), the second direction's at the reversed time; what training needs."""
        p, h, (t_all, b) = self.p, HIDDEN, seq.shape
        state = np.zeros((2, h, b), np.float32)
        out, held = np.empty((t_all, 2, h, b), np.float32), []
        for t in range(t_all):
            g = np.stack([np.take(p["x"][0], seq[t], axis=1), np.take(p["x"][1], seq[t_all - 1 - t], axis=1)])
            r = p["u"] @ state
            zr = _sigmoid(g[:, : 2 * h] + r[:, : 2 * h])
            z, q = zr[:, :h], zr[:, h:]
            inner = r[:, 2 * h :] + p["b"]
            n = np.tanh(g[:, 2 * h :] + q * inner)
            if keep:
                held.append((state, z, q, inner, n))
            state = n + z * (state - n)
            out[t] = state
        return out, held

    def probabilities(self, out: np.ndarray) -> np.ndarray:
        """(T, K, B) of each position."""
        x = self.p["v"][0] @ out[:, 0] + (self.p["v"][1] @ out[:, 1])[::-1] + self.p["c"]
        x -= x.max(axis=1, keepdims=True)
        np.exp(x, out=x)
        x /= x.sum(axis=1, keepdims=True)
        return x

    def gradients(self, seq: np.ndarray, label: np.ndarray, mask: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross entropy over the positions that mask (T, B) has."""
        p, h, (t_all, b) = self.p, HIDDEN, seq.shape
        out, held = self.states(seq, True)
        d = self.probabilities(out)
        d[:, label, np.arange(b)] -= 1
        d *= (mask / mask.sum())[:, None, :]
        g = {n: np.zeros_like(w) for n, w in p.items()}
        g["c"] = d.sum(axis=(0, 2))[:, None].astype(np.float32)
        both = np.stack([d, d[::-1]])  # by direction, in each direction's own time
        g["v"] = np.einsum("dtkb,tdhb->dkh", both, out, optimize=True)
        back = np.zeros((2, h, b), np.float32)
        gates = np.empty((t_all, 2, 3 * h, b), np.float32)
        vt, ut = p["v"].transpose(0, 2, 1), p["u"].transpose(0, 2, 1)
        for t in range(t_all - 1, -1, -1):
            state, z, q, inner, n = held[t]
            back = back + vt @ both[:, t]
            dn = back * (1 - z) * (1 - n * n)
            dz = back * (state - n) * z * (1 - z)
            di = dn * q
            dq = dn * inner * q * (1 - q)
            gates[t, :, :h], gates[t, :, h : 2 * h], gates[t, :, 2 * h :] = dz, dq, dn
            rec = np.concatenate((dz, dq, di), axis=1)
            g["u"] += rec @ state.transpose(0, 2, 1)
            g["b"] += di.sum(axis=2, keepdims=True)
            back = back * z + ut @ rec
        for d_, s in ((0, seq), (1, seq[::-1])):
            rows = gates[:, d_].transpose(0, 2, 1).reshape(-1, 3 * h)
            hot = np.zeros((256, 3 * h), np.float32)
            np.add.at(hot, s.ravel(), rows)
            g["x"][d_] = hot.T
        return g

    def train(self, windows: np.ndarray, sizes: np.ndarray, label: np.ndarray, seed: int = 8) -> None:
        rng = np.random.default_rng(seed)
        first, second = ({n: np.zeros_like(w) for n, w in self.p.items()} for _ in range(2))
        by = [np.flatnonzero(label == k) for k in range(len(self.languages))]
        for step in range(1, STEPS + 1):
            pick = np.concatenate([rng.choice(i, max(1, BATCH // len(by))) for i in by])
            seq = windows[pick].T
            grad = self.gradients(seq, label[pick], (np.arange(WINDOW)[:, None] < sizes[pick]).astype(np.float32))
            norm = np.sqrt(sum(float((x * x).sum()) for x in grad.values()))
            rate = 0.02 * (1 - 0.9 * step / STEPS) * min(1.0, 1.0 / max(norm, 1e-9))
            for n, x in grad.items():
                first[n] = 0.9 * first[n] + 0.1 * x
                second[n] = 0.99 * second[n] + 0.01 * x * x
                self.p[n] -= (rate * (first[n] / (1 - 0.9**step)) / (np.sqrt(second[n] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)

    def documents(self, text: np.ndarray, offsets: np.ndarray, step: int = 2048) -> np.ndarray:
        """(n, K) probabilities of the rows of a flat byte text; 0 for an empty row."""
        n = len(offsets) - 1
        count = -(-np.diff(offsets) // WINDOW)
        row = np.repeat(np.arange(n), count)
        at = np.repeat(offsets[:-1] - WINDOW * (np.cumsum(count) - count), count) + WINDOW * np.arange(len(row))
        size = np.minimum(offsets[1:][row] - at, WINDOW)
        text = np.concatenate((text, np.zeros(WINDOW, np.uint8)))
        total = np.zeros((n, len(self.languages)))
        for a in range(0, len(row), step):
            i = slice(a, a + step)
            seq = text[at[i] + np.arange(WINDOW)[:, None]]
            out, _ = self.states(seq, False)
            seen = np.arange(WINDOW)[:, None] < size[i]
            np.add.at(total, row[i], (self.probabilities(out) * seen[:, None]).sum(axis=0).T)
        return total / np.maximum(np.diff(offsets), 1)[:, None]


def windows_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Padded windows, their sizes and their texts."""
    parts = [(i, t[a : a + WINDOW]) for i, t in enumerate(texts) for a in range(0, len(t), WINDOW)]
    out = np.zeros((len(parts), WINDOW), np.uint8)
    for k, (_, w) in enumerate(parts):
        out[k, : len(w)] = np.frombuffer(w, np.uint8)
    return out, np.array([len(w) for _, w in parts]), np.array([i for i, _ in parts])


def sample(docs: DataFrame) -> list:
    """Rows (lang, h, parts) to learn from, of the rows of doc_id, text, lang that may be learned from."""
    known = docs.where("text is not null and lang is not null and length(text) > 0").where(~C.held_out())
    order, room = F.xxhash64("text"), F.greatest(F.length("text") - PART_CHARS, F.lit(0)) + 1
    # A short text is one part; a longer one has a part in each PARTS-th of it, at a place that its hash gives.
    at = F.transform(F.when(room == 1, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.lit(PARTS - 1))), lambda i: F.floor((i + F.pmod(order, F.lit(1000)) / 1000) * room / PARTS).cast("int"))
    part = F.transform(at, lambda x: F.substring("text", x + 1, F.lit(PART_CHARS)))
    known = known.select(F.col("lang").cast("string").alias("lang"), order.alias("h"), part.alias("parts"))
    # Equal texts are learned from once. Hashes below a bound hold about four samples of a language, so that
    # neither the ranking nor a text that is copied often brings more than that to one task.
    texts = {r.lang: r.n for r in known.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()}
    most = max(LEAST, min(PER_LANGUAGE, ALL_TEXTS // max(len(texts), 1)))
    low = [(x, C.low_hash(4 * most / n)) for x, n in sorted(texts.items())]
    bound = docs.sparkSession.createDataFrame(low, "lang string, most long")
    few = known.join(F.broadcast(bound), "lang").where("h <= most").groupBy("lang", "h").agg(F.min("parts").alias("parts"))
    ranked = few.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("h")))
    return sorted(ranked.where(F.col("n") <= most).select("lang", "h", "parts").collect(), key=lambda r: (r.lang, r.h, r.parts))


def fit(docs: DataFrame) -> ByteGRU | None:
    """A network from the rows of doc_id, text, lang that may be learned from."""
    rows = sample(docs)
    languages = sorted({r.lang for r in rows})
    if not languages:
        return None
    net = ByteGRU(languages)
    of = {x: i for i, x in enumerate(languages)}
    parts = [(of[r.lang], x.encode()) for r in rows for x in r.parts]
    windows, sizes, text = windows_of([x for _, x in parts])
    net.train(windows, sizes, np.array([k for k, _ in parts])[text])
    return net


def predict(docs: DataFrame, net: ByteGRU | None) -> DataFrame:
    """docs with lang_pred and score."""
    C.small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(net)
    fields = [f for f in docs.schema.fields if f.name not in ("lang_pred", "score")]
    docs = docs.select([f.name for f in fields])

    def run(batches):
        net = shared.value
        for batch in batches:
            text, off = C.utf8(batch.column("text"))
            prob = np.concatenate([net.documents(text[off[a] : off[b]], off[a : b + 1] - off[a]) for a, b in C.spans(off)]) if net and batch.num_rows else np.zeros((batch.num_rows, 1))
            plain = np.zeros(len(text) + 1, np.int64)  # ASCII letters so far
            np.cumsum((text | 32) - 97 < 26, out=plain[1:])
            lettered = plain[off[1:]] > plain[off[:-1]]
            for i in np.flatnonzero(~lettered & (np.diff(off) > 0)):
                lettered[i] = bool(_LETTER.search(text[off[i] : off[i + 1]].tobytes().decode()))
            if net is None:
                lettered[:] = False
            best = prob.argmax(axis=1)
            lang = [net.languages[k] if ok else "und" for k, ok in zip(best, lettered)]
            score = np.where(lettered, prob.max(axis=1), 0.0).clip(0, 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lang, pa.string()), pa.array(score.astype(np.float64))], [*batch.schema.names, "lang_pred", "score"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    return docs.mapInArrow(C.batchwise(run), f"{schema}, lang_pred string, score double")


def language_id(docs: DataFrame) -> DataFrame:
    """docs with lang_pred and score, by a network fitted to docs' own labelled rows."""
    return predict(docs, fit(docs))
