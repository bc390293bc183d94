"""Toxicity: a convolutional text classifier trained in numpy, with thresholds calibrated by language.

Words (runs of bytes other than ASCII white space, ASCII letters lower-cased, ASCII punctuation at either end
left out) have hashed embeddings, of the word and of its first bytes (``STEMS``), whose sum is the word's
vector. Filters of several widths run over the vectors, each filter keeps its ``TOP`` largest responses in the
document (so that the classifier can tell one telling word from several), and a logistic layer scores them.
As a filter is linear, scoring adds table rows: each embedding's product with each filter position is
computed once.

Training (Adagrad, gradients pass through the positions of the maxima) takes a bounded sample of labelled
rows: ``PER_LABEL`` of each label by the lowest hash of the id, with their whole texts. Thresholds are
calibrated by cross-fitting: each of ``FOLDS`` parts of the sample is scored by a network trained on the
others, and for each language the probability that separates its labels best is moved to 0.3, so that a score
of 0.3 is the threshold in every language. The network itself is then trained on the whole sample. At scoring
time a document's language is guessed from its words alone (log frequencies of hashed words in the sample's
languages).

Defined cases: a null, empty or wordless text is scored as a document whose maxima are all 0. Rows without
a text or a label of 0 or 1 are not learned from; of rows that repeat an id the least text is. Without rows of
both labels every score is 0.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

BITS, DIM, FILTERS, WIDTHS, TOP, STEMS = 17, 12, 6, (1, 2, 3), 3, (4, 6)
LANG_BITS = 15
PER_LABEL = 3000
EPOCHS, BATCH, FOLDS = 4, 32, 3
THRESHOLD = 0.3
_NOTHING = np.float32(-1e9)
_PUNCT = np.zeros(256, bool)
_PUNCT[[c for c in range(33, 127) if not chr(c).isalnum()]] = True


def word_hashes(text: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of each word and of its stems (n, 1 + stems), and its row; a word of punctuation alone is left out."""
    text = C.LOWER[text]
    start, end, row = C.words(text, off)
    start, end = C.bare(text, start, end, _PUNCT)
    keep = ~_PUNCT[text[start]] if len(start) else np.zeros(0, bool)
    start, end, row = start[keep], end[keep], row[keep]
    return np.stack([C.segment_hashes(text, start, e) for e in (end, *(np.minimum(start + n, end) for n in STEMS))], axis=1), row


def buckets(h: np.ndarray) -> np.ndarray:
    """The rows of the embedding table (1 + stems, n) whose sum is a word's vector."""
    return np.stack([(h[:, i] >> np.uint64(20 * i)) & np.uint64((1 << BITS) - 1) for i in range(h.shape[1])]).astype(np.int64)


def top_responses(y: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The TOP largest values (n, filters, TOP) of each column in the segments that begin at ``at``, and their places."""
    skip, at = at[0], at - at[0]  # documents too short for a window stand in front
    y = np.array(y[skip:].T, order="C")
    (f, m), n = y.shape, len(at)
    size = np.diff(np.concatenate((at, [m])))
    seg, value, where = np.repeat(np.arange(n), size), np.empty((TOP, f, n), np.float32), np.empty((TOP, f * n), np.int64)
    for r in range(TOP):
        value[r] = np.maximum.reduceat(y, at, axis=1)
        hit = np.flatnonzero(y == np.repeat(value[r], size, axis=1))
        group = hit // m * n + seg[hit % m]
        hit = hit[np.concatenate(([True], group[1:] != group[:-1]))]  # the first of equal ones
        where[r] = hit % m + skip
        y.ravel()[hit] = _NOTHING
    return value.transpose(2, 1, 0), where.reshape(TOP, f, n).transpose(2, 1, 0)


class ToxicCNN:
    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.e = rng.normal(0, 0.1, (1 << BITS, DIM)).astype(np.float32)
        self.w = {k: rng.normal(0, (k * DIM) ** -0.5, (k, DIM, FILTERS)).astype(np.float32) for k in WIDTHS}
        self.b = {k: np.zeros(FILTERS, np.float32) for k in WIDTHS}
        self.v = rng.normal(0, 0.3, len(WIDTHS) * FILTERS * TOP).astype(np.float32)
        self.c = np.float32(-2.0)
        self.languages: list[str] = []
        self.log = np.zeros((1 << LANG_BITS, 1), np.float32)
        self.shift = np.zeros(1)
        self.tables = None

    def maxima(self, ids, at, tables=None):
        """Pooled features (n, widths * FILTERS * TOP) of documents bounded by at, and the places (n, FILTERS, TOP) by width; -1 where a feature is 0."""
        n, size = len(at) - 1, np.diff(at)
        out, where = [], []
        x = None if tables else sum(self.e[i] for i in ids)
        for k in WIDTHS:
            m = ids.shape[1] - k + 1
            feat, pos = np.zeros((n, FILTERS, TOP), np.float32), np.full((n, FILTERS, TOP), -1)
            full = np.flatnonzero(size >= k)
            if m > 0 and len(full):
                if tables:
                    y = np.zeros((m, FILTERS), np.float32)
                    for j in range(k):
                        for i in ids:
                            y += tables[k][j][i[j : j + m]]
                else:
                    y = sum(x[j : j + m] @ self.w[k][j] for j in range(k))
                y += self.b[k]
                if k > 1:  # windows that reach into the next document don't count
                    inner = np.concatenate([at[1:-1] - d for d in range(1, k)])
                    y[inner[(inner >= 0) & (inner < m)]] = _NOTHING
                value, place = top_responses(y, at[full])
                feat[full] = np.maximum(value, 0)
                pos[full] = np.where(value > 0, place, -1)
            out.append(feat.reshape(n, -1))
            where.append(pos)
        return np.concatenate(out, axis=1), where

    def train(self, docs: list[np.ndarray], label: np.ndarray, seed: int = 6) -> None:
        rng = np.random.default_rng(seed)
        sq = {"e": np.full(self.e.shape, 1e-3, np.float32), "v": np.full(self.v.shape, 1e-3), "c": 1e-3} | {("w", k): np.full(self.w[k].shape, 1e-3) for k in WIDTHS} | {("b", k): np.full(FILTERS, 1e-3) for k in WIDTHS}
        weight = np.where(label == 1, 0.5 / max(label.mean(), 1e-6), 0.5 / max(1 - label.mean(), 1e-6))
        rate = 0.1
        for _ in range(EPOCHS):
            order = rng.permutation(len(docs))
            for s in range(0, len(order), BATCH):
                pick = order[s : s + BATCH]
                at = np.concatenate(([0], np.cumsum([len(docs[i]) for i in pick])))
                ids = buckets(np.concatenate([docs[i] for i in pick]))
                feat, where = self.maxima(ids, at)
                p = 1 / (1 + np.exp(-np.clip(feat @ self.v + self.c, -30, 30)))
                d = ((p - label[pick]) * weight[pick] / len(pick)).astype(np.float32)
                df = d[:, None] * self.v
                dv, dc = feat.T @ d, float(d.sum())
                rows, grads = [], []
                for n, k in enumerate(WIDTHS):
                    g, pos = df[:, n * FILTERS * TOP : (n + 1) * FILTERS * TOP].reshape(-1, FILTERS, TOP), where[n]
                    i, f, r = np.nonzero(pos >= 0)
                    at_, g = pos[i, f, r], g[i, f, r]
                    db = np.bincount(f, g, FILTERS)
                    dw = np.zeros_like(self.w[k])
                    for j in range(k):
                        here = ids[:, at_ + j]
                        np.add.at(dw[j].T, f, g[:, None] * self.e[here].sum(axis=0))
                        rows.append(here.ravel())
                        grads += [g[:, None] * self.w[k][j][:, f].T] * len(ids)
                    self.w[k] -= self._step(sq, ("w", k), dw, rate)
                    self.b[k] -= self._step(sq, ("b", k), db, rate).astype(np.float32)
                self.v -= self._step(sq, "v", dv, rate).astype(np.float32)
                sq["c"] += dc * dc
                self.c -= np.float32(rate * dc / sq["c"] ** 0.5)
                rows, grads = np.concatenate(rows), np.concatenate(grads)
                if not len(rows):
                    continue
                order_ = np.argsort(rows, kind="stable")
                first = np.flatnonzero(np.concatenate(([True], np.diff(rows[order_]) > 0)))
                r, ge = rows[order_[first]], np.add.reduceat(grads[order_], first, axis=0)
                sq["e"][r] += ge * ge
                self.e[r] -= rate * ge / np.sqrt(sq["e"][r])

    @staticmethod
    def _step(sq, name, g, rate):
        sq[name] += g * g
        return rate * g / np.sqrt(sq[name])

    def prepare(self) -> None:
        self.tables = {k: [self.e @ self.w[k][j] for j in range(k)] for k in WIDTHS}

    def logits(self, h: np.ndarray, at: np.ndarray) -> np.ndarray:
        feat, _ = self.maxima(buckets(h), at, self.tables)
        return (feat @ self.v + self.c).astype(np.float64)

    def guess(self, h: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Each document's language, by its words."""
        if not len(h):
            return np.zeros(len(at) - 1, np.int64)
        total = np.concatenate((np.zeros((1, self.log.shape[1])), np.cumsum(self.log[(h[:, 0] & np.uint64((1 << LANG_BITS) - 1)).astype(np.int64)], axis=0, dtype=np.float64)))
        return (total[at[1:]] - total[at[:-1]]).argmax(axis=1)

    def learn_languages(self, docs, lang) -> None:
        self.languages = sorted({x for x in lang if x is not None}) or ["und"]
        count = np.full((1 << LANG_BITS, len(self.languages)), 0.5)
        for d, x in zip(docs, lang):
            if x is not None:
                np.add.at(count[:, self.languages.index(x)], (d[:, 0] & np.uint64((1 << LANG_BITS) - 1)).astype(np.int64), 1)
        self.log = np.log(count / count.sum(axis=0)).astype(np.float32)
        self.shift = np.zeros(len(self.languages))

    def calibrate(self, logit: np.ndarray, label: np.ndarray, language: np.ndarray) -> None:
        """For each language, moves the logit that separates its labels best (by F1, in the middle of the gap) to THRESHOLD."""
        goal = np.log(THRESHOLD / (1 - THRESHOLD))
        overall = self._cut(logit, label)
        for k in range(len(self.languages)):
            mine = language == k
            few = min(label[mine].sum(), (1 - label[mine]).sum()) < 5
            self.shift[k] = goal - (overall if few else self._cut(logit[mine], label[mine]))

    @staticmethod
    def _cut(x, y):
        order = np.argsort(-x, kind="stable")
        x, y = x[order], y[order]
        f1 = 2 * np.cumsum(y) / (np.arange(1, len(y) + 1) + max(y.sum(), 1))
        f1[:-1][x[:-1] == x[1:]] = -1  # a cut lies between two values
        i = int(f1.argmax())
        return (x[i] + x[min(i + 1, len(x) - 1)]) / 2

    def score(self, h, at):
        x = self.logits(h, at) + self.shift[self.guess(h, at)]
        return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(docs: DataFrame, labels: DataFrame) -> ToxicCNN | None:
    """A classifier from the labelled rows that may be learned from."""
    known = labels.where("toxic in (0, 1) and doc_id is not null").where(~C.held_out()).select("doc_id", "toxic").distinct()
    known = known.withColumn("h", F.xxhash64("doc_id"))
    # Hashes below a bound hold about four samples of a label: no more than that is ranked by one task.
    most = {r.toxic: C.low_hash(4 * PER_LABEL / r.n) for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    few = known.where(F.col("h") <= F.when(F.col("toxic") == 1, F.lit(most.get(1, 0))).otherwise(F.lit(most.get(0, 0))))
    ranked = few.withColumn("n", F.row_number().over(Window.partitionBy("toxic").orderBy("h", "doc_id")))
    ids = ranked.where(F.col("n") <= PER_LABEL).select("doc_id", "toxic")  # at most 2 * PER_LABEL rows, so they may be sent
    known = docs.where("text is not null").select("doc_id", "text", "lang").join(F.broadcast(ids), "doc_id")
    known = known.groupBy("doc_id", "toxic").agg(F.min(F.struct("text", "lang")).alias("r"))
    return learn(known.select(F.col("toxic").cast("int").alias("toxic"), F.col("r.lang").alias("lang"), F.xxhash64("r.text").alias("h"), F.col("r.text").alias("text")))


def _flat(words: list[np.ndarray], of) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate([words[i] for i in of]), np.concatenate(([0], np.cumsum([len(words[i]) for i in of])))


def _parts(words: list[np.ndarray], of: np.ndarray, f) -> np.ndarray:
    """f of the flat documents ``of``, in parts of about a million words."""
    at = np.concatenate(([0], np.cumsum([len(words[i]) for i in of])))
    return np.concatenate([f(*_flat(words, of[a:b])) for a, b in C.spans(at)])


def _sample(batches) -> tuple[int | None, list[np.ndarray], np.ndarray, list]:
    """The network k that the rows (k, toxic, lang, h, text) are for, and their words, labels and languages in an order that depends on the rows alone."""
    k, rows = None, []
    for batch in batches:
        text, off = C.utf8(batch.column("text"))
        jobs, toxic, lang, h = (batch.column(c).to_pylist() for c in ("k", "toxic", "lang", "h"))
        for i in range(batch.num_rows):
            raw = text[off[i] : off[i + 1]]
            k = jobs[i]
            rows.append((h[i], raw.tobytes(), toxic[i], str(lang[i]), lang[i], word_hashes(raw, np.array([0, len(raw)]))[0]))
    rows.sort(key=lambda r: r[:4])
    return k, [r[5] for r in rows], np.array([r[2] for r in rows], np.int64), [r[4] for r in rows]


def _folds(label: np.ndarray) -> tuple[int, np.ndarray]:
    """How many parts are held out in turn, and each row's; each part has its share of either label."""
    fold, folds = np.full(len(label), 0), FOLDS if min(label.sum(), (1 - label).sum()) >= 30 else 0
    for x in (0, 1):
        fold[label == x] = np.arange((label == x).sum()) % max(folds, 1)
    return folds, fold


def _trained(k: int, words: list[np.ndarray], label: np.ndarray, lang: list):
    """What the network of the documents outside fold k says of the fold. k < 0: the network of all documents, their labels, guessed languages and, without folds, what it says of them."""
    folds, fold = _folds(label)
    if len(set(label.tolist())) < 2 or k >= folds:
        return None
    net, use = ToxicCNN(), [i for i in np.flatnonzero(fold != k) if len(words[i])]
    net.train([words[i] for i in use], label[use])
    if k >= 0:
        net.prepare()
        return _parts(words, np.flatnonzero(fold == k), net.logits)
    net.learn_languages(words, lang)
    everything, logit = np.arange(len(words)), None
    language = _parts(words, everything, net.guess)
    if not folds:
        net.prepare()
        logit = _parts(words, everything, net.logits)
        net.tables = None
    return net, label, language, logit


def learn(sample: DataFrame) -> ToxicCNN | None:
    """A network trained on all rows (toxic, lang, h, text), whose thresholds were found by networks that had not seen them; None without rows of both labels.

    Each network is a task, which gets all rows; no text comes to the driver. Training depends on the rows
    alone, so a lost task is done again.
    """
    C.small_batches(sample.sparkSession)

    def run(batches):
        k, *rows = _sample(batches)
        if k is not None:
            made = pickle.dumps(_trained(k - 1, *rows))
            yield pa.RecordBatch.from_arrays([pa.array([k - 1], pa.int64()), pa.array([made], pa.binary())], ["k", "made"])

    each = sample.withColumn("k", F.explode(F.array(*[F.lit(k) for k in range(FOLDS + 1)]))).repartitionById(FOLDS + 1, F.col("k"))
    done = {r.k: pickle.loads(r.made) for r in each.mapInArrow(C.batchwise(run), "k long, made binary").collect()}
    if done.get(-1) is None:
        return None
    net, label, language, logit = done[-1]
    folds, fold = _folds(label)
    if folds:
        logit = np.zeros(len(label))
        for k in range(folds):
            logit[fold == k] = done[k]
    net.calibrate(logit, label, language)
    return net


def toxicity(docs: DataFrame, net: ToxicCNN | None) -> DataFrame:
    """doc_id, score, predicted of every row of ``docs`` (doc_id, text)."""
    C.small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches):
        net = shared.value
        if net is not None and net.tables is None:
            net.prepare()
        for batch in batches:
            text, off = C.utf8(batch.column("text"))
            score = np.zeros(batch.num_rows)
            for a, b in C.spans(off) if net is not None else ():
                h, row = word_hashes(text[off[a] : off[b]], off[a : b + 1] - off[a])
                score[a:b] = net.score(h, C.row_bounds(row, b - a))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))], ["doc_id", "score", "predicted"])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(C.batchwise(run), f"doc_id {dict(docs.dtypes)['doc_id']}, score double, predicted int")
