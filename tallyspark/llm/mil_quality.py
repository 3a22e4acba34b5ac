"""Quality scores by attention-based multiple-instance learning.

A document is a bag of passages.  Every passage of the whole text is encoded
from its style (repetition, symbols, case, punctuation, word shape); a gated
attention network, trained from document labels alone, weighs the encoded
passages, and the weighted representation is scored.

The model is fitted on the driver from a bounded sample of labelled documents
(``train_docs``); its few hundred numbers travel to the tasks, which score
each document by itself.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyspark.llm import common

PASSAGE_WORDS = 80
TRAIN_DOCS = 4000
#: Passages that one training document gives at most, evenly spaced (scoring takes all).
TRAIN_PASSAGES = 40
THRESHOLD = 0.3
FOLDS = 5
HIDDEN, GATES = 16, 8
EPOCHS, RATE, DECAY = 150, 0.03, 1e-4


def _byte_class(test) -> np.ndarray:
    return np.array([test(i) for i in range(256)])


SPACE = _byte_class(lambda i: chr(i) in " \t\n\r\x0b\x0c")
DIGITS = _byte_class(lambda i: chr(i) in "0123456789")
UPPER = _byte_class(lambda i: 65 <= i <= 90)
LETTER = _byte_class(lambda i: 65 <= i <= 90 or 97 <= i <= 122 or i >= 128)
SYMBOL = _byte_class(lambda i: i > 32 and not LETTER[i] and not DIGITS[i] and chr(i) not in ".,;:'\"()?-")
FEATURES = 15
#: Bytes of text described at a time.
CHUNK_BYTES = 1 << 20
_MIX = np.random.default_rng(7).integers(1, 1 << 62, (2, 256), dtype=np.int64) | 1


def passage_style(texts: list[bytes], words_per_passage: int = PASSAGE_WORDS) -> list[np.ndarray]:
    """For each whole text, one row of ``FEATURES`` per passage of
    ``words_per_passage`` words; a text without words is one passage of zeros."""
    out, chunk, size = [], [], 0
    for text in texts:
        chunk.append(text)
        size += len(text)
        if size >= CHUNK_BYTES:
            out += _chunk_style(chunk, words_per_passage)
            chunk, size = [], 0
    return out + _chunk_style(chunk, words_per_passage)


def _chunk_style(texts: list[bytes], words_per_passage: int) -> list[np.ndarray]:
    data = np.frombuffer(b"".join(t + b" " for t in texts), np.uint8)
    solid = ~SPACE[data]
    edge = np.diff(np.r_[False, solid].astype(np.int8))
    start = np.flatnonzero(edge == 1)
    if not len(start):
        return [np.zeros((1, FEATURES)) for _ in texts]
    end = np.flatnonzero(edge == -1)  # every text ends in a space
    length = end - start
    text_end = np.cumsum([len(t) + 1 for t in texts])
    of = np.searchsorted(text_end, start, side="right")
    per_text = np.bincount(of, minlength=len(texts))
    at = np.arange(len(start)) - (np.cumsum(per_text) - per_text)[of]
    # passages, numbered through
    bags = np.maximum(1, -(-per_text // words_per_passage))
    first = np.cumsum(bags) - bags
    passage = first[of] + at // words_per_passage
    total = int(bags.sum())

    word = np.repeat(np.arange(len(start)), length)
    body = data[solid]
    place = np.arange(len(body)) - np.repeat(np.cumsum(length) - length, length)
    value = np.add.reduceat(_MIX[0][body] * _MIX[1][place & 255], np.cumsum(length) - length)

    def each_word(table):
        return np.bincount(word, weights=table[body], minlength=len(start))

    def each_passage(v):
        return np.bincount(passage, weights=v, minlength=total)

    upper, letters = each_word(UPPER), each_word(LETTER)
    n = np.maximum(each_passage(np.ones(len(start))), 1)
    size = np.maximum(each_passage(length), 1)
    again = np.r_[False, (value[1:] == value[:-1]) & (passage[1:] == passage[:-1])]
    order = np.lexsort((value, passage))
    p, v = passage[order], value[order]
    new = np.flatnonzero(np.r_[True, (p[1:] != p[:-1]) | (v[1:] != v[:-1])])
    times = np.diff(np.r_[new, len(p)])
    most = np.zeros(total)
    np.maximum.at(most, p[new], times)
    last = data[end - 1]
    mean = size / n
    spread = np.sqrt(np.maximum(each_passage(length.astype(np.float64) ** 2) / n - mean ** 2, 0))
    rows = np.stack([
        np.log1p(np.where(most > 0, n, 0)) / 5, np.bincount(p[new], minlength=total) / n, each_passage(again) / n,
        most / n, each_passage(each_word(SYMBOL)) / size, each_passage(upper) / size,
        each_passage(each_word(DIGITS)) / size, each_passage(letters) / size,
        each_passage(each_word(np.arange(256) == ord("|"))) / n, np.where(most > 0, mean, 0) / 10, spread / 10,
        each_passage((last == ord(".")) | (last == ord(","))) / n, each_passage(SYMBOL[last]) / n,
        each_passage((upper == letters) & (letters > 0)) / n, each_passage(each_word(np.arange(256) >= 128)) / size,
    ], axis=1)
    return np.split(rows, first[1:])


class GatedAttention:
    """h = tanh(xA); gate = tanh(hV) * sigmoid(hU); weight = softmax(gate w)
    within the document; score = sigmoid(sum(weight h) c)."""

    NAMES = ("A", "a", "V", "U", "w", "c", "b")

    def __init__(self, features: int, seed: int):
        rng = np.random.default_rng(seed)

        def some(*shape):
            return rng.normal(0, 1 / np.sqrt(shape[0]), shape)

        self.mean, self.scale = np.zeros(features), np.ones(features)
        self.A, self.a = some(features, HIDDEN), np.zeros(HIDDEN)
        self.V, self.U, self.w = some(HIDDEN, GATES), some(HIDDEN, GATES), some(GATES)
        self.c, self.b = some(HIDDEN), np.zeros(1)

    def forward(self, x: np.ndarray, first: np.ndarray):
        """``first``: where each document's passages begin."""
        x = (x - self.mean) / self.scale
        of = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(x)]))
        h = np.tanh(x @ self.A + self.a)
        t, s = np.tanh(h @ self.V), 1 / (1 + np.exp(-(h @ self.U)))
        e = (t * s) @ self.w
        e = np.exp(e - np.maximum.reduceat(e, first)[of])
        weight = e / np.add.reduceat(e, first)[of]
        z = np.add.reduceat(weight[:, None] * h, first)
        logit = np.clip(z @ self.c + self.b[0], -30, 30)
        return 1 / (1 + np.exp(-logit)), (x, of, h, t, s, weight, z)

    def gradients(self, y: np.ndarray, p: np.ndarray, kept) -> list[np.ndarray]:
        x, of, h, t, s, weight, z = kept
        d_logit = (p - y) / len(y)
        d_z = d_logit[:, None] * self.c
        along = (h * d_z[of]).sum(axis=1)
        d_e = weight * (along - (z * d_z).sum(axis=1)[of])
        d_gate = d_e[:, None] * self.w
        d_t, d_s = d_gate * s * (1 - t * t), d_gate * t * s * (1 - s)
        d_h = weight[:, None] * d_z[of] + d_t @ self.V.T + d_s @ self.U.T
        d_in = d_h * (1 - h * h)
        return [x.T @ d_in, d_in.sum(axis=0), h.T @ d_t, h.T @ d_s, (t * s).T @ d_e, z.T @ d_logit,
                np.array([d_logit.sum()])]

    def fit(self, x: np.ndarray, first: np.ndarray, y: np.ndarray) -> GatedAttention:
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        m = [np.zeros_like(getattr(self, n)) for n in self.NAMES]
        v = [np.zeros_like(k) for k in m]
        for step in range(1, EPOCHS + 1):
            p, kept = self.forward(x, first)
            for i, (name, g) in enumerate(zip(self.NAMES, self.gradients(y, p, kept), strict=True)):
                value = getattr(self, name)
                g = g + DECAY * value
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                setattr(self, name, value - RATE * (m[i] / (1 - 0.9 ** step))
                        / (np.sqrt(v[i] / (1 - 0.999 ** step)) + 1e-8))
        return self

    def scores(self, bags: list[np.ndarray]) -> np.ndarray:
        first = np.cumsum([0] + [len(b) for b in bags[:-1]])
        return self.forward(np.concatenate(bags), first)[0]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS, seed: int = 1) -> GatedAttention | None:
    """Fitted on the ``train_docs`` labelled, not held-out documents of
    smallest seeded hash (the smallest text of a doc_id that repeats); None
    when there is none."""
    usable = (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
              .select(F.col("doc_id").cast("long").alias("__id"), F.col("quality").cast("double").alias("__y"))
              .distinct()  # a doc_id that labels repeat is one of train_docs
              .withColumn("__h", F.xxhash64(F.lit(seed), "__id")))
    chosen = common.smallest(usable, train_docs, "__h", "__id", "__y").drop("__h")

    def bags(batches):
        for b in batches:
            rows = [r[::-(-len(r) // TRAIN_PASSAGES)].ravel().tolist()
                    for r in passage_style(b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(rows, pa.list_(pa.float64()))],
                                             ["id", "y", "bag"])

    text = common.text_or_empty(F.col("text").cast("string")).cast("binary")
    got = (docs.select(F.col("doc_id").cast("long").alias("id"), text.alias("text"))
           .join(F.broadcast(chosen), F.col("id") == F.col("__id"))  # bounded by train_docs
           .groupBy("id", "__y").agg(F.min("text").alias("text"))  # one text of an id that repeats, however often
           .select("id", "text", "__y").mapInArrow(bags, "id long, y double, bag array<double>").collect())
    if not got:
        return None
    got.sort(key=lambda r: (r.id, r.y, r.bag))
    bag = [np.array(r.bag).reshape(-1, FEATURES) for r in got]
    return GatedAttention(FEATURES, seed).fit(np.concatenate(bag), np.cumsum([0] + [len(b) for b in bag[:-1]]),
                                              np.array([r.y for r in got]))


def score(docs: DataFrame, model: GatedAttention | None, *keep: Column) -> DataFrame:
    """``keep`` columns plus ``__score`` of each row's whole ``text`` (null:
    empty; without a model 0.5).  Whole rows are kept as one struct
    (``common.whole_row``), so no name can clash."""
    common.ready(docs.sparkSession)
    rows = docs.select(
        *keep, common.text_or_empty(F.col("text").cast("string")).cast("binary").alias("__text"))
    kept = rows.drop("__text")
    names = kept.columns
    if model is None:
        return kept.withColumn("__score", F.lit(0.5))

    def run(batches):
        for b in batches:
            out = model.scores(passage_style(b.column("__text").to_pylist())) if b.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*b.drop_columns(["__text"]).columns, pa.array(out, pa.float64())],
                                             [*names, "__score"])

    return rows.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField("__score", T.DoubleType())]))


def quality_scores(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs``.

    Scores see the text alone.  A null doc_id is not held out; null and empty
    texts score as one empty passage; repeated rows score alike; without any
    training label every score is 0.5."""
    common.ready(docs.sparkSession)
    model = train(docs, labels, train_docs)
    return score(docs, model, F.col("doc_id").cast("long").alias("doc_id")).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("__score").alias("score"),
        (F.col("__score") >= THRESHOLD).cast("int").alias("predicted"))
