"""Quality rules: base counts, and a hashed n-gram logistic regression with fixed thresholds.

The regression sees four hashed groups of a document: its words (A-Z lower-cased), the shapes of neighbouring
words (length class, first and last byte class, equality with the word before), its 3-grams of characters, and its
2-grams of words (both with A-Z lower-cased). The value
of a group is the mean weight of its items. Weights are learned by full-batch Adam on labelled quality rows
outside the held-out fold; a fifth of them is set aside to calibrate the probability (Platt). Documents are
scored in Arrow batches, and those with a probability below ``KEEP`` go, as do those that fail a base rule.

Base rules: fewer than 50 words, or over half of all words in 3-word windows that the text holds twice or more.

Training sees at most ``ROWS`` rows, each as at most one number for every hash bucket.

Defined results: null or empty text has zero counts and fails the base rules; rows that repeat are judged each;
without labels of both kinds every probability is 1 and the base rules decide; an empty table gives an empty
result; extra columns are ignored; a null doc_id passes through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from svgspark.llm import labelled as L
from svgspark.llm import stats
from svgspark.llm import textkit as K

ROWS = 4_000
STEPS = 120
KEEP = 0.5
LEAST_WORDS = 50
MOST_REPEATED = 50  # per cent
FOLDS, HELD_OUT = 4, 2
BITS = (18, 12, 16, 18)  # words, shapes, characters' 3-grams, words' 2-grams
BASES = (0, 1 << 18, (1 << 18) + (1 << 12), (1 << 18) + (1 << 12) + (1 << 16))
SIZE = BASES[3] + (1 << 18)
GRAM = 3
_FOLDED = K.SpanHash(seed=23, fold=True)


def _bucket(h: np.ndarray, group: int) -> np.ndarray:
    return (h >> K.U64(64 - BITS[group])).astype(np.int64) + BASES[group]


def items(t: stats.Texts) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each group: (bucket of each item, first item of each document)."""
    data = t.data
    prefix = _FOLDED.prefix(data)
    h = K.mix(_FOLDED.spans(prefix, t.starts, t.ends))
    size = np.minimum(t.ends - t.starts, 24) // 3
    head = stats._class[data[t.starts]].astype(np.int64) if len(t.starts) else np.zeros(0, np.int64)
    tail = stats._class[data[t.ends - 1]].astype(np.int64) if len(t.starts) else np.zeros(0, np.int64)
    same = np.zeros(len(h), np.int64)
    same[1:] = (h[1:] == h[:-1]) & (t.owner[1:] == t.owner[:-1])
    shape = ((size * 16 + head) * 16 + tail) * 2 + same
    before = np.zeros(len(h), np.int64)
    before[1:] = np.where(t.owner[1:] == t.owner[:-1], shape[:-1] + 1, 0)
    shape = K.mix((before * 8192 + shape).astype(np.uint64))
    # a character begins at every byte that does not continue one
    begin = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    begin, end = begin[:-GRAM], begin[GRAM:]
    owner = stats.owners(t.offsets)
    inside = owner[begin] == owner[end - 1]
    gram = K.mix(_FOLDED.spans(prefix, begin[inside], end[inside]))
    both = t.owner[1:] == t.owner[:-1]
    pair = K.mix(K.mix(h[:-1] + K.U64(1)) ^ h[1:])[both]
    docs = np.arange(t.n + 1)
    return [(_bucket(h, 0), t.first), (_bucket(shape, 1), t.first),
            (_bucket(gram, 2), np.searchsorted(owner[begin][inside], docs)),
            (_bucket(pair, 3), np.searchsorted(t.owner[1:][both], docs))]


def _means(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Mean of x over the items of each document, 0 without any; each is summed by itself, so equal texts get equal means."""
    n = np.diff(first)
    out = np.zeros(len(n))
    some = n > 0
    if some.any():
        out[some] = np.add.reduceat(x.astype(np.float64), first[:-1][some]) / n[some]
    return out


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float
    a: float
    b: float

    def probability(self, t: stats.Texts) -> np.ndarray:
        raw = np.full(t.n, self.bias)
        for bucket, first in items(t):
            raw += _means(self.weights[bucket], first)
        return L.sigmoid(self.a * raw + self.b)


def fit(indptr: np.ndarray, index: np.ndarray, value: np.ndarray, y: np.ndarray, steps: int = STEPS) -> Model:
    """Learns from sparse rows (the share of each bucket in its group) with labels y."""
    if len(np.unique(y)) < 2:
        return Model(np.zeros(SIZE, np.float32), 0.0, 0.0, 40.0)
    rng = np.random.default_rng(10)
    aside = rng.random(len(y)) < 0.2
    if len(np.unique(y[aside])) < 2 or len(np.unique(y[~aside])) < 2:
        aside[:] = False
    used, index = np.unique(index, return_inverse=True)
    row = np.repeat(np.arange(len(y)), np.diff(indptr))
    weight = np.where(aside, 0.0, 1.0) / max(1, (~aside).sum())
    w, m, v, b = np.zeros(len(used)), np.zeros(len(used)), np.zeros(len(used)), float(np.log(y.mean() / (1 - y.mean())))
    raw = np.zeros(len(y))
    for k in range(1, steps + 1):
        raw = np.bincount(row, value * w[index], len(y)) + b
        err = (L.sigmoid(raw) - y) * weight
        g = np.bincount(index, value * err[row], len(used)) + 1e-7 * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.5 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-6)
        b -= 2.0 * err.sum()
    raw = np.bincount(row, value * w[index], len(y)) + b
    part = aside if aside.any() else np.ones(len(y), bool)
    a, c = L.platt(raw[part], y[part])
    full = np.zeros(SIZE, np.float32)
    full[used] = w
    return Model(full, b, max(a, 0.0), c)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, label, index, value): each bucket a document uses, with its share in the group."""
    for batch in batches:
        data, offsets = K.buffers(batch.column("text"))
        index, value = [], []
        for t in stats.of_segments(data, offsets):
            groups = items(t)
            for d in range(t.n):
                own = [np.unique(bucket[first[d]:first[d + 1]], return_counts=True) for bucket, first in groups]
                index.append(np.concatenate([i for i, _ in own]).astype(np.int32))
                value.append(np.concatenate([n / max(1, n.sum()) for _, n in own]).astype(np.float32))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("label"), pa.array(index, pa.list_(pa.int32())), pa.array(value, pa.list_(pa.float32()))],
            names=["doc_id", "label", "index", "value"])


def train(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> Model:
    got = L.sample(docs, labels, "quality", FOLDS, HELD_OUT, rows) \
        .mapInArrow(_rows, "doc_id long, label int, index array<int>, value array<float>").toArrow().combine_chunks()
    order = np.argsort(got.column("doc_id").to_numpy(), kind="stable")
    got = got.take(pa.array(order)).combine_chunks()
    column = [got.column(c).chunk(0) if got.num_rows else None for c in ("index", "value")]
    if not got.num_rows:
        return fit(np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0))
    indptr = np.concatenate([[0], np.cumsum(column[0].value_lengths().to_numpy())])
    return fit(indptr, column[0].flatten().to_numpy(), column[1].flatten().to_numpy().astype(np.float64), got.column("label").to_numpy())


def _judge(model: Model):
    symbol = stats.CLASSES.index("symbol")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = K.buffers(batch.column(1))
            out = []
            for t in stats.of_segments(data, offsets):
                repeat = t.repeated_windows()
                failed = (t.n_words < LEAST_WORDS) | (100 * repeat > MOST_REPEATED * t.n_words)
                p = model.probability(t)
                out.append((t.n_words, t.word_chars(), t.classes()[:, symbol], t.duplicate_lines()[0], repeat, failed, ~failed & (p >= KEEP), p))
            kinds = (np.int64,) * 5 + (bool, bool, np.float64)
            cols = [np.concatenate([o[k] for o in out] or [np.zeros(0)]).astype(kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, cols)],
                names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "probability"])

    return run


def judge(docs: DataFrame, model: Model) -> DataFrame:
    """The base counts, base_failed, kept and the probability of each document."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _judge(model), "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, kept boolean, probability double")
