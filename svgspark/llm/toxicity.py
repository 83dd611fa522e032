"""Toxicity by a convolutional text classifier over hashed word embeddings, trained in numpy.

Words are runs of letters, digits and other non-ASCII bytes, A-Z lower-cased. A word's embedding is the sum of
four rows of four tables: two chosen by two hashes of the word, so that a clash in one is outvoted by the other,
and two by its first four and five bytes, so that compounds and inflections of a word share a part. Filters of the widths ``WIDTHS`` slide over the whole text, each keeps its largest activation (never below 0), and a
logistic layer reads those maxima. Tables, filters and the layer are trained together by Adagrad; the gradient
of a maximum reaches only the window that gave it. A fifth of the training rows is set aside: it calibrates the
probability so that ``CUT`` is where precision and recall balance best, and it gives each language a threshold
of its own (``flagged``), drawn towards ``CUT`` for languages with few rows. The language is never an input of
the score.

Training sees every labelled row outside the held-out fold, written once to the shared folder. The rows are dealt by
hash to groups of about ``ROWS``; in each of ``ROUNDS`` rounds every group trains a copy of the net in a task, its share
of the epochs, and the copies' changes are averaged, those of a table row over the groups that touched it. The driver holds the net, the averages and
counts of calibration scores in steps of 1 / ``BINS``. All documents are scored in Arrow batches.

Defined results: null or empty text has no words and gets the score of all-zero maxima; texts of any length are
read whole; rows that repeat are scored each; a language that training did not see has the threshold ``CUT``;
without labels of both kinds the score is the share of label 1; an empty table gives an empty result; extra
columns are ignored; a null doc_id passes through and is not held out.
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
from svgspark.session import materialized

ROWS = 8_000  # of a group
BINS = 256
UNIT = 2.0**32  # changes are added up as whole numbers, so that their order does not count
SPAN = 40  # of calibration scores
EPOCHS = 6
ROUNDS = 2
BATCH = 32
BITS = 16
STEMS = (4, 5)  # bytes
TABLES = 2 + len(STEMS)
DIM = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
CUT = 0.5
FOLDS, HELD_OUT = 5, 0
ENOUGH = 20  # toxic rows of a language at which its own threshold counts half

_TOKEN = np.zeros(256, bool)
_TOKEN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(0x80, 0x100)]] = True
_HASH = K.SpanHash(seed=31, fold=True)


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(64 bits for each word, first word of each document): 16 bits are the row in each of the four tables."""
    starts, ends, first = K.runs(_TOKEN[data], offsets)
    prefix = _HASH.prefix(data)
    out = K.mix(_HASH.spans(prefix, starts, ends)) >> K.U64(32)
    for n in STEMS:
        stem = K.mix(_HASH.spans(prefix, starts, np.minimum(ends, starts + n)) + K.U64(n))
        out = (out << K.U64(BITS)) | (stem >> K.U64(64 - BITS))
    return out, first


def rows_of(h: np.ndarray, table: int) -> np.ndarray:
    return ((h >> K.U64(BITS * table)) & K.U64((1 << BITS) - 1)).astype(np.int64)


@dataclass
class Net:
    tables: np.ndarray  # (TABLES, 2**BITS, DIM)
    filters: list[np.ndarray]  # for each width: (width, DIM, FILTERS)
    bias: np.ndarray  # (widths, FILTERS)
    out: np.ndarray  # (widths * FILTERS,)
    base: float
    a: float = 1.0
    b: float = 0.0

    def embed(self, h: np.ndarray) -> np.ndarray:
        return sum(self.tables[t][rows_of(h, t)] for t in range(TABLES))

    def convolve(self, x: np.ndarray, k: int) -> np.ndarray:
        """Activations of the filters of the k-th width at each window of x."""
        w, n = WIDTHS[k], len(x) - WIDTHS[k] + 1
        if n <= 0:
            return np.zeros((0, FILTERS), np.float32)
        return sum(x[j:j + n] @ self.filters[k][j] for j in range(w)) + self.bias[k]

    def maxima(self, h: np.ndarray, first: np.ndarray) -> np.ndarray:
        x = self.embed(h)
        n = np.diff(first)
        out = np.zeros((len(n), len(WIDTHS) * FILTERS), np.float32)
        for k, w in enumerate(WIDTHS):
            y = self.convolve(x, k)
            docs = np.flatnonzero(n >= w)
            if not len(docs):
                continue
            # windows that begin in a document's last words reach into the next one: they are left out
            edges = np.stack([first[docs], first[docs + 1] - w + 1], axis=1).ravel()
            y = np.concatenate([y, np.zeros((1, FILTERS), np.float32)])
            top = np.maximum.reduceat(y, edges, axis=0)[::2]
            out[docs, k * FILTERS:(k + 1) * FILTERS] = np.maximum(top, 0)
        return out

    def raw(self, h: np.ndarray, first: np.ndarray) -> np.ndarray:
        return (self.maxima(h, first) @ self.out).astype(np.float64) + self.base

    def score(self, h: np.ndarray, first: np.ndarray) -> np.ndarray:
        return L.sigmoid(self.a * self.raw(h, first) + self.b)


def _words(text: pa.Array) -> list[np.ndarray]:
    """The word hashes of each text."""
    data, offsets = K.buffers(text)
    words = []
    for i, j in K.segments(offsets):
        h, first = tokens(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
        words += [h[first[d]:first[d + 1]] for d in range(j - i)]
    return words


def _seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(side, row, seen, hit): in how many rows of a batch a table row is used, and in how many of label 1."""
    for batch in batches:
        y, words = batch.column("label").to_numpy(), _words(batch.column("text"))
        for side in range(TABLES):
            seen, hit = np.zeros(1 << BITS, np.int64), np.zeros(1 << BITS, np.int64)
            for h, label in zip(words, y):
                own = np.unique(rows_of(h, side))
                seen[own] += 1
                hit[own] += label
            own = np.flatnonzero(seen)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), side, np.int32)), pa.array(own.astype(np.int32)), pa.array(seen[own]), pa.array(hit[own])],
                                             names=["side", "row", "seen", "hit"])


def _start(rows: DataFrame, rate: float, rng: np.random.Generator) -> Net:
    """Tables start at small random values, the first dimension at each row's smoothed log-odds of label 1."""
    counts = rows.select("label", "text").mapInArrow(_seen, "side int, row int, seen long, hit long").groupBy("side", "row").agg(F.sum("seen").alias("seen"), F.sum("hit").alias("hit"))
    got = counts.toArrow()
    seen, hit = np.zeros((TABLES, 1 << BITS)), np.zeros((TABLES, 1 << BITS))
    at = got.column("side").to_numpy(), got.column("row").to_numpy()
    seen[at], hit[at] = got.column("seen").to_numpy(), got.column("hit").to_numpy()
    tables = np.zeros((TABLES, 1 << BITS, DIM), np.float32)
    for side in range(TABLES):
        share = (hit[side] + 5 * rate) / (seen[side] + 5)
        tables[side] = rng.normal(0, 0.02, tables[side].shape)
        tables[side][seen[side] == 0] = 0
        tables[side, :, 0] = np.where(seen[side] > 0, np.log(share / (1 - share)) - np.log(rate / (1 - rate)), 0) / (2 * TABLES)
    filters = [rng.normal(0, 0.1, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
    for f in filters:
        f[:, 0, :] += 1.0 / len(f)
    bias = np.full((len(WIDTHS), FILTERS), -0.1, np.float32)
    return Net(tables, filters, bias, np.full(len(WIDTHS) * FILTERS, 1.0 / len(WIDTHS), np.float32), float(np.log(rate / (1 - rate))))


def _speeds(net: Net) -> dict:
    return {"t": np.full((TABLES, 1 << BITS), 0.01), "f": [np.full(f.shape, 0.01) for f in net.filters],
            "b": np.full(net.bias.shape, 0.01), "o": np.full(net.out.shape, 0.01)}


def _copy(net: Net, speed: dict) -> tuple[Net, dict]:
    return (Net(net.tables.copy(), [f.copy() for f in net.filters], net.bias.copy(), net.out.copy(), net.base),
            {"t": speed["t"].copy(), "f": [f.copy() for f in speed["f"]], "b": speed["b"].copy(), "o": speed["o"].copy()})


def _dense(net: Net, speed: dict) -> np.ndarray:
    """Filters, bias, layer and base with their speeds, in rows of DIM + 1 numbers."""
    flat = np.concatenate([np.ravel(x) for x in (*net.filters, net.bias, net.out, [net.base], *speed["f"], speed["b"], speed["o"])]).astype(float)
    return np.pad(flat, (0, -len(flat) % (DIM + 1))).reshape(-1, DIM + 1)


def _undense(net: Net, speed: dict, rows: np.ndarray) -> None:
    flat, at = rows.ravel(), 0
    for x in (*net.filters, net.bias, net.out, None, *speed["f"], speed["b"], speed["o"]):
        n = 1 if x is None else x.size
        if x is None:
            net.base = float(flat[at])
        else:
            x[...] = flat[at:at + n].reshape(x.shape)
        at += n


CHANGES = "side int, row int, " + ", ".join(f"d{k} long" for k in range(DIM + 1))


def _round(net: Net, speed: dict, number: int, epochs: int):
    """A copy of the net trained by a group's rows -> the changes (side, row, those of its numbers and its speed)."""
    def run(group: pa.Table) -> pa.Table:
        own, fast = _copy(net, speed)
        group = group.sort_by([("doc_id", "ascending"), ("crc", "ascending")]).combine_chunks()
        docs = [w for chunk in group.column("text").chunks for w in _words(chunk)]
        y = group.column("label").to_numpy().astype(int)
        rng = np.random.default_rng([4, number, group.column("part")[0].as_py()])
        for _ in range(epochs):
            rows = rng.permutation(len(y))
            for i in range(0, len(rows), BATCH):
                _step(own, fast, [docs[r] for r in rows[i:i + BATCH]], y[rows[i:i + BATCH]])
        side, row = np.nonzero(fast["t"] != speed["t"])
        moved = np.concatenate([own.tables[side, row].astype(float) - net.tables[side, row], (fast["t"] - speed["t"])[side, row][:, None]], axis=1)
        rest = _dense(own, fast) - _dense(net, speed)
        changes = np.rint(np.concatenate([moved, rest]) * UNIT).astype(np.int64)
        side, row = np.concatenate([side, np.full(len(rest), TABLES)]), np.concatenate([row, np.arange(len(rest))])
        return pa.table([pa.array(side.astype(np.int32)), pa.array(row.astype(np.int32)), *[pa.array(c) for c in changes.T]],
                        names=["side", "row", *[f"d{k}" for k in range(DIM + 1)]])

    return run


def fit(rows: DataFrame, parts: int, rate: float, epochs: int = EPOCHS) -> Net:
    """The net of the rows ``(doc_id, label, text, crc, part)`` of both labels, before calibration."""
    net = _start(rows, rate, np.random.default_rng(4))
    speed = _speeds(net)
    for number in range(ROUNDS):
        changes = rows.groupBy("part").applyInArrow(_round(net, speed, number, epochs // ROUNDS), CHANGES)
        got = changes.groupBy("side", "row").agg(F.count("*").alias("n"), *[F.sum(f"d{k}").alias(f"d{k}") for k in range(DIM + 1)]).toArrow()
        side, row = got.column("side").to_numpy(), got.column("row").to_numpy()
        mean = np.stack([got.column(f"d{k}").to_numpy() for k in range(DIM + 1)], axis=1) / UNIT / got.column("n").to_numpy()[:, None]
        net, speed = _copy(net, speed)
        dense, sparse = side == TABLES, side < TABLES
        rest = _dense(net, speed)
        rest[row[dense]] += mean[dense]
        net.tables[side[sparse], row[sparse]] += mean[sparse, :DIM].astype(np.float32)
        speed["t"][side[sparse], row[sparse]] += mean[sparse, DIM]
        _undense(net, speed, rest)
    return net


def _flat(rate: float) -> Net:
    """Without labels of both kinds: the share of label 1."""
    net = Net(np.zeros((TABLES, 1 << BITS, DIM), np.float32), [np.zeros((w, DIM, FILTERS), np.float32) for w in WIDTHS],
              np.zeros((len(WIDTHS), FILTERS), np.float32), np.zeros(len(WIDTHS) * FILTERS, np.float32), 0.0)
    share = float(np.clip(rate, 1e-6, 1 - 1e-6))
    net.b = float(np.log(share / (1 - share)))
    return net


def _binned(net: Net):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = _raws(net, _words(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("label"), pa.array(np.rint(np.clip(raw, -SPAN, SPAN) * BINS).astype(np.int32))],
                                             names=["lang", "label", "bin"])

    return run


def _raws(net: Net, docs: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([net.raw(d, np.array([0, len(d)])) for d in docs] or [np.zeros(0)])


def _step(net: Net, speed: dict, docs: list[np.ndarray], y: np.ndarray, rate: float = 0.05) -> None:
    first = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
    h = np.concatenate(docs)
    x = net.embed(h)
    top = np.zeros((len(docs), len(WIDTHS) * FILTERS), np.float32)
    at = np.zeros(top.shape, np.int64)
    for k, w in enumerate(WIDTHS):
        act = net.convolve(x, k)
        for d in range(len(docs)):
            if first[d + 1] - first[d] >= w:
                own = act[first[d]:first[d + 1] - w + 1]
                where = own.argmax(axis=0)
                cols = slice(k * FILTERS, (k + 1) * FILTERS)
                top[d, cols] = np.maximum(own[where, np.arange(FILTERS)], 0)
                at[d, cols] = first[d] + where
    err = ((L.sigmoid((top @ net.out).astype(np.float64) + net.base) - y) / len(docs)).astype(np.float32)
    g_out = top.T @ err + 1e-4 * net.out
    back = np.outer(err, net.out) * (top > 0)
    g_x: list[tuple[np.ndarray, np.ndarray]] = []
    for k, w in enumerate(WIDTHS):
        cols = slice(k * FILTERS, (k + 1) * FILTERS)
        d, f = np.nonzero(back[:, cols])
        g, pos = back[:, cols][d, f], at[:, cols][d, f]
        grad = np.zeros_like(net.filters[k])
        for j in range(w):
            np.add.at(grad[j].T, f, g[:, None] * x[pos + j])
            g_x.append((pos + j, g[:, None] * net.filters[k][j].T[f]))
        bias = np.bincount(f, g, FILTERS)
        speed["f"][k] += grad**2
        net.filters[k] -= (rate * grad / np.sqrt(speed["f"][k])).astype(np.float32)
        speed["b"][k] += bias**2
        net.bias[k] -= (rate * bias / np.sqrt(speed["b"][k])).astype(np.float32)
    pos, grad = np.concatenate([p for p, _ in g_x]), np.concatenate([g for _, g in g_x])
    for side in range(TABLES):
        used, inverse = np.unique(rows_of(h[pos], side), return_inverse=True)
        total = np.zeros((len(used), DIM), np.float32)
        np.add.at(total, inverse, grad)
        speed["t"][side][used] += (total**2).mean(axis=1)
        net.tables[side][used] -= (rate * total / np.sqrt(speed["t"][side][used])[:, None]).astype(np.float32)
    speed["o"] += g_out**2
    net.out -= (rate * g_out / np.sqrt(speed["o"])).astype(np.float32)
    net.base -= rate * float(err.sum())


def f1(tp, fp, fn, tn):
    return 2 * tp / np.maximum(1, 2 * tp + fp + fn)


def thresholds(score: np.ndarray, y: np.ndarray, lang: list[str | None], n: np.ndarray) -> dict[str, float]:
    """For each language the cut with the best F1 among its rows, drawn towards CUT when it has few toxic ones; ``n``: how
    many rows each stands for."""
    out: dict[str, float] = {}
    for name in sorted({x for x in lang if x is not None}):
        own = np.array([x == name for x in lang])
        hits = int((y[own] * n[own]).sum())
        if 0 < hits < n[own].sum():
            cut = L.best_cut(score[own], y[own], f1, n[own])
            out[name] = float(np.clip((hits * cut + ENOUGH * CUT) / (hits + ENOUGH), 0, 1))
    return out


def train(docs: DataFrame, labels: DataFrame, group: int = ROWS) -> tuple[Net, dict[str, float]]:
    """(net, threshold of each language); ``group``: rows of a group."""
    found = L.labelled(docs.select("doc_id", "text", "lang"), L.known(labels, "toxic", FOLDS, HELD_OUT))
    rows = materialized(found.withColumn("aside", F.pmod(F.xxhash64("doc_id", F.lit(4)), F.lit(5)) == 0), "toxic_rows")
    n = {(r["aside"], r["label"]): r["count"] for r in rows.groupBy("aside", "label").count().collect()}
    total = sum(n.values())
    if len({label for _, label in n}) < 2:
        return _flat(sum(k for (_, label), k in n.items() if label == 1) / max(1, total)), {}
    apart = all(len({label for aside, label in n if aside == side}) == 2 for side in (False, True))
    learned = rows.where("NOT aside") if apart else rows
    count = sum(k for (aside, _), k in n.items() if not (apart and aside))
    rate = sum(k for (aside, label), k in n.items() if label == 1 and not (apart and aside)) / count
    parts = max(1, -(-count // group))
    learned = learned.select("doc_id", "label", "text", F.xxhash64("text").alias("crc"), F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(parts)).cast("int").alias("part"))
    net = fit(learned, parts, rate)
    bins = (rows.where("aside") if apart else rows).select("lang", "label", "text").mapInArrow(_binned(net), "lang string, label int, bin int") \
        .groupBy("lang", "label", "bin").agg(F.count("*").alias("n")).orderBy("bin", "label", "lang").toArrow()
    raw, y, k = bins.column("bin").to_numpy() / BINS, bins.column("label").to_numpy().astype(int), bins.column("n").to_numpy()
    net.a, net.b = L.platt(raw, y, n=k)
    net.a = max(net.a, 1e-6)
    net.b = -net.a * L.best_cut(raw, y, f1, k)  # the best cut becomes CUT
    return net, thresholds(L.sigmoid(net.a * raw + net.b), y, bins.column("lang").to_pylist(), k)


def _score(net: Net):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = K.buffers(batch.column("text"))
            out = [np.zeros(0)]
            for i, j in K.segments(offsets):
                out.append(net.score(*tokens(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(np.concatenate(out))],
                                             names=["doc_id", "held_out", "threshold", "score"])

    return run


def score(docs: DataFrame, net: Net, cuts: dict[str, float]) -> DataFrame:
    """(doc_id, held_out, score, predicted, threshold, flagged)."""
    cut = F.lit(CUT)
    for name, value in cuts.items():
        cut = F.when(F.col("lang") == name, F.lit(value)).otherwise(cut)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), L.held_out(FOLDS, HELD_OUT).alias("held_out"), cut.alias("threshold"), "text")
    out = rows.mapInArrow(_score(net), "doc_id long, held_out boolean, threshold double, score double")
    return out.select("doc_id", "held_out", "score", (F.col("score") >= CUT).cast("int").alias("predicted"), "threshold",
                      (F.col("score") >= F.col("threshold")).alias("flagged"))
