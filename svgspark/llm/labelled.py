"""Labelled rows for the trained operators: folds, bounded samples, and calibration."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Bits of the bitmap of labelled ids: 8 MB.
FILTER = 1 << 26


def fold(n: int) -> Column:
    """crc32 of the doc_id as text, modulo n."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(n))


def held_out(n: int, remainder: int) -> Column:
    return F.coalesce(fold(n) == remainder, F.lit(False))


def known(labels: DataFrame, label: str, n: int, remainder: int) -> DataFrame:
    """(doc_id, label) of the labelled ids outside the held-out fold. Rows with a null id or label are left out; if rows
    of one doc_id disagree, label 0 stands."""
    return labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(n, remainder)) \
        .groupBy("doc_id").agg(F.min(label).cast("int").alias("label"))


def labelled(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` with the label of their id. Only texts whose id has its bit in a bitmap of ``FILTER`` bits, which is
    broadcast, come to the join, so that the shuffle holds the labelled texts and few others, however many ids there are."""
    at = F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(FILTER))
    place = {"_block": F.floor(at / 32768).cast("int"), "_bit": (at % 32768).cast("int")}
    bits = ids.withColumns(place).groupBy("_block").agg(F.bitmap_construct_agg(F.col("_bit").cast("long")).alias("_bits"))
    byte = F.conv(F.hex(F.expr("substring(_bits, _bit div 8 + 1, 1)")), 16, 10).cast("int")
    near = docs.withColumns(place).join(F.broadcast(bits), "_block").where(F.expr("1").bitwiseAND(F.call_function("shiftright", byte, F.col("_bit") % 8)) == 1)
    return near.drop("_block", "_bit", "_bits").join(ids.hint("merge"), "doc_id")


def sample(docs: DataFrame, labels: DataFrame, label: str, n: int, remainder: int, rows: int, *more: str) -> DataFrame:
    """(doc_id, label, text, *more) of at most ``rows`` labelled documents outside the held-out fold, by hash order.

    Only the ids are broadcast, ``rows`` of them at most.
    """
    ids = known(labels, label, n, remainder).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return docs.select("doc_id", "text", *more).join(F.broadcast(ids), "doc_id").select("doc_id", "label", "text", *more)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def auc(y: np.ndarray, score: np.ndarray) -> float:
    """Probability that a row of label 1 scores above one of label 0, ties counted half."""
    _, inverse, n = np.unique(score, return_inverse=True, return_counts=True)
    rank = (np.cumsum(n) - (n - 1) / 2)[inverse]
    p = int((y == 1).sum())
    return float((rank[y == 1].sum() - p * (p + 1) / 2) / max(1, p * (len(y) - p)))


def platt(raw: np.ndarray, y: np.ndarray, steps: int = 60, n: np.ndarray | None = None) -> tuple[float, float]:
    """(a, b) of the calibrated probability sigmoid(a * raw + b), by damped Newton steps; ``n``: how many rows each stands for."""
    n = np.ones(len(raw)) if n is None else n
    spread = np.sqrt(np.average((raw - np.average(raw, weights=n))**2, weights=n)) + 1e-9
    x = np.stack([raw / spread, np.ones(len(raw))], axis=1)
    w = np.zeros(2)
    for _ in range(steps):
        p = sigmoid(x @ w)
        g = x.T @ ((p - y) * n) + 1e-2 * w
        h = (x * (p * (1 - p) * n)[:, None]).T @ x + 1e-2 * np.eye(2)
        w -= np.clip(np.linalg.solve(h, g), -2, 2)
    return float(w[0] / spread), float(w[1])


def best_cut(raw: np.ndarray, y: np.ndarray, gain, n: np.ndarray | None = None) -> float:
    """The middle of the best gap between neighbouring scores; gain(tp, fp, fn, tn) with raw >= cut called 1; ``n`` as in ``platt``."""
    order = np.argsort(raw, kind="stable")
    s, t, n = raw[order], y[order], np.ones(len(raw), int) if n is None else n[order]
    below1, below0 = np.concatenate([[0], np.cumsum((t == 1) * n)]), np.concatenate([[0], np.cumsum((t == 0) * n)])
    value = gain(below1[-1] - below1, below0[-1] - below0, below1, below0).astype(float)
    edge = np.concatenate([[s[0] - 1], (s[1:] + s[:-1]) / 2, [s[-1] + 1]])
    value[1:-1][s[1:] == s[:-1]] = -np.inf
    best = np.flatnonzero(value >= value.max() - 1e-12)
    return float(edge[best[len(best) // 2]])
