"""Quality classifier by Bradley-Terry pairwise ranking.

A document's score is linear in its surface statistics (``stats.FEATURES``). The weights are learned from
preference pairs, a row of label 1 over a row of label 0: the pair's probability is the logistic function of
the score difference, and the loss is its logarithm on feature differences. A document is good if its score is
above a quantile of the training scores, the one that separates the labels best there. The reported score maps
that quantile to ``CUT`` and follows a logistic curve around it.

Training sees at most ``ROWS`` labelled rows outside the held-out fold, as vectors of a fixed length; all
documents are scored in Arrow batches. Labels, language, source and ids are never inputs.

Defined results: null, empty and blank texts have all-zero statistics and are scored like others; rows that
repeat are scored each; null ids are not held out; without labels of both kinds all scores are equal, above
``CUT`` unless every label is 0; an empty table gives an empty result; other columns are ignored or pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from svgspark.llm import labelled as L
from svgspark.llm import stats
from svgspark.llm import textkit as K

ROWS = 20_000
PAIRS = 60_000
STEPS = 300
CUT = 0.7
FOLDS, HELD_OUT = 4, 2


@dataclass(frozen=True)
class Ranking:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float  # the raw score at the quantile
    quantile: float
    slope: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return L.sigmoid(np.log(CUT / (1 - CUT)) + self.slope * (self.raw(x) - self.cut))


def fit(x: np.ndarray, y: np.ndarray, pairs: int = PAIRS, steps: int = STEPS, penalty: float = 1e-3) -> Ranking:
    """Learns from rows x with labels y."""
    d = len(stats.FEATURES)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return Ranking(np.zeros(d), np.ones(d), np.zeros(d), 1.0 if len(bad) else -1.0, 0.0, 1.0)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = np.clip((x - mean) / scale, -8, 8)
    rng = np.random.default_rng(9)
    diff = z[rng.choice(good, pairs)] - z[rng.choice(bad, pairs)]
    w, m, v = np.zeros(d), np.zeros(d), np.zeros(d)
    for k in range(1, steps + 1):
        g = -diff.T @ (1 - L.sigmoid(diff @ w)) / pairs + penalty * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.1 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
    raw = z @ w
    cut = L.best_cut(raw, y, lambda tp, fp, fn, tn: tp + tn)
    a, _ = L.platt(raw, y)
    return Ranking(mean, scale, w, cut, float((raw < cut).mean()), max(a, 1e-6))


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = K.buffers(batch.column("text"))
        x = np.concatenate([stats.features(t) for t in stats.of_segments(data, offsets)] or [np.zeros((0, len(stats.FEATURES)))])
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(list(x), pa.list_(pa.float64()))],
                                         names=["doc_id", "label", "x"])


def train(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> Ranking:
    got = L.sample(docs, labels, "quality", FOLDS, HELD_OUT, rows) \
        .mapInArrow(_vectors, "doc_id long, label int, x array<double>").collect()
    got.sort(key=lambda r: (r["doc_id"], r["x"]))
    return fit(np.array([r["x"] for r in got]).reshape(-1, len(stats.FEATURES)), np.array([r["label"] for r in got], int))


def _score(model: Ranking):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = K.buffers(batch.column("text"))
            s = np.concatenate([model.score(stats.features(t)) for t in stats.of_segments(data, offsets)] or [np.zeros(0)])
            rest = [batch.column(k) for k in range(batch.num_columns) if batch.schema.names[k] != "text"]
            names = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(s)], names=[*names, "score"])

    return run


def score(docs: DataFrame, model: Ranking) -> DataFrame:
    """(doc_id, held_out, score, predicted)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), L.held_out(FOLDS, HELD_OUT).alias("held_out"), "text")
    return rows.mapInArrow(_score(model), "doc_id long, held_out boolean, score double") \
        .withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def good_documents(docs: DataFrame, model: Ranking) -> DataFrame:
    """The documents that the model does not reject, columns as they are."""
    rows = docs.select(F.struct("*").alias("row"), "text")
    schema = StructType([rows.schema["row"], StructField("score", DoubleType())])
    return rows.mapInArrow(_score(model), schema).where(F.col("score") >= CUT).select("row.*")
