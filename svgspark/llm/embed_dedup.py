"""Embedding near-dedup by PCA-ordered tiled comparison.

Vectors of one label are normalised and turned into the principal axes of all vectors, largest variance first.
A tile holds a block of ``TILE`` vectors; two tiles are compared by accumulating the dot products dimension
block by dimension block. What the remaining dimensions can still add is at most the product of the two
suffix norms (Cauchy-Schwarz), so a pair whose partial product plus that bound stays below the threshold is
given up, and a pair of tiles ends as soon as no pair is left. Survivors are confirmed by their cosine in
double precision on the vectors as given.

Equal vectors collapse into a class first; a class counts as often as it occurs and is not expanded. Every
label is cut into tiles, and every pair of tiles of a label is a task of its own kind (tile i with tile j), so
a label with a third of all vectors is shared by many tasks and none ever holds a whole label. A pair of tiles
hands on a row for each linked vector (its number of links, and the smallest vector that it reaches through
them), not a row for each link. The axes come
from the 64 x 64 or so matrix of second moments, summed by Spark over all vectors.

Defined results: vectors that are null, empty, zero or hold null or non-finite components link with nothing,
nor do vectors with a null label; vectors of different lengths link with nothing; rows that share a vec_id are
one node; a null vec_id links with nothing, its component_id is null and it is kept; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from svgspark.llm.common import written
from svgspark.llm.components import components

THRESHOLD = 0.98
TILE = 1024
STEP = 8  # dimensions accumulated between two looks at the bound
SPARSE = 64  # a tile goes on pair by pair when at most one pair in so many is left
SLACK = 1e-9  # rounding of the rotated products; survivors are confirmed on the vectors themselves


def _moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Second moments of the normalised vectors of a task, one row for each vector length."""
    total: dict[int, np.ndarray] = {}
    for pdf in batches:
        for dim, part in pdf.groupby("dim"):
            x = np.stack(part["v"].to_numpy())
            x = x / np.abs(x).max(axis=1, keepdims=True)
            x = x / np.linalg.norm(x, axis=1, keepdims=True)
            total[int(dim)] = total.get(int(dim), 0) + x.T @ x
    for dim, m in total.items():
        yield pd.DataFrame({"dim": dim, "i": np.arange(dim), "row": list(m)})


def axes(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Principal axes for each vector length: dim rows of dim numbers reach the driver, however many vectors there are."""
    rows = vectors.select("dim", "v").mapInPandas(_moments, "dim int, i int, row array<double>") \
        .select("dim", "i", F.posexplode("row").alias("j", "x")).groupBy("dim", "i", "j").agg(F.sum("x").alias("x")) \
        .groupBy("dim", "i").agg(F.transform(F.array_sort(F.collect_list(F.struct("j", "x"))), lambda e: e["x"]).alias("row")).collect()
    out: dict[int, np.ndarray] = {}
    for r in rows:
        out.setdefault(r["dim"], np.zeros((r["dim"], r["dim"])))[r["i"]] = r["row"]
    return {dim: np.linalg.eigh((m + m.T) / 2)[1][:, ::-1].copy() for dim, m in out.items()}


def near_pairs(x: np.ndarray, y: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of unit rows, in principal axes, whose dot product may reach the threshold."""
    rest_x = np.sqrt(np.maximum(np.cumsum((x * x)[:, ::-1], axis=1)[:, ::-1], 0))
    rest_y = np.sqrt(np.maximum(np.cumsum((y * y)[:, ::-1], axis=1)[:, ::-1], 0))
    dim = x.shape[1]
    part, e = 0.0, 0
    while True:  # the whole tile, until few pairs are left
        d, e = e, min(dim, e + STEP)
        part = part + x[:, d:e] @ y[:, d:e].T
        open_ = part + (np.outer(rest_x[:, e], rest_y[:, e]) if e < dim else 0.0) >= threshold - SLACK
        if e == dim or np.count_nonzero(open_) * SPARSE <= open_.size:
            break
    i, j = np.nonzero(open_)
    value = part[i, j]
    for d in range(e, dim, STEP):  # then pair by pair
        if not len(i):
            break
        e = min(dim, d + STEP)
        value = value + np.einsum("ij,ij->i", x[i, d:e], y[j, d:e])
        bound = rest_x[i, e] * rest_y[j, e] if e < dim else 0.0
        keep = value + bound >= threshold - SLACK
        i, j, value = i[keep], j[keep], value[keep]
    return i, j


def cosine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosine of row pairs, in double precision; rows are first scaled by a power of two so that nothing overflows."""
    x = x * np.exp2(-np.floor(np.log2(np.abs(x).max(axis=1, keepdims=True))))
    y = y * np.exp2(-np.floor(np.log2(np.abs(y).max(axis=1, keepdims=True))))
    return (x * y).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1)))


def _compare(turn: dict[int, np.ndarray], threshold: float):
    def run(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"id": np.zeros(0, np.int64), "least": np.zeros(0, np.int64), "others": np.zeros(0, np.int64)})
        v, w = np.stack(left["v"].to_numpy()), np.stack(right["v"].to_numpy())
        axis = turn[v.shape[1]]
        unit = [z / np.abs(z).max(axis=1, keepdims=True) for z in (v, w)]
        x, y = [(z / np.linalg.norm(z, axis=1, keepdims=True)) @ axis for z in unit]
        i, j = near_pairs(x, y, threshold)
        a, b = left["id"].to_numpy()[i], right["id"].to_numpy()[j]
        once = a < b if key[2] == key[3] else a != b
        i, j = i[once], j[once]
        sure = cosine(v[i], w[j]) >= threshold
        i, j = i[sure], j[sure]
        return _summary(left["id"].to_numpy()[i], right["id"].to_numpy()[j], left["n"].to_numpy()[i], right["n"].to_numpy()[j])

    return run


def _summary(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> pd.DataFrame:
    """What the links (a, b) of two tiles say, a row for each linked vector: the smallest vector that it reaches
    through them, and how many vectors they link it to."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    others = np.bincount(at, np.concatenate([size_b, size_a]), len(ids)).astype(np.int64)
    least = np.arange(len(ids))
    while True:
        low = np.minimum(least[x], least[y])
        new = least.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = new[new]
        if (new == least).all():
            return pd.DataFrame({"id": ids, "least": ids[least], "others": others})
        least = new


def near_duplicates(embeddings: DataFrame, threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """(vec_id, n_links, component_id, kept), a row for each row of ``embeddings``."""
    spark = embeddings.sparkSession
    v = F.transform("embedding", lambda x: x.cast("double"))
    fine = (F.size("embedding") > 0) & F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    ) & F.exists("embedding", lambda x: x != 0)
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "label",
                             F.when(F.coalesce(fine, F.lit(False)), v).alias("v"))
    live = rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")
    # -0.0 and 0.0 are equal components: adding zero makes them one
    live = live.select("vec_id", "label", F.transform("v", lambda x: x + F.lit(0.0)).alias("v"))
    classes = live.groupBy("label", "v").agg(F.min("vec_id").alias("id"), F.countDistinct("vec_id").alias("n")) \
        .withColumn("dim", F.size("v"))
    path = written(classes, "vectors")
    turn = axes(path)

    sizes = path.groupBy("label", "dim").count().withColumn("tiles", F.ceil(F.col("count") / tile).cast("int")).drop("count")
    placed = written(path.join(sizes, ["label", "dim"]).withColumn("tile", F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int")), "tiles")
    # tile t is the left side against tiles t.. and the right side against tiles ..t: its vectors go to each task once
    left = placed.select("label", "dim", F.col("tile").alias("s"), F.explode(F.sequence("tile", F.col("tiles") - 1)).alias("t"), "id", "n", "v")
    right = placed.select("label", "dim", F.explode(F.sequence(F.lit(0), F.col("tile"))).alias("s"), F.col("tile").alias("t"), "id", "n", "v")
    keys = ["label", "dim", "s", "t"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(_compare(turn, threshold), "id long, least long, others long")
    found = written(found, "found")

    degree = found.groupBy(F.col("id").alias("a")).agg(F.sum("others").alias("others"))
    label = components(found.select(F.col("id").alias("a"), F.col("least").alias("b")))
    member = live.select("vec_id", "label", "v").join(placed.select("label", "v", "id", "n"), ["label", "v"]) \
        .select("vec_id", "id", "n").join(degree, F.col("id") == degree["a"], "left").drop("a") \
        .join(label, F.col("id") == label["node"], "left") \
        .groupBy("vec_id").agg((F.max(F.col("n") - 1 + F.coalesce("others", F.lit(0)))).alias("n_links"),
                               F.min(F.coalesce("component", "id")).alias("component"))
    component = F.coalesce("component", "vec_id")
    return rows.select("vec_id").join(member, "vec_id", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"))


ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE label IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.98),
r AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b),
c AS (SELECT a, min(b) AS component FROM r GROUP BY a),
d AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(component, vec_id) AS component_id, coalesce(component, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN c ON c.a = vec_id LEFT JOIN d ON d.a = vec_id
"""
