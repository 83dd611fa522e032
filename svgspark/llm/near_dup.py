"""MinHash near-dedup by a multi-index Hamming join over b-bit signatures.

A document's set is its distinct shingles of ``width`` words (A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``): 2 in
op2, 5 in the pipeline. Its
signature has ``SLOTS`` minima reduced to 16 bits each. By the pigeonhole principle two signatures that
differ in at most ``CHUNKS * (ERRORS + 1) - 1`` slots agree in all but ``ERRORS`` slots of some chunk, so
every chunk is indexed once for each choice of ``ERRORS`` slots left out: all pairs under that distance meet
in a bucket. With 60 slots the guarantee holds up to distance 23; two sets of similarity 0.8 differ in 12
slots on average, and miss every bucket with probability 1e-7.

Buckets propose, sets decide: every proposed pair is confirmed on the full sets. Buckets are not expanded
into all pairs. First each member meets the bucket's smallest member, its hub (a star, linear in the bucket).
After the confirmed links are joined into components, the buckets whose hubs share a component form a family;
of a family only members of different components can add anything, since pairs inside one component cannot
change it. Small families meet pair by pair; large ones are cut into tiles, and two tiles are compared inside
a task by one product of their incidence matrices, which hands on nothing but confirmed links. So every pair
that shares a bucket is confirmed, refuted, or already connected, and no link between components is lost.
Documents with equal sets collapse into a class before any of this, by partial aggregation.

Defined results: null, empty or blank texts have no shingles and link with nothing; fewer than ``width`` words are
one shingle; rows that share a doc_id are one node of the graph, linked through any of their texts; a row with a null doc_id links with nothing, its
component_id is null and it is kept; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from svgspark.llm import textkit as K
from svgspark.llm.common import small_batches, thinned, written
from svgspark.llm.components import components

CHUNKS, CHUNK_SLOTS, ERRORS = 12, 5, 1
SLOTS = CHUNKS * CHUNK_SLOTS
BITS = 16
SALTS = 16
CHUNK = 4096
SMALL = 12  # members of a family up to which its pairs are joined one by one
TILE = 512
#: Words of a shingle in the contract of op2.
WIDTH = 2

_rng = np.random.default_rng(2)
_A = _rng.integers(1, 2**63, SLOTS, dtype=np.uint64)[:, None] * K.U64(2) + K.U64(1)
_B = _rng.integers(0, 2**63, SLOTS, dtype=np.uint64)[:, None]
_SLOT = np.arange(SLOTS, dtype=np.uint64) * K.U64(0x9E3779B97F4A7C15)
#: The slots that stay of each chunk when ``ERRORS`` of its slots are left out.
_STAY = np.array([[c * CHUNK_SLOTS + s for s in keep] for c in range(CHUNKS)
                  for keep in combinations(range(CHUNK_SLOTS), CHUNK_SLOTS - ERRORS)])
_WHICH = K.mix(np.arange(1, len(_STAY) + 1, dtype=np.uint64))


def signature(shingles: np.ndarray) -> np.ndarray:
    """The 16-bit slots of a set of shingle hashes."""
    low = np.full(SLOTS, 2**64 - 1, np.uint64)
    for i in range(0, len(shingles), CHUNK):
        np.minimum(low, (shingles[None, i:i + CHUNK] * _A + _B).min(axis=1), out=low)
    return K.mix(low ^ _SLOT) >> K.U64(64 - BITS)


def bucket_keys(sig: np.ndarray) -> np.ndarray:
    """One 64-bit key for each chunk and each choice of left-out slots: the slots side by side, tagged."""
    key = np.zeros(len(_STAY), np.uint64)
    for j in range(_STAY.shape[1]):
        key = (key << K.U64(BITS)) | sig[_STAY[:, j]]
    return K.mix(key ^ _WHICH)


def _documents(batch: pa.RecordBatch, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text of a batch."""
    data, offsets = K.buffers(batch.column(1))
    hasher = _documents.hasher
    for i, j in K.segments(offsets):
        part, off = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        starts, ends, first = K.words(part, off)
        h = hasher.spans(hasher.prefix(part), starts, ends)
        for k in range(j - i):
            yield K.shingles(h[first[k]:first[k + 1]], width)


_documents.hasher = K.SpanHash(fold=True)


def _sign(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, s1, s2, keys, ends = [], [], [], [], [0]
            for s in _documents(batch, width):
                n.append(len(s))
                if len(s):
                    s1.append(int(K.mix(s).sum().view(np.int64)))
                    s2.append(int(K.mix(s ^ K.U64(0x2545F4914F6CDD1D)).sum().view(np.int64)))
                    keys.append(bucket_keys(signature(s)).view(np.int64))
                else:
                    s1.append(None)
                    s2.append(None)
                ends.append(ends[-1] + (len(_STAY) if len(s) else 0))
            flat = np.concatenate(keys) if keys else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))],
                names=["doc_id", "n_shingles", "s1", "s2", "keys"])

    return sign


def _sets(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s.view(np.int64) for s in _documents(batch, width)]
            ends = np.cumsum([0] + [len(s) for s in sets])
            flat = np.concatenate(sets) if sets else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))], names=["id", "shingles"])

    return sets_of


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= 80 * union."""
    rows = pairs.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("y")), "b") \
        .join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("x")), "a")
    rows = rows.select("a", "b", F.size(F.array_intersect("x", "y")).cast("long").alias("both"),
                       (F.size("x") + F.size("y")).cast("long").alias("sum"))
    return rows.where("100 * both >= 80 * (sum - both)").select("a", "b")


def _incidence(rows: list[np.ndarray], tokens: np.ndarray) -> np.ndarray:
    """0/1 matrix of which of the sorted tokens each row's sorted set holds."""
    out = np.zeros((len(rows), len(tokens)), np.float32)
    for k, s in enumerate(rows):
        part = s[np.searchsorted(s, tokens[0]):np.searchsorted(s, tokens[-1], "right")]
        at = np.searchsorted(tokens, part)
        out[k, at[tokens[np.minimum(at, len(tokens) - 1)] == part]] = 1
    return out


def _tile_links(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """The links between two tiles of a family, of members in different components."""
    none = pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
    if not len(left) or not len(right):
        return none
    x, y = ([np.sort(s) for s in side["shingles"]] for side in (left, right))
    tokens = np.intersect1d(np.concatenate(x), np.concatenate(y))
    both = np.zeros((len(x), len(y)), np.float32)  # exact: counts below 2^24 are whole numbers
    for i in range(0, len(tokens), CHUNK):
        both += _incidence(x, tokens[i:i + CHUNK]) @ _incidence(y, tokens[i:i + CHUNK]).T
    total = np.array([len(s) for s in x], np.float64)[:, None] + np.array([len(s) for s in y], np.float64)[None, :]
    i, j = np.nonzero(100 * both.astype(np.float64) >= 80 * (total - both))
    a, b = left["id"].to_numpy()[i], right["id"].to_numpy()[j]
    ok = left["component"].to_numpy()[i] != right["component"].to_numpy()[j]
    return pd.DataFrame({"a": a[ok], "b": b[ok]})


def near_duplicates(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), a row for each row of ``docs``; shingles have ``width`` words."""
    small_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = written(
        texts.mapInArrow(_sign(width), "doc_id long, n_shingles long, s1 long, s2 long, keys array<long>"), "signatures")
    live = signed.where("doc_id IS NOT NULL AND n_shingles > 0")

    # classes of equal sets, and of rows that share a doc_id: the smallest doc_id stands for the class
    shared = live.groupBy("s1", "s2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("c")).where("c > 1").drop("c")
    shared = shared.withColumn("salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
    nodes = written(
        live.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
        .join(shared, ["s1", "s2", "salt"], "left")
        .select("doc_id", F.coalesce("rep", "doc_id").alias("rep"), F.when(F.coalesce("rep", "doc_id") == F.col("doc_id"), F.col("keys")).alias("keys")),
        "classes")

    entries = nodes.select(F.col("rep").alias("id"), F.explode("keys").alias("key"))
    hubs = entries.groupBy("key").agg(F.min("id").alias("hub"), F.max("id").alias("last")).where("hub < last").drop("last")
    stars = written(entries.join(hubs, "key").where("id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct(), "stars")

    wanted = stars.select(F.col("a").alias("id")).union(stars.select("b")).distinct()
    wanted = written(wanted, "wanted")
    some = thinned(texts, "doc_id", wanted)
    sets = written(some.join(wanted, some["doc_id"] == wanted["id"], "left_semi").mapInArrow(_sets(width), "id long, shingles array<long>"), "sets")
    links = written(_confirmed(stars, sets), "links")
    same = nodes.where("doc_id <> rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))

    # what stars cannot see: members of one family that are in different components so far
    label = written(components(links), "labels")
    hub, member = label.select(F.col("node").alias("a"), F.col("component").alias("fa")), label.select(F.col("node").alias("b"), F.col("component").alias("fb"))
    family = written(stars.join(hub, "a", "left").join(member, "b", "left").select(
        F.coalesce("fa", "a").alias("family"), F.col("b").alias("id"), F.coalesce("fb", "b").alias("component")).distinct(), "families")
    foreign = F.col("component") != F.col("family")
    count = family.groupBy("family").agg(F.sum(foreign.cast("int")).alias("out"), F.sum((~foreign).cast("int")).alias("own")) \
        .where("out > 0 AND out + own > 1")
    family = written(family.join(count, "family"), "open")

    small = family.where(f"out + own <= {SMALL}").select("family", "id", "component")
    right = small.select("family", F.col("id").alias("b"), F.col("component").alias("cb"))
    pairs = small.select("family", F.col("id").alias("a"), F.col("component").alias("ca")).join(right, "family") \
        .where("a < b AND ca <> cb").select("a", "b").distinct().join(stars, ["a", "b"], "left_anti")
    more = _confirmed(written(pairs, "pairs"), sets)

    large = family.where(f"out + own > {SMALL}").join(sets, "id")
    tiles = {"out": F.ceil(F.col("out") / TILE).cast("int"), "own": F.ceil(F.col("own") / TILE).cast("int")}
    large = large.withColumns(tiles).withColumn("far", foreign) \
        .withColumn("tile", F.pmod(F.xxhash64("id"), F.when(F.col("far"), F.col("out")).otherwise(F.col("own"))).cast("int"))
    # foreign tile s meets every own tile, and the foreign tiles s..
    t = F.when(F.col("far"), F.col("own") + F.col("tile")).otherwise(F.col("tile"))
    last = F.when(F.col("far"), F.col("tile")).otherwise(F.col("out") - 1)
    columns = ["family", "s", "t", "id", "component", "shingles"]
    left = large.where("far").select("family", F.col("tile").alias("s"), F.explode(F.concat(
        F.slice(F.sequence(F.lit(0), F.col("own")), F.lit(1), F.col("own")), F.sequence(F.col("own") + F.col("tile"), F.col("own") + F.col("out") - 1))).alias("t"),
        "id", "component", "shingles")
    right = large.select("family", F.explode(F.sequence(F.lit(0), last)).alias("s"), t.alias("t"), "id", "component", "shingles").toDF(*columns)
    keys = ["family", "s", "t"]
    dense = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(_tile_links, "a long, b long")
    links = links.unionByName(more).unionByName(dense)

    label = components(links.unionByName(same))
    out = signed.join(label, (signed["doc_id"] == label["node"]) & (signed["n_shingles"] > 0), "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) < 2 THEN w
    ELSE list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM w),
n AS (SELECT doc_id, len(s) AS n FROM s),
u AS (SELECT doc_id, unnest(s) AS x FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM u a JOIN u b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n m ON m.doc_id = a JOIN n o ON o.doc_id = b WHERE 100 * c >= 80 * (m.n + o.n - c)),
r AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b)
SELECT doc_id, n::BIGINT AS n_shingles, min(b) AS component_id, doc_id = min(b) AS kept
FROM n JOIN r ON r.a = doc_id GROUP BY doc_id, n
"""
