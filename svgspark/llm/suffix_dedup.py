"""Suffix-array dedup with a logarithmic family of indexes.

Every byte covered by a ``LENGTH``-byte string that starts anywhere else too, in any document, is removed.

The suffix arrays are sparse. Each window of ``LENGTH`` bytes points at one suffix: the one that starts at the
window's smallest ``ANCHOR``-byte gram (by fingerprint, leftmost on ties). Equal windows point at equal
places, so two windows can only be equal if their suffixes share the first ``ANCHOR`` bytes; on ordinary text
one suffix in 70 or so is kept. A suffix is entered under the 64-bit fingerprint of that prefix and sorted by it.

Documents arrive in batches. A batch gets its suffix array (fingerprint, count), sorted and bucketed by
fingerprint. It is merge-scanned against every existing level: fingerprints that occur twice over batch and
levels are matches. Then it joins the family: two runs of one level merge into a run of the next, so a suffix
is rewritten a logarithmic number of times. Bucketed runs are merged and scanned without another shuffle.

Matches become long matches in two exact steps. Entries whose whole context (all windows of the suffix) has an
equal one elsewhere are repeated as a whole. What remains in a fingerprint with several contexts, mostly the
edges of repeated passages, is compared window by window, one representative for each context: in one task for
a fingerprint with up to ``MANY`` contexts (some 40 MB), as shuffled rows of window fingerprints beyond. Counting uses partial
aggregation and joins that Spark may split, so a passage held by a third of all documents costs its entries, not
their pairs. Texts are shuffled once, compressed, for both the comparison and the cut.

Strings are compared by fingerprints: 64 bits of the prefix together with 64 bits of the context or window.

Defined results: null or empty text has no bytes; texts shorter than ``LENGTH`` lose nothing; rows that repeat
count as documents each, so a long text given twice goes entirely; texts of any length are handled in
overlapping chunks; a null doc_id is a value like any other; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from svgspark.llm import textkit as K
from svgspark.llm.common import dropped, row_id, scratch, small_batches, written

LENGTH = 200
ANCHOR = 32
#: Prefixes with more contexts than this are compared as rows of windows instead of whole in one task.
MANY = 1 << 17
AT_ONCE = 1 << 19  # windows compared at once
SPAN = LENGTH - ANCHOR + 1  # grams of a window
_HASH = K.SpanHash(seed=3)
_LOW = K.U64(0xFFFFFFFF)


def _smallest(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, from running minima of blocks in both directions."""
    n = len(x)
    m = -(-n // width)
    blocks = np.full(m * width, np.iinfo(np.uint64).max, np.uint64)
    blocks[:n] = x
    blocks = blocks.reshape(m, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - width + 1], ahead[width - 1:n])


def _chunks(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """(bytes, offsets, first document, place in it): documents together, or overlapping chunks of a long one."""
    for i, j in K.segments(offsets):
        a, b = int(offsets[i]), int(offsets[j])
        if j - i > 1 or b - a <= 2 * K.SEGMENT:
            yield data[a:b], offsets[i:j + 1] - a, i, 0
            continue
        for c in range(a, b - LENGTH + 1, K.SEGMENT):
            e = min(b, c + K.SEGMENT + LENGTH - 1)
            yield data[c:e], np.array([0, e - c]), i, c - a


def entries(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(document, prefix fingerprint, context fingerprint, first window, last window, place) of each kept suffix."""
    none = tuple(np.zeros(0, t) for t in (np.int64, np.uint64, np.uint64, np.int64, np.int64, np.int64))
    n = len(data)
    if n < LENGTH:
        return none
    prefix = _HASH.prefix(data)
    at = np.arange(n - ANCHOR + 1)
    gram = K.mix(_HASH.spans(prefix, at, at + ANCHOR))
    low = _smallest((gram & ~_LOW) | at.astype(np.uint64), SPAN)
    inside = np.zeros(n + 1, np.int64)
    long = np.flatnonzero(np.diff(offsets) >= LENGTH)
    np.add.at(inside, offsets[long], 1)
    np.add.at(inside, offsets[long + 1] - LENGTH + 1, -1)
    windows = np.flatnonzero(np.cumsum(inside)[:n] > 0)
    if not len(windows):
        return none
    pick = (low[windows] & _LOW).astype(np.int64)
    edge = np.flatnonzero(np.diff(pick) != 0)
    first = windows[np.concatenate([[0], edge + 1])]
    last = windows[np.concatenate([edge, [len(windows) - 1]])]
    p = pick[np.concatenate([[0], edge + 1])]
    context = _HASH.spans(prefix, first, last + LENGTH)
    context = K.mix(context + (p - first).astype(np.uint64) * K.U64(0x9FB21C651E98DF25) + (last - first).astype(np.uint64))
    return np.searchsorted(offsets, first, "right") - 1, gram[p], context, first, last, p


def _suffixes(full: bool):
    """Rows (rid, a[, c, first, more, left]) of the suffixes of a batch of (rid, text).

    first: the first window of the suffix; more: how many follow; left: how far the first one begins before the suffix.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = K.buffers(batch.column(1))
            rid = batch.column(0).to_numpy()
            for part, off, doc, place in _chunks(data, offsets):
                d, a, c, first, last, p = entries(part, off)
                start = off[d] - place
                cols = [pa.array(rid[doc + d]), pa.array(a.view(np.int64))]
                names = ["rid", "a"]
                if full:
                    cols += [pa.array(c.view(np.int64)), pa.array(first - start), pa.array((last - first).astype(np.int32)),
                             pa.array((p - first).astype(np.int32))]
                    names += ["c", "first", "more", "left"]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return run


def _squeezed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rid, doc_id, body): texts as they are shuffled, compressed one by one."""
    pack = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        data, offsets = K.buffers(batch.column("text"))
        body = [pack(data[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
        yield pa.RecordBatch.from_arrays([batch.column("rid"), batch.column("doc_id"), pa.array(body, pa.binary())],
                                         names=["rid", "doc_id", "body"])


def _body(cell: pa.Scalar) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(cell.as_buffer()), np.uint8)


def _lists(column: pa.Array) -> tuple[pa.StructArray, np.ndarray]:
    """The structs of a column of lists and where each row's begin; null is an empty list."""
    sizes = np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    return column.flatten(), np.concatenate([[0], np.cumsum(sizes)])


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rid, a, first, more, left, single, context): the bytes under all windows of the open entries of a document."""
    for batch in batches:
        flat, ends = _lists(batch.column("open"))
        first, more = flat.field("first").to_numpy(), flat.field("more").to_numpy()
        context = []
        for k in range(batch.num_rows):
            raw = _body(batch.column("body")[k]).tobytes()
            context += [raw[first[e]:first[e] + more[e] + LENGTH] for e in range(ends[k], ends[k + 1])]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(batch.column("rid").to_numpy(), np.diff(ends))), flat.field("a"), flat.field("first"),
             flat.field("more"), flat.field("left"), flat.field("single"), pa.array(context, pa.binary())],
            names=["rid", "a", "first", "more", "left", "single", "context"])


def _window_hashes(batch: pa.RecordBatch, low: int = -LENGTH, high: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(entry, start in the document, fingerprint) of the windows that begin low..high bytes before their suffix."""
    data, offsets = K.buffers(batch.column("context").cast(pa.large_binary()))
    first, left = batch.column("first").to_numpy(), batch.column("left").to_numpy().astype(np.int64)
    begin = np.maximum(0, left - high)
    n = np.maximum(0, np.minimum(batch.column("more").to_numpy(), left - low) - begin + 1)
    entry = np.repeat(np.arange(len(n)), n)
    inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - begin, n)
    w = np.zeros(len(entry), np.uint64)
    done = 0
    for i, j in K.segments(offsets):
        own = slice(done, done + int(n[i:j].sum()))
        at = inner[own] + offsets[entry[own]] - offsets[i]
        w[own] = K.mix(_HASH.spans(_HASH.prefix(data[offsets[i]:offsets[j]]), at, at + LENGTH))
        done = own.stop
    return entry, inner + first[entry], w


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rid, a, w, s, single): a row for each window; for prefixes with very many contexts."""
    for batch in batches:
        entry, s, w = _window_hashes(batch)
        take = pa.array(entry)
        yield pa.RecordBatch.from_arrays(
            [batch.column("rid").take(take), batch.column("a").take(take), pa.array(w.view(np.int64)), pa.array(s),
             batch.column("single").take(take)], names=["rid", "a", "w", "s", "single"])


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans (rid, lo, hi) of the windows that repeat within a prefix; rows come sorted by prefix."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch] if rest is None else [rest, batch]).combine_chunks()
        a = table.column("a").to_numpy()
        cut = int(np.searchsorted(a, a[-1])) if len(a) else 0
        rest = table.slice(cut).combine_chunks().to_batches()[0] if cut < len(a) else None
        if cut:
            yield _repeated(table.slice(0, cut).combine_chunks().to_batches()[0])
    if rest is not None:
        yield _repeated(rest)


def _repeated(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Equal windows begin equally far before their suffix, so a large group is compared one distance after another."""
    a, single = batch.column("a").to_numpy().view(np.uint64), batch.column("single").to_numpy(zero_copy_only=False)
    tag, step = K.mix(a), max(1, AT_ONCE // batch.num_rows)
    entries_, starts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for low in range(0, SPAN, step):
        entry, s, w = _window_hashes(batch, low, low + step - 1)
        _, inverse, n = np.unique(w ^ tag[entry], return_inverse=True, return_counts=True)
        hit = (n[inverse] > 1) & single[entry]
        entries_.append(entry[hit])
        starts.append(s[hit])
    entry, s = np.concatenate(entries_), np.concatenate(starts)
    order = np.lexsort([s, entry])
    entry, s = entry[order], s[order]
    new = np.ones(len(s) + 1, bool)
    new[1:-1] = (entry[1:] != entry[:-1]) | (s[1:] != s[:-1] + 1)
    begin, end = np.flatnonzero(new[:-1]), np.flatnonzero(new[1:])
    return pa.RecordBatch.from_arrays(
        [batch.column("rid").take(pa.array(entry[begin])), pa.array(s[begin]), pa.array(s[end] + LENGTH)], names=["rid", "lo", "hi"])


def _covered(n: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Which of n bytes lie in some span [lo, hi)."""
    step = np.zeros(n + 1, np.int32)
    np.add.at(step, lo, 1)
    np.add.at(step, hi, -1)
    return np.cumsum(step[:n]) > 0


def _cut(keep_text: bool):
    """doc columns and what is left of each text, given its removed spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, ends = _lists(batch.column("spans"))
            lo, hi = flat.field("lo").to_numpy(), flat.field("hi").to_numpy()
            rows = []
            for k in range(batch.num_rows):
                part = _body(batch.column("body")[k])
                gone = _covered(len(part), lo[ends[k]:ends[k + 1]], hi[ends[k]:ends[k + 1]])
                edge = np.diff(np.concatenate([[0], gone.view(np.int8), [0]]))
                begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
                kept = part[~gone].tobytes()
                rows.append((len(part), int(gone.sum()), hashlib.sha256(kept).hexdigest(),
                             np.stack([begin, end], axis=1).tolist(), kept if keep_text else None))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                 pa.array([len(r[3]) for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.string()),
                 pa.array([r[3] for r in rows], pa.list_(pa.list_(pa.int64()))), pa.array([r[4] for r in rows], pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed", "kept"])

    return run


class SuffixFamily:
    """The index family: runs (a, n) bucketed and sorted by prefix fingerprint, at most one of each level."""

    def __init__(self, spark: SparkSession, buckets: int) -> None:
        self.spark, self.buckets = spark, buckets
        self.levels: dict[int, tuple[str, str]] = {}

    def _run(self, rows: DataFrame, tag: str) -> tuple[str, str]:
        path = scratch(self.spark, f"suffix-{tag}")
        name = path.rsplit("/", 1)[1].replace("-", "_")
        rows.select("a", "n").write.bucketBy(self.buckets, "a").sortBy("a").option("path", path).saveAsTable(name)
        return name, path

    def _drop(self, run: tuple[str, str]) -> None:
        self.spark.sql(f"DROP TABLE {run[0]}")
        dropped(self.spark, run[1])

    def add(self, grams: DataFrame) -> DataFrame:
        """Takes the batch in; the fingerprints (a) that it repeats, within itself or from the levels."""
        # counted before the shuffle, so that a frequent prefix arrives as one row of each task
        array = self._run(grams.groupBy("a").agg(F.count("*").alias("n")), "batch")
        scan = self.spark.table(array[0]).select("a", "n", F.lit(True).alias("new"))
        for run in self.levels.values():
            scan = scan.union(self.spark.table(run[0]).select("a", "n", F.lit(False)))
        hits = scan.groupBy("a").agg(F.sum("n").alias("n"), F.max("new").alias("new")).where("new AND n > 1").select("a")
        hits = written(hits, "matches")
        level, merging = 0, [array]
        while level in self.levels:
            merging.append(self.levels.pop(level))
            level += 1
        if len(merging) > 1:
            rows = self.spark.table(merging[0][0])
            for run in merging[1:]:
                rows = rows.union(self.spark.table(run[0]))
            self.levels[level] = self._run(rows.groupBy("a").agg(F.sum("n").alias("n")), f"level{level}")
            for run in merging:
                self._drop(run)
        else:
            self.levels[level] = array
        return hits

    def close(self) -> None:
        for run in self.levels.values():
            self._drop(run)
        self.levels = {}


def remove_repeats(docs: DataFrame, batches: int = 4, keep_text: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed, kept), a row for each row of ``docs``.

    removed: the spans [from, to) in bytes; kept: the remaining bytes, if ``keep_text``.
    """
    spark = small_batches(docs.sparkSession)
    texts = docs.select("doc_id", row_id("doc_id", "text").alias("rid"), "text")
    pairs = texts.select("rid", "text")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    path = scratch(spark, "grams")
    pairs.mapInArrow(_suffixes(False), "rid long, a long").select("a", F.pmod("rid", F.lit(batches)).alias("batch")) \
        .write.partitionBy("batch").parquet(path)
    grams = spark.read.schema("a long, batch int").parquet(path)
    family = SuffixFamily(spark, buckets)
    hits = None
    for k in range(batches):
        own = family.add(grams.where(F.col("batch") == k).select("a"))
        hits = own if hits is None else hits.union(own)
    family.close()
    dropped(spark, path)

    suffixes = pairs.mapInArrow(_suffixes(True), "rid long, a long, c long, first long, more int, left int")
    path = scratch(spark, "matched")
    # both sides of the two joins are plain shuffles, so that Spark may split a prefix that very many suffixes share
    hits = written(hits.distinct(), "hits")
    suffixes.join(hits.hint("merge"), "a", "left_semi").write.parquet(path)
    matched = spark.read.schema("rid long, a long, c long, first long, more int, left int").parquet(path)
    contexts = matched.groupBy("a", "c").agg(F.count("*").alias("n"), F.min(F.struct("rid", "first")).alias("rep"))
    several = contexts.groupBy("a").agg(F.count("*").alias("contexts"))
    contexts = written(contexts.join(several, "a").where("n > 1 OR contexts > 1"), "contexts")
    judged = written(matched.join(contexts, ["a", "c"]).select(
        "rid", "a", "first", "more", "left", (F.col("n") == 1).alias("single"),
        F.when(F.struct("rid", "first") == F.col("rep"), F.col("contexts")).otherwise(1).alias("contexts")), "judged")
    dropped(spark, path)
    full = judged.where("NOT single").select("rid", F.col("first").alias("lo"), (F.col("first") + F.col("more") + LENGTH).alias("hi"))

    # the filter stands for the one that inner joins add: with it all uses of the exchange are alike
    bodies = texts.mapInArrow(_squeezed, "rid long, doc_id long, body binary").where("rid IS NOT NULL")
    entry = F.collect_list(F.struct("a", "first", "more", "left", "single")).alias("open")
    opened = [_with_lists(bodies, judged.where(c).groupBy("rid").agg(entry), "inner", "open").mapInArrow(
        _contexts, "rid long, a long, first long, more int, left int, single boolean, context binary")
        for c in (f"contexts > 1 AND contexts <= {MANY}", f"contexts > {MANY}")]
    edges = opened[0].repartition("a").sortWithinPartitions("a").mapInArrow(_compared, "rid long, lo long, hi long")
    windows = opened[1].mapInArrow(_windows, "rid long, a long, w long, s long, single boolean")
    again = windows.groupBy("a", "w").agg(F.count("*").alias("n")).where("n > 1").select("a", "w")
    many = windows.where("single").join(again, ["a", "w"], "left_semi") \
        .select("rid", F.col("s").alias("lo"), (F.col("s") + LENGTH).alias("hi"))
    spans = full.union(edges).union(many).groupBy("rid").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    return _with_lists(bodies, spans, "left", "spans").mapInArrow(
        _cut(keep_text), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
        "removed array<array<long>>, kept binary")


def _with_lists(bodies: DataFrame, lists: DataFrame, how: str, name: str) -> DataFrame:
    """Every use has the same columns of ``bodies``, so Spark shuffles the texts once for all of them."""
    return bodies.join(lists.hint("shuffle_hash"), "rid", how).select("rid", "doc_id", "body", name)


def op3(docs: DataFrame) -> DataFrame:
    """Digest columns of the contract."""
    return remove_repeats(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
