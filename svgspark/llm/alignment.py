"""Alignment of two tokenizers over a corpus: which tokens of A and of B cover the same bytes.

A is a byte-level BPE file and reads a space and the text; B is a sentencepiece model, which adds that space itself.
Byte offsets where a token of A and one of B both end cut a document into groups. Between two neighbouring ends of
either kind lies the overlap of exactly one token of A with one of B, so a document's links are read off its ends.

Identity map: the vocabularies are compared once, which gives an array from A's ids to the ids of B with the same
bytes. Links of such a pair, those of all exact one-to-one groups among them, are counted in vectors as long as A's
vocabulary; only the other pairs of irregular groups are shuffled, summed by batch first. The counts then return to the
documents: those of identity pairs, of the ``FREQUENT`` most frequent other pairs and the highest count of each id of B
as arrays (bounded by the vocabularies and that parameter), those of the rarer pairs by a join, in which no pair is
frequent. Texts are tokenized once; what a document's links are is kept as a table of distinct pairs with counts.

Defined results: texts that are null or empty, or whose tokens do not spell the space and the text, have no tokens, no
links and the digest ''; rows that repeat are rows each, and count as often; a null doc_id is a value like any other; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from svgspark.llm import textkit as K
from svgspark.llm.common import Scratch, written
from svgspark.llm.packing import Ids, byte_letters

FREQUENT = 65_536
#: Units of B that a worker remembers, each of at most this many characters.
REMEMBERED, UNIT_CHARS = 300_000, 48
LINKS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, counts array<long>"


class Bytes:
    """The bytes of each id of a vocabulary, in one pool."""

    def __init__(self, entries: list[bytes]) -> None:
        self.entries = entries
        self.size = np.array([len(e) for e in entries], np.int64)
        self.at = np.cumsum(self.size) - self.size
        self.pool = np.frombuffer(b"".join(entries), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        size = self.size[ids]
        before = np.cumsum(size) - size
        return self.pool[np.repeat(self.at[ids] - before, size) + np.arange(int(size.sum()))]


class PlainIds(Ids):
    """A's ids, with the strings of special tokens read as ordinary text."""

    def __init__(self, path: str | None) -> None:
        super().__init__(path)
        self.library.encode_special_tokens = True
        self.special = []
        letters = byte_letters()
        special = {t.content for t in self.library.get_added_tokens_decoder().values()}
        entries = [b""] * self.library.get_vocab_size()
        for token, i in self.library.get_vocab().items():
            entries[i] = token.encode() if token in special else bytes(letters[c] for c in token)
        self.bytes = Bytes(entries)


class Pieces(dict):
    """B's ids. A unit, spaces and what follows them up to the next space, is encoded once and remembered as the bytes of
    its ids: no piece has a space after another character, so units do not meet in a piece."""

    UNIT = re.compile(" +[^ ]*")

    def __init__(self, path: str | None) -> None:
        super().__init__()
        import public_tokenizers
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path("piece_bpe_32k.model"))
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = Bytes([bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)])
        self.space = self.model.piece_to_id("▁")
        probe = " x  y \n z "
        self.units = not any("▁" in p.lstrip("▁") for p in pieces) and pieces[self.space] == "▁" \
            and self.bytes.joined(np.array(self.model.encode(probe))).tobytes() == f" {probe}".encode()

    def __missing__(self, unit: str) -> bytes:
        ids = [self.space] if unit == " " else self.model.encode(unit[1:], num_threads=1)
        out = np.array(ids, "<u4").tobytes()
        if len(unit) <= UNIT_CHARS:
            if len(self) >= REMEMBERED:
                self.clear()
            self[unit] = out
        return out

    def ids(self, text: str) -> np.ndarray:
        if not self.units:
            return np.array(self.model.encode(text, num_threads=1), "<u4")
        return np.frombuffer(b"".join(map(self.__getitem__, self.UNIT.findall(f" {text}"))), "<u4")


class Aligner:
    """Both tokenizers, the identity map, and the links of documents; one instance lives in each Python worker."""

    def __init__(self, a: str | None, b: str | None) -> None:
        self.a, self.b = PlainIds(a), Pieces(b)
        self.width = len(self.b.bytes.entries)
        same: dict[bytes, int] = {}
        for i, e in enumerate(self.b.bytes.entries):
            if e not in same or self.b.model.is_byte(same[e]):
                same[e] = i
        self.identity = np.array([same.get(e, -1) if e else -1 for e in self.a.bytes.entries], np.int64)
        # the digest's text of each token: A's, then B's; not the last of its group, and the last
        listed = [f"{i}{end}".encode() for n, last in ((len(self.identity), "|"), (self.width, ";")) for i in range(n) for end in (",", last)]
        self.letters = np.zeros((len(listed), max(map(len, listed))), np.uint8)
        for k, x in enumerate(listed):
            self.letters[k, :len(x)] = np.frombuffer(x, np.uint8)
        self.long = np.array([len(x) for x in listed], np.int64)

    def links(self, column: pa.Array) -> Iterator[tuple]:
        """For each text: n_a, n_b, n_groups, n_links, digest, distinct pairs (a * width + b), their counts."""
        texts = pc.fill_null(column, "").cast(pa.large_string())
        spaced = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts, pa.scalar("", pa.large_string()))
        data, offsets = K.buffers(spaced)
        a = list(self.a.of(spaced))
        docs = []
        for k, text in enumerate(texts.to_pylist()):
            own = data[offsets[k]:offsets[k + 1]]
            x = a[k].astype(np.int64)
            y = self.b.ids(text).astype(np.int64) if text else x[:0]
            fits = text and np.array_equal(self.a.bytes.joined(x), own) and np.array_equal(self.b.bytes.joined(y), own)
            docs.append((x, y, len(own)) if fits else None)
        some = [d for d in docs if d]
        rows = iter(self._aligned(some) if some else ())
        for d in docs:
            yield next(rows) if d else (0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64))

    def _aligned(self, docs: list[tuple]) -> Iterator[tuple]:
        a, b = (np.concatenate([d[k] for d in docs]) for k in (0, 1))
        size = np.array([d[2] for d in docs])
        mark = np.zeros(int(size.sum()) + 1, np.uint8)
        mark[np.cumsum(self.a.bytes.size[a])] |= 1
        mark[np.cumsum(self.b.bytes.size[b])] |= 2
        at = np.flatnonzero(mark)  # a link ends at each of these
        in_a, in_b = (mark[at] & 1) > 0, (mark[at] & 2) > 0
        both = in_a & in_b
        na, nb, ng = np.cumsum(in_a), np.cumsum(in_b), np.cumsum(both)
        end = np.searchsorted(at, np.cumsum(size)) + 1  # links up to the end of each document
        pair = a[na - in_a] * self.width + b[nb - in_b]
        # the digest's order: the tokens of A of a group, then those of B
        a_before = np.append(0, na[both])
        b_before = np.append(0, nb[both])
        code = np.empty(len(a) + len(b), np.int64)
        code[np.arange(len(a)) + b_before[(ng - both)[in_a]]] = 2 * a + both[in_a]
        code[np.arange(len(b)) + a_before[(ng - both)[in_b] + 1]] = 2 * (len(self.identity) + b) + both[in_b]
        long = self.long[code]
        text = self.letters[code][np.arange(self.letters.shape[1]) < long[:, None]].tobytes()
        upto = np.append(0, np.cumsum(long))[na[end - 1] + nb[end - 1]]
        doc = np.repeat(np.arange(len(docs)), np.diff(np.append(0, end)))
        base = len(self.identity) * self.width
        keys, counts = np.unique(doc * base + pair, return_counts=True)
        cut = np.searchsorted(keys, np.arange(len(docs) + 1) * base)
        keys %= base
        start = link = group = 0
        for k, (x, y, _) in enumerate(docs):
            groups = int(ng[end[k] - 1])
            yield (len(x), len(y), groups - group, int(end[k]) - link, hashlib.sha256(text[start:upto[k] - 1]).hexdigest(),
                   keys[cut[k]:cut[k + 1]], counts[cut[k]:cut[k + 1]])
            start, link, group = int(upto[k]), int(end[k]), groups


_ALIGNERS: dict[tuple, Aligner] = {}


def aligner(a: str | None, b: str | None) -> Aligner:
    if (a, b) not in _ALIGNERS:
        _ALIGNERS[a, b] = Aligner(a, b)
    return _ALIGNERS[a, b]


def _links(a: str | None, b: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(a, b)
        for batch in batches:
            _, offsets = K.buffers(batch.column(1))
            for i, j in K.segments(offsets):
                cols = list(zip(*own.links(batch.column(1).slice(i, j - i))))
                starts = pa.array(np.cumsum([0, *map(len, cols[5])]), pa.int32())
                lists = [pa.ListArray.from_arrays(starts, pa.array(np.concatenate(c), pa.int64())) for c in cols[5:]]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), *[pa.array(c, pa.int64()) for c in cols[:4]], pa.array(cols[4], pa.string()), *lists],
                    names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "counts"])

    return run


def links(docs: DataFrame, a: str | None = None, b: str | None = None) -> DataFrame:
    """For each row of ``docs`` its counts, the digest of its groups, and its distinct linked pairs with counts; a pair is
    the id of A times B's vocabulary size, plus the id of B."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_links(a, b), LINKS)


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pairs, counts, where each row's pairs start) of a batch whose last columns are pairs and counts."""
    pairs, counts = batch.column("pairs"), batch.column("counts")
    starts = pairs.offsets.to_numpy().astype(np.int64)
    return pairs.flatten().to_numpy(), counts.flatten().to_numpy(), starts - starts[0]


def _counted(a: str | None, b: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(a, b)
        exact = np.zeros(len(own.identity), np.int64)
        for batch in batches:
            pairs, counts, _ = _flat(batch)
            same = own.identity[pairs // own.width] == pairs % own.width
            exact += np.bincount(pairs[same] // own.width, counts[same], len(exact)).astype(np.int64)
            rest, inverse = np.unique(pairs[~same], return_inverse=True)
            n = np.bincount(inverse, counts[~same], len(rest)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(rest, pa.int64()), pa.array(n, pa.int64())], names=["pair", "n"])
        some = np.flatnonzero(exact)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some * own.width + own.identity[some], pa.int64()), pa.array(exact[some], pa.int64())], names=["pair", "n"])

    return run


def pair_counts(linked: DataFrame, a: str | None = None, b: str | None = None) -> DataFrame:
    """(pair, n): in how many links of the corpus each pair stands, from the rows of ``links``."""
    return linked.select("pairs", "counts").mapInArrow(_counted(a, b), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def _scored(keys: np.ndarray, totals: np.ndarray, best: np.ndarray):
    """Sums over the links whose pair is among ``keys``; the other pairs stay."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs, counts, starts = _flat(batch)
            at = np.minimum(np.searchsorted(keys, pairs), len(keys) - 1) if len(keys) else np.zeros(len(pairs), np.int64)
            known = keys[at] == pairs if len(keys) else np.zeros(len(pairs), bool)
            total = np.where(known, totals[at], 0) if len(keys) else at
            high = counts * (known & (total == best[pairs % len(best)]))
            sums = [np.append(0, np.cumsum(x)) for x in (high, counts * total, ~known)]
            n_best, count_sum = (pa.array(np.diff(x[starts]), pa.int64()) for x in sums[:2])
            rest = pa.array(sums[2][starts], pa.int32())
            lists = [pa.ListArray.from_arrays(rest, pa.array(x[~known], pa.int64())) for x in (pairs, counts)]
            yield pa.RecordBatch.from_arrays([batch.column("rid"), n_best, count_sum, *lists], names=["rid", "n_best", "count_sum", "pairs", "counts"])

    return run


def align(docs: DataFrame, a: str | None = None, b: str | None = None, frequent: int = FREQUENT) -> DataFrame:
    """A row for each row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    spark, own, tables = docs.sparkSession, aligner(a, b), Scratch()
    # the number of a row is fixed once the table is written
    linked = written(links(docs, a, b).withColumn("rid", F.monotonically_increasing_id()), "links")
    counts = tables.written(pair_counts(linked, a, b).withColumn("b", F.col("pair") % own.width), "pairs")
    best = counts.groupBy("b").agg(F.max("n").alias("most"))  # a row for each id of B at most
    highest = np.full(own.width, -1, np.int64)
    for r in best.collect():
        highest[r["b"]] = r["most"]
    exact = [[int(k * own.width + i)] for k, i in enumerate(own.identity) if i >= 0]
    identity = spark.createDataFrame(exact or [[-1]], "pair long")  # a row for each id of A at most
    top = counts.join(F.broadcast(identity), "pair", "left_anti").orderBy(F.desc("n"), "pair").limit(frequent)
    known = counts.join(F.broadcast(identity), "pair").select("pair", "n").union(top.select("pair", "n")).toPandas().sort_values("pair")
    keys, totals = known["pair"].to_numpy(np.int64), known["n"].to_numpy(np.int64)
    scored = tables.written(linked.select("rid", "pairs", "counts").mapInArrow(
        _scored(keys, totals, highest), "rid long, n_best long, count_sum long, pairs array<long>, counts array<long>"), "scored")
    rare = scored.where(F.size("pairs") > 0).select("rid", F.explode(F.arrays_zip("pairs", "counts")).alias("x")).select(
        "rid", F.col("x.pairs").alias("pair"), F.col("x.counts").alias("times"))
    totals_of = counts.join(F.broadcast(best), "b").select("pair", "n", (F.col("n") == F.col("most")).cast("long").alias("high"))
    rest = rare.join(totals_of, "pair").groupBy("rid").agg(
        F.sum(F.col("times") * F.col("high")).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum"))
    sums = written(scored.select("rid", "n_best", "count_sum").join(rest, "rid", "left").select(
        "rid", (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum")), "sums")
    tables.drop(spark)
    return linked.drop("pairs", "counts").join(sums, "rid").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
