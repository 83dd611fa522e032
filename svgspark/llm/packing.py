"""Best-two-fit packing of token pieces into sequences of at most ``capacity`` tokens.

A document is its token ids and a closing id 0. Only documents longer than a sequence are cut, into pieces
of exactly ``capacity`` tokens; the first piece takes what is left over. Packing depends on lengths alone,
so the plan is made on the histogram of lengths, at most ``capacity`` rows however large the corpus: fill a
bin greedily with the largest piece that fits, then replace its smallest piece by the two unpacked pieces
that fill the widened gap most tightly, if they fill it better. A bin pattern is repeated as often as its
lengths last, so the plan has a few thousand rows at any size. Pieces are then ranked within their length
(salted, so that a length shared by a third of all pieces is ranked by many tasks) and the rank says which
sequence and offset a piece gets.

Token ids come from the tokenizer file's vocabulary. For a byte-level BPE file, texts are cut into its
pre-tokens with array operations, and every distinct pre-token is encoded once per worker and kept in a
bounded table; texts with characters outside ``PLAIN`` or with a special token's string go to the
``tokenizers`` library whole, as do all texts for another kind of file.

Defined results: null or empty text is the one token 0; rows that repeat are packed each; an empty table
gives an empty result; a null doc_id is a value like any other; extra columns are ignored.
"""

from __future__ import annotations

import json
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from svgspark.llm import textkit as K
from svgspark.llm.common import written

CAPACITY = 2048
SALTS = 64
#: Code points whose classes no Unicode version changes: up to the Hebrew block, and 2000-2BFF less its gaps.
PLAIN = 0x2C00
_LETTER, _NUMBER, _OTHER, _SPACE = 1, 2, 3, 4
#: Fixed value: the suffixes that the pre-token pattern splits off after an apostrophe, in its order.
SUFFIXES = ("s", "t", "re", "ve", "m", "ll", "d")
TABLE_BITS = 20
POOL = 1 << 24
#: Pre-tokens of more characters are encoded one by one: a pattern that looks ahead fails on a million of white space.
LONG = 4096


def _classes() -> np.ndarray:
    """Class of each plain code point; 0 marks those that the array form leaves to the library."""
    out = np.zeros(0x110000, np.uint8)
    for c in [*range(0x0590), *range(0x2000, PLAIN)]:
        kind = unicodedata.category(chr(c))
        out[c] = 0 if kind in ("Cn", "Cs", "Co") else {"L": _LETTER, "N": _NUMBER}.get(kind[0], _OTHER)
    for c in (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F):
        out[c] = _SPACE
    return out


def byte_letters() -> dict[str, int]:
    """The printable letter that byte-level vocabularies write for each byte: itself, or the next of U+0100.."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(0x100 + k): b for k, b in enumerate(rest)}


class Ids:
    """Token ids of whole texts by one tokenizer file; one instance lives in each Python worker."""

    def __init__(self, path: str | None) -> None:
        import public_tokenizers
        from tokenizers import Tokenizer

        path = path or public_tokenizers.path("byte_bpe_50k.json")
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
        self.plain = (
            model["type"] == "BPE" and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
            and not pre.get("add_prefix_space") and not spec.get("normalizer")
            and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix")
        )
        if not self.plain:
            return
        import tiktoken

        self.special = [t["content"].encode() for t in spec.get("added_tokens", [])]
        letters, special = byte_letters(), {t["content"] for t in spec.get("added_tokens", [])}
        ranks = {bytes(letters[c] for c in t): i for t, i in model["vocab"].items() if t not in special}
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self.bpe = tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.spaced = np.zeros(max(ranks.values()) + 1, bool)
        self.spaced[[i for t, i in ranks.items() if t[:1] == b" "]] = True
        self.classes = _classes()
        self.code = np.random.default_rng(5).integers(1, 2**64, PLAIN, dtype=np.uint64)
        self.hash = K.SpanHash(seed=5)
        self._empty()

    def _empty(self) -> None:
        self.key = np.zeros(1 << TABLE_BITS, np.uint64)
        self.at = np.zeros(1 << TABLE_BITS, np.int64)
        self.size = np.zeros(1 << TABLE_BITS, np.int64)
        self.pool, self.used = np.zeros(1 << 20, np.uint32), 0

    def of(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text, in order."""
        data, offsets = K.buffers(column)
        for i, j in K.segments(offsets, K.SEGMENT // 2):
            yield from self._segment(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])

    def _segment(self, data: np.ndarray, off: np.ndarray) -> Iterator[np.ndarray]:
        if not self.plain:
            for a, b in zip(off[:-1], off[1:]):
                yield self._whole(data[a:b])
            return
        raw = data.tobytes()
        points = np.frombuffer(raw.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        kinds = self.classes[points]
        lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        cp = lead[off] if lead[-1] == len(points) else None
        odd = np.zeros(len(off) - 1, bool)
        if cp is None:
            odd[:] = True
        else:
            bad = np.concatenate([[0], np.cumsum(kinds == 0)])
            odd = bad[cp[1:]] > bad[cp[:-1]]
        for s in self.special:
            at = raw.find(s)
            while at >= 0:
                odd[np.searchsorted(off, at, "right") - 1] = True
                at = raw.find(s, at + 1)
        if odd.all():
            for a, b in zip(off[:-1], off[1:]):
                yield self._whole(data[a:b])
            return
        kinds = np.where(kinds == 0, _OTHER, kinds)
        points = np.where(points < PLAIN, points, 0)
        ids, ends = self._plain(points, kinds, cp)
        for k in range(len(odd)):
            yield self._whole(data[off[k]:off[k + 1]]) if odd[k] else ids[ends[k]:ends[k + 1]]

    def _whole(self, data: np.ndarray) -> np.ndarray:
        text = data.tobytes().decode("utf-8", "replace")
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)

    def _plain(self, points: np.ndarray, kinds: np.ndarray, cp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts of the segment, where each text's ids start)."""
        n = len(points)
        if n == 0:
            return np.zeros(0, np.uint32), np.zeros(len(cp), np.int64)
        if self.used > POOL:
            self._empty()
        starts = self._pretokens(points, kinds, cp)
        ends = np.append(starts[1:], n)
        self.hash._grow(n)
        prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(self.code[points] * self.hash.power[:n], out=prefix[1:])
        h = K.mix(self.hash.spans(prefix, starts, ends) + (ends - starts).astype(np.uint64))
        h |= K.U64(1)
        slot = (h >> K.U64(64 - TABLE_BITS)).astype(np.int64)
        at, size = self.at[slot], self.size[slot]
        miss = np.flatnonzero(self.key[slot] != h)
        if len(miss):
            new, first, inverse = np.unique(h[miss], return_index=True, return_inverse=True)
            where, count = self._learn(new, points, starts[miss[first]], ends[miss[first]], kinds)
            at[miss], size[miss] = where[inverse], count[inverse]
        total = np.concatenate([[0], np.cumsum(size)])
        ids = self.pool[np.repeat(at - total[:-1], size) + np.arange(total[-1])]
        return ids, total[np.searchsorted(starts, cp)]

    def _pretokens(self, points: np.ndarray, kinds: np.ndarray, cp: np.ndarray) -> np.ndarray:
        """Starts of the pre-tokens; each ends where the next one starts."""
        n = len(points)
        text = np.zeros(n + 1, bool)
        text[cp] = True
        start = np.ones(n, bool)
        start[1:] = kinds[1:] != kinds[:-1]
        start |= text[:n]
        word = np.flatnonzero(start & (kinds != _SPACE) & ~text[:n])
        after = word[kinds[word - 1] == _SPACE]
        start[after - 1] = True
        start[after[points[after - 1] == 0x20]] = False
        for i in np.flatnonzero((points[:-1] == 0x27) & start[:-1] & (kinds[1:] == _LETTER) & ~text[1:n]):
            for s in SUFFIXES:
                e = i + 1 + len(s)
                if e <= n and not text[i + 1:e].any() and "".join(map(chr, points[i + 1:e])) == s:
                    start[i + 1] = False
                    if e < n:
                        start[e] = True
                    break
        return np.flatnonzero(start)

    def _learn(self, new: np.ndarray, points: np.ndarray, starts: np.ndarray, ends: np.ndarray, kinds: np.ndarray):
        """Encodes pre-tokens met for the first time; (place in the pool, ids) of each."""
        size = np.zeros(len(new), np.int64)
        at = np.zeros(len(new), np.int64)
        spaced = (points[starts] == 0x20) & (ends - starts > 1) & (ends - starts <= LONG) & (kinds[np.minimum(starts + 1, len(kinds) - 1)] == _LETTER)
        some = np.flatnonzero(spaced)
        parts: list[np.ndarray] = []
        done = 0
        if len(some):
            lens = ends[some] - starts[some]
            edge = np.cumsum(lens) - lens
            line = points[np.repeat(starts[some] - edge, lens) + np.arange(lens.sum())]
            # pre-tokens " word" side by side are the same pre-tokens, and only their first ids start with a space
            ids = np.array(self.bpe.encode_ordinary(line.astype("<u4").tobytes().decode("utf-32-le")), np.uint32)
            first = np.flatnonzero(self.spaced[ids])
            at[some], size[some] = first, np.diff(np.append(first, len(ids)))
            parts.append(ids)
            done = len(ids)
        for k in np.flatnonzero(~spaced):
            token = points[starts[k]:ends[k]].astype("<u4").tobytes().decode("utf-32-le")
            ids = np.array(self.bpe._encode_single_piece(token.encode()), np.uint32)
            at[k], size[k] = done, len(ids)
            parts.append(ids)
            done += len(ids)
        while self.used + done > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(len(self.pool), np.uint32)])
        self.pool[self.used:self.used + done] = np.concatenate(parts)
        at += self.used
        self.used += done
        slot = (new >> K.U64(64 - TABLE_BITS)).astype(np.int64)
        self.key[slot], self.at[slot], self.size[slot] = new, at, size
        return at, size


_IDS: dict[str | None, Ids] = {}


def _pieces(path: str | None, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _IDS:
            _IDS[path] = Ids(path)
        for batch in batches:
            doc, piece, start, length, crc = [], [], [], [], []
            for k, ids in enumerate(_IDS[path].of(batch.column(1))):
                ids = np.append(ids, 0).astype("<u4")
                cuts = np.arange(len(ids), 0, -capacity)[::-1]
                a = 0
                for p, b in enumerate(cuts.tolist()):
                    doc.append(k)
                    piece.append(p)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(ids[a:b].tobytes()))
                    a = b
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(doc, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[int]]]:
    """(times, lengths of the bin, largest first) for the given number of pieces of each length."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    out: list[tuple[int, list[int]]] = []
    sizes = np.arange(capacity + 1)
    while left.any():
        have = left.copy()
        below = np.maximum.accumulate(np.where(have > 0, sizes, 0))
        bin_, gap = [], capacity
        while gap and (take := int(_floor(below, have, gap))):
            bin_.append(take)
            have[take] -= 1
            gap -= take
        if len(bin_) > 1:
            least = bin_[-1]
            wide = gap + least
            floor = np.maximum.accumulate(np.where(have > 0, sizes, 0))
            a = sizes[1:wide][have[1:wide] > 0]
            b = floor[wide - a]
            alone = (b == a) & (have[a] < 2)
            b[alone] = floor[np.maximum(a[alone] - 1, 0)]
            both = np.where(b > 0, a + b, 0)
            if len(both) and both.max() > least:
                k = int(both.argmax())
                bin_ = bin_[:-1] + sorted([int(a[k]), int(b[k])], reverse=True)
        used, n = np.unique(bin_, return_counts=True)
        times = int((left[used] // n).min())
        left[used] -= times * n
        out.append((times, bin_))
    return out


def _floor(below: np.ndarray, have: np.ndarray, gap: int) -> int:
    """The largest length up to ``gap`` that is still there (``below`` may count lengths used up since)."""
    x = int(below[gap])
    while x and have[x] <= 0:
        x = int(below[x - 1])
    return x


def placements(bins: list[tuple[int, list[int]]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, offset), sorted: ranks from there on go to the following sequences."""
    rows, rank, base = [], {}, 0
    for times, lengths in bins:
        offset = 0
        for x in lengths:
            rows.append((x, rank.get(x, 0), base, offset))
            rank[x] = rank.get(x, 0) + times
            offset += x
        base += times
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def _place(rows: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, first = np.unique(rows[:, 0], return_index=True)
        last = np.append(first[1:], len(rows))
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            at = np.zeros(len(length), np.int64)
            for x in np.unique(length):
                k = int(np.searchsorted(lengths, x))
                own = length == x
                at[own] = first[k] + np.searchsorted(rows[first[k]:last[k], 1], rank[own], "right") - 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(rows[at, 2] + rank - rows[at, 1]), pa.array(rows[at, 3])],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """A row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = written(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
            _pieces(tokenizer, capacity), "doc_id long, piece int, start long, length long, ids_crc32 long"), "pieces")
    pieces = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(SALTS)).cast("int"))
    cells = written(pieces.groupBy("length", "salt").count(), "lengths")  # at most capacity * SALTS rows
    histogram = {r["length"]: r["n"] for r in cells.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    rows = placements(plan(histogram, capacity))
    before = cells.select("length", "salt", (F.sum("count").over(
        Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1))).alias("before"))
    inside = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32"))
    ranked = pieces.withColumn("inside", inside).join(before, ["length", "salt"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.coalesce("before", F.lit(0)) + F.col("inside") - 1).alias("rank"))
    return ranked.mapInArrow(
        _place(rows), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
