"""Periodic runs of words: maximal repetitions, by longest common extensions on suffix trees.

A run is a maximal stretch of words with smallest period q, at least ``least`` words and ``exponent`` periods long. Every
run starts, once in each period, a Lyndon word that is the longest at its place for the order of words or for the
reverse order; so the longest Lyndon words at all places, two for each word, are all candidates there are. They follow
from the order of the suffixes: the longest Lyndon word at i ends where the next smaller suffix starts. A candidate is
extended to the right by the longest common extension of its two ends and to the left by that in the reversed words.
Extensions are answered in constant time: Ukkonen's suffix tree of the words and of their reversal, its Euler tour, and
a sparse table of minima over the tour, in which the lowest common ancestor of two leaves is the least depth between
them.

Trees are built for the stretches of a document that can hold a run: a run repeats each of its windows of ``WINDOW``
words within a third of the document, so stretches covered by no such windows hold none, and a run never leaves its
stretch. Windows are compared by 64-bit hashes, which only decide where trees are built; the trees compare words. All
of it is one narrow pass in Arrow batches, a segment of documents at a time.

Defined results: null and empty texts and texts without words have no runs and collapse to the empty text; rows that
repeat are rows each; a null doc_id is a value like any other; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from svgspark.llm import textkit as K
from svgspark.llm.common import WORD

LEAST = 24
EXPONENT = 3
#: Words of a window; every run has windows that repeat as long as LEAST - LEAST // EXPONENT is not below it.
WINDOW = 16
#: Times that stretches are narrowed before trees are built for what is left, which may then be more than needed.
ROUNDS = 8
SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


class SuffixTree:
    """Ukkonen's suffix tree of ``s`` (whole numbers from 1) and a closing 0, with its Euler tour.

    first[i]: place of the leaf of suffix i in the tour; low: for each place the depth, in words, of its node's parent.
    """

    def __init__(self, s: list[int]) -> None:
        self.text = text = [*s, 0]
        self.n = n = len(text)
        base = max(text) + 1
        begin, end, link = [0, 0], [0, 0], [0, 0]  # node 0 is above the root, node 1 is the root
        child: dict[int, int] = {}
        link[1] = 0
        node, at, length = 1, 0, 0  # the active point: ``length`` words from text[at] below ``node``
        todo = 0
        for i, c in enumerate(text):
            todo += 1
            last = 0
            while todo:
                if not length:
                    at = i
                key = node * base + text[at]
                edge = child.get(key)
                if edge is None:
                    begin.append(i)
                    end.append(n)
                    link.append(1)
                    child[key] = len(begin) - 1
                    if last:
                        link[last] = node
                        last = 0
                else:
                    size = (end[edge] if end[edge] <= i else i + 1) - begin[edge]
                    if length >= size:
                        node, at, length = edge, at + size, length - size
                        continue
                    if text[begin[edge] + length] == c:
                        if last and node != 1:
                            link[last] = node
                        length += 1
                        break
                    split = len(begin)
                    begin += (begin[edge], i)
                    end += (begin[edge] + length, n)
                    link += (1, 1)
                    child[key] = split
                    child[split * base + c] = split + 1
                    begin[edge] += length
                    child[split * base + text[begin[edge]]] = edge
                    if last:
                        link[last] = split
                    last = split
                todo -= 1
                if node == 1 and length:
                    length -= 1
                    at = i - todo + 1
                elif node != 1:
                    node = link[node]
        keys = np.fromiter(child.keys(), np.int64, len(child))
        nodes = np.fromiter(child.values(), np.int64, len(child))
        self.parent, self.symbol, self.node = keys // base, keys % base, nodes
        self.edge = np.array(end, np.int64) - np.array(begin, np.int64)
        self.size = len(begin)

    def tour(self, reverse: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(place of each suffix's leaf, depth of the parent at each place); the closing 0 is least in both orders."""
        symbol = np.where(self.symbol > 0, -self.symbol, np.iinfo(np.int64).min) if reverse else self.symbol
        order = np.lexsort((-symbol, self.parent))  # children are stacked from the largest
        parents, nodes = self.parent[order], self.node[order].tolist()
        ids = np.arange(self.size)
        lo, hi = np.searchsorted(parents, ids, "left").tolist(), np.searchsorted(parents, ids, "right").tolist()
        edge, n = self.edge.tolist(), self.n
        first, low = [0] * n, []
        stack, above = nodes[lo[1]:hi[1]], [0] * self.size
        while stack:
            v = stack.pop()
            up = above[v]
            down = up + edge[v]
            low.append(up)
            a, b = lo[v], hi[v]
            if a == b:
                first[n - down] = len(low) - 1
            else:
                for u in nodes[a:b]:
                    above[u] = down
                stack += nodes[a:b]
        return np.array(first, np.int64), np.array(low, np.int32)


class Extensions:
    """Longest common extensions of pairs of suffixes, in constant time each."""

    def __init__(self, first: np.ndarray, low: np.ndarray) -> None:
        self.first = first
        self.levels = [low]
        while 2 << (len(self.levels) - 1) <= len(low):
            x, step = self.levels[-1], 1 << (len(self.levels) - 1)
            self.levels.append(np.minimum(x[:-step], x[step:]))

    def of(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common words of the suffixes at i and j, which differ."""
        a, b = self.first[i], self.first[j]
        a, b = np.minimum(a, b) + 1, np.maximum(a, b)
        level = np.frexp((b - a + 1).astype(np.float64))[1] - 1
        out = np.empty(len(a), np.int64)
        for k in np.unique(level):
            own = level == k
            x = self.levels[k]
            out[own] = np.minimum(x[a[own]], x[b[own] - (1 << int(k)) + 1])
        return out


def lyndon_ends(rank: np.ndarray) -> np.ndarray:
    """End of the longest Lyndon word at each place: the next place whose suffix ranks lower."""
    rank, n = rank.tolist(), len(rank)
    out, stack = [n] * n, []
    for i in range(n):
        r = rank[i]
        while stack and rank[stack[-1]] > r:
            out[stack.pop()] = i
        stack.append(i)
    return np.array(out, np.int64)


def runs(s: list[int], least: int = LEAST, exponent: int = EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of ``s``, by start, then period."""
    n = len(s)
    if n < least:
        return []
    tree = SuffixTree(s)
    orders = [tree.tour(), tree.tour(reverse=True)]
    back = SuffixTree(s[::-1])
    right, left = Extensions(*orders[0]), Extensions(*back.tour())
    starts = np.arange(n)
    found = []
    for first, _ in orders:
        period = lyndon_ends(first[:n]) - starts
        i = starts[(period * exponent <= n) & (starts + period < n)]
        p = period[i]
        ahead = right.of(i, i + p)
        behind = np.zeros(len(i), np.int64)
        inner = i > 0
        behind[inner] = left.of(n - i[inner], n - i[inner] - p[inner])
        length = behind + p + ahead
        good = (length >= least) & (length >= exponent * p)
        found.append(np.stack([i - behind, length, p], 1)[good])
    rows = np.unique(np.concatenate(found), axis=0)
    return [tuple(r) for r in rows[np.lexsort((rows[:, 2], rows[:, 0]))].tolist()]


def stretches(h: np.ndarray, first: np.ndarray, window: int = WINDOW, least: int = LEAST, exponent: int = EXPONENT) -> list[tuple[int, int, int]]:
    """(document, first word, end) of what can hold a run, from the word hashes of documents that start at ``first``."""
    n = len(h) - window + 1
    if n <= 0:
        return []
    sizes = np.diff(np.append(first, len(h)))
    doc = np.repeat(np.arange(len(first)), sizes)
    x = h[:n]
    for k in range(1, window):
        x = K.followed(x, h[k:k + n])
    starts = np.flatnonzero(doc[:n] == doc[window - 1:])
    if not len(starts):
        return []
    code = K.mix(x[starts] + doc[starts].astype(np.uint64) * K.U64(0x9E3779B97F4A7C15))
    order = np.argsort(code, kind="stable")
    same = code[order[1:]] == code[order[:-1]]
    a, b = starts[order[:-1]][same], starts[order[1:]][same]
    near = exponent * (b - a) <= sizes[doc[a]]
    a, b = a[near], b[near]
    rounds = 0
    while len(a):
        cover = sum(np.bincount(p, minlength=len(h) + 1) - np.bincount(p + window, minlength=len(h) + 1) for p in (a, b))
        inside = np.cumsum(cover[:-1]) > 0
        edge = np.diff(np.concatenate([[0], inside.astype(np.int8), [0]]))
        begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        # stretches of neighbouring documents meet where one ends and the next begins
        cuts = first[(first > 0) & (first < len(h))]
        cuts = cuts[inside[cuts] & inside[cuts - 1]]
        begin, end = np.union1d(begin, cuts), np.union1d(end, cuts)
        k = np.searchsorted(begin, a, "right") - 1
        apart = (b >= end[k]) | (exponent * (b - a) > end[k] - begin[k])
        rounds += 1
        if rounds == ROUNDS or not apart.any():
            long = end - begin >= least
            return [(int(doc[x]), int(x - first[doc[x]]), int(y - first[doc[x]])) for x, y in zip(begin[long], end[long])]
        a, b = a[~apart], b[~apart]  # windows that repeat in another stretch, or too far off, belong to no run
    return []


def _found(least: int, exponent: int):
    window = max(1, min(WINDOW, least - least // exponent))
    words_of = K.SpanHash(seed=13)

    def segment(data: np.ndarray, off: np.ndarray) -> Iterator[tuple[int, list, str]]:
        starts, ends, first = K.words(data, off)
        raw = data.tobytes()
        h = K.mix(words_of.spans(words_of.prefix(data), starts, ends) + (ends - starts).astype(np.uint64))
        own: dict[int, list[tuple[int, int]]] = {}
        for d, a, b in stretches(h, first[:-1], window, least, exponent):
            own.setdefault(d, []).append((a, b))
        for d in range(len(off) - 1):
            words = raw[off[d]:off[d + 1]].split()  # bytes split at the white space that ends words, and at no other
            n_words = len(words)
            found = []
            for a, b in own.get(d, ()):
                ids: dict[bytes, int] = {}
                s = [ids.setdefault(x, len(ids) + 1) for x in words[a:b]]
                found += [(a + start, length, period) for start, length, period in runs(s, least, exponent)]
            if found:
                gone = np.zeros(len(words) + 1, np.int64)
                for start, length, period in found:
                    gone[start + period] += 1
                    gone[start + length] -= 1
                words = [x for x, k in zip(words, np.cumsum(gone[:-1]).tolist()) if not k]
            yield n_words, sorted(found, key=lambda r: (r[0], r[2])), b" ".join(words).decode("utf-8", "replace")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            data, offsets = K.buffers(batch.column(1))
            for i, j in K.segments(offsets):
                rows = list(segment(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array([r[0] for r in rows], pa.int64()),
                     pa.array([[{"start": a, "length": b, "period": c} for a, b, c in r[1]] for r in rows], kind),
                     pa.array([r[2] for r in rows], pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])

    return run


def periodic_runs(docs: DataFrame, least: int = LEAST, exponent: int = EXPONENT) -> DataFrame:
    """(doc_id, n_words, runs, collapsed): the runs of each text by start, then period, and the words left, joined by
    one space, when each run keeps its first period only."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_found(least, exponent), SCHEMA)


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text) of ``docs`` in which every tenth document by hash is made periodic, as the contract states."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    some = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("words"), g.alias("g"))
    n = F.size("words").cast("long")
    a = F.col("g") % n
    p = 1 + F.floor((n - a) / (3 + F.col("g") % 8))
    periodic = F.concat(F.slice("words", F.lit(1), a.cast("int")), F.transform(
        F.sequence(F.lit(0).cast("long"), n - a - 1), lambda k: F.get("words", (a + k % p).cast("int"))))
    return some.select("doc_id", F.when(n > 0, F.array_join(periodic, " ")).otherwise(F.col("text")).alias("text"))


def _better(x: Column, y: Column) -> Column:
    """Whether the run x comes before y: larger exact exponent, then smaller start, then smaller period."""
    one, other = x["length"] * y["period"], y["length"] * x["period"]
    return (one > other) | ((one == other) & ((x["start"] < y["start"]) | ((x["start"] == y["start"]) & (x["period"] < y["period"]))))


def op13(docs: DataFrame) -> DataFrame:
    """Digest columns of the contract, over the documents with planted periods."""
    out = periodic_runs(planted(docs))
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda s, x: F.when(_better(x, s), x).otherwise(s))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    out = out.withColumn("best", best)
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"),
        F.col("best.period").alias("period"), F.floor(F.col("best.length") * 1000 / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
