"""Surface statistics of texts, computed for all documents of a segment at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from svgspark.llm import textkit as K

#: Byte classes: lower, upper, digit, space, newline, stop, mark, symbol, other ASCII, first byte and later bytes of other characters.
CLASSES = ("lower", "upper", "digit", "space", "newline", "stop", "mark", "symbol", "other", "lead", "tail")
_class = np.full(256, CLASSES.index("other"), np.uint8)
for _name, _bytes in (
    ("lower", range(97, 123)), ("upper", range(65, 91)), ("digit", range(48, 58)), ("space", (9, 11, 12, 13, 32)), ("newline", (10,)),
    ("stop", b".!?"), ("mark", b",;:'\"()-"), ("symbol", b"#*$%&|<>"), ("tail", range(0x80, 0xC0)), ("lead", range(0xC0, 0x100)),
):
    _class[list(_bytes)] = CLASSES.index(_name)
_HASH = K.SpanHash(seed=17)
_BREAK = np.zeros(256, bool)
_BREAK[10] = True


def per_document(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of x over the items of each document; first: where each document's items begin, and the end."""
    total = np.concatenate([[0], np.cumsum(x)])
    return total[first[1:]] - total[first[:-1]]


def owners(first: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def repeated(keys: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(item equals an earlier one of its document, item occurs twice or more in it), per item, by 64-bit key."""
    if not len(keys):
        return np.zeros(0, bool), np.zeros(0, bool)
    own = keys ^ K.mix(owner.astype(np.uint64) + K.U64(1))
    _, first, inverse, n = np.unique(own, return_index=True, return_inverse=True, return_counts=True)
    later = np.ones(len(keys), bool)
    later[first] = False
    return later, n[inverse] > 1


class Texts:
    """Words, lines and counts of the documents of one segment."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        self.data, self.offsets, self.n = data, offsets, len(offsets) - 1
        self.starts, self.ends, self.first = K.words(data, offsets)
        self.prefix = _HASH.prefix(data)
        self.hash = K.mix(_HASH.spans(self.prefix, self.starts, self.ends))
        self.owner = owners(self.first)
        self.n_words = np.diff(self.first)

    def classes(self) -> np.ndarray:
        """(document, byte class) counts."""
        at = owners(self.offsets) * len(CLASSES) + _class[self.data]
        return np.bincount(at, minlength=self.n * len(CLASSES)).reshape(self.n, len(CLASSES))

    def word_chars(self) -> np.ndarray:
        """Code points in words, for each document."""
        lead = np.concatenate([[0], np.cumsum((self.data & 0xC0) != 0x80)])
        return per_document(lead[self.ends] - lead[self.starts], self.first)

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(starts, ends, owner) of the \\n-separated lines, empty ones included."""
        cut = np.flatnonzero(_BREAK[self.data])
        doc = np.searchsorted(self.offsets, cut, "right") - 1
        starts = np.concatenate([self.offsets[:-1], cut + 1])
        owner = np.concatenate([np.arange(self.n), doc])
        order = np.lexsort([starts, owner])
        starts, owner = starts[order], owner[order]
        ends = np.append(starts[1:] - 1, self.offsets[-1])
        last = np.append(owner[1:] != owner[:-1], True)
        ends[last] = self.offsets[1:]
        return starts, ends, owner

    def duplicate_lines(self) -> tuple[np.ndarray, np.ndarray]:
        """(lines with a word that equal an earlier line, lines with a word), for each document."""
        starts, ends, owner = self.lines()
        word = np.searchsorted(self.starts, ends) > np.searchsorted(self.starts, starts)
        h = K.mix(_HASH.spans(self.prefix, starts, ends) + (ends - starts).astype(np.uint64))
        later, _ = repeated(h[word], owner[word])
        return np.bincount(owner[word], later, self.n).astype(np.int64), np.bincount(owner[word], minlength=self.n)

    def repeated_windows(self, width: int = 3) -> np.ndarray:
        """Words in windows of ``width`` words that the document holds twice or more, first ones included."""
        n = len(self.hash)
        if n < width:
            return np.zeros(self.n, np.int64)
        h = self.hash[:n - width + 1].copy()
        for k in range(1, width):
            h = K.mix(h * K.U64(0x9FB21C651E98DF25) + self.hash[k:n - width + 1 + k])
        inside = self.owner[:n - width + 1] == self.owner[width - 1:]
        _, twice = repeated(h[inside], self.owner[:n - width + 1][inside])
        at = np.flatnonzero(inside)[twice]
        step = np.zeros(n + 1, np.int64)
        np.add.at(step, at, 1)
        np.add.at(step, at + width, -1)
        return per_document((np.cumsum(step)[:n] > 0).astype(np.int64), self.first)


FEATURES = (
    "log_words", "word_length", "distinct", "repeated", "dup_lines", "log_line_words", "stops_per_line", "lines_per_word",
    *CLASSES, "lone_symbols", "long_words", "short_words", "capital_words", "symbol_words", "top_word",
)


def features(t: Texts) -> np.ndarray:
    """(document, feature) matrix; a document without words has zeros."""
    words = np.maximum(t.n_words, 1).astype(np.float64)
    size = np.maximum(np.diff(t.offsets), 1).astype(np.float64)
    counts = t.classes()
    length = (t.ends - t.starts).astype(np.float64)
    later, _ = repeated(t.hash, t.owner)
    dup, lines = t.duplicate_lines()
    lines1 = np.maximum(lines, 1).astype(np.float64)
    first_byte = _class[t.data[t.starts]] if len(t.starts) else np.zeros(0, np.uint8)
    last_byte = _class[t.data[t.ends - 1]] if len(t.starts) else np.zeros(0, np.uint8)
    symbol = CLASSES.index("symbol")
    top = np.zeros(t.n)
    if len(t.hash):
        key = t.hash ^ K.mix(t.owner.astype(np.uint64) + K.U64(1))
        _, at, n = np.unique(key, return_index=True, return_counts=True)
        np.maximum.at(top, t.owner[at], n)
    def share(flag: np.ndarray) -> np.ndarray:
        return per_document(flag.astype(np.int64), t.first) / words
    cols = [
        np.log1p(t.n_words), per_document(length, t.first) / words, 1 - per_document(later.astype(np.int64), t.first) / words,
        t.repeated_windows() / words, dup / lines1, np.log1p(t.n_words / lines1), counts[:, CLASSES.index("stop")] / lines1, lines / words,
        *(counts / size[:, None]).T,
        share((length == 1) & (first_byte == symbol)), share(length > 20), share(length <= 2), share(first_byte == CLASSES.index("upper")),
        share((length > 1) & (last_byte == symbol)), top / words,
    ]
    out = np.stack(cols, axis=1)
    out[t.n_words == 0] = 0.0
    return out


def of_segments(data: np.ndarray, offsets: np.ndarray) -> Iterator[Texts]:
    for i, j in K.segments(offsets):
        yield Texts(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
