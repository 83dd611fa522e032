"""Secret scan over a trigram inverted index.

Each rule is a regular expression. From its parse tree a Boolean trigram query is derived: every literal run
the match must contain gives the trigrams it is made of, alternatives are OR-ed, parts in sequence AND-ed. The
texts of an Arrow batch form an index segment: one pass over the bytes finds where the queries' trigrams occur
(A-Z lower-cased) and leaves a postings list of documents for each trigram. Queries intersect and unite
postings; only the candidates are verified with the expression itself. Rules without a mandatory trigram scan
every text. Postings never cross a segment, so the index needs no shuffle, its size is bounded by the batch,
and a lost task rebuilds its own segments only.

Base rules, leftmost and non-overlapping within each rule: assign (a key word, ``:`` or ``=``, a value of 6
characters or more), access (AKIA..., 20 or more), hex (24 or more); matches that are too short are dropped.
Further rules add the spans of other well-known credential formats. A span is kind:start:end in code points.

Defined results: null or empty text has no spans; texts of any length are searched whole; rows that repeat are
searched each; an empty table gives an empty result; extra columns are ignored; a null doc_id passes through.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import product
from re import _constants as C
from re import _parser as parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from svgspark.llm import textkit as K


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    group: int = 0
    least: int = 0  # characters of the group that a match must have


#: The base rules, in the order in which spans that start together are listed.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
#: Further formats, after the base rules.
MORE = (
    Rule("github", r"(?:ghp|gho|ghu|ghs|ghr)_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("stripe", r"(?:sk|rk)_live_[0-9A-Za-z]{16,}"),
    # from the left end of a run of its letters only: a run of "eyJ" without a dot is read once
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
)

# Queries: True (no constraint), a trigram, ("and", q, ...) or ("or", q, ...).
FEW = 64  # strings a run may stand for before it is cut
CHOICES = 8  # letters a class may have to count as alternatives


def _and(parts: list) -> object:
    parts = list(dict.fromkeys(p for p in parts if p is not True))
    return True if not parts else parts[0] if len(parts) == 1 else ("and", *parts)


def _or(parts: list) -> object:
    parts = list(dict.fromkeys(parts))
    return True if True in parts else parts[0] if len(parts) == 1 else ("or", *parts)


def _of_string(s: str) -> object:
    raw = s.encode()
    return _and([raw[i:i + 3] for i in range(len(raw) - 2)])


def _letters(items: list) -> set[str] | None:
    """The lower-cased letters of a small character class; None for others."""
    out: set[str] = set()
    for kind, value in items:
        if kind is C.LITERAL:
            out.add(chr(value).lower())
        elif kind is C.RANGE and value[1] - value[0] < CHOICES:
            out |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return out if len(out) <= CHOICES else None


def _walk(items: list) -> tuple[set[str] | None, object]:
    """(all strings the sequence can be, or None if they are not few; a query every match satisfies)."""
    run: set[str] | None = {""}
    whole, query = True, []

    def close() -> None:
        nonlocal run
        query.append(_or([_of_string(s) for s in run]))
        run = {""}

    for kind, value in items:
        more, need = None, True
        if kind is C.LITERAL:
            more = {chr(value).lower()}
        elif kind is C.IN:
            more = _letters(value)
        elif kind is C.SUBPATTERN:
            more, need = _walk(value[3])
        elif kind is C.BRANCH:
            sides = [_walk(side) for side in value[1]]
            more = None if any(s is None for s, _ in sides) else set().union(*(s for s, _ in sides))
            need = _or([q for _, q in sides])
        elif kind in (C.MAX_REPEAT, C.MIN_REPEAT):
            low, high, body = value
            own, inner = _walk(body)
            if (low, high) == (0, 1) and own is not None:
                more = own | {""}
            elif own is not None and low == high and low <= 8 and len(own) ** low <= FEW:
                more = {"".join(p) for p in product(own, repeat=low)}
            elif low > 0:
                need = inner
        elif kind is C.AT:
            more = {""}
        if more is not None and len(run) * len(more) <= FEW:
            run = {a + b for a in run for b in more}
        else:
            close()
            query.append(need if more is None else _and([need, _or([_of_string(s) for s in more])]))
            whole = False
    if whole:
        return run, _or([_of_string(s) for s in run])
    close()
    return None, _and(query)


def trigram_query(pattern: str) -> object:
    """The Boolean trigram query of a pattern over lower-cased text; True if it has no mandatory trigram."""
    return _walk(list(parser.parse(pattern, re.ASCII)))[1]


def trigrams(query: object) -> set[bytes]:
    if query is True:
        return set()
    return {query} if isinstance(query, bytes) else set().union(*(trigrams(q) for q in query[1:]))


class Segment:
    """Postings of the wanted trigrams over the texts of one Arrow batch."""

    def __init__(self, wanted: list[bytes]) -> None:
        self.wanted = wanted
        self.number = np.zeros(1 << 24, np.uint8)
        if len(wanted) > 255:
            raise ValueError("more than 255 distinct trigrams: split the rules")
        for k, t in enumerate(wanted):
            self.number[t[0] << 16 | t[1] << 8 | t[2]] = k + 1
        self.lower = np.arange(256, dtype=np.uint32)
        self.lower[65:91] += 32

    def postings(self, data: np.ndarray, offsets: np.ndarray) -> dict[bytes, np.ndarray]:
        """Sorted documents of each trigram."""
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for i, j in K.segments(offsets):
            low = self.lower[data[offsets[i]:offsets[j]]]
            if len(low) < 3:
                continue
            k = self.number[(low[:-2] << np.uint32(16)) | (low[1:-1] << np.uint32(8)) | low[2:]]
            at = np.flatnonzero(k)
            doc = np.searchsorted(offsets, at + offsets[i], "right") - 1
            inside = at + offsets[i] + 3 <= offsets[doc + 1]
            found.append((k[at[inside]], doc[inside]))
        k = np.concatenate([f[0] for f in found]) if found else np.zeros(0, np.uint8)
        doc = np.concatenate([f[1] for f in found]) if found else np.zeros(0, np.int64)
        return {t: np.unique(doc[k == n + 1]) for n, t in enumerate(self.wanted)}


def candidates(query: object, postings: dict[bytes, np.ndarray], n: int) -> np.ndarray:
    """The documents that satisfy a query."""
    if query is True:
        return np.arange(n)
    if isinstance(query, bytes):
        return postings[query]
    join = np.intersect1d if query[0] == "and" else np.union1d
    return reduce(join, [candidates(q, postings, n) for q in query[1:]])


def _scan(rules: tuple[Rule, ...], base: int):
    queries = [trigram_query(r.pattern) for r in rules]
    wanted = sorted(set().union(*map(trigrams, queries)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment, compiled = Segment(wanted), [re.compile(r.pattern, re.ASCII) for r in rules]
        for batch in batches:
            data, offsets = K.buffers(batch.column(1))
            n = batch.num_rows
            postings = segment.postings(data, offsets)
            wants: list[list[int]] = [[] for _ in range(n)]
            for r, q in enumerate(queries):
                for d in candidates(q, postings, n).tolist():
                    wants[d].append(r)
            counts = np.zeros((n, base), np.int64)
            spans: list[list[tuple[int, int, int]]] = []
            for d in range(n):
                text = data[offsets[d]:offsets[d + 1]].tobytes().decode("utf-8", "replace") if wants[d] else ""
                own = []
                for r in wants[d]:
                    rule = rules[r]
                    for m in compiled[r].finditer(text):
                        if m.end(rule.group) - m.start(rule.group) >= rule.least:
                            own.append((m.start(), r, m.end()))
                            if r < base:
                                counts[d, r] += 1
                spans.append(sorted(own))
            listed = [[f"{rules[r].kind}:{a}:{b}" for a, r, b in s] for s in spans]
            firm = [",".join(x for x, (_, r, _) in zip(names, s) if r < base) for names, s in zip(listed, spans)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(counts[:, k]) for k in range(base)),
                 pa.array([hashlib.sha256(x.encode()).hexdigest() for x in firm]), pa.array([",".join(x) for x in listed], pa.string())],
                names=["doc_id", *(f"n_{r.kind}" for r in rules[:base]), "base_sha256", "spans"])

    return run


def scan(docs: DataFrame, more: tuple[Rule, ...] = MORE) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans of each document."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _scan(BASE + more, len(BASE)), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
