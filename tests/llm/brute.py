"""Plain Python versions of the operators' contracts, for small tables."""

from __future__ import annotations

import bisect
import collections
import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np

WORD = re.compile("[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(x: str | bytes) -> str:
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


def components(nodes, links):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def secrets(text):
    rules = (
        ("assign", re.compile(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"""
                              r"""|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 6),
        ("access", re.compile("AKIA[A-Z0-9]+"), 0, 20),
        ("hex", re.compile("[0-9a-f]+"), 0, 24),
    )
    found = [(m.start(), k, m.end()) for k, (_, p, g, least) in enumerate(rules) for m in p.finditer(text or "") if len(m.group(g)) >= least]
    listed = [f"{rules[k][0]}:{a}:{b}" for a, k, b in sorted(found)]
    return [sum(k == r for _, k, _ in found) for r in range(3)], ",".join(listed)


def shingles(text):
    w = WORD.findall((text or "").translate(FOLD))
    return frozenset(zip(w, w[1:])) if len(w) > 1 else frozenset([tuple(w)] if w else [])


def near(rows):
    """{doc_id: (n_shingles, component, kept)} of (doc_id, text) rows with distinct ids."""
    sets = {i: shingles(t) for i, t in rows}
    links, holders = [], collections.defaultdict(list)
    for i, s in sets.items():
        both = collections.Counter()
        for x in s:
            both.update(holders[x])
            holders[x].append(i)
        links += [(i, j) for j, n in both.items() if 100 * n >= 80 * (len(s) + len(sets[j]) - n)]
    c = components(sets, links)
    return {i: (len(sets[i]), c[i], c[i] == i) for i in sets}


def repeats(texts, length=200):
    """(n_bytes, n_removed, n_spans, sha256 of the rest) of each text."""
    raw, seen = [(t or "").encode() for t in texts], collections.Counter()
    for b in raw:
        seen.update(b[i:i + length] for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = True
        edge = np.diff(np.concatenate([[0], gone.astype(int), [0]]))
        out.append((len(b), int(gone.sum()), int((edge == 1).sum()), sha(np.frombuffer(b, np.uint8)[~gone].tobytes())))
    return out


def line_key(line):
    return line.strip("\x20\x09\x0A\x0B\x0C\x0D").translate(FOLD)


def lines(rows, min_docs=10):
    """(n_lines, n_dropped, kept text) of each (doc_id, text) row; rows that repeat are documents each."""
    holders = collections.defaultdict(set)
    for k, row in enumerate(rows):
        for line in (row[1] or "").split("\n"):
            holders[line_key(line)].add(k)
    common = {k for k, d in holders.items() if len(d) >= min_docs and k}
    out = []
    for _, text in rows:
        parts = (text or "").split("\n")
        stay = [p for p in parts if line_key(p) not in common]
        out.append((len(parts), len(parts) - len(stay), "\n".join(stay)))
    return out


def counts(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    text = text or ""
    w = WORD.findall(text)
    windows = collections.Counter(zip(w, w[1:], w[2:]))
    repeat = {i + k for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeat)


def targets(sizes):
    """{source: target} from {source: size}: shared by weight, stopped at twice the size, the excess shared anew."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(order)}
    out, rest, left = {}, 1.5 * sum(sizes.values()), list(order)
    while left:
        total = sum(weight[s] for s in left)
        share = {s: rest * weight[s] / total for s in left}
        full = [s for s in left if share[s] > 2 * sizes[s]]
        if not full:
            return out | share
        for s in full:
            out[s] = 2.0 * sizes[s]
            rest -= out[s]
        left = [s for s in left if s not in full]
    return out


def vectors(rows, threshold=0.98):
    """{vec_id: (n_links, component, kept)} of (vec_id, embedding, label) rows with distinct ids."""
    fine = {}
    for i, v, label in rows:
        x = None if v is None or label is None or any(e is None for e in v) else np.array(v, np.float64)
        if x is not None and len(x) and np.isfinite(x).all() and x.any():
            fine[i] = (x, label)
    links = collections.defaultdict(set)
    ids = sorted(fine)
    for a in ids:
        for b in ids:
            (x, p), (y, q) = fine[a], fine[b]
            if a < b and p == q and len(x) == len(y) and x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= threshold:
                links[a].add(b)
                links[b].add(a)
    c = components([r[0] for r in rows], [(a, b) for a in links for b in links[a]])
    return {i: (len(links[i]), c[i], c[i] == i) for i, _, _ in rows}


def kept_words(words, found):
    gone = {i for start, length, period in found for i in range(start + period, start + length)}
    return [w for i, w in enumerate(words) if i not in gone]


def runs(words, least=24, exponent=3):
    """(start, length, period) of the maximal runs, by start, then period: every distance tried."""
    ids = {w: k for k, w in enumerate(dict.fromkeys(words))}
    x, n, out = np.array([ids[w] for w in words]), len(words), {}
    for q in range(1, n // exponent + 1):
        edge = np.diff(np.concatenate([[0], (x[:-q] == x[q:]).astype(int), [0]]))
        for i, j in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
            length = j - i + q
            if length >= max(least, exponent * q) and (i, length) not in out:  # a smaller period has the same stretch
                out[i, length] = q
    return sorted(((i, length, q) for (i, length), q in out.items()), key=lambda r: (r[0], r[2]))


def planted(doc_id, text):
    w = WORD.findall(text or "")
    if doc_id is None or not w:
        return w
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return w[:a] + [w[a + (i - a) % p] for i in range(a, n)]


def periodic(doc_id, text):
    """The row that op13's contract states, after doc_id."""
    w = planted(doc_id, text)
    found = runs(w)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else (None, None, None)
    milli = best[1] * 1000 // best[2] if found else None
    return (len(found), *best, milli, sha("".join(f"{a},{b},{c}\n" for a, b, c in found)), sha(" ".join(kept_words(w, found))))


def aligned(texts):
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, digest) of each text: every overlap looked for."""
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in printable)}

    def piece(i):
        p = second.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode()

    def spans(tokens):
        end, out = 0, []
        for i, b in tokens:
            out.append((i, end, end + len(b)))
            end += len(b)
        return out

    pairs, rows = collections.Counter(), []
    for text in texts:
        a = [(i, bytes(letters[c] for c in first.id_to_token(i))) for i in first.encode(" " + text, add_special_tokens=False).ids] if text else []
        b = [(i, piece(i)) for i in second.encode(text)] if text else []
        if not text or any(b"".join(x for _, x in t) != (" " + text).encode() for t in (a, b)):
            rows.append(None)
            continue
        a, b = spans(a), spans(b)
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups, link = [], []
        parts = [([], []) for _ in cuts]
        for side, s in enumerate((a, b)):
            for t in s:
                parts[bisect.bisect_left(cuts, t[2])][side].append(t)
        for x, y in parts:
            groups.append(",".join(str(t[0]) for t in x) + "|" + ",".join(str(t[0]) for t in y))
            link += [(p[0], q[0]) for p in x for q in y if p[1] < q[2] and q[1] < p[2]]
        pairs.update(link)
        rows.append((len(a), len(b), len(groups), link, sha(";".join(groups))))
    best = collections.Counter()
    for (_, y), n in pairs.items():
        best[y] = max(best[y], n)
    return [(0, 0, 0, 0, 0, 0, "") if r is None else
            (*r[:3], len(r[3]), sum(pairs[p] == best[p[1]] for p in r[3]), sum(pairs[p] for p in r[3]), r[4]) for r in rows]
