"""Differencing, tokenizer alignment and periodic runs against plain Python."""

import collections
import os
import random
import sys
import zlib

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402
from test_operators import frame, texts  # noqa: E402

from svgspark.llm import alignment, packing, periodic, sharding  # noqa: E402

#: White space and letters in runs of two million characters, which recursive patterns do not survive.
ENDLESS = [" " * 2_000_000, "\t" * 2_000_000, "\n" * 2_000_000, "a" * 2_000_000, "x " * 30 + " " * 2_000_000 + "y"]


@pytest.fixture(scope="module")
def rows():
    """The awkward rows, two of them again, a row without an id, and documents with long periods."""
    rng = random.Random(11)
    base = texts()
    more = [" ".join(rng.choice("abcdef") for _ in range(n)) for n in (23, 24, 300, 700)]
    more += [" ".join(["k"] * 40), "\n".join(f"u{i % 9}" for i in range(100)), " ".join(f"v{i % 50}" for i in range(149)),
             " ".join(f"v{i % 50}" for i in range(150)), " ".join(["p", "q", "p", "q", "r"] * 12 + ["p", "q"] * 20)]
    out = base + [(len(base) + k, t, "a") for k, t in enumerate(more)]
    return out + [out[0], out[3], (None, "no id but a text " * 12, "b")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return frame(spark, rows)


def plain_difference(sizes, parts):
    """The sums of Karmarkar-Karp differencing, stated with sorted lists."""
    left = [[s] + [0] * (parts - 1) for s in sizes]
    while len(left) > 1:
        left.sort(key=lambda v: v[0] - v[-1], reverse=True)
        both = sorted((x + y for x, y in zip(left[0], reversed(left[1]))), reverse=True)
        left = [both, *left[2:]]
    return left[0] if left else [0] * parts


def test_differencing_is_the_plain_one():
    rng = random.Random(4)
    for parts in (2, 3, 16):
        for n in (0, 1, 5, 60, 200):
            sizes = rng.sample(range(1, 10**7), n)  # distinct, so that ties cannot part the two
            sums = [0] * parts
            for s, p in zip(sizes, sharding.difference(sizes, parts)):
                sums[p] += s
            assert sorted(sums, reverse=True) == sorted(plain_difference(sizes, parts), reverse=True)
    assert sharding.difference([8, 7, 6, 5, 4], 2).count(0) in (2, 3)


@pytest.mark.parametrize("shards, cell, last", [(16, 4096, 32768), (2, 32, 128)])
def test_sharding(spark, rows, shards, cell, last):
    rows = rows + [(1000 + i, f"short text {i % 150}", "a") for i in range(200)]
    docs = frame(spark, rows)
    got = sharding.assign(docs, shards, cell, last).collect()
    want = collections.Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in rows)
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    slots = collections.defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert set(slots) <= set(range(shards)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    shard_of = {}
    for r in got:  # equal texts together
        assert shard_of.setdefault((r.size, r.text_crc32), r.shard) == r.shard
    assert collections.Counter(got) == collections.Counter(sharding.assign(docs, shards, cell, last).collect())
    whole = sharding.sharded(docs, shards, cell, last).collect()
    assert collections.Counter((r.doc_id, r.text) for r in whole) == collections.Counter((i, t) for i, t, _ in rows)
    assert all(r._shard == shard_of[len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())] and r.size == "x" for r in whole)


def test_shards_are_near_equal_at_any_level(spark):
    """One level or three, and a group larger than a fair shard: the rest is shared among the others."""
    rng = random.Random(9)
    rows = [(i, "y" * int(rng.paretovariate(1.3) * 20) + str(i), "a") for i in range(4000)]
    total = sum(len(t) + 1 for _, t, _ in rows)
    for last in (8000, 1024):
        size = collections.Counter()
        for r in sharding.assign(frame(spark, rows), cell=256, last=last).collect():
            size[r.shard] += r.size
        largest = max(max(len(t) + 1 for _, t, _ in rows), total / 16)
        assert len(size) == 16 and max(size.values()) <= largest * 1.002
    hot = rows + [(5000 + i, "z" * 99, "a") for i in range(total // 100)]  # half of all bytes in one group
    size = collections.Counter()
    for r in sharding.assign(frame(spark, hot), cell=256, last=1024).collect():
        size[r.shard] += r.size
    rest = sorted(size.values())[:15]
    assert rest[-1] - rest[0] <= 0.01 * rest[-1]


def test_levels_that_cannot_shrink_are_refused(docs):
    with pytest.raises(ValueError):
        sharding.assign(docs, 16, 32, 2000)


def test_op11_columns(docs):
    out = sharding.op11(docs)
    assert out.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    assert sharding.op11(docs.where("false")).collect() == []


def test_alignment(docs, rows):
    want = collections.Counter((i, *w) for (i, _, _), w in zip(rows, brute.aligned([t for _, t, _ in rows])))
    for frequent in (65_536, 0, 20):
        got = alignment.align(docs, frequent=frequent).collect()
        assert collections.Counter(tuple(r) for r in got) == want
    assert sum(r.n_links for r in got) > 1000
    assert alignment.align(docs.where("false")).collect() == []


def test_pieces_by_unit_are_those_of_the_whole_text():
    rng = random.Random(2)
    pieces = alignment.Pieces(None)
    assert pieces.units
    some = ["a", "  a", "a  ", " ", " \n", "\n\n a", "x\ty  z\r\n", "é😀ſ ▁", "a▁b", "\x00 b", "<s> </s>", "日本 語", "ﬁ Å"]
    some += ["".join(rng.choice(" \nabcdéß.,<0x4") for _ in range(60)) for _ in range(200)]
    for t in some:
        assert pieces.ids(t).tolist() == pieces.model.encode(t), t


def test_periodic_core():
    rng = random.Random(5)
    for _ in range(400):
        s = [rng.randint(1, rng.choice([1, 2, 3, 5])) for _ in range(rng.randint(1, 120))]
        a, p = rng.randrange(len(s)), rng.randint(1, 12)
        for i in range(a + p, min(len(s), a + rng.randint(10, 90))):
            s[i] = s[i - p]
        for least, exponent in ((2, 2), (6, 3), (24, 3)):
            assert periodic.runs(s, least, exponent) == brute.runs(s, least, exponent), s


def test_extensions():
    rng = random.Random(6)
    s = [rng.randint(1, 2) for _ in range(90)]
    i, j = zip(*[(a, b) for a in range(90) for b in range(90) if a != b])
    import numpy as np

    got = periodic.Extensions(*periodic.SuffixTree(s).tour()).of(np.array(i), np.array(j)).tolist()
    for a, b, n in zip(i, j, got):
        assert s[a:a + n] == s[b:b + n] and (max(a, b) + n == 90 or s[a + n] != s[b + n])


def test_periodic(docs, rows):
    got = collections.Counter(tuple(r) for r in periodic.op13(docs).collect())
    assert got == collections.Counter((i, *brute.periodic(i, t)) for i, t, _ in rows)
    assert sum(r[1] > 0 for r in got) >= 12
    out = {r.doc_id: r for r in periodic.periodic_runs(docs).collect()}
    for i, t, _ in rows:
        w = brute.WORD.findall(t or "")
        assert [tuple(r) for r in out[i].runs] == brute.runs(w) and out[i].collapsed == " ".join(brute.kept_words(w, brute.runs(w)))
    assert periodic.op13(docs.where("false")).collect() == []


def test_runs_of_two_million_characters(spark):
    """No recursion and no quadratic time on a single endless pre-token or word."""
    docs = frame(spark, [(k, t, "a") for k, t in enumerate(ENDLESS)]).repartition(5)
    got = {r.doc_id: r for r in packing.pack(docs).groupBy("doc_id").sum("length").collect()}
    assert len(got) == 5 and got[0]["sum(length)"] > 1000
    aligned = {r.doc_id: r for r in alignment.align(docs).collect()}
    assert all(aligned[k].n_links >= max(aligned[k].n_a, aligned[k].n_b) > 0 for k in range(5))
    runs = {r.doc_id: [tuple(x) for x in r.runs] for r in periodic.periodic_runs(docs).collect()}
    assert runs == {0: [], 1: [], 2: [], 3: [], 4: [(0, 30, 1)]}
