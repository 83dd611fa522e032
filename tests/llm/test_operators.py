"""The training-data operators against plain Python on a small table of awkward rows."""

import collections
import os
import random
import sys
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402

from svgspark.llm import (  # noqa: E402
    embed_dedup, labelled, line_dedup, mixing, near_dup, packing, quality_rank, quality_rules, secrets, suffix_dedup, toxicity,
)

SF = "/root/testdata/sf0.1"
#: Extra columns whose names the operators use inside.
EXTRA = ("row", "rid", "parts", "id", "keys", "label", "score", "spans", "size", "target", "salt")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in EXTRA)


def texts() -> list[tuple]:
    """(doc_id, text, source): words of a small vocabulary, copies, edits, repeated lines, awkward texts."""
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(400)] + ["Über", "É", "the", "of"]
    out = []
    base = rng.choices(vocabulary, k=120)
    for i in range(60):
        words = list(base)
        for k in range(len(words)):
            if rng.random() < rng.choice([0.01, 0.04, 0.1]):
                words[k] = rng.choice(vocabulary)
        out.append(" ".join(words))
    passage = " ".join(rng.choices(vocabulary, k=70))
    for i in range(40):
        body = "\n".join(" ".join(rng.choices(vocabulary, k=rng.randint(1, 40))) for _ in range(4))
        out.append(body + "\n  Common LINE \t\nÉcole\n" + (passage if i % 3 == 0 else "x"))
    long = " ".join(rng.choices(vocabulary, k=30_000))
    out += [long, long[5000:9000], None, "", " \t\n ", "one", "One", "Two words", "two  WORDS", "a" * 700, "\n" * 40, "\x00 null   é😀" * 30]
    out += ["password = 'hunter22' token:abc SECRET=\"abcdef\" tokentoken=aaaaaaa", "AKIA" + "A1" * 8, "AKIAshort", "x" + "0af9" * 7 + "z",
            "é api_key: k-1234567 apikey=zz1234 ſecret=abcdefg", "pass\nword=abcdefgh", "<|endoftext|> it's 'll 're   x"]
    rows = [(i, t, (None, "b", "a", "ü", "c")[i % 5] if i % 7 else "a") for i, t in enumerate(out)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, None, *["x"] * len(EXTRA)) for i, t, s in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    return texts()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return frame(spark, rows)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.where("false")


def test_secrets(docs, rows, empty):
    got = {r.doc_id: r for r in secrets.scan(docs).collect()}
    for i, text, _ in rows:
        n, spans = brute.secrets(text)
        assert [got[i].n_assign, got[i].n_access, got[i].n_hex] == n
        assert got[i].base_sha256 == brute.sha(spans)
        assert got[i].spans == spans
    assert secrets.scan(empty).collect() == []


def test_trigram_queries():
    """A text that a pattern matches always satisfies the pattern's query."""
    for pattern, hits in (
        ("abc+d", ["abcd", "abcccd"]), ("(foo|bar)baz", ["foobaz", "barbaz"]), ("a?bcde", ["bcde", "abcde"]), ("x[12]{2}yz", ["x12yz"]),
        ("(?:ab)*cde", ["cde", "ababcde"]), ("[a-z]+", ["q"]), ("ab|[0-9]+", ["ab", "7"]), ("(?i:TOKEN)s", ["ToKens"]),
    ):
        query = secrets.trigram_query(pattern)
        segment = secrets.Segment(sorted(secrets.trigrams(query)) or [b"zzz"])
        data = np.frombuffer("".join(hits).encode(), np.uint8)
        offsets = np.cumsum([0] + [len(h) for h in hits])
        assert secrets.candidates(query, segment.postings(data, offsets), len(hits)).tolist() == list(range(len(hits)))
    assert secrets.trigram_query("[0-9a-f]+") is True
    assert secrets.candidates(b"abc", {b"abc": np.array([2])}, 4).tolist() == [2]


def test_near_duplicates(docs, rows, empty):
    want = brute.near([r[:2] for r in rows])
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dup.near_duplicates(docs).collect()}
    assert got == want
    assert near_dup.near_duplicates(empty).collect() == []


def test_near_duplicates_of_a_large_family(spark):
    """Many edits of one text: large families are compared in tiles."""
    rng = random.Random(3)
    base = [f"w{i}" for i in rng.choices(range(2000), k=100)]
    rows = [(i, " ".join(rng.choice([f"w{k}"] if rng.random() > 0.08 else [f"w{rng.randrange(2000)}"]) if rng.random() < 0.12 else w
                         for k, w in enumerate(base)), "a") for i in range(200)]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dup.near_duplicates(frame(spark, rows)).collect()}
    assert got == brute.near([r[:2] for r in rows])


def test_near_duplicates_with_repeated_and_null_ids(spark):
    rows = [(5, "a b c", "a"), (5, "a b c", "a"), (3, "A b  C", "a"), (None, "a b c", "a"), (9, "", "a")]
    got = sorted((str(r.doc_id), r.component_id, r.kept) for r in near_dup.near_duplicates(frame(spark, rows)).collect())
    assert got == [("3", 3, True), ("5", 3, False), ("5", 3, False), ("9", 9, True), ("None", None, True)]


def test_signature_distance_guarantee():
    """Signatures within the distance share a key, whichever slots differ."""
    rng = np.random.default_rng(1)
    for _ in range(200):
        a = rng.integers(0, 2**16, near_dup.SLOTS, dtype=np.uint64)
        b = a.copy()
        at = rng.choice(near_dup.SLOTS, near_dup.CHUNKS * (near_dup.ERRORS + 1) - 1, replace=False)
        b[at] ^= np.uint64(1)
        assert set(near_dup.bucket_keys(a).tolist()) & set(near_dup.bucket_keys(b).tolist())


def test_suffix_dedup(docs, rows, empty):
    want = {i: w for (i, _, _), w in zip(rows, brute.repeats([t for _, t, _ in rows]))}
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.op3(docs).collect()}
    assert got == want
    assert suffix_dedup.op3(empty).collect() == []


@pytest.mark.parametrize("many", [2, 1000])
def test_suffix_dedup_many_contexts(spark, monkeypatch, many):
    """A passage with many surroundings, compared as rows of windows; long texts in chunks."""
    monkeypatch.setattr(suffix_dedup, "MANY", many)
    rng = random.Random(5)
    passage = "".join(rng.choices("abcdef ", k=260))
    rows = [(i, "".join(rng.choices("abcdef ", k=rng.randint(0, 300))) + passage[i % 9:] + "".join(rng.choices("abcdef ", k=150)), "a") for i in range(60)]
    rows += [(100, rows[0][1], "a"), (100, rows[0][1], "a")]
    want = collections.Counter((i, *w) for (i, _, _), w in zip(rows, brute.repeats([t for _, t, _ in rows])))
    got = collections.Counter(tuple(r) for r in suffix_dedup.op3(frame(spark, rows)).collect())
    assert got == want


def test_large_groups_are_compared_by_distance(monkeypatch):
    """The same spans, however many windows are compared at once."""
    rng = np.random.default_rng(3)
    data = rng.integers(97, 100, 3000).astype(np.uint8)
    rows = []
    for start in (500, 500, 520, 560, 700):
        rows.append((start, bytes(data[start:start + 260]) + bytes(rng.integers(97, 100, 40).astype(np.uint8)), start == 700))
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(5)), pa.array([1] * 5), pa.array([10] * 5), pa.array([100] * 5, pa.int32()),
         pa.array([1000 - r[0] if r[0] < 700 else 50 for r in rows], pa.int32()), pa.array([True] * 5), pa.array([r[1] for r in rows], pa.binary())],
        names=["rid", "a", "first", "more", "left", "single", "context"])
    batch = batch.set_column(4, "left", pa.array([136, 136, 116, 76, 50], pa.int32()))
    whole = suffix_dedup._repeated(batch).to_pylist()
    monkeypatch.setattr(suffix_dedup, "AT_ONCE", 5)
    assert suffix_dedup._repeated(batch).to_pylist() == whole
    assert {r["rid"] for r in whole} == {0, 1, 2, 3}


def test_suffix_entries_of_chunks_cover_all_windows():
    rng = np.random.default_rng(2)
    data = rng.integers(97, 101, 5_000_000).astype(np.uint8)
    n = 0
    for part, off, doc, place in suffix_dedup._chunks(data, np.array([0, len(data)])):
        _, _, _, first, last, _ = suffix_dedup.entries(part, off)
        n += int((last - first + 1).sum())
    assert n == len(data) - suffix_dedup.LENGTH + 1


def test_line_dedup(docs, rows, empty):
    want = {i: (n, d, brute.sha(t)) for (i, _, _), (n, d, t) in zip(rows, brute.lines([r[:2] for r in rows]))}
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in line_dedup.op8(docs).collect()}
    assert got == want
    out = line_dedup.dedup_lines(docs).select("row.*").columns
    assert out == docs.columns
    assert line_dedup.op8(empty).collect() == []


def test_line_runs_merge_levels(spark):
    """The same counts whatever the number of batches and the fan-out."""
    rng = random.Random(1)
    rows = [(i, "\n".join(rng.choice(["Aé", "aÉ", "b ", "B", "c%d" % rng.randrange(9)]) for _ in range(5)), "a") for i in range(80)]
    frame_ = frame(spark, rows)
    want = sorted((n, d, t) for n, d, t in brute.lines([r[:2] for r in rows]))
    for batches, fanout in ((1, 2), (5, 2), (6, 3)):
        out = line_dedup.dedup_lines(frame_, batches=batches, fanout=fanout)
        assert sorted((r.n_lines, r.n_dropped, r.kept) for r in out.collect()) == want


def test_mixing(docs, rows, empty):
    sizes = {i: len(brute.WORD.findall(t or "")) for i, t, _ in rows}
    per = collections.Counter()
    for i, _, s in rows:
        per[s] += sizes[i]
    want = brute.targets(per)
    source = {i: s for i, _, s in rows}
    got = mixing.op5(docs).collect()
    taken = collections.Counter()
    for r in got:
        assert (r["size"], r.source_size) == (sizes[r.doc_id], per[source[r.doc_id]])
        assert r.target == pytest.approx(want[source[r.doc_id]])
        assert 0 <= r.taken <= 2 * r["size"]
        taken[source[r.doc_id]] += r.taken
    assert all(abs(taken[s] - want[s]) <= 0.5 for s in per)
    assert got == mixing.op5(docs.repartition(7)).collect()
    assert mixing.op5(empty).collect() == []
    out = mixing.curriculum(docs)
    assert out.columns == docs.columns
    assert sum(len(brute.WORD.findall(r.text or "")) for r in out.collect()) == sum(taken.values())


def test_curriculum_inverts_demand():
    """The share of demand used up to a position is the integral of the weight."""
    for a, b in mixing.SCHEDULE + ((0.0, 2.0),):
        for u in (0.0, 0.1, 0.5, 0.99):
            root = a + np.sqrt(a * a + (b * b - a * a) * u)
            t = 0.0 if root == 0 else (a + b) * u / root
            assert (a * t + (b - a) * t * t / 2) / ((a + b) / 2) == pytest.approx(u)


def test_embeddings(spark):
    rng = np.random.default_rng(6)
    rows, centre = [], rng.normal(size=(12, 24))
    for i in range(300):
        v = centre[i % 12] * rng.uniform(0.1, 9) + rng.normal(size=24) * rng.choice([0.02, 0.1, 0.16])
        rows.append((i, [float(np.float32(x)) for x in v], int(i % 3)))
    rows += [(500 + k, rows[k][1], rows[k][2]) for k in range(40)]
    rows += [(600, None, 1), (601, [0.0] * 24, 1), (602, [float("nan")] * 24, 1), (603, [1.0] * 24, None), (604, [1.0, None], 1), (605, [], 1),
             (606, [float("inf")] + [1.0] * 23, 1), (607, [1e30] * 24, 1), (608, [1e-30] * 24, 1), (609, [1.0, 2.0], 1), (610, [2.0, 4.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    rows = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    for tile in (16, 1024):
        got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embed_dedup.near_duplicates(df, tile=tile).collect()}
        assert got == brute.vectors(rows)
    assert embed_dedup.near_duplicates(df.where("false")).collect() == []


def test_bounds_keep_every_pair():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(200, 40))
    x[100:] = x[:100] + rng.normal(size=(100, 40)) * 0.2
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    i, j = embed_dedup.near_pairs(x, x, 0.9)
    assert set(zip(i.tolist(), j.tolist())) == set(zip(*(k.tolist() for k in np.nonzero(x @ x.T >= 0.9))))


def test_packing_round_trip(docs, rows, empty):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {i: library.encode(t or "", add_special_tokens=False).ids + [0] for i, t, _ in rows}
    got = packing.pack(docs).collect()
    pieces = collections.defaultdict(list)
    bins = collections.defaultdict(list)
    for r in got:
        pieces[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
        bins[r.sequence_id].append((r.offset, r.length))
    for i, ids in want.items():
        own = sorted(pieces[i])
        assert [p[0] for p in own] == list(range(-(-len(ids) // 2048)))
        assert [p[1] for p in own] == [sum(p[2] for p in own[:k]) for k in range(len(own))]
        assert sum(p[2] for p in own) == len(ids) and all(p[2] == 2048 for p in own[1:])
        for _, start, length, crc in own:
            assert crc == zlib.crc32(np.array(ids[start:start + length], "<u4").tobytes())
    for b in bins.values():
        b.sort()
        assert [o for o, _ in b] == [sum(n for _, n in b[:k]) for k in range(len(b))]
        assert sum(n for _, n in b) <= 2048
    assert packing.pack(empty).collect() == []


def test_ids_equal_the_library():
    rng = random.Random(2)
    letters = list("ab'  \n\t12.,!s") + ["'s", "'re", "'ll", " '", "é", "ß", " ", " ", "²", "½", "ǅ", "中", "\x00", "<|endoftext|>", "😀"]
    some = ["".join(rng.choices(letters, k=rng.randint(0, 25))) for _ in range(3000)]
    ids = packing.Ids(None)
    want = [e.ids for e in ids.library.encode_batch(some, add_special_tokens=False)]
    assert [x.tolist() for x in ids.of(pa.array(some))] == want


def test_plan_fills_bins():
    rng = random.Random(4)
    counts = collections.Counter(min(2048, int(rng.lognormvariate(5.5, 1))) or 1 for _ in range(20000))
    bins = packing.plan(counts)
    used = collections.Counter()
    for times, lengths in bins:
        assert sum(lengths) <= 2048
        for x in lengths:
            used[x] += times
    assert used == counts
    least = -(-sum(k * n for k, n in counts.items()) // 2048)
    assert sum(t for t, _ in bins) <= least * 1.01 + 1
    # a bin's smallest piece gives way to two that fit the widened gap more tightly
    assert (1, [1000, 500, 548]) in [(t, sorted(b, reverse=True)[:1] + sorted(b[1:])) for t, b in packing.plan({1000: 1, 900: 1, 548: 1, 500: 1})]


def test_rules_counts(spark, docs, rows, empty):
    model = quality_rules.Model(np.zeros(quality_rules.SIZE, np.float32), 0.0, 0.0, 40.0)
    got = {r.doc_id: r for r in quality_rules.judge(docs, model).collect()}
    for i, text, _ in rows:
        n = brute.counts(text)
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == n
        failed = n[0] < 50 or 100 * n[4] > 50 * n[0]
        assert (r.base_failed, r.kept) == (failed, not failed)
    assert quality_rules.judge(empty, model).collect() == []


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def held_out(rows, label, n, remainder):
    truth = dict(duckdb.sql(f"SELECT doc_id, {label} FROM '{SF}/labels.parquet'").fetchall())
    own = [r for r in rows if r.doc_id in truth and zlib.crc32(str(r.doc_id).encode()) % n == remainder]
    return own, np.array([truth[r.doc_id] for r in own])


def test_quality_ranking_on_held_out_rows(corpus, empty):
    docs, labels = corpus
    model = quality_rank.train(docs, labels)
    own, y = held_out(quality_rank.score(docs, model).collect(), "quality", 4, 2)
    assert all(r.held_out for r in own)
    assert labelled.auc(y, np.array([r.score for r in own])) > 0.98
    assert np.mean([r.predicted for r in own] == y) > 0.97
    assert quality_rank.score(empty, model).collect() == []
    assert quality_rank.good_documents(docs, model).columns == docs.columns


def test_rules_on_held_out_rows(corpus):
    docs, labels = corpus
    model = quality_rules.train(docs, labels)
    own, y = held_out(quality_rules.judge(docs, model).collect(), "quality", 4, 2)
    p = np.array([r.probability for r in own])
    assert labelled.auc(y, p) > 0.98
    assert abs(p.mean() - y.mean()) < 0.03


def test_toxicity_on_held_out_rows(corpus, empty):
    docs, labels = corpus
    net, cuts = toxicity.train(docs, labels)
    own, y = held_out(toxicity.score(docs, net, cuts).collect(), "toxic", 5, 0)
    p = np.array([r.predicted for r in own])
    assert labelled.auc(y, np.array([r.score for r in own])) > 0.93
    assert np.mean(p == y) > 0.95
    assert p[y == 1].mean() > 0.7
    assert toxicity.score(empty, net, cuts).collect() == []


def test_scores_of_awkward_rows(docs, rows, empty, corpus):
    """Null, empty and very long texts get finite scores; training without rows gives a constant model."""
    labels = corpus[1]
    for out in (quality_rank.score(docs, quality_rank.train(empty, labels)), toxicity.score(docs, *toxicity.train(empty, labels)),
                quality_rules.judge(docs, quality_rules.train(empty, labels)).withColumnRenamed("probability", "score")):
        got = out.collect()
        assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
