"""The pipeline's stages, each on what the one before it kept, against plain Python."""

import collections
import os
import sys
import zlib

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402

import corpus_pipeline as P  # noqa: E402
from svgspark.llm import mixing, quality_rank  # noqa: E402
from svgspark.llm.common import noted, table, written  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The documents and the result of each stage."""
    docs = [table(spark, SF, "documents")]
    for _, f in P.STAGES:
        docs.append(written(f(spark, docs[-1], SF), "stage"))
    return docs


def test_quality(spark, stages):
    model = quality_rank.train(stages[0], table(spark, SF, "labels"))
    good = {r.doc_id for r in quality_rank.score(stages[0], model).where("predicted = 1").collect()}
    assert {r.doc_id for r in stages[1].collect()} == good
    assert stages[1].columns == stages[0].columns


def test_lines(stages):
    rows = [(r.doc_id, r.text) for r in stages[1].collect()]
    got = {r.doc_id: (r.text, r.n_chars) for r in stages[2].collect()}
    assert got == {i: (t, len(t)) for (i, _), (_, _, t) in zip(rows, brute.lines(rows))}


def five_words(text):
    w = brute.WORD.findall((text or "").translate(brute.FOLD))
    return frozenset(zip(*[w[k:] for k in range(5)])) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def test_near_duplicates(stages, monkeypatch):
    monkeypatch.setattr(brute, "shingles", five_words)
    rows = [(r.doc_id, r.text) for r in stages[2].collect()]
    kept = {i for i, (_, _, keep) in brute.near(rows).items() if keep}
    got = [(r.doc_id, r.text) for r in stages[3].collect()]
    assert sorted(got) == sorted((i, t) for i, t in rows if i in kept)


def test_mixing(stages):
    words = lambda t: brute.WORD.findall(t or "")
    before = {r.doc_id: r for r in stages[3].collect()}
    sizes = collections.Counter()
    for r in before.values():
        sizes[r.source] += len(words(r.text))
    taken = collections.Counter()
    for r in stages[4].collect():
        own = words(before[r.doc_id].text)
        assert r.text == before[r.doc_id].text or words(r.text) == own[:len(words(r.text))]
        assert r.n_chars == len(r.text)
        taken[r.source] += len(words(r.text))
    target = brute.targets(sizes)
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in sizes)
    assert stages[4].columns == stages[0].columns


def test_packing(spark, stages):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = collections.Counter()
    for r in stages[4].collect():
        ids = np.array(library.encode(r.text, add_special_tokens=False).ids + [0], "<u4")
        cut = [0, *range(len(ids) - (len(ids) - 1) // 2048 * 2048, len(ids) + 1, 2048)]
        for k, (a, b) in enumerate(zip(cut, cut[1:])):
            want[r.doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    rows = stages[5].collect()
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    bins = collections.defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        b.sort()
        assert [o for o, _ in b] == [sum(n for _, n in b[:k]) for k in range(len(b))] and sum(n for _, n in b) <= 2048
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in P.run(spark, SF).collect()) == want


def test_extra_columns_and_awkward_rows_pass(spark):
    """Null texts, ids and sources, repeated rows and columns with the operators' own names."""
    rows = [(1, "a b c " * 30, "en", "s", 180, "x", 1), (1, "a b c " * 30, "en", "s", 180, "x", 1), (2, None, None, None, None, "x", 2), (None, "one line", "en", None, 8, "x", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, row string, n long")
    for name, f in P.STAGES[1:4]:
        out = f(spark, docs, SF)
        assert out.columns == docs.columns, name
        got = out.collect()
        assert {r.doc_id for r in got} >= {1}, name
    assert sum(r.doc_id == 1 for r in P.near_duplicates(spark, docs, SF).collect()) == 1
    assert P.near_duplicates(spark, docs.where("false"), SF).collect() == []


def test_near_duplicates_of_five_words(spark, stages, monkeypatch):
    """Plain Python at 5 words: a copy with scattered changes stays, though it is near at 2 words; short texts are one shingle."""
    base = [f"w{k}" for k in range(200)]
    texts = [base, base[:199], [f"x{k}" if k % 26 == 13 else w for k, w in enumerate(base)], ["A", "b"], ["a", "B"], ["a", "b", "c"], ["a"], []]
    rows = [(k, " ".join(w)) for k, w in enumerate(texts)]
    assert {i for i, (_, _, keep) in brute.near(rows).items() if keep} == {0, 3, 5, 6, 7}
    monkeypatch.setattr(brute, "shingles", five_words)
    for docs in (spark.createDataFrame(rows, "doc_id long, text string"), stages[2].select("doc_id", "text")):
        rows = [tuple(r) for r in docs.collect()]
        kept = {i for i, (_, _, keep) in brute.near(rows).items() if keep}
        assert sorted(tuple(r) for r in P.near_duplicates(spark, docs, SF).collect()) == sorted((i, t) for i, t in rows if i in kept)
    assert {0, 2, 3, 5, 6, 7} == {i for i, (_, _, keep) in brute.near([(k, " ".join(w)) for k, w in enumerate(texts)]).items() if keep}


def test_part_taken_keeps_its_white_space(spark):
    """One source of 21 words has a target of 32: its second round takes one document whole and one in part."""
    rows = [(k, f"  a{k} b\n\nc\td  e\n f\x0bg \n", "s") for k in range(3)]
    texts = {k: t for k, t, _ in rows}
    out = [(r.doc_id, r.text) for r in mixing.curriculum(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()]
    parts = [(k, t) for k, t in out if t != texts[k]]
    assert len(out) == 5 and len(parts) == 1
    k, t = parts[0]
    assert t == f"  a{k} b\n\nc\td" and len(brute.WORD.findall(t)) == 4


def test_odd_columns_pass_every_stage(spark):
    """Names with spaces and dots, a map column and a struct column, repeated rows, and empty tables."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, `a b` string, `c.d` map<string,int>, s struct<x:int>"
    rows = [(k // 2, f"plain words of the text {k // 2} " * 20, "en", "s", 10, "v", {"k": k % 3}, (k,)) for k in range(12)]
    docs = spark.createDataFrame(rows, schema)
    for name, f in P.STAGES[:4]:
        out = f(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert {r.doc_id for r in out.collect()} <= set(range(6)), name
        assert f(spark, docs.where("false"), SF).collect() == [], name
    assert P.pack(spark, docs, SF).count() >= 12 and P.pack(spark, docs.where("false"), SF).collect() == []
    kept = P.near_duplicates(spark, docs, SF).collect()
    assert len({r.doc_id for r in kept}) == len(kept) and all(r["c.d"] is not None for r in kept)


def test_tokens_in_one_long_run(spark):
    """A run of token letters without a dot is read once, from its left end."""
    from svgspark.llm import secrets

    text = "eyJ" * 100_000
    one = "eyJhbGciOiJIUzI1.eyJzdWIiOiIxMjM0.c2lnbmF0dXJl"
    got = {r.doc_id: r.spans for r in secrets.scan(spark.createDataFrame([(1, text), (2, f"x {one} y")], "doc_id long, text string")).collect()}
    assert "jwt" not in got[1] and f"jwt:2:{2 + len(one)}" in got[2]


def test_run_leaves_only_what_its_result_reads(spark):
    """The tables of the first stages are gone once the next one is written; the result is still whole."""
    with noted() as paths:
        out = P.run(spark, SF)
    left = {os.path.basename(p).rsplit("-", 1)[0] for p in paths if os.path.exists(p)}
    assert "stage3" in left and not left & {"stage0", "stage1", "stage2", "lines", "line-hits", "line-run-0"}
    assert out.count() > 0
