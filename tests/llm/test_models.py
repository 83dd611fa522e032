"""Scores of the classifiers against plain passes over single documents; null and repeated ids in every operator."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from svgspark.llm import embed_dedup, labelled, mixing, packing, quality_rank, quality_rules, secrets, stats, suffix_dedup, toxicity
from svgspark.llm import textkit as K
from svgspark.llm.common import table
from test_operators import frame, texts

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def short():
    return [(i, t, s) for i, t, s in texts() if t is None or len(t) < 1500]


@pytest.fixture(scope="module")
def docs(spark, short):
    return frame(spark, short)


@pytest.fixture(scope="module")
def models(spark):
    train = table(spark, SF, "documents"), table(spark, SF, "labels")
    return {"rank": quality_rank.train(*train), "rules": quality_rules.train(*train), "net": toxicity.train(*train)}


def logistic(x):
    return 1 / (1 + math.exp(-max(-40, min(40, x))))


def words_of(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def span_hash(data):
    table, p = quality_rules._FOLDED.table, K.SpanHash.P
    total = sum(int(table[x]) * pow(p, i, 2**64) for i, x in enumerate(data)) % 2**64
    return mixed(total)


def mixed(x):
    return int(K.mix(np.array([x % 2**64], np.uint64))[0])


def rule_groups(text):
    """The hashes of the four groups, word by word and character by character."""
    words = [w.encode() for w in words_of(text)]
    h = [span_hash(w) for w in words]
    shapes, last = [], 0
    for i, w in enumerate(words):
        same = int(i > 0 and h[i] == h[i - 1])
        shape = ((min(len(w), 24) // 3 * 16 + int(stats._class[w[0]])) * 16 + int(stats._class[w[-1]])) * 2 + same
        shapes.append(mixed(last * 8192 + shape))
        last = shape + 1
    text = text or ""
    return [h, shapes, [span_hash(text[i:i + 3].encode()) for i in range(len(text) - 2)], [mixed(mixed(a + 1) ^ b) for a, b in zip(h, h[1:])]]


def test_rules_of_single_documents(docs, short, models):
    model = models["rules"]
    got = {r.doc_id: r for r in quality_rules.judge(docs, model).collect()}
    for i, text, _ in short:
        raw = model.bias
        for k, group in enumerate(rule_groups(text)):
            own = [float(model.weights[(x >> (64 - quality_rules.BITS[k])) + quality_rules.BASES[k]]) for x in group]
            raw += sum(own) / max(1, len(own))
        p = logistic(model.a * raw + model.b)
        assert abs(got[i].probability - p) < 1e-4
        if abs(p - 0.5) > 1e-4:
            words = words_of(text)
            seen = Counter(tuple(words[j:j + 3]) for j in range(len(words) - 2))
            again = {j + d for j in range(len(words) - 2) if seen[tuple(words[j:j + 3])] > 1 for d in range(3)}
            assert got[i].kept == (p >= 0.5 and len(words) >= 50 and 100 * len(again) <= 50 * len(words))


def test_toxicity_of_single_documents(docs, short, models):
    net, cuts = models["net"]
    got = {r.doc_id: r for r in toxicity.score(docs, net, cuts).collect()}
    for i, text, _ in short:
        data = np.frombuffer((text or "").encode(), np.uint8)
        h, _first = toxicity.tokens(data, np.array([0, len(data)]))
        x = [sum(net.tables[t][toxicity.rows_of(np.array([v]), t)[0]] for t in range(toxicity.TABLES)).astype(float) for v in h]
        raw = net.base
        for k, w in enumerate(toxicity.WIDTHS):
            for f in range(toxicity.FILTERS):
                acts = [sum(float(x[p + j] @ net.filters[k][j][:, f]) for j in range(w)) + float(net.bias[k, f]) for p in range(len(x) - w + 1)]
                raw += max([0.0, *acts]) * float(net.out[k * toxicity.FILTERS + f])
        want = logistic(net.a * raw + net.b)
        assert abs(got[i].score - want) < 1e-3 and got[i].flagged == (got[i].score >= cuts.get("en", toxicity.CUT))


def test_ranking_of_single_documents(docs, short, models):
    model = models["rank"]
    got = {r.doc_id: r for r in quality_rank.score(docs, model).collect()}
    for i, text, _ in short:
        data = np.frombuffer((text or "").encode(), np.uint8)
        x = stats.features(stats.Texts(data, np.array([0, len(data)])))[0]
        raw = sum(max(-8.0, min(8.0, float((v - m) / s))) * float(w) for v, m, s, w in zip(x, model.mean, model.scale, model.weights))
        want = logistic(math.log(0.7 / 0.3) + model.slope * (raw - model.cut))
        assert abs(got[i].score - want) < 1e-6 and got[i].predicted == int(got[i].score >= 0.7)


def test_null_and_repeated_ids(spark, models):
    long = " ".join(f"w{i % 97}" for i in range(120)) + " password=hunter2222"
    rows = [(None, long, "a"), (7, long, "a"), (7, long, "a"), (None, None, None), (8, "", "b"), (9, "other text", "b")]
    odd = frame(spark, rows)

    def both(out, *cols):
        return Counter((r["doc_id"], *(r[c] for c in cols)) for r in out.collect())

    assert both(secrets.scan(odd), "n_assign") == Counter({(None, 1): 1, (7, 1): 2, (None, 0): 1, (8, 0): 1, (9, 0): 1})
    n = len(long.encode())
    assert both(suffix_dedup.op3(odd), "n_bytes", "n_removed") == Counter({(None, n, n): 1, (7, n, n): 2, (None, 0, 0): 1, (8, 0, 0): 1, (9, 10, 0): 1})
    for out, col in ((quality_rank.score(odd, models["rank"]), "score"), (toxicity.score(odd, *models["net"]), "score"),
                     (quality_rules.judge(odd, models["rules"]), "probability")):
        got = out.collect()
        assert Counter(r.doc_id for r in got) == Counter([None, None, 7, 7, 8, 9])
        assert len({r[col] for r in got if r.doc_id == 7}) == 1
        if "held_out" in out.columns:
            assert not any(r.held_out for r in got if r.doc_id is None)
    pieces = packing.pack(odd).collect()
    assert Counter(r.doc_id for r in pieces) == Counter([None, None, 7, 7, 8, 9])
    assert len({r.ids_crc32 for r in pieces if r.doc_id == 7}) == 1
    for s in {r.sequence_id for r in pieces}:
        own = sorted((r.offset, r.length) for r in pieces if r.sequence_id == s)
        assert [o for o, _ in own] == [sum(k for _, k in own[:j]) for j in range(len(own))]


def test_no_words_at_all(spark):
    got = mixing.op5(frame(spark, [(1, None, "a"), (2, "", "b"), (3, " \n", None)])).collect()
    assert sorted((r.doc_id, r.size, r.source_size, r.target, r.taken) for r in got) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0), (3, 0, 0, 0.0, 0)]


def test_null_and_repeated_vectors(spark):
    v, w = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    rows = [(None, v, 1), (4, v, 1), (4, v, 1), (2, [2.0, 0.01, 0.0], 1), (6, w, 1), (5, v, 2), (3, v, None)]
    got = embed_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label long")).collect()
    assert Counter(tuple(r) for r in got) == Counter({(None, 0, None, True): 1, (4, 1, 2, False): 2, (2, 1, 2, True): 1, (6, 0, 6, True): 1, (5, 0, 5, True): 1, (3, 0, 3, True): 1})


def test_toxicity_learns_from_every_labelled_row(spark):
    """In groups of 40 rows, of which none is left out; the changes are added up in any order with the same result."""
    rows = [(i, f"plain text number {i % 7} " + ("vile " if i % 3 == 0 else "kind ") + f"w{i % 11}", "en") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(600)], "doc_id long, toxic int")
    seen = []
    whole = toxicity.fit
    try:
        toxicity.fit = lambda words, parts, rate: seen.append((words.count(), parts)) or whole(words, parts, rate)
        net, cuts = toxicity.train(docs, labels, 40)
        again, _ = toxicity.train(docs, labels, 40)
    finally:
        toxicity.fit = whole
    outside = docs.where(~labelled.held_out(toxicity.FOLDS, toxicity.HELD_OUT)).count()
    assert 0.7 * outside < seen[0][0] < outside and seen[0][1] == -(-seen[0][0] // 40)
    assert (net.tables == again.tables).all() and (net.a, net.b) == (again.a, again.b)
    got = toxicity.score(docs, net, cuts).collect()
    assert all(r.predicted == int(r.doc_id % 3 == 0) for r in got)


def test_every_labelled_text_finds_its_label(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "concat('t', id) AS text").unionAll(spark.sql("SELECT CAST(NULL AS LONG), 'x'"))
    ids = spark.range(0, 6000, 7).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS label")
    got = sorted((r.doc_id, r.text, r.label) for r in labelled.labelled(docs, ids).collect())
    assert got == [(i, f"t{i}", i % 2) for i in range(0, 3000, 7)]
