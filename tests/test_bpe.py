"""The learned vocabulary against plain Python: exact merges, rounds of several, special tokens kept whole."""

import collections
import random
import re

from pyspark.sql import functions as F

import __spark_entry__ as E
from svgspark.operators import train as TR

from conftest import SF_SMALL

TEXT = "low low low low lower lower newest newest newest newest newest newest widest widest widest hug pug hugs aaaa aaaa aaaa"


def exact(words, n):
    """The first n merges, one at a time: largest count, then smallest pair."""
    state, out = {w: list(w) for w in words}, []
    for _ in range(n):
        pairs = collections.Counter()
        for w, s in state.items():
            for p in zip(s, s[1:]):
                pairs[p] += words[w]
        if not pairs:
            break
        best = min(pairs, key=lambda p: (-pairs[p], p))
        out.append((*best, pairs[best]))
        for w, s in state.items():
            i = 0
            while i < len(s) - 1:
                if (s[i], s[i + 1]) == best:
                    s[i:i + 2] = ["".join(best)]
                i += 1
    return out


def test_three_merges_of_the_corpus(spark):
    wc = TR.pretoken_counts(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    got = [(r.a, r.b, r.cnt) for r in TR.bpe_merges(spark, wc, 3).orderBy("rank").collect()]
    assert got == exact({r.word: r.n for r in wc.collect()}, 3)


def test_rounds_end_with_whole_words(spark):
    words = collections.Counter(TEXT.split())
    wc = spark.createDataFrame(list(words.items()), "word string, n long")
    one = [(r.a, r.b, r.cnt) for r in TR.bpe_merges(spark, wc, 99).orderBy("rank").collect()]
    assert one == exact(words, 99)
    many = [(r.a, r.b) for r in TR.bpe_merges(spark, wc, 99, 100).orderBy("rank").collect()]
    for merges in ([p[:2] for p in one], many):
        assert {r.word: r.tokens for r in TR.encode_words(wc, merges).collect()} == {w: [w] for w in words}
    assert len(set(many)) == len(many)
    assert len({r.a + r.b for r in TR.bpe_merges(spark, wc, 5, 100).collect()}) == 5


def test_registered_queries_reach_the_end(spark):
    """Until the target or no pair is left: every word of the corpus found three times is one token."""
    merges = [(r.a, r.b) for r in E.queries()["bpe_merges"](spark, SF_SMALL).orderBy("rank").collect()]
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    ranks = {p: k for k, p in enumerate(merges)}
    assert len(merges) == len(ranks) > 3
    assert all(len(TR.bpe_apply(list(r.word), ranks)) == 1 for r in TR.unit_counts(docs).collect())
    vocabulary = {r.token: r.id for r in E.queries()["vocab_table"](spark, SF_SMALL).collect()}
    assert {a + b for a, b in merges} <= set(vocabulary) and sorted(vocabulary.values()) == list(range(len(vocabulary)))
    assert len(vocabulary) <= TR.VOCAB_TARGET
    units = docs.select("doc_id", F.regexp_extract_all("text", F.lit(TR.UNIT_RE), F.lit(0)).alias("u")).collect()
    want = {r.doc_id: sum(1 if w in TR.SPECIAL_TOKENS else len(TR.bpe_apply(list(w), ranks)) for w in r.u or []) for r in units}
    assert {r.doc_id: r.n_tokens for r in E.queries()["encode_corpus"](spark, SF_SMALL).collect()} == want


def test_special_tokens_are_kept_whole(spark):
    text = '"><svg><lineage stroke-width="2" xx x="1" xmlns="http://www.w3.org/2000/svg"></svg><line a <path></paths>'
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = [r.word for r in TR.pretokens(docs, pattern=TR.UNIT_RE).orderBy("pos").collect()]
    assert got == ['">', "<svg>", "<", "lineage", "stroke-width", '="', "2", '"', "xx", "x", '="', "1", '"', "xmlns", '="',
                   "http://www.w3.org/2000/svg", '">', "</svg>", "<line", "a", "<path>", "</", "paths", ">"]
    assert "".join(got) == re.sub(r"\s", "", text)
    enc = {r.word: r.tokens for r in TR.encode_words(spark.createDataFrame([(w,) for w in got], "word string"), []).collect()}
    assert enc["<svg>"] == ["<svg>"] and enc["stroke-width"] == ["stroke-width"] and enc["xx"] == ["x", "x"]


def test_older_tokens_follow_the_learned_ones(spark):
    merges = spark.createDataFrame([(0, "a", "b", 9), (1, "ab", "c", 5)], "rank int, a string, b string, cnt long")
    alphabet = spark.createDataFrame([("a",), ("b",), ("c",)], "token string")
    extra = spark.createDataFrame([(7, "zz"), (3, "older"), (1, "ab"), (2, "<svg>")], "rank int, token string")
    plain = {r.token: r.id for r in TR.vocab_table(spark, merges, alphabet).collect()}
    more = {r.token: r.id for r in TR.vocab_table(spark, merges, alphabet, extra).collect()}
    assert more == plain | {"older": len(plain), "zz": len(plain) + 1}


def swept(symbols, ranks):
    """The plain form: the learned pair of the lowest rank merged everywhere from the left, again and again."""
    while found := [ranks[p] for p in zip(symbols, symbols[1:]) if p in ranks]:
        out, i = [], 0
        while i < len(symbols):
            hit = i + 1 < len(symbols) and ranks.get((symbols[i], symbols[i + 1])) == min(found)
            out.append(symbols[i] + symbols[i + 1] if hit else symbols[i])
            i += 1 + hit
        symbols = out
    return symbols


def test_merges_of_a_word_equal_the_sweeps():
    rng = random.Random(5)
    for _ in range(300):
        parts, ranks = ["a", "b", "c"], {}
        while len(ranks) < 12:
            p = (rng.choice(parts), rng.choice(parts))
            if p not in ranks:
                ranks[p] = len(ranks)
                parts.append("".join(p))
        word = [rng.choice("abc") for _ in range(rng.randrange(40))]
        assert TR.bpe_apply(word, ranks) == swept(word, ranks)


def test_a_very_long_word():
    ranks = {("a", "a"): 0, ("aa", "aa"): 1}
    word = ["a"] * 300_001 + ["b"]
    assert TR.bpe_apply(word, ranks) == ["aaaa"] * 75_000 + ["a", "b"]


def test_characters_per_learned_token(spark):
    q = E.queries()
    n = {r.doc_id: r.n_tokens for r in q["encode_corpus"](spark, SF_SMALL).collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()}
    for r in q["fertility_learned"](spark, SF_SMALL).collect():
        assert (r.n_chars, r.n_tokens) == (len(texts[r.doc_id]), n[r.doc_id])
        assert abs(r.chars_per_token - r.n_chars / max(1, r.n_tokens)) < 1e-6


def test_driver_gets_only_the_pairs_a_round_may_take(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame as Frame

    sizes, collect = [], Frame.collect
    monkeypatch.setattr(Frame, "collect", lambda self: sizes.append(got := collect(self)) or got)
    wc = spark.createDataFrame([("ab" * 3, 1000)] + [(chr(200 + i) + "z", 3) for i in range(300)], "word string, n long")
    TR.bpe_merges(spark, wc, 1, 1000)
    assert [len(x) for x in sizes] == [2]


def test_words_merged_together_equal_the_sweeps():
    rng = random.Random(6)
    for _ in range(60):
        parts, ranks = ["a", "b", "é", "𝄞"], {}
        while len(ranks) < 14:
            p = (rng.choice(parts), rng.choice(parts))
            if p not in ranks:
                ranks[p] = len(ranks)
                parts.append("".join(p))
        words = ["".join(rng.choice("abé𝄞c") for _ in range(rng.choice([1, 2, 5, 20, TR.LONG_WORD + 9]))) for _ in range(12)]
        table = TR.Merges(list(ranks)).table()
        sym, word = table.apply(*TR._characters(words))
        assert [table.names(sym[word == i]) for i in range(len(words))] == [swept(list(w), ranks) for w in words]


def test_empty_and_special_words_are_encoded(spark):
    words = spark.createDataFrame([("",), ("<svg>",), ("aab",), ("width",), ("z",)], "word string")
    got = {r.word: r.tokens for r in TR.encode_words(words, [("a", "b"), ("a", "ab")]).collect()}
    assert got == {"": [], "<svg>": ["<svg>"], "aab": ["aab"], "width": ["width"], "z": ["z"]}


def test_texts_are_taken_apart_once_per_distinct_run(spark, capsys):
    texts = [" <svg  width=\"2\">low,low\tlow.\n", "a b xx y width=3", "", None, "<line a<path> </g >x1 stroke-widths"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 3)], "doc_id long, text string")
    whole = docs.select(F.explode(F.regexp_extract_all("text", F.lit(TR.UNIT_RE), F.lit(0))).alias("w")).groupBy("w").count().collect()
    assert {r.word: r.n for r in TR.unit_counts(docs).collect()} == {r.w: r["count"] for r in whole if r.w not in TR.SPECIAL_TOKENS}
    TR.unit_counts(docs).explain()
    plan = capsys.readouterr().out
    assert plan.index("regexp_extract_all") < plan.index("split(")  # the pattern above, the counted runs below
