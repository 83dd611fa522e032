"""Records that once ended a job: very long tags, open quotes, clashing attributes, odd numbers and paths."""

from pyspark.sql import functions as F

from svgspark.functions.text import style_map
from svgspark.operators import clean as C
from svgspark.operators import geom as G
from svgspark.operators import mine as M
from svgspark.operators import normalize as N
from svgspark.operators import train as TR
from svgspark.operators import tree as T


def test_long_tags_and_open_quotes(spark):
    long = "<svg " + "a" * 1_000_000 + "><g/></svg>"
    rows = [(1, long), (2, '<svg a="' + "x" * 20_000), (3, "<svg><p " + "b='c' " * 2_000 + "/></svg>"), (4, None), (5, "")]
    docs = spark.createDataFrame(rows, "rec_id long, svg string")
    el = T.svg_elements(T.svg_tokens(docs)).select("rec_id", "tag", F.size("attrs").alias("n")).collect()
    assert sorted((r.rec_id, r.tag, r.n) for r in el) == [(1, "g", 0), (1, "svg", 0), (3, "p", 1), (3, "svg", 0)]
    page = spark.createDataFrame([(1, "u", "<img " + "a" * 100_000 + ' src="x.svg">')], "page_id long, url string, html string")
    assert [r.ref for r in M.extract_src_refs(page).collect()] == ["x.svg"]


def test_class_names_and_references_are_not_cut(spark):
    name = "c" * 3_000
    docs = spark.createDataFrame([(1, f"<svg><style>.{name}{{fill:red}}</style></svg>")], "rec_id long, svg string")
    assert [r.cls for r in T.style_rules(T.svg_tokens(docs)).collect()] == [name]


def test_clashing_links_and_colons_in_styles(spark):
    el = spark.createDataFrame([(1, 1, {"href": "#a", "xlink:href": "#b", "style": "fill:url(http://x/y;z#q);stroke:red"})],
                               "rec_id long, depth int, attrs map<string,string>")
    assert C.drop_attrs(el).first().attrs["href"] == "#a"
    assert C.style_to_attrs(el).first().attrs["fill"] == "url(http://x/y;z#q)"
    assert spark.range(1).select(style_map(F.lit("a:b:c;d:e")).alias("m")).first().m == {"d": "e"}


def test_numbers_beyond_decimals(spark):
    got = spark.createDataFrame([("1e60",), ("2.55px",)], "v string").select(C.round_value(F.lit("x"), F.col("v")).alias("v")).collect()
    assert [r.v for r in got] == ["1.0E60", "2.6"]
    assert spark.range(1).select(G.fmt_num(F.lit(1e30)).alias("v")).first().v == "1" + "0" * 30


def test_many_attributes(spark):
    """Ten thousand attributes, and as many that repeat: the first counts."""
    names = "".join(f'a{i}="{i}" ' for i in range(10_000))
    rows = [(1, f"<svg {names}/>"), (2, f"<svg {names} {names.replace('=', '=' + chr(32))} A1='x'/>")]
    el = T.lower_attrs(T.svg_elements(T.svg_tokens(spark.createDataFrame(rows, "rec_id long, svg string"))))
    got = {r.rec_id: (r.n, r.m, r.a) for r in el.select("rec_id", F.size("attrs").alias("n"), F.size("lattrs").alias("m"), F.col("lattrs")["a1"].alias("a")).collect()}
    assert got == {1: (10_000, 10_000, "1"), 2: (10_001, 10_000, "1")}


def test_matrices_of_deep_trees(spark):
    """A chain of 10,000 groups: a row each, and the product of all."""
    n = 10_000
    svg = "<svg>" + '<g transform="translate(1 2)">' * n + "<path/>" + "</g>" * n + "</svg>"
    el = T.lower_attrs(T.svg_elements(T.svg_tokens(spark.createDataFrame([(1, svg)], "rec_id long, svg string"))))
    el = N.effective_transform(el.withColumn("m_local", G.parse_transform(F.col("lattrs")["transform"])))
    rows = el.select("tag", "depth", "m_eff").collect()
    assert len(rows) == n + 2
    deepest = next(r for r in rows if r.tag == "path")
    assert (deepest.depth, deepest.m_eff.e, deepest.m_eff.f) == (n + 1, float(n), 2.0 * n)


def test_special_tokens_are_whole_units(spark):
    docs = spark.createDataFrame([('<svg><linearGradient/><line x="1" transform="translate(2)"/></svg>',)], "svg string")
    got = {r.token: r.n for r in TR.special_token_counts(docs).collect()}
    assert (got["<line"], got["<linearGradient"], got["<svg>"], got["</svg>"], got["x"], got["translate"], got["rotate"]) == (1, 1, 1, 1, 1, 1, 0)


def test_one_letter_words_have_no_pairs(spark):
    words = spark.createDataFrame([("a", 9), ("ab", 2), ("abb", 1)], "word string, n long")
    assert [(r.a, r.b, r.cnt) for r in TR.bpe_merges(spark, words, 1).collect()] == [("a", "b", 3)]


def test_pairs_cover_every_record(spark):
    rows = spark.createDataFrame([(i, f"r{i}", "same" if i < 2 else f"s{i}") for i in range(6)], "rec_id long, raw string, stage2 string")
    got = TR.optimized_pairs(rows, 1).collect()
    stage2 = {f"r{i}": "same" if i < 2 else f"s{i}" for i in range(6)}
    assert sum(r.label for r in got) == 6
    assert all((stage2[r.a] == r.b) == bool(r.label) for r in got)
    assert sum(1 - r.label for r in got) >= 4


def test_clean_corpus_keeps_the_picture(spark):
    svg = ('<svg xmlns="http://www.w3.org/2000/svg"><style>.a{fill:red}</style><g display="none"><path d="M0 0"/>secret</g>'
           '<g><g><defs/></g></g><path class="a" id="p&#233;" d="M1 1"/></svg>')
    rows = spark.createDataFrame([(1, svg)], "rec_id long, svg string")
    assert "id=" not in C.clean_corpus(rows).first().stage2  # nothing refers to it
    out = C.clean_corpus(rows, cleanup_ids=False).first().stage2
    assert "secret" not in out and "M0 0" not in out and "<g" not in out and "<defs" not in out
    assert 'fill="#FF0000"' in out and "class=" not in out and 'id="p&#233;"' in out


def test_normalize_lengths_gradients_and_links(spark):
    svg = ('<svg xmlns="http://www.w3.org/2000/svg" xmlns:xlink="http://www.w3.org/1999/xlink" viewBox="0 0 128 128"><linearGradient id="g"/>'
           '<radialGradient cx="50%" cy="50%" r="50%"/><use xlink:href="#g"/><path d="M0 0L1 1" stroke="red" style="fill:red;stroke-width:3"/>'
           '<path transform="rotate(90)" d="M0 0L1 1" stroke-width="2"/></svg>')
    rows = spark.createDataFrame([(1, svg), (2, '<svg viewBox="0 0 0 0"><path d="M0 0L10 10L20 20L30 30Z" fill="red"/></svg>')], "rec_id long, svg string")
    got = {r.rec_id: r for r in N.normalize_corpus(rows).collect()}
    out = got[1].svg_out
    assert '<linearGradient id="g"/>' in out and 'cx="50%"' in out and 'href="#g"' in out and "xlink" not in out
    assert 'stroke-width="2"' in out and "stroke-width:6" in out and 'stroke-width="4"' in out
    assert (got[2].status, got[2].reason) == ("rejected", "empty canvas")


def test_style_block_is_written_back(spark):
    svg = ('<svg viewBox="0 0 128 64"><style>/* c */ .a, .b{stroke:red;fill:url(http://x/y;z#q)} rect{x:1} .b{stroke-width:2px;font-size:bad}\n'
           '.c{width:3;x:1;x:2}</style><style><![CDATA[.d{content:"a&b";line-height:1.5}]]></style><style> </style><g stroke="red" transform="scale(3)">'
           '<path d="M0 0L1 1" stroke="blue"/></g><path d="M0 0" style="fill:url(http://u/v;w#x);stroke-width:1"/></svg>')
    out = N.normalize_corpus(spark.createDataFrame([(1, svg)], "rec_id long, svg string")).first().svg_out
    assert ("<style>.a{stroke:red;fill:url(http://x/y;z#q);stroke-width:2}\n.b{stroke:red;fill:url(http://x/y;z#q);stroke-width:4;font-size:bad}\n"
            ".c{width:6;x:4}</style>") in out
    assert '<style>.d{content:"a&amp;b";line-height:3}</style><style> </style>' in out
    # a group's default stroke scales by the canvas alone, a shape's by its matrix too
    assert '<g stroke="red" stroke-width="2">' in out and 'stroke="blue" stroke-width="6"' in out
    assert "fill:url(http://u/v;w#x);stroke-width:2" in out


def test_unused_definitions_and_shared_paths(spark):
    svg = ('<svg xmlns="http://www.w3.org/2000/svg"><defs><linearGradient id="a" href="#b"/><linearGradient id="b"/><linearGradient id="c" href="#d"/>'
           '<linearGradient id="d" href="#c"/></defs><path id="z" d="M0 0L1 1" fill="url(#a)"/><path d="M0 0L1 1" x="4" fill="red"></path>'
           '<path d="M2 2L1 1"/><text> </text><text>t</text></svg>')
    keep = '<svg><style>rect.k{fill:red}</style><rect class="k" width="1" height="1"/><path id="u" d="M0 0L9 9"/><use href="#u"/></svg>'
    got = {r.rec_id: r.stage2 for r in C.clean_corpus(spark.createDataFrame([(1, svg), (2, keep)], "rec_id long, svg string")).collect()}
    one = got[1]
    assert 'id="a"' in one and 'id="b"' in one and 'id="c"' not in one and 'id="d"' not in one and 'id="z"' not in one
    name = one.split('<path id="')[1].split('"')[0]
    assert name.startswith("reuse-") and one.count(f'<use href="#{name}"') == 2 and one.count('d="M0 0L1 1"') == 1
    assert one.startswith("<svg><defs><path id=") and "x=" not in one and 'd="M2 2L1 1"' in one
    assert "<text>t</text>" in one and one.count("<text>") == 1
    assert 'class="k"' in got[2] and 'id="u"' in got[2] and 'href="#u"' in got[2]


def test_order_of_attributes(spark):
    el = spark.createDataFrame([(1, {"zoom": "1", "fill-rule": "e", "a": "2", "points": "p", "fill": "f", "id": "i", "X": "3", "x:y": "4", "xmlns:x": "u", "xmlns": "v"})], "rec_id long, attrs map<string,string>")
    assert C.sort_attrs(el).select(F.map_keys("attrs").alias("k")).first().k == ["xmlns", "xmlns:x", "x:y", "id", "X", "fill", "fill-rule", "points", "a", "zoom"]
