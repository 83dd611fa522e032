"""Tokens, elements and markup of records read as lists: against a stack, with rows that share a key, and without sorting tokens."""

import random

import pytest

import __spark_entry__ as E
from svgspark.operators import normalize as N
from svgspark.operators import tree as T

PIECES = ["<a>", "<b k='1'>", "</a>", "</b>", "<c/>", "text", "<!-- <a> -->", "<?p ?>", "<![CDATA[<a>]]>", "<!DOCTYPE a>", "<é>", "</é>", "< >"]


def stacked(texts):
    """(pos, tok, depth, close_pos) by a walk over the tokens of all texts of a key, place by place."""
    rows = sorted((pos, i, tok) for i, text in enumerate(texts) for pos, tok in enumerate(text))
    level, found, open_at = 0, [], {}
    for pos, _, tok in rows:
        tag = tok.startswith("<") and tok[1] not in "!?"
        closes, empty = tag and tok.startswith("</"), tag and tok.endswith("/>") and not tok.startswith("</")
        level -= closes
        found.append([pos, tok, level, None])
        if closes and level in open_at:
            found[open_at.pop(level)][3] = pos
        if tag and not closes and not empty:
            open_at[level] = len(found) - 1
            level += 1
    return sorted((tuple(r) for r in found), key=str)


def test_tokens_are_those_of_a_stack(spark):
    rng = random.Random(3)
    texts = {k: [[]] for k in range(60)}
    for k in texts:
        for _ in range(rng.randrange(40)):
            last = texts[k][0][-1:]
            texts[k][0].append(rng.choice([p for p in PIECES if [p] != ["text"] or last != ["text"]]))
    for k in (3, 7):
        texts[k] = texts[k] * 2  # a key that comes twice
    rows = [(k, "".join(t)) for k, some in texts.items() for t in some] + [(99, None), (98, "")]
    got = {k: [] for k in texts}
    for r in T.svg_tokens(spark.createDataFrame(rows, "rec_id long, svg string")).collect():
        got[r.rec_id].append((r.pos, r.tok, r.depth, r.close_pos))
    for k, some in texts.items():
        assert sorted(got[k], key=str) == stacked(some), some


def test_markup_takes_elements_and_texts_at_their_places(spark):
    docs = spark.createDataFrame([(1, "<a><b x='1'/>t<c>u</c><d/></a>"), (2, "<a/>"), (3, "<!-- -->")], "rec_id long, svg string")
    tk = T.svg_tokens(docs)
    el = spark.createDataFrame([(1, 0, 8, "A", {"k": "&"}), (1, 1, 1, "B", {}), (1, 3, 5, "C", {}), (1, 90, 91, "no", {}), (4, 0, 0, "no", {})],
                               "rec_id long, open_pos int, close_pos int, new_tag string, new_attrs map<string,string>")
    texts = spark.createDataFrame([(1, 4, "new"), (1, 2, None)], "rec_id long, pos int, new_text string")
    added = spark.createDataFrame([(1, 0, 2, "second"), (1, 0, 1, "first")], "rec_id long, pos int, ord int, piece string")
    got = {r.rec_id: r.svg_out for r in N.svg_text(tk, el, new_texts=texts, added=added).collect()}
    end = 7  # the closing tag of <a>, which no element here ends at
    assert [r.pos for r in tk.where("rec_id = 1 AND kind = 'close'").collect()] == [5, end]
    assert got == {1: '<A k="&amp;">firstsecond<B/>t<C>new</C></a>', 2: ""}


@pytest.mark.parametrize("name", ["svg_tokens", "svg_elements", "lower_attrs", "svg_text"])
def test_tokens_are_not_sorted(spark, name, capsys):
    E.queries()[name](spark, "/root/testdata/sf0.001").explain()
    plan = capsys.readouterr().out
    # the one window is that of declared prefixes; the sorts left are of records
    assert plan.count("+- Window") <= 2 and "pos#" not in "".join(x for x in plan.splitlines() if "- Sort " in x and "prefix" not in x)
    assert "SortMergeJoin" not in plan or name == "svg_text"


def test_record_files_have_no_companions(spark, tmp_path):
    from pathlib import Path

    from svgspark.plans.mining import _svg_files

    spark.range(40).selectExpr("id AS p_partkey").write.parquet(f"{tmp_path}/part.parquet")
    folder = _svg_files(spark, str(tmp_path)).removeprefix("file://").removeprefix("file:")
    found = [p.name for p in Path(folder).rglob("*") if p.is_file() and p.name != "_SUCCESS"]
    # one file a record, without the checksum files that double what is made and listed
    assert len(found) == 40 and not any(n.endswith(".crc") for n in found)
    assert E.queries()["svg_dir_scan"](spark, str(tmp_path)).count() == 40


def test_elements_without_a_matrix_may_be_left_out(spark):
    from pyspark.sql import functions as F

    svg = '<svg><g transform="translate(1 0)"/><g><path transform="translate(0 2)"/></g><g transform="scale(2)"><g><path transform="translate(3 4)"/></g></g></svg>'
    el = T.lower_attrs(T.svg_elements(T.svg_tokens(spark.createDataFrame([(1, svg)], "rec_id long, svg string"))))
    for some in (el, el.where("size(attrs) > 0")):
        m = N.effective_transform(some.withColumn("m_local", N.local_matrix()), "rec_id").where(F.col("tag") == "path").orderBy("open_pos")
        assert [(r.m_eff.a, r.m_eff.e, r.m_eff.f) for r in m.collect()] == [(1.0, 0.0, 2.0), (2.0, 6.0, 8.0)]


def test_elements_are_not_joined_to_their_counts(spark, capsys):
    from svgspark.operators import clean as K

    docs = spark.createDataFrame([(1, "<svg><g><g/></g><g><path d='M0 0'/></g><defs><path/></defs><g><image/></g></svg>")], "rec_id long, svg string")
    el = T.definition_units(T.lower_attrs(T.svg_elements(T.svg_tokens(docs))))
    out = K.drop_empty(el)
    assert sorted((r.open_pos, r.drop_reason) for r in out.collect()) == [
        (1, "empty container"), (2, "empty container"), (7, "empty container"), (8, "unused definition"), (10, "empty container"), (11, "raster image")]
    out.explain()
    # the elements are made ready once for the counts, not again to take them back
    assert capsys.readouterr().out.count("sum(") <= 2
