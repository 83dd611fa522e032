"""What goes through the driver or one task: joins of exploded markup are not broadcast, markup is made by many tasks."""

import pytest

import __spark_entry__ as E
from svgspark.sources import tables
from svgspark.sources.tables import ROWS_PER_TASK, tasks, view


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("sf"))
    spark.range(2 * ROWS_PER_TASK + 1).selectExpr("id AS p_partkey").coalesce(1).write.parquet(f"{folder}/part.parquet")
    spark.range(60).selectExpr("id AS doc_id", "concat('caption: a word ', id) AS text").write.parquet(f"{folder}/documents.parquet")
    spark.range(40).selectExpr("id AS page_id", "concat('http://h/', id) AS url", "'<article></article>' AS html").write.parquet(f"{folder}/pages.parquet")
    return folder


def test_markup_is_made_by_tasks_that_grow_with_the_keys(spark, sf):
    assert tasks(spark, sf, "part") == 3
    for name in ("svg_raw", "svg_geom", "svg_defs", "stage_out"):
        assert view(spark, sf, name).rdd.getNumPartitions() == 3


@pytest.mark.parametrize("name", [
    "caption_clean", "caption_merge", "caption_report", "caption_job", "chat_format_infer", "pair_captions"])
def test_captions_are_not_broadcast(spark, sf, name, capsys):
    E.queries()[name](spark, sf).explain()
    plan = capsys.readouterr().out
    # batches are numbered by 16**3 buckets at most: these offsets are the only thing sent to all
    assert plan.count("BroadcastExchange") == (2 if name == "caption_report" else 0)
    assert "SortMergeJoin" in plan


@pytest.mark.parametrize("name", ["svg_pages", "assets"])
def test_pages_are_not_sent_to_their_icons(spark, sf, name, capsys):
    # html that compresses well: the planner sizes the table like its file
    view(spark, sf, name).explain()
    plan = capsys.readouterr().out
    sent = plan[plan.index("BroadcastExchange"):].split("- FileScan")[1].splitlines()[0]
    assert plan.count("BroadcastExchange") == 1 and "p_partkey" in sent and "page" not in sent


@pytest.mark.parametrize("name", ["svg_pages", "fetch_log"])
def test_pages_are_dealt_to_tasks_that_grow_with_them(spark, sf, name, monkeypatch):
    monkeypatch.setattr(tables, "PAGES_PER_TASK", 15)
    out = view(spark, sf, name)
    assert out.rdd.getNumPartitions() == 3
    assert {r.page_id for r in out.select("page_id").collect()} == set(range(40))


@pytest.mark.parametrize("name,icons", [("html_response", 1), ("join_assets", 2), ("shard_counts", 2)])
def test_only_icons_are_sent_to_pages(spark, sf, name, icons, capsys):
    E.queries()[name](spark, sf).explain()
    assert capsys.readouterr().out.count("BroadcastExchange") == icons


def test_stream_joins_assets_without_sending_them(spark, sf, capsys):
    from svgspark.plans.streaming import _mine_stream

    _mine_stream(spark, sf).explain()
    plan = capsys.readouterr().out
    # the assets are read from a table written once: none of their markup is made in a micro-batch
    assert "Broadcast" not in plan and "p_partkey" not in plan


def test_known_hashes_are_not_broadcast(spark, sf, capsys):
    E.queries()["anti_known"](spark, sf).explain()
    joins = [line for line in capsys.readouterr().out.splitlines() if "LeftAnti" in line]
    assert joins and all("SortMergeJoin" in line for line in joins)


@pytest.mark.parametrize("name", [
    "wellformed", "ancestor_join", "canvas_box", "canvas_scale", "round_numbers", "sort_attrs", "normal_colors", "style_to_attrs",
    "reuse_paths", "path_commands", "augment_fill", "augment_svg", "arc_to_cubic", "to_cubic", "shape_to_path", "subpath_close",
    "apply_transform", "stroke_default", "svg_text", "unreferenced_ids", "drop_empty", "class_rules"])
def test_exploded_markup_is_not_broadcast(spark, sf, name, capsys):
    E.queries()[name](spark, sf).explain()
    assert "Broadcast" not in capsys.readouterr().out


def test_prefixes_of_empty_and_nested_elements(spark):
    from svgspark.operators import tree as T

    rows = [(1, '<a xmlns:p="u"><p:b/><p:c><d/></p:c></a>', False), (2, '<a><b xmlns:p="u"/><p:b/></a>', True),
            (3, '<a><b xmlns:p="u"><c/></b><p:b/></a>', True), (4, '<a><p:b xmlns:p="u"/></a>', False),
            (5, '<a xmlns:p="u"><b xmlns:p="v"/><p:c/></a>', False), (6, '<a><p:b/></a>', True), (7, '<xml:a/>', False)]
    docs = spark.createDataFrame([r[:2] for r in rows], "rec_id long, svg string")
    got = {r.rec_id for r in T.unbound_prefixes(T.svg_tokens(docs)).collect()}
    assert got == {k for k, _, unbound in rows if unbound}


def test_texts_are_not_made_again_for_their_tokens(spark, capsys):
    from svgspark.operators import clean as K

    # the filter can be told from the key, so the planner would ask it of every row that joins by the key
    docs = spark.range(1, 4).selectExpr("id AS rec_id", "concat('<svg><path d=\"M0 ', id, '\"/>', repeat('<g/>', CAST(id AS INT)), '</svg>') AS svg").where("length(svg) > 1")
    out = K.clean_corpus(docs)
    out.explain()
    assert "repeat(" not in capsys.readouterr().out
    assert {r.rec_id: r.stage2 for r in out.collect()} == {i: f'<svg><path d="M0 {i}"/></svg>' for i in (1, 2, 3)}
