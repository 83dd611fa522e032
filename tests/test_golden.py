"""Hand-written expected rows (SVG / URL specifications) for the keys without an SQL oracle."""

import os

from pyspark.sql import functions as F

from svgspark.functions.url import resolve_url
from svgspark.operators import geom as G
from svgspark.operators.corpus import size_reduction
from svgspark.sources import scans

PATHS = {
    "M1 2l3-4.5.5z": "M 1 2 L 4 -2.5 L 1 2Z",
    "M0 0 H10 V10 H0 Z": "M 0 0 L 10 0 L 10 10 L 0 10 L 0 0Z",
    "M0 0 C1 1 2 1 3 0 S5 -1 6 0": "M 0 0 C 1 1 2 1 3 0 C 4 -1 5 -1 6 0",
    "M0 0 Q1 1 2 0 T4 0": "M 0 0 Q 1 1 2 0 Q 3 -1 4 0",
    "M0 0 L1 0 1 1": "M 0 0 L 1 0 L 1 1",
    "M0 0 L1 1 L0 0.000001": "M 0 0 L 1 1 L 0 0Z",
    "M0 0 L1 1 m5 5 l1 0 z": "M 0 0 L 1 1 M 6 6 L 7 6 L 6 6Z",
    "M0 0 A1 1 0 0 1 2 0": "M 0 0 C 0 -0.552 0.448 -1 1 -1 C 1.552 -1 2 -0.552 2 0",
    "": "",
}


def texts_of(spark, paths, scale=1.0, **options):
    df = spark.createDataFrame(list(enumerate(paths)), "open_pos int, d string").withColumn("m", G.identity()).withColumn("s", F.lit(scale).cast("double"))
    got = {r.open_pos: r.path_d for r in G.path_texts(df, ["open_pos"], **options).collect()}
    return [got.get(k) for k in range(len(paths))]


def test_path_text_golden(spark):
    assert texts_of(spark, PATHS, cubic_only=False) == list(PATHS.values())
    assert texts_of(spark, ["M0 0 L3 0 Q 0 3 3 3z"], 2.0) == ["M 0 0 C 2 0 4 0 6 0 C 2 4 2 6 6 6 C 4 4 2 2 0 0Z"]
    # each subpath keeps its own end, an arc without a radius is a line, and one between equal points draws nothing
    assert texts_of(spark, ["M0 0L1 1zM5 5L6 6", "M0 0A0 1 0 0 1 3 4", "M1 1A2 2 0 0 1 1 1L2 2"], cubic_only=False) == [
        "M 0 0 L 1 1 L 0 0Z M 5 5 L 6 6", "M 0 0 L 3 4", "M 1 1 L 2 2"]
    assert texts_of(spark, ["M0 0L1e400 0", "M0 0L1 1"]) == [None, "M 0 0 C 0.333 0.333 0.667 0.667 1 1"]
    assert texts_of(spark, ["M0 0L1 1"], None) == [None]
    assert texts_of(spark, ["M0.4 0.6L1.9 -1.9"], cubic_only=False, to_int=True) == ["M 0 0 L 1 -1"]


def test_transform_golden(spark):
    rows = {"translate(1 2)": (1, 0, 0, 1, 1, 2), "scale(2)": (2, 0, 0, 2, 0, 0), "translate(1) scale(2,3)": (2, 0, 0, 3, 1, 0),
            "matrix(1 2 3 4 5 6)": (1, 2, 3, 4, 5, 6), "rotate(90 1 1)": (0, 1, -1, 0, 2, 0)}
    df = spark.createDataFrame([(k,) for k in rows], "t string").select("t", G.parse_transform("t").alias("m"))
    for r in df.collect():
        got = tuple(round(r["m"][k], 9) + 0.0 for k in "abcdef")
        assert got == tuple(float(x) for x in rows[r["t"]]), r["t"]


def test_resolve_url_golden(spark):
    cases = [("http://a.com/b/c/page.html", "http://x.org/i.svg", "http://x.org/i.svg"),
             ("https://a.com/b/c", "//cdn.net/x.svg", "https://cdn.net/x.svg"),
             ("http://a.com/b/c", "/x.svg", "http://a.com/x.svg"),
             ("http://a.com/b/c", "x.svg", "http://a.com/b/x.svg"),
             ("http://a.com/b/c/d", "../x.svg", "http://a.com/b/x.svg"),
             ("http://a.com/b/c?q=1", "?z=2", "http://a.com/b/c?z=2"),
             ("http://a.com/b/c?q=1#f", "#g", "http://a.com/b/c?q=1#g"),
             ("http://a.com", "x.svg", "http://a.com/x.svg")]
    df = spark.createDataFrame(cases, "page string, ref string, want string")
    for r in df.select("want", resolve_url("page", "ref").alias("got")).collect():
        assert r["got"] == r["want"]


def test_size_golden(spark):
    df = spark.createDataFrame([("x" * 648, "y" * 343)], "raw string, stage2 string")
    r = size_reduction(df, "raw", ["stage2"]).collect()[0]
    assert (r["chars_before"], r["chars_after"], round(r["pct_saved"] * 100)) == (648, 343, 47)


def test_svg_dir_scan(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "1.svg").write_text("<svg/>")
    (tmp_path / "2.svg").write_text("<svg></svg>")
    (tmp_path / "note.txt").write_text("x")
    rows = {(r["grp"], r["svg"]) for r in scans.svg_dir_scan(spark, str(tmp_path)).collect()}
    assert rows == {("a", "<svg/>"), ("", "<svg></svg>")}


def test_jsonl_scan_drops_corrupt(spark, tmp_path):
    p = tmp_path / "c.jsonl"
    p.write_text('{"hash":"h1","caption":"a cat","source":"m","prompt":"p"}\n{"hash":"h2","cap\n'
                 '{"hash":"h3","caption":"a dog","source":"m","prompt":"p"}\n')
    rows = sorted(r["hash"] for r in scans.jsonl_scan(spark, str(p), scans.CAPTION_SCHEMA).collect())
    assert rows == ["h1", "h3"]


def test_hash_algorithms(spark):
    from svgspark.functions.text import content_hash
    import hashlib
    import pytest

    r = spark.createDataFrame([("é<svg/>",)], "s string").select(content_hash("s").alias("m"), content_hash("s", "sha256").alias("h")).first()
    assert r["m"] == hashlib.md5("é<svg/>".encode()).hexdigest()
    assert r["h"] == hashlib.sha256("é<svg/>".encode()).hexdigest()
    with pytest.raises(ValueError):
        content_hash("s", "blake9")
    assert os.path.sep


def test_hash_files(spark, tmp_path):
    import hashlib

    (tmp_path / "x.svg").write_bytes(b"<svg>\xc3\xa9</svg>")
    r = scans.hash_files(spark, str(tmp_path), "*.svg").first()
    assert r["hash"] == hashlib.md5(b"<svg>\xc3\xa9</svg>").hexdigest()


def test_captions_by_a_model_function(spark):
    """The function sees the prompts in batches; its answers go through the caption job, empty ones are not kept."""
    from svgspark.operators import caption as P

    items = spark.createDataFrame([(f"h{i}", f"<svg>{i}</svg>") for i in range(50)], "hash string, svg string")
    prompts = {r.hash: r.prompt for r in P.prompt_assign(items).collect()}

    def model(pdf):
        return "Caption: " + pdf["prompt"].str.len().astype(str).where(pdf["svg"] != "<svg>7</svg>", "  ")

    answers = P.model_hook(P.prompt_assign(items), model)
    got = {r.hash: (r.caption, r.source, r.prompt, r.kept) for r in P.caption_job(items, answers, "m").collect()}
    assert got == {h: ("" if h == "h7" else str(len(p)), "m", p, h != "h7") for h, p in prompts.items()}
    assert P.model_hook(P.prompt_assign(items.limit(0)), model).isEmpty()


def test_groups_that_share_a_prefix(spark):
    from svgspark.operators import select as S

    df = spark.range(3000).selectExpr("concat('long-common-prefix-', lpad(id % 700, 4, '0'), '/', id, '.svg') AS filename")
    got = S.dir_group_order(df).collect()
    want = sorted({f"long-common-prefix-{i:04d}" for i in range(700)})
    assert sorted((r.grp_order, r.grp) for r in got) == list(enumerate(want, 1)) and sum(r.n_files for r in got) == 3000
