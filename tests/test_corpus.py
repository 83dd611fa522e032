"""The corpus job: both stages, errors of either, store and log; a table made once for the same input files."""

import hashlib
import json

import __spark_entry__ as E
from svgspark.operators import clean as K
from svgspark.operators import corpus as C
from svgspark.operators import normalize as N
from svgspark.session import once, scratch_dir
from svgspark.sources import sinks

from conftest import SF_SMALL

GOOD = '<svg xmlns="http://www.w3.org/2000/svg" version="1.1" viewBox="0 0 64 32"><!-- c --><title>t</title><rect x="1" y="2" width="3" height="4" fill="red"/></svg>'


def md5(x):
    return hashlib.md5(x.encode()).hexdigest()


def test_stages_store_and_log(spark, tmp_path):
    torn = GOOD.replace("</svg>", "</g>")
    rows = [(1, "a/1.svg", GOOD), (2, "a/2.svg", torn), (3, "b/3.svg", "<svg/>"), (4, "b/4.svg", None), (5, "b/5.svg", GOOD), (6, "b/6.svg", "")]
    raw = spark.createDataFrame(rows, "rec_id long, filename string, svg string")
    run = C.optimize_corpus(raw)
    out1 = N.normalize_corpus(raw.where("rec_id = 1").select("rec_id", "svg")).first().svg_out
    out2 = K.clean_corpus(spark.createDataFrame([(1, out1)], "rec_id long, svg string")).first().stage2
    got = {r.rec_id: (r.raw, r.stage1, r.stage2, r.error) for r in run.lineage.collect()}
    assert got[1] == got[5] == (md5(GOOD), md5(out1), md5(out2), None) and len({md5(GOOD), md5(out1), md5(out2)}) == 3
    assert got[2][:3] == (md5(torn), None, None) and got[2][3].startswith("Stage-1 optimization failed: ")
    assert [got[i][3] for i in (3, 4, 6)] == ["Stage-1 optimization failed: " + x for x in ("too short", "empty", "empty")]
    outcomes = {r.grp: (r.successful, r.failed, r.empty_stage2) for r in C.outcome_counts(run.lineage).collect()}
    assert outcomes == {"a": (1, 1, 0), "b": (1, 3, 0)}
    sizes = {r.stage: (r.chars_before, r.chars_after) for r in C.stage_sizes(run.texts).collect()}
    assert sizes == {"stage1": (2 * len(GOOD), 2 * len(out1)), "stage2": (2 * len(GOOD), 2 * len(out2))}
    try:
        for _ in range(2):  # a second run adds nothing to the store
            sinks.corpus_sink(run, "corpus_test_store", str(tmp_path / "store"), str(tmp_path / "log"), buckets=4)
        held = [(r.hash, r.svg) for r in spark.table("corpus_test_store").collect()]
    finally:
        spark.sql("DROP TABLE IF EXISTS corpus_test_store")
    assert sorted(held) == sorted((md5(x), x) for x in (GOOD, torn, "<svg/>", "", out1, out2))
    logged = [json.loads(line) for f in (tmp_path / "log").glob("*.json") for line in f.read_text().splitlines()]
    assert sorted(r["rec_id"] for r in logged) == [1, 1, 5, 5] and all(r["stage2"] == md5(out2) and "error" not in r for r in logged)


def test_stage_two_says_what_it_refuses(spark):
    docs = spark.createDataFrame([(1, "<svg><g></svg>"), (2, GOOD), (3, "")], "rec_id long, svg string")
    got = {r.rec_id: (r.stage2 is None, r.reason) for r in K.clean_corpus(docs).collect()}
    assert got == {1: (True, "mismatched tag"), 2: (False, None), 3: (True, None)}


def test_no_records(spark):
    run = C.optimize_corpus(spark.createDataFrame([], "rec_id long, filename string, svg string"))
    assert run.lineage.isEmpty() and run.texts.isEmpty() and C.stage_sizes(run.texts).isEmpty()


def test_registered_job(spark):
    q = E.queries()
    rows = q["corpus_job"](spark, SF_SMALL).collect()
    assert len(rows) == spark.read.parquet(f"{SF_SMALL}/part.parquet").count()
    for r in rows:
        assert r.logged == (r.error is None) == (r.stage1 is not None)
        assert r.n_stored == sum(x is not None for x in (r.raw, r.stage1, r.stage2))
    outcomes = q["corpus_outcomes"](spark, SF_SMALL).collect()
    assert sum(r.successful for r in outcomes) == sum(r.error is None for r in rows) > 0
    assert sum(r.failed for r in outcomes) == sum(r.error is not None for r in rows) > 0
    assert {r.stage for r in q["corpus_sizes"](spark, SF_SMALL).collect()} == {"stage1", "stage2"}


def test_made_once_for_the_same_files(spark, tmp_path):
    path, made = str(tmp_path / "t"), []
    write = lambda folder: (made.append(folder), spark.range(1).write.parquet(folder))
    spark.range(3).write.parquet(path)
    first = once(spark, "t", [path], write)
    assert once(spark, "t", [path], write) == first and made == [first]
    spark.range(4).write.mode("overwrite").parquet(path)
    assert once(spark, "t", [path], write) != first and len(made) == 2
    assert scratch_dir(spark, "t") not in made
