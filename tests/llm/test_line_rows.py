"""Rows that repeat are documents each: the operator, its SQL and plain Python."""

import collections
import contextlib
import io
import os
import sys

import duckdb
import pyarrow as pa
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402

from svgspark.llm import line_dedup  # noqa: E402


def test_ten_identical_rows(spark):
    rows = [(1, "same\nown line\nsame")] * 10 + [(2, "nine")] * 9 + [(3, "OWN line\nlast")]
    documents = pa.table({"doc_id": [i for i, _ in rows], "text": [t for _, t in rows]})  # noqa: F841
    sql = collections.Counter(duckdb.sql(line_dedup.ORACLE).fetchall())
    got = collections.Counter(tuple(r) for r in line_dedup.op8(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == sql
    assert got == collections.Counter((i, n, gone, brute.sha(kept)) for (i, _), (n, gone, kept) in zip(rows, brute.lines(rows)))
    assert got[1, 3, 3, brute.sha("")] == 10 and got[2, 1, 0, brute.sha("nine")] == 9 and got[3, 2, 1, brute.sha("last")] == 1


def exchanges(df):
    """Exchanges of a plan before it runs."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    plan = out.getvalue()
    return [line for line in plan.splitlines() if "Exchange" in line and ("+-" in line or ":-" in line)], plan


def test_runs_are_not_shuffled(spark):
    runs = line_dedup.LineRuns(spark, 3)
    batch = spark.createDataFrame([(k, -k, d) for k in range(9) for d in range(k)], "h1 long, h2 long, doc long")
    counts = batch.groupBy("h1", "h2").agg(F.count("*").alias("n"))
    left, right = runs._write(counts, 0), runs._write(counts.where("h1 % 2 = 0"), 0)
    try:
        found, plan = exchanges(runs.merged(left, right))
        assert not found and plan.count("Bucketed: true") == 2
        assert sorted(map(tuple, runs.merged(left, right).collect())) == sorted((k, -k, k * (2 - k % 2)) for k in range(1, 9))
        runs.levels = [[left, right]]
        found, plan = exchanges(runs.unknown(counts))
        assert len(found) == 1 and plan.count("Bucketed: true") == 2  # that of the counts themselves
        assert sorted(r.h1 for r in runs.unknown(counts).collect()) == [1, 2]
        assert sorted(map(tuple, runs.common().collect())) == sorted((k, -k, k * (2 - k % 2)) for k in range(1, 9) if k * (2 - k % 2) >= 3)
    finally:
        runs.close()
    assert not any(t.name.startswith("line_run") for t in spark.catalog.listTables())


def test_keys_beyond_the_broadcast(spark, monkeypatch):
    """A key is broadcast or joined by bucket, whatever the limit: the lines are the same."""
    rows = [(i, f"Hot\n{i % 12}\n{i}") for i in range(240)]
    want = sorted(brute.lines(rows))
    for limit in (1, 2, 65_536):
        monkeypatch.setattr(line_dedup, "HOT_KEYS", limit)
        out = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
        assert sorted((r.n_lines, r.n_dropped, r.kept) for r in out.collect()) == want
