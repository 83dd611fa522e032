"""Streams: late rows and a flush row over several files, stopped and replayed upserts, the bucketed store."""

import datetime as dt
import os

from pyspark.sql import functions as F

from svgspark.operators import corpus as C
from svgspark.sources import sinks
from svgspark.streaming import stream as ST
from svgspark.streaming.keyed import KeyedTable

from test_pruning import plan_of

T0 = dt.datetime(2024, 1, 1, 12, 0)
SCHEMA = "hash string, ts timestamp"


def put(spark, root, k, rows, schema=SCHEMA):
    """File number k of a feed: files are read in the order of their times of change."""
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(root)
    for f in set(os.listdir(root)) - before:
        os.utime(f"{root}/{f}", (1_000_000_000 + k, 1_000_000_000 + k))


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def test_new_per_minute_drops_late_rows(spark, tmp_path):
    src, out, cp = (str(tmp_path / p) for p in ("src", "out", "cp"))
    put(spark, src, 0, [("a", at(0)), ("b", at(0.5)), ("a", at(0.7)), ("c", at(20))])
    put(spark, src, 1, [("d", at(15)), ("b", at(21)), (None, at(21))])  # within the delay; repeated
    put(spark, src, 2, [("late", at(1)), ("e", at(22))])  # a batch drops what was late when the batch before it ended
    put(spark, src, 3, [("a", at(500))])  # a known key: only the watermark moves
    schema = spark.read.parquet(src).schema
    ST.run_available_now(ST.stream_new_per_minute(ST.stream_source(spark, src, schema), "10 minutes"), out, cp, timeout_s=300)
    got = {r.minute: r.n_new for r in spark.read.parquet(out).collect()}
    assert got == {at(0): 2, at(20): 1, at(15): 1, at(21): 1, at(22): 1}


def test_stopped_run_equals_one_run(spark, tmp_path):
    urls = [[("u1",), ("u2",), ("u1",)], [("u2",), ("u3",), (None,)], [("u1",), (None,)]]

    def run(name, stops):
        src, cp = str(tmp_path / f"{name}-src"), str(tmp_path / f"{name}-cp")
        table = None
        for k, rows in enumerate(urls):
            put(spark, src, k, rows, "url string")
            if k in stops:
                counts = ST.stream_counts(ST.stream_source(spark, src, spark.read.parquet(src).schema), "url")
                table = KeyedTable(spark, str(tmp_path / f"{name}-table"), ["url"], counts.schema, compact_every=2)
                ST.upsert_available_now(counts, table, cp, timeout_s=300)
        return {(r.url, r.n) for r in table.read().collect()}

    assert run("one", {2}) == run("stopped", {0, 2}) == run("each", {0, 1, 2}) == {("u1", 3), ("u2", 2), ("u3", 1), (None, 2)}


def test_replayed_batch_changes_nothing(spark, tmp_path):
    schema = spark.createDataFrame([], "k string, n long").schema
    table = KeyedTable(spark, str(tmp_path / "t"), ["k"], schema, compact_every=2)
    assert table.read().collect() == []
    batches = [[("a", 1), ("b", 1)], [("a", 2)], [("c", 1)], [("b", 5)], [("a", 9)]]
    want = {}
    for epoch, rows in enumerate(batches):
        want |= dict(rows)
        for _ in range(2):
            table.write(spark.createDataFrame(rows, schema), epoch)
            assert dict(map(tuple, table.read().collect())) == want
    table.write(spark.createDataFrame(batches[1], schema), 1)  # older than the base
    assert dict(map(tuple, table.read().collect())) == want
    assert sorted(os.listdir(tmp_path / "t")) == ["base=1", "base=3", "batch=2", "batch=3", "batch=4"]


def test_a_run_torn_in_compaction_is_read_whole(spark, tmp_path):
    schema = spark.createDataFrame([], "k string, n long").schema
    table = KeyedTable(spark, str(tmp_path / "t"), ["k"], schema, compact_every=2)
    table.write(spark.createDataFrame([("a", 1)], schema), 0)
    os.makedirs(tmp_path / "t" / "base=1")  # no _SUCCESS: its job was lost
    assert dict(map(tuple, table.read().collect())) == {"a": 1}
    table.write(spark.createDataFrame([("a", 2)], schema), 1)
    assert dict(map(tuple, table.read().collect())) == {"a": 2}


def test_store_append_leaves_the_store_in_place(spark, tmp_path):
    path, table = str(tmp_path / "store"), "store_in_place"

    def rows(*texts):
        return C.store_rows(spark.createDataFrame([(t,) for t in texts], "text string"))

    try:
        sinks.content_store_sink(rows("a", "b", "b"), table, path, buckets=4)
        sinks.content_store_sink(rows("b", "c"), table, path, buckets=4)
        assert sorted(r.svg for r in spark.table(table).collect()) == ["a", "b", "c"]
        assert sinks.bucket_count(spark, table) == 4
        plan = plan_of(C.new_for_store(rows("c", "d"), spark.table(table), 4))
        exchanges = [line for line in plan.splitlines() if line.startswith("Arguments: hashpartitioning")]
        assert "Bucketed: true" in plan and "REPARTITION_BY_NUM" in plan
        # the new rows: one by hash to make them distinct, one to the buckets; none for the store
        assert len([line for line in exchanges if ", 4)" in line]) == 1 and len(exchanges) == 2, plan
        spark.sql(f"DROP TABLE {table}")  # another session's catalog
        sinks.content_store_sink(rows("a", "e"), table, path, buckets=4)
        assert sorted(r.svg for r in spark.table(table).collect()) == ["a", "b", "c", "e"]
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_mined_records_carry_their_time(spark, tmp_path):
    mined = spark.createDataFrame([("ab1", "ab", "u", "<svg/>")], "hash string, shard string, url string, svg string")
    for k, (ts, like) in enumerate([(None, r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}$"), (F.lit("2024-01-01T00:00:00"), "^2024-01-01T00:00:00$")]):
        sinks.shard_sink(mined, str(tmp_path / str(k)), ts)
        assert spark.read.json(str(tmp_path / str(k))).where(F.col("timestamp").rlike(like)).count() == 1
