"""Partition pruning of the split and shard scans, and what mining leaves out for its length."""

import contextlib
import io

from pyspark.sql import functions as F

from svgspark.operators import mine as M
from svgspark.sources import scans


def plan_of(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_split_scan_prunes(spark, tmp_path):
    root = str(tmp_path / "t")
    spark.range(30).select("id", F.element_at(F.array(F.lit("b"), F.lit("train"), F.lit("a")), (F.col("id") % 3 + 1).cast("int")).alias("split")) \
        .write.partitionBy("split").parquet(root)
    df = scans.split_scan(spark, root)
    assert {r.split for r in df.collect()} == {"train"} and df.count() == 10
    assert "PartitionFilters: [isnotnull(split" in plan_of(df) and "= train)" in plan_of(df)
    assert {r.split for r in scans.split_scan(spark, root, preferred="none").collect()} == {"a"}


def test_shard_scan_prunes(spark, tmp_path):
    root = str(tmp_path / "s")
    spark.range(64).select("id", F.lpad(F.hex(F.col("id") % 16), 2, "0").alias("shard")) \
        .withColumn("path", F.concat("shard", F.lit("/"), F.col("id").cast("string"), F.lit(".svg"))).write.partitionBy("shard").parquet(root)
    df = scans.shard_scan(spark, root, ["0A/*", "0B/1?.svg"])
    assert sorted(r.id for r in df.collect()) == [10, 11, 26, 42, 58]
    line = next(x for x in plan_of(df).splitlines() if x.startswith("PartitionFilters"))
    assert "shard" in line and "RLIKE" in line.upper()


def test_shards_of_digits_are_names(spark, tmp_path):
    root = str(tmp_path / "d")
    spark.range(4).select("id", F.lpad(F.col("id").cast("string"), 2, "0").alias("shard")).withColumn("path", F.concat("shard", F.lit("/x.svg"))) \
        .write.partitionBy("shard").parquet(root)
    assert [(r.id, r.shard) for r in scans.shard_scan(spark, root, ["01/*"]).collect()] == [(1, "01")]


def test_long_svgs_are_reported(spark):
    long = "<svg>" + "x" * 200 + "</svg>"
    log = spark.createDataFrame([(1, "http://a/p", 1, 200, "text/html", f"<p>{long}<svg>a</svg></p>")],
                                "page_id long, url string, attempt int, status int, content_type string, body string")
    assets = spark.createDataFrame([], "abs_url string, body string, content_type string, status int")
    assert [r.svg for r in M.mine_svgs(log, assets, 100).collect()] == ["<svg>a</svg>"]
    got = M.rejected_svgs(log, assets, 100).collect()
    assert [(r.page_id, r.n_chars, r.reason) for r in got] == [(1, len(long), "longer than 100 characters")]
    assert M.mine_svgs(log, assets).count() == 2 and M.rejected_svgs(log, assets).count() == 0
