"""Scans: URL columns, split choice, glob restriction, SVG directories, JSONL corpora, fetch logs."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column-name aliases for the SVG text column across corpora (fixed values).
SVG_ALIASES = ("svg", "content", "svg_contents")

FETCH_LOG_SCHEMA = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
    T.StructField("attempt", T.IntegerType()), T.StructField("status", T.IntegerType()),
    T.StructField("content_type", T.StringType()), T.StructField("body", T.StringType()),
])
MINED_SCHEMA = T.StructType([
    T.StructField("url", T.StringType()), T.StructField("timestamp", T.StringType()), T.StructField("svg", T.StringType()),
])
CAPTION_SCHEMA = T.StructType([
    T.StructField("hash", T.StringType()), T.StructField("caption", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("prompt", T.StringType()),
])


def url_scan(df: DataFrame, column: str = "url") -> DataFrame:
    """The URL column of a dataset as ``url``; a missing column is an error, NULL URLs are dropped."""
    if column not in df.columns:
        raise ValueError(f"column {column!r} not in dataset columns {df.columns}")
    return df.select(F.col(column).alias("url")).where(F.col("url").isNotNull())


def glob_to_regex(pattern: str) -> str:
    out = []
    for ch in pattern:
        out.append("[^/]*" if ch == "*" else "[^/]" if ch == "?" else re.escape(ch))
    return "^" + "".join(out) + "$"


def glob_filter(df: DataFrame, patterns: list[str], col: str = "path") -> DataFrame:
    """Rows whose ``col`` matches any of the glob patterns (``*``, ``?``)."""
    rx = "|".join(f"(?:{glob_to_regex(p)})" for p in patterns)
    return df.where(F.col(col).rlike(rx))


def glob_scan(spark: SparkSession, root: str, fmt: str, patterns: list[str], **options) -> DataFrame:
    """Read only the files of ``root`` whose names match the patterns (pruned at listing time)."""
    reader = spark.read.format(fmt).options(**options)
    paths = [f"{root.rstrip('/')}/{p}" for p in patterns]
    return reader.load(paths)


def shard_scan(spark: SparkSession, root: str, patterns: list[str], fmt: str = "parquet", shard: str = "shard", path: str = "path") -> DataFrame:
    """Rows of a table partitioned by ``shard`` whose ``path`` (shard/name) matches a pattern. The part of a pattern before
    the slash is asked of the partition value, so other shards are not read."""
    found = spark.read.format(fmt).load(root).schema
    # shards such as 00 and 01 are names, which the reader takes for numbers if there are no others
    schema = T.StructType([T.StructField(f.name, T.StringType()) if f.name == shard else f for f in found])
    df = spark.read.schema(schema).format(fmt).load(root)
    heads = "|".join(f"(?:{glob_to_regex(p.split('/')[0])})" for p in patterns)
    return glob_filter(df.where(F.col(shard).rlike(heads)), patterns, path)


def split_scan(spark: SparkSession, root: str, split: str = "split", preferred: str = "train") -> DataFrame:
    """Split ``preferred`` of a table partitioned by ``split``, else the first in sorted order. The choice reads partition
    values only, and as a constant in the filter it prunes the other partitions."""
    df = spark.read.parquet(root)
    chosen = df.agg(F.coalesce(F.max(F.when(F.col(split) == preferred, F.col(split))), F.min(split)).alias("c")).first()["c"]
    return df.where(F.col(split) == F.lit(chosen))


def svg_dir_scan(spark: SparkSession, path: str, glob: str = "*.svg") -> DataFrame:
    """Every file named like ``glob`` under ``path`` (recursively) as ``(path, grp, svg, n_bytes)``; ``grp`` is the
    top-level directory below ``path`` ('' for files directly in it)."""
    root = path.rstrip("/")
    df = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
          .option("recursiveFileLookup", "true").load(root))
    rel = F.regexp_replace(F.col("path"), r"^.*?" + re.escape(root.split("://")[-1]) + "/", "")
    return df.select(
        F.col("path"),
        F.when(rel.contains("/"), F.regexp_extract(rel, r"^([^/]+)/", 1)).otherwise(F.lit("")).alias("grp"),
        F.col("content").cast("string").alias("svg"),
        F.col("length").alias("n_bytes"),
    )


def jsonl_scan(spark: SparkSession, path, schema: T.StructType) -> DataFrame:
    """JSON-lines corpus with a fixed schema; corrupt lines are dropped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def with_svg_alias(df: DataFrame) -> DataFrame:
    """Rename whichever SVG text column a corpus uses to ``svg``."""
    for a in SVG_ALIASES:
        if a in df.columns:
            return df.withColumnRenamed(a, "svg") if a != "svg" else df
    raise ValueError(f"no SVG text column among {df.columns}")


def fetch_log_scan(df: DataFrame) -> DataFrame:
    """Crawl results as a typed table (the HTTP client is outside the engine)."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in FETCH_LOG_SCHEMA.fields])


def hash_files(spark: SparkSession, path: str, glob: str = "*", algorithm: str = "md5") -> DataFrame:
    """Digest of every file's bytes under ``path`` as ``(path, hash)``; order is the path column."""
    from svgspark.functions.text import content_hash

    df = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    return df.select("path", content_hash(F.col("content"), algorithm).alias("hash"))
