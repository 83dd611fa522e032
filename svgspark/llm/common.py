"""Helpers the training-data operators share: tables, scratch tables, row identity."""

from __future__ import annotations

import contextlib
import contextvars
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
_noted: contextvars.ContextVar[tuple[list[str], ...]] = contextvars.ContextVar("noted", default=())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, tag: str) -> str:
    """A new folder name under ``spark.checkpoint.dir``, which driver and executors share.

    Only a ``local`` master may lack the setting; it then gets one folder for the session.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="llm-scratch-")
        spark.conf.set("spark.checkpoint.dir", root)
    path = f"{root.rstrip('/')}/{tag}-{uuid.uuid4().hex[:12]}"
    for paths in _noted.get():
        paths.append(path)
    return path


@contextlib.contextmanager
def noted() -> Iterator[list[str]]:
    """The scratch folders named inside, in order, for a caller that deletes them once nothing reads them."""
    paths: list[str] = []
    token = _noted.set((*_noted.get(), paths))
    try:
        yield paths
    finally:
        _noted.reset(token)


def small_batches(spark: SparkSession, rows: int = 2000) -> SparkSession:
    """Sets the rows of an Arrow batch, unless the session sets them: whole texts are wide rows."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(rows))
    return spark


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(spark: SparkSession, path: str) -> None:
    """Deletes a scratch table that nothing reads any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


class Scratch:
    """Scratch tables that are deleted together, once what is read from them has been written elsewhere."""

    def __init__(self) -> None:
        self.paths: list[str] = []

    def written(self, df: DataFrame, tag: str) -> DataFrame:
        path = scratch(df.sparkSession, tag)
        self.paths.append(path)
        df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def drop(self, spark: SparkSession) -> None:
        while self.paths:
            dropped(spark, self.paths.pop())


def thinned(rows: DataFrame, key: str, wanted: DataFrame, bits: int = 23) -> DataFrame:
    """``rows`` without most of those whose ``key`` is not an ``id`` of ``wanted``, before a semi join shuffles them.

    The ids are hashed into one bitmap of 2**bits bits, 1 MB however many there are, and that is broadcast; rows
    that only share a bit pass too, so the exact join must follow.
    """
    def bit(column: str) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(1 << bits)) + 1

    maps = wanted.select(bit("id").alias("_h")).groupBy(F.bitmap_bucket_number("_h").alias("_bucket")) \
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_h")).alias("_bits"))
    place = F.bitmap_bit_position("_h")
    byte = F.conv(F.hex(F.expr("substr(_bits, cast(bitmap_bit_position(_h) div 8 + 1 as int), 1)")), 16, 10).cast("int")
    return rows.withColumn("_h", bit(key)).join(F.broadcast(maps), F.bitmap_bucket_number("_h") == F.col("_bucket")) \
        .where(F.getbit(byte.cast("long"), F.pmod(place, F.lit(8)).cast("int")) == 1).drop("_h", "_bucket", "_bits")


def row_id(*cols: str) -> Column:
    """64-bit identity of a row's content; with doc_id it is the key that joins decisions back to rows.

    Null and empty differ. Rows that repeat every one of ``cols`` share it, so decisions kept once per
    identity reach each repeated row exactly once.
    """
    parts: list[Column] = []
    for c in cols:
        parts += [F.col(c).isNull().cast("int"), F.col(c)]
    return F.xxhash64(*parts)


def same_row(a: DataFrame, b: DataFrame, *cols: str) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & a[c].eqNullSafe(b[c])
    return cond
