"""Session construction and the shared scratch location.

On a cluster ``spark.checkpoint.dir`` names a shared folder; every job that cuts lineage or
round-trips through a sink writes below it. Only when the setting is absent (local tests) do we
create one under the system temp folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: What ``once`` has written: folders by application, name and state of the input files.
_WRITTEN: dict[tuple, str] = {}


def get_spark(master: str | None = None, partitions: int | None = None, app: str = "svgspark") -> SparkSession:
    """A session with the engine's settings. What the launcher has set stands: the master, and on a cluster the
    shuffle partitions and the driver's memory; only a local session without settings gets defaults for one box."""
    master = master or SparkConf().get("spark.master", f"local[{os.environ.get('BENCH_CPUS', '8')}]")
    builder = SparkSession.builder.master(master).appName(app)
    if master.startswith("local"):
        builder = builder.config("spark.driver.memory", os.environ.get("SVGSPARK_DRIVER_MEMORY", "16g"))
        partitions = partitions or 8
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    spark = (
        builder
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder; a local session without one gets a temporary folder, a cluster must name it."""
    conf = spark.sparkContext.getConf()
    cp = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not cp:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        cp = tempfile.mkdtemp(prefix="svgspark-cp-")
        spark.conf.set("spark.checkpoint.dir", cp)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(cp)
    return cp


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint location."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def materialized(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: planned and computed once, however often it is read after."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def once(spark: SparkSession, name: str, inputs: list[str], write: Callable[[str], None]) -> str:
    """The folder that ``write(folder)`` fills, filled once in an application for the same state (path, size and time) of
    the input files: for tables that several queries read and that are dear to make, such as a learned vocabulary."""
    state = []
    for path in inputs:
        files = spark.read.parquet(path).select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
        state.append((path, *files.agg(F.count("*"), F.bit_xor(F.xxhash64("file_path", "file_size", "file_modification_time"))).first()))
    key = (spark.sparkContext.applicationId, name, *state)
    if key not in _WRITTEN:
        folder = scratch_dir(spark, name)
        write(folder)
        _WRITTEN[key] = folder
    return _WRITTEN[key]
