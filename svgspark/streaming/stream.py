"""Structured Streaming forms of the mining jobs.

Sources are file streams (``maxFilesPerTrigger`` bounds a micro-batch, the back-pressure of the
crawler's bounded queue); the transforms are the batch column functions; dedup state lives in the
state store (RocksDB provider configured by the session); sinks are exactly-once file sinks or
keyed upserts (``keyed.KeyedTable``). ``run_available_now`` drains what is there and stops, which is also how a
resumed run continues from its checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from svgspark.functions.text import content_hash, shard_of
from svgspark.operators import mine as M
from svgspark.streaming.keyed import KeyedTable


def stream_source(spark: SparkSession, path: str, schema, max_files_per_trigger: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(path)


def run_available_now(df: DataFrame, out_path: str, checkpoint: str, fmt: str = "parquet",
                      partition_by: list[str] | None = None, timeout_s: int | None = None) -> None:
    """Appends what is there to a file sink and stops. ``timeout_s``: seconds after which the caller wants an error instead; none by default."""
    w = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).format(fmt).option("path", out_path)
    if partition_by:
        w = w.partitionBy(*partition_by)
    _drain(w.start(), timeout_s)


def upsert_available_now(df: DataFrame, table: KeyedTable, checkpoint: str, timeout_s: int | None = None) -> None:
    """Update mode: the keys that a micro-batch changed go to ``table``; a run that was stopped goes on from its checkpoint."""
    w = df.writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(table.write)
    _drain(w.start(), timeout_s)


def _drain(q: StreamingQuery, timeout_s: int | None) -> None:
    if timeout_s is None:
        q.awaitTermination()
    elif not q.awaitTermination(timeout_s):
        q.stop()
        raise TimeoutError("streaming query did not drain in time")
    if q.exception() is not None:
        raise q.exception()


def stream_mine(pages: DataFrame, assets: DataFrame) -> DataFrame:
    """Stateless part of mining on a page stream: candidates, gates, hashes (assets: a static table)."""
    return (M.candidate_svgs(pages, assets).where(F.col("hash").isNotNull())
            .withColumn("shard", shard_of("hash")))


def stream_dedup_exact(cands: DataFrame, key: str = "hash") -> DataFrame:
    """Exact dedup: the state keeps one key per unique item, forever (as the reference's hash set)."""
    return cands.dropDuplicates([key])


def stream_dedup_bounded(cands: DataFrame, ts: str, delay: str, key: str = "hash") -> DataFrame:
    """Bounded-state dedup: duplicates are dropped only within the watermark delay (weaker)."""
    return cands.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def stream_first_seen(events: DataFrame, key: str = "hash", ts: str = "ts") -> DataFrame:
    """Earliest time of each key, for update mode: one number of state per key, whatever the order of arrival."""
    return events.groupBy(F.col(key).alias("hash")).agg(F.min(ts).alias("ts"))


def stream_counts(events: DataFrame, *keys: str) -> DataFrame:
    """Running count of each key, for update mode."""
    return events.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def stream_new_per_minute(events: DataFrame, delay: str, key: str = "hash", ts: str = "ts") -> DataFrame:
    """Keys not met before, counted by minute of event time: watermark, exact dedup and window in one append-mode query.

    The row of a key that arrives first counts, as in the crawler's set of hashes; rows of one micro-batch arrive in the
    order in which their splits are read. Rows older than the watermark are dropped before the dedup, and a minute is
    emitted once the watermark has passed its end."""
    new = events.select(F.col(key).alias("hash"), F.col(ts).alias("ts")).withWatermark("ts", delay).dropDuplicates(["hash"])
    return new.groupBy(F.window("ts", "1 minute").alias("w")).agg(F.count(F.lit(1)).alias("n_new")).select(F.col("w.start").alias("minute"), "n_new")


def events_with_hash(events: DataFrame) -> DataFrame:
    return events.select(content_hash(F.col("user_id").cast("string")).alias("hash"), F.col("ts").cast("timestamp").alias("ts"),
                         "event_id")
