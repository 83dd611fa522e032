"""Registered streaming and sink queries: each runs its job into the shared scratch folder and
returns the read-back result as a batch DataFrame."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from svgspark.functions.text import content_hash
from svgspark.operators import caption as P
from svgspark.operators import corpus as C
from svgspark.plans.mining import d_cands, mined_df
from svgspark.plans.registry import lit, register
from svgspark.session import materialized, scratch_dir
from svgspark.sources import scans, sinks
from svgspark.sources.tables import duck_with, view
from svgspark.streaming import stream as ST
from svgspark.streaming.keyed import KeyedTable


FEED_ROWS = 1_000_000


def _feed(spark, df, *order):
    """``df`` as files of at most about FEED_ROWS rows, four at least, that a stream reads in the order of the columns."""
    files = max(4, -(-df.count() // FEED_ROWS))
    path = scratch_dir(spark, "feed")
    df.repartitionByRange(files, *order).sortWithinPartitions(*order).write.parquet(path)
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    parts = sorted((f.getPath() for f in fs.listStatus(root) if f.getPath().getName().startswith("part-")), key=lambda p: p.getName())
    # a file stream reads by time of change; tasks end in any order
    for k, part in enumerate(parts):
        fs.setTimes(part, 1_000_000_000_000 + 1000 * k, -1)
    return path


def _stage_parquet(spark, df, name):
    """Materialise a derived table once under the shared scratch folder (a stream needs files)."""
    p = scratch_dir(spark, name)
    df.write.parquet(p)
    return p


@register("stream_pages", "SELECT page_id, url FROM pages")
def q_stream_pages(spark, sf):
    pages = view(spark, sf, "pages").select("page_id", "url")
    out, cp = scratch_dir(spark, "stream_pages"), scratch_dir(spark, "cp")
    ST.run_available_now(ST.stream_source(spark, _feed(spark, pages, "page_id"), pages.schema), out, cp)
    return spark.read.parquet(out)


D_SVG_CANDS = duck_with("svg_pages", "assets") + ",\n" + d_cands("svg_pages")


def _mine_stream(spark, sf):
    pages = view(spark, sf, "svg_pages")
    src = _stage_parquet(spark, pages, "svg_pages")
    s = spark.readStream.schema(pages.schema).option("maxFilesPerTrigger", 4).parquet(src)
    # written once: every micro-batch reads this side of its join again
    return ST.stream_mine(s, materialized(view(spark, sf, "assets"), "assets"))


@register("stream_mine", D_SVG_CANDS + "SELECT page_id, origin, ord, hash, n_chars FROM cands WHERE hash IS NOT NULL")
def q_stream_mine(spark, sf):
    out, cp = scratch_dir(spark, "stream_mine"), scratch_dir(spark, "cp")
    ST.run_available_now(_mine_stream(spark, sf).select("page_id", "origin", "ord", "hash", "n_chars"), out, cp)
    return spark.read.parquet(out)


@register("stream_shard_sink", D_SVG_CANDS + "SELECT DISTINCT hash, shard FROM (SELECT hash, substr(hash, 1, 2) AS shard FROM cands WHERE hash IS NOT NULL) t")
def q_stream_shard_sink(spark, sf):
    out, cp = scratch_dir(spark, "stream_shard_sink"), scratch_dir(spark, "cp")
    d = ST.stream_dedup_exact(_mine_stream(spark, sf).select("hash", "shard", "url", "svg")).withColumn("timestamp", sinks.mined_at())
    ST.run_available_now(d, out, cp, fmt="json", partition_by=["shard"])
    return spark.read.schema("hash string, url string, svg string, timestamp string, shard string").json(out).select("hash", "shard")


D_FIRST = "SELECT md5(CAST(user_id AS VARCHAR)) AS hash, min(CAST(ts AS TIMESTAMP)) AS ts FROM events GROUP BY 1"


def _events_feed(spark, sf):
    ev = view(spark, sf, "events")
    return ST.events_with_hash(ST.stream_source(spark, _feed(spark, ev, "ts", "event_id"), ev.schema))


@register("stream_dedup", f"SELECT hash, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts FROM ({D_FIRST}) t")
def q_stream_dedup(spark, sf):
    first = ST.stream_first_seen(_events_feed(spark, sf))
    table = KeyedTable(spark, scratch_dir(spark, "stream_first"), ["hash"], first.schema)
    ST.upsert_available_now(first, table, scratch_dir(spark, "cp"))
    return table.read().select("hash", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"))


@register("stream_new_per_minute", f"""SELECT strftime(minute, '%Y-%m-%d %H:%M:%S') AS minute, n_new,
  CAST(sum(n_new) OVER (ORDER BY minute ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS n_total FROM (
  SELECT time_bucket(INTERVAL 1 minute, ts) AS minute, count(*) AS n_new FROM ({D_FIRST}) f GROUP BY 1) t""")
def q_stream_new_per_minute(spark, sf):
    ev = view(spark, sf, "events")
    src = _feed(spark, ev, "ts", "event_id")
    # the last file: the first rows again under users never seen, too late to count, and a known user a day
    # after the last event, whose row only moves the watermark past every minute
    late = ev.orderBy("ts").limit(5).withColumn("user_id", -1 - F.col("user_id"))
    flush = ev.orderBy(F.desc("ts")).limit(1).withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 DAY"))
    late.unionByName(flush).coalesce(1).write.mode("append").parquet(src)
    per = ST.stream_new_per_minute(ST.events_with_hash(ST.stream_source(spark, src, ev.schema)), "10 minutes")
    out, cp = scratch_dir(spark, "stream_minutes"), scratch_dir(spark, "cp")
    ST.run_available_now(per, out, cp)
    # minutes are few: half a million a year
    total = F.sum("n_new").over(Window.orderBy("minute").rowsBetween(Window.unboundedPreceding, 0)).alias("n_total")
    return spark.read.schema("minute timestamp, n_new long").parquet(out).select(F.date_format("minute", "yyyy-MM-dd HH:mm:ss").alias("minute"), "n_new", total)


@register("stream_total", """SELECT count(*) AS n_events, count(DISTINCT user_id) AS n_users FROM events""")
def q_stream_total(spark, sf):
    counts, table, cp = _user_counts(spark, sf)
    ST.upsert_available_now(counts, table, cp)
    return table.read().agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_events"), F.count("user_id").alias("n_users"))


def _user_counts(spark, sf):
    ev = view(spark, sf, "events")
    counts = ST.stream_counts(ST.stream_source(spark, _feed(spark, ev, "event_id"), ev.schema), "user_id")
    return counts, KeyedTable(spark, scratch_dir(spark, "stream_users"), ["user_id"], counts.schema), scratch_dir(spark, "cp")


@register("stream_url_counts", D_SVG_CANDS + "SELECT url, count(*) AS n FROM cands WHERE hash IS NOT NULL GROUP BY url")
def q_stream_url_counts(spark, sf):
    """SVG found for each URL, kept up to date while pages arrive."""
    counts = ST.stream_counts(_mine_stream(spark, sf), "url")
    table = KeyedTable(spark, scratch_dir(spark, "stream_urls"), ["url"], counts.schema)
    ST.upsert_available_now(counts, table, scratch_dir(spark, "cp"))
    return table.read()


@register("stream_resume", """SELECT count(*) AS n_events, CAST(round(sum(value) * 1000) AS BIGINT) AS value_milli FROM events""")
def q_stream_resume(spark, sf):
    ev = view(spark, sf, "events")
    src = scratch_dir(spark, "resume_src")
    out, cp = scratch_dir(spark, "stream_resume"), scratch_dir(spark, "cp")
    # the input arrives in two parts; the second run continues from the first run's checkpoint
    cut = ev.agg(F.percentile_approx("event_id", 0.5).alias("cut"))
    first = ev.join(F.broadcast(cut), F.col("event_id") <= F.col("cut"), "left_semi")
    second = ev.join(F.broadcast(cut), F.col("event_id") > F.col("cut"), "left_semi")
    first.write.parquet(f"{src}/part=1")
    stream = spark.readStream.schema(ev.schema).option("recursiveFileLookup", "true").parquet(src)
    ST.run_available_now(stream.select("event_id", "value"), out, cp)
    second.write.parquet(f"{src}/part=2")
    stream = spark.readStream.schema(ev.schema).option("recursiveFileLookup", "true").parquet(src)
    ST.run_available_now(stream.select("event_id", "value"), out, cp)
    r = spark.read.parquet(out)
    return r.agg(F.count(F.lit(1)).alias("n_events"), F.round(F.sum("value") * 1000).cast("bigint").alias("value_milli"))


# ---------------------------------------------------------------- sinks (write, then read back)
from svgspark.plans.mining import d_mined  # noqa: E402


@register("shard_sink", d_mined() + "SELECT hash, shard, url, svg FROM mined")
def q_shard_sink(spark, sf):
    out = scratch_dir(spark, "shard_sink")
    sinks.shard_sink(mined_df(spark, sf), out)
    return spark.read.schema("hash string, url string, timestamp string, svg string, shard string").json(out) \
        .select("hash", "shard", "url", "svg")


@register("content_store_sink", duck_with("stage_out") + """SELECT DISTINCT md5(t) AS hash, substr(md5(t), 1, 2) AS shard,
  CAST(length(t) AS BIGINT) AS n_chars FROM (SELECT raw AS t FROM stage_out UNION ALL SELECT stage1 FROM stage_out
  UNION ALL SELECT stage2 FROM stage_out) u WHERE t IS NOT NULL""")
def q_content_store_sink(spark, sf):
    s = view(spark, sf, "stage_out")
    store = scratch_dir(spark, "svg_store")
    # three appends (one per stage) into one store; a repeated append must change nothing
    table = store.rsplit("/", 1)[1].replace("-", "_")
    for col in ("raw", "stage1", "stage1", "stage2"):
        rows = C.store_rows(s.where(F.col(col).isNotNull()).select(F.col(col).alias("text")))
        sinks.content_store_sink(rows, table, store)
    spark.sql(f"DROP TABLE {table}")  # the files stay
    return spark.read.parquet(store).select("hash", "shard", "n_chars")


@register("lineage_sink", duck_with("stage_out") + """SELECT rec_id, filename, md5(raw) AS raw, md5(stage1) AS stage1,
  CASE WHEN stage2 IS NOT NULL THEN md5(stage2) END AS stage2 FROM stage_out WHERE stage1 IS NOT NULL""")
def q_lineage_sink(spark, sf):
    s = view(spark, sf, "stage_out")
    lin = C.stage_lineage(s.select("rec_id", "filename", F.col("raw").alias("text")),
                          s.where(F.col("stage1").isNotNull()).select("rec_id", F.col("stage1").alias("text")),
                          s.where(F.col("stage2").isNotNull()).select("rec_id", F.col("stage2").alias("text")))
    out = scratch_dir(spark, "hash_map")
    sinks.lineage_sink(lin, out)
    return spark.read.schema("rec_id bigint, filename string, raw string, stage1 string, stage2 string").json(out)


D_CLEAN = f"regexp_replace(regexp_replace(text, '^\\s+|\\s+$', '', 'g'), {lit(r'(?i)^(Caption:|Description:|Image shows:)\s*')}, '')"


@register("caption_sink", duck_with("caption_raw") + f"""SELECT hash, caption, 'InternVL3-2B' AS source FROM (
  SELECT hash, {D_CLEAN} AS caption FROM caption_raw WHERE hash IN (SELECT md5(svg) FROM svg_raw)) t WHERE caption <> ''""")
def q_caption_sink(spark, sf):
    items = view(spark, sf, "svg_raw").select(content_hash("svg").alias("hash")).distinct()
    recs = P.caption_job(items, view(spark, sf, "caption_raw"), "InternVL3-2B")
    out = scratch_dir(spark, "captions")
    sinks.caption_sink(recs, out)
    return scans.jsonl_scan(spark, out, scans.CAPTION_SCHEMA).select("hash", "caption", "source")


@register("jsonl_scan", duck_with("caption_raw") + """SELECT hash, rec_id, text FROM caption_raw WHERE rec_id % 7 <> 0""")
def q_jsonl_scan(spark, sf):
    raw = view(spark, sf, "caption_raw")
    line = F.to_json(F.struct("hash", "rec_id", "text"))
    # records of every seventh id arrive truncated (corrupt lines); the scan must drop exactly those
    lines = raw.select(F.when(F.col("rec_id") % 7 == 0, F.substring(line, 1, 20)).otherwise(line).alias("value"))
    out = scratch_dir(spark, "jsonl")
    lines.write.text(out)
    return scans.jsonl_scan(spark, out, "hash string, rec_id bigint, text string")
