"""Line dedup with levelled sorted runs of line hashes, DataFrame operators only.

A line's key is the line with white space ``[\\x20\\x09-\\x0D]`` stripped at both ends and A-Z lower-cased.
Documents arrive in batches. A batch is reduced to (key hash, documents that hold it), merge-anti-joined
against the keys that a run already knows to be common (they need no more counting), and the rest is
written as a sorted run of level 0. Whenever ``fanout`` runs stand on a level they are merged into one run
of the next level, sums per hash. Keys found in ``min_docs`` documents lose all their lines.

Runs are tables bucketed and sorted by hash, so neither the anti join nor the merge of two runs shuffles them: a
batch is shuffled once, to the buckets. Only 128-bit hashes and line numbers are shuffled to find the keys; texts
move once, for the rewrite. A key that a third of all documents hold is counted by partial aggregation. Keys that
make up at least 1/``HOT_KEYS`` of all lines, of which there can be no more than ``HOT_KEYS``, are broadcast to find
their lines, which therefore stay where they are; only the lines of rarer keys are shuffled to the buckets.

Defined results: null or empty text is one empty line; an empty key is never dropped; rows that repeat
are documents each and get the same verdict; a null doc_id is a value like any
other; an empty table gives an empty result; other columns pass through unchanged, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from svgspark.llm.common import dropped, row_id, scratch, written

WHITE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Letters outside A-Z that ``lower`` would change; lines with one take the slower exact ``translate``.
OTHER_UPPER = r"[\p{IsUppercase}\p{Lt}&&[^A-Z]]"
#: Most keys that are broadcast, 16 bytes each.
HOT_KEYS = 65_536


def line_key(line: Column) -> Column:
    stripped = F.btrim(line, F.lit(WHITE))
    return F.when(stripped.rlike(OTHER_UPPER), F.translate(stripped, UPPER, UPPER.lower())).otherwise(F.lower(stripped))


def key_hashes(key: Column) -> list[Column]:
    """Two differently seeded 64-bit hashes."""
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(7), key).alias("h2")]


class LineRuns:
    """The runs: tables (h1, h2, n) bucketed and sorted by hash, a list of (table, path) per level."""

    def __init__(self, spark: SparkSession, min_docs: int, fanout: int = 2) -> None:
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[tuple[str, str]]] = []

    def _read(self, run: tuple[str, str]) -> DataFrame:
        return self.spark.table(run[0])

    def _write(self, counts: DataFrame, level: int) -> tuple[str, str]:
        path = scratch(self.spark, f"line-run-{level}")
        name = path.rsplit("/", 1)[1].replace("-", "_")
        counts.select("h1", "h2", "n").write.bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2").option("path", path).saveAsTable(name)
        return name, path

    def _drop(self, run: tuple[str, str]) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {run[0]}")
        dropped(self.spark, run[1])

    def _known(self, run: tuple[str, str]) -> DataFrame:
        """The keys that a run holds as common."""
        return self._read(run).where(F.col("n") >= self.min_docs).select(F.col("h1").alias("k1"), F.col("h2").alias("k2"))

    def unknown(self, counts: DataFrame) -> DataFrame:
        """``counts`` without the keys that a run already knows to be common; the runs are not shuffled."""
        # an outer join and a filter: an anti join would move below the aggregation that makes the counts
        for run in (run for level in self.levels for run in level):
            counts = counts.join(self._known(run).hint("merge"), (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2")), "left") \
                .where("k1 IS NULL").drop("k1", "k2")
        return counts

    def merged(self, left: tuple[str, str], right: tuple[str, str]) -> DataFrame:
        """(h1, h2, n) of two runs, bucket by bucket."""
        a, b = self._read(left), self._read(right).withColumnRenamed("n", "m")
        return a.join(b.hint("merge"), ["h1", "h2"], "full").select("h1", "h2", (F.coalesce("n", F.lit(0)) + F.coalesce("m", F.lit(0))).alias("n"))

    def _one(self, runs: list[tuple[str, str]], level: int) -> tuple[str, str]:
        """The runs merged into one, two at a time."""
        while len(runs) > 1:
            left, right = runs[:2]
            runs = [self._write(self.merged(left, right), level), *runs[2:]]
            self._drop(left)
            self._drop(right)
        return runs[0]

    def add(self, batch: DataFrame) -> None:
        """batch: (h1, h2, doc), one row or more for each document (row of the table) that holds the line."""
        counts = batch.groupBy("h1", "h2").agg(F.countDistinct("doc").alias("n"))
        self._push(self._write(self.unknown(counts), 0), 0)

    def _push(self, run: tuple[str, str], level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            old, self.levels[level] = self.levels[level], []
            self._push(self._one(old, level + 1), level + 1)

    def common(self) -> DataFrame:
        """(h1, h2, n) of the keys found in ``min_docs`` documents, from all runs merged into one."""
        runs = [run for level in self.levels for run in level]
        self.levels = [[self._one(runs, len(self.levels))]]
        return self._read(self.levels[0][0]).where(F.col("n") >= self.min_docs)

    def close(self) -> None:
        for level in self.levels:
            while level:
                self._drop(level.pop())


def _common_lines(lines: DataFrame, common: DataFrame) -> DataFrame:
    """The rows of ``lines`` whose key is common: id, rid, pos."""
    rare = -(-lines.count() // HOT_KEYS)  # the documents of all keys are at most the lines, so at most HOT_KEYS reach it
    keys = common.select(F.col("h1").alias("k1"), F.col("h2").alias("k2"), "n")
    same = (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2"))
    seen = lines.join(F.broadcast(keys.where(F.col("n") >= rare).drop("n")), same, "left")
    hot = seen.where("k1 IS NOT NULL").select("id", "rid", "pos")
    cold = seen.where("k1 IS NULL").drop("k1", "k2").join(keys.where(F.col("n") < rare).hint("merge"), same).select("id", "rid", "pos")
    return hot.unionAll(cold)


def dedup_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, batches: int = 4, fanout: int = 2) -> DataFrame:
    """``docs`` with ``row`` (its own columns as a struct), n_lines, n_dropped and kept (text of the other lines)."""
    spark = docs.sparkSession
    base = docs.select(
        F.struct("*").alias("row"), row_id("doc_id", "text").alias("rid"), F.col("doc_id").alias("id"),
        F.split(F.coalesce("text", F.lit("")), "\n", -1).alias("parts"),
    )
    path = scratch(spark, "lines")
    lines = base.withColumn("doc", F.monotonically_increasing_id()).select("id", "rid", "doc", F.posexplode("parts").alias("pos", "line")).withColumn("key", line_key(F.col("line")))
    lines = lines.where(F.char_length("key") >= max(1, min_chars)).select("id", "rid", "doc", "pos", *key_hashes(F.col("key")))
    runs = LineRuns(spark, min_docs, fanout)
    try:
        lines.withColumn("batch", F.pmod("rid", F.lit(batches))).write.partitionBy("batch").parquet(path)
        lines = spark.read.schema(f"{_ddl(lines)}, batch int").parquet(path)
        for k in range(batches):
            runs.add(lines.where(F.col("batch") == k).select("h1", "h2", "doc"))
        hits = written(_common_lines(lines, runs.common()).groupBy("id", "rid").agg(F.collect_set("pos").alias("gone")), "line-hits")
    finally:
        runs.close()
        dropped(spark, path)
    n = F.size("parts")
    joined = base.join(hits.select(F.col("id").alias("hid"), F.col("rid").alias("hrid"), "gone"),
                       F.col("id").eqNullSafe(F.col("hid")) & (F.col("rid") == F.col("hrid")), "left")
    stay = F.array_except(F.sequence(F.lit(0), n - 1), F.col("gone"))
    kept = F.when(F.col("gone").isNull(), F.col("parts")).otherwise(F.transform(stay, lambda i: F.get(F.col("parts"), i)))
    return joined.select(
        "row", n.cast("long").alias("n_lines"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
        F.array_join(kept, "\n").alias("kept"),
    )


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)


def op8(docs: DataFrame) -> DataFrame:
    """Digest columns of the contract: doc_id, n_lines, n_dropped, kept_sha256."""
    out = dedup_lines(docs.select("doc_id", "text"))
    return out.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
l AS (SELECT r, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos FROM d),
k AS (SELECT r, pos, line,
             translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= 10),
m AS (SELECT r, pos, line, key IN (SELECT key FROM c) AS gone FROM k),
s AS (SELECT r, count(*) AS n_lines, sum(gone::BIGINT)::BIGINT AS n_dropped,
             coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS kept FROM m GROUP BY r)
SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM s JOIN d USING (r)
"""
