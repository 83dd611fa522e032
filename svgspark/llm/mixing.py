"""Mixing sources to target weights along a time-varying curriculum.

Targets: sources in code point order, null last, weigh 3, 1, 2, repeating, and share 150 % of all words; a
target stops at twice its source's size and the excess is shared anew by weight, which has the closed form
min(2 * size, level * weight). Every source's documents are put into a fixed random order (by md5 of the
doc_id) and taken from its start, round after round, until the target is met to the word; the last document of
a source is taken in part.

Curriculum: a source's weight over training time t in [0, 1] runs linearly from a to b. Integrated and scaled
to its target it is the source's cumulative demand; a document whose words start at demand u is trained at the
t where the demand is u, the root of a quadratic. The training order is the range sort by that position.

Only (doc_id, source, size) is shuffled. The running sums of a source are split by hash range, so a source
with a third of all documents is summed by many tasks; the rows of one source are never together in one.

Defined results: null or empty text has size 0 and is taken 0 times, at no position; rows that repeat are
documents each; a null source is a source of its own; if all sizes are 0, so are all targets; an empty table
gives an empty result; other columns pass through ``curriculum`` unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from svgspark.llm.common import WORD, row_id, written

#: Fixed value: the weights of the sources in order, repeating.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0
#: Weight over time of the sources in order, repeating: (at the start, at the end).
SCHEDULE = ((1.0, 3.0), (1.0, 1.0), (3.0, 1.0))
#: A word with the white space before it.
PIECE = r"[\x20\x09-\x0D]*" + WORD
RANGES = 4096  # hash ranges: the first three digits of the md5


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, rank, target): a row for each source, from (source, size) rows."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())  # one row for each source
    per = per.withColumn("rank", F.row_number().over(order) - 1)
    per = per.withColumn("weight", _cycle(weights, F.col("rank")).cast("double")).withColumn("cap", F.col("source_size") * F.lit(most))
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    everything = Window.partitionBy()
    per = (
        per.withColumn("total", F.sum("source_size").over(everything) * F.lit(share))
        .withColumn("capped", F.coalesce(F.sum("cap").over(by_level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("open", F.sum("weight").over(by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
        .withColumn("level", (F.col("total") - F.col("capped")) / F.col("open"))
    )
    first = F.min(F.when(F.col("cap") / F.col("weight") >= F.col("level"), F.struct(F.col("cap") / F.col("weight"), "rank", "level")))
    per = per.withColumn("level", first.over(everything)["level"])
    return per.select("source", "source_size", "rank", F.least("cap", F.col("level") * F.col("weight")).alias("target"))


def _cycle(values: tuple, rank: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), F.pmod(rank, F.lit(len(values))))


def position(u: Column, a: Column, b: Column) -> Column:
    """The time t at which a weight running linearly from a to b has used the share u of its integral."""
    root = a + F.sqrt(a * a + (b * b - a * a) * u)
    return F.when(root == 0, F.lit(0.0)).otherwise((a + b) * u / root)


def plan(docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST, schedule: tuple = SCHEDULE) -> DataFrame:
    """(doc_id, rid, size, source_size, target, taken, rounds), a row for each row of ``docs``.

    rounds: array of (take, position), one for each round that takes words of the document.
    """
    sizes = written(docs.select(
        "doc_id", row_id("doc_id", "text", "source").alias("rid"), "source",
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size")), "sizes")
    goal = written(targets(sizes, weights, share, most), "targets")
    key = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":mix")))
    rows = sizes.withColumn("key", key).withColumn("range", F.substring("key", 1, 3))
    ranges = rows.groupBy("source", "range").agg(F.sum("size").alias("words"))
    before = ranges.select("source", "range", F.coalesce(F.sum("words").over(
        Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    within = Window.partitionBy("source", "range").orderBy("key", "doc_id", "rid").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0)))
    rows = _null_safe(rows, before, ["source", "range"])
    rows = _null_safe(rows, goal, ["source"])
    at = F.col("before") + F.col("inside")
    whole = F.floor(F.col("target") + 0.5)
    a, b = (_cycle(tuple(s[k] for s in schedule), F.col("rank")) for k in (0, 1))

    def one(n: Column) -> Column:
        begin = at + n * F.col("source_size")
        take = F.greatest(F.least(whole - begin, F.col("size")), F.lit(0))
        return F.struct(take.cast("long").alias("take"), F.round(position(F.try_divide(begin, whole), a, b), 9).alias("position"))

    rounds = F.filter(F.transform(F.sequence(F.lit(0), F.lit(int(-(-most // 1)) - 1)), one), lambda x: x["take"] > 0)
    rows = rows.withColumn("rounds", F.when(whole > 0, rounds).otherwise(F.filter(rounds, lambda x: F.lit(False))))
    return rows.select("doc_id", "rid", "size", "source_size", "target", F.aggregate(
        "rounds", F.lit(0).cast("long"), lambda s, x: s + x["take"]).alias("taken"), "rounds")


def _null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join in which a null source is a source."""
    other = right.select(*[F.col(k).alias(f"_{k}") if k in keys else F.col(k) for k in right.columns])
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return left.join(other, cond).drop(*[f"_{k}" for k in keys])


def op5(docs: DataFrame) -> DataFrame:
    """Digest columns of the contract, and the positions of the first and second round; in training order."""
    out = plan(docs.select("doc_id", "text", "source"))
    return out.select("doc_id", "size", "source_size", "target", "taken",
                      F.get("rounds", F.lit(0))["position"].alias("position"), F.get("rounds", F.lit(1))["position"].alias("position2")) \
        .orderBy(F.col("position").asc_nulls_last(), "doc_id")


def curriculum(docs: DataFrame) -> DataFrame:
    """The documents in training order, once for each round that takes them; a part taken is the text up to the end of
    its last word, white space as it is."""
    taken = plan(docs).where("taken > 0").select(F.struct("doc_id", "rid").alias("key"), "rounds") \
        .groupBy("key").agg(F.collect_list("rounds").alias("copies"))
    # the document's columns travel under names of their own, so none can clash
    own = {c: f"_c{k}" for k, c in enumerate(docs.columns)}
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in own.items()],
                       F.struct("doc_id", row_id("doc_id", "text", "source").alias("rid")).alias("key"))
    # rows that repeat share a key: the k-th of them gets the k-th verdict; the numbering needs no further shuffle
    rows = rows.join(taken, "key").withColumn("copy", F.row_number().over(Window.partitionBy("key").orderBy("key")))
    rows = rows.withColumn("round", F.explode(F.get("copies", F.col("copy") - 1)))
    whole = F.col(own["text"])
    pieces = F.regexp_extract_all(whole, F.lit(PIECE), F.lit(0))
    text = F.when(F.col("round.take") < F.regexp_count(whole, F.lit(WORD)),
                  F.array_join(F.slice(pieces, 1, F.col("round.take").cast("int")), "")).otherwise(whole)
    rows = rows.withColumn(own["text"], text)
    return rows.orderBy("round.position", "key.doc_id").select(*[
        F.char_length(own["text"]).cast("long").alias(c) if c == "n_chars" else F.col(n).alias(c) for c, n in own.items()])


ORACLE = r"""
WITH z AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM z GROUP BY source),
w AS (SELECT *, [3, 1, 2][rank % 3 + 1]::DOUBLE AS weight, source_size * 2.0::DOUBLE AS cap, [1, 1, 3][rank % 3 + 1]::DOUBLE AS a,
             [3, 1, 1][rank % 3 + 1]::DOUBLE AS b FROM s),
l AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING
             AND 1 PRECEDING), 0)) / sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT *, least(cap, weight * (SELECT level FROM l WHERE cap / weight >= level ORDER BY cap / weight, rank LIMIT 1)) AS target FROM l),
o AS (SELECT z.*, source_size, target, floor(target + 0.5)::BIGINT AS goal, a, b, coalesce(sum(size) OVER (PARTITION BY z.source
             ORDER BY md5(z.doc_id::VARCHAR || ':mix'), doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS c
      FROM z JOIN t ON z.source IS NOT DISTINCT FROM t.source),
p AS (SELECT *, greatest(least(goal - c, size), 0) AS t1, greatest(least(goal - source_size - c, size), 0) AS t2,
             c / goal AS u1, (c + source_size) / goal AS u2 FROM o)
SELECT doc_id, size, source_size, target, (t1 + t2)::BIGINT AS taken,
       CASE WHEN t1 > 0 THEN round((a + b) * u1 / (a + sqrt(a * a + (b * b - a * a) * u1)), 9) END AS position,
       CASE WHEN t2 > 0 THEN round((a + b) * u2 / (a + sqrt(a * a + (b * b - a * a) * u2)), 9) END AS position2
FROM p
"""
