"""Sharding by Karmarkar-Karp differencing: shards of near equal bytes, equal texts always together.

A group is all rows of one text and cannot be divided; its size is the bytes of its rows. Differencing starts with a
partial partition for each group (the group alone, other parts empty) and repeatedly combines the two partial
partitions with the largest spread, the largest part of one with the smallest of the other, until one is left.

One task differences at most ``LAST`` groups. More are dealt by hash into a half, a quarter, an eighth and so on down to
a few groups, and each such share into cells of about ``CELL`` groups. A cell is differenced into ``shards`` parts, and
the parts are the groups of the next level. The parts of the large shares carry most bytes; those of the small shares,
down to single groups, let the last level close what gaps remain, also beside a group larger than a fair shard. The last
level differences whole parts into the shards. Only sizes travel, and a level has about 1/200 of the rows of the one
before.

Places in a shard are counted within salted ranges of about ``RANGE`` rows, rows that repeat as one row with a count,
so that neither a text on a third of all rows nor a shard is numbered by one task.

Defined results: null and empty texts have size 1 and are one group; rows that repeat get a place each; a null doc_id
is a value like any other; an empty table gives an empty result; extra columns are ignored by ``assign`` and kept by
``sharded``; ties in size go by the hash of the group, so reruns agree.
"""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from svgspark.llm.common import Scratch, written

SHARDS = 16
CELL = 4096
LAST = 32_768
RANGE = 4096


def difference(sizes: list[int], parts: int) -> list[int]:
    """The part of each size, by differencing; sizes in any order, ties in the order given."""
    if not sizes:
        return []
    nodes: list[tuple] = []  # (values, left, right, order); a size alone has no order
    heap: list[tuple[int, int]] = []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        nodes.append((sizes[i], i))
        heap.append((-sizes[i], len(nodes) - 1))
    heapq.heapify(heap)
    places = range(parts)

    def values(k: int) -> list[int]:
        node = nodes[k]
        return node[0] if len(node) == 4 else [node[0]] + [0] * (parts - 1)

    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        both = [x + y for x, y in zip(values(a), reversed(values(b)))]
        order = sorted(places, key=both.__getitem__, reverse=True)
        least = both[order[-1]]
        nodes.append(([both[j] - least for j in order], a, b, order))
        for k in (a, b):
            if len(nodes[k]) == 4:
                nodes[k] = ([], *nodes[k][1:])
        heapq.heappush(heap, (least - both[order[0]], len(nodes) - 1))
    out, label = [0] * len(sizes), {len(nodes) - 1: list(places)}
    for k in range(len(nodes) - 1, -1, -1):
        own = label.pop(k)
        if len(nodes[k]) == 2:
            out[nodes[k][1]] = own[0]
            continue
        _, a, b, order = nodes[k]
        left, right = [0] * parts, [0] * parts
        for j, place in enumerate(order):
            left[place] = right[parts - 1 - place] = own[j]
        label[a], label[b] = left, right
    return out


def _parts(parts: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("size", "descending"), ("id", "ascending")])
        part = difference(table.column("size").to_pylist(), parts)
        return table.append_column("part", pa.array(part, pa.int32()))

    return run


def _differenced(groups: DataFrame, parts: int) -> DataFrame:
    """``groups`` (id, size, cell) with the part that differencing each cell gives them."""
    return groups.select("id", "size", "cell").groupBy("cell").applyInArrow(_parts(parts), "id binary, size long, cell string, part int")


def _cell(n: int, level: int, cell: int, least: int) -> Column:
    """The cell of a group: its share k, that of 2^-(k+1) of all n groups, and a place among the cells of that share."""
    halves = max(1, (n // least).bit_length() - 1)
    bits = F.pmod(F.xxhash64("id", F.lit(level), F.lit("share")), F.lit(1 << halves))
    share = F.lit(halves) - F.length(F.regexp_replace(F.bin(bits), "^0", ""))
    cells = F.get(F.array(*[F.lit(max(1, -(-(n >> min(k + 1, halves)) // cell))) for k in range(halves + 1)]), share)
    return F.concat_ws(":", share, F.pmod(F.xxhash64("id", F.lit(level)), cells))


def placed(groups: DataFrame, shards: int = SHARDS, cell: int = CELL, last: int = LAST, tables: Scratch | None = None) -> DataFrame:
    """(id, shard) of ``groups`` (id binary, size long); ids are distinct."""
    if cell < 16 * shards or last < 64 * shards:
        raise ValueError("a cell needs 16 groups for each shard, and the last level 64, or levels do not shrink")
    tables = tables or Scratch()
    level = tables.written(groups, "groups")
    maps: list[DataFrame] = []
    while (n := level.count()) > last:
        bundle = F.unhex(F.md5(F.concat_ws("/", F.lit(len(maps)), "cell", "part")))
        dealt = _differenced(level.withColumn("cell", _cell(n, len(maps), cell, shards)), shards)
        dealt = tables.written(dealt.withColumn("bundle", bundle), "dealt")
        maps.append(dealt.select("id", "bundle"))
        level = tables.written(dealt.groupBy("bundle").agg(F.sum("size").alias("size")).withColumnRenamed("bundle", "id"), "level")
    out = tables.written(_differenced(level.withColumn("cell", F.lit("")), shards).select("id", F.col("part").alias("shard")), "placed")
    for table in reversed(maps):
        out = table.join(out.withColumnRenamed("id", "bundle"), "bundle").select("id", "shard")
    return out


def _rows(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("id"))


def assign(docs: DataFrame, shards: int = SHARDS, cell: int = CELL, last: int = LAST) -> DataFrame:
    """A row for each row of ``docs``: doc_id, size, text_crc32, shard, slot."""
    tables = Scratch()
    rows = tables.written(_rows(docs).groupBy("doc_id", "size", "text_crc32", "id").agg(F.count("*").alias("n")), "rows")
    groups = rows.groupBy("id").agg(F.sum(F.col("size") * F.col("n")).alias("size"))
    salts = max(1, -(-rows.count() // (shards * RANGE)))
    salt = F.pmod(F.xxhash64("doc_id", "id"), F.lit(salts))
    rows = written(rows.join(placed(groups, shards, cell, last, tables), "id").withColumn("salt", salt), "dealt_rows")
    tables.drop(docs.sparkSession)
    counts = rows.groupBy("shard", "salt").agg(F.sum("n").alias("n"))
    before = counts.select("shard", "salt", F.coalesce(F.sum("n").over(
        Window.partitionBy("shard").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inside = Window.partitionBy("shard", "salt").orderBy("doc_id", "id").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(before, ["shard", "salt"])
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1))).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("inside") + F.col("copy")).alias("slot"))


def sharded(docs: DataFrame, shards: int = SHARDS, cell: int = CELL, last: int = LAST) -> DataFrame:
    """The rows of ``docs`` with all their columns and ``_shard`` after them; write it with ``partitionBy("_shard")``."""
    # the columns travel under names of their own, so none can clash
    own = {c: f"_c{k}" for k, c in enumerate(docs.columns)}
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in own.items()], F.unhex(F.sha2(text, 256)).alias("id"))
    groups = _rows(docs).groupBy("id").agg(F.sum("size").alias("size"))
    return keyed.join(placed(groups, shards, cell, last), "id").select(*[F.col(n).alias(c) for c, n in own.items()], F.col("shard").alias("_shard"))


def op11(docs: DataFrame) -> DataFrame:
    """Digest columns of the contract: the ``bytes`` law, 16 shards."""
    return assign(docs).select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                               F.lit(None).cast("int").alias("grown_shard"))
