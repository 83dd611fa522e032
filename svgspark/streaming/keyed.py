"""A keyed table that the micro-batches of an update-mode query write: the newest row of each key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType


class KeyedTable:
    """Micro-batch ``i`` writes the rows it changed as the folder ``batch=i``; a reader takes each key's row of the largest
    batch. A replayed batch replaces its own folder, so it changes nothing, and a batch costs what it changed. Every
    ``compact_every`` batches the folders become one ``base=i``, which counts once it is complete; folders that the
    base before it covers are deleted, so a reader that listed them a generation ago still finds them."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], schema: StructType, compact_every: int = 16) -> None:
        self.spark, self.path, self.keys, self.compact_every = spark, path, keys, compact_every
        self.schema = StructType([*schema.fields, StructField("_batch", LongType())])
        self.values = [f.name for f in schema.fields if f.name not in keys]

    def _fs(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _folders(self, kind: str) -> list[int]:
        """The numbers of the complete folders of a kind, ascending."""
        path, fs = self._fs()
        if not fs.exists(path):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(path)]
        done = [n for n in names if n.startswith(f"{kind}=") and fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{n}/_SUCCESS"))]
        return sorted(int(n.split("=")[1]) for n in done)

    def write(self, batch: DataFrame, epoch: int) -> None:
        """The ``foreachBatch`` function."""
        bases = self._folders("base")
        if bases and epoch <= bases[-1]:
            return  # a replay of what the base holds
        batch.withColumn("_batch", F.lit(epoch).cast("long")).write.mode("overwrite").parquet(f"{self.path}/batch={epoch}")
        if (epoch + 1) % self.compact_every == 0:
            self._newest().write.mode("overwrite").parquet(f"{self.path}/base={epoch}")
            self._clear(bases)

    def _clear(self, bases: list[int]) -> None:
        if not bases:
            return
        _, fs = self._fs()
        old = [f"batch={i}" for i in self._folders("batch") if i <= bases[-1]] + [f"base={i}" for i in bases[:-1]]
        for name in old:
            fs.delete(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}"), True)

    def _newest(self) -> DataFrame:
        bases = self._folders("base")
        last = bases[-1] if bases else -1
        paths = [f"{self.path}/base={last}"] if bases else []
        paths += [f"{self.path}/batch={i}" for i in self._folders("batch") if i > last]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(self.schema).parquet(*paths)
        row = F.max_by(F.struct(*self.values, "_batch"), "_batch").alias("row")
        return rows.groupBy(*self.keys).agg(row).select(*self.keys, "row.*")

    def read(self) -> DataFrame:
        return self._newest().drop("_batch")
