"""The corpus pipeline: quality, line dedup, near-dedup, source mixing, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame, and
``run`` writes each stage's result to the shared folder and rereads it as the next one's documents. All stages
but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from svgspark.llm import line_dedup, mixing, near_dup, packing, quality_rank
from svgspark.llm.common import dropped, noted, table, written

#: Words of a shingle in the near-dedup stage; the 2 of op2_near_dup are that query's contract.
SHINGLE_WORDS = 5


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the Bradley-Terry classifier rejects; trained on the whole corpus' labelled rows.

    A null or empty text is scored like any other, and rows that repeat or have no doc_id are each kept or dropped by
    their text; ties at the threshold stay."""
    model = quality_rank.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality_rank.good_documents(docs, model)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the lines found in ten documents or more; a document keeps its row, and a null text stays null."""
    out = line_dedup.dedup_lines(docs)
    text = F.when(F.col("row.text").isNull(), F.col("row.text")).otherwise(F.col("kept"))
    return _with_text(docs, out.withColumn("text", text))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each group of near copies: 0.8 of their 5-word shingles."""
    kept = near_dup.near_duplicates(docs, SHINGLE_WORDS).where("kept AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n"))
    rows = docs.select(F.struct("*").alias("row"), "doc_id").join(kept, "doc_id")
    # rows that share the doc_id are one document: the row whose JSON has the smallest hash stands for it, since maps have no order
    single = rows.where("n = 1").select("row")
    first = rows.where("n > 1").groupBy("doc_id").agg(F.min_by("row", F.sha2(F.to_json("row"), 256)).alias("row")).select("row")
    none = docs.where("doc_id IS NULL")
    return single.union(first).select("row.*").unionByName(none)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in training order, as often as their source's target takes them."""
    return mixing.curriculum(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return packing.pack(docs)


def _with_text(docs: DataFrame, out: DataFrame) -> DataFrame:
    """The columns of documents, from ``row`` with ``text`` in place of the old one and n_chars to match."""
    return out.select(*[
        F.col("text") if c == "text" else F.char_length("text").cast("long").alias(c) if c == "n_chars" else F.col(f"row.`{c}`").alias(c)
        for c in docs.columns])


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("MinHash near-dedup", near_duplicates),
    ("mixing sources to target weights", mix),
    ("best-fit packing", pack),
]

#: The classifier, the signatures and the tokenizer are beyond SQL: tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces. A stage's scratch tables, and the table it read, go once its own is written; those of the last
    stage stay, since the result reads them."""
    docs, before = table(spark, sf_dir, "documents"), []
    for k, (_, stage) in enumerate(STAGES[:-1]):
        with noted() as paths:
            docs = written(stage(spark, docs, sf_dir), f"stage{k}")
        for path in before + paths[:-1]:
            dropped(spark, path)
        before = paths[-1:]
    return STAGES[-1][1](spark, docs, sf_dir)
