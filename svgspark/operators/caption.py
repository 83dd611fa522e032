"""Captions: prompt grid and assignment, cleaning, merge into the store, training pairs, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from svgspark.functions.text import caption_clean, prompt_text, strip_ws, uniform_u32

# Prompt vocabulary.
STYLES = ["concise", "detailed", "technical", "schematic"]
FOCUSES = ["object", "scene", "color", "action"]
MAX_WORDS = [5, 10, 15, 20, 50]
PROMPT_SEED = 12343


def _arr(vals):
    return F.array(*[F.lit(v) for v in vals])


def prompt_assign(items: DataFrame, key: str = "hash", seed: int = PROMPT_SEED) -> DataFrame:
    """Independent uniform choice of style, focus and word limit per item (md5 of seed, key, slot).
    The 4 x 4 x 5 grid is indexed directly: no join, nothing broadcast."""
    pick = lambda vals, slot: F.element_at(_arr(vals), (uniform_u32(F.lit(seed), F.col(key), F.lit(slot)) % len(vals) + 1).cast("int"))
    out = (items.withColumn("style", pick(STYLES, "style"))
           .withColumn("focus", pick(FOCUSES, "focus"))
           .withColumn("max_words", pick(MAX_WORDS, "words")))
    return out.withColumn("prompt", prompt_text("style", "focus", "max_words"))


def caption_job(items: DataFrame, responses: DataFrame, source: str, key: str = "hash") -> DataFrame:
    """Rendered items joined to the model's responses (hash, prompt, text); cleaned; kept if non-empty.
    Emits caption records ``(hash, caption, source, prompt)`` with a ``kept`` flag."""
    j = prompt_assign(items, key).join(responses.select(key, F.col("text")).hint("merge"), key)
    return (j.withColumn("caption", caption_clean("text"))
            .select(key, "caption", F.lit(source).alias("source"), "prompt", (F.col("caption") != "").alias("kept")))


def model_hook(items: DataFrame, model_fn, key: str = "hash") -> DataFrame:
    """Run a user captioning function over Arrow batches: ``model_fn(pandas.DataFrame[hash, prompt, svg])
    -> pandas.Series`` of answers. The function is the only per-row Python in the caption job."""
    schema = f"{key} string, text string"

    def run(batches):
        import pandas as pd

        for pdf in batches:
            yield pd.DataFrame({key: pdf[key], "text": model_fn(pdf)})

    return items.mapInPandas(run, schema)


def caption_merge(new: DataFrame, store: DataFrame, key: str = "hash") -> DataFrame:
    """Captions to append: stripped, non-empty, not already stored for that hash, not repeated in
    the batch (anti-join on (hash, caption) + dropDuplicates)."""
    clean = new.withColumn("caption", strip_ws("caption")).where(F.col("caption") != "")
    fresh = clean.dropDuplicates([key, "caption"])
    return fresh.join(store.select(key, "caption").hint("merge"), [key, "caption"], "left_anti")


def pair_captions(svgs: DataFrame, captions: DataFrame, key: str = "hash") -> DataFrame:
    """SVG text with each of its captions (inner equi-join on the content hash)."""
    return svgs.select(key, "svg").join(captions.select(key, "caption").hint("merge"), key)
