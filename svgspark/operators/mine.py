"""Mining SVG out of fetched pages: extraction, references, first-seen dedup, per-URL results, counters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from svgspark.functions.text import content_hash, shard_of, strip_backslash
from svgspark.functions.url import resolve_url
from svgspark.functions.util import as_col
from svgspark.operators import select as S
from svgspark.session import materialized

# Extraction patterns.
SVG_INLINE_RE = r"(?is)<svg[^>]*>.*?</svg>"   # non-greedy: a nested svg ends at the first close tag
SVG_FALLBACK_RE = r"(?is)<svg\b.*\z"          # unclosed <svg ... to the end of the page
TAG_BODY = r"""(?:[^>"']|"[^"]*"|'[^']*')*>"""
SRC_TAG_RE = r"(?is)<(?:img|object|embed)\b" + TAG_BODY
OBJECT_TAG_RE = r"(?is)<object\b" + TAG_BODY
# The tag patterns for Java's engine: possessive, so that a long tag cannot overflow the stack.
TAG_RUNS = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
SRC_TAG_RUNS = r"(?is)<(?:img|object|embed)\b" + TAG_RUNS
OBJECT_TAG_RUNS = r"(?is)<object\b" + TAG_RUNS
SRC_ATTR_RE = r"""(?is)\ssrc\s*=\s*["']?([^"'\s>]*)"""
DATA_ATTR_RE = r"""(?is)\sdata\s*=\s*["']?([^"'\s>]*)"""

# Batches of a report whose running totals are summed in one task.
BLOCK = 4096

CAND_TYPE = "array<struct<origin:int,ord:int,svg:string,ref:string>>"

# candidate origins, in the order the reference visits them
ORIGIN_INLINE, ORIGIN_FALLBACK, ORIGIN_SRC, ORIGIN_DATA = 0, 1, 2, 3


def inline_matches(html) -> F.Column:
    return F.regexp_extract_all(as_col(html), F.lit(SVG_INLINE_RE), 0)


def extract_inline(pages: DataFrame, html: str = "html", keys=("page_id", "url")) -> DataFrame:
    """One row per non-overlapping ``<svg ...>...</svg>`` match, with its position ``ord``."""
    return pages.select(*keys, F.posexplode(inline_matches(html)).alias("ord", "svg"))


def fallback_svg(html) -> F.Column:
    """Text from an unclosed ``<svg`` to the end of the page ('' when there is none)."""
    return F.regexp_extract(as_col(html), SVG_FALLBACK_RE, 0)


def extract_inline_fallback(pages: DataFrame, html: str = "html", keys=("page_id", "url")) -> DataFrame:
    """Inline matches; for pages where the fast path matched nothing, the lenient fallback instead."""
    m = inline_matches(html)
    cands = F.when(F.size(m) > 0, F.transform(m, lambda s, i: F.struct(F.lit(ORIGIN_INLINE).alias("origin"),
                                                                        i.alias("ord"), s.alias("svg"))))
    fb = F.array(F.struct(F.lit(ORIGIN_FALLBACK).alias("origin"), F.lit(0).alias("ord"), fallback_svg(html).alias("svg")))
    return (pages.select(*keys, F.explode(F.coalesce(cands, fb)).alias("c"))
            .select(*keys, "c.origin", "c.ord", "c.svg")
            .where(F.col("svg") != ""))


def _attr_refs(html, tag_re: str, attr_re: str) -> F.Column:
    """Attribute values of the matching tags, in document order ('' where the tag lacks the attribute)."""
    tags = F.regexp_extract_all(as_col(html), F.lit(tag_re), 0)
    return F.transform(tags, lambda t: F.regexp_extract(t, attr_re, 1))


def svg_ref(ref) -> F.Column:
    """A reference counts when it ends in ``.svg`` (lower-cased; a ``?query`` suffix fails)."""
    r = as_col(ref)
    return (r != "") & F.lower(r).endswith(".svg")


def extract_src_refs(pages: DataFrame, html: str = "html", keys=("page_id", "url")) -> DataFrame:
    refs = F.filter(_attr_refs(html, SRC_TAG_RUNS, SRC_ATTR_RE), lambda r: r != "")
    return (pages.select(*keys, F.posexplode(refs).alias("ord", "ref"))
            .where(svg_ref("ref")))


def extract_data_refs(pages: DataFrame, html: str = "html", keys=("page_id", "url")) -> DataFrame:
    refs = F.filter(_attr_refs(html, OBJECT_TAG_RUNS, DATA_ATTR_RE), lambda r: r != "")
    return (pages.select(*keys, F.posexplode(refs).alias("ord", "ref"))
            .where(svg_ref("ref")))


def page_candidates(pages: DataFrame, html: str = "html", keys=("page_id", "url")) -> DataFrame:
    """All candidates of every page in one pass over ``html``: inline (or fallback) SVG text and
    resolved ``.svg`` references, as rows ``(keys, origin, ord, svg, abs_url)``.

    One scan and one explode; the regexes read ``html`` once per page.
    """
    m = inline_matches(html)
    inline = F.transform(m, lambda s, i: F.struct(F.lit(ORIGIN_INLINE).alias("origin"), i.alias("ord"),
                                                   s.alias("svg"), F.lit(None).cast("string").alias("ref")))
    fb_text = fallback_svg(html)
    fallback = F.when((F.size(m) == 0) & (fb_text != ""), F.array(
        F.struct(F.lit(ORIGIN_FALLBACK).alias("origin"), F.lit(0).alias("ord"), fb_text.alias("svg"),
                 F.lit(None).cast("string").alias("ref")))).otherwise(F.array().cast(CAND_TYPE))

    def refs(tag_re, attr_re, origin):
        rs = F.filter(_attr_refs(html, tag_re, attr_re), lambda r: r != "")
        return F.filter(F.transform(rs, lambda r, i: F.struct(F.lit(origin).alias("origin"), i.alias("ord"),
                                                               F.lit(None).cast("string").alias("svg"), r.alias("ref"))),
                        lambda c: svg_ref(c["ref"]))

    allc = F.concat(inline, fallback, refs(SRC_TAG_RUNS, SRC_ATTR_RE, ORIGIN_SRC), refs(OBJECT_TAG_RUNS, DATA_ATTR_RE, ORIGIN_DATA))
    out = pages.select(*keys, F.explode(allc).alias("c")).select(*keys, "c.origin", "c.ord", "c.svg", "c.ref")
    return out.withColumn("abs_url", F.when(F.col("ref").isNotNull(), resolve_url(F.col("url"), F.col("ref"))))


def fetched_assets(assets: DataFrame, max_chars: int = S.MAX_SVG_CHARS) -> DataFrame:
    """Fetched SVG bodies as ``(_k, _asset, _asset_chars, _asset_hash)``: each is stripped and hashed once, however many
    pages refer to it. A body of more than ``max_chars`` characters has no hash."""
    ok = S.svg_response(assets).where(F.col("body").isNotNull() & (F.col("body") != ""))
    return (ok.select(F.col("abs_url").alias("_k"), strip_backslash("body").alias("_asset"))
            .withColumn("_asset_chars", F.length("_asset").cast("bigint"))
            .withColumn("_asset_hash", F.when(F.col("_asset_chars") <= max_chars, content_hash("_asset"))))


def join_assets(cands: DataFrame, fetched: DataFrame) -> DataFrame:
    """Attach ``fetched_assets`` rows to reference candidates (``left`` join, one row per candidate).

    Inline candidates carry no URL; they get a unique non-matching join key so they spread over
    all partitions instead of piling onto the NULL-key partition. Assets are not broadcast: their file is far smaller
    than their bodies.
    """
    salted = F.coalesce(F.col("abs_url"), F.concat(F.lit("\u0000"), F.col("page_id").cast("string"), F.lit(":"),
                                                   F.col("origin").cast("string"), F.lit(":"), F.col("ord").cast("string")))
    return cands.withColumn("_k", salted).join(fetched.hint("merge"), "_k", "left").drop("_k")


def judged_candidates(pages_ok: DataFrame, assets: DataFrame, max_chars: int = S.MAX_SVG_CHARS, bodies: bool = True) -> DataFrame:
    """Every candidate with ``external`` (a reference), ``found`` (it passes its gates), ``svg``, ``n_chars`` and ``hash``.

    Inline/fallback: found unless use-only, backslashes stripped. References: found when a body that is not empty was
    fetched. A candidate that is not found, or of more than ``max_chars`` characters, has no hash. Without ``bodies``
    the ``svg`` of references is NULL, so a popular asset is not copied to every page that refers to it.
    """
    fetched = fetched_assets(assets, max_chars)
    c = join_assets(page_candidates(pages_ok), fetched if bodies else fetched.drop("_asset"))
    external = F.col("ref").isNotNull()
    own = strip_backslash("svg")
    return (c.withColumn("external", external)
            .withColumn("found", F.when(external, F.col("_asset_chars").isNotNull()).otherwise(~S.is_use_only(F.col("svg"))))
            .withColumn("svg", F.coalesce(own, "_asset") if bodies else own)
            .withColumn("n_chars", F.coalesce("_asset_chars", F.length("svg").cast("bigint")))
            .withColumn("hash", F.when(F.col("external"), F.col("_asset_hash"))
                        .when(F.col("found") & (F.col("n_chars") <= max_chars), content_hash("svg")))
            .drop("_asset", "_asset_chars", "_asset_hash"))


def candidate_svgs(pages_ok: DataFrame, assets: DataFrame, max_chars: int = S.MAX_SVG_CHARS, bodies: bool = True) -> DataFrame:
    """The candidates that pass their gates; ``rejected_svgs`` lists those among them without a hash."""
    return judged_candidates(pages_ok, assets, max_chars, bodies).where("found").drop("found")


def first_seen(df: DataFrame, key: str = "hash", order=("page_id", "origin", "ord")) -> DataFrame:
    """One row per key: the earliest by ``order``. ``min_by`` aggregates partially map-side, so a hot
    key (one icon on a third of all pages) collapses before the shuffle instead of landing in one task."""
    cols = [c for c in df.columns if c != key]
    best = F.min_by(F.struct(*[F.col(c) for c in cols]), F.struct(*[F.col(c) for c in order]))
    return df.groupBy(key).agg(best.alias("_b")).select(key, "_b.*")


def fetched_pages(fetch_log: DataFrame) -> DataFrame:
    """Best attempt per URL that is an HTML page with a body: ``(page_id, url, html)``.

    The best attempt is a page only if it succeeded, so bodies of failed attempts and of other types are not shuffled."""
    got = fetch_log.where(F.col("status") < 400).select(
        "page_id", "url", "attempt", "status", "content_type", F.when(F.lower("content_type").contains("html"), F.col("body")).alias("body"))
    return S.html_response(S.best_attempt(got)).select("page_id", "url", F.col("body").alias("html"))


def rejected_svgs(fetch_log: DataFrame, assets: DataFrame, max_chars: int = S.MAX_SVG_CHARS) -> DataFrame:
    """Candidates that ``mine_svgs`` leaves out for their length: ``(page_id, url, origin, ord, n_chars, reason)``."""
    cands = candidate_svgs(fetched_pages(fetch_log), assets, max_chars, bodies=False).where("hash IS NULL AND n_chars IS NOT NULL")
    return cands.select("page_id", "url", "origin", "ord", "n_chars", F.lit(f"longer than {max_chars} characters").alias("reason"))


def mine_svgs(fetch_log: DataFrame, assets: DataFrame, max_chars: int = S.MAX_SVG_CHARS) -> DataFrame:
    """Flagship: fetched pages -> candidates -> gates -> md5 -> first-seen dedup -> sharded rows.

    Bodies of assets join the winners only, on the hash by which these already lie."""
    cands = candidate_svgs(fetched_pages(fetch_log), assets, max_chars, bodies=False).where(F.col("hash").isNotNull())
    won = first_seen(cands.select("hash", "page_id", "origin", "ord", "url", "svg", "n_chars"))
    bodies = (fetched_assets(assets, max_chars).where(F.col("_asset_hash").isNotNull())
              .groupBy(F.col("_asset_hash").alias("hash")).agg(F.any_value("_asset").alias("_asset")))
    return (won.join(bodies, "hash", "left").withColumn("svg", F.coalesce("svg", "_asset")).drop("_asset")
            .withColumn("shard", shard_of("hash")))


def mined_hashes(fetch_log: DataFrame, assets: DataFrame, max_chars: int = S.MAX_SVG_CHARS) -> DataFrame:
    """The hashes and shards of ``mine_svgs``, for counts: no body is shuffled."""
    cands = candidate_svgs(fetched_pages(fetch_log), assets, max_chars, bodies=False)
    return cands.where(F.col("hash").isNotNull()).select("hash").distinct().withColumn("shard", shard_of("hash"))


def _candidate_table(fetch_log: DataFrame, assets: DataFrame, max_chars: int) -> DataFrame:
    """The candidates of all pages without their texts, written once: reports read them several times."""
    judged = judged_candidates(fetched_pages(fetch_log), assets, max_chars, bodies=False)
    return materialized(judged.select("page_id", "origin", "ord", "external", "found", "abs_url", "hash"), "candidates")


def time_taken(fetch_log: DataFrame, max_attempts: int = S.MAX_ATTEMPTS) -> DataFrame:
    """``(url, page_ms)``: what the attempts up to the best one took (all of them where none succeeded)."""
    tries = fetch_log.where(F.col("attempt").between(1, max_attempts))
    last = F.coalesce(F.min(F.when(F.col("status") < 400, F.col("attempt"))), F.lit(max_attempts))
    spent = [F.coalesce(F.sum(F.when(F.col("attempt") == k, F.col("ms"))), F.lit(0)) for k in range(1, max_attempts + 1)]
    per = tries.groupBy("url").agg(last.alias("_last"), *[x.alias(f"_ms{k}") for k, x in enumerate(spent, 1)])
    total = sum((F.when(F.col("_last") >= k, F.col(f"_ms{k}")).otherwise(0) for k in range(1, max_attempts + 1)), F.lit(0))
    return per.select("url", total.cast("bigint").alias("page_ms"))


def url_result(fetch_log: DataFrame, assets: DataFrame, max_chars: int = S.MAX_SVG_CHARS) -> DataFrame:
    """Per URL: success, svg_matched (inline regex matches), svg_found, svg_saved, time_taken (seconds).

    Inline candidates count as found only when newly saved; references count as found when the
    fetch returned a body, and as saved when new. The time is that of the page's attempts and of the assets that it
    refers to (``ms`` of the fetch log and of the assets; an asset's retries are part of its time).
    """
    flagged = fetch_log.withColumn("body", F.when(F.col("body") != "", F.lit("b")))  # whether there is one, not what it says
    best = S.best_attempt(flagged).join(time_taken(fetch_log), "url", "left")
    cands = _candidate_table(fetch_log, assets, max_chars)
    won = first_seen(cands.where(F.col("hash").isNotNull()).select("hash", "page_id", "origin", "ord"))
    saved = won.groupBy("page_id").agg(F.count(F.lit(1)).alias("svg_saved"),
                                      F.count_if(F.col("origin") <= ORIGIN_FALLBACK).alias("_inline_saved"))
    seen = cands.groupBy("page_id").agg(F.count_if(F.col("origin") == ORIGIN_INLINE).alias("svg_matched"),
                                        F.count_if(F.col("external") & F.col("found")).alias("_ext_found"))
    fetches = (cands.where("external").select("page_id", "abs_url").join(assets.select("abs_url", "ms"), "abs_url")
               .groupBy("page_id").agg(F.sum("ms").alias("_ref_ms")))
    ok = best.select("page_id", "url", "page_ms", (F.col("success") & F.lower("content_type").contains("html")
                                                   & F.col("body").isNotNull()).alias("success"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    return (ok.join(seen, "page_id", "left")
            .join(saved, "page_id", "left")
            .join(fetches, "page_id", "left")
            .select("url", "success",
                    zero("svg_matched").cast("bigint").alias("svg_matched"),
                    (zero("_inline_saved") + zero("_ext_found")).cast("bigint").alias("svg_found"),
                    zero("svg_saved").cast("bigint").alias("svg_saved"),
                    ((zero("page_ms") + zero("_ref_ms")) / 1000).alias("time_taken")))


def crawl_counters(fetch_log: DataFrame, assets: DataFrame, max_chars: int = S.MAX_SVG_CHARS) -> DataFrame:
    """One row: pages_fetched, failed_fetches, retried_requests, svg_saved.

    Page fetches come from the fetch log (attempts capped at 3); every reference fetch of a page
    counts too: a failing asset status is retried twice and then counted as failed.
    """
    best = S.best_attempt(fetch_log.select("url", "attempt", "status", "content_type"))
    page_stats = best.agg(
        F.count_if(F.col("success") & F.lower("content_type").contains("html")).alias("pages_fetched"),
        F.count_if(~F.col("success")).alias("page_failed"),
        F.sum(F.col("n_attempts") - 1).alias("page_retried"),
    )
    cands = _candidate_table(fetch_log, assets, max_chars)
    ref_stats = (cands.where("external").select("abs_url").join(assets.select("abs_url", "status"), "abs_url", "left")
                 .agg(F.count_if(F.coalesce(F.col("status"), F.lit(404)) >= 400).alias("ref_failed")))
    saved = cands.agg(F.count_distinct("hash").alias("svg_saved"))
    # three one-row partial results, stacked and summed (no join needed)
    parts = page_stats.unionByName(ref_stats, allowMissingColumns=True).unionByName(saved, allowMissingColumns=True)
    z = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return parts.agg(
        z("pages_fetched").cast("bigint").alias("pages_fetched"),
        (z("page_failed") + z("ref_failed")).cast("bigint").alias("failed_fetches"),
        (z("page_retried") + 2 * z("ref_failed")).cast("bigint").alias("retried_requests"),
        z("svg_saved").cast("bigint").alias("svg_saved"),
    )


def shard_counts(mined: DataFrame) -> DataFrame:
    return mined.groupBy("shard").agg(F.count(F.lit(1)).alias("n_svg"))


def exact_distinct(df: DataFrame, key: str = "hash") -> DataFrame:
    return df.agg(F.count_distinct(key).alias("n_distinct"), F.count(F.lit(1)).alias("n_rows"))


def new_per_minute(first: DataFrame, ts: str = "ts") -> DataFrame:
    """Newly unique items per minute and the running total. The running window runs on the
    per-minute aggregate (one row per minute), never on row-level data."""
    per = (first.groupBy(F.window(F.col(ts).cast("timestamp"), "1 minute").alias("w"))
           .agg(F.count(F.lit(1)).alias("n_new"))
           .select(F.col("w.start").alias("minute"), "n_new"))
    return per.withColumn("n_total", F.sum("n_new").over(Window.orderBy("minute").rowsBetween(Window.unboundedPreceding, 0)))


def dedup_growth(items: DataFrame, key: str = "hash", ts: str = "ts", unit: str = "hour") -> DataFrame:
    """Processed vs unique over time (cumulative per ``unit``), from two small per-unit aggregates."""
    bucket = F.date_trunc(unit, F.col(ts))
    processed = items.groupBy(bucket.alias("t")).agg(F.count(F.lit(1)).alias("n_processed"))
    firsts = items.groupBy(key).agg(F.min(ts).alias("_first"))
    uniques = firsts.groupBy(F.date_trunc(unit, F.col("_first")).alias("t")).agg(F.count(F.lit(1)).alias("n_new"))
    w = Window.orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    return (processed.join(uniques, "t", "full")
            .select("t", F.coalesce("n_processed", F.lit(0)).alias("n_processed"), F.coalesce("n_new", F.lit(0)).alias("n_new"))
            .withColumn("cum_processed", F.sum("n_processed").over(w))
            .withColumn("cum_unique", F.sum("n_new").over(w)))


def growth_fit(growth: DataFrame) -> DataFrame:
    """Power-law fit unique = a * processed^b over the cumulative curve (log-log least squares)."""
    return growth.agg(
        F.regr_slope(F.ln("cum_unique"), F.ln("cum_processed")).alias("exponent"),
        F.regr_intercept(F.ln("cum_unique"), F.ln("cum_processed")).alias("log_coef"),
    )


def month_estimate(growth: DataFrame, unit_hours: float = 1.0, hours: float = 720.0) -> DataFrame:
    """One row: items processed and unique after ``hours`` at the mean rate of the curve, by its power-law fit. ``growth``
    has a row for each of its units, of ``unit_hours`` each; units without items count as time that passed."""
    span = (F.unix_timestamp(F.max("t").cast("timestamp")) - F.unix_timestamp(F.min("t").cast("timestamp"))) / 3600 + unit_hours
    one = growth.agg(F.regr_slope(F.ln("cum_unique"), F.ln("cum_processed")).alias("exponent"),
                     F.regr_intercept(F.ln("cum_unique"), F.ln("cum_processed")).alias("log_coef"),
                     (F.max("cum_processed") / span * hours).alias("month_processed"))
    return one.withColumn("month_unique", F.exp(F.col("log_coef") + F.col("exponent") * F.ln("month_processed")))


def accuracy_pivot(predictions: DataFrame, tasks: list[str]) -> DataFrame:
    """Accuracy for each model, a column for each task; NULL where a model has no prediction for it."""
    return (predictions.groupBy("model").pivot("task", tasks)
            .agg(F.round(F.avg((F.col("pred") == F.col("label")).cast("double")), 6)))


def batch_report(df: DataFrame, order_col: str, tie_col: str, kept, batch_size: int) -> DataFrame:
    """Rows cut into batches of ``batch_size`` in (order_col, tie_col) order; per batch processed and
    kept, with running totals. Uses the bucketed global rank (no single-partition window on rows)."""
    ranked = S.global_rank(df, order_col, tie_col, "_rn")
    per = (ranked.withColumn("batch", F.floor((F.col("_rn") - 1) / batch_size).cast("bigint"))
           .groupBy("batch").agg(F.count(F.lit(1)).alias("processed"), F.count_if(as_col(kept)).alias("kept")))
    # running totals in two levels: inside blocks of batches, and over the blocks
    per = per.withColumn("_block", F.floor(F.col("batch") / BLOCK))
    blocks = per.groupBy("_block").agg(F.sum("processed").alias("_p"), F.sum("kept").alias("_k"))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("_block", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in ("_p", "_k")])
    w = Window.partitionBy("_block").orderBy("batch").rowsBetween(Window.unboundedPreceding, 0)
    return (per.withColumn("_sp", F.sum("processed").over(w)).withColumn("_sk", F.sum("kept").over(w)).join(blocks, "_block")
            .select("batch", "processed", "kept", (F.col("_p") + F.col("_sp")).alias("total_processed"), (F.col("_k") + F.col("_sk")).alias("total_kept")))
