"""Registered caption queries and scalar-function queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from svgspark.functions import text as X
from svgspark.operators import caption as P
from svgspark.operators import corpus as C
from svgspark.operators import mine as M
from svgspark.operators import select as S
from svgspark.plans.registry import lit, register
from svgspark.sources.tables import duck_with, view

D_CLEAN = f"regexp_replace(regexp_replace(text, '^\\s+|\\s+$', '', 'g'), {lit(X.CAPTION_PREFIX_RE)}, '')"


def d_pick(vals, slot, key="hash"):
    arr = "[" + ", ".join(repr(v) if isinstance(v, str) else str(v) for v in vals) + "]"
    u = f"CAST(('0x' || substr(md5(concat_ws('|', '{P.PROMPT_SEED}', {key}, '{slot}')), 1, 8)) AS UBIGINT)"
    return f"{arr}[CAST({u} % {len(vals)} + 1 AS INTEGER)]"


D_PROMPT = ("format('Describe this {} in {} words or less, {} style. Response in English.', "
            f"{d_pick(P.FOCUSES, 'focus')}, CAST({d_pick(P.MAX_WORDS, 'words')} AS VARCHAR), {d_pick(P.STYLES, 'style')})")


@register("caption_clean", duck_with("caption_raw") + f"SELECT hash, rec_id, {D_CLEAN} AS caption FROM caption_raw")
def q_caption_clean(spark, sf):
    return view(spark, sf, "caption_raw").select("hash", "rec_id", X.caption_clean("text").alias("caption"))


@register("prompt_assign", duck_with("svg_raw") + f"SELECT hash, {D_PROMPT} AS prompt FROM (SELECT DISTINCT md5(svg) AS hash FROM svg_raw) t")
def q_prompt_assign(spark, sf):
    items = view(spark, sf, "svg_raw").select(X.content_hash("svg").alias("hash")).distinct()
    return P.prompt_assign(items).select("hash", "prompt")


@register("prompt_text", duck_with("svg_raw") + f"SELECT hash, {D_PROMPT} AS prompt FROM (SELECT DISTINCT md5(svg) AS hash FROM svg_raw) t")
def q_prompt_text(spark, sf):
    items = view(spark, sf, "svg_raw").select(X.content_hash("svg").alias("hash")).distinct()
    a = P.prompt_assign(items)
    return a.select("hash", X.prompt_text("style", "focus", "max_words").alias("prompt"))


@register("caption_job", duck_with("caption_raw") + f"""SELECT hash, caption, 'InternVL3-2B' AS source, {D_PROMPT} AS prompt, caption <> '' AS kept
FROM (SELECT hash, {D_CLEAN} AS caption FROM caption_raw WHERE hash IN (SELECT md5(svg) FROM svg_raw)) t""")
def q_caption_job(spark, sf):
    items = view(spark, sf, "svg_raw").select(X.content_hash("svg").alias("hash")).distinct()
    return P.caption_job(items, view(spark, sf, "caption_raw"), "InternVL3-2B")


@register("caption_merge", duck_with("caption_raw") + f"""SELECT DISTINCT hash, caption FROM (
  SELECT hash, rec_id, regexp_replace({D_CLEAN}, '^\\s+|\\s+$', '', 'g') AS caption FROM caption_raw) t
WHERE caption <> '' AND rec_id % 2 = 0 AND NOT EXISTS (SELECT 1 FROM (SELECT hash AS h2, {D_CLEAN} AS c2, rec_id AS r2 FROM caption_raw) s
  WHERE s.r2 % 2 = 1 AND s.h2 = t.hash AND s.c2 = t.caption)""")
def q_caption_merge(spark, sf):
    raw = view(spark, sf, "caption_raw").withColumn("caption", X.caption_clean("text"))
    store = raw.where(F.col("rec_id") % 2 == 1)          # first capture run, already stored
    batch = raw.where(F.col("rec_id") % 2 == 0)          # second run, to be merged
    return P.caption_merge(batch, store).select("hash", "caption")


@register("pair_captions", duck_with("caption_raw") + f"""SELECT s.hash, s.svg, c.caption FROM (SELECT DISTINCT md5(svg) AS hash, svg FROM svg_raw) s
JOIN (SELECT hash, {D_CLEAN} AS caption FROM caption_raw) c ON c.hash = s.hash WHERE c.caption <> ''""")
def q_pair_captions(spark, sf):
    svgs = C.store_rows(view(spark, sf, "svg_raw").select(F.col("svg").alias("text")))
    caps = view(spark, sf, "caption_raw").select("hash", X.caption_clean("text").alias("caption")).where(F.col("caption") != "")
    return P.pair_captions(svgs, caps).select("hash", "svg", "caption")


@register("caption_report", duck_with("caption_raw") + f"""SELECT batch, count(*) AS processed, count(*) FILTER (WHERE kept) AS kept,
  CAST(sum(count(*)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS total_processed,
  CAST(sum(count(*) FILTER (WHERE kept)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS total_kept,
  round(count(*) FILTER (WHERE kept) / count(*), 6) AS kept_ratio
FROM (SELECT CAST(floor((row_number() OVER (ORDER BY md5(concat_ws('|', '12343', hash, CAST(rec_id AS VARCHAR), text)), rec_id) - 1) / 64) AS BIGINT) AS batch,
        {D_CLEAN} <> '' AS kept FROM caption_raw) t GROUP BY batch""")
def q_caption_report(spark, sf):
    c = view(spark, sf, "caption_raw")
    c = S.seeded_shuffle(c, P.PROMPT_SEED, "hash", "rec_id", "text").withColumn("kept", X.caption_clean("text") != "")
    c = c.withColumn("tie", F.col("rec_id"))
    r = M.batch_report(c, "shuffle_key", "tie", "kept", 64)
    return r.withColumn("kept_ratio", F.round(F.col("kept") / F.col("processed"), 6))


# ---------------------------------------------------------------- scalar functions (2.6)
@register("shard_of", duck_with("svg_raw") + "SELECT rec_id, substr(md5(svg), 1, 2) AS shard FROM svg_raw")
def q_shard_of(spark, sf):
    return view(spark, sf, "svg_raw").select("rec_id", X.shard_of(X.content_hash("svg")).alias("shard"))


D_ATTR_VALS = "list_transform(regexp_extract_all(svg, '\\s([a-z-]+)=\"([^\"]*)\"', 2), lambda v: v)"


@register("numeric_text", duck_with("svg_raw") + """SELECT rec_id, ord, v AS value_text,
  TRY_CAST(regexp_replace(v, '[A-Za-z]', '', 'g') AS DOUBLE) AS value FROM (
  SELECT rec_id, CAST(unnest(generate_series(0, len(vs) - 1)) AS INTEGER) AS ord, unnest(vs) AS v
  FROM (SELECT rec_id, regexp_extract_all(svg, '\\s(?:width|height|x|y|stroke-width)="([^"]*)"', 1) AS vs FROM svg_raw) a WHERE len(vs) > 0) b""")
def q_numeric_text(spark, sf):
    s = view(spark, sf, "svg_raw")
    vals = s.select("rec_id", F.posexplode(F.regexp_extract_all("svg", F.lit(r'\s(?:width|height|x|y|stroke-width)="([^"]*)"'), 1))
                    .alias("ord", "value_text"))
    return vals.select("rec_id", "ord", "value_text", X.numeric_text("value_text").alias("value"))


@register("style_map", duck_with("svg_styled") + """, st AS (SELECT rec_id, regexp_extract(svg, ' style="([^"]*)"', 1) AS style FROM svg_styled),
d AS (SELECT rec_id, CAST(unnest(generate_series(0, len(ps) - 1)) AS INTEGER) AS i, unnest(ps) AS piece
  FROM (SELECT rec_id, string_split(style, ';') AS ps FROM st) a)
SELECT rec_id, regexp_replace(split_part(piece, ':', 1), '^\\s+|\\s+$', '', 'g') AS key,
  arg_max(regexp_replace(split_part(piece, ':', 2), '^\\s+|\\s+$', '', 'g'), i) AS value
FROM d WHERE len(string_split(piece, ':')) = 2 GROUP BY ALL""")
def q_style_map(spark, sf):
    s = view(spark, sf, "svg_styled").select("rec_id", F.regexp_extract("svg", r' style="([^"]*)"', 1).alias("style"))
    return s.select("rec_id", F.explode(X.style_map("style")).alias("key", "value"))


@register("style_text", duck_with("svg_styled") + """, st AS (SELECT rec_id, regexp_extract(svg, ' style="([^"]*)"', 1) AS style FROM svg_styled)
SELECT rec_id, array_to_string(list_transform(list_filter(string_split(style, ';'), lambda p: len(string_split(p, ':')) = 2),
  lambda p: regexp_replace(split_part(p, ':', 1), '^\\s+|\\s+$', '', 'g') || ':' || regexp_replace(split_part(p, ':', 2), '^\\s+|\\s+$', '', 'g')), ';') AS style
FROM st""")
def q_style_text(spark, sf):
    s = view(spark, sf, "svg_styled").select("rec_id", F.regexp_extract("svg", r' style="([^"]*)"', 1).alias("style"))
    return s.select("rec_id", X.style_text(X.style_map("style")).alias("style"))


@register("local_name", duck_with("svg_raw") + """SELECT rec_id, CAST(unnest(generate_series(0, len(ns) - 1)) AS INTEGER) AS ord,
  unnest(ns) AS qname, regexp_replace(unnest(ns), '^.*[:}]', '') AS tag
FROM (SELECT rec_id, regexp_extract_all(svg, '\\s([A-Za-z:]+)="', 1) AS ns FROM svg_raw) t WHERE len(ns) > 0""")
def q_local_name(spark, sf):
    s = view(spark, sf, "svg_raw").select("rec_id", F.posexplode(F.regexp_extract_all("svg", F.lit(r'\s([A-Za-z:]+)="'), 1)).alias("ord", "qname"))
    return s.select("rec_id", "ord", "qname", X.local_name("qname").alias("tag"))


@register("fix_for_render", duck_with("svg_raw") + """SELECT rec_id,
  CASE WHEN regexp_matches(s, '<svg[^>]*\\sviewBox=') THEN s
       WHEN regexp_matches(s, '<svg[^>]*\\swidth="[^"]*"[^>]*\\sheight="[^"]*"') THEN regexp_replace(s, '<svg',
         '<svg viewBox="0 0 ' || regexp_extract(s, '<svg[^>]*\\swidth="([^"]*)"', 1) || ' ' || regexp_extract(s, '<svg[^>]*\\sheight="([^"]*)"', 1) || '"')
       ELSE s END AS svg
FROM (SELECT rec_id, replace(svg, 'xlink:href=', 'href=') AS s FROM svg_raw) t""")
def q_fix_for_render(spark, sf):
    return view(spark, sf, "svg_raw").select("rec_id", X.fix_for_render("svg").alias("svg"))
