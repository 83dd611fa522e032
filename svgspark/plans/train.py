"""Registered training-set queries and augmentation."""

from __future__ import annotations

from pyspark.sql import functions as F

from svgspark.functions.text import caption_clean, content_hash
from svgspark.operators import caption as P
from svgspark.operators import corpus as C
from svgspark.operators import train as TR
from svgspark.operators import tree as T
from svgspark.plans.registry import lit, register
from svgspark.plans.tree import d_tokens, ok_lists, ok_tokens
from svgspark.session import once
from svgspark.sources.tables import duck_with, view

SEED = 2998
D_U = "CAST(('0x' || substr(md5(concat_ws('|', {})), 1, 8)) AS UBIGINT) / 4294967296.0"
D_CLEAN = f"regexp_replace(regexp_replace(text, '^\\s+|\\s+$', '', 'g'), {lit(r'(?i)^(Caption:|Description:|Image shows:)\s*')}, '')"
HEAD = f"{TR.IM_START}system\n{TR.SYSTEM_TEXT}{TR.IM_END}\n{TR.IM_START}user\n{TR.USER_TEXT}"
D_PAIRS = f"""pairs AS (SELECT s.hash, s.svg, c.caption FROM (SELECT DISTINCT md5(svg) AS hash, svg FROM svg_raw) s
  JOIN (SELECT hash, {D_CLEAN} AS caption FROM caption_raw) c ON c.hash = s.hash WHERE c.caption <> '')"""


def _pairs(spark, sf):
    svgs = C.store_rows(view(spark, sf, "svg_raw").select(F.col("svg").alias("text")))
    caps = view(spark, sf, "caption_raw").select("hash", caption_clean("text").alias("caption")).where(F.col("caption") != "")
    return P.pair_captions(svgs, caps)


@register("chat_format", duck_with("caption_raw") + ", " + D_PAIRS + f"""
SELECT hash, caption, {lit(HEAD)} || caption || {lit(TR.IM_END + chr(10) + TR.IM_START + 'assistant' + chr(10))} || svg || {lit(TR.IM_END)} AS text FROM pairs""")
def q_chat_format(spark, sf):
    return TR.chat_format(_pairs(spark, sf)).select("hash", "caption", "text")


@register("chat_format_infer", duck_with("caption_raw") + ", " + D_PAIRS + f"""
SELECT hash, caption, {lit(HEAD)} || caption || {lit(TR.IM_END + chr(10) + TR.IM_START + 'assistant' + chr(10))} AS text FROM pairs""")
def q_chat_format_infer(spark, sf):
    return TR.chat_format(_pairs(spark, sf), infer=True).select("hash", "caption", "text")


D_CONV = f"""packed AS (SELECT conv_id, string_agg({lit(TR.IM_START)} || role || chr(10) || text || {lit(TR.IM_END)}, chr(10) ORDER BY turn) AS text,
  CAST(count(*) AS INTEGER) AS n_turns FROM conversations GROUP BY conv_id)"""


@register("conversation_pack", "WITH " + D_CONV + "\nSELECT conv_id, text, n_turns FROM packed")
def q_conversation_pack(spark, sf):
    return TR.conversation_pack(view(spark, sf, "conversations"))


@register("response_spans", "WITH " + D_CONV + f"""
SELECT conv_id, CAST(len(spans) AS INTEGER) AS n_spans, CAST(coalesce(list_sum(list_transform(spans, lambda s: s.e - s.b)), 0) AS INTEGER) AS response_chars,
  array_to_string(list_transform(spans, lambda s: s.b || ':' || s.e), ';') AS spans
FROM (SELECT conv_id, list_transform(generate_series(2, len(parts)), lambda i: {{'b': b(parts, i), 'e': b(parts, i) + length(split_part(parts[i], {lit(TR.INSTRUCTION_MARK)}, 1))}}) AS spans
  FROM (SELECT conv_id, string_split(text, {lit(TR.RESPONSE_MARK)}) AS parts FROM packed) t) u""".replace("b(parts, i)",
  f"list_sum(list_transform(parts[1:i - 1], lambda p: length(p))) + {len(TR.RESPONSE_MARK)} * (i - 1)"))
def q_response_spans(spark, sf):
    return TR.response_spans(TR.conversation_pack(view(spark, sf, "conversations"))).select(
        "conv_id", "n_spans", "response_chars", F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"])), ";").alias("spans"))


@register("split_rows", f"""SELECT doc_id, CASE WHEN {D_U.format(f"'{SEED}', md5(text)")} < 0.05 THEN 'val' ELSE 'train' END AS split FROM documents""")
def q_split_rows(spark, sf):
    d = view(spark, sf, "documents").withColumn("h", content_hash("text"))
    return TR.split_rows(d, "h").select("doc_id", "split")


@register("special_token_counts", duck_with("svg_raw") + f""", c AS (SELECT regexp_replace(u, '\\s*[=(]$', '') AS token, count(*) AS n
  FROM (SELECT unnest(regexp_extract_all(svg, {lit(TR.SPECIAL_UNIT_RE)}, 0)) AS u FROM svg_raw) t GROUP BY 1)
SELECT t.token, CAST(coalesce(n, 0) AS BIGINT) AS n FROM (SELECT DISTINCT unnest([{", ".join(lit(t) for t in TR.SPECIAL_TOKENS)}]) AS token) t
LEFT JOIN c USING (token)""")
def q_special_token_counts(spark, sf):
    return TR.special_token_counts(view(spark, sf, "svg_raw"))


@register("pretoken_counts", f"""SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, {lit(TR.PRETOKEN_RE)}, 0)) AS word FROM documents) t
GROUP BY word HAVING count(*) >= 3""")
def q_pretoken_counts(spark, sf):
    return TR.pretoken_counts(view(spark, sf, "documents"))


def _learned(spark, sf):
    """(merges, alphabet) up to the vocabulary target, or until every word is one token; learned once for all queries."""
    def write(folder):
        wc = TR.unit_counts(view(spark, sf, "documents")).checkpoint()  # read for the alphabet and for the merges
        alphabet = wc.select(F.explode(F.split("word", "")).alias("token")).where(F.col("token") != "").distinct()
        known = {*TR.BASE_SPECIALS, *TR.SPECIAL_TOKENS, *(r["token"] for r in alphabet.collect())}  # at most Unicode's characters
        alphabet.write.parquet(f"{folder}/alphabet")
        TR.bpe_merges(spark, wc, TR.VOCAB_TARGET - len(known), TR.MERGES_PER_ROUND, known).write.parquet(f"{folder}/merges")

    folder = once(spark, "vocabulary", [f"{sf.rstrip('/')}/documents.parquet"], write)
    return spark.read.parquet(f"{folder}/merges"), spark.read.parquet(f"{folder}/alphabet")


@register("bpe_merges")
def q_bpe_merges(spark, sf):
    return _learned(spark, sf)[0]


@register("vocab_table")
def q_vocab_table(spark, sf):
    return TR.vocab_table(spark, *_learned(spark, sf))


@register("encode_corpus")
def q_encode_corpus(spark, sf):
    docs = view(spark, sf, "documents")
    merges = [(r["a"], r["b"]) for r in _learned(spark, sf)[0].orderBy("rank").collect()]  # at most the vocabulary target
    # a run of a document is one row with its count, so a frequent one joins once for each document
    counted = TR.runs(docs, "text", "doc_id").groupBy("doc_id", "run").agg(F.count(F.lit(1)).alias("n"))
    units = TR.pretokens(TR.runs(docs).distinct(), "run", "run", TR.UNIT_RE).select("run", "word")
    enc = TR.encode_words(units.select("word").distinct(), merges).select("word", F.size("tokens").alias("size"))
    sizes = units.join(enc.hint("merge"), "word").groupBy("run").agg(F.sum("size").alias("size"))
    per = counted.join(sizes.hint("merge"), "run").groupBy("doc_id").agg(F.sum(F.col("size") * F.col("n")).alias("n"))
    return docs.select("doc_id").join(per, "doc_id", "left").select("doc_id", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_tokens"))


@register("fertility", f"""SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars, CAST(len(regexp_extract_all(text, {lit(TR.PRETOKEN_RE)}, 0)) AS BIGINT) AS n_tokens,
  round(length(text) / greatest(len(regexp_extract_all(text, {lit(TR.PRETOKEN_RE)}, 0)), 1), 6) AS chars_per_token FROM documents""")
def q_fertility(spark, sf):
    d = view(spark, sf, "documents")
    n = F.size(F.regexp_extract_all("text", F.lit(TR.PRETOKEN_RE), 0))
    return d.select("doc_id", F.length("text").cast("bigint").alias("n_chars"), n.cast("bigint").alias("n_tokens"),
                    F.round(F.length("text") / F.greatest(n, F.lit(1)), 6).alias("chars_per_token"))


@register("fertility_learned")
def q_fertility_learned(spark, sf):
    """Characters per token of the learned vocabulary."""
    chars = view(spark, sf, "documents").select("doc_id", F.length("text").cast("bigint").alias("n_chars"))
    return chars.join(q_encode_corpus(spark, sf), "doc_id").select(
        "doc_id", "n_chars", "n_tokens", F.round(F.col("n_chars") / F.greatest("n_tokens", F.lit(1)), 6).alias("chars_per_token"))


D_TL = duck_with("tokens_len")


@register("truncate_seq", D_TL + "SELECT doc_id, CAST(least(n_tok, 1024) AS BIGINT) AS n_kept, n_tok > 1024 AS truncated FROM tokens_len")
def q_truncate_seq(spark, sf):
    return TR.truncate_seq(view(spark, sf, "tokens_len"), 1024).select("doc_id", "n_kept", "truncated")


@register("stage_assign", D_TL + """SELECT CASE WHEN n_tok <= 1024 THEN 'stage1' WHEN n_tok <= 8192 THEN 'stage2' ELSE 'stage3' END AS stage,
  count(*) AS n_docs, CAST(sum(n_tok) AS BIGINT) AS n_tokens FROM tokens_len GROUP BY 1""")
def q_stage_assign(spark, sf):
    s = TR.stage_assign(view(spark, sf, "tokens_len"))
    return s.groupBy("stage").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_tok").cast("bigint").alias("n_tokens"))


@register("mlm_select", D_TL + f"""SELECT doc_id, CAST((SELECT count(*) FROM generate_series(0, n_tok - 1) g(i)
  WHERE {D_U.format("'7', CAST(doc_id AS VARCHAR), CAST(i AS VARCHAR)")} < 0.3) AS BIGINT) AS n_masked FROM tokens_len""")
def q_mlm_select(spark, sf):
    return TR.mlm_select(view(spark, sf, "tokens_len"), 0.3, 7).select("doc_id", "n_masked")


@register("token_budget", D_TL + f"""SELECT doc_id, n_tok, cum_tok FROM (SELECT doc_id, n_tok,
  CAST(sum(n_tok) OVER (ORDER BY md5(concat_ws('|', '{SEED}', CAST(doc_id AS VARCHAR))), doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cum_tok
  FROM tokens_len) t WHERE cum_tok - n_tok < 100000""")
def q_token_budget(spark, sf):
    return TR.token_budget(view(spark, sf, "tokens_len"), 100000, SEED).select("doc_id", F.col("n_tok").cast("bigint"), "cum_tok")


D_NEXT_FIT = (D_TL.replace("WITH ", "WITH RECURSIVE ", 1) + f""", r AS (SELECT doc_id, least(n_tok, 1024) AS len,
  row_number() OVER (ORDER BY md5(concat_ws('|', '{SEED}', CAST(doc_id AS VARCHAR))), doc_id) - 1 AS rn FROM tokens_len),
g AS (SELECT rn // 256 AS group_id, rn % 256 AS i, doc_id, len FROM r),
p AS (SELECT group_id, i, doc_id, len, 0 AS bin, len AS used FROM g WHERE i = 0
  UNION ALL SELECT g.group_id, g.i, g.doc_id, g.len, CASE WHEN p.used + g.len > 1024 AND p.used > 0 THEN p.bin + 1 ELSE p.bin END,
    CASE WHEN p.used + g.len > 1024 AND p.used > 0 THEN g.len ELSE p.used + g.len END FROM p JOIN g ON g.group_id = p.group_id AND g.i = p.i + 1)
""")


@register("pack_sequences", D_NEXT_FIT + "SELECT CAST(group_id AS BIGINT) AS group_id, bin, doc_id, CAST(len AS BIGINT) AS n_tok FROM p")
def q_pack_sequences(spark, sf):
    return TR.pack_sequences(view(spark, sf, "tokens_len"), 1024, SEED)


@register("packing_efficiency", D_NEXT_FIT + """SELECT count(*) AS n_bins, CAST(sum(used) AS BIGINT) AS used_tokens,
  round(sum(used) / (count(*) * 1024), 6) AS efficiency FROM (SELECT group_id, bin, sum(len) AS used FROM p GROUP BY ALL) b""")
def q_packing_efficiency(spark, sf):
    return TR.packing_efficiency(TR.pack_sequences(view(spark, sf, "tokens_len"), 1024, SEED), 1024)


@register("optimized_pairs", duck_with("stage_out") + f""", ok AS (SELECT rec_id, md5(raw) AS raw, md5(stage2) AS stage2 FROM stage_out WHERE stage2 IS NOT NULL),
r AS (SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', '{SEED}', CAST(rec_id AS VARCHAR))), rec_id) AS rn FROM ok)
SELECT rec_id, raw AS a, stage2 AS b, 1 AS label FROM r
UNION ALL SELECT r.rec_id, r.raw, n.stage2, 0 FROM r JOIN r n ON n.rn = CASE WHEN r.rn = (SELECT max(rn) FROM r) THEN 1 ELSE r.rn + 1 END
WHERE n.stage2 <> r.stage2""")
def q_optimized_pairs(spark, sf):
    s = view(spark, sf, "stage_out")
    lin = s.select("rec_id", content_hash("raw").alias("raw"),
                   F.when(F.col("stage2").isNotNull(), content_hash("stage2")).alias("stage2"))
    return TR.optimized_pairs(lin, SEED)


D_FILLS = duck_with("svg_raw") + ",\n" + d_tokens() + f""",
e AS (SELECT okel.*, md5(s.svg) AS hash FROM okel JOIN svg_raw s USING (rec_id)),
fills AS (SELECT rec_id, open_pos, {D_U.format("'5', hash, 'root'")} < 0.1 AS root_mode,
  CASE WHEN {D_U.format("'5', hash, 'root'")} < 0.1 AND depth = 0 THEN '#' || upper(substr(md5(concat_ws('|', '5', hash, 'rootfill')), 1, 6))
       WHEN {D_U.format("'5', hash, 'root'")} < 0.1 THEN NULL
       WHEN tag = 'path' THEN '#' || upper(substr(md5(concat_ws('|', '5', hash, CAST(open_pos AS VARCHAR))), 1, 6))
       ELSE CASE WHEN regexp_matches(tok, '\\sfill="') THEN regexp_extract(tok, '\\sfill="([^"]*)"', 1) END END AS new_fill
FROM e)
"""


HASHED = ("hash", "root_mode")


def _hashed_tokens(spark, sf, seed=5):
    """``ok_tokens`` with the hash of their record's text and what follows from it, which join the token lists."""
    h = view(spark, sf, "svg_raw").select("rec_id", content_hash("svg").alias("hash")).withColumn("root_mode", TR.root_mode(seed))
    return T.exploded(ok_lists(spark, sf).join(h.hint("merge"), "rec_id"), carry=HASHED)


@register("augment_fill", D_FILLS + "SELECT rec_id, open_pos, root_mode, new_fill FROM fills")
def q_augment_fill(spark, sf):
    el = T.lower_attrs(T.svg_elements(_hashed_tokens(spark, sf), carry=HASHED))
    return TR.augment_fill(el, 5).select("rec_id", "open_pos", "root_mode", "new_fill")


@register("augment_svg", D_FILLS + """, pieces AS (SELECT t.rec_id, t.pos, CASE WHEN f.rec_id IS NULL THEN t.tok
    WHEN f.new_fill IS NULL THEN regexp_replace(t.tok, '\\sfill="[^"]*"', '')
    WHEN regexp_matches(t.tok, '\\sfill="') THEN regexp_replace(t.tok, '\\sfill="[^"]*"', ' fill="' || f.new_fill || '"')
    ELSE regexp_replace(t.tok, '(/?>)$', ' fill="' || f.new_fill || '"\\1') END AS piece
  FROM dtok t JOIN dwf w ON w.rec_id = t.rec_id AND w.ok LEFT JOIN fills f ON f.rec_id = t.rec_id AND f.open_pos = t.pos WHERE t.kind <> 'comment')
SELECT rec_id, string_agg(piece, '' ORDER BY pos) AS svg_out FROM pieces GROUP BY rec_id""")
def q_augment_svg(spark, sf):
    return TR.augmented_svg(_hashed_tokens(spark, sf), ok_tokens(spark, sf), 5)
