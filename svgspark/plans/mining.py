"""Registered mining queries (sources, gates, extraction, dedup, per-URL results) and their oracles."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from svgspark.functions.text import content_hash, shard_of, strip_backslash
from svgspark.functions.url import duck_resolve_url, resolve_url
from svgspark.operators import mine as M
from svgspark.operators import select as S
from svgspark.session import once, scratch_dir
from svgspark.plans.registry import lit, register
from svgspark.sources import scans
from svgspark.sources.tables import duck_with, view

SEED = 2998  # shuffle seed of the encoder stage configs
TASKS = ["clean", "quality", "toxic"]

# ---------------------------------------------------------------- DuckDB building blocks
D_BEST = """best AS (SELECT * EXCLUDE (rn, n_try), CASE WHEN success THEN attempt ELSE least(n_try, 3) END AS n_attempts
  FROM (SELECT *, status < 400 AS success,
               row_number() OVER (PARTITION BY url ORDER BY CASE WHEN status < 400 THEN 0 ELSE 1 END, attempt) AS rn,
               count(*) OVER (PARTITION BY url) AS n_try
        FROM fetch_log WHERE attempt <= 3) t WHERE rn = 1)"""
D_PAGES_OK = """pages_ok AS (SELECT page_id, url, body AS html FROM best
  WHERE success AND contains(lower(content_type), 'html') AND body IS NOT NULL AND body <> '')"""


def d_cands(pages: str = "pages_ok") -> str:
    """DuckDB CTEs: per-page candidates ``cand_all`` (origin, ord, svg, ref, abs_url)."""
    inl, fb, use = lit(M.SVG_INLINE_RE), lit(M.SVG_FALLBACK_RE), lit(S.SVG_USE_RE)
    src = (f"list_filter(list_transform(regexp_extract_all(html, {lit(M.SRC_TAG_RE)}, 0), "
           f"lambda t: regexp_extract(t, {lit(M.SRC_ATTR_RE)}, 1)), lambda r: r <> '')")
    dat = (f"list_filter(list_transform(regexp_extract_all(html, {lit(M.OBJECT_TAG_RE)}, 0), "
           f"lambda t: regexp_extract(t, {lit(M.DATA_ATTR_RE)}, 1)), lambda r: r <> '')")
    return f"""m AS (SELECT page_id, url, html, regexp_extract_all(html, {inl}, 0) AS ms,
                 {src} AS srcs, {dat} AS datas FROM {pages}),
inl AS (SELECT page_id, url, 0 AS origin, CAST(unnest(generate_series(0, len(ms) - 1)) AS INTEGER) AS ord,
               unnest(ms) AS svg, CAST(NULL AS VARCHAR) AS ref FROM m WHERE len(ms) > 0),
fb AS (SELECT page_id, url, 1 AS origin, 0 AS ord, regexp_extract(html, {fb}, 0) AS svg, CAST(NULL AS VARCHAR) AS ref
       FROM m WHERE len(ms) = 0 AND regexp_extract(html, {fb}, 0) <> ''),
srcr AS (SELECT page_id, url, 2 AS origin, CAST(unnest(generate_series(0, len(srcs) - 1)) AS INTEGER) AS ord,
                CAST(NULL AS VARCHAR) AS svg, unnest(srcs) AS ref FROM m WHERE len(srcs) > 0),
datr AS (SELECT page_id, url, 3 AS origin, CAST(unnest(generate_series(0, len(datas) - 1)) AS INTEGER) AS ord,
                CAST(NULL AS VARCHAR) AS svg, unnest(datas) AS ref FROM m WHERE len(datas) > 0),
cand_all AS (SELECT *, CASE WHEN ref IS NOT NULL THEN {duck_resolve_url('url', 'ref')} END AS abs_url FROM (
   SELECT * FROM inl UNION ALL SELECT * FROM fb
   UNION ALL SELECT * FROM srcr WHERE ends_with(lower(ref), '.svg')
   UNION ALL SELECT * FROM datr WHERE ends_with(lower(ref), '.svg')) u),
assets_ok AS (SELECT abs_url AS k, body AS asset FROM assets WHERE status < 400
   AND (contains(lower(content_type), 'svg') OR ends_with(lower(abs_url), '.svg')) AND body IS NOT NULL AND body <> ''),
cands AS (SELECT page_id, url, origin, ord, ref, abs_url, ref IS NOT NULL AS external, svg2 AS svg,
     CAST(length(svg2) AS BIGINT) AS n_chars, CASE WHEN length(svg2) <= {S.MAX_SVG_CHARS} THEN md5(svg2) END AS hash
   FROM (SELECT c.*, replace(coalesce(c.svg, a.asset), '\\', '') AS svg2, a.asset FROM cand_all c LEFT JOIN assets_ok a ON a.k = c.abs_url) j
   WHERE (ref IS NULL AND NOT regexp_matches(svg, {use})) OR (ref IS NOT NULL AND asset IS NOT NULL)),
mined AS (SELECT hash, page_id, origin, ord, url, svg, n_chars, substr(hash, 1, 2) AS shard FROM (
   SELECT *, row_number() OVER (PARTITION BY hash ORDER BY page_id, origin, ord) AS rn FROM cands WHERE hash IS NOT NULL) t
   WHERE rn = 1)"""


def d_mined() -> str:
    w = duck_with("fetch_log", "assets")
    return w + ",\n" + D_BEST + ",\n" + D_PAGES_OK + ",\n" + d_cands() + "\n"


def d_with(*views: str, extra: str = "") -> str:
    w = duck_with(*views)
    if extra:
        return (w + ",\n" + extra + "\n") if w else ("WITH " + extra + "\n")
    return w


def _v(spark, sf, name):
    return view(spark, sf, name)


def mined_df(spark, sf):
    return M.mine_svgs(_v(spark, sf, "fetch_log"), _v(spark, sf, "assets"))


def mined_hashes_df(spark, sf):
    return M.mined_hashes(_v(spark, sf, "fetch_log"), _v(spark, sf, "assets"))


# ---------------------------------------------------------------- 2.1 sources
@register("url_scan", "SELECT url FROM pages WHERE url IS NOT NULL")
def q_url_scan(spark, sf):
    return scans.url_scan(_v(spark, sf, "pages"), "url")


@register("split_select", """SELECT doc_id, lang FROM documents WHERE lang = (
  SELECT coalesce(max(CASE WHEN lang = 'train' THEN lang END), min(lang)) FROM documents)""")
def q_split_select(spark, sf):
    root = scratch_dir(spark, "splits")
    _v(spark, sf, "documents").select("doc_id", "lang").write.partitionBy("lang").parquet(root)
    return scans.split_scan(spark, root, "lang").select("doc_id", "lang")


SHARD_GLOBS = ["00/*", "01/*", "02/*", "04/*"]


#: For files of one record each. Tasks move their files into place themselves, where the driver would move one after the other;
#: the local file system writes no checksum files and starts no process to set each file's mode. Other stores take no notice.
SMALL_FILES = {"mapreduce.fileoutputcommitter.algorithm.version": "2", "fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem",
               "fs.file.impl.disable.cache": "true"}


def _svg_files(spark, sf):
    """``svg_raw`` as files, one for each record, in folders of 16: written once for the queries that scan them."""
    def write(folder):
        s = _v(spark, sf, "svg_raw").select(F.concat(F.lit("g"), (F.col("rec_id") % 16).cast("string")).alias("grp"), "svg")
        s.write.options(maxRecordsPerFile=1, **SMALL_FILES).partitionBy("grp").text(folder)

    return once(spark, "svg_files", [f"{sf.rstrip('/')}/part.parquet"], write)


@register("svg_dir_scan", duck_with("svg_raw") + """SELECT 'grp=g' || CAST(rec_id % 16 AS VARCHAR) AS grp, md5(svg || chr(10)) AS hash,
  CAST(strlen(svg) + 1 AS BIGINT) AS n_bytes FROM svg_raw""")
def q_svg_dir_scan(spark, sf):
    files = scans.svg_dir_scan(spark, _svg_files(spark, sf), "*.txt")
    return files.select("grp", content_hash("svg").alias("hash"), "n_bytes")


@register("hash_files", duck_with("svg_raw") + """SELECT 'grp=g' || CAST(rec_id % 16 AS VARCHAR) AS grp, sha256(svg || chr(10)) AS hash FROM svg_raw""")
def q_hash_files(spark, sf):
    files = scans.hash_files(spark, _svg_files(spark, sf), "*.txt", "sha256")
    return files.select(F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("grp"), "hash")


@register("glob_scan", duck_with("svg_raw") + """SELECT rec_id, md5(svg) AS hash,
  concat(substr(md5(svg), 1, 2), '/', md5(svg), '.svg') AS path FROM svg_raw
WHERE substr(md5(svg), 1, 2) IN ('00', '01', '02', '04')""")
def q_glob_scan(spark, sf):
    s = _v(spark, sf, "svg_raw").select("rec_id", content_hash("svg").alias("hash"))
    s = s.withColumn("path", F.concat(shard_of("hash"), F.lit("/"), F.col("hash"), F.lit(".svg")))
    root = scratch_dir(spark, "shards")
    # the letter keeps the reader from taking shards for numbers
    s.withColumn("shard", shard_of("hash")).repartition("shard").write.partitionBy("shard").parquet(root)
    return scans.shard_scan(spark, root, SHARD_GLOBS).select("rec_id", "hash", "path")


@register("fetch_log_scan", duck_with("fetch_log") + "SELECT page_id, url, attempt, status, content_type, body FROM fetch_log")
def q_fetch_log_scan(spark, sf):
    return scans.fetch_log_scan(_v(spark, sf, "fetch_log"))


# ---------------------------------------------------------------- 2.2 selection
@register("valid_url", "SELECT page_id, url FROM pages WHERE url IS NOT NULL AND url <> ''")
def q_valid_url(spark, sf):
    return S.valid_url(_v(spark, sf, "pages").select("page_id", "url"))


@register("distinct_url", duck_with("fetch_log") + "SELECT DISTINCT url FROM fetch_log WHERE url IS NOT NULL AND url <> ''")
def q_distinct_url(spark, sf):
    return S.distinct_url(_v(spark, sf, "fetch_log"))


@register("url_stats", duck_with("fetch_log") + """SELECT count(*) AS n_rows, count(*) FILTER (WHERE url <> '') AS n_valid,
  count(DISTINCT url) FILTER (WHERE url <> '') AS n_distinct,
  count(*) - count(DISTINCT url) FILTER (WHERE url <> '') AS n_invalid FROM fetch_log""")
def q_url_stats(spark, sf):
    return S.url_stats(_v(spark, sf, "fetch_log"))


D_SHUF = f"md5(concat_ws('|', '{SEED}', CAST(doc_id AS VARCHAR)))"


@register("seeded_shuffle", f"""SELECT doc_id, CAST(row_number() OVER (ORDER BY {D_SHUF}, doc_id) AS BIGINT) AS rn FROM documents""")
def q_seeded_shuffle(spark, sf):
    d = S.seeded_shuffle(_v(spark, sf, "documents").select("doc_id"), SEED, "doc_id")
    return S.global_rank(d, "shuffle_key", "doc_id", "rn").select("doc_id", "rn")


@register("offset_rows", f"""SELECT doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY {D_SHUF}, doc_id) AS rn FROM documents) t
WHERE rn > 100""")
def q_offset_rows(spark, sf):
    d = S.seeded_shuffle(_v(spark, sf, "documents").select("doc_id"), SEED, "doc_id")
    return S.offset_rows(d, "shuffle_key", "doc_id", 100).select("doc_id")


@register("limit_rows", f"""SELECT url, md5(concat_ws('|', '{SEED}', url)) AS shuffle_key FROM (SELECT DISTINCT url FROM pages WHERE url <> '') t
ORDER BY 2, 1 LIMIT 100""")
def q_limit_rows(spark, sf):
    return S.limit_urls(_v(spark, sf, "pages"), 100, SEED)


@register("html_response", duck_with("fetch_log") + """SELECT page_id, url, attempt FROM fetch_log
WHERE status < 400 AND contains(lower(content_type), 'html') AND body IS NOT NULL AND body <> ''""")
def q_html_response(spark, sf):
    return S.html_response(_v(spark, sf, "fetch_log")).select("page_id", "url", "attempt")


@register("svg_response", duck_with("assets") + """SELECT abs_url, status FROM assets
WHERE status < 400 AND (contains(lower(content_type), 'svg') OR ends_with(lower(abs_url), '.svg'))""")
def q_svg_response(spark, sf):
    return S.svg_response(_v(spark, sf, "assets")).select("abs_url", "status")


@register("drop_use_only", duck_with("svg_raw") + f"SELECT rec_id FROM svg_raw WHERE NOT regexp_matches(svg, {lit(S.SVG_USE_RE)})")
def q_drop_use_only(spark, sf):
    return S.drop_use_only(_v(spark, sf, "svg_raw")).select("rec_id")


@register("max_length", duck_with("svg_raw") + "SELECT rec_id, CAST(length(svg) AS BIGINT) AS n_chars FROM svg_raw WHERE length(svg) <= 32768")
def q_max_length(spark, sf):
    return S.max_length(_v(spark, sf, "svg_raw")).select("rec_id", F.length("svg").cast("bigint").alias("n_chars"))


D_REASON = """CASE WHEN svg IS NULL OR svg = '' THEN 'empty' WHEN length(svg) < 20 THEN 'too short'
  WHEN length(svg) < 50 THEN 'too short to parse' WHEN NOT contains(svg, '<svg') THEN 'no svg tag' END"""


@register("min_length_gate", duck_with("svg_raw") + f"SELECT rec_id, {D_REASON} AS reject_reason FROM svg_raw")
def q_min_length_gate(spark, sf):
    return S.min_length_gate(_v(spark, sf, "svg_raw")).select("rec_id", "reject_reason")


@register("blank_image", duck_with("pixels") + """SELECT vec_id, round(stddev_pop(gray), 6) AS gray_std,
  stddev_pop(gray) < 5 AS is_blank FROM pixels GROUP BY vec_id""")
def q_blank_image(spark, sf):
    return S.blank_image(_v(spark, sf, "pixels")).withColumn("gray_std", F.round("gray_std", 6))


D_MINE_ERR = f"""CASE WHEN regexp_matches(svg, {lit(S.SVG_USE_RE)}) THEN 'use only' WHEN length(svg) > 32768 THEN 'too long'
  ELSE {D_REASON} END"""


def mine_error(svg="svg"):
    return (F.when(S.is_use_only(svg), F.lit("use only"))
            .when(F.length(svg) > S.MAX_SVG_CHARS, F.lit("too long"))
            .otherwise(S.reject_reason(svg)))


@register("top_errors", duck_with("svg_raw") + f"""SELECT error, n, rank FROM (
  SELECT error, n, CAST(row_number() OVER (ORDER BY n DESC, error) AS BIGINT) AS rank FROM (
    SELECT {D_MINE_ERR} AS error, count(*) AS n FROM svg_raw GROUP BY 1) c WHERE error IS NOT NULL) r WHERE rank <= 3
UNION ALL SELECT format('... and {{}} more', sum(n)), CAST(sum(n) AS BIGINT), 4 FROM (
  SELECT error, n, row_number() OVER (ORDER BY n DESC, error) AS rank FROM (
    SELECT {D_MINE_ERR} AS error, count(*) AS n FROM svg_raw GROUP BY 1) c WHERE error IS NOT NULL) r WHERE rank > 3
  HAVING sum(n) IS NOT NULL""")
def q_top_errors(spark, sf):
    return S.top_errors(_v(spark, sf, "svg_raw").select(mine_error().alias("error")), "error", 3)


@register("dir_group_order", duck_with("stage_out") + """SELECT grp, n_files, CAST(row_number() OVER (ORDER BY grp) AS BIGINT) AS grp_order FROM (
  SELECT regexp_extract(filename, '^([^/]+)/', 1) AS grp, count(*) AS n_files FROM stage_out GROUP BY 1) t""")
def q_dir_group_order(spark, sf):
    return S.dir_group_order(_v(spark, sf, "stage_out"))


# ---------------------------------------------------------------- 2.3 extraction
@register("extract_inline", duck_with("svg_pages") + f"""SELECT page_id, CAST(unnest(generate_series(0, len(ms) - 1)) AS INTEGER) AS ord,
  unnest(ms) AS svg FROM (SELECT page_id, regexp_extract_all(html, {lit(M.SVG_INLINE_RE)}, 0) AS ms FROM svg_pages) t WHERE len(ms) > 0""")
def q_extract_inline(spark, sf):
    return M.extract_inline(_v(spark, sf, "svg_pages"), keys=("page_id",))


def _truncated_pages(spark, sf):
    p = _v(spark, sf, "svg_pages")
    return p.withColumn("html", F.when(F.col("page_id") % 7 == 0, F.replace("html", F.lit("</svg>"), F.lit("")))
                        .otherwise(F.col("html")))


@register("extract_inline_fallback", duck_with("svg_pages") + f"""
, tp AS (SELECT page_id, CASE WHEN page_id % 7 = 0 THEN replace(html, '</svg>', '') ELSE html END AS html FROM svg_pages),
m AS (SELECT page_id, html, regexp_extract_all(html, {lit(M.SVG_INLINE_RE)}, 0) AS ms FROM tp)
SELECT page_id, 0 AS origin, CAST(unnest(generate_series(0, len(ms) - 1)) AS INTEGER) AS ord, unnest(ms) AS svg FROM m WHERE len(ms) > 0
UNION ALL SELECT page_id, 1, 0, regexp_extract(html, {lit(M.SVG_FALLBACK_RE)}, 0) FROM m
  WHERE len(ms) = 0 AND regexp_extract(html, {lit(M.SVG_FALLBACK_RE)}, 0) <> ''""")
def q_extract_inline_fallback(spark, sf):
    return M.extract_inline_fallback(_truncated_pages(spark, sf), keys=("page_id",))


def _d_refs(tag_re, attr_re):
    return (f"SELECT page_id, url, CAST(unnest(generate_series(0, len(rs) - 1)) AS INTEGER) AS ord, unnest(rs) AS ref FROM ("
            f"SELECT page_id, url, list_filter(list_transform(regexp_extract_all(html, {lit(tag_re)}, 0), "
            f"lambda t: regexp_extract(t, {lit(attr_re)}, 1)), lambda r: r <> '') AS rs FROM svg_pages) t WHERE len(rs) > 0")


@register("extract_src_refs", duck_with("svg_pages") + f"""SELECT page_id, ord, ref FROM ({_d_refs(M.SRC_TAG_RE, M.SRC_ATTR_RE)}) r
WHERE ends_with(lower(ref), '.svg')""")
def q_extract_src_refs(spark, sf):
    return M.extract_src_refs(_v(spark, sf, "svg_pages")).select("page_id", "ord", "ref")


@register("extract_data_refs", duck_with("svg_pages") + f"""SELECT page_id, ord, ref FROM ({_d_refs(M.OBJECT_TAG_RE, M.DATA_ATTR_RE)}) r
WHERE ends_with(lower(ref), '.svg')""")
def q_extract_data_refs(spark, sf):
    return M.extract_data_refs(_v(spark, sf, "svg_pages")).select("page_id", "ord", "ref")


@register("resolve_url", duck_with("svg_pages") + f"""SELECT page_id, origin, ord, {duck_resolve_url('url', 'ref')} AS abs_url FROM (
  SELECT 2 AS origin, * FROM ({_d_refs(M.SRC_TAG_RE, M.SRC_ATTR_RE)}) a UNION ALL
  SELECT 3 AS origin, * FROM ({_d_refs(M.OBJECT_TAG_RE, M.DATA_ATTR_RE)}) b) r WHERE ends_with(lower(ref), '.svg')""")
def q_resolve_url(spark, sf):
    p = _v(spark, sf, "svg_pages")
    a = M.extract_src_refs(p).withColumn("origin", F.lit(2))
    b = M.extract_data_refs(p).withColumn("origin", F.lit(3))
    return a.unionByName(b).select("page_id", "origin", "ord", resolve_url("url", "ref").alias("abs_url"))


@register("strip_backslash", duck_with("svg_raw") + "SELECT rec_id, replace(svg, '\\', '') AS svg FROM svg_raw")
def q_strip_backslash(spark, sf):
    return _v(spark, sf, "svg_raw").select("rec_id", strip_backslash("svg").alias("svg"))


@register("union_candidates", duck_with("svg_pages") + ",\n" + d_cands("svg_pages") + """
SELECT page_id, origin, ord, svg, ref, abs_url FROM cand_all""")
def q_union_candidates(spark, sf):
    return M.page_candidates(_v(spark, sf, "svg_pages")).select("page_id", "origin", "ord", "svg", "ref", "abs_url")


@register("mine_svgs", d_mined() + "SELECT hash, shard, page_id, origin, ord, url, svg, n_chars FROM mined")
def q_mine_svgs(spark, sf):
    return mined_df(spark, sf).select("hash", "shard", "page_id", "origin", "ord", "url", "svg", "n_chars")


@register("rejected_svgs", d_mined() + f"""SELECT page_id, url, origin, ord, n_chars, 'longer than {S.MAX_SVG_CHARS} characters' AS reason
FROM cands WHERE hash IS NULL""")
def q_rejected_svgs(spark, sf):
    return M.rejected_svgs(_v(spark, sf, "fetch_log"), _v(spark, sf, "assets"))


@register("best_attempt", d_with("fetch_log", extra=D_BEST) + """SELECT url, page_id, attempt, status, success,
  CAST(n_attempts AS INTEGER) AS n_attempts FROM best""")
def q_best_attempt(spark, sf):
    return S.best_attempt(_v(spark, sf, "fetch_log")).select("url", "page_id", "attempt", "status", "success", "n_attempts")


# ---------------------------------------------------------------- 2.4 joins
@register("join_assets", duck_with("svg_pages", "assets") + ",\n" + d_cands("svg_pages") + """
SELECT c.page_id, c.origin, c.ord, c.abs_url, a.k IS NOT NULL AS fetched FROM cand_all c LEFT JOIN assets_ok a ON a.k = c.abs_url
WHERE c.ref IS NOT NULL""")
def q_join_assets(spark, sf):
    c = M.page_candidates(_v(spark, sf, "svg_pages")).where(F.col("ref").isNotNull())
    j = M.join_assets(c, M.fetched_assets(_v(spark, sf, "assets")).drop("_asset"))
    return j.select("page_id", "origin", "ord", "abs_url", F.col("_asset_chars").isNotNull().alias("fetched"))


@register("anti_known", d_mined() + """SELECT hash FROM mined WHERE hash NOT IN (SELECT md5(svg) FROM svg_raw)""")
def q_anti_known(spark, sf):
    known = _v(spark, sf, "svg_raw").select(content_hash("svg").alias("hash"))
    return mined_hashes_df(spark, sf).select("hash").join(known.hint("merge"), "hash", "left_anti")


@register("anti_rendered", duck_with("caption_raw") + """SELECT DISTINCT md5(svg) AS hash FROM svg_raw
WHERE md5(svg) NOT IN (SELECT hash FROM caption_raw)""")
def q_anti_rendered(spark, sf):
    items = _v(spark, sf, "svg_raw").select(content_hash("svg").alias("hash")).distinct()
    done = _v(spark, sf, "caption_raw").select("hash")
    return items.join(done, "hash", "left_anti")


# ---------------------------------------------------------------- 2.5 aggregates
@register("url_result", d_mined() + """, matched AS (SELECT page_id, CAST(len(ms) AS BIGINT) AS svg_matched FROM m),
saved AS (SELECT page_id, count(*) AS svg_saved, count(*) FILTER (WHERE origin <= 1) AS inline_saved FROM mined GROUP BY 1),
ext AS (SELECT page_id, count(*) AS ext_found FROM cands WHERE external GROUP BY 1),
spent AS (SELECT f.url, sum(f.ms) AS page_ms FROM fetch_log f JOIN best b ON b.url = f.url AND f.attempt <= b.n_attempts GROUP BY 1),
refs AS (SELECT c.page_id, sum(a.ms) AS ref_ms FROM cand_all c JOIN assets a ON a.abs_url = c.abs_url WHERE c.ref IS NOT NULL GROUP BY 1)
SELECT b.url, (b.success AND contains(lower(b.content_type), 'html') AND b.body IS NOT NULL AND b.body <> '') AS success,
  CAST(coalesce(svg_matched, 0) AS BIGINT) AS svg_matched,
  CAST(coalesce(inline_saved, 0) + coalesce(ext_found, 0) AS BIGINT) AS svg_found,
  CAST(coalesce(svg_saved, 0) AS BIGINT) AS svg_saved, CAST(coalesce(page_ms, 0) + coalesce(ref_ms, 0) AS DOUBLE) / 1000 AS time_taken
FROM best b LEFT JOIN matched USING (page_id) LEFT JOIN saved USING (page_id) LEFT JOIN ext USING (page_id)
LEFT JOIN spent ON spent.url = b.url LEFT JOIN refs USING (page_id)""")
def q_url_result(spark, sf):
    return M.url_result(_v(spark, sf, "fetch_log"), _v(spark, sf, "assets"))


@register("crawl_counters", d_mined() + """SELECT
  CAST((SELECT count(*) FROM best WHERE success AND contains(lower(content_type), 'html')) AS BIGINT) AS pages_fetched,
  CAST((SELECT count(*) FROM best WHERE NOT success) + (SELECT count(*) FROM cand_all c LEFT JOIN assets a ON a.abs_url = c.abs_url
        WHERE c.ref IS NOT NULL AND coalesce(a.status, 404) >= 400) AS BIGINT) AS failed_fetches,
  CAST((SELECT sum(n_attempts - 1) FROM best) + 2 * (SELECT count(*) FROM cand_all c LEFT JOIN assets a ON a.abs_url = c.abs_url
        WHERE c.ref IS NOT NULL AND coalesce(a.status, 404) >= 400) AS BIGINT) AS retried_requests,
  CAST((SELECT count(*) FROM mined) AS BIGINT) AS svg_saved""")
def q_crawl_counters(spark, sf):
    return M.crawl_counters(_v(spark, sf, "fetch_log"), _v(spark, sf, "assets"))


@register("shard_counts", d_mined() + "SELECT shard, count(*) AS n_svg FROM mined GROUP BY shard")
def q_shard_counts(spark, sf):
    return M.shard_counts(mined_hashes_df(spark, sf))


@register("exact_distinct", duck_with("svg_raw") + "SELECT count(DISTINCT md5(svg)) AS n_distinct, count(*) AS n_rows FROM svg_raw")
def q_exact_distinct(spark, sf):
    return M.exact_distinct(_v(spark, sf, "svg_raw").select(content_hash("svg").alias("hash")))


@register("first_seen", duck_with("svg_raw") + """SELECT hash, rec_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM (
  SELECT md5(svg) AS hash, rec_id, ts, row_number() OVER (PARTITION BY md5(svg) ORDER BY ts, rec_id) AS rn FROM svg_raw) t WHERE rn = 1""")
def q_first_seen(spark, sf):
    s = _v(spark, sf, "svg_raw").select(content_hash("svg").alias("hash"), "rec_id", "ts")
    return (M.first_seen(s, "hash", ("ts", "rec_id"))
            .select("hash", "rec_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts")))


@register("new_per_minute", duck_with("svg_raw") + """SELECT strftime(minute, '%Y-%m-%d %H:%M:%S') AS minute, n_new,
  CAST(sum(n_new) OVER (ORDER BY minute ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS n_total FROM (
  SELECT time_bucket(INTERVAL 1 minute, ts) AS minute, count(*) AS n_new FROM (
    SELECT min(ts) AS ts FROM svg_raw GROUP BY md5(svg)) f GROUP BY 1) t""")
def q_new_per_minute(spark, sf):
    s = _v(spark, sf, "svg_raw").select(content_hash("svg").alias("hash"), "rec_id", "ts")
    first = M.first_seen(s, "hash", ("ts", "rec_id"))
    out = M.new_per_minute(first, "ts")
    return out.select(F.date_format("minute", "yyyy-MM-dd HH:mm:ss").alias("minute"), "n_new", "n_total")


D_GROWTH = """WITH per AS (SELECT date_trunc('hour', ts) AS t, count(*) AS n_processed FROM events GROUP BY 1),
firsts AS (SELECT date_trunc('hour', min(ts)) AS t FROM events GROUP BY md5(CAST(user_id AS VARCHAR))),
uniq AS (SELECT t, count(*) AS n_new FROM firsts GROUP BY 1),
g AS (SELECT coalesce(per.t, uniq.t) AS t, coalesce(n_processed, 0) AS n_processed, coalesce(n_new, 0) AS n_new
      FROM per FULL JOIN uniq ON per.t = uniq.t),
c AS (SELECT t, n_processed, n_new,
   sum(n_processed) OVER (ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_processed,
   sum(n_new) OVER (ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_unique FROM g)
"""


@register("dedup_growth", D_GROWTH + """SELECT strftime(t, '%Y-%m-%d %H:%M:%S') AS t, CAST(n_processed AS BIGINT) AS n_processed, CAST(n_new AS BIGINT) AS n_new,
  CAST(cum_processed AS BIGINT) AS cum_processed, CAST(cum_unique AS BIGINT) AS cum_unique,
  round((SELECT regr_slope(ln(cum_unique), ln(cum_processed)) FROM c), 6) AS exponent FROM c""")
def q_dedup_growth(spark, sf):
    ev = _v(spark, sf, "events").select(content_hash(F.col("user_id").cast("string")).alias("hash"), "ts")
    g = M.dedup_growth(ev, "hash", "ts", "hour")
    # the fit runs as a window over the per-hour aggregate (one row per hour), not over events
    whole = Window.partitionBy()
    g = g.withColumn("exponent", F.round(F.regr_slope(F.ln("cum_unique"), F.ln("cum_processed")).over(whole), 6))
    return (g.select(F.date_format("t", "yyyy-MM-dd HH:mm:ss").alias("t"),
                    *[F.col(c).cast("bigint").alias(c) for c in ("n_processed", "n_new", "cum_processed", "cum_unique")],
                    "exponent"))


@register("dedup_month", D_GROWTH + """, f AS (SELECT regr_slope(ln(cum_unique), ln(cum_processed)) AS exponent, regr_intercept(ln(cum_unique), ln(cum_processed)) AS coef,
  max(cum_processed) / ((epoch(max(t)) - epoch(min(t))) / 3600 + 1) * 720 AS x FROM c)
SELECT round(exponent, 6) AS exponent, round(x, 3) AS month_processed, round(exp(coef + exponent * ln(x)), 3) AS month_unique FROM f""")
def q_dedup_month(spark, sf):
    ev = _v(spark, sf, "events").select(content_hash(F.col("user_id").cast("string")).alias("hash"), "ts")
    m = M.month_estimate(M.dedup_growth(ev, "hash", "ts", "hour"))
    return m.select(F.round("exponent", 6).alias("exponent"), *[F.round(c, 3).alias(c) for c in ("month_processed", "month_unique")])


@register("batch_report", duck_with("svg_raw") + f"""SELECT batch, count(*) AS processed, count(*) FILTER (WHERE kept) AS kept,
  CAST(sum(count(*)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS total_processed,
  CAST(sum(count(*) FILTER (WHERE kept)) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS total_kept
FROM (SELECT CAST(floor((row_number() OVER (ORDER BY md5(concat_ws('|', '{SEED}', CAST(rec_id AS VARCHAR))), rec_id) - 1) / 64) AS BIGINT) AS batch,
        ({D_MINE_ERR}) IS NULL AS kept FROM svg_raw) t GROUP BY batch""")
def q_batch_report(spark, sf):
    s = _v(spark, sf, "svg_raw")
    s = S.seeded_shuffle(s, SEED, "rec_id").withColumn("kept", mine_error().isNull())
    return M.batch_report(s, "shuffle_key", "rec_id", "kept", 64)


@register("accuracy_by_task", duck_with("predictions") + """SELECT model, task, count(*) AS n,
  round(avg(CASE WHEN pred = label THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM predictions GROUP BY model, task""")
def q_accuracy_by_task(spark, sf):
    p = _v(spark, sf, "predictions")
    return (p.groupBy("model", "task")
            .agg(F.count(F.lit(1)).alias("n"), F.round(F.avg((F.col("pred") == F.col("label")).cast("double")), 6).alias("accuracy")))


@register("accuracy_pivot", duck_with("predictions") + "SELECT model, " + ", ".join(
    f"round(avg(CASE WHEN pred = label THEN 1.0 ELSE 0.0 END) FILTER (WHERE task = '{t}'), 6) AS {t}" for t in TASKS) + " FROM predictions GROUP BY model")
def q_accuracy_pivot(spark, sf):
    return M.accuracy_pivot(_v(spark, sf, "predictions"), TASKS)
