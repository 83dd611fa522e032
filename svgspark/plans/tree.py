"""Registered tree queries (tokens, elements, structure checks, canvas, styles, ids) and oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from svgspark.functions.text import content_hash
from svgspark.operators import tree as T
from svgspark.plans.registry import lit, register
from svgspark.sources.tables import duck_with, tasks, view


def docs(spark, sf, name="svg_raw"):
    return T.by_record(view(spark, sf, name).select("rec_id", "svg"), partitions=tasks(spark, sf, "part"))


def lists(spark, sf, name="svg_raw"):
    return T.token_lists(docs(spark, sf, name), partitions=tasks(spark, sf, "part"))


def tokens(spark, sf, name="svg_raw"):
    return T.exploded(lists(spark, sf, name))


def elements(spark, sf, name="svg_raw"):
    return T.lower_attrs(T.svg_elements(tokens(spark, sf, name)))


def ok_lists(spark, sf, name="svg_raw"):
    """Token lists of the well-formed records only."""
    every = lists(spark, sf, name)
    return every.join(T.wellformed(T.exploded(every)).where("ok").select("rec_id").hint("merge"), "rec_id", "left_semi")


def ok_tokens(spark, sf, name="svg_raw"):
    return T.exploded(ok_lists(spark, sf, name))


def ok_elements(spark, sf, name="svg_raw"):
    """Elements of the well-formed records only."""
    return T.lower_attrs(T.svg_elements(ok_tokens(spark, sf, name)))


def d_tokens(src: str = "svg_raw") -> str:
    """DuckDB CTEs ``dtok`` (tokens with kind/name/depth) and ``del`` (elements) over view ``src``."""
    return f"""dtok0 AS (SELECT rec_id, CAST(unnest(generate_series(0, len(ts) - 1)) AS INTEGER) AS pos, unnest(ts) AS tok
  FROM (SELECT rec_id, regexp_extract_all(svg, {lit(T.TOKEN_RE)}, 0) AS ts FROM {src}) t WHERE len(ts) > 0),
dtok1 AS (SELECT *, CASE WHEN starts_with(tok, '<!--') THEN 'comment' WHEN starts_with(tok, '<![CDATA[') THEN 'cdata'
    WHEN starts_with(tok, '<?') THEN 'pi' WHEN starts_with(tok, '<!') THEN 'doctype' WHEN starts_with(tok, '</') THEN 'close'
    WHEN starts_with(tok, '<') AND ends_with(tok, '/>') THEN 'empty' WHEN starts_with(tok, '<') THEN 'open' ELSE 'text' END AS kind
  FROM dtok0),
dtok AS (SELECT rec_id, pos, tok, kind, CASE WHEN kind IN ('open', 'close', 'empty') THEN regexp_extract(tok, {lit(T.NAME_RE)}, 1) END AS name,
    CAST(sum(CASE kind WHEN 'open' THEN 1 WHEN 'close' THEN -1 ELSE 0 END) OVER (PARTITION BY rec_id ORDER BY pos
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - CASE WHEN kind = 'open' THEN 1 ELSE 0 END AS INTEGER) AS depth FROM dtok1),
dtags AS (SELECT *, lead(pos) OVER w AS next_pos, lead(kind) OVER w AS next_kind, lead(name) OVER w AS next_name
  FROM dtok WHERE kind IN ('open', 'close', 'empty') WINDOW w AS (PARTITION BY rec_id, depth ORDER BY pos)),
del AS (SELECT rec_id, pos AS open_pos, CASE WHEN kind = 'empty' THEN pos WHEN next_kind = 'close' THEN next_pos END AS close_pos,
    depth, regexp_replace(name, '^.*[:}}]', '') AS tag, tok,
    array_to_string(regexp_extract_all(tok, {lit(T.ATTR_RE)}, 1), ' ') AS attr_names
  FROM dtags WHERE kind IN ('open', 'empty')),
dns0 AS (SELECT rec_id, pos, n FROM (SELECT rec_id, pos, unnest(list_append(regexp_extract_all(tok, {lit(T.ATTR_RE)}, 1), name)) AS n FROM dtok
    WHERE kind IN ('open', 'empty') AND contains(tok, ':')) t WHERE contains(n, ':') AND NOT starts_with(n, 'xml')),
dns AS (SELECT DISTINCT rec_id FROM dns0 u WHERE NOT EXISTS (SELECT 1 FROM del d WHERE d.rec_id = u.rec_id AND contains(d.tok, 'xmlns:')
    AND d.open_pos <= u.pos AND u.pos <= d.close_pos AND contains(d.tok, ' xmlns:' || split_part(u.n, ':', 1) || '='))),
dwf AS (SELECT r.rec_id, coalesce(reason, CASE WHEN dns.rec_id IS NOT NULL THEN 'unbound prefix' END) IS NULL AS ok,
    coalesce(reason, CASE WHEN dns.rec_id IS NOT NULL THEN 'unbound prefix' END) AS reason FROM (SELECT rec_id,
    CASE WHEN min(depth) < 0 THEN 'unexpected close tag'
      WHEN count(*) FILTER (WHERE kind = 'open' AND next_kind = 'close' AND next_name <> name) > 0 THEN 'mismatched tag'
      WHEN count(*) FILTER (WHERE kind = 'open' AND (next_kind IS NULL OR next_kind <> 'close')) > 0
        OR arg_max(CASE WHEN kind = 'open' THEN depth + 1 ELSE depth END, pos) <> 0 THEN 'unclosed tag'
      WHEN count(*) FILTER (WHERE kind IN ('open', 'empty') AND depth = 0) = 0 THEN 'no element'
      WHEN count(*) FILTER (WHERE kind IN ('open', 'empty') AND depth = 0) > 1 THEN 'junk after document element' END AS reason
  FROM dtags GROUP BY rec_id) r LEFT JOIN dns ON dns.rec_id = r.rec_id),
okel AS (SELECT e.* FROM del e JOIN dwf w ON w.rec_id = e.rec_id AND w.ok)"""


def d_attr(name: str, tok: str = "tok") -> str:
    """DuckDB: a double-quoted attribute value by case-insensitive name (NULL when absent)."""
    rx = lit(r"(?i)\s" + name + r"""\s*=\s*"([^"]*)\"""")
    return f"CASE WHEN regexp_matches({tok}, {rx}) THEN regexp_extract({tok}, {rx}, 1) END"


def d_num(x: str) -> str:
    return f"TRY_CAST(regexp_replace({x}, '[A-Za-z]', '', 'g') AS DOUBLE)"


@register("svg_tokens", duck_with("svg_raw") + ",\n" + d_tokens() + "\nSELECT rec_id, pos, tok, kind, name, depth FROM dtok")
def q_svg_tokens(spark, sf):
    return tokens(spark, sf).select("rec_id", "pos", "tok", "kind", "name", "depth")


@register("svg_elements", duck_with("svg_raw") + ",\n" + d_tokens() + """
SELECT rec_id, open_pos, close_pos, depth, tag, attr_names FROM del""")
def q_svg_elements(spark, sf):
    el = T.svg_elements(tokens(spark, sf))
    return el.select("rec_id", "open_pos", "close_pos", "depth", "tag", F.array_join(F.map_keys("attrs"), " ").alias("attr_names"))


@register("wellformed", duck_with("svg_raw") + ",\n" + d_tokens() + "\nSELECT rec_id, ok, reason FROM dwf")
def q_wellformed(spark, sf):
    return T.wellformed(tokens(spark, sf))


@register("lower_attrs", duck_with("svg_raw") + ",\n" + d_tokens() + "\nSELECT rec_id, open_pos, lower(attr_names) AS attr_names FROM del")
def q_lower_attrs(spark, sf):
    return elements(spark, sf).select("rec_id", "open_pos", F.array_join(F.map_keys("lattrs"), " ").alias("attr_names"))


def _roots(spark, sf):
    return ok_elements(spark, sf).where((F.col("depth") == 0) & (F.col("tag") == "svg"))


def d_canvas() -> str:
    vb = d_attr("viewbox")
    parts = f"string_split(regexp_replace(trim({vb}, ' ,'), '[\\s,]+', ' ', 'g'), ' ')"
    w, h = d_num(d_attr("width")), d_num(d_attr("height"))
    return f"""canvas AS (SELECT rec_id,
  CASE WHEN {vb} IS NOT NULL THEN {d_num(parts + '[1]')} ELSE 0.0 END AS vb_x,
  CASE WHEN {vb} IS NOT NULL THEN {d_num(parts + '[2]')} ELSE 0.0 END AS vb_y,
  CASE WHEN {vb} IS NOT NULL THEN {d_num(parts + '[3]')} ELSE coalesce({w}, 0.0) END AS vb_w,
  CASE WHEN {vb} IS NOT NULL THEN {d_num(parts + '[4]')} ELSE coalesce({h}, 0.0) END AS vb_h,
  CASE WHEN {vb} IS NOT NULL THEN {d_num(parts + '[3]')} ELSE coalesce({w}, 1.0) END AS canvas_w,
  CASE WHEN {vb} IS NOT NULL THEN {d_num(parts + '[4]')} ELSE coalesce({h}, 1.0) END AS canvas_h,
  CASE WHEN {vb} IS NOT NULL THEN 'viewbox' WHEN {d_attr('width')} IS NOT NULL OR {d_attr('height')} IS NOT NULL THEN 'size'
    ELSE 'default' END AS canvas_from
  FROM okel WHERE depth = 0 AND tag = 'svg')"""


CANVAS_COLS = ["vb_x", "vb_y", "vb_w", "vb_h", "canvas_w", "canvas_h"]


@register("canvas_box", duck_with("svg_raw") + ",\n" + d_tokens() + ",\n" + d_canvas() + """
SELECT rec_id, vb_x, vb_y, vb_w, vb_h, canvas_w, canvas_h, canvas_from FROM canvas""")
def q_canvas_box(spark, sf):
    return T.canvas_box(_roots(spark, sf)).select("rec_id", *CANVAS_COLS, "canvas_from")


@register("canvas_scale", duck_with("svg_raw") + ",\n" + d_tokens() + ",\n" + d_canvas() + """
SELECT rec_id, round(s, 6) AS s, round(vb_x * s, 6) AS vb_x_s, round(vb_y * s, 6) AS vb_y_s, round(vb_w * s, 6) AS vb_w_s,
  round(vb_h * s, 6) AS vb_h_s FROM (SELECT *, CASE WHEN greatest(canvas_w, canvas_h) > 0 THEN 256.0 / greatest(canvas_w, canvas_h) END AS s
  FROM canvas) t""")
def q_canvas_scale(spark, sf):
    c = T.canvas_scale(T.canvas_box(_roots(spark, sf)), 256.0)
    return c.select("rec_id", *[F.round(x, 6).alias(x) for x in ("s", "vb_x_s", "vb_y_s", "vb_w_s", "vb_h_s")])


@register("ancestor_join", duck_with("svg_raw") + ",\n" + d_tokens() + """,
lev AS (SELECT rec_id, open_pos, depth AS k, open_pos AS anc, tag FROM okel
  UNION ALL SELECT rec_id, open_pos, unnest(generate_series(0, depth - 1)), NULL, NULL FROM okel WHERE depth > 0),
held AS (SELECT rec_id, open_pos, k, anc, last_value(anc IGNORE NULLS) OVER w AS anc_pos, last_value(tag IGNORE NULLS) OVER w AS anc_tag FROM lev
  WINDOW w AS (PARTITION BY rec_id, k ORDER BY open_pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT rec_id, open_pos, CAST(k AS INTEGER) AS anc_depth, anc_pos, anc_tag FROM held WHERE anc IS NULL""")
def q_ancestor_join(spark, sf):
    return T.ancestor_join(ok_elements(spark, sf), carry="tag")


@register("style_rules", duck_with("svg_styled") + """, css AS (SELECT rec_id,
  regexp_extract(svg, '<style>([^<]*)</style>', 1) AS css FROM svg_styled),
rules AS (SELECT rec_id, CAST(unnest(generate_series(0, len(rs) - 1)) AS INTEGER) AS ri, unnest(rs) AS rule
  FROM (SELECT rec_id, regexp_extract_all(css, '([^{}]+)\\{([^}]*)\\}', 0) AS rs FROM css) t WHERE len(rs) > 0),
sels AS (SELECT rec_id, ri, trim(unnest(string_split(regexp_extract(rule, '([^{}]+)\\{', 1), ','))) AS selector,
  regexp_extract(rule, '\\{([^}]*)\\}', 1) AS body FROM rules),
decl AS (SELECT rec_id, ri, substr(selector, 2) AS cls, unnest(string_split(body, ';')) AS d FROM sels
  WHERE regexp_matches(selector, '^\\.[A-Za-z_-][A-Za-z0-9_-]*$')),
kv AS (SELECT rec_id, ri, cls, trim(split_part(d, ':', 1)) AS prop, trim(split_part(d, ':', 2)) AS value FROM decl
  WHERE len(string_split(d, ':')) = 2)
SELECT rec_id, cls, prop, arg_max(value, ri) AS value FROM kv GROUP BY rec_id, cls, prop""")
def q_style_rules(spark, sf):
    r = T.style_rules(tokens(spark, sf, "svg_styled"))
    return r.select("rec_id", "cls", F.explode("props").alias("prop", "value"))


@register("class_rules", duck_with("svg_styled") + ",\n" + d_tokens("svg_styled") + """,
rules AS (SELECT * FROM (VALUES ('a', 'fill', '#123', 0), ('a', 'stroke', 'red', 0), ('b', 'fill', 'blue', 2),
  ('b', 'stroke', 'red', 0), ('b', 'stroke-width', '2', 2)) v(cls, prop, value, ri)),
ec AS (SELECT rec_id, open_pos, CAST(unnest(generate_series(0, len(cs) - 1)) AS INTEGER) AS ci, unnest(cs) AS cls
  FROM (SELECT rec_id, open_pos, string_split(""" + d_attr("class") + """, ' ') AS cs FROM del) t WHERE cs IS NOT NULL)
SELECT rec_id, open_pos, prop, arg_max(value, ci) AS value FROM ec JOIN rules USING (cls) GROUP BY rec_id, open_pos, prop""")
def q_class_rules(spark, sf):
    tk = tokens(spark, sf, "svg_styled")
    return T.class_rules(T.lower_attrs(T.svg_elements(tk)), T.style_rules(tk))


def d_live(src: str = "svg_defs") -> str:
    """DuckDB CTEs over ``svg_defs``: ``m`` (elements with their definition), ``refs`` and ``live`` (definitions reached)."""
    return duck_with(src).replace("WITH ", "WITH RECURSIVE ", 1) + ",\n" + d_tokens(src) + f""",
dfs AS (SELECT rec_id, open_pos, close_pos FROM okel WHERE tag = 'defs'),
u AS (SELECT e.rec_id, e.open_pos AS unit, e.close_pos FROM okel e JOIN dfs d ON d.rec_id = e.rec_id AND e.open_pos > d.open_pos AND e.close_pos < d.close_pos
  WHERE e.depth = 2 AND e.tag <> 'style'),
m AS (SELECT e.*, u.unit, nullif(regexp_extract(e.tok, ' id="([^"]*)"', 1), '') AS id FROM okel e LEFT JOIN u ON u.rec_id = e.rec_id AND e.open_pos BETWEEN u.unit AND u.close_pos),
refs AS (SELECT rec_id, unit, unnest(regexp_extract_all(tok, '(?:url\\(#|href="#)([^)"]+)', 1)) AS id FROM m UNION ALL SELECT rec_id, NULL, 's' FROM {src}),
edges AS (SELECT DISTINCT r.rec_id, coalesce(r.unit, -1) AS a, t.unit AS b FROM refs r JOIN m t ON t.rec_id = r.rec_id AND t.id = r.id WHERE t.unit IS NOT NULL),
live AS (SELECT rec_id, b AS unit FROM edges WHERE a = -1 UNION SELECT e.rec_id, e.b FROM live l JOIN edges e ON e.rec_id = l.rec_id AND e.a = l.unit)"""


@register("unreferenced_ids", d_live() + """
SELECT rec_id, open_pos, id FROM m WHERE id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM refs r WHERE r.rec_id = m.rec_id AND r.id = m.id
  AND (r.unit IS NULL OR EXISTS (SELECT 1 FROM live l WHERE l.rec_id = r.rec_id AND l.unit = r.unit)))""")
def q_unreferenced_ids(spark, sf):
    tk = tokens(spark, sf, "svg_defs")
    return T.unreferenced_ids(T.lower_attrs(T.svg_elements(tk)), css=T.style_texts(tk, "rec_id")).select("rec_id", "open_pos", "id")
