"""Registered geometry / stage-1 queries, lineage and outcome reports, with oracles where SQL is practical."""

from __future__ import annotations

from pyspark.sql import functions as F

from svgspark.functions.text import content_hash
from svgspark.operators import geom as G
from svgspark.operators import normalize as N
from svgspark.operators import corpus as C
from svgspark.operators import tree as T
from svgspark.plans.registry import register
from svgspark.plans.tree import d_tokens, ok_elements, ok_tokens, tokens
from svgspark.session import once
from svgspark.sources import sinks
from svgspark.sources.tables import duck_with, tasks, view

MAT = ["a", "b", "c", "d", "e", "f"]
GEOM = duck_with("svg_geom") + ",\n" + d_tokens("svg_geom")


def _arg(fn: str, k: int, default: int) -> str:
    """DuckDB: the k-th argument of a transform function in ``tok``."""
    rx = fn + r"\(([-0-9.]+)[ ,]?([-0-9.]*)\)"
    return f"coalesce(TRY_CAST(regexp_extract(tok, '{rx}', {k}) AS DOUBLE), {default}.0)"


#: Local matrices of ``svg_geom`` (translate, rotate, skewX and scale, in that order) and their products down the tree.
D_LOCAL = f""",
par AS (SELECT *, radians({_arg('rotate', 1, 0)}) AS th, tan(radians({_arg('skewX', 1, 0)})) AS sk, {_arg('scale', 1, 1)} AS sx, {_arg('scale', 2, 1)} AS sy,
  {_arg('translate', 1, 0)} AS tx, {_arg('translate', 2, 0)} AS ty FROM okel),
loc AS (SELECT rec_id, open_pos, close_pos, depth, tag, tok, cos(th) * sx AS a, sin(th) * sx AS b, (cos(th) * sk - sin(th)) * sy AS c,
  (sin(th) * sk + cos(th)) * sy AS d, tx AS e, ty AS f FROM par)"""
D_EFF = D_LOCAL + """,
up AS (SELECT l.*, p.open_pos AS parent FROM loc l LEFT JOIN loc p ON p.rec_id = l.rec_id AND p.depth = l.depth - 1 AND p.open_pos < l.open_pos AND p.close_pos >= l.close_pos),
eff AS (SELECT rec_id, open_pos, tag, tok, depth, a, b, c, d, e, f FROM up WHERE depth = 0
  UNION ALL SELECT u.rec_id, u.open_pos, u.tag, u.tok, u.depth, p.a * u.a + p.c * u.b, p.b * u.a + p.d * u.b, p.a * u.c + p.c * u.d, p.b * u.c + p.d * u.d,
    p.a * u.e + p.c * u.f + p.e, p.b * u.e + p.d * u.f + p.f FROM eff p JOIN up u ON u.rec_id = p.rec_id AND u.parent = p.open_pos AND u.depth = p.depth + 1)"""
GEOM_REC = GEOM.replace("WITH ", "WITH RECURSIVE ", 1)


def _with_local(el):
    return el.withColumn("m_local", N.local_matrix())


def _rounded(cols):
    return ", ".join(f"round({x}, 6) + 0.0 AS {x}" for x in cols)


@register("parse_transform", GEOM + D_LOCAL + f"""
SELECT rec_id, open_pos, {_rounded(MAT)} FROM loc WHERE regexp_matches(tok, '(?i)transform=')""")
def q_parse_transform(spark, sf):
    el = _with_local(ok_elements(spark, sf, "svg_geom"))
    el = el.where(F.col("lattrs")["transform"].isNotNull() | F.col("lattrs")["gradienttransform"].isNotNull())
    return el.select("rec_id", "open_pos", *[(F.round(F.col("m_local")[x], 6) + 0.0).alias(x) for x in MAT])


@register("effective_transform", GEOM_REC + D_EFF + f"""
SELECT rec_id, open_pos, {_rounded(MAT)} FROM eff""")
def q_effective_transform(spark, sf):
    el = N.effective_transform(_with_local(ok_elements(spark, sf, "svg_geom")))
    return el.select("rec_id", "open_pos", *[(F.round(F.col("m_eff")[x], 6) + 0.0).alias(x) for x in MAT])


def _paths(spark, sf):
    return ok_elements(spark, sf).where(F.col("tag") == "path").select("rec_id", "open_pos", F.col("lattrs")["d"].alias("d"))


@register("path_commands", duck_with("svg_raw") + ",\n" + d_tokens() + """
SELECT rec_id, open_pos, array_to_string(regexp_extract_all(regexp_extract(tok, ' d="([^"]*)"', 1), '[MmZzLlHhVvCcSsQqTtAa]', 0), '') AS cmds,
  CAST(len(regexp_extract_all(regexp_extract(tok, ' d="([^"]*)"', 1), '[-+]?(?:\\d+\\.?\\d*|\\.\\d+)', 0)) AS INTEGER) AS n_args
FROM okel WHERE tag = 'path'""")
def q_path_commands(spark, sf):
    p = _paths(spark, sf).withColumn("_t", G.path_tokens("d")).withColumn("_i", G.command_index("_t"))
    p = p.withColumn("cmds", G.path_commands("_t", "_i"))
    return p.select("rec_id", "open_pos", F.array_join(F.transform("cmds", lambda c: c["cmd"]), "").alias("cmds"),
                    F.aggregate("cmds", F.lit(0), lambda acc, c: acc + F.size(c["args"])).alias("n_args"))


def _geom_paths(spark, sf):
    """Paths of ``svg_geom`` with their effective matrix and the scale 2."""
    el = N.effective_transform(_with_local(ok_elements(spark, sf, "svg_geom"))).where(F.col("tag") == "path")
    return el.select("rec_id", "open_pos", F.col("lattrs")["d"].alias("d"), F.col("m_eff").alias("m"), F.lit(2.0).alias("s"))


def _plain_paths(spark, sf):
    return ok_elements(spark, sf, "svg_geom").where(F.col("tag") == "path").select("rec_id", "open_pos", F.col("lattrs")["d"].alias("d"))


POINTS = ["x1", "y1", "x2", "y2", "x", "y"]


def _points(segs, *more):
    """Segment rows with the control points and the end as columns; NULL where the kind has none."""
    pts, n = F.col("pts"), F.size("pts")
    at = {"x1": (n > 1, 0, "x"), "y1": (n > 1, 0, "y"), "x2": (n > 2, 1, "x"), "y2": (n > 2, 1, "y")}
    cols = [F.when(cond, F.get(pts, F.lit(i))[axis]) for cond, i, axis in at.values()]
    end = F.coalesce(F.try_element_at(pts, F.lit(-1)), F.col("p0"))
    named = zip(POINTS, [*cols, end["x"], end["y"]])
    return segs.select("rec_id", "open_pos", "seg", *more, "kind", *[(F.round(c, 6) + 0.0).alias(x) for x, c in named])


#: Segments of the four path forms of ``svg_geom`` from their numbers: a row (seg, kind, x1, y1, x2, y2, x, y) for each
#: command, and the arc's numbers. ``px, py`` is the start of the segment.
D_SEG = """,
num AS (SELECT rec_id, open_pos, list_transform(regexp_extract_all(d, '[-+]?[0-9.]+', 0), lambda t: CAST(t AS DOUBLE)) AS v, regexp_replace(d, '[^A-Za-z]', '', 'g') AS form
  FROM (SELECT rec_id, open_pos, regexp_extract(tok, ' d="([^"]*)"', 1) AS d FROM okel WHERE tag = 'path') t),
lines AS (SELECT rec_id, open_pos, unnest([
    {'seg': 0, 'kind': 'M', 'p': [v[1], v[2]]}, {'seg': 1, 'kind': 'L', 'p': [v[3], v[2]]}, {'seg': 2, 'kind': 'L', 'p': [v[3], v[4]]},
    {'seg': 3, 'kind': 'L', 'p': [v[3] + v[5], v[4]]}, {'seg': 4, 'kind': 'L', 'p': [v[3] + v[5], v[4] + v[6]]}, {'seg': 5, 'kind': 'L', 'p': [v[1], v[2]]}]) AS s
  FROM num WHERE form = 'MHVhvz'),
curves AS (SELECT rec_id, open_pos, unnest([
    {'seg': 0, 'kind': 'M', 'p': [v[1], v[2]]}, {'seg': 1, 'kind': 'C', 'p': [v[3], v[4], v[5], v[6], v[7], v[8]]},
    {'seg': 2, 'kind': 'C', 'p': [2 * v[7] - v[5], 2 * v[8] - v[6], v[9], v[10], v[11], v[12]]},
    {'seg': 3, 'kind': 'C', 'p': [2 * v[11] - v[9], 2 * v[12] - v[10], v[11] + v[13], v[12] + v[14], v[11] + v[15], v[12] + v[16]]}]) AS s
  FROM num WHERE form = 'MCSs'),
quads AS (SELECT rec_id, open_pos, unnest([
    {'seg': 0, 'kind': 'M', 'p': [v[1], v[2]]}, {'seg': 1, 'kind': 'Q', 'p': [v[3], v[4], v[5], v[6]]},
    {'seg': 2, 'kind': 'Q', 'p': [2 * v[5] - v[3], 2 * v[6] - v[4], v[7], v[8]]},
    {'seg': 3, 'kind': 'Q', 'p': [2 * v[7] - 2 * v[5] + v[3], 2 * v[8] - 2 * v[6] + v[4], v[7] + v[9], v[8] + v[10]]}]) AS s
  FROM num WHERE form = 'MQTt'),
arcs AS (SELECT rec_id, open_pos, unnest([
    {'seg': 0, 'kind': 'M', 'p': [v[1], v[2]], 'arc': v[1:0]}, {'seg': 1, 'kind': 'A', 'p': [v[8], v[9]], 'arc': v[3:7]},
    {'seg': 2, 'kind': 'A', 'p': [v[8] + v[15], v[9] + v[16]], 'arc': v[10:14]}]) AS s FROM num WHERE form = 'MAa'),
flat AS (SELECT rec_id, open_pos, s.seg AS seg, s.kind AS kind, s.p AS p, NULL::DOUBLE[] AS arc FROM (SELECT * FROM lines UNION ALL SELECT * FROM curves UNION ALL SELECT * FROM quads) t
  UNION ALL SELECT rec_id, open_pos, s.seg, s.kind, s.p, s.arc FROM arcs),
seg AS (SELECT rec_id, open_pos, seg, kind, arc, CASE WHEN len(p) > 2 THEN p[1] END AS x1, CASE WHEN len(p) > 2 THEN p[2] END AS y1,
    CASE WHEN len(p) > 4 THEN p[3] END AS x2, CASE WHEN len(p) > 4 THEN p[4] END AS y2, p[-2] AS x, p[-1] AS y FROM flat),
sub AS (SELECT *, lag(x) OVER w AS px, lag(y) OVER w AS py FROM seg WINDOW w AS (PARTITION BY rec_id, open_pos ORDER BY seg))"""

#: Arcs as cubics by the centre form, and the other segments as they are.
D_ARC = D_SEG + """,
a1 AS (SELECT *, cos(radians(arc[3])) AS co, sin(radians(arc[3])) AS si, (px - x) / 2 AS hx, (py - y) / 2 AS hy FROM sub WHERE kind = 'A'),
a2 AS (SELECT *, co * hx + si * hy AS xp, co * hy - si * hx AS yp FROM a1),
a3 AS (SELECT * EXCLUDE (arc), arc, arc[1] * greatest(1, sqrt(xp * xp / (arc[1] * arc[1]) + yp * yp / (arc[2] * arc[2]))) AS rx,
  arc[2] * greatest(1, sqrt(xp * xp / (arc[1] * arc[1]) + yp * yp / (arc[2] * arc[2]))) AS ry FROM a2),
a4 AS (SELECT *, CASE WHEN arc[4] = arc[5] THEN -1 ELSE 1 END * sqrt(greatest(0, (rx * rx * ry * ry - rx * rx * yp * yp - ry * ry * xp * xp)
  / (rx * rx * yp * yp + ry * ry * xp * xp))) AS q FROM a3),
a5 AS (SELECT *, q * rx * yp / ry AS ux, -q * ry * xp / rx AS uy FROM a4),
a6 AS (SELECT *, co * ux - si * uy + (px + x) / 2 AS cx, si * ux + co * uy + (py + y) / 2 AS cy, atan2((yp - uy) / ry, (xp - ux) / rx) AS t1,
  atan2((-yp - uy) / ry, (-xp - ux) / rx) AS t2 FROM a5),
a7 AS (SELECT *, CASE WHEN arc[5] <> 0 AND t2 < t1 THEN t2 - t1 + 2 * pi() WHEN arc[5] = 0 AND t2 > t1 THEN t2 - t1 - 2 * pi() ELSE t2 - t1 END AS dt FROM a6),
a8 AS (SELECT *, greatest(1, ceil(abs(dt) / (pi() / 2) - 1e-9)) AS n FROM a7),
a9 AS (SELECT *, unnest(generate_series(0, CAST(n AS BIGINT) - 1)) AS piece FROM a8),
b1 AS (SELECT *, t1 + dt / n * piece AS u, t1 + dt / n * (piece + 1) AS w, 4.0 / 3 * tan(dt / n / 4) AS h FROM a9),
b2 AS (SELECT *, cos(u) - h * sin(u) AS ax, sin(u) + h * cos(u) AS ay, cos(w) + h * sin(w) AS bx, sin(w) - h * cos(w) AS b_y FROM b1),
curved AS (SELECT rec_id, open_pos, seg, CAST(piece AS INTEGER) AS piece, 'C' AS kind, cx + rx * co * ax - ry * si * ay AS x1, cy + rx * si * ax + ry * co * ay AS y1,
    cx + rx * co * bx - ry * si * b_y AS x2, cy + rx * si * bx + ry * co * b_y AS y2,
    CASE WHEN piece = n - 1 THEN x ELSE cx + rx * co * cos(w) - ry * si * sin(w) END AS x, CASE WHEN piece = n - 1 THEN y ELSE cy + rx * si * cos(w) + ry * co * sin(w) END AS y FROM b2
  UNION ALL SELECT rec_id, open_pos, seg, 0, kind, x1, y1, x2, y2, x, y FROM sub WHERE kind <> 'A')"""

#: Everything as cubics.
D_CUBIC = D_ARC + """,
from_pt AS (SELECT *, lag(x) OVER w AS px, lag(y) OVER w AS py FROM curved WINDOW w AS (PARTITION BY rec_id, open_pos ORDER BY seg, piece)),
cubic AS (SELECT rec_id, open_pos, seg, piece, CASE WHEN kind IN ('L', 'Q') THEN 'C' ELSE kind END AS kind,
    CASE kind WHEN 'L' THEN px + (x - px) / 3 WHEN 'Q' THEN px + (x1 - px) * 2 / 3 ELSE x1 END AS x1,
    CASE kind WHEN 'L' THEN py + (y - py) / 3 WHEN 'Q' THEN py + (y1 - py) * 2 / 3 ELSE y1 END AS y1,
    CASE kind WHEN 'L' THEN px + (x - px) * 2 / 3 WHEN 'Q' THEN x + (x1 - x) * 2 / 3 ELSE x2 END AS x2,
    CASE kind WHEN 'L' THEN py + (y - py) * 2 / 3 WHEN 'Q' THEN y + (y1 - y) * 2 / 3 ELSE y2 END AS y2, x, y FROM from_pt)"""


@register("path_absolute", GEOM + D_SEG + f"""
SELECT rec_id, open_pos, CAST(seg AS INTEGER) AS seg, kind, {_rounded(POINTS)} FROM seg""")
def q_path_absolute(spark, sf):
    return _points(G.path_segments(_plain_paths(spark, sf)))


@register("subpath_close", GEOM + D_SEG + """
SELECT rec_id, open_pos, CAST(1 AS INTEGER) AS n_subpaths, CAST(CASE WHEN form = 'MHVhvz' OR (l.x = f.x AND l.y = f.y) THEN 1 ELSE 0 END AS INTEGER) AS n_closed,
  CAST(NULL AS VARCHAR) AS reason FROM num JOIN (SELECT rec_id, open_pos, arg_max(x, seg) AS x, arg_max(y, seg) AS y FROM seg GROUP BY ALL) l USING (rec_id, open_pos)
  JOIN (SELECT rec_id, open_pos, x, y FROM seg WHERE seg = 0) f USING (rec_id, open_pos)""")
def q_subpath_close(spark, sf):
    p = _plain_paths(spark, sf).withColumn("_t", G.path_tokens("d")).withColumn("_i", G.command_index("_t"))
    s = p.withColumn("_c", G.path_commands("_t", "_i")).withColumn("segs", G.path_absolute("_c")).withColumn("subs", G.subpath_close("segs"))
    return s.select("rec_id", "open_pos", F.size("subs").alias("n_subpaths"),
                    F.aggregate("subs", F.lit(0), lambda acc, x: acc + x["closed"].cast("int")).alias("n_closed"),
                    G.path_reason("_t", "_i").alias("reason"))


@register("arc_to_cubic", GEOM + D_ARC + f"""
SELECT rec_id, open_pos, CAST(seg AS INTEGER) AS seg, piece, kind, {_rounded(POINTS)} FROM curved""")
def q_arc_to_cubic(spark, sf):
    return _points(G.split_arcs(G.path_segments(_plain_paths(spark, sf))), "piece")


@register("to_cubic", GEOM + D_CUBIC + f"""
SELECT rec_id, open_pos, CAST(seg AS INTEGER) AS seg, piece, kind, {_rounded(POINTS)} FROM cubic""")
def q_to_cubic(spark, sf):
    return _points(G.cubic_rows(G.split_arcs(G.path_segments(_plain_paths(spark, sf)))), "piece")


@register("shape_to_path", GEOM + """,
n AS (SELECT rec_id, open_pos, tag, list_transform(regexp_extract_all(tok, '="([0-9.]+)"', 1), lambda t: CAST(t AS BIGINT)) AS v FROM okel WHERE tag IN ('circle', 'ellipse', 'rect')),
e AS (SELECT rec_id, open_pos, tag, v[1] AS cx, v[2] AS cy, v[3] AS rx, v[len(v)] AS ry FROM n WHERE tag <> 'rect'),
b AS (SELECT rec_id, open_pos, tag, v[1] AS x, v[2] AS y, v[3] AS w, v[4] AS h, least(v[5], v[4] / 2) AS r FROM n WHERE tag = 'rect')
SELECT rec_id, open_pos, tag, concat('M ', cx - rx, ' ', cy, ' A ', rx, ' ', ry, ' 0 1 0 ', cx + rx, ' ', cy, ' A ', rx, ' ', ry, ' 0 1 0 ', cx - rx, ' ', cy, ' Z') AS d FROM e
UNION ALL SELECT rec_id, open_pos, tag, CASE WHEN r = 0 THEN concat('M ', x, ' ', y, ' H ', x + w, ' V ', y + h, ' H ', x, ' Z')
  ELSE concat('M ', x + r::BIGINT, ' ', y, ' H ', (x + w - r)::BIGINT, ' A ', r::BIGINT, ' ', r::BIGINT, ' 0 0 1 ', x + w, ' ', (y + r)::BIGINT, ' V ', (y + h - r)::BIGINT,
    ' A ', r::BIGINT, ' ', r::BIGINT, ' 0 0 1 ', (x + w - r)::BIGINT, ' ', y + h, ' H ', (x + r)::BIGINT, ' A ', r::BIGINT, ' ', r::BIGINT, ' 0 0 1 ', x, ' ',
    (y + h - r)::BIGINT, ' V ', (y + r)::BIGINT, ' A ', r::BIGINT, ' ', r::BIGINT, ' 0 0 1 ', (x + r)::BIGINT, ' ', y, ' Z') END FROM b""")
def q_shape_to_path(spark, sf):
    el = ok_elements(spark, sf, "svg_geom").where(F.col("tag").isin("rect", "circle", "ellipse"))
    return G.with_shape_path(el, "d").select("rec_id", "open_pos", "tag", "d")


def _moved(x: str, y: str) -> str:
    return f"round((m.a * {x} + m.c * {y} + m.e) * 2, 6) + 0.0 AS {x}, round((m.b * {x} + m.d * {y} + m.f) * 2, 6) + 0.0 AS {y}"


@register("apply_transform", GEOM_REC + D_EFF + D_ARC + f"""
SELECT t.rec_id, t.open_pos, CAST(seg AS INTEGER) AS seg, piece, kind, {_moved('x1', 'y1')}, {_moved('x2', 'y2')}, {_moved('x', 'y')}
FROM curved t JOIN eff m ON m.rec_id = t.rec_id AND m.open_pos = t.open_pos""")
def q_apply_transform(spark, sf):
    return _points(G.transform_rows(G.split_arcs(G.path_segments(_geom_paths(spark, sf))), "m", "s"), "piece")


D_NUM3 = "regexp_replace(regexp_replace(regexp_replace(printf('%.3f', {}), '0+$', ''), '\\.$', ''), '^-0$', '0')"


def _pair(x: str, y: str) -> str:
    return f"{D_NUM3.format(x)} || ' ' || {D_NUM3.format(y)}"


@register("path_text", GEOM + D_CUBIC + f""",
txt AS (SELECT rec_id, open_pos, string_agg(CASE kind WHEN 'M' THEN 'M ' || {_pair('x', 'y')}
    ELSE ' C ' || {_pair('x1', 'y1')} || ' ' || {_pair('x2', 'y2')} || ' ' || {_pair('x', 'y')} END, '' ORDER BY seg, piece) AS body,
    max(seg) AS top FROM cubic GROUP BY rec_id, open_pos)
SELECT rec_id, open_pos, body || CASE WHEN form = 'MHVhvz' OR (l.x = f.x AND l.y = f.y) THEN 'Z' ELSE '' END AS path_d FROM txt JOIN num USING (rec_id, open_pos)
  JOIN (SELECT rec_id, open_pos, arg_max(x, seg) AS x, arg_max(y, seg) AS y FROM seg GROUP BY ALL) l USING (rec_id, open_pos)
  JOIN (SELECT rec_id, open_pos, x, y FROM seg WHERE seg = 0) f USING (rec_id, open_pos)""")
def q_path_text(spark, sf):
    p = _plain_paths(spark, sf).withColumn("m", G.identity()).withColumn("s", F.lit(1.0))
    return G.path_texts(p, ["rec_id", "open_pos"])


def _scaled_elements(spark, sf, name):
    """Elements with effective matrix and canvas scale."""
    el = ok_elements(spark, sf, name)
    root = T.canvas_scale(T.canvas_box(el.where("depth = 0")))
    return N.effective_transform(_with_local(el)).join(root.select("rec_id", "s").hint("merge"), "rec_id")


D_CANVAS = """,
cs AS (SELECT rec_id, 256.0 / greatest(CAST(v[3] AS DOUBLE), CAST(v[4] AS DOUBLE)) AS s FROM (SELECT rec_id, string_split(regexp_extract(tok, 'viewBox="([^"]*)"', 1), ' ') AS v
  FROM okel WHERE depth = 0) t)"""


@register("gradient_points", GEOM_REC + D_EFF + D_CANVAS + """,
g AS (SELECT eff.*, s, list_transform(regexp_extract_all(tok, ' (?:x1|y1|x2|y2|cx|cy|r)="([0-9.]+)"', 1), lambda t: CAST(t AS DOUBLE)) AS v FROM eff JOIN cs USING (rec_id) WHERE tag LIKE '%Gradient')
SELECT rec_id, open_pos, tag, round((a * v[1] + c * v[2] + e) * s, 6) + 0.0 AS px, round((b * v[1] + d * v[2] + f) * s, 6) + 0.0 AS py,
  CASE WHEN tag LIKE 'lin%' THEN round((a * v[3] + c * v[4] + e) * s, 6) + 0.0 END AS qx, CASE WHEN tag LIKE 'lin%' THEN round((b * v[3] + d * v[4] + f) * s, 6) + 0.0 END AS qy,
  CASE WHEN tag LIKE 'rad%' THEN round(v[3] * s, 6) END AS r FROM g""")
def q_gradient_points(spark, sf):
    el = _scaled_elements(spark, sf, "svg_geom").where(F.col("tag").isin("linearGradient", "radialGradient"))
    linear = F.col("tag") == "linearGradient"
    cols = {f"{p}{x}": F.when(linear, F.col(f"g_{x}{k}")) for k, p in ((1, "p"), (2, "q")) for x in "xy"}
    cols |= {f"p{x}": F.when(linear, F.col(f"g_{x}1")).otherwise(F.col(f"g_c{x}")) for x in "xy"} | {"r": F.when(~linear, F.col("g_r"))}
    return N.gradient_points(el).select("rec_id", "open_pos", "tag", *[(F.round(c, 6) + 0.0).alias(k) for k, c in cols.items()])


@register("stroke_default", GEOM_REC + D_EFF + D_CANVAS + """
SELECT rec_id, open_pos, tag, round(s * CASE WHEN tag = 'path' AND abs(abs(a) - abs(d)) < 1e-4 AND abs(a) > 1e-8 THEN abs(a) ELSE 1 END, 6) AS stroke_width
FROM eff JOIN cs USING (rec_id) WHERE contains(tok, ' stroke="') AND NOT contains(tok, 'stroke-width=')""")
def q_stroke_default(spark, sf):
    el, la = _scaled_elements(spark, sf, "svg_geom"), F.col("lattrs")
    el = el.where(la["stroke"].isNotNull() & la["stroke-width"].isNull())
    return el.select("rec_id", "open_pos", "tag", F.round(N.length_scale(F.col("tag"), F.col("m_eff"), F.col("s")), 6).alias("stroke_width"))


@register("scale_lengths", GEOM + D_CANVAS + """,
k AS (SELECT DISTINCT rec_id, s, regexp_extract(svg, 'font-size:([0-9]+)px', 1)::DOUBLE AS fs, regexp_extract(svg, 'stroke-width:([0-9]+)}', 1)::DOUBLE AS sw FROM svg_geom JOIN cs USING (rec_id))
SELECT rec_id, concat('.a{stroke:red;stroke-width:', """ + D_NUM3.format("s") + """, '}', chr(10), '.b{font-size:', """ + D_NUM3.format("fs * s") + """, ';fill:blue;stroke-width:',
  """ + D_NUM3.format("sw * s") + """, '}', chr(10), '.c{font-size:', """ + D_NUM3.format("fs * s") + """, ';fill:blue}') AS block FROM k""")
def q_scale_lengths(spark, sf):
    """The scaled ``<style>`` block of each record."""
    tk = tokens(spark, sf, "svg_geom")
    el = T.lower_attrs(T.svg_elements(tk))
    scale = T.canvas_scale(T.canvas_box(el.where("depth = 0"))).select("rec_id", "s")
    blocks = T.style_blocks(tk, scale, "rec_id", N.LENGTH_ATTRS + N.NON_ROOT_LENGTHS, lambda v: G.fmt_num(v))
    return blocks.select("rec_id", F.col("new_text").alias("block"))


@register("svg_text", duck_with("svg_raw") + ",\n" + d_tokens() + """
SELECT rec_id, regexp_replace(svg, '<!--.*?-->', '', 'g') AS svg_out FROM svg_raw WHERE rec_id IN (SELECT rec_id FROM dwf WHERE ok)""")
def q_svg_text(spark, sf):
    tk = ok_tokens(spark, sf)
    el = T.svg_elements(tk)
    el = el.select("rec_id", "open_pos", "close_pos", F.col("qname").alias("new_tag"), F.col("attrs").alias("new_attrs"))
    return N.svg_text(tk, el)


@register("normalize_corpus")
def q_normalize_corpus(spark, sf):
    return N.normalize_corpus(view(spark, sf, "svg_raw").select("rec_id", "svg"), partitions=tasks(spark, sf, "part"))


# ---------------------------------------------------------------- lineage, outcomes, sizes
def _stages(spark, sf):
    s = view(spark, sf, "stage_out")
    raw = s.select("rec_id", "filename", F.col("raw").alias("text"))
    s1 = s.where(F.col("stage1").isNotNull()).select("rec_id", F.col("stage1").alias("text"))
    s2 = s.where(F.col("stage2").isNotNull()).select("rec_id", F.col("stage2").alias("text"))
    return raw, s1, s2


D_LINEAGE = """lineage AS (SELECT rec_id, filename, md5(raw) AS raw, CASE WHEN stage1 IS NOT NULL THEN md5(stage1) END AS stage1,
  CASE WHEN stage2 IS NOT NULL THEN md5(stage2) END AS stage2,
  CASE WHEN stage1 IS NULL THEN 'stage1 failed' END AS error FROM stage_out)"""


@register("stage_lineage", duck_with("stage_out") + ", " + D_LINEAGE + "\nSELECT rec_id, filename, raw, stage1, stage2, error FROM lineage")
def q_stage_lineage(spark, sf):
    return C.stage_lineage(*_stages(spark, sf))


@register("outcome_counts", duck_with("stage_out") + ", " + D_LINEAGE + """
SELECT regexp_extract(filename, '^([^/]+)/', 1) AS grp, count(*) FILTER (WHERE error IS NULL) AS successful,
  count(*) FILTER (WHERE error IS NOT NULL) AS failed, count(*) FILTER (WHERE error IS NULL AND stage2 IS NULL) AS empty_stage2
FROM lineage GROUP BY 1""")
def q_outcome_counts(spark, sf):
    return C.outcome_counts(C.stage_lineage(*_stages(spark, sf)))


@register("size_reduction", duck_with("stage_out") + """SELECT stage, CAST(sum(length(raw)) AS BIGINT) AS chars_before,
  CAST(sum(length(txt)) AS BIGINT) AS chars_after, round(1 - sum(length(txt)) / sum(length(raw)), 6) AS pct_saved FROM (
  SELECT 'stage1' AS stage, raw, stage1 AS txt FROM stage_out WHERE stage1 IS NOT NULL
  UNION ALL SELECT 'stage2', raw, stage2 FROM stage_out WHERE stage2 IS NOT NULL) t GROUP BY stage""")
def q_size_reduction(spark, sf):
    s = view(spark, sf, "stage_out")
    return C.size_reduction(s, "raw", ["stage1", "stage2"])


def _corpus(spark, sf):
    """The corpus job over ``svg_raw``: store, log, lineage and texts, written once for the queries that read them."""
    def write(folder):
        s = view(spark, sf, "svg_raw")
        run = C.optimize_corpus(s.select("rec_id", F.concat(F.lit("f"), (F.col("rec_id") % 7).cast("string"), F.lit("/"), F.col("rec_id").cast("string"), F.lit(".svg"))
                                         .alias("filename"), "svg"), partitions=tasks(spark, sf, "part"))
        run.lineage.write.parquet(f"{folder}/lineage")
        run.texts.write.parquet(f"{folder}/texts")
        run = C.CorpusRun(spark.read.parquet(f"{folder}/texts"), spark.read.parquet(f"{folder}/lineage"))
        table = "corpus_" + folder.rstrip("/").rsplit("-", 1)[-1]
        try:
            sinks.corpus_sink(run, table, f"{folder}/store", f"{folder}/log", buckets=8)
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {table}")  # the table is external: its files stay

    return once(spark, "corpus", [f"{sf.rstrip('/')}/part.parquet"], write)


@register("corpus_job")
def q_corpus_job(spark, sf):
    """Lineage as the log has it (records without an error) with what the store holds of it."""
    folder = _corpus(spark, sf)
    lineage = spark.read.parquet(f"{folder}/lineage")
    log = spark.read.schema("rec_id bigint").json(f"{folder}/log").select("rec_id", F.lit(True).alias("logged"))
    store = spark.read.parquet(f"{folder}/store").select("hash")
    held = (lineage.select("rec_id", F.explode(F.array("raw", "stage1", "stage2")).alias("hash")).join(store.hint("merge"), "hash")
            .groupBy("rec_id").agg(F.count("*").alias("n_stored")))
    return (lineage.join(log.hint("merge"), "rec_id", "left").join(held.hint("merge"), "rec_id", "left")
            .select("rec_id", "filename", "raw", "stage1", "stage2", "error", F.coalesce("logged", F.lit(False)).alias("logged"),
                    F.coalesce("n_stored", F.lit(0)).alias("n_stored")))


@register("corpus_outcomes")
def q_corpus_outcomes(spark, sf):
    return C.outcome_counts(spark.read.parquet(f"{_corpus(spark, sf)}/lineage"))


@register("corpus_sizes")
def q_corpus_sizes(spark, sf):
    return C.stage_sizes(spark.read.parquet(f"{_corpus(spark, sf)}/texts"))


@register("content_hash", duck_with("svg_raw") + """SELECT rec_id, md5(svg) AS md5, sha256(svg) AS sha256 FROM svg_raw""")
def q_content_hash(spark, sf):
    s = view(spark, sf, "svg_raw")
    return s.select("rec_id", content_hash("svg", "md5").alias("md5"), content_hash("svg", "sha256").alias("sha256"))
