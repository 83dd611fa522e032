"""Stage-1 normalisation as one composed job over the exploded element table.

gate -> tokens -> well-formed -> elements -> canvas scale -> effective transforms (ancestor join)
-> shapes and paths rewritten -> lengths scaled -> markup text. Every record ends with a status
and, when it fails, a reason; nothing is dropped silently.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from svgspark.functions.text import local_name, style_map, style_text
from svgspark.operators import geom as G
from svgspark.operators import select as S
from svgspark.operators import tree as T
from svgspark.session import materialized

# Attribute lists of the stage-1 rules.
LENGTH_ATTRS = ["stroke-width", "x", "y", "x1", "x2", "y1", "y2", "font-size", "line-height"]
NON_ROOT_LENGTHS = ["width", "height"]
SHAPE_TO_PATH = ["rect", "circle", "ellipse"]
SHAPE_GEOMETRY = ["x", "y", "width", "height", "rx", "ry", "cx", "cy", "r"]
UNIT = (1.0, 0.0, 0.0, 1.0, 0.0, 0.0)
SHAPES = ["path", "polygon", "line", "polyline", "circle", "rect", "ellipse"]


def _products(key: str):
    """Product of local matrices along the open elements: one pass over a record's elements with a stack."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("open_pos")
        stack: list[tuple] = []  # the open elements: where each closes, its depth, its product
        out: list[tuple] = []
        places = zip(*[table.column(x).to_pylist() for x in ("open_pos", "close_pos", "depth")])
        for (pos, close, depth), own in zip(places, zip(*[table.column(x).to_pylist() for x in G.MAT_FIELDS])):
            while stack and (stack[-1][1] >= depth or (stack[-1][0] is not None and stack[-1][0] < pos)):
                stack.pop()
            if stack and own != UNIT:
                a, b, c, d, e, f = stack[-1][2]
                p, q, r, s, t, u = own
                own = (a * p + c * q, b * p + d * q, a * r + c * s, b * r + d * s, a * t + c * u + e, b * t + d * u + f)
            elif stack:
                own = stack[-1][2]
            stack.append((close, depth, own))
            out.append(own)
        kept = table.select([key, "open_pos"])
        for x, column in zip(G.MAT_FIELDS, zip(*out)):
            kept = kept.append_column(x, pa.array(column, pa.float64()))
        return kept

    return run


def local_matrix(m: str = "lattrs") -> F.Column:
    return G.parse_transform(F.concat_ws(" ", F.col(m)["transform"], F.col(m)["gradienttransform"]))


def effective_transform(el: DataFrame, key: str = "rec_id") -> DataFrame:
    """Adds ``m_eff``: product of ancestors' local matrices (root first) times the element's own.

    A record's elements are folded in order with the stack of open elements, a row each however deep they are nested.
    Elements without a matrix of their own may be left out, since those that are open are told by where they close.
    """
    kind = el.schema[key].dataType.simpleString()
    rows = el.select(key, F.col("open_pos").cast("int").alias("open_pos"), F.col("close_pos").cast("int").alias("close_pos"), "depth", *[F.col("m_local")[x].alias(x) for x in G.MAT_FIELDS])
    eff = rows.groupBy(key).applyInArrow(_products(key), f"{key} {kind}, open_pos int, " + ", ".join(f"{x} double" for x in G.MAT_FIELDS))
    return el.join(eff.select(key, "open_pos", F.struct(*G.MAT_FIELDS).alias("m_eff")).hint("merge"), [key, "open_pos"], "left")


def _scaled_style(m, is_shape, shape_factor, factor, fmt) -> F.Column:
    """The declarations of an inline style with its lengths scaled; NULL when it holds none."""
    length = lambda k: F.when(is_shape, k == "stroke-width").otherwise(k.isin(*LENGTH_ATTRS, *NON_ROOT_LENGTHS))
    number = lambda v: F.regexp_replace(v, "[A-Za-z]", "").try_cast("double")
    by = F.when(is_shape, shape_factor).otherwise(factor)
    some = F.exists(F.map_keys(m), length)
    return F.when(some, style_text(F.transform_values(m, lambda k, v: F.when(length(k), F.coalesce(fmt(number(v) * by), v)).otherwise(v))))


def length_scale(tag, m, s) -> F.Column:
    """What a length is multiplied by: a shape's own scale too where it is the same on both axes, a group's is the canvas'."""
    uniform = (F.abs(F.abs(m["a"]) - F.abs(m["d"])) < 1e-4) & (F.abs(m["a"]) > 1e-8)
    return s * F.when(tag.isin(*SHAPES) & uniform, F.abs(m["a"])).otherwise(F.lit(1.0))


def gradient_points(el: DataFrame, attrs: str = "lattrs") -> DataFrame:
    """Adds ``g_x1 g_y1 g_x2 g_y2`` (start and end of a linear gradient, ends of a line), ``g_cx g_cy g_r`` (centre and
    radius of a radial one), moved by ``m_eff`` and scaled by ``s``; coordinates that are missing or no numbers count as 0,
    percentages of a centre as plain numbers. ``n_*`` are the numbers as written, NULL where they are none."""
    la, m, s = F.col(attrs), F.col("m_eff"), F.col("s")
    names = ("x1", "y1", "x2", "y2", "cx", "cy", "r")
    el = el.withColumns({f"n_{k}": F.regexp_replace(la[k], "[A-Za-z]", "").try_cast("double") for k in names})
    at = {k: F.coalesce(f"n_{k}", F.regexp_replace(la[k], "[A-Za-z%]", "").try_cast("double") if k[0] == "c" else F.lit(0.0), F.lit(0.0)) for k in names}
    el = el.withColumns({f"p_{k}": at[k] for k in names})
    moved = {}
    for x, y in (("x1", "y1"), ("x2", "y2"), ("cx", "cy")):
        moved |= {f"g_{x}": (m["a"] * F.col(f"p_{x}") + m["c"] * F.col(f"p_{y}") + m["e"]) * s, f"g_{y}": (m["b"] * F.col(f"p_{x}") + m["d"] * F.col(f"p_{y}") + m["f"]) * s}
    return el.withColumns(moved | {"g_r": F.col("n_r") * s}).drop(*[f"p_{k}" for k in names])


def normalize_corpus(docs: DataFrame, key: str = "rec_id", normalize_scale: float = 256.0, normalize_points: bool = True,
                     cubic_only: bool = True, to_int: bool = False, decimals: int = 3, partitions: int = 0) -> DataFrame:
    """``(rec_id, svg)`` -> ``(rec_id, status, reason, svg_out, n_chars_in, n_chars_out)``; ``partitions``: see ``tree.by_record``."""
    docs = T.by_record(docs.select(key, "svg"), key, partitions)
    gate = S.reject_reason("svg")
    gated = docs.withColumn("reason", gate)
    # token lists and elements are read several times below: each is written once
    lists = materialized(T.token_lists(gated.where(F.col("reason").isNull()).select(key, "svg"), key, partitions=partitions), "stage1_tokens")
    lists = T.by_record(lists, key, partitions)
    wf = materialized(T.wellformed(T.exploded(lists, key), key), "stage1_checks")
    toks = T.exploded(lists.join(wf.where("ok").select(key).hint("merge"), key, "left_semi"), key)
    # an element without attributes that is neither the root nor a shape has nothing to rewrite and moves nothing
    el = T.svg_elements(toks, key)
    bare = (F.size("attrs") == 0) & (F.col("depth") > 0) & ~F.col("tag").isin(*SHAPES)
    same = el.where(bare).select(key, "open_pos", "close_pos", F.col("tag").alias("new_tag"), F.col("attrs").alias("new_attrs"))
    el = T.by_record(materialized(T.lower_attrs(el.where(~bare)), "stage1_tree"), key, partitions)

    # path data that do not make whole commands fail the record
    paths = el.where(F.col("tag") == "path").select(key, "open_pos", G.path_tokens(F.col("lattrs").getItem("d")).alias("_t"))
    paths = paths.withColumn("_i", G.command_index("_t")).withColumn("reason", G.path_reason("_t", "_i")).where(F.col("reason").isNotNull())
    torn = materialized(paths.groupBy(key).agg(F.min_by("reason", "open_pos").alias("reason")), "stage1_torn")

    # canvas of each root and the scale factor
    root = T.canvas_box(el.where((F.col("depth") == 0)), "lattrs")
    root = T.canvas_scale(root, normalize_scale, to_int)
    root = materialized(root.select(key, "s", *[f"{x}{y}" for x in ("vb_x", "vb_y", "vb_w", "vb_h") for y in ("", "_s")]), "stage1_roots")
    flat = root.where(F.col("s").isNull()).select(key)  # a canvas without extent has no scale
    sc = root.select(key, F.col("s") if normalize_points else F.lit(1.0).alias("s"),
                     "vb_x_s", "vb_y_s", "vb_w_s", "vb_h_s", "vb_w", "vb_h")
    el = el.join(sc.select(key, "s").hint("merge"), key, "left")

    la = F.col("lattrs")
    el = el.withColumn("m_local", local_matrix())
    # rect, circle and ellipse become paths
    el = materialized(effective_transform(G.with_shape_path(el, "_shape"), key), "stage1_elements")

    tag = F.col("tag")
    is_shape = tag.isin(*SHAPES)
    el = el.withColumn("_d", F.when(tag == "path", la.getItem("d")).otherwise(F.col("_shape"))).drop("_shape")
    drawn = G.path_texts(el.select(key, "open_pos", "_d", "m_eff", "s"), [key, "open_pos"], "_d", "m_eff", "s", cubic_only, decimals, to_int)
    el = el.join(materialized(drawn, "stage1_paths").withColumnRenamed("path_d", "_d_out").hint("merge"), [key, "open_pos"], "left")

    # every rewritten attribute as one small "updates" map (lower-case keys), applied in one pass
    m, s = F.col("m_eff"), F.col("s")
    fmt = lambda v: G.fmt_num(v, decimals, to_int)
    line_like = tag.isin("line", "linearGradient", "lineargradient")
    rad = tag.isin("radialGradient", "radialgradient")
    gradient = rad | tag.isin("linearGradient", "lineargradient")
    # gradients keep their defaults and percentages: only coordinates that are all there as numbers are rewritten
    el = gradient_points(el)
    number = {k: F.col(f"n_{k}") for k in ("x1", "y1", "x2", "y2", "cx", "cy", "r")}
    line_like = line_like & ((tag == "line") | (number["x1"] + number["y1"] + number["x2"] + number["y2"]).isNotNull())
    # a percentage takes part in the point as a plain number but stays as written
    part = {k: F.regexp_replace(la.getItem(k), "[A-Za-z%]", "").try_cast("double") for k in ("cx", "cy", "r")}
    rad = rad & (part["cx"] + part["cy"] + part["r"]).isNotNull()
    stroke_scale = length_scale(tag, m, s)
    el = el.join(sc.drop("s").hint("merge"), key, "left")
    is_root = F.col("depth") == 0
    vb = F.concat_ws(" ", *[fmt(F.col(x)) for x in ("vb_x_s", "vb_y_s", "vb_w_s", "vb_h_s")])
    ups = [
        ("d", F.when(F.col("_d").isNotNull(), F.col("_d_out"))),
        # a stroke without a width has width 1: a shape's scales with its own matrix, a group's by the canvas alone
        ("stroke-width", F.when(~gradient & la.getItem("stroke").isNotNull() & la.getItem("stroke-width").isNull(),
                                fmt(stroke_scale))),
        ("x1", F.when(line_like, fmt(F.col("g_x1")))), ("y1", F.when(line_like, fmt(F.col("g_y1")))),
        ("x2", F.when(line_like, fmt(F.col("g_x2")))), ("y2", F.when(line_like, fmt(F.col("g_y2")))),
        ("points", F.when(tag.isin("polyline", "polygon") & la.getItem("points").isNotNull(),
                          G.points_text(la.getItem("points"), m, s, decimals, to_int))),
        ("cx", F.when(rad & number["cx"].isNotNull(), fmt(F.col("g_cx")))), ("cy", F.when(rad & number["cy"].isNotNull(), fmt(F.col("g_cy")))),
        ("r", F.when(rad, fmt(F.col("g_r")))),
        ("viewbox", F.when(is_root & F.lit(normalize_points), vb)),
        ("width", F.when(is_root & (la.getItem("width").isNull() | la.getItem("width").contains("%")), fmt(F.col("vb_w")))),
        ("height", F.when(is_root & (la.getItem("height").isNull() | la.getItem("height").contains("%")), fmt(F.col("vb_h")))),
    ]
    entries = F.array(*[F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in ups])
    el = el.withColumn("_ups", entries)
    entries = F.col("_ups")
    el = el.withColumn("_up", F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull())))
    el = el.withColumn("_sw", stroke_scale)
    dropped = lambda k: (F.lower(k).isin("transform", "gradienttransform") | F.lower(k).startswith("xmlns")
                         | (tag.isin(*SHAPE_TO_PATH) & F.lower(k).isin(*SHAPE_GEOMETRY)))
    base = F.map_filter("attrs", lambda k, v: ~dropped(k) & ~((F.lower(k) == "xlink:href") & F.array_contains(F.map_keys("lattrs"), "href")))
    base = F.transform_keys(base, lambda k, v: F.when(F.lower(k) == "xlink:href", F.lit("href")).otherwise(k))
    el = el.withColumn("_base", base)
    # lengths in an inline style scale by the same factor as the attributes would
    el = el.withColumn("_declared", style_map(la.getItem("style"), whole=True))
    el = el.withColumn("_style", _scaled_style(F.col("_declared"), is_shape, F.col("_sw"), s, fmt))
    num_re = r"^\s*[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?[A-Za-z]*\s*$"

    def rewrite(k, v):
        lk = F.lower(k)
        up = F.col("_up").getItem(lk)
        is_len = lk.isin(*LENGTH_ATTRS) | (lk.isin(*NON_ROOT_LENGTHS) & ~is_root)
        factor = F.when(is_shape, F.when(lk == "stroke-width", F.col("_sw"))).otherwise(s)
        scaled = fmt(F.regexp_replace(v, "[A-Za-z]", "").try_cast("double") * factor)
        return (F.when(up.isNotNull(), up)
                .when(lk == "style", F.coalesce("_style", v))
                .when(is_len & factor.isNotNull() & v.rlike(num_re), scaled)
                .otherwise(v))

    el = el.withColumn("_a", F.transform_values("_base", rewrite))
    present = F.transform(F.map_keys("_base"), lambda k: F.lower(k))
    extra = F.map_filter("_up", lambda k, v: ~F.array_contains(present, k))
    extra = F.transform_keys(extra, lambda k, v: F.when(k == "viewbox", F.lit("viewBox")).otherwise(k))
    el = el.withColumn("_a", F.map_concat("_a", extra))
    new_tag = F.when(tag.isin(*SHAPE_TO_PATH), F.lit("path")).otherwise(tag)
    el = materialized(el.select(key, "open_pos", "close_pos", new_tag.alias("new_tag"), F.col("_a").alias("new_attrs")), "stage1_rewritten")

    text = svg_text(toks, el.unionByName(same), key, T.style_blocks(toks, sc.select(key, "s"), key, LENGTH_ATTRS + NON_ROOT_LENGTHS, fmt))
    fails = (gated.where(F.col("reason").isNotNull()).select(key, F.lit("rejected").alias("status"), "reason",
                                                             F.lit(None).cast("string").alias("svg_out")))
    parse_fail = wf.where(~F.col("ok")).select(key, F.lit("parse_error").alias("status"), "reason",
                                               F.lit(None).cast("string").alias("svg_out"))
    if normalize_points:
        flat_fail = flat.select(key, F.lit("rejected").alias("status"), F.lit("empty canvas").alias("reason"), F.lit(None).cast("string").alias("svg_out"))
        parse_fail = parse_fail.unionByName(flat_fail)
        text = text.join(flat.hint("merge"), key, "left_anti")
        torn = torn.join(flat.hint("merge"), key, "left_anti")
    parse_fail = parse_fail.unionByName(torn.select(key, F.lit("parse_error").alias("status"), "reason", F.lit(None).cast("string").alias("svg_out")))
    text = text.join(torn.hint("merge"), key, "left_anti")
    ok = text.select(key, F.lit("ok").alias("status"), F.lit(None).cast("string").alias("reason"), "svg_out")
    res = fails.unionByName(parse_fail).unionByName(ok)
    sizes = docs.select(key, F.length("svg").cast("bigint").alias("n_chars_in"))
    return res.join(sizes.hint("merge"), key).withColumn("n_chars_out", F.length("svg_out").cast("bigint"))


def attrs_text(m) -> F.Column:
    return F.array_join(F.transform(F.map_entries(m), lambda e: F.concat(F.lit(" "), e["key"], F.lit('="'),
                                                                         T.escape_xml(e["value"]), F.lit('"'))), "")


# What a row says of its place in the markup: a text; an opening, empty or closing tag; how an element's tag is written where
# it opens (an empty one also ends there) or closes; a text instead of the token's; markup put in.
TEXT, OPEN, EMPTY, CLOSE, OPENING, WHOLE, CLOSING, INSTEAD, ADDED = range(9)


def _beside(items: list[tuple]) -> list[str]:
    """The pieces of a record in which rows share a place: every token with every element and text of its place, in order."""
    places: dict[int, list[tuple]] = {}
    for item in items:
        places.setdefault(item[0], []).append(item)
    out = []
    for pos, rows in places.items():
        some = lambda *kinds: [p for _, _, k, p in rows if k in kinds]
        opens, instead = some(OPENING, WHOLE) or [None], some(INSTEAD) or [None]
        closes = some(CLOSING) + [None if p is None else f"</{p[1:].split(' ')[0]}>" for p in some(WHOLE)] or [None]
        for _, _, kind, own in rows:
            if kind == ADDED or kind > CLOSE:
                continue
            for o, c, x in itertools.product(opens, closes, instead):
                tag = None if o is None else o + ("/>" if kind == EMPTY else ">")
                out.append((pos, 0, tag if kind in (OPEN, EMPTY) else (c or own) if kind == CLOSE else own if x is None else x))
        out += [(pos, ord, p) for _, ord, kind, p in rows if kind == ADDED]
    return [p for _, _, p in sorted((x for x in out if x[2] is not None), key=lambda x: (x[0], x[1], x[2].encode()))]


def _written(lists: pa.Array) -> pa.Array:
    """The markup of each record of a batch from its rows ``(at, piece)``, by array operations; ``at`` is place, order and kind."""
    rows = lists.flatten()
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    rec = np.repeat(np.arange(len(lists)), sizes)
    order = np.lexsort((rows.field("at").to_numpy(zero_copy_only=False), rec))
    rec, at, piece = rec[order], rows.field("at").to_numpy(zero_copy_only=False)[order], rows.field("piece").take(pa.array(order))
    pos, ord, kind = at >> 32, at >> 4 & (1 << 28) - 1, at & 15
    there = piece.is_valid().to_numpy(zero_copy_only=False)
    place = np.cumsum(np.concatenate([[True], (rec[1:] != rec[:-1]) | (pos[1:] != pos[:-1])])[:len(rec)]) - 1
    n = place[-1] + 1 if len(place) else 0

    def held(mask):
        return np.bincount(place[mask], minlength=n)

    several = held(kind <= CLOSE) > 1
    for mask in (np.isin(kind, (OPENING, WHOLE)), kind == CLOSING, kind == INSTEAD, kind == ADDED):
        several |= held(mask) > 1
    several |= (held(kind == ADDED) > 0) & (held((kind == ADDED) & (ord == 0)) > 0)
    token = np.full(n, -1)
    token[place[kind <= CLOSE]] = kind[kind <= CLOSE]
    token = token[place]
    tag = np.isin(kind, (OPENING, WHOLE)) & there & np.isin(token, (OPEN, EMPTY))
    other = (held((kind == CLOSING) & there) > 0)[place]
    instead = (held((kind == INSTEAD) & there) > 0)[place]
    keep = there & (tag | ((kind == CLOSING) & (token == CLOSE)) | ((kind == CLOSE) & ~other) | ((kind == TEXT) & ~instead)
                    | ((kind == INSTEAD) & (token == TEXT)) | (kind == ADDED))
    odd = np.zeros(len(lists), bool)
    odd[rec[several[place]]] = True
    keep &= ~odd[rec]
    ends = np.where(tag, np.where(token == EMPTY, 2, 1), 0)[keep]
    suffix = pa.array(["", ">", "/>"]).take(pa.array(ends))
    pieces = pc.binary_join_element_wise(piece.filter(pa.array(keep)), suffix, "")
    offsets = np.concatenate([[0], np.cumsum(np.bincount(rec[keep], minlength=len(lists)))]).astype(np.int32)
    out = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), pieces), "")
    if odd.any():
        texts = out.to_pylist()
        for i in np.flatnonzero(odd):
            texts[i] = "".join(_beside([(x["at"] >> 32, x["at"] >> 4 & (1 << 28) - 1, x["at"] & 15, x["piece"]) for x in lists[int(i)].as_py()]))
        out = pa.array(texts, pa.string())
    return out


def svg_text(tokens: DataFrame, new_el: DataFrame, key: str = "rec_id", new_texts: DataFrame | None = None,
             added: DataFrame | None = None) -> DataFrame:
    """Tokens + rewritten elements -> markup per record. Comments, PIs and doctype are dropped (as an
    XML tree round trip does); tag prefixes removed; attribute order kept.

    ``new_texts`` ``(key, pos, new_text)`` replaces text tokens; ``added`` ``(key, pos, ord, piece)`` is markup put in
    after the token at ``pos``, in the order of ``ord``. What tokens, elements and texts say of a place meets in one list
    a record, so that no join sorts the tokens."""
    kinds = F.when(F.col("kind") == "open", OPEN).when(F.col("kind") == "empty", EMPTY).when(F.col("kind") == "close", CLOSE).otherwise(TEXT)
    own = F.when(F.col("kind") == "close", F.concat(F.lit("</"), local_name(F.col("name")), F.lit(">"))).when(F.col("kind").isin("text", "cdata"), F.col("tok"))
    place = lambda pos, ord, kind, piece: F.struct((pos.cast("bigint") * (1 << 32) + ord * 16 + kind).alias("at"), piece.alias("piece"))
    no = F.lit(0)
    kind = F.col("_p.at").bitwiseAND(15)
    parts = tokens.where(F.col("kind").isin("open", "empty", "close", "text", "cdata")).select(key, place(F.col("pos"), no, kinds, own).alias("_p"))
    whole = F.col("close_pos").eqNullSafe(F.col("open_pos"))
    opening = place(F.col("open_pos"), no, F.when(whole, WHOLE).otherwise(OPENING), F.concat(F.lit("<"), F.col("new_tag"), attrs_text(F.col("new_attrs"))))
    closing = place(F.col("close_pos"), no, F.lit(CLOSING), F.concat(F.lit("</"), F.col("new_tag"), F.lit(">")))
    both = F.when(whole | F.col("close_pos").isNull(), F.array(opening)).otherwise(F.array(opening, closing))
    parts = parts.unionByName(new_el.select(key, F.explode(both).alias("_p")))
    if new_texts is not None:
        parts = parts.unionByName(new_texts.select(key, place(F.col("pos"), no, F.lit(INSTEAD), F.col("new_text")).alias("_p")))
    if added is not None:
        parts = parts.unionByName(added.select(key, place(F.col("pos"), F.col("ord"), F.lit(ADDED), F.col("piece")).alias("_p")))
    lists = parts.groupBy(key).agg(F.collect_list("_p").alias("_ps"), F.count_if((kind <= CLOSE) | (kind == ADDED)).alias("_n"))
    return lists.where("_n > 0").select(key, F.arrow_udf(_written, "string")("_ps").alias("svg_out"))
