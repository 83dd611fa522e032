"""Stage-2 clean-up rules that are row filters or column rewrites over the element table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from svgspark.functions.text import local_name, style_map
from svgspark.operators import tree as T
from svgspark.session import materialized

# CSS named colours (CSS Color Module Level 4), in alphabetical order.
NAMED_COLORS = {
    "aliceblue": "F0F8FF", "antiquewhite": "FAEBD7", "aqua": "00FFFF", "aquamarine": "7FFFD4", "azure": "F0FFFF",
    "beige": "F5F5DC", "bisque": "FFE4C4", "black": "000000", "blanchedalmond": "FFEBCD", "blue": "0000FF",
    "blueviolet": "8A2BE2", "brown": "A52A2A", "burlywood": "DEB887", "cadetblue": "5F9EA0", "chartreuse": "7FFF00",
    "chocolate": "D2691E", "coral": "FF7F50", "cornflowerblue": "6495ED", "cornsilk": "FFF8DC", "crimson": "DC143C",
    "cyan": "00FFFF", "darkblue": "00008B", "darkcyan": "008B8B", "darkgoldenrod": "B8860B", "darkgray": "A9A9A9",
    "darkgreen": "006400", "darkgrey": "A9A9A9", "darkkhaki": "BDB76B", "darkmagenta": "8B008B", "darkolivegreen": "556B2F",
    "darkorange": "FF8C00", "darkorchid": "9932CC", "darkred": "8B0000", "darksalmon": "E9967A", "darkseagreen": "8FBC8F",
    "darkslateblue": "483D8B", "darkslategray": "2F4F4F", "darkslategrey": "2F4F4F", "darkturquoise": "00CED1",
    "darkviolet": "9400D3", "deeppink": "FF1493", "deepskyblue": "00BFFF", "dimgray": "696969", "dimgrey": "696969",
    "dodgerblue": "1E90FF", "firebrick": "B22222", "floralwhite": "FFFAF0", "forestgreen": "228B22", "fuchsia": "FF00FF",
    "gainsboro": "DCDCDC", "ghostwhite": "F8F8FF", "gold": "FFD700", "goldenrod": "DAA520", "gray": "808080",
    "green": "008000", "greenyellow": "ADFF2F", "grey": "808080", "honeydew": "F0FFF0", "hotpink": "FF69B4",
    "indianred": "CD5C5C", "indigo": "4B0082", "ivory": "FFFFF0", "khaki": "F0E68C", "lavender": "E6E6FA",
    "lavenderblush": "FFF0F5", "lawngreen": "7CFC00", "lemonchiffon": "FFFACD", "lightblue": "ADD8E6", "lightcoral": "F08080",
    "lightcyan": "E0FFFF", "lightgoldenrodyellow": "FAFAD2", "lightgray": "D3D3D3", "lightgreen": "90EE90",
    "lightgrey": "D3D3D3", "lightpink": "FFB6C1", "lightsalmon": "FFA07A", "lightseagreen": "20B2AA",
    "lightskyblue": "87CEFA", "lightslategray": "778899", "lightslategrey": "778899", "lightsteelblue": "B0C4DE",
    "lightyellow": "FFFFE0", "lime": "00FF00", "limegreen": "32CD32", "linen": "FAF0E6", "magenta": "FF00FF",
    "maroon": "800000", "mediumaquamarine": "66CDAA", "mediumblue": "0000CD", "mediumorchid": "BA55D3",
    "mediumpurple": "9370DB", "mediumseagreen": "3CB371", "mediumslateblue": "7B68EE", "mediumspringgreen": "00FA9A",
    "mediumturquoise": "48D1CC", "mediumvioletred": "C71585", "midnightblue": "191970", "mintcream": "F5FFFA",
    "mistyrose": "FFE4E1", "moccasin": "FFE4B5", "navajowhite": "FFDEAD", "navy": "000080", "oldlace": "FDF5E6",
    "olive": "808000", "olivedrab": "6B8E23", "orange": "FFA500", "orangered": "FF4500", "orchid": "DA70D6",
    "palegoldenrod": "EEE8AA", "palegreen": "98FB98", "paleturquoise": "AFEEEE", "palevioletred": "DB7093",
    "papayawhip": "FFEFD5", "peachpuff": "FFDAB9", "peru": "CD853F", "pink": "FFC0CB", "plum": "DDA0DD",
    "powderblue": "B0E0E6", "purple": "800080", "rebeccapurple": "663399", "red": "FF0000", "rosybrown": "BC8F8F",
    "royalblue": "4169E1", "saddlebrown": "8B4513", "salmon": "FA8072", "sandybrown": "F4A460", "seagreen": "2E8B57",
    "seashell": "FFF5EE", "sienna": "A0522D", "silver": "C0C0C0", "skyblue": "87CEEB", "slateblue": "6A5ACD",
    "slategray": "708090", "slategrey": "708090", "snow": "FFFAFA", "springgreen": "00FF7F", "steelblue": "4682B4",
    "tan": "D2B48C", "teal": "008080", "thistle": "D8BFD8", "tomato": "FF6347", "turquoise": "40E0D0", "violet": "EE82EE",
    "wheat": "F5DEB3", "white": "FFFFFF", "whitesmoke": "F5F5F5", "yellow": "FFFF00", "yellowgreen": "9ACD32",
}
COLOR_ATTRS = ["fill", "stroke", "stop-color", "flood-color", "lighting-color", "color"]
DROP_ATTRS = ["version", "aria-hidden", "class"]
LIST_ATTRS = ["viewbox", "points", "stroke-dasharray", "enable-background"]
# attribute order of the sorted output: these first, then alphabetical
SORT_FIRST = ["id", "width", "height", "x", "x1", "x2", "y", "y1", "y2", "cx", "cy", "r", "fill", "stroke", "marker", "d", "points"]
EDITOR_PREFIXES = ["inkscape", "sodipodi", "sketch", "illustrator", "serif"]
NONRENDER_TAGS = ["metadata"]
CONTAINERS = ["g", "defs", "svg", "symbol", "a", "switch", "marker", "mask", "pattern", "clipPath", "clippath"]
TEXTS = ["text", "tspan", "textPath", "textpath"]
NUM_RE = r"^\s*([-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?)(px)?\s*$"


def color_map() -> F.Column:
    return F.create_map(*sum([[F.lit(k), F.lit("#" + v)] for k, v in NAMED_COLORS.items()], []))


def clean_value(v) -> F.Column:
    """Trim and collapse white space in an attribute value."""
    return F.regexp_replace(F.regexp_replace(v, r"^\s+|\s+$", ""), r"\s+", " ")


def short_num(x, decimals: int) -> F.Column:
    """Number text rounded to ``decimals`` through DECIMAL, trailing zeros cut, leading zero removed."""
    s = F.coalesce(F.round(x, decimals).try_cast(f"decimal(38,{max(decimals, 0)})").cast("string"), x.cast("string"))
    if decimals > 0:
        s = F.regexp_replace(F.regexp_replace(s, r"(\.\d*?)0+$", "$1"), r"\.$", "")
    s = F.when(s == "-0", F.lit("0")).otherwise(s)
    return F.regexp_replace(s, r"^(-?)0\.", "$1.")


def round_value(k, v) -> F.Column:
    """Single numbers (px dropped) to 1 decimal; number lists to integers; other values unchanged."""
    single = F.regexp_extract(v, NUM_RE, 1)
    lst = F.lower(k).isin(*LIST_ATTRS)
    nums = F.split(F.regexp_replace(v, r"^[\s,]+|[\s,]+$", ""), r"[\s,]+")
    all_num = F.forall(nums, lambda n: n.rlike(r"^[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?(px)?$"))
    as_list = F.array_join(F.transform(nums, lambda n: short_num(F.regexp_replace(n, "px$", "").try_cast("double"), 0)), " ")
    return (F.when(lst & all_num, as_list)
            .when(~lst & (single != ""), short_num(single.try_cast("double"), 1))
            .otherwise(v))


def color_value(v) -> F.Column:
    """Named colours and rgb() to upper-case 6-digit hex; hex upper-cased; never shortened."""
    lv = F.lower(F.trim(v))
    rgb = F.regexp_extract_all(lv, F.lit(r"(\d+(?:\.\d+)?%?)"), 1)
    chan = F.transform(rgb, lambda c: F.lpad(F.upper(F.hex(F.least(F.lit(255), F.greatest(F.lit(0), F.round(
        F.when(c.endswith("%"), F.regexp_replace(c, "%", "").try_cast("double") * 2.55).otherwise(c.try_cast("double")))).cast("int")))), 2, "0"))
    return (F.when(color_map()[lv].isNotNull(), color_map()[lv])
            .when(lv.rlike(r"^rgb\(\s*[\d.]+%?\s*,\s*[\d.]+%?\s*,\s*[\d.]+%?\s*\)$"), F.concat(F.lit("#"), F.array_join(chan, "")))
            .when(lv.rlike(r"^#([0-9a-f]{3}|[0-9a-f]{6})$"), F.upper(lv))
            .otherwise(v))


def clean_attrs(el: DataFrame, m: str = "attrs") -> DataFrame:
    return el.withColumn(m, F.transform_values(m, lambda k, v: clean_value(v)))


def round_numbers(el: DataFrame, m: str = "attrs") -> DataFrame:
    return el.withColumn(m, F.transform_values(m, lambda k, v: F.when(F.lower(k).isin("d", "transform", "style"), v)
                                               .otherwise(round_value(k, v))))


def normal_colors(el: DataFrame, m: str = "attrs") -> DataFrame:
    return el.withColumn(m, F.transform_values(m, lambda k, v: F.when(F.lower(k).isin(*COLOR_ATTRS), color_value(v)).otherwise(v)))


def style_to_attrs(el: DataFrame, m: str = "attrs") -> DataFrame:
    """Inline ``style`` declarations become attributes (they override same-named attributes)."""
    st = style_map(F.col(m).getItem("style"), whole=True)
    base = F.map_filter(m, lambda k, v: (k != "style") & ~F.coalesce(F.array_contains(F.map_keys(st), k), F.lit(False)))
    return el.withColumn(m, F.when(st.isNull(), F.col(m)).otherwise(F.map_concat(base, st)))


def drop_attrs(el: DataFrame, m: str = "attrs", keep_class: F.Column | None = None) -> DataFrame:
    """Drop version/xmlns/aria-hidden/class and the root width/height; ``xlink:href`` -> ``href``.

    ``keep_class``: where it is true the class stays, as for records with rules that ask for more than a class."""
    stays = F.lit(False) if keep_class is None else F.coalesce(keep_class, F.lit(False))
    kept = F.map_filter(m, lambda k, v: (~F.lower(k).isin(*DROP_ATTRS) | (stays & (F.lower(k) == "class"))) & ~F.lower(k).startswith("xmlns")
                        & ~((F.col("depth") == 0) & F.lower(k).isin("width", "height"))
                        & ~((F.lower(k) == "xlink:href") & F.array_contains(F.map_keys(m), "href"))
                        & ~F.exists(F.array(*[F.lit(p + ":") for p in EDITOR_PREFIXES]), lambda p: F.lower(k).startswith(p)))
    renamed = F.transform_keys(kept, lambda k, v: F.when(F.lower(k) == "xlink:href", F.lit("href")).otherwise(k))
    return el.withColumn(m, renamed)


def sort_attrs(el: DataFrame, m: str = "attrs") -> DataFrame:
    """Namespace declarations, names with a prefix, the attributes of ``SORT_FIRST`` by their place there (``fill-rule`` goes
    with ``fill``), then the rest; by name among equals."""
    order = F.array(*[F.lit(x) for x in SORT_FIRST])
    place = lambda k: F.array_position(order, F.split(F.lower(k), "-")[0])
    front = lambda k: F.when(F.lower(k) == "xmlns", -3).when(F.lower(k).startswith("xmlns:"), -2).when(k.contains(":"), -1)
    keyed = F.transform(F.map_entries(m), lambda e: F.struct(  # array_position is 0 where there is none
        F.coalesce(front(e["key"]), F.when(place(e["key"]) > 0, place(e["key"])), F.lit(1000)).alias("rank"), e["key"].alias("key"), e["value"].alias("value")))
    return el.withColumn(m, F.map_from_entries(F.transform(F.array_sort(keyed), lambda x: F.struct(x["key"], x["value"]))))


def drop_nonrender(tokens: DataFrame, key: str = "rec_id", drop_title: bool = True, drop_desc: bool = True,
                   drop_style: bool = False, drop_script: bool = False) -> DataFrame:
    """Tokens without doctype, PIs, comments and the subtrees of metadata/editor elements (and
    title/desc/style/script per flag). A token is inside a dropped subtree when the furthest close
    position of dropped elements opened so far reaches it (one running-max window)."""
    tags = list(NONRENDER_TAGS) + (["title"] if drop_title else []) + (["desc"] if drop_desc else []) \
        + (["style"] if drop_style else []) + (["script"] if drop_script else [])
    local = F.lower(local_name(F.col("name")))
    dropped = local.isin(*tags) | F.exists(F.array(*[F.lit(p + ":") for p in EDITOR_PREFIXES]), lambda p: F.lower("name").startswith(p))
    # a tag knows where its element ends, so no join brings the spans
    end = F.when(F.col("kind").isin("open", "empty") & dropped, F.coalesce("close_pos", "pos"))
    w = Window.partitionBy(key).orderBy("pos").rangeBetween(Window.unboundedPreceding, 0)
    t = tokens.withColumn("_span_end", end).withColumn("_reach", F.max("_span_end").over(w))
    return (t.where(~F.col("kind").isin("doctype", "pi", "comment") & (F.col("_reach").isNull() | (F.col("_reach") < F.col("pos"))))
            .drop("_reach", "_span_end"))


def drop_empty(el: DataFrame, key: str = "rec_id", css: DataFrame | None = None, texts: DataFrame | None = None) -> DataFrame:
    """Elements to drop: raster images, hidden elements, definitions that nothing drawn reaches, all that is inside these,
    text elements without text (``texts`` has the positions of the text tokens that are not blank), and containers in
    which nothing but containers is left (so an emptied outer group goes with its inner ones).

    What is inside a dropped element follows from the furthest end of those begun so far; what is left inside a
    container is the growth of a running count between its tags. Neither makes pairs of elements."""
    units = T.with_units(el, key)
    roots = units.where("unit = open_pos").join(T.live_units(units, css, key).hint("merge"), [key, "unit"], "left_anti")
    dead = roots.select(key, F.col("open_pos").alias("pos"), F.coalesce("close_pos", "open_pos").alias("_span_end"))
    # the next text that is not blank, seen from a text element's tag
    blank = el.where(F.col("tag").isin(*TEXTS)).select(key, F.col("open_pos").alias("pos"), F.coalesce("close_pos", "open_pos").alias("_span_end"))
    if texts is not None:
        later = Window.partitionBy(key).orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, 0)
        both = blank.withColumn("_t", F.lit(None).cast("int")).unionByName(texts.select(key, "pos", F.lit(None).cast("int").alias("_span_end"), F.col("pos").alias("_t")))
        both = both.withColumn("_next", F.min("_t").over(later))
        blank = both.where(F.col("_span_end").isNotNull() & (F.col("_next").isNull() | (F.col("_next") > F.col("_span_end")))).select(key, "pos", "_span_end")
    else:
        blank = blank.where("pos = _span_end")
    spans = hidden_spans(el, key).unionByName(dead).unionByName(blank).groupBy(key, "pos").agg(F.max("_span_end").alias("_span_end"))
    why = dead.select(key, F.col("pos").alias("open_pos"), F.lit("unused definition").alias("_why")).unionByName(
        blank.select(key, F.col("pos").alias("open_pos"), F.lit("empty text").alias("_why"))).groupBy(key, "open_pos").agg(F.max("_why").alias("_why"))
    t = _reached(el.join(why.hint("merge"), [key, "open_pos"], "left"), spans, key, "open_pos")
    inside = F.coalesce(F.col("_reach") >= F.col("open_pos"), F.lit(False))
    container = F.col("tag").isin(*CONTAINERS)
    reason = (F.when(F.col("tag") == "image", "raster image").when(_hidden(), "hidden").when(F.col("_why").isNotNull(), F.col("_why"))
              .when(inside, "inside a dropped element"))
    one = t.select(key, "open_pos", "tag", reason.alias("_r"), (container & (F.col("depth") > 0)).alias("_box"), (~inside & ~container).cast("int").alias("_own"),
                   F.when(container, F.array("open_pos", F.coalesce("close_pos", "open_pos"))).otherwise(F.array("open_pos")).alias("_ats"))
    # a row where an element opens and, for containers, one where it closes: one order of a record's places
    rows = one.select(key, "open_pos", "tag", "_r", "_box", "_own", F.posexplode("_ats").alias("_i", "_at"))
    count = F.sum(F.when(F.col("_i") == 0, F.col("_own")).otherwise(0)).over(Window.partitionBy(key).orderBy("_at").rangeBetween(Window.unboundedPreceding, 0))
    held = rows.withColumn("_c", count).where(F.col("_r").isNotNull() | F.col("_box")).groupBy(key, "open_pos", "tag", "_r", "_box").agg(
        (F.max("_c") - F.min("_c")).alias("_held"), F.count_if(F.col("_i") == 0).cast("int").alias("_m"))
    why_not = F.coalesce("_r", F.when(F.col("_box") & (F.col("_held") == 0), "empty container"))
    return held.withColumn("drop_reason", why_not).where(F.col("drop_reason").isNotNull()) \
        .select(key, "open_pos", "tag", "drop_reason", F.explode(F.array_repeat(F.lit(0), F.col("_m"))).alias("_")).drop("_")


def _hidden() -> F.Column:
    la = F.col("lattrs")
    return (F.lower(F.coalesce(la["display"], F.lit(""))) == "none") | (F.trim(F.coalesce(la["opacity"], F.lit("1"))) == "0") \
        | (F.lower(F.coalesce(la["visibility"], F.lit(""))) == "hidden")


def hidden_spans(el: DataFrame, key: str = "rec_id") -> DataFrame:
    """``(rec_id, pos, _span_end)`` of hidden elements and raster images."""
    return el.where((F.col("tag") == "image") | _hidden()).select(key, F.col("open_pos").alias("pos"), F.coalesce("close_pos", "open_pos").alias("_span_end"))


def _reached(rows: DataFrame, spans: DataFrame, key: str, pos: str) -> DataFrame:
    """Adds ``_reach``: the furthest end of the spans that begin at or before the row."""
    t = rows.join(spans.withColumnRenamed("pos", pos).hint("merge"), [key, pos], "left")
    w = Window.partitionBy(key).orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    return t.withColumn("_reach", F.max("_span_end").over(w)).drop("_span_end")


def apply_class_rules(el: DataFrame, tokens: DataFrame, key: str = "rec_id") -> DataFrame:
    """Properties of ``.class`` rules become attributes, over those of the same name; inline styles come later."""
    props = T.class_rules(el, T.style_rules(tokens, key), key).groupBy(key, "open_pos") \
        .agg(F.map_from_entries(F.collect_list(F.struct("prop", "value"))).alias("_props"))
    own = F.map_filter("attrs", lambda k, v: ~F.array_contains(F.map_keys("_props"), k))
    return el.join(props.hint("merge"), [key, "open_pos"], "left") \
        .withColumn("attrs", F.when(F.col("_props").isNull(), F.col("attrs")).otherwise(F.map_concat(own, "_props"))).drop("_props")


def reuse_paths(el: DataFrame, key: str = "rec_id") -> DataFrame:
    """Paths repeated identically inside one document (same d and fill/stroke): candidates for <use>."""
    la = F.col("lattrs")
    p = el.where(F.col("tag") == "path").select(key, la["d"].alias("d"), F.coalesce(la["fill"], F.lit("")).alias("fill"),
                                                F.coalesce(la["stroke"], F.lit("")).alias("stroke"))
    return p.groupBy(key, "d", "fill", "stroke").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def shared_paths(el: DataFrame, key: str = "rec_id") -> tuple[DataFrame, DataFrame]:
    """(elements in which drawn paths of the same data are ``<use>``, the ``<defs>`` to put in after the root's tag).

    The shared path holds the data alone; every use has its link as ``xlink:href`` and keeps the other attributes, which the path inherits. Paths with an id,
    a length of their own, content, or inside a definition stay as they are, and so do those whose new id is taken.
    """
    units = T.with_units(el, key)
    la = F.col("lattrs")
    free = units.where((F.col("tag") == "path") & F.col("unit").isNull() & la["d"].isNotNull() & ~F.map_contains_key("lattrs", F.lit("id"))
                       & ~F.map_contains_key("lattrs", F.lit("pathlength")) & (F.col("close_pos") - F.col("open_pos") <= 1))
    free = free.select(key, "open_pos", la["d"].alias("_d"), F.concat(F.lit("reuse-"), F.substring(F.md5(la["d"]), 1, 12)).alias("_id"))
    groups = free.groupBy(key, "_id").agg(F.count("*").alias("_n"), F.min("_d").alias("_d"), F.countDistinct("_d").alias("_forms"), F.min("open_pos").alias("_first"))
    taken = el.where(F.map_contains_key("lattrs", F.lit("id"))).select(key, la["id"].alias("_id"))
    groups = groups.where("_n > 1 AND _forms = 1").join(taken.hint("merge"), [key, "_id"], "left_anti")
    uses = free.select(key, "open_pos", "_id").join(groups.select(key, "_id").hint("merge"), [key, "_id"])
    out = el.join(uses.hint("merge"), [key, "open_pos"], "left")
    plain = F.map_filter("attrs", lambda k, v: ~F.lower(k).isin("d", "x", "y", "width", "height"))
    out = out.withColumn("attrs", F.when(F.col("_id").isNull(), F.col("attrs")).otherwise(F.map_concat(F.create_map(F.lit("xlink:href"), F.concat(F.lit("#"), "_id")), plain)))
    out = out.withColumn("tag", F.when(F.col("_id").isNull(), F.col("tag")).otherwise(F.lit("use"))).drop("_id")
    shape = F.concat(F.lit('<path id="'), "_id", F.lit('" d="'), T.escape_xml(F.col("_d")), F.lit('"/>'))
    defs = groups.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_first", shape.alias("shape")))), lambda x: x["shape"]), "").alias("shapes"))
    root = el.where("depth = 0").select(key, F.col("open_pos").alias("pos"))
    return out, defs.join(root.hint("merge"), key).select(key, "pos", F.lit(1).alias("ord"), F.concat(F.lit("<defs>"), "shapes", F.lit("</defs>")).alias("piece"))


def clean_corpus(stage1: DataFrame, key: str = "rec_id", cleanup_ids: bool = True, share_paths: bool = True, partitions: int = 0) -> DataFrame:
    """Stage 2 over stage-1 text: non-render drop, attribute rules, empty and unused drop, ids that nothing refers to,
    repeated paths as uses, then markup again. ``svg`` falls back to the stage-1 text when stage 2 yields nothing;
    ``reason`` says why a text was refused. ``partitions``: see ``tree.by_record``."""
    from svgspark.operators.normalize import svg_text

    # written once: else what made or chose the texts from their key is taken through the joins and done for every token
    stage1 = materialized(stage1.select(key, "svg"), "stage2_input")
    lists = materialized(T.token_lists(T.by_record(stage1, key, partitions), key, partitions=partitions), "stage2_lists")
    lists = T.by_record(lists, key, partitions)
    checks = materialized(T.wellformed(T.exploded(lists, key), key), "stage2_checks")
    toks = T.exploded(lists.join(checks.where("ok").select(key).hint("merge"), key, "left_semi"), key)
    # tokens and elements are read by many of the rules below: written once, so that no rule computes them anew
    written = lambda df, name: T.by_record(materialized(df, name), key, partitions)
    kept = written(drop_nonrender(toks, key), "stage2_tokens")
    el = written(T.definition_units(T.lower_attrs(T.svg_elements(kept, key)), key), "stage2_elements")
    css = T.style_texts(kept, key).select(key, "css")
    texts = kept.where(F.col("kind").isin("text", "cdata") & (F.trim(F.regexp_replace("tok", r"\s+", " ")) != "")).select(key, "pos")
    gone = written(drop_empty(el, key, css, texts).select(key, "open_pos"), "stage2_gone")
    # whatever stands inside a dropped element goes with it; an emptied container has nothing left in it
    spans = el.join(gone.hint("merge"), [key, "open_pos"], "left_semi").select(key, F.col("open_pos").alias("pos"), F.coalesce("close_pos", "open_pos").alias("_span_end"))
    rest = _reached(kept, spans, key, "pos").where("_reach IS NULL OR _reach < pos").drop("_reach")
    el = el.join(gone.hint("merge"), [key, "open_pos"], "left_anti")
    # an element without attributes has nothing that the rules below could change; the root is asked for below
    bare = (F.size("attrs") == 0) & (F.col("depth") > 0)
    same = el.where(bare).select(key, "open_pos", "close_pos", F.col("tag").alias("new_tag"), F.col("attrs").alias("new_attrs"))
    el = written(el.where(~bare), "stage2_left")
    if cleanup_ids:
        unused = T.unreferenced_ids(el, key, css).select(key, "open_pos", F.lit(True).alias("_bare"))
        for m in ("attrs", "lattrs"):
            el = el.withColumn(f"_no_{m}", F.map_filter(m, lambda k, v: F.lower(k) != "id"))
        el = el.join(unused.hint("merge"), [key, "open_pos"], "left").withColumns({m: F.when(F.col("_bare"), F.col(f"_no_{m}")).otherwise(F.col(m)) for m in ("attrs", "lattrs")}) \
            .drop("_bare", "_no_attrs", "_no_lattrs")
    el = apply_class_rules(el, kept, key).join(T.complex_class_rules(kept, key).withColumn("_more", F.lit(True)).hint("merge"), key, "left")
    for rule in (clean_attrs, style_to_attrs, round_numbers, normal_colors):
        el = rule(el)
    el = materialized(drop_attrs(el, keep_class=F.col("_more")), "stage2_cleaned")
    added = None
    if share_paths:
        el, added = shared_paths(el, key)
    el = sort_attrs(el)  # the link of a use is sorted under its prefix, which goes after
    el = el.withColumn("attrs", F.transform_keys("attrs", lambda k, v: F.when(F.lower(k) == "xlink:href", F.lit("href")).otherwise(k)))
    new_el = el.select(key, "open_pos", "close_pos", F.col("tag").alias("new_tag"), F.col("attrs").alias("new_attrs"))
    text = svg_text(rest, new_el.unionByName(same), key, added=added)
    base = stage1.select(key, F.col("svg").alias("stage1"))
    refused = checks.where(~F.col("ok")).select(key, "reason")
    return (base.join(text.hint("merge"), key, "left").join(refused.hint("merge"), key, "left")
            .select(key, F.col("svg_out").alias("stage2"), F.coalesce("svg_out", "stage1").alias("svg"), "reason"))
