"""SVG markup as tables: tokens -> elements -> ancestors, plus structural checks and style rules.

The corpus is hash-partitioned by ``rec_id`` once (``by_record``); tokens are exploded from that
partitioning and every window below is partitioned by ``rec_id`` (plus a finer key), so the plan
keeps a single exchange. Records of any length are read whole.

Joins of exploded rows carry the ``merge`` hint: the planner sizes them like the texts' source, so it would send
millions of tokens through the driver as a broadcast.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from svgspark.functions.text import local_name, numeric_text, strip_ws, style_map

# Markup token pattern (comment, CDATA, PI, doctype, quote-safe tag, text run).
QTAG = r"""(?:[^>"']|"[^"]*"|'[^']*')*>"""
TOKEN_RE = r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>|<\?.*?\?>|<!" + QTAG + "|<" + QTAG + "|[^<]+"
ATTR_RE = r"""([^\s=/<>"']+)\s*=\s*("[^"]*"|'[^']*')"""
# The same patterns for Java's engine: possessive runs neither recurse nor backtrack, and names start where a run
# starts, so a tag of a million characters takes linear time and no stack.
QTAG_RUNS = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
TOKEN_RUNS = r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>|<\?.*?\?>|<!" + QTAG_RUNS + "|<" + QTAG_RUNS + "|[^<]++"
ATTR_RUNS = r"""(?<![^\s=/<>"'])([^\s=/<>"']++)\s*+=\s*+("[^"]*+"|'[^']*+')"""
NAME_RE = r"^</?([^\s/>]+)"


def by_record(df: DataFrame, key: str = "rec_id", partitions: int = 0) -> DataFrame:
    """The one shuffle of the tree jobs: co-locate each record's rows. The number of partitions is fixed, since the texts
    grow manyfold when they are exploded: the session's, or ``partitions`` where that is more."""
    return df.repartition(max(partitions, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))), key)


def token_kind(tok) -> F.Column:
    return (F.when(tok.startswith("<!--"), "comment")
            .when(tok.startswith("<![CDATA["), "cdata")
            .when(tok.startswith("<?"), "pi")
            .when(tok.startswith("<!"), "doctype")
            .when(tok.startswith("</"), "close")
            .when(tok.startswith("<") & tok.endswith("/>"), "empty")
            .when(tok.startswith("<"), "open")
            .otherwise("text"))


TAG_NAME = r"^<(?P<name>[^ \t\n\x0B\f\r/>]+)"  # as NAME_RE, for RE2
#: What ``_nested`` says of each token, as lists beside the tokens.
NESTING = "struct<pos:array<int>,depth:array<int>,close_pos:array<int>,close_tok:array<string>,parent:array<string>>"


def _nested(texts: pa.Array) -> pa.Array:
    """The place, depth and closing tag of the tokens of each record, by array operations over a batch of records.

    A record is a list of texts, each a list of tokens; the texts of one key are read token by token beside each other.
    The closing tag of an opening one is the next tag of its depth: the level can return there by a closing tag only, so
    opening and closing tags are put in order by depth and no others."""
    inner = texts.flatten()
    tokens = inner.flatten()
    n = len(tokens)
    lengths = inner.value_lengths().to_numpy(zero_copy_only=False)
    per_text = texts.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    text_rec = np.repeat(np.arange(len(texts)), per_text)
    rec = np.repeat(text_rec, lengths)
    starts = np.cumsum(lengths) - lengths
    pos = np.arange(n) - np.repeat(starts, lengths)
    _, offsets, data = tokens.buffers()
    width = np.int64 if pa.types.is_large_string(tokens.type) else np.int32
    offsets = np.frombuffer(offsets, width)[tokens.offset:tokens.offset + n + 1].astype(np.int64) if n else np.zeros(1, np.int64)
    chars = np.frombuffer(data, np.uint8) if n else np.zeros(0, np.uint8)
    first, last = offsets[:-1], offsets[1:]
    at = lambda i: chars[np.minimum(i, len(chars) - 1)]
    second = at(first + 1)
    tag = (at(first) == ord("<")) & (second != ord("!")) & (second != ord("?"))
    closes = tag & (second == ord("/"))
    opens = tag & ~closes & ~((at(last - 1) == ord(">")) & (at(last - 2) == ord("/")))
    beside = None if per_text.max(initial=0) <= 1 else np.lexsort((pos, rec))
    if beside is not None:
        rec, opens, closes = rec[beside], opens[beside], closes[beside]
    delta = opens.astype(np.int32) - closes
    level = np.cumsum(delta)
    sizes = np.bincount(rec, minlength=len(texts)) if n else np.zeros(len(texts), np.int64)
    ends = np.cumsum(sizes)
    before = np.where(ends - sizes > 0, level[np.maximum(ends - sizes - 1, 0)], 0) if n else ends
    depth = level - opens - before[rec]
    pair = np.flatnonzero(opens | closes)
    pair = pair[np.lexsort((depth[pair], rec[pair]))]
    this, after = pair[:-1], pair[1:]
    met = opens[this] & (rec[this] == rec[after]) & (depth[this] == depth[after])
    mate = np.full(n, -1)
    mate[this[met]] = after[met]
    # the enclosing element of a token: the last one opened before it a level higher
    top, low = (depth.max() + 2, depth.min() - 1) if n else (1, 0)
    row = rec * (top - low)
    begun = np.flatnonzero(opens)
    begun = begun[np.lexsort((depth[begun], rec[begun]))]
    last = np.searchsorted((row[begun] + depth[begun] - low) * n + begun, (row + depth - 1 - low) * n + np.arange(n)) - 1
    inside = last >= 0
    if len(begun):
        inside &= (rec[begun[last]] == rec) & (depth[begun[last]] == depth - 1)
    parent = np.where(inside, begun[last] if len(begun) else -1, -1)
    if beside is not None:
        back = np.empty(n, np.int64)
        back[beside] = np.arange(n)
        depth, mate, parent = depth[back], mate[back], parent[back]
        mate, parent = np.where(mate < 0, -1, beside[mate]), np.where(parent < 0, -1, beside[parent])
    none = mate < 0
    # the names of opening tags, taken by the tokens inside
    held = np.unique(parent[parent >= 0])
    names = pc.struct_field(pc.extract_regex(tokens.take(pa.array(held)), TAG_NAME), 0)
    place = np.searchsorted(held, parent)
    parents = names.take(pa.array(place, pa.int64(), mask=parent < 0))
    lists = pa.array(np.concatenate([[0], np.cumsum(np.bincount(text_rec, weights=lengths, minlength=len(texts)))]).astype(np.int32))
    in_records = lambda values: pa.ListArray.from_arrays(lists, values)
    mates = pa.array(mate, pa.int64(), mask=none)
    return pa.StructArray.from_arrays(
        [in_records(pa.array(pos, pa.int32())), in_records(pa.array(depth, pa.int32())),
         in_records(pa.array(pos[mate] if n else pos, pa.int32(), mask=none)), in_records(tokens.take(mates)), in_records(parents)],
        ["pos", "depth", "close_pos", "close_tok", "parent"])


def token_lists(docs: DataFrame, key: str = "rec_id", svg: str = "svg", partitions: int = 0) -> DataFrame:
    """One row per record: its tokens and, beside them, their places (``NESTING``), as ``(rec_id, _toks, _in)``.

    Records of one key are read as one. The lists are dealt to tasks by their key (``partitions``: see ``by_record``) once they
    are made, so that the branches of a plan that explode them read one exchange and shuffle no tokens."""
    texts = docs.groupBy(key).agg(F.collect_list(svg).alias("_texts"))
    lists = texts.select(key, F.transform("_texts", lambda s: F.regexp_extract_all(s, F.lit(TOKEN_RUNS), 0)).alias("_toks"))
    lists = lists.select(key, F.flatten("_toks").alias("_toks"), F.arrow_udf(_nested, NESTING)("_toks").alias("_in"))
    return by_record(lists, key, partitions)


def exploded(lists: DataFrame, key: str = "rec_id", carry: tuple[str, ...] = ()) -> DataFrame:
    """The rows of ``svg_tokens`` from ``token_lists``; ``carry`` names columns of the record that each row has too."""
    t = lists.select(key, *carry, F.inline(F.arrays_zip(F.col("_toks").alias("tok"), F.col("_in.pos").alias("pos"), F.col("_in.depth").alias("depth"),
                                                        F.col("_in.close_pos").alias("close_pos"), F.col("_in.close_tok").alias("close_tok"),
                                                        F.col("_in.parent").alias("parent"))))
    t = t.withColumn("kind", token_kind(F.col("tok")))
    name = F.when(F.col("kind").isin("open", "close", "empty"), F.regexp_extract("tok", NAME_RE, 1))
    return t.select(key, "pos", "tok", "kind", name.alias("name"), "depth", "close_pos", "close_tok", "parent", *carry)


def svg_tokens(docs: DataFrame, key: str = "rec_id", svg: str = "svg", partitions: int = 0) -> DataFrame:
    """One row per markup token: ``(rec_id, pos, tok, kind, name, depth, close_pos, close_tok, parent)``.

    ``depth`` is the nesting level of an element (root = 0) for open/close/empty tags and the level
    inside which a text/comment token sits for the others. ``close_pos`` and ``close_tok`` are the matching
    close token of an opening tag, if it has one, and ``parent`` is the name of the element around. All of it is told from a record's tokens as one list, so that
    no window sorts the rows."""
    return exploded(token_lists(docs, key, svg, partitions), key)


def unescape_xml(c) -> F.Column:
    for ent, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
        c = F.replace(c, F.lit(ent), F.lit(ch))
    return c


def escape_xml(c) -> F.Column:
    c = F.regexp_replace(c, r"&(?!#[0-9]+;|#x[0-9A-Fa-f]+;)", "&amp;")  # numeric references stay as they are
    for ch, ent in (("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(ch), F.lit(ent))
    return c


def first_wins(names: str, values: str) -> F.Column:
    """Map of two array columns in which the first of repeated names counts. Only tags that repeat a name search it."""
    once = F.array_distinct(names)
    first = F.transform(once, lambda n: F.get(F.col(values), F.array_position(F.col(names), n).cast("int") - 1))
    return F.when(F.size(once) == F.size(names), F.map_from_arrays(names, values)).otherwise(F.map_from_arrays(once, first))


def with_attrs(tags: DataFrame, tok: str = "tok") -> DataFrame:
    """Adds ``attrs``, the attributes of a tag token as MAP (values unquoted and unescaped; first occurrence wins)."""
    quoted = F.regexp_extract_all(tok, F.lit(ATTR_RUNS), 2)
    tags = tags.withColumns({"_names": F.regexp_extract_all(tok, F.lit(ATTR_RUNS), 1),
                             "_values": F.transform(quoted, lambda v: unescape_xml(F.substring(v, 2, F.length(v) - 2)))})
    return tags.withColumn("attrs", first_wins("_names", "_values")).drop("_names", "_values")


def svg_elements(tokens: DataFrame, key: str = "rec_id", carry: tuple[str, ...] = ()) -> DataFrame:
    """Elements: ``(rec_id, open_pos, close_pos, depth, tag, attrs, parent)``; ``close_pos`` is the matching
    close token (the next tag token at the same depth) or ``open_pos`` for empty elements. ``carry``: see ``exploded``."""
    el = with_attrs(tokens.where(F.col("kind").isin("open", "empty")))
    close = F.when(F.col("kind") == "empty", F.col("pos")).otherwise(F.col("close_pos"))
    return el.select(key, F.col("pos").alias("open_pos"), close.alias("close_pos"), "depth",
                     F.col("name").alias("qname"), local_name(F.col("name")).alias("tag"),
                     "attrs", "parent", *carry)


def ancestor_join(elements: DataFrame, key: str = "rec_id", carry: str | None = None, only_parent: bool = False) -> DataFrame:
    """Every (element, ancestor) pair: ``(rec_id, open_pos, anc_depth, anc_pos[, anc_<carry>])``.

    The ancestor of an element at depth k is the latest element opened at depth k before it. Each
    element contributes one anchor row (its own depth) and one query row per ancestor level; one
    window per (rec_id, level) carries the latest anchor forward. Output size is the sum of depths,
    never the pairs of a record.
    """
    carried = F.col(carry) if carry else F.lit(None).cast("string")
    anchor = F.struct(F.col("depth").alias("k"), F.lit(True).alias("is_anchor"), carried.alias("val"))
    levels = (F.when(F.col("depth") > 0, F.array(F.col("depth") - 1)) if only_parent else
              F.when(F.col("depth") > 0, F.sequence(F.lit(0), F.col("depth") - 1)))
    queries = F.transform(F.coalesce(levels, F.array().cast("array<int>")),
                          lambda k: F.struct(k.alias("k"), F.lit(False).alias("is_anchor"), F.lit(None).alias("val")))
    rows = elements.select(key, "open_pos", F.explode(F.concat(F.array(anchor), queries)).alias("r"))
    rows = rows.select(key, "open_pos", "r.k", "r.is_anchor", "r.val")
    w = Window.partitionBy(key, "k").orderBy("open_pos").rowsBetween(Window.unboundedPreceding, -1)
    last_anchor = F.last(F.when(F.col("is_anchor"), F.struct(F.col("open_pos").alias("p"), F.col("val").alias("v"))),
                         ignorenulls=True).over(w)
    out = (rows.withColumn("_a", last_anchor).where(~F.col("is_anchor"))
           .select(key, "open_pos", F.col("k").alias("anc_depth"), F.col("_a.p").alias("anc_pos"),
                   *([F.col("_a.v").alias(f"anc_{carry}")] if carry else [])))
    return out


def with_parent(elements: DataFrame, key: str = "rec_id") -> DataFrame:
    par = ancestor_join(elements, key, only_parent=True).select(key, "open_pos", F.col("anc_pos").alias("parent_pos"))
    return elements.join(par.hint("merge"), [key, "open_pos"], "left")


# A whole tag: a name, then attributes with quoted values that hold no "<". Possessive, so that it takes linear time.
TAG_RUNS = r"""(?s)^<(?:/[^\s/>"'=<]++\s*+|[^\s/>"'=<!?]++(?:\s++[^\s=/<>"']++\s*+=\s*+(?:"[^"<]*+"|'[^'<]*+'))*+\s*+/?+)>$"""
# An ampersand that begins no predefined or numeric reference.
LOOSE_AMP = r"&(?!(?:amp|lt|gt|quot|apos|#[0-9]++|#x[0-9A-Fa-f]++);)"
CONTROL = r"[\x00-\x08\x0B\x0C\x0E-\x1F]"


def unbound_prefixes(tokens: DataFrame, key: str = "rec_id") -> DataFrame:
    """Records with a name whose prefix no open element declares.

    A declaration holds from its tag to the closing tag of its element. Of the declarations of a prefix that begin at or
    before a use, the one that ends last must end behind it: one running maximum by record and prefix.
    """
    names = F.when(F.col("tok").contains(":"), F.filter(
        F.array_append(F.regexp_extract_all("tok", F.lit(ATTR_RUNS), 1), F.col("name")), lambda n: n.contains(":")))
    # an empty element ends where it begins
    end = F.when(F.col("kind") == "empty", F.col("pos")).otherwise(F.col("close_pos"))
    tags = tokens.where(F.col("kind").isin("open", "empty")).select(key, "pos", end.alias("end"), names.alias("names")).where("names IS NOT NULL")
    uses = tags.select(key, "pos", "end", F.explode("names").alias("n")).withColumn("use", ~F.col("n").startswith("xmlns:"))
    prefix = F.when(F.col("use"), F.substring_index("n", ":", 1)).otherwise(F.substring_index("n", ":", -1))
    spans = uses.select(key, "pos", prefix.alias("prefix"), "use", F.when(~F.col("use"), F.col("end")).alias("end")).where(~F.col("prefix").isin("xml", "xmlns"))
    sofar = Window.partitionBy(key, "prefix").orderBy("pos").rangeBetween(Window.unboundedPreceding, 0)
    held = spans.withColumn("reach", F.max("end").over(sofar))
    return held.where(F.col("use") & (F.col("reach").isNull() | (F.col("reach") < F.col("pos")))).select(key).distinct()


def wellformed(tokens: DataFrame, key: str = "rec_id") -> DataFrame:
    """Per record: ``ok`` and the first ``reason`` (NULL when well formed): structure first, then what stands in a tag or a
    text, then prefixes without a declaration, as an XML parser would refuse them."""
    is_tag = F.col("kind").isin("open", "close", "empty")
    level = F.when(F.col("kind") == "open", F.col("depth") + 1).otherwise(F.col("depth"))
    opens = F.col("kind").isin("open", "empty")
    names = F.regexp_extract_all("tok", F.lit(ATTR_RUNS), 1)
    texts = F.col("kind") == "text"
    per = tokens.groupBy(key).agg(
        F.min(F.when(is_tag, F.col("depth"))).alias("min_depth"),
        F.max_by(level, F.when(is_tag, F.col("pos").cast("bigint") * 4294967296 + level)).alias("end_level"),  # of tags at one place the innermost
        F.count_if((F.col("kind") == "open") & F.col("close_pos").isNull()).alias("unclosed"),
        F.count_if((F.col("kind") == "open") & (F.regexp_extract("close_tok", NAME_RE, 1) != F.col("name"))).alias("mismatch"),
        F.count_if(opens & (F.col("depth") == 0)).alias("roots"),
        F.count_if(texts & (F.col("depth") == 0) & F.col("tok").rlike(r"\S")).alias("outside"),
        F.count_if(is_tag & ~F.col("tok").rlike(TAG_RUNS)).alias("torn"),
        F.count_if(opens & (F.size(names) != F.size(F.array_distinct(names)))).alias("repeated"),
        F.count_if((opens | texts) & F.col("tok").rlike(LOOSE_AMP)).alias("entities"),
        F.count_if((F.col("kind") == "doctype") & F.col("tok").contains("<!ENTITY")).alias("declared"),
        F.count_if(((F.col("kind") == "comment") & F.col("tok").rlike("(?s)^<!--.*--.*-->$")) | (texts & F.col("tok").contains("]]>"))).alias("marks"),
        F.count_if(F.col("tok").rlike(CONTROL)).alias("control"),
        F.count_if((F.col("kind") == "pi") & (F.col("pos") > 0) & F.col("tok").rlike(r"^<\?xml\s")).alias("late"),
    )
    reason = (F.when(F.col("min_depth") < 0, "unexpected close tag")
              .when(F.col("mismatch") > 0, "mismatched tag")
              .when((F.col("unclosed") > 0) | (F.col("end_level") != 0), "unclosed tag")
              .when(F.col("roots") == 0, "no element")
              .when(F.col("roots") > 1, "junk after document element")
              .when(F.col("outside") > 0, "text outside the document element")
              .when(F.col("torn") > 0, "malformed tag")
              .when(F.col("repeated") > 0, "duplicate attribute")
              .when((F.col("entities") > 0) & (F.col("declared") == 0), "undefined entity")
              .when(F.col("marks") > 0, "malformed comment or text")
              .when(F.col("control") > 0, "invalid character")
              .when(F.col("late") > 0, "XML declaration not at the start"))
    unbound = unbound_prefixes(tokens, key).withColumn("_unbound", F.lit("unbound prefix"))
    per = per.withColumn("reason", reason).join(unbound.hint("merge"), key, "left").withColumn("reason", F.coalesce("reason", "_unbound"))
    return per.select(key, F.col("reason").isNull().alias("ok"), "reason")


def lower_attrs(elements: DataFrame) -> DataFrame:
    """Adds ``lattrs``: attribute names lower-cased (values unchanged; first spelling wins on clashes)."""
    named = elements.withColumns({"_names": F.transform(F.map_keys("attrs"), F.lower), "_values": F.map_values("attrs")})
    return named.withColumn("lattrs", first_wins("_names", "_values")).drop("_names", "_values")


def attr(name: str, m: str = "lattrs") -> F.Column:
    return F.col(m).getItem(name)


def canvas_box(roots: DataFrame, m: str = "lattrs") -> DataFrame:
    """Canvas of each root: viewBox (split on commas and spaces) else width/height else 1.0.

    Adds ``vb_x, vb_y, vb_w, vb_h`` (the box), ``canvas_w, canvas_h`` and ``canvas_from``.
    """
    vb = F.split(F.regexp_replace(attr("viewbox", m), r"^[\s,]+|[\s,]+$", ""), r"[\s,]+")
    has_vb = attr("viewbox", m).isNotNull()
    wv, hv = numeric_text(attr("width", m)), numeric_text(attr("height", m))
    out = roots.select(
        "*",
        F.when(has_vb, numeric_text(F.get(vb, 0))).otherwise(F.lit(0.0)).alias("vb_x"),
        F.when(has_vb, numeric_text(F.get(vb, 1))).otherwise(F.lit(0.0)).alias("vb_y"),
        F.when(has_vb, numeric_text(F.get(vb, 2))).otherwise(F.coalesce(wv, F.lit(0.0))).alias("vb_w"),
        F.when(has_vb, numeric_text(F.get(vb, 3))).otherwise(F.coalesce(hv, F.lit(0.0))).alias("vb_h"),
        F.when(has_vb, numeric_text(F.get(vb, 2))).otherwise(F.coalesce(wv, F.lit(1.0))).alias("canvas_w"),
        F.when(has_vb, numeric_text(F.get(vb, 3))).otherwise(F.coalesce(hv, F.lit(1.0))).alias("canvas_h"),
        F.when(has_vb, "viewbox").when(attr("width", m).isNotNull() | attr("height", m).isNotNull(), "size")
        .otherwise("default").alias("canvas_from"),
    )
    return out


def canvas_scale(boxes: DataFrame, normalize_scale: float = 256.0, to_int: bool = False) -> DataFrame:
    """``s = normalize_scale / max(canvas_w, canvas_h)``; the box scaled by s (truncated when to_int)."""
    s = F.lit(float(normalize_scale)) / F.greatest("canvas_w", "canvas_h")
    out = boxes.withColumn("s", F.when(F.greatest("canvas_w", "canvas_h") > 0, s))
    for c in ("vb_x", "vb_y", "vb_w", "vb_h"):
        v = F.col(c) * F.col("s")
        out = out.withColumn(f"{c}_s", v.cast("long").cast("double") if to_int else v)
    return out


# Fixed value: CSS rule pattern (selector list, declaration block).
CSS_RULE_RE = r"(?<![^{}])([^{}]++)\{([^}]*+)\}"


def style_texts(tokens: DataFrame, key: str) -> DataFrame:
    """``(rec_id, pos, kind, css)``: the text and CDATA tokens inside ``<style>``, comments and CDATA marks removed."""
    # what stands in a <style> is told by its parent, so that only these rows are sorted
    style = F.lower("name") == "style"
    w = Window.partitionBy(key).orderBy("pos")
    t = tokens.where((F.lower("parent") == "style") | ((F.col("kind") == "open") & style)).select(key, "pos", "tok", "kind", "name")
    t = t.withColumn("_prev_name", F.lag("name").over(w)).withColumn("_prev_kind", F.lag("kind").over(w))
    css = t.where((F.col("kind").isin("text", "cdata")) & (F.lower("_prev_name") == "style") & (F.col("_prev_kind") == "open"))
    return css.select(key, "pos", "kind", F.regexp_replace(F.regexp_replace("tok", r"^<!\[CDATA\[|\]\]>$", ""), r"(?s)/\*.*?\*/", "").alias("css"))


def _class_bodies(css: DataFrame, key: str) -> DataFrame:
    """``(rec_id, pos, ri, si, cls, body)``: a row per plain class selector of each rule, in order."""
    rules = css.select(key, "pos", F.posexplode(F.regexp_extract_all("css", F.lit(CSS_RULE_RE), 0)).alias("ri", "rule"))
    rules = rules.select(key, "pos", "ri", F.regexp_extract("rule", CSS_RULE_RE, 1).alias("sel"), F.regexp_extract("rule", CSS_RULE_RE, 2).alias("body"))
    sels = rules.select(key, "pos", "ri", F.posexplode(F.split("sel", ",")).alias("si", "selector"), "body")
    sels = sels.withColumn("selector", F.regexp_replace("selector", r"^\s+|\s+$", ""))
    plain = sels.where(F.col("selector").rlike(r"^\.[A-Za-z_-][A-Za-z0-9_-]*$"))
    return plain.select(key, "pos", "ri", "si", F.expr("substr(selector, 2)").alias("cls"), "body")


def complex_class_rules(tokens: DataFrame, key: str = "rec_id") -> DataFrame:
    """Records with a selector that names a class and is more than one plain class (``rect.a``, ``.a .b``)."""
    css = style_texts(tokens, key)
    sels = css.select(key, F.explode(F.split(F.array_join(F.regexp_extract_all("css", F.lit(CSS_RULE_RE), 1), ","), ",")).alias("selector"))
    sels = sels.withColumn("selector", F.regexp_replace("selector", r"^\s+|\s+$", ""))
    return sels.where(F.col("selector").contains(".") & ~F.col("selector").rlike(r"^\.[A-Za-z_-][A-Za-z0-9_-]*$")).select(key).distinct()


def style_rules(tokens: DataFrame, key: str = "rec_id") -> DataFrame:
    """``<style>`` text -> one row per ``.class`` selector: ``(rec_id, selector, props MAP)``.

    Selector lists are split; non-class selectors are dropped; rules for the same class merge,
    later declarations winning.
    """
    cls = _class_bodies(style_texts(tokens, key), key)
    per = (cls.select(key, "cls", "pos", "ri", F.explode(style_map("body")).alias("prop", "value"))
           .groupBy(key, "cls", "prop").agg(F.max_by("value", F.struct("pos", "ri")).alias("value")))
    return per.groupBy(key, "cls").agg(F.map_from_entries(F.collect_list(F.struct("prop", "value"))).alias("props"))


def style_blocks(tokens: DataFrame, scales: DataFrame, key: str, lengths: list[str], fmt) -> DataFrame:
    """``(rec_id, pos, new_text)``: each ``<style>`` text written back from its class rules.

    Rules of one class merge, in the order in which classes and properties first come, the last value of a property
    counting; a stroke without a width gets width 1; ``lengths`` are multiplied by the record's ``s``. Selectors that are
    no plain class are dropped. Values may hold colons, and semicolons inside parentheses.
    """
    css = style_texts(tokens, key).where(F.trim("css") != "")
    decl = _class_bodies(css, key).select(key, "pos", "cls", "ri", "si", F.posexplode(F.split("body", r";(?![^(]*\))")).alias("di", "decl"))
    decl = decl.where(F.locate(":", "decl") > 1).select(
        key, "pos", "cls", F.struct("ri", "si", "di").alias("at"), strip_ws(F.split("decl", ":", 2)[0]).alias("prop"),
        strip_ws(F.split("decl", ":", 2)[1]).alias("value"))
    props = decl.groupBy(key, "pos", "cls", "prop").agg(F.min("at").alias("at"), F.max_by("value", "at").alias("value"))
    scaled = fmt(numeric_text("value") * F.col("s"))
    written = F.concat("prop", F.lit(":"), F.when(F.col("prop").isin(*lengths), F.coalesce(scaled, F.col("value"))).otherwise(F.col("value")))
    classes = props.join(scales.hint("merge"), key).groupBy(key, "pos", "cls").agg(
        F.min("at").alias("at"), F.array_sort(F.collect_list(F.struct("at", written.alias("text")))).alias("texts"),
        F.max("s").alias("s"), F.bool_or(F.col("prop") == "stroke").alias("stroke"), F.bool_or(F.col("prop") == "stroke-width").alias("width"))
    bare = F.when(F.col("stroke") & ~F.col("width"), F.array(F.concat(F.lit("stroke-width:"), fmt(F.col("s"))))).otherwise(F.array().cast("array<string>"))
    rule = F.concat(F.lit("."), "cls", F.lit("{"), F.array_join(F.concat(F.transform("texts", lambda x: x["text"]), bare), ";"), F.lit("}"))
    blocks = classes.groupBy(key, "pos").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("at", rule.alias("rule")))), lambda x: x["rule"]), "\n").alias("text"))
    # CDATA marks are gone from the text, so what they protected is escaped
    text = F.when(F.col("kind") == "cdata", F.replace(F.replace("text", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))).otherwise(F.col("text"))
    return css.join(blocks.hint("merge"), [key, "pos"], "left").select(key, "pos", F.coalesce(text, F.lit("")).alias("new_text"))


def class_rules(elements: DataFrame, rules: DataFrame, key: str = "rec_id") -> DataFrame:
    """Style properties each element receives from its classes: ``(rec_id, open_pos, prop, value)``."""
    cls = (elements.select(key, "open_pos", F.posexplode(F.split(F.trim(F.col("lattrs")["class"]), r"\s+")).alias("ci", "cls"))
           .where(F.col("cls") != ""))
    props = rules.select(key, "cls", F.explode("props").alias("prop", "value"))
    j = cls.join(props.hint("merge"), [key, "cls"])
    return j.groupBy(key, "open_pos", "prop").agg(F.max_by("value", "ci").alias("value"))


# Fixed value: elements that are never drawn where they stand, only where they are referred to.
DEFINITIONS = ["lineargradient", "radialgradient", "clippath", "mask", "marker", "pattern", "symbol", "filter"]
#: Children of <defs> that work without being referred to.
STANDING = ["style", "script", "title", "desc", "metadata"]
URL_REF = r"""url\(\s*["']?#([^)\s"']+)["']?\s*\)"""


def definition_units(elements: DataFrame, key: str = "rec_id") -> DataFrame:
    """Adds ``unit``: the opening position of the outermost definition an element is or lies in, NULL where it is drawn.

    A definition is a child of ``<defs>`` or an element of DEFINITIONS. One order of a record's elements: the furthest end of
    the definitions begun so far.
    """
    low = F.lower("tag")
    before = Window.partitionBy(key).orderBy("open_pos").rowsBetween(Window.unboundedPreceding, -1)
    begins = (low.isin(*DEFINITIONS) | F.coalesce(F.lower(local_name(F.col("parent"))) == "defs", F.lit(False))) & ~low.isin(*STANDING, "defs")
    el = elements
    end = F.coalesce("close_pos", "open_pos")
    el = el.withColumn("_end", F.when(begins, end))
    el = el.withColumn("_reach", F.max("_end").over(before))
    outer = F.col("_end").isNotNull() & ~F.coalesce(F.col("_reach") >= F.col("open_pos"), F.lit(False))
    upto = Window.partitionBy(key).orderBy("open_pos").rowsBetween(Window.unboundedPreceding, 0)
    last = F.last(F.when(outer, F.struct(F.col("open_pos").alias("p"), end.alias("e"))), ignorenulls=True).over(upto)
    el = el.withColumn("_unit", last)
    return el.withColumn("unit", F.when(F.col("_unit.e") >= F.col("open_pos"), F.col("_unit.p"))).drop("_end", "_reach", "_unit")


def with_units(elements: DataFrame, key: str = "rec_id") -> DataFrame:
    return elements if "unit" in elements.columns else definition_units(elements, key)


def references(units: DataFrame, css: DataFrame | None = None, key: str = "rec_id") -> DataFrame:
    """``(rec_id, unit, id)``: what the elements of each unit refer to, by ``url(#id)`` in any value or ``#id`` as a link;
    references in ``css`` (rec_id, css) come from no unit."""
    in_values = F.flatten(F.transform(F.map_values("lattrs"), lambda v: F.regexp_extract_all(v, F.lit(URL_REF), 1)))
    links = F.transform(F.filter(F.array(F.col("lattrs")["href"], F.col("lattrs")["xlink:href"]), lambda v: v.startswith("#")), lambda v: F.substr(v, F.lit(2)))
    refs = units.where(F.size("lattrs") > 0).select(key, "unit", F.explode(F.concat(in_values, links)).alias("id"))
    if css is not None:
        refs = refs.unionByName(css.select(key, F.lit(None).cast("int").alias("unit"), F.explode(F.regexp_extract_all("css", F.lit(URL_REF), 1)).alias("id")))
    return refs.distinct()


def _reach_of(key: str):
    """The units that can be reached from what is drawn (-1), along the references of one record."""
    def run(table: pa.Table) -> pa.Table:
        after: dict[int, list[int]] = {}
        for a, b in zip(table.column("unit").to_pylist(), table.column("target").to_pylist()):
            after.setdefault(a, []).append(b)
        seen, todo = set(), [-1]
        while todo:
            for b in after.get(todo.pop(), ()):
                if b not in seen:
                    seen.add(b)
                    todo.append(b)
        units = pa.array(sorted(seen), pa.int32())
        return pa.table({key: table.column(key).take(pa.array([0] * len(units), pa.int64())), "unit": units})

    return run


def live_units(units: DataFrame, css: DataFrame | None = None, key: str = "rec_id") -> DataFrame:
    """``(rec_id, unit)`` of the definitions that something drawn refers to, directly or through other definitions. A
    definition used only by an unused one is unused, and so are definitions that use each other."""
    ids = units.where(F.col("unit").isNotNull() & F.col("lattrs")["id"].isNotNull()).select(key, F.col("lattrs")["id"].alias("id"), F.col("unit").cast("int").alias("target"))
    edges = references(units, css, key).join(ids.hint("merge"), [key, "id"]).select(key, F.coalesce(F.col("unit"), F.lit(-1)).cast("int").alias("unit"), "target").distinct()
    kind = units.schema[key].dataType.simpleString()
    return edges.groupBy(key).applyInArrow(_reach_of(key), f"{key} {kind}, unit int")


def unreferenced_ids(elements: DataFrame, key: str = "rec_id", css: DataFrame | None = None) -> DataFrame:
    """Elements whose id nothing that is kept refers to: what is drawn, and the definitions that are reached from there."""
    units = with_units(elements, key)
    live = live_units(units, css, key)
    refs = references(units, css, key)
    kept = refs.where("unit IS NULL").select(key, "id").union(refs.join(live.hint("merge"), [key, "unit"], "left_semi").select(key, "id")).distinct()
    ids = units.where(F.col("lattrs")["id"].isNotNull()).select(key, "open_pos", F.col("lattrs")["id"].alias("id"))
    return ids.join(kept.hint("merge"), [key, "id"], "left_anti")
