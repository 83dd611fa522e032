"""Geometry as column expressions: transforms, path commands, absolute segments, shapes, and the segment table.

Path data are folded once per path, with higher-order functions inside one row; from there on a path is rows of
segments, on which arcs, cubics, matrices and text are plain columns and grouped sums. A segment is
``struct<sub:int, kind:string, p0:point, pts:array<point>, arc:array<double>, closing:boolean>``:
``p0`` is the start point, ``pts`` the control points and end point, ``kind`` one of M L Q C A.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from svgspark.functions.util import as_col

POINT = "struct<x:double,y:double>"
SEG = f"struct<sub:int,kind:string,p0:{POINT},pts:array<{POINT}>,arc:array<double>,closing:boolean>"
MAT_FIELDS = ("a", "b", "c", "d", "e", "f")
BLOCK = 256  # commands of a path that one fold reads
CLOSE_EPS = 1e-5

# Path and transform grammar.
PATH_TOKEN_RE = r"[MmZzLlHhVvCcSsQqTtAa]|[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?"
PATH_PIECE_RE = r"[MmZzLlHhVvCcSsQqTtAa][^MmZzLlHhVvCcSsQqTtAa]*|^[^MmZzLlHhVvCcSsQqTtAa]+"
_NUM = r"[-+]?(?:\d++\.?+\d*+|\.\d++)(?:[eE][-+]?\d++)?+"
#: The seven numbers of an arc; its flags are one digit each and need no space behind them: ``a1 1 0 012 2``.
ARC_RE = r"[\s,]*+".join(["", *[f"({_NUM})"] * 3, "([01])", "([01])", f"({_NUM})", f"({_NUM})"])
ARITY = {"M": 2, "L": 2, "H": 1, "V": 1, "C": 6, "S": 4, "Q": 4, "T": 2, "A": 7, "Z": 0}
TRANSFORM_RE = r"(matrix|translate|scale|rotate|skewX|skewY)\s*\(([^)]*)\)"


# ---------------------------------------------------------------- points and matrices
def pt(x, y) -> Column:
    return F.struct(as_col(x).cast("double").alias("x"), as_col(y).cast("double").alias("y"))


def mat(a, b, c, d, e, f) -> Column:
    vals = (a, b, c, d, e, f)
    return F.struct(*[(v if isinstance(v, Column) else F.lit(float(v))).cast("double").alias(n) for v, n in zip(vals, MAT_FIELDS)])


def identity() -> Column:
    return mat(1, 0, 0, 1, 0, 0)


def matmul(m1: Column, m2: Column) -> Column:
    """m1 @ m2 for affine matrices [[a c e], [b d f], [0 0 1]]."""
    a1, b1, c1, d1, e1, f1 = (m1[n] for n in MAT_FIELDS)
    a2, b2, c2, d2, e2, f2 = (m2[n] for n in MAT_FIELDS)
    return mat(a1 * a2 + c1 * b2, b1 * a2 + d1 * b2, a1 * c2 + c1 * d2, b1 * c2 + d1 * d2,
               a1 * e2 + c1 * f2 + e1, b1 * e2 + d1 * f2 + f1)


def apply_mat(m: Column, p: Column) -> Column:
    return pt(m["a"] * p["x"] + m["c"] * p["y"] + m["e"], m["b"] * p["x"] + m["d"] * p["y"] + m["f"])


def scale_pt(p: Column, s) -> Column:
    return pt(p["x"] * as_col(s), p["y"] * as_col(s))


def numbers(text) -> Column:
    """All numbers of a list like ``1, 2 3e2 -4`` as array<double>."""
    return F.transform(F.regexp_extract_all(as_col(text), F.lit(r"[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?"), 0),
                       lambda x: x.cast("double"))


def _fn_matrix(fn: Column, a: Column) -> Column:
    g = lambda i: F.get(a, i)
    n = F.size(a)
    rad = F.radians(g(0))
    cos, sin = F.cos(rad), F.sin(rad)
    cx, cy = F.coalesce(g(1), F.lit(0.0)), F.coalesce(g(2), F.lit(0.0))
    return (F.when(fn == "matrix", mat(g(0), g(1), g(2), g(3), g(4), g(5)))
            .when(fn == "translate", mat(1, 0, 0, 1, g(0), F.coalesce(g(1), F.lit(0.0))))
            .when(fn == "scale", mat(g(0), 0, 0, F.coalesce(g(1), g(0)), 0, 0))
            .when(fn == "rotate", F.when(n >= 3, mat(cos, sin, -sin, cos, cx - cx * cos + cy * sin, cy - cx * sin - cy * cos))
                  .otherwise(mat(cos, sin, -sin, cos, 0, 0)))
            .when(fn == "skewX", mat(1, 0, F.tan(rad), 1, 0, 0))
            .when(fn == "skewY", mat(1, F.tan(rad), 0, 1, 0, 0)))


def parse_transform(text) -> Column:
    """``transform`` list -> one matrix; functions compose left to right (NULL text -> identity). Lists written one after
    the other are one list."""
    t = F.coalesce(as_col(text), F.lit(""))
    fns = F.regexp_extract_all(t, F.lit(TRANSFORM_RE), 1)
    args = F.regexp_extract_all(t, F.lit(TRANSFORM_RE), 2)
    calls = F.transform(F.arrays_zip(fns.alias("fn"), args.alias("args")), lambda z: F.struct(z["fn"].alias("fn"), numbers(z["args"]).alias("a")))
    mats = F.transform(calls, lambda z: F.coalesce(_fn_matrix(z["fn"], z["a"]), identity()))
    return F.aggregate(mats, identity(), matmul)


# ---------------------------------------------------------------- path commands
def path_tokens(d) -> Column:
    """Command letters and numbers; the groups of an arc are parted first, since its flags may stand close."""
    pieces = F.regexp_extract_all(F.coalesce(as_col(d), F.lit("")), F.lit(PATH_PIECE_RE), 0)
    parted = lambda p: F.when(p.rlike("^[Aa]"), F.regexp_replace(p, rf"(^[Aa]|\G){ARC_RE}", "$1 $2 $3 $4 $5 $6 $7 $8 ")).otherwise(p)
    return F.flatten(F.transform(pieces, lambda p: F.regexp_extract_all(parted(p), F.lit(PATH_TOKEN_RE), 0)))


def command_index(toks) -> Column:
    """0-based positions of the command letters in the token array."""
    return F.filter(F.transform(as_col(toks), lambda t, i: F.when(t.rlike("^[A-Za-z]$"), i).otherwise(-1)), lambda i: i >= 0)


def path_commands(toks, idx) -> Column:
    """Tokens + letter positions -> array<struct<cmd, args array<double>>>; implicit repeats expanded
    (extra pairs after M are L). Argument groups shorter than the arity are no command: see ``path_reason``."""
    toks, idx = as_col(toks), as_col(idx)
    n_tok = F.size(toks)
    arity_map = F.create_map(*sum([[F.lit(k), F.lit(v)] for k, v in ARITY.items()], []))

    def per_cmd(i, j):
        nxt = F.coalesce(F.get(idx, j + 1), n_tok)
        nums = F.transform(F.slice(toks, i + 2, nxt - i - 1), lambda x: x.cast("double"))
        cmd = F.get(toks, i)
        ar = F.element_at(arity_map, F.upper(cmd))
        n_chunks = F.when(ar == 0, F.lit(1)).otherwise(F.floor(F.size(nums) / ar).cast("int"))
        chunks = F.when(n_chunks > 0, F.sequence(F.lit(0), n_chunks - 1)).otherwise(F.array().cast("array<int>"))
        repeat_cmd = F.when(cmd == "M", F.lit("L")).when(cmd == "m", F.lit("l")).otherwise(cmd)
        return F.transform(chunks, lambda c: F.struct(
            F.when(c > 0, repeat_cmd).otherwise(cmd).alias("cmd"),
            F.when(ar == 0, F.array().cast("array<double>")).otherwise(F.slice(nums, c * ar + 1, ar)).alias("args")))

    return F.flatten(F.transform(idx, lambda i, j: per_cmd(i, j)))


def path_reason(toks, idx) -> Column:
    """Why tokens do not make whole commands, NULL if they do: numbers that belong to none, or too few of them."""
    toks, idx = as_col(toks), as_col(idx)
    arity_map = F.create_map(*sum([[F.lit(k), F.lit(v)] for k, v in ARITY.items()], []))

    def short(i, j):
        n = F.coalesce(F.get(idx, j + 1), F.size(toks)) - i - 1
        ar = F.element_at(arity_map, F.upper(F.get(toks, i)))
        return F.when(ar == 0, n > 0).otherwise((n == 0) | (n % F.greatest(ar, F.lit(1)) != 0))

    return (F.when(F.coalesce(F.get(idx, F.lit(0)), F.size(toks)) > 0, F.lit("path data: numbers before the first command"))
            .when(F.exists(F.transform(idx, short), lambda x: x), F.lit("path data: numbers missing or left over")))


def commands_of(d) -> Column:
    """Convenience for short inputs: ``d`` text straight to commands (tokenises twice)."""
    return path_commands(path_tokens(d), command_index(path_tokens(d)))


def _seg(sub, kind, p0, pts, arc=None, closing=False) -> Column:
    return F.struct(as_col(sub).cast("int").alias("sub"), F.lit(kind).alias("kind") if isinstance(kind, str) else kind.alias("kind"),
                    p0.alias("p0"), pts.cast(f"array<{POINT}>").alias("pts"),
                    (arc if arc is not None else F.array().cast("array<double>")).alias("arc"),
                    F.lit(closing).alias("closing"))


def path_absolute(cmds) -> Column:
    """Commands -> absolute segments (relative offsets applied, H/V/S/T expanded, Z as a closing line).

    An ``aggregate`` fold carrying (current point, subpath start, last control point, last command). Every step of a fold
    copies all that it carries, so blocks of ``BLOCK`` commands are folded each, and their segments put one after another.
    """
    cmds = as_col(cmds)
    nothing = F.array().cast(f"array<{SEG}>")
    carried = ("cur", "start", "ctrl", "last", "sub")
    state0 = F.struct(
        pt(F.lit(0.0), F.lit(0.0)).alias("cur"), pt(F.lit(0.0), F.lit(0.0)).alias("start"),
        pt(F.lit(0.0), F.lit(0.0)).alias("ctrl"), F.lit("").alias("last"), F.lit(-1).alias("sub"),
        F.array().cast(f"array<array<{SEG}>>").alias("out"))

    def step(st, c):
        cmd, a = c["cmd"], c["args"]
        up = F.upper(cmd)
        rel = cmd != up
        cur, start, ctrl, last = st["cur"], st["start"], st["ctrl"], st["last"]
        ox = F.when(rel, cur["x"]).otherwise(F.lit(0.0))
        oy = F.when(rel, cur["y"]).otherwise(F.lit(0.0))
        g = lambda i: F.get(a, i)
        P = lambda i: pt(ox + g(i), oy + g(i + 1))
        refl = pt(cur["x"] * 2 - ctrl["x"], cur["y"] * 2 - ctrl["y"])
        c1_s = F.when(F.upper(last).isin("C", "S"), refl).otherwise(cur)
        c1_t = F.when(F.upper(last).isin("Q", "T"), refl).otherwise(cur)
        end = (F.when(up.isin("M", "L", "T"), P(0))
               .when(up == "H", pt(ox + g(0), cur["y"]))
               .when(up == "V", pt(cur["x"], oy + g(0)))
               .when(up == "C", P(4))
               .when(up.isin("S", "Q"), P(2))
               .when(up == "A", P(5))
               .otherwise(start))
        new_ctrl = (F.when(up == "C", P(2)).when(up == "S", P(0)).when(up == "Q", P(0)).when(up == "T", c1_t).otherwise(end))
        sub = F.when(up == "M", st["sub"] + 1).otherwise(st["sub"])
        seg = (F.when(up == "M", _seg(sub, "M", end, F.array()))
               .when(up.isin("L", "H", "V"), _seg(sub, "L", cur, F.array(end)))
               .when(up == "C", _seg(sub, "C", cur, F.array(P(0), P(2), end)))
               .when(up == "S", _seg(sub, "C", cur, F.array(c1_s, P(0), end)))
               .when(up == "Q", _seg(sub, "Q", cur, F.array(P(0), end)))
               .when(up == "T", _seg(sub, "Q", cur, F.array(c1_t, end)))
               .when(up == "A", _seg(sub, "A", cur, F.array(end), F.slice(a, 1, 5)))
               .otherwise(_seg(sub, "L", cur, F.array(start), closing=True)))
        return F.struct(end.alias("cur"), F.when(up == "M", end).otherwise(start).alias("start"),
                        new_ctrl.alias("ctrl"), cmd.alias("last"), sub.alias("sub"),
                        F.array_append(st["out"], seg).alias("out"))

    def block(st, b):
        own = F.struct(*[st[x].alias(x) for x in carried], nothing.alias("out"))
        done = F.aggregate(F.slice(cmds, b * BLOCK + 1, F.lit(BLOCK)), own, step)
        # through a lambda variable, so that the block is folded once and not for each field
        return F.transform(F.array(done), lambda d: F.struct(*[d[x].alias(x) for x in carried], F.array_append(st["out"], d["out"]).alias("out")))[0]

    blocks = F.when(F.size(cmds) > 0, F.sequence(F.lit(0), F.floor((F.size(cmds) - 1) / BLOCK).cast("int"))).otherwise(F.array().cast("array<int>"))
    segs = F.aggregate(blocks, state0, block, lambda st: F.flatten(st["out"]))
    return F.when(cmds.isNotNull(), segs)


def _dist(p, q) -> Column:
    return F.sqrt((p["x"] - q["x"]) * (p["x"] - q["x"]) + (p["y"] - q["y"]) * (p["y"] - q["y"]))


def _end(s) -> Column:
    return F.coalesce(F.try_element_at(s["pts"], F.lit(-1)), s["p0"])


def subpath_close(segs) -> Column:
    """Drop zero-length closing lines; returns array<struct<sub, start, closed, segs>> per subpath.

    A subpath is closed when it ends with Z, or when its end lies within 1e-5 of its start.
    """
    segs = F.filter(as_col(segs), lambda s: ~(s["closing"] & (_dist(s["p0"], s["pts"][0]) < CLOSE_EPS)))
    subs = F.array_distinct(F.transform(segs, lambda s: s["sub"]))

    def one(k):
        mine = F.filter(segs, lambda s: s["sub"] == k)
        draw = F.filter(mine, lambda s: s["kind"] != "M")
        start = F.get(mine, 0)["p0"]
        closed = F.exists(mine, lambda s: s["closing"]) | (
            (F.size(draw) > 0) & (_dist(_end(F.try_element_at(draw, F.lit(-1))), start) < CLOSE_EPS))
        return F.struct(k.alias("sub"), start.alias("start"), closed.alias("closed"), draw.alias("segs"))

    return F.filter(F.transform(subs, one), lambda sp: sp["start"].isNotNull())


def to_cubic(segs, cubic_only: bool = True) -> Column:
    """Lines -> cubics at 1/3 and 2/3; quadratics -> cubics (2/3 rule). Identity when not cubic_only."""
    if not cubic_only:
        return as_col(segs)

    def conv(s):
        p0, pts = s["p0"], s["pts"]
        e = F.try_element_at(pts, F.lit(-1))
        lerp = lambda a, b, t: pt(a["x"] + (b["x"] - a["x"]) * t, a["y"] + (b["y"] - a["y"]) * t)
        q = pts[0]
        new_pts = (F.when(s["kind"] == "L", F.array(lerp(p0, e, 1.0 / 3), lerp(p0, e, 2.0 / 3), e))
                   .when(s["kind"] == "Q", F.array(lerp(p0, q, 2.0 / 3), lerp(e, q, 2.0 / 3), e))
                   .otherwise(pts))
        kind = F.when(s["kind"].isin("L", "Q"), F.lit("C")).otherwise(s["kind"])
        return s.withField("kind", kind).withField("pts", new_pts)

    return F.transform(as_col(segs), conv)


# ---------------------------------------------------------------- segment table
def path_segments(paths: DataFrame, d: str = "d") -> DataFrame:
    """One fold per path, then a row per segment: the columns of ``paths`` and
    ``(seg, sub, kind, p0, pts, arc, closing)``; a path without commands is one row of NULLs."""
    folded = (paths.withColumn("_t", path_tokens(d)).withColumn("_i", command_index("_t"))
              .withColumn("_c", path_commands("_t", "_i")).withColumn("_s", path_absolute("_c")))
    return folded.select(*paths.columns, F.posexplode_outer("_s").alias("seg", "_g")).select(*paths.columns, "seg", "_g.*")


def split_arcs(segs: DataFrame) -> DataFrame:
    """Arc rows -> rows of cubic pieces of at most 90 degrees, numbered by ``piece``; other rows have piece 0.

    An arc between equal points draws nothing, one without a radius is a line. The centre follows from the end points
    (SVG implementation notes), step by step in columns of their own, so that no step is copied into the next.
    """
    p1, p2 = F.col("p0"), F.try_element_at("pts", F.lit(-1))
    c, is_arc = F.col, F.col("kind") == "A"
    same = (p1["x"] == p2["x"]) & (p1["y"] == p2["y"])
    df = segs.withColumns({"_rx": F.abs(F.get("arc", F.lit(0))), "_ry": F.abs(F.get("arc", F.lit(1))), "_phi": F.radians(F.get("arc", F.lit(2))),
                         "_hx": (p1["x"] - p2["x"]) / 2, "_hy": (p1["y"] - p2["y"]) / 2})
    flat = is_arc & ((c("_rx") == 0) | (c("_ry") == 0))
    df = df.withColumn("kind", F.when(is_arc & same, F.lit("M")).when(flat, F.lit("L")).otherwise(c("kind")))
    df = df.withColumns({"_cos": F.cos("_phi"), "_sin": F.sin("_phi")})
    df = df.withColumns({"_x": c("_cos") * c("_hx") + c("_sin") * c("_hy"), "_y": c("_cos") * c("_hy") - c("_sin") * c("_hx")})
    df = df.withColumn("_grow", F.sqrt(F.greatest(F.lit(1.0), F.try_divide(c("_x") * c("_x"), c("_rx") * c("_rx"))
                                                  + F.try_divide(c("_y") * c("_y"), c("_ry") * c("_ry")))))
    df = df.withColumns({"_rx": c("_rx") * c("_grow"), "_ry": c("_ry") * c("_grow")})
    # the centre in the ellipse's own axes, as multiples of the radii
    df = df.withColumns({"_u": F.try_divide(c("_x"), c("_rx")), "_v": F.try_divide(c("_y"), c("_ry"))})
    df = df.withColumn("_uu", c("_u") * c("_u") + c("_v") * c("_v"))
    side = F.when(F.get("arc", F.lit(3)) == F.get("arc", F.lit(4)), F.lit(-1.0)).otherwise(F.lit(1.0))
    df = df.withColumn("_k", side * F.sqrt(F.greatest(F.lit(0.0), F.try_divide(1 - c("_uu"), c("_uu")))))
    df = df.withColumns({"_cu": c("_k") * c("_v"), "_cv": -c("_k") * c("_u")})
    df = df.withColumns({
        "_cx": c("_cos") * c("_rx") * c("_cu") - c("_sin") * c("_ry") * c("_cv") + (p1["x"] + p2["x"]) / 2,
        "_cy": c("_sin") * c("_rx") * c("_cu") + c("_cos") * c("_ry") * c("_cv") + (p1["y"] + p2["y"]) / 2,
        "_from": F.atan2(c("_v") - c("_cv"), c("_u") - c("_cu")),
        "_to": F.atan2(-c("_v") - c("_cv"), -c("_u") - c("_cu"))})
    turn = c("_to") - c("_from")
    sweeps = F.get("arc", F.lit(4)) != 0
    df = df.withColumn("_turn", F.when(sweeps & (turn < 0), turn + 2 * math.pi).when(~sweeps & (turn > 0), turn - 2 * math.pi).otherwise(turn))
    df = df.withColumn("_n", F.when(is_arc, F.greatest(F.lit(1), F.ceil(F.abs("_turn") / (math.pi / 2) - 1e-9).cast("int"))).otherwise(F.lit(1)))
    df = df.withColumn("piece", F.explode(F.sequence(F.lit(0), c("_n") - 1)))
    df = df.withColumns({"_a": c("_from") + c("_turn") / c("_n") * c("piece"), "_b": c("_from") + c("_turn") / c("_n") * (c("piece") + 1),
                         "_w": F.lit(4.0 / 3.0) * F.tan(c("_turn") / c("_n") / 4)})
    df = df.withColumns({"_ca": F.cos("_a"), "_sa": F.sin("_a"), "_cb": F.cos("_b"), "_sb": F.sin("_b")})

    def on(u, v):
        return pt(c("_cx") + c("_rx") * c("_cos") * u - c("_ry") * c("_sin") * v, c("_cy") + c("_rx") * c("_sin") * u + c("_ry") * c("_cos") * v)

    begin = F.when(c("piece") == 0, p1).otherwise(on(c("_ca"), c("_sa")))
    end = F.when(c("piece") == c("_n") - 1, p2).otherwise(on(c("_cb"), c("_sb")))
    handles = F.array(on(c("_ca") - c("_w") * c("_sa"), c("_sa") + c("_w") * c("_ca")), on(c("_cb") + c("_w") * c("_sb"), c("_sb") - c("_w") * c("_cb")), end)
    df = df.withColumns({"p0": F.when(is_arc, begin).otherwise(p1), "pts": F.when(is_arc, handles).otherwise(c("pts")),
                         "kind": F.when(is_arc, F.lit("C")).otherwise(c("kind"))})
    return df.select(*[x for x in segs.columns if x != "arc"], "piece")


def cubic_rows(segs: DataFrame) -> DataFrame:
    """Lines and quadratics of a segment table as cubics."""
    p0, q, e = F.col("p0"), F.get("pts", F.lit(0)), F.try_element_at("pts", F.lit(-1))
    lerp = lambda a, b, t: pt(a["x"] + (b["x"] - a["x"]) * t, a["y"] + (b["y"] - a["y"]) * t)
    pts = (F.when(F.col("kind") == "L", F.array(lerp(p0, e, 1.0 / 3), lerp(p0, e, 2.0 / 3), e))
           .when(F.col("kind") == "Q", F.array(lerp(p0, q, 2.0 / 3), lerp(e, q, 2.0 / 3), e)).otherwise(F.col("pts")))
    return segs.withColumns({"pts": pts, "kind": F.when(F.col("kind").isin("L", "Q"), F.lit("C")).otherwise(F.col("kind"))})


def transform_rows(segs: DataFrame, m: str, s: str) -> DataFrame:
    """Every point of a segment table through matrix ``m``, then times ``s``."""
    f = lambda p: scale_pt(apply_mat(F.col(m), p), F.col(s))
    return segs.withColumns({"p0": f(F.col("p0")), "pts": F.transform("pts", f)})


def rows_text(segs: DataFrame, keys: list[str], decimals: int = 3, to_int: bool = False) -> DataFrame:
    """Segment rows -> ``(keys, path_d)``: ordered regroup by subpath, then by path. Closing lines without length go; a
    subpath is closed if it has a closing line or ends within 1e-5 of its start. NULL where a coordinate is not finite."""
    f = lambda p: F.concat(fmt_num(p["x"], decimals, to_int), F.lit(" "), fmt_num(p["y"], decimals, to_int))
    end = F.coalesce(F.try_element_at("pts", F.lit(-1)), F.col("p0"))
    beyond = lambda p: ~((F.abs(p["x"]) < float("inf")) & (F.abs(p["y"]) < float("inf")))
    bad = F.col("seg").isNotNull() & F.coalesce(F.exists(F.array_append("pts", F.col("p0")), beyond), F.lit(True))
    kept = segs.where(~F.coalesce(F.col("closing") & (_dist(F.col("p0"), end) < CLOSE_EPS), F.lit(False)))
    draws = F.col("kind") != "M"
    kept = kept.select(*keys, "sub", "closing", "p0", F.struct("seg", "piece").alias("_at"), bad.alias("_bad"), F.when(draws, end).alias("_end"),
                       F.when(draws, F.concat(F.lit(" "), "kind", F.lit(" "), F.array_join(F.transform("pts", f), " "))).alias("_text"))
    in_order = lambda at, x: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(at, x))), lambda r: r[x]), " " if x == "_sub" else "")
    subs = kept.groupBy(*keys, "sub").agg(
        F.min_by("p0", "_at").alias("_start"), F.max_by("_end", F.when(F.col("_end").isNotNull(), F.col("_at"))).alias("_stop"),
        F.bool_or("closing").alias("_closing"), F.bool_or("_bad").alias("_bad"), in_order("_at", "_text").alias("_body"))
    closed = F.col("_closing") | F.coalesce(_dist(F.col("_stop"), F.col("_start")) < CLOSE_EPS, F.lit(False))
    subs = subs.withColumn("_sub", F.concat(F.lit("M "), f(F.col("_start")), F.col("_body"), F.when(closed, F.lit("Z")).otherwise(F.lit(""))))
    out = subs.groupBy(*keys).agg(F.bool_or("_bad").alias("_bad"), in_order("sub", "_sub").alias("path_d"))
    return out.select(*keys, F.when(~F.col("_bad"), F.col("path_d")).alias("path_d"))


def path_texts(paths: DataFrame, keys: list[str], d: str = "d", m: str = "m", s: str = "s", cubic_only: bool = True,
               decimals: int = 3, to_int: bool = False) -> DataFrame:
    """``(keys, path_d)`` of the ``paths`` that have data: segments, arcs, cubics, matrix and scale, text. A path without
    commands has the empty text; a NULL scale, like a coordinate beyond double, gives NULL."""
    paths = paths.where(F.col(d).isNotNull()).select(*keys, F.col(d).alias("_d"), F.col(m).alias("_m"), F.col(s).alias("_z"))
    rows = split_arcs(path_segments(paths, "_d").drop("_d"))
    return rows_text(transform_rows(cubic_rows(rows) if cubic_only else rows, "_m", "_z"), keys, decimals, to_int)


# ---------------------------------------------------------------- text output
def fmt_num(v, decimals: int = 3, to_int: bool = False) -> Column:
    """Fixed decimals through DECIMAL (never double-to-string), trailing zeros and '-0' removed."""
    v = as_col(v)
    if to_int:
        return v.cast("long").cast("string")
    s = F.coalesce(F.round(v, decimals).try_cast(f"decimal(38,{decimals})").cast("string"), v.cast("string"))
    s = F.regexp_replace(F.regexp_replace(s, r"(\.\d*?)0+$", "$1"), r"\.$", "")
    return F.when(s == "-0", F.lit("0")).otherwise(s)


# ---------------------------------------------------------------- shapes
def _num(m: Column, k: str, default=None) -> Column:
    v = F.regexp_replace(m[k], "[A-Za-z]", "").try_cast("double")
    return F.coalesce(v, F.lit(default)) if default is not None else v


def with_shape_path(df: DataFrame, out: str, attrs: str = "lattrs") -> DataFrame:
    """Adds ``out``: circle / ellipse / rect as an equivalent path ``d`` (rx, ry default to each other), NULL for others.

    The numbers are texts in one array first, so that the path is put together from texts alone."""
    m, t = F.col(attrs), F.col("tag")
    n = {k: _num(m, k, 0.0) for k in ("cx", "cy", "r", "rx", "ry", "x", "y", "width", "height")}
    round_x = F.least(F.coalesce(_num(m, "rx"), _num(m, "ry"), F.lit(0.0)), n["width"] / 2)
    round_y = F.least(F.coalesce(_num(m, "ry"), _num(m, "rx"), F.lit(0.0)), n["height"] / 2)
    rect = t == "rect"
    df = df.withColumns({
        "_w": F.when(t == "circle", n["r"]).when(rect, round_x).otherwise(n["rx"]), "_h": F.when(t == "circle", n["r"]).when(rect, round_y).otherwise(n["ry"]),
        "_l": F.when(rect, n["x"]).otherwise(n["cx"]), "_o": F.when(rect, n["y"]).otherwise(n["cy"]),
        "_r": F.when(rect, n["x"] + n["width"]), "_u": F.when(rect, n["y"] + n["height"])})
    c = F.col
    places = {"w": c("_w"), "h": c("_h"), "l": c("_l"), "o": c("_o"), "r": c("_r"), "u": c("_u"), "l+": c("_l") + c("_w"), "l-": c("_l") - c("_w"),
              "r-": c("_r") - c("_w"), "o+": c("_o") + c("_h"), "u-": c("_u") - c("_h")}
    df = df.withColumn("_f", F.when(t.isin("circle", "ellipse", "rect"), F.transform(F.array(*places.values()), lambda v: fmt_num(v, 6))))

    def text(form: str) -> Column:
        """The form's words, with the names of numbers replaced by their texts."""
        names = list(places)
        return F.concat_ws(" ", *[F.get("_f", F.lit(names.index(w))) if w in places else F.lit(w) for w in form.split()])

    d = (F.when(t.isin("circle", "ellipse"), text("M l- o A w h 0 1 0 l+ o A w h 0 1 0 l- o Z"))
         .when(rect & (c("_w") > 0) & (c("_h") > 0), text("M l+ o H r- A w h 0 0 1 r o+ V u- A w h 0 0 1 r- u H l+ A w h 0 0 1 l u- V o+ A w h 0 0 1 l+ o Z"))
         .when(rect, text("M l o H r V u H l Z")))
    return df.withColumn(out, d).drop("_w", "_h", "_l", "_o", "_r", "_u", "_f")


def points_text(text, m, s, decimals: int = 3, to_int: bool = False) -> Column:
    """``points`` list -> transformed and scaled ``x,y x,y`` text."""
    nums = numbers(text)
    n = F.floor(F.size(nums) / 2).cast("int")
    pts = F.transform(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")),
                      lambda i: scale_pt(apply_mat(m, pt(F.get(nums, i * 2), F.get(nums, i * 2 + 1))), s))
    return F.array_join(F.transform(pts, lambda p: F.concat(fmt_num(p["x"], decimals, to_int), F.lit(","),
                                                             fmt_num(p["y"], decimals, to_int))), " ")
