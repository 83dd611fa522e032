"""Driver tables and the deterministic fixture views derived from them.

The driver's ``pages`` contain no SVG markup, so SVG inputs are SQL views over the driver
tables (documented in FIXTURES.md). Each view is written once as a template with dialect
slots and rendered for Spark (run through ``spark.sql`` with DataFrame arguments) and for
DuckDB (inlined as ``WITH`` clauses in the oracle SQL). Both engines see the same rows.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in BASE_TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Dialect slots (fixed values; see FIXTURES.md "Dialect slots").
SPARK_SLOTS = {
    "S": "STRING",
    "BS": "\\\\",
    "TS": "timestampadd(SECOND, CAST(p_partkey%997 AS INT), TIMESTAMP_NTZ '2024-01-01')",
    "U": "explode",
    "WC": "size(split(text,' '))",
    "SEQ": "sequence(1, CAST(p.page_id%4+1 AS INT))",
}
DUCK_SLOTS = {
    "S": "VARCHAR",
    "BS": "\\",
    "TS": "TIMESTAMP '2024-01-01' + to_seconds(p_partkey%997)",
    "U": "unnest",
    "WC": "len(string_split(text,' '))",
    "SEQ": "generate_series(1, CAST(p.page_id%4+1 AS INT))",
}

def _geom() -> str:
    """Template of ``svg_geom``: markup in which ``[expression of k]`` is a number."""
    paths = (
        "M[k%13] [k%7]H[k%9+14]V[k%5+8]h[k%4+1]v-[k%6+1]z",
        "M[k%13] [k%7]C1 [k%5] [k%6] 7 [k%8+9] 4S[k%10] 3 [k%12+2] [k%4]s2 [k%3+1] 5 -[k%5+1]",
        "M[k%13],[k%7]Q[k%5+3] 9 [k%8+9] [k%4]T[k%12+20] [k%6]t-3 [k%9+1]",
        "M[k%13] [k%7]A[k%5+6] [k%4+5] [k%6*15] 0 1 [k%13+5] [k%7+4]a[k%3+2] 2 [k%5*10] 1 0 [k%2+1] 3",
    )
    path = "CASE k%4 " + " ".join(f"WHEN {i} THEN {_text(d)}" for i, d in enumerate(paths)) + " END"
    head = ('<svg xmlns="http://www.w3.org/2000/svg" viewBox="0 0 [k%20*16+64] [k%10*8+32]"><style>.a{{stroke:red}} .b, .c{{font-size:[k%5+1]px;fill:blue}} '
            '.b{{stroke-width:[k%3+1]}}</style><linearGradient id="l" x1="[k%5]" y1="1" x2="[k%6+2]" y2="[k%7]" gradientTransform="translate(2 [k%4])"/>'
            '<radialGradient id="r" cx="[k%9]" cy="[k%8]" r="[k%3+1]"/><g transform="rotate([k%8*15])"><g transform="translate([k%3] 1) skewX([k%4*10]) scale([k%3+1],[k%2+1])" '
            'stroke="red"><path stroke="blue" d="')
    tail = ('"/><circle cx="[k%11]" cy="3" r="[k%4+1]"/><ellipse cx="2" cy="[k%6]" rx="[k%5+1]" ry="2"/><rect x="1" y="[k%4]" width="[k%7+4]" height="4" rx="[k%3]"/></g></g>'
            '<polyline points="0,0 [k%5],1 2,[k%6]" stroke-width="2" transform="rotate(90)"/></svg>')
    return f"""
SELECT rec_id, k, concat({_text(head)}, {path}, {_text(tail)}) AS svg FROM (SELECT p_partkey AS rec_id, p_partkey%120 AS k FROM {{part}}) t
"""


def _defs() -> str:
    markup = ('<svg xmlns="http://www.w3.org/2000/svg" xmlns:xlink="http://www.w3.org/1999/xlink"><defs><linearGradient id="a[k%3]" xlink:href="#b"/><linearGradient id="b" href="#c"/><linearGradient id="c"/>'
              '<linearGradient id="d" href="#e"/><linearGradient id="e" href="#d"/><g id="f"><path id="p0" d="M0 0L1 [k%5]" fill="url(#g)"/></g>'
              '<style>.x{{fill:url(#s)}}</style><radialGradient id="s"/><radialGradient id="g"/></defs><path id="q" d="M0 0L5 5" fill="url(#a[k%4])"/>'
              '<use href="#p[k%5]"/><text></text><text>t[k%2]</text><g><g/></g><path d="M1 2L3 4" fill="red"/><path d="M1 2L3 4" fill="blue"/></svg>')
    return f"""
SELECT rec_id, k, {_text(markup)} AS svg FROM (SELECT p_partkey AS rec_id, p_partkey%120 AS k FROM {{part}}) t
"""


def _text(markup: str) -> str:
    """SQL text of markup in which ``[expression]`` stands for a number."""
    parts = re.split(r"\[([^]]*)\]", markup)
    return "concat(" + ", ".join(f"CAST({x} AS <<S>>)" if i % 2 else f"'{x}'" for i, x in enumerate(parts)) + ")"


# View templates: <<slot>> marks a dialect slot, {name} a table or view reference, {{ }} literal braces.
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "svg_raw": (("part",), """
SELECT rec_id, k, ts,
 CASE WHEN k%25=2 THEN '<svg></svg>'
      WHEN k%15=1 THEN concat('<svg xmlns="http://www.w3.org/2000/svg"><use xlink:href="#i', CAST(k AS <<S>>), '"/></svg>')
      ELSE concat('<svg xmlns="http://www.w3.org/2000/svg" version="1.1" width="', CAST(w AS <<S>>), '" height="', CAST(h AS <<S>>),
        '" viewBox="0 0 ', CAST(w AS <<S>>), ' ', CAST(h AS <<S>>), '"><title>', brand, '</title><!-- c', CAST(k AS <<S>>), ' --><g transform="translate(',
        CAST(k%3 AS <<S>>), ' ', CAST(k%5 AS <<S>>), ')"><rect x="1" y="2" width="', CAST(k%7+1 AS <<S>>), '" height="', CAST(k%11+1 AS <<S>>),
        '" fill="#F00" stroke="blue"/><path d="M', CAST(k%13 AS <<S>>), ' ', CAST(k%17 AS <<S>>), 'l3 4h', CAST(k%5+1 AS <<S>>), 'z" fill="red"',
        CASE WHEN k%12=5 THEN ' data-x="a<<BS>>b"' ELSE '' END, '/>', CASE WHEN k%30=3 THEN repeat('<g/>', 9000) ELSE '' END,
        CASE WHEN k%10=0 THEN '' ELSE '</g>' END, '</svg>') END AS svg
FROM (SELECT p_partkey AS rec_id, p_partkey%150 AS k, concat('Brand', CAST(p_partkey%150%5 AS <<S>>)) AS brand,
      ((p_partkey%150)%20+4)*2 AS w, (p_partkey%150)%20+4 AS h, <<TS>> AS ts FROM {part}) t
"""),
    "svg_pages": (("pages", "svg_raw"), """
SELECT p.page_id, p.url, replace(p.html, '</article>', concat(s.svg, '<img src="/img/', CAST(s.k AS <<S>>), '.SVG">',
  '<object data="icons/', CAST(s.k%9 AS <<S>>), '.svg"></object></article>')) AS html
FROM {pages} p JOIN (SELECT k, min(svg) AS svg FROM {svg_raw} GROUP BY k) s ON p.page_id%150 = s.k
"""),
    "fetch_log": (("pages", "svg_pages"), """
SELECT page_id, url, attempt,
  CASE WHEN (page_id+attempt)%4=0 THEN 503 WHEN page_id%13=0 THEN 404 ELSE 200 END AS status,
  CASE WHEN page_id%11=0 THEN 'application/pdf' ELSE 'Text/HTML; charset=utf-8' END AS content_type,
  CASE WHEN page_id%17=0 THEN '' ELSE html END AS body, CAST(page_id*37%900+attempt*25 AS INT) AS ms
FROM (SELECT p.page_id, p.url, p.html, CAST(a.attempt AS INT) AS attempt
      FROM (SELECT page_id, <<U>>(<<SEQ>>) AS attempt FROM {pages} p) a JOIN {svg_pages} p ON p.page_id = a.page_id) t
"""),
    "assets": (("pages", "svg_raw"), """
SELECT concat(regexp_extract(p.url, '^(https?://[^/]+)', 1), '/img/', CAST(s.k AS <<S>>), '.SVG') AS abs_url, min(s.svg) AS body,
  min(CASE WHEN s.k%6=0 THEN 'text/plain' ELSE 'image/SVG+xml' END) AS content_type, min(CASE WHEN s.k%5=0 THEN 404 ELSE 200 END) AS status,
  CAST(min(s.k%40+5) AS INT) AS ms
FROM {pages} p JOIN (SELECT k, min(svg) AS svg FROM {svg_raw} GROUP BY k) s ON p.page_id%150 = s.k GROUP BY 1
"""),
    "stage_out": (("svg_raw",), """
SELECT rec_id, concat('f', CAST(rec_id%7 AS <<S>>), '/', CAST(rec_id AS <<S>>), '.svg') AS filename, svg AS raw,
  CASE WHEN length(svg) < 50 OR k%10=0 THEN NULL ELSE replace(svg, ' version="1.1"', '') END AS stage1,
  CASE WHEN length(svg) < 50 OR k%10=0 OR k%8=0 THEN NULL ELSE replace(replace(svg, ' version="1.1"', ''), concat('<!-- c', CAST(k AS <<S>>), ' -->'), '') END AS stage2
FROM {svg_raw}
"""),
    "caption_raw": (("svg_raw", "documents"), """
SELECT md5(s.svg) AS hash, s.rec_id, concat(CASE WHEN d.doc_id%4=0 THEN 'Caption: ' WHEN d.doc_id%4=1 THEN '  image SHOWS:' ELSE ' ' END,
  CASE WHEN d.doc_id%9=0 THEN '' ELSE d.text END, ' ') AS text
FROM {svg_raw} s JOIN {documents} d ON d.doc_id = s.rec_id
"""),
    "pixels": (("embeddings",), """
SELECT vec_id, label, CAST(e AS DOUBLE)*CASE WHEN vec_id%5=0 THEN 1 ELSE 255 END AS gray FROM (SELECT vec_id, label, <<U>>(embedding) AS e FROM {embeddings}) t
"""),
    "tokens_len": (("documents",), """
SELECT doc_id, <<WC>> AS n_tok, md5(text) AS h FROM {documents}
"""),
    "svg_styled": (("svg_raw",), """
SELECT rec_id, k, replace(replace(replace(svg,
  '<title>', concat('<style>.a, .b{{fill:#123;stroke:red}} rect{{x:1}} .b{{fill:blue; stroke-width:2}}</style><defs><linearGradient id="lg', CAST(k AS <<S>>), '"/><clipPath id="cp', CAST(k%4 AS <<S>>), '"><rect width="1" height="1"/></clipPath></defs><title>')),
  '<rect ', concat('<rect class="a b" id="r', CAST(k AS <<S>>), '" ')),
  '<path ', concat('<path style="stroke: #0F0 ;opacity:0.5;bad" clip-path="url(#cp', CAST(k%3 AS <<S>>), ')" ')) AS svg
FROM {svg_raw}
"""),
    # paths of every command, nested rotations and skews, shapes, gradients with points, a style block with lengths
    "svg_geom": (("part",), _geom()),
    # definitions used in a chain, in a cycle, by a style block and from inside other definitions; empty texts and groups
    "svg_defs": (("part",), _defs()),
    "predictions": (("labels",), """
SELECT 'a' AS model, doc_id AS item, 'quality' AS task, quality AS label, CASE WHEN doc_id%3=0 THEN 1-quality ELSE quality END AS pred FROM {labels}
UNION ALL SELECT 'b', doc_id, 'quality', quality, CASE WHEN (doc_id+1)%7=0 THEN 1-quality ELSE quality END FROM {labels}
UNION ALL SELECT 'a', doc_id, 'toxic', toxic, CASE WHEN doc_id%4=1 THEN 1-toxic ELSE toxic END FROM {labels}
UNION ALL SELECT 'b', doc_id, 'clean', CASE WHEN quality = 1 AND toxic = 0 THEN 1 ELSE 0 END, quality FROM {labels}
"""),
}


def _render(template: str, slots: dict[str, str]) -> str:
    for k, v in slots.items():
        template = template.replace(f"<<{k}>>", v)
    return template


#: Rows of a base table that one task turns into markup: a key of a few bytes becomes a text of up to 36,000.
ROWS_PER_TASK = 5_000
#: Pages that one task puts icons into.
PAGES_PER_TASK = 2_000


def tasks(spark: SparkSession, sf_dir: str, name: str, rows: int = ROWS_PER_TASK) -> int:
    """How many tasks the markup made of a base table takes; the count reads the files' footers."""
    return max(1, -(-table(spark, sf_dir, name).count() // rows))


def _captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``caption_raw`` of the hashes: the join carries them in place of the markup, and neither side is broadcast."""
    svgs = view(spark, sf_dir, "svg_raw").selectExpr("md5(svg) AS hash", "rec_id")
    template = VIEWS["caption_raw"][1].replace("md5(s.svg) AS hash", "s.hash")
    return spark.sql(_render(template, SPARK_SLOTS), svg_raw=svgs.hint("merge"), documents=table(spark, sf_dir, "documents"))


#: The one markup of each ``k`` that ``svg_pages`` and ``assets`` put into pages.
ICONS = "(SELECT k, min(svg) AS svg FROM {svg_raw} GROUP BY k)"


def _with_icons(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view that puts icons into pages. There are as many icons as remainders of 150, so they are sent to the pages: a
    table of pages is larger than its file, and a join by ``k`` would broadcast it or deal it to 150 keys. The pages are
    dealt to tasks by their key, which needs no sort: a file of a few megabytes, once unpacked, would be one task's."""
    icons = view(spark, sf_dir, "svg_raw").groupBy("k").agg(F.min("svg").alias("svg"))
    pages = table(spark, sf_dir, "pages").repartition(tasks(spark, sf_dir, "pages", PAGES_PER_TASK), "page_id")
    template = VIEWS[name][1].replace(ICONS, "{icons}")
    return spark.sql(_render(template, SPARK_SLOTS), icons=F.broadcast(icons), pages=pages)


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base table or a fixture view as a Spark DataFrame. The keys that views make markup of are dealt to tasks first: a
    file of a few megabytes is one task's, and its texts would be sorted there."""
    if name in BASE_TABLES:
        return table(spark, sf_dir, name)
    if name == "caption_raw":
        return _captions(spark, sf_dir)
    if ICONS in VIEWS[name][1]:
        return _with_icons(spark, sf_dir, name)
    deps, template = VIEWS[name]
    args = {d: view(spark, sf_dir, d) for d in deps}
    if "svg_pages" in args:  # the attempts' keys join the pages where these lie; a table of keys is not broadcast
        args["svg_pages"] = args["svg_pages"].hint("merge")
    if "part" in args:
        args["part"] = args["part"].select("p_partkey").repartition(tasks(spark, sf_dir, "part"))
    return spark.sql(_render(template, SPARK_SLOTS), **args)


def duck_with(*names: str) -> str:
    """``WITH`` clause defining the requested fixture views (and their dependencies) for DuckDB."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in BASE_TABLES or n in order:
            return
        for d in VIEWS[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return ""
    parts = []
    for n in order:
        deps = VIEWS[n][0]
        body = _render(VIEWS[n][1], DUCK_SLOTS).format(**{d: d for d in deps}).strip()
        parts.append(f"{n} AS ({body})")
    return "WITH " + ",\n".join(parts) + "\n"
