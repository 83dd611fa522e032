"""URL resolution as a column expression (``urljoin(page, ref)`` semantics, RFC 3986 reference resolution)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from svgspark.functions.util import as_col

# Fixed value: RFC 3986 appendix B splitter. Groups: 2 scheme, 3 //authority, 4 authority, 5 path,
# 7 query, 9 fragment.
URI_RE = r"^(([A-Za-z][A-Za-z0-9+.-]*):)?(//([^/?#]*))?([^?#]*)(\?([^#]*))?(#(.*))?$"


def _part(c: Column, i: int) -> Column:
    return F.regexp_extract(c, URI_RE, i)


def remove_dot_segments(segments: Column) -> Column:
    """Fold a list of path segments, dropping ``.`` and popping on ``..`` (never above the root)."""
    empty = F.array().cast("array<string>")
    folded = F.aggregate(
        segments,
        empty,
        lambda acc, s: F.when(s == "..", F.when(F.size(acc) == 0, acc).otherwise(F.slice(acc, 1, F.size(acc) - 1)))
        .when(s == ".", acc)
        .otherwise(F.array_append(acc, s)),
    )
    return F.when(F.element_at(segments, -1).isin(".", ".."), F.array_append(folded, F.lit(""))).otherwise(folded)


def resolve_url(page, ref) -> Column:
    page, ref = as_col(page), as_col(ref)
    b_scheme, b_auth, b_path, b_query = _part(page, 2), _part(page, 4), _part(page, 5), _part(page, 7)
    r_scheme, r_has_auth, r_path, r_query, r_frag = (
        _part(ref, 2), _part(ref, 3) != "", _part(ref, 5), _part(ref, 7), _part(ref, 9))

    def tail(q: Column, f: Column) -> Column:
        return F.concat(F.when(q != "", F.concat(F.lit("?"), q)).otherwise(""),
                        F.when(f != "", F.concat(F.lit("#"), f)).otherwise(""))

    prefix = F.concat(F.when(b_scheme != "", F.concat(b_scheme, F.lit(":"))).otherwise(""),
                      F.when(b_auth != "", F.concat(F.lit("//"), b_auth)).otherwise(""))
    base_parts = F.split(b_path, "/")
    base_dir = F.when(F.element_at(base_parts, -1) != "", F.slice(base_parts, 1, F.size(base_parts) - 1)).otherwise(base_parts)
    rel = F.concat(base_dir, F.split(r_path, "/"))
    n = F.size(rel)
    rel = F.filter(rel, lambda s, i: (i == 0) | (i == n - 1) | (s != ""))
    segs = F.when(F.startswith(r_path, F.lit("/")), F.split(r_path, "/")).otherwise(rel)
    path = F.array_join(remove_dot_segments(segs), "/")
    path = F.when(path == "", F.lit("/")).otherwise(path)
    path = F.when((b_auth != "") & ~F.startswith(path, F.lit("/")), F.concat(F.lit("/"), path)).otherwise(path)
    return (
        F.when(ref.isNull() | page.isNull(), F.lit(None).cast("string"))
        .when(ref == "", page)
        .when((r_scheme != "") & (F.lower(r_scheme) != F.lower(b_scheme)), ref)
        .when(r_has_auth, F.when(r_scheme != "", ref).otherwise(F.concat(b_scheme, F.lit(":"), ref)))
        .when(r_path == "", F.concat(prefix, b_path, tail(F.when(r_query != "", r_query).otherwise(b_query), r_frag)))
        .otherwise(F.concat(prefix, path, tail(r_query, r_frag)))
    )


def duck_resolve_url(page: str, ref: str) -> str:
    """DuckDB oracle text for references without dot segments (absolute, ``//host``, ``/path``, relative)."""
    rx = URI_RE.replace("'", "''")
    bs, ba, bp = (f"regexp_extract({page}, '{rx}', {i})" for i in (2, 4, 5))
    return (
        f"CASE WHEN {ref} = '' THEN {page} "
        f"WHEN regexp_matches({ref}, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN {ref} "
        f"WHEN starts_with({ref}, '//') THEN concat({bs}, ':', {ref}) "
        f"WHEN starts_with({ref}, '/') THEN concat({bs}, '://', {ba}, {ref}) "
        f"ELSE concat({bs}, '://', {ba}, CASE WHEN {bp} = '' THEN '/' ELSE regexp_replace({bp}, '[^/]*$', '') END, {ref}) END"
    )
