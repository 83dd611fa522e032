"""Scalar column expressions used by the jobs (all JVM-side built-ins, no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from svgspark.functions.util import as_col

# Digest names accepted by content_hash and the Spark built-in behind each.
HASH_ALGORITHMS = {
    "md5": lambda c: F.md5(c),
    "sha1": lambda c: F.sha1(c),
    "sha224": lambda c: F.sha2(c, 224),
    "sha256": lambda c: F.sha2(c, 256),
    "sha384": lambda c: F.sha2(c, 384),
    "sha512": lambda c: F.sha2(c, 512),
}


def content_hash(c, algorithm: str = "md5") -> Column:
    """Lower-case hex digest of the UTF-8 text (or bytes). Unknown algorithms fail at plan time."""
    algo = algorithm.lower().replace("-", "")
    if algo not in HASH_ALGORITHMS:
        raise ValueError(f"unsupported hash algorithm {algorithm!r}; choose one of {sorted(HASH_ALGORITHMS)}")
    return HASH_ALGORITHMS[algo](as_col(c))


def shard_of(hash_col, prefix_len: int = 2) -> Column:
    return F.substring(as_col(hash_col), 1, prefix_len)


def strip_backslash(c) -> Column:
    return F.translate(as_col(c), "\\", "")


def numeric_text(c) -> Column:
    """Letters removed, then parsed as a double; NULL when that fails (``50%``, ``1e-5``)."""
    return F.regexp_replace(as_col(c), "[A-Za-z]", "").try_cast("double")


def numeric_unit(c) -> Column:
    """The trailing unit of a length (``px``, ``%``, ``em`` ...), empty when unitless."""
    return F.regexp_extract(as_col(c), r"([A-Za-z]+|%)\s*$", 1)


def strip_ws(c) -> Column:
    """White space removed at both ends (``trim`` alone removes spaces only)."""
    return F.regexp_replace(as_col(c), r"^\s+|\s+$", "")


def style_map(c, whole: bool = False) -> Column:
    """``k:v;k:v`` -> MAP, both sides trimmed, last key wins. Pieces without exactly one ``:`` are dropped.

    ``whole``: values may hold ``:``, and ``;`` inside parentheses, as in ``fill:url(http://a/b#c)``.
    """
    if whole:
        kept = F.filter(F.split(as_col(c), r";(?![^(]*\))"), lambda p: F.locate(":", p) > 1)
    else:
        kept = F.filter(F.split(as_col(c), ";"), lambda p: F.size(F.split(p, ":")) == 2)
    pieces = F.transform(kept, lambda p: F.struct(
        strip_ws(F.split(p, ":", 2)[0]).alias("key"), strip_ws(F.split(p, ":", 2)[1]).alias("value")))
    # keep the last occurrence of every key so the map has unique keys
    last = F.filter(
        pieces,
        lambda e, i: ~F.exists(F.filter(pieces, lambda x, j: j > i), lambda x: x["key"] == e["key"]),
    )
    return F.when(as_col(c).isNull(), F.lit(None)).otherwise(F.map_from_entries(last))


def style_text(m) -> Column:
    """MAP -> ``k:v;k:v`` in key order of the map."""
    return F.array_join(F.transform(F.map_entries(as_col(m)), lambda e: F.concat(e["key"], F.lit(":"), e["value"])), ";")


def local_name(tag) -> Column:
    """``{ns}tag`` or ``ns:tag`` -> ``tag``."""
    return F.regexp_replace(as_col(tag), r"^.*[:}]", "")


# Caption prefixes removed once, case-insensitively, after trimming.
CAPTION_PREFIX_RE = r"(?i)^(Caption:|Description:|Image shows:)\s*"


def caption_clean(c) -> Column:
    """Trim white space at both ends, then drop one leading caption prefix."""
    return F.regexp_replace(strip_ws(c), CAPTION_PREFIX_RE, "")


def prompt_text(style, focus, max_words) -> Column:
    return F.format_string(
        "Describe this %s in %s words or less, %s style. Response in English.",
        as_col(focus), as_col(max_words).cast("string"), as_col(style),
    )


def uniform_u32(*parts) -> Column:
    """Deterministic pseudo-random integer in [0, 2^32) from md5 of the parts joined by ``|``."""
    key = F.concat_ws("|", *[as_col(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint")


def uniform01(*parts) -> Column:
    """Deterministic pseudo-random double in [0, 1)."""
    return uniform_u32(*parts) / F.lit(4294967296.0)


# Canonical camelCase element names restored before rendering (lower-cased by parsers).
CAMEL_TAGS = ["linearGradient", "radialGradient", "clipPath", "textPath", "foreignObject"]


def fix_for_render(svg) -> Column:
    """``xlink:href`` -> ``href``; camelCase element names restored; ``viewBox="0 0 w h"`` added from the
    root width/height when the root has no viewBox."""
    s = F.replace(as_col(svg), F.lit("xlink:href="), F.lit("href="))
    for t in CAMEL_TAGS:
        s = F.regexp_replace(s, "(?i)(</?)" + t + r"\b", "$1" + t)
    w = F.regexp_extract(s, r'<svg[^>]*\swidth="([^"]*)"', 1)
    h = F.regexp_extract(s, r'<svg[^>]*\sheight="([^"]*)"', 1)
    has_vb = s.rlike(r"<svg[^>]*\sviewBox=")
    has_size = s.rlike(r'<svg[^>]*\swidth="[^"]*"[^>]*\sheight="[^"]*"')
    vb = F.concat(F.lit('<svg viewBox="0 0 '), w, F.lit(" "), h, F.lit('"'))
    return F.when(has_vb, s).when(has_size, F.overlay(s, vb, F.locate("<svg", s), F.lit(4))).otherwise(s)
