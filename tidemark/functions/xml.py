"""Well-formedness of XML text, as a column: no parser runs, and nothing is raised."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NAME = r"[A-Za-z_:\x{80}-\x{10FFFF}][\w:.\-\x{80}-\x{10FFFF}]*"
_ATTRIBUTES = rf"""(?:\s+{_NAME}\s*=\s*(?:"[^"<]*"|'[^'<]*'))*+"""
#: What is not markup of elements: declarations, instructions, comments, CDATA, a document type.
_ASIDE = r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>|<\?.*?\?>|<!DOCTYPE(?:[^>\[\"']|\"[^\"]*\"|'[^']*')*(?:\[[^\]]*\])?\s*>"
_TAG = rf"</{_NAME}\s*>|<{_NAME}{_ATTRIBUTES}\s*/?>"
_BARE_AMPERSAND = r"&(?!(?:#[0-9]+|#x[0-9A-Fa-f]+|amp|lt|gt|quot|apos);)"


def well_formed(xml: Column) -> Column:
    """Whether a text is one XML element with its tags in order, and nothing but markup asides around it.

    The tags are folded over a stack, kept as a path: a start tag adds a step, an end tag has to be that
    of the last step, an empty element changes nothing.  Null and empty texts are not well formed; an
    attribute that is given twice and characters that XML does not allow are let through."""
    body = F.regexp_replace(F.regexp_replace(xml, "^﻿", ""), _ASIDE, "")
    tags = F.regexp_extract_all(body, F.lit(_TAG), F.lit(0))
    between = F.regexp_replace(body, _TAG, "")

    def step(state: Column, tag: Column) -> Column:
        name = F.regexp_extract(tag, _NAME, 0)
        last = F.concat(F.lit("/"), name)
        path, roots = state["path"], state["roots"]
        closing, empty, outside = tag.startswith("</"), tag.endswith("/>"), F.length(path) == 0
        fits = closing & path.endswith(last)
        return F.struct(
            F.when(fits, F.left(path, F.length(path) - F.length(last))).when(closing | empty, path).otherwise(F.concat(path, last)).alias("path"),
            (roots + F.when(~closing & outside, F.lit(1)).otherwise(F.lit(0))).alias("roots"),
            (state["ok"] & (~closing | fits)).alias("ok"))

    start = F.struct(F.lit("").alias("path"), F.lit(0).alias("roots"), F.lit(True).alias("ok"))
    folded = F.aggregate(tags, start, step, lambda s: s["ok"] & (s["path"] == "") & (s["roots"] == 1))
    sound = folded & ~between.contains("<") & ~F.regexp_like(body, F.lit(_BARE_AMPERSAND)) & F.regexp_like(body, F.lit(r"(?s)^\s*<.*>\s*$"))
    return F.coalesce(sound, F.lit(False))
