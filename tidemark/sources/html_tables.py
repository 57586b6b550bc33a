"""HTML tables -> rows of cell text, and the header-row search.

Each page is handled inside its own row with regex extraction and higher-order array functions
(``transform``/``filter``/``array_position``), in one pass: no join, no shuffle, no Python, and the work
is spread by pages across tasks.  Comments are left out first; all numeric character references and the
named ones of HTML 4 are decoded.
"""

from __future__ import annotations

from html.entities import html5, name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A row counts only when closed by </tr>; a new <tr> discards an unclosed one.
# A cell counts only when closed by </td>/</th>; a new cell start restarts it.
_ATTRIBUTES = r"""(?:\s(?:[^>"']|"[^"]*"|'[^']*')*)?"""
ROW_PATTERN = rf"(?is)<tr{_ATTRIBUTES}>((?:(?!<tr[\s>]).)*?)</tr\s*>"
CELL_PATTERN = rf"(?is)<t[dh]{_ATTRIBUTES}>((?:(?!<t[dh][\s>]).)*?)</t[dh]\s*>"
COMMENT_PATTERN = r"(?s)<!--.*?-->"
REFERENCE_PATTERN = r"&(?:#[0-9]{1,7};?|#[xX][0-9a-fA-F]{1,6};?|[A-Za-z][A-Za-z0-9]{1,8};?)"


def _named_references() -> Column:
    """The named references of HTML 4 as a map, in each of the forms that the standard library knows."""
    known = {f"&{name}": char for name, char in html5.items() if name.rstrip(";") in name2codepoint}
    return F.create_map(*(F.lit(x) for pair in known.items() for x in pair))


def _character(reference: Column) -> Column:
    """What a reference stands for; itself if that is nothing."""
    digits = F.regexp_extract(reference, "[0-9a-fA-F]+;?$", 0)
    code = F.when(F.lower(F.substring(reference, 3, 1)) == "x", F.conv(F.rtrim(digits, F.lit(";")), 16, 10)) \
        .otherwise(F.rtrim(digits, F.lit(";"))).try_cast("int")
    char = F.when(code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF), F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
    return F.coalesce(F.when(F.startswith(reference, F.lit("&#")), char), F.try_element_at(_named_references(), reference), reference)


def decoded(text: Column) -> Column:
    """Text with its character references replaced, left to right, each once."""
    between = F.split(text, REFERENCE_PATTERN)
    references = F.transform(F.regexp_extract_all(text, F.lit(REFERENCE_PATTERN), 0), _character)
    woven = F.array_join(F.transform(between, lambda t, k: F.concat(t, F.coalesce(F.get(references, k), F.lit("")))), "")
    return F.when(F.contains(text, F.lit("&")), woven).otherwise(text)


def cell_text(raw: Column) -> Column:
    """Text of one cell: tags removed, character references decoded, white space stripped."""
    return F.regexp_replace(decoded(F.regexp_replace(raw, r"(?s)<[^>]*>", "")), r"^[\s\u00A0]+|[\s\u00A0]+$", "")


def table_rows(html: Column) -> Column:
    """``array<array<string>>``: every ``<tr>`` of every table, in page order; empty rows dropped."""
    rows = F.regexp_extract_all(F.regexp_replace(html, COMMENT_PATTERN, ""), F.lit(ROW_PATTERN), 1)
    cells = F.transform(rows, lambda r: F.transform(F.regexp_extract_all(r, F.lit(CELL_PATTERN), 1), cell_text))
    return F.filter(cells, lambda r: F.size(r) > 0)


def header_search(rows: Column, *names: str) -> tuple[Column, list[Column]]:
    """1-based position of the first row whose lower-cased cells contain all ``names``
    (0 when none), and the 0-based index of each name in that row."""
    lowered = F.transform(rows, lambda r: F.transform(r, lambda c: F.lower(F.trim(c))))

    def has_all(r: Column) -> Column:
        cond = F.lit(True)
        for n in names:
            cond = cond & F.array_contains(r, n)
        return cond

    header_pos = F.array_position(F.transform(lowered, has_all), True)
    header = F.get(lowered, (header_pos - 1).cast("int"))
    idx = [(F.array_position(header, n) - 1).cast("int") for n in names]
    return header_pos, idx


def rows_after_header(df: DataFrame, html: str, *names: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """One output row per table row after the header row; columns ``row_pos`` (0-based), ``cells``, and
    ``idx_<name>`` for each header name.  Pages without a header row give no rows."""
    staged = df.select(*keep, table_rows(F.col(html)).alias("_rows"))
    header_pos, idx = header_search(F.col("_rows"), *names)
    staged = staged.select(*keep, "_rows", header_pos.alias("_hdr"), *[i.alias(f"idx_{n}") for i, n in zip(idx, names)]).filter(F.col("_hdr") > 0)
    exploded = staged.select(*keep, "_hdr", *[f"idx_{n}" for n in names], F.posexplode("_rows").alias("row_pos", "cells"))
    widest = F.greatest(*[F.col(f"idx_{n}") for n in names], F.lit(0))
    return (exploded.filter(F.col("row_pos") >= F.col("_hdr"))          # strictly after the header
            .filter(F.size("cells") > widest)                           # too few cells: skipped
            .drop("_hdr"))
