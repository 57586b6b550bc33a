"""Number parsing with the sources' sentinel rules.  All ``try_*``: a bad value
gives null, and strict jobs turn a null required value into a bad-row flag."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.casts import try_cast

# Text that means "no number" in the sources.
MISSING_MACRO = ("", ".")              # macro observations
SKIP_FLOW_CELLS = ("", "-", "N/A")     # ETF table cells
FLOW_STRIP_CHARS = ",$"                # thousands separator and currency sign
FLOW_UNIT = 1_000_000.0                # ETF flows are published in USD millions


def optional_double(c: Column) -> Column:
    """Null when missing or ``""``; otherwise the number (null if unparsable)."""
    text = c.cast("string")
    return F.when(text.isNull() | (text == ""), F.lit(None).cast("double")).otherwise(try_cast(text, "double"))


def optional_double_strict_empty(c: Column) -> Column:
    """Null only when missing; ``""`` is not a number (null + bad flag in strict jobs)."""
    return try_cast(c.cast("string"), "double")


def macro_value(c: Column) -> Column:
    """Null for missing, ``""`` and ``"."``."""
    text = c.cast("string")
    return F.when(text.isNull() | text.isin(*MISSING_MACRO), F.lit(None).cast("double")) \
        .otherwise(try_cast(text, "double"))


def int_via_double(c: Column) -> Column:
    """Integer through float, truncating toward zero (``"6000.0"`` -> 6000); null for missing/``""``."""
    text = c.cast("string")
    as_double = F.when(text.isNull() | (text == ""), F.lit(None).cast("double")).otherwise(try_cast(text, "double"))
    finite = as_double.isNotNull() & ~F.isnan(as_double) & (F.abs(as_double) < F.lit(9.2e18))
    return F.when(finite, as_double.cast("long"))


def unparsable(c: Column, missing: tuple[str, ...] = ("",)) -> Column:
    """True for text that is there, is none of the ``missing`` marks, and is no number."""
    text = c.cast("string")
    return F.coalesce(~text.isin(*missing) & try_cast(text, "double").isNull(), F.lit(False))


def not_integral(c: Column) -> Column:
    """True where :func:`int_via_double` gets something that it cannot make an integer of (not a number,
    not finite)."""
    text = c.cast("string")
    return F.coalesce((text != "") & int_via_double(c).isNull(), F.lit(False))


def flow_cell_text(c: Column) -> Column:
    return F.trim(F.translate(c, FLOW_STRIP_CHARS, ""))


def flow_millions(c: Column) -> Column:
    """``"1,234.5"`` / ``"$12"`` -> value * 1e6; skipped cells and bad text -> null."""
    text = flow_cell_text(c)
    return F.when(~text.isin(*SKIP_FLOW_CELLS), try_cast(text, "double") * F.lit(FLOW_UNIT))


def guarded_ratio(num: Column, den: Column) -> Column:
    """``num / den`` when ``den > 0`` else null."""
    return F.when(den > 0, num / den)


def null_safe_total(*cols: Column) -> Column:
    """Nulls count as zero; a zero total becomes null."""
    total = None
    for c in cols:
        term = F.coalesce(c, F.lit(0.0))
        total = term if total is None else total + term
    return F.nullif(total, F.lit(0.0))
