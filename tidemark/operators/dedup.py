"""First-wins deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_wins(df: DataFrame, key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first in ``order`` (e.g. feed position, item position; nulls last).

    ``min_by`` is a partial aggregate, so duplicates are collapsed map-side before the shuffle - a key
    repeated across a third of the input costs one partial row per task, not a group in one task.  All
    columns compare the same order, so they come from one row."""
    keys = [key] if isinstance(key, str) else list(key)
    place = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    return df.groupBy(*keys).agg(*(F.min_by(c, place).alias(c) for c in df.columns if c not in keys)).select(*keys, *(c for c in df.columns if c not in keys))
