"""Cast helpers."""

from __future__ import annotations

from pyspark.sql import Column


def try_cast(c: Column, data_type: str) -> Column:
    """ANSI-safe cast: null instead of an error for malformed or overflowing values."""
    return c.try_cast(data_type)
