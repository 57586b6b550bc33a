"""Time-window filters.  All are plain predicates on the scan, so Catalyst
pushes them into the Parquet reader (row-group skipping) and, on partition
columns, prunes directories.

Rows that a strict source flagged as bad (``_bad``) pass every window: their time
may be the very thing that is wrong, and the strict test has to see them."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _within(df: DataFrame, condition: Column) -> DataFrame:
    return df.filter(condition | F.col("_bad")) if "_bad" in df.columns else df.filter(condition)


def window_inclusive(df: DataFrame, col: str | Column, start, end) -> DataFrame:
    """``start <= t <= end`` (source request bounds, check windows)."""
    return _within(df, _c(col).between(F.lit(start), F.lit(end)))


def window_half_open(df: DataFrame, col: str | Column, start, end) -> DataFrame:
    """``start <= t < end`` (backfill windows; ``end`` exclusive)."""
    c = _c(col)
    return _within(df, (c >= F.lit(start)) & (c < F.lit(end)))


def lookback_window(df: DataFrame, col: str | Column, run_date: date, days: int) -> DataFrame:
    """``run_date - days <= d <= run_date``."""
    return _within(df, _c(col).between(F.lit(run_date - timedelta(days=days)), F.lit(run_date)))


def run_day_rows(df: DataFrame, col: str | Column, run_date: date) -> DataFrame:
    return _within(df, _c(col) == F.lit(run_date))


def since_filter(df: DataFrame, col: str | Column, since=None) -> DataFrame:
    """Optional lower bound: no predicate at all when ``since`` is None."""
    return df if since is None else _within(df, _c(col) >= F.lit(since))


def closed_bars(df: DataFrame, *, open_col: str = "open_time", close_col: str = "close_time",
                window_start: datetime | None = None, window_end: datetime | None = None,
                as_of: datetime) -> DataFrame:
    """Keep bars that closed before ``as_of``; the requested window end is clamped
    to ``as_of - 1 ms``, and an inverted window gives no rows."""
    out = _within(df, F.col(close_col) < F.lit(as_of))
    if window_start is not None or window_end is not None:
        end = as_of - timedelta(milliseconds=1)
        if window_end is not None:
            end = min(window_end, end)
        start = window_start if window_start is not None else datetime.min
        if start > end:
            return _within(out, F.lit(False))
        out = _within(out, F.col(open_col).between(F.lit(start), F.lit(end)))
    return out
