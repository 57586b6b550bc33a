"""Aggregations with map-side partials (``sum``, ``count_if``, ``max_by``/``min_by`` all merge
partially), so a hot key holding a third of the rows still sends only one partial row per task.
They are hash aggregates as long as what they carry has a fixed width; a text among the carried
columns makes Spark sort instead, so callers carry an id and join the text back where it is long."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def conditional_sum(value: Column, cond: Column) -> Column:
    """``sum(value where cond)``, missing value counted as 0."""
    return F.sum(F.when(cond, F.coalesce(value, F.lit(0.0))).otherwise(F.lit(0.0)))


def latest_by(df: DataFrame, keys: Sequence[str], order: str | Column, cols: Sequence[str]) -> DataFrame:
    """Latest record per key: the row with the greatest ``order`` (payload position or timestamp).

    Every column takes the same row: all of them compare the same order in the same way."""
    order_c = F.col(order) if isinstance(order, str) else order
    return df.groupBy(*keys).agg(*(F.max_by(c, order_c).alias(c) for c in cols))


def last_value_per_day(df: DataFrame, ts: str, value: str, order: str | None = None,
                       day_col: str = "date", keys: Sequence[str] = ()) -> DataFrame:
    """Per (keys, day): the value of the last record (greatest ``order``; default the timestamp)."""
    order_c = F.col(order) if order else F.col(ts)
    return (df.withColumn(day_col, F.to_date(F.col(ts)))
            .groupBy(*keys, day_col).agg(F.max_by(F.col(value), order_c).alias(value)))


def run_counters(df: DataFrame, *, kept: Column | None = None, latest_of: Sequence[str] = ()) -> DataFrame:
    """One row: raw rows, kept rows and the latest (max) value of each column over
    the kept rows (run metrics), in one aggregate."""
    aggs = [F.count(F.lit(1)).cast("long").alias("raw_rows")]
    if kept is not None:
        aggs.append(F.count_if(kept).cast("long").alias("kept_rows"))
    aggs += [F.max(F.when(kept, F.col(c)) if kept is not None else F.col(c)).alias(f"latest_{c}") for c in latest_of]
    return df.agg(*aggs)


def observed(seen: Observation, name: str) -> int:
    """A count that was taken while a query ran; waits for its end.  0 if the query was found to have no
    rows before it ran, which leaves nothing to observe."""
    return seen.get[name] if seen._jo.getRow().length() else 0
