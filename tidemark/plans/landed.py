"""Payload datasets derived by Spark from the driver tables.

The jobs read landed source payloads (JSON pages, HTML pages, XML feeds).  For
queries over the given tables these payloads are derived from them here, in
Spark, so the work grows with the tables.  Page sizes are bounded by
construction (a day of hourly bars, a month of daily rows, a block of at most
``PAGE_ITEMS`` consecutive events), so no page ever gathers an unbounded group
into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PAGE_ITEMS = 50          # items per landed page for event-derived payloads
MS_PER_HOUR = 3_600_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def utc(c: str | Column) -> Column:
    """Driver tables hold ``timestamp_ntz`` wall-clock UTC; jobs use UTC instants."""
    return (F.col(c) if isinstance(c, str) else c).cast("timestamp")


def _num(c: Column) -> Column:
    return c.cast("string")


def bars(events: DataFrame) -> DataFrame:
    """Hourly OHLC bars per event type (test fixture, not a source operator)."""
    ts = utc("ts")
    return (events.select("event_type", ts.alias("ts"), "value")
            .groupBy("event_type", F.date_trunc("hour", F.col("ts")).alias("open_time"))
            .agg(F.min_by("value", "ts").alias("open"), F.max("value").alias("high"),
                 F.min("value").alias("low"), F.max_by("value", "ts").alias("close"),
                 F.round(F.sum("value"), 2).alias("volume"), F.count(F.lit(1)).alias("trades")))


def kline_json(b: DataFrame, open_text: Column | None = None) -> Column:
    """Positional kline text: numbers for times/trades, strings for prices."""
    open_ms = F.unix_millis(F.col("open_time"))
    return F.format_string(
        '[%d,"%s","%s","%s","%s","%s",%d,"%s",%d,"%s","%s","0"]',
        open_ms, open_text if open_text is not None else _num(F.col("open")), _num(F.col("high")), _num(F.col("low")), _num(F.col("close")),
        _num(F.col("volume")), open_ms + F.lit(MS_PER_HOUR - 1), _num(F.col("volume") * 2), F.col("trades"),
        _num(F.col("volume") / 2), _num(F.col("volume") / 4))


def kline_pages(events: DataFrame, open_text=None) -> DataFrame:
    """One JSON page per (event type, day) with that day's hourly klines in time order.
    ``open_text(bars) -> Column`` may replace the open field (malformed-payload tests)."""
    b = bars(events)
    k = kline_json(b, open_text(b) if open_text is not None else None)
    return (b.select("event_type", F.to_date("open_time").alias("day"),
                     F.struct(F.col("open_time"), k.alias("k")).alias("kl"))
            .groupBy("event_type", "day")
            .agg(F.array_sort(F.collect_list("kl")).alias("kls"))
            .select(F.col("event_type").alias("instrument"), "day",
                    F.concat(F.lit("["), F.array_join(F.transform("kls", lambda x: x["k"]), ","),
                             F.lit("]")).alias("payload")))


def event_pages(events: DataFrame, item: Column, *, by: tuple[str, ...] = ("event_type",),
                order: str = "event_id", sep: str = ",", prefix: str = "[", suffix: str = "]") -> DataFrame:
    """Generic event-derived pages: ``PAGE_ITEMS`` consecutive events per page."""
    page_no = F.floor(F.col(order) / F.lit(PAGE_ITEMS)).alias("page_no")
    return (events.select(*by, page_no, F.struct(F.col(order).alias("o"), item.alias("t")).alias("x"))
            .groupBy(*by, "page_no")
            .agg(F.array_sort(F.collect_list("x")).alias("xs"))
            .select(*by, "page_no",
                    F.concat(F.lit(prefix), F.array_join(F.transform("xs", lambda x: x["t"]), sep),
                             F.lit(suffix)).alias("payload")))
