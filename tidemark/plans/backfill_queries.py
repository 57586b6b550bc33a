"""Backfills of sources whose pages are landed from the events: hourly points of a day make a page (so a
page is bounded by its 24 hours), pages lie in day folders as a fetcher would leave them, the backfill
reads the days of its window and the query reads the stored table."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans import landed
from tidemark.plans.backfill import run_backfill
from tidemark.plans.registry import finish, load, register
from tidemark.session import scratch_path
from tidemark.store import TableStore

#: A window within the events' days, as one query's feature; the others take in all days that there are.
PART = (date(2024, 1, 5), date(2024, 1, 20))
STAMP = datetime(2024, 2, 1, tzinfo=timezone.utc)
WINDOW_SQL = "BETWEEN DATE '2024-01-05' AND DATE '2024-01-19'"


def hourly(spark: SparkSession, sf_dir: str, *keys: str) -> DataFrame:
    """``(keys, h, total, n)``: sum and number of the events of an hour."""
    events = load(spark, sf_dir, "events").withColumn("h", F.date_trunc("hour", landed.utc("ts")))
    return events.groupBy(*keys, "h").agg(F.round(F.sum("value"), 2).alias("total"), F.count("*").alias("n"))


def land(points: DataFrame, item: Column, folder: str, prefix: str = "[", suffix: str = "]", **parts: Column) -> None:
    """One page a day (and value of ``parts``) of ``points`` by hour, as a file under its folders."""
    names = list(parts)
    days = (points.withColumns(parts).groupBy(F.to_date("h").alias("dt"), *names)
            .agg(F.array_sort(F.collect_list(F.struct("h", item.alias("t")))).alias("xs")))
    page = F.concat(F.lit(prefix), F.array_join(F.transform("xs", lambda x: x["t"]), ","), F.lit(suffix))
    days.select("dt", *names, page.alias("value")).repartition("dt", *names).write.mode("append").partitionBy("dt", *names).text(folder)


def all_days(spark: SparkSession, sf_dir: str) -> tuple[date, date]:
    """The events' first day, and the day after their last."""
    first, last = load(spark, sf_dir, "events").agg(F.min(F.to_date("ts")), F.max(F.to_date("ts"))).first()
    return first, last + timedelta(days=1)


def backfilled(spark: SparkSession, source: str, table: str, landing: str, window: tuple[date, date]) -> DataFrame:
    """The stored table after the backfill of the window, run twice (the second run finds nothing new)."""
    store = TableStore(spark, scratch_path(spark, f"backfill-{source}"))
    first = run_backfill(spark, landing, store, source, *window, source_updated_at=STAMP, tables=(table,))
    again = run_backfill(spark, landing, store, source, *window, source_updated_at=STAMP, tables=(table,))
    assert first[table] > 0 and again[table] == 0
    return finish(store.read(table))


def _ms() -> Column:
    return F.unix_millis("h").cast("string")


HOURLY_SQL = "SELECT date_trunc('hour', ts) AS h, round(sum(value), 2) AS total FROM events GROUP BY 1"


@register("backfill_volatility_index", f"""
WITH p AS ({HOURLY_SQL})
SELECT CAST(h AS DATE) AS date, arg_max(total, h) AS dvol, TIMESTAMP '2024-02-01 00:00:00' AS source_updated_at
FROM p GROUP BY 1
""")
def backfill_volatility_index(spark: SparkSession, sf_dir: str):
    """Index candles by hour; the last of a day counts."""
    root = scratch_path(spark, "landing")
    land(hourly(spark, sf_dir), F.format_string("[%s,1,2,3,%s]", _ms(), F.col("total").cast("string")), f"{root}/sentiment_index",
         '{"result": {"data": [', "]}}", kind=F.lit("dvol"))
    return backfilled(spark, "sentiment_index", "raw.deribit_dvol", root, all_days(spark, sf_dir))


@register("backfill_blockchain_charts", f"""
SELECT event_type AS chart_name, CAST(ts AS DATE) AS date, CAST(count(*) AS DOUBLE) AS value,
       TIMESTAMP '2024-02-01 00:00:00' AS source_updated_at
FROM events GROUP BY 1, 2
""")
def backfill_blockchain_charts(spark: SparkSession, sf_dir: str):
    """A chart for each event type with a point a day."""
    root = scratch_path(spark, "landing")
    daily = hourly(spark, sf_dir, "event_type").groupBy("event_type", F.date_trunc("day", "h").alias("h")).agg(F.sum("n").alias("n"))
    land(daily, F.to_json(F.struct(F.unix_seconds("h").alias("x"), F.col("n").alias("y"))), f"{root}/onchain_metrics",
         '{"values": [', "]}", chart=F.col("event_type"))
    return backfilled(spark, "onchain_metrics", "raw.blockchain_charts", root, all_days(spark, sf_dir))


@register("backfill_futures_metrics", f"""
WITH p AS ({HOURLY_SQL}), d AS (SELECT CAST(h AS DATE) AS date, arg_max(total, h) AS v FROM p GROUP BY 1)
SELECT 'BTC' AS instrument, 'USDT' AS counterpart, date, CASE WHEN dayofweek(date) <> 0 THEN v END AS open_interest,
       CASE WHEN dayofweek(date) <> 6 THEN v END AS basis, v AS premium_index
FROM d
""")
def backfill_futures_metrics(spark: SparkSession, sf_dir: str):
    """Three kinds of pages a day, assembled; one kind rests on Sundays, one on Saturdays."""
    root = scratch_path(spark, "landing")
    points, value = hourly(spark, sf_dir), F.col("total").cast("string")
    folder = f"{root}/futures_metrics"
    on = lambda resting: points.filter(F.dayofweek("h") != resting)
    land(on(1), F.to_json(F.struct(F.unix_millis("h").alias("timestamp"), value.alias("sumOpenInterest"))), folder, kind=F.lit("open_interest"))
    land(on(7), F.to_json(F.struct(F.unix_millis("h").alias("timestamp"), value.alias("basis"))), folder, kind=F.lit("basis"))
    land(points, F.format_string('[%s,"0","0","0","%s"]', _ms(), value), folder, kind=F.lit("premium"))
    return backfilled(spark, "futures_metrics", "raw.futures_metrics", root, all_days(spark, sf_dir))


@register("backfill_macro_calendar", f"""
SELECT DISTINCT '10:' || strftime(ts, '%Y-%m-%d') AS event_id, date_trunc('day', ts)::TIMESTAMP AS event_time_utc,
       'Consumer Price Index' AS title, TIMESTAMP '2024-02-01 00:00:00' AS source_updated_at
FROM events
""")
def backfill_macro_calendar(spark: SparkSession, sf_dir: str):
    """A release on every day with events."""
    root = scratch_path(spark, "landing")
    days = hourly(spark, sf_dir).select(F.date_trunc("day", "h").alias("h")).distinct()
    land(days, F.to_json(F.struct(F.date_format("h", "yyyy-MM-dd").alias("date"))), f"{root}/macro_calendar",
         '{"release_dates": [', "]}", release=F.lit("10"))
    return backfilled(spark, "macro_calendar", "raw.macro_calendar", root, all_days(spark, sf_dir))


@register("backfill_market_metrics", f"""
WITH p AS (SELECT date_trunc('hour', ts) AS h, 1 + count(*) AS n, CAST(1 + count(*) FILTER (WHERE event_type = 'click') AS DOUBLE) AS c FROM events GROUP BY 1)
SELECT CAST(h AS DATE) AS date, arg_max(c / n * 100, h) AS btc_dominance_pct,
       CAST(CAST(h AS DATE) AS TIMESTAMP) AS source_updated_at
FROM p WHERE CAST(h AS DATE) {WINDOW_SQL} GROUP BY 1
""")
def backfill_market_metrics(spark: SparkSession, sf_dir: str):
    """The share of clicks by hour; the last of a day counts."""
    root = scratch_path(spark, "landing")
    points = (load(spark, sf_dir, "events").groupBy(F.date_trunc("hour", landed.utc("ts")).alias("h"))
              .agg((1 + F.count_if(F.col("event_type") == "click")).alias("c"), (1 + F.count("*")).alias("n")))
    folder = f"{root}/market_metrics"
    land(points, F.format_string("[%s,%s]", _ms(), F.col("c").cast("string")), folder, '{"market_caps": [', "]}", kind=F.lit("asset"))
    land(points, F.format_string("[%s,%s]", _ms(), F.col("n").cast("string")), folder, '{"market_cap_chart": {"market_cap": [', "]}}", kind=F.lit("total"))
    return backfilled(spark, "market_metrics", "raw.market_metrics", root, PART)
