"""Daily runs, one per source family, over landed page DataFrames.

Each is a composition: normaliser -> the source's window rule -> ``run_job``
(strict abort, one-pass validation, gate, keyed upsert, metrics) or
``run_tables`` for sources that feed several tables.  Clocks (``as_of``,
``source_updated_at``) are parameters, never read inside a plan.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.operators.aggregates import observed
from tidemark.operators.dedup import first_wins
from tidemark.operators.windows import closed_bars, lookback_window, run_day_rows, since_filter, window_inclusive
from tidemark.plans import normalize as N
from tidemark.plans.jobs import JobRun, run_job, run_tables
from tidemark.sources.registry import source
from tidemark.store import TableStore
from tidemark.tables import (
    BLOCKCHAIN_CHARTS,
    CANDLES,
    COT_POSITIONING,
    ETF_FLOWS,
    EXCHANGE_FLOWS,
    FUNDING_RATES,
    FUTURES_METRICS,
    LONG_SHORT_RATIO,
    MACRO_CALENDAR,
    MACRO_SERIES,
    MARKET_METRICS,
    MARKET_NEWS_ITEMS,
    ONCHAIN_METRICS,
    PUT_CALL,
    SENTIMENT_INDEX,
    STABLECOIN_SUPPLY,
    VOLATILITY_INDEX,
    quality_checks,
)

UTC = timezone.utc


def _ts(value: datetime) -> Column:
    return F.lit(value).cast("timestamp")


def _midnight(d: date) -> datetime:
    return datetime.combine(d, datetime.min.time(), tzinfo=UTC)


def run_candles(store: TableStore, pages: DataFrame, *, interval: str, window_start: datetime,
                window_end: datetime, as_of: datetime, instrument: str = "BTC", counterpart: str = "USDT") -> JobRun:
    """Klines of one interval; only bars closed before ``as_of`` within the clamped window."""
    rows = N.candles(pages, instrument=F.lit(instrument), counterpart=F.lit(counterpart), interval=F.lit(interval))
    kept = closed_bars(rows, window_start=window_start, window_end=window_end, as_of=as_of)
    res = run_job(store, CANDLES.identifier, kept, quality_checks(CANDLES),
                  max_columns=("close_time",),
                  extra_metrics={"symbol": instrument + counterpart, "interval": interval})
    res.metrics["latest_source_close_time"] = res.metrics.pop("latest_close_time", None)
    return res


def run_funding_rates(store: TableStore, pages: DataFrame, *, window_start: datetime, window_end: datetime,
                      as_of: datetime, instrument: str = "BTC", counterpart: str = "USDT") -> JobRun:
    end = min(window_end, as_of - timedelta(milliseconds=1))
    rows = N.funding_rates(pages, instrument=F.lit(instrument), counterpart=F.lit(counterpart))
    rows = window_inclusive(rows, "funding_time", window_start, end)   # an inverted window holds nothing
    return run_job(store, FUNDING_RATES.identifier, rows, quality_checks(FUNDING_RATES),
                   max_columns=("funding_time",))


def run_futures_metrics(store: TableStore, open_interest: DataFrame, basis: DataFrame, premium: DataFrame, *,
                        window_start: datetime, instrument: str = "BTC", counterpart: str = "USDT") -> JobRun:
    """One row for the window's start date assembled from three sources (all missing = none)."""
    day = window_start.date()
    rows = N.futures_metrics(*(p.withColumn("date", F.lit(day)) if "date" not in p.columns else p
                               for p in (open_interest, basis, premium)),
                             instrument=instrument, counterpart=counterpart)
    return run_job(store, FUTURES_METRICS.identifier, run_day_rows(rows, "date", day), quality_checks(FUTURES_METRICS))


def run_long_short_ratio(store: TableStore, pages: DataFrame, *, window_start: datetime, window_end: datetime,
                         source_updated_at: datetime, instrument: str = "BTC", counterpart: str = "USDT") -> JobRun:
    rows = N.long_short(pages, instrument=F.lit(instrument), counterpart=F.lit(counterpart),
                        source_updated_at=source_updated_at)
    rows = window_inclusive(rows, "date", window_start.date(), window_end.date())
    return run_job(store, LONG_SHORT_RATIO.identifier, rows, quality_checks(LONG_SHORT_RATIO))


def run_cot_positioning(store: TableStore, pages: DataFrame, *, run_date: date, source_updated_at: datetime,
                        market_prefix: str = "BITCOIN -") -> JobRun:
    since = run_date - timedelta(days=source("cot_positioning").lookback_days)
    rows = N.cot_positioning(pages, since=since, market_prefix=market_prefix, source_updated_at=source_updated_at)
    return run_job(store, COT_POSITIONING.identifier, rows, quality_checks(COT_POSITIONING))


def run_etf_flows(store: TableStore, pages: DataFrame, *, run_date: date, source_updated_at: datetime) -> JobRun:
    """All parsable days of the page; the trailing look-back is written."""
    seen = Observation()
    days = N.etf_flows(pages, keep=("page",) if "page" in pages.columns else (),
                       source_updated_at=source_updated_at).select(*ETF_FLOWS.columns).observe(seen, F.count(F.lit(1)).alias("days"))
    window = lookback_window(days, "date", run_date, source("etf_flows").lookback_days)
    res = run_job(store, ETF_FLOWS.identifier, window, quality_checks(ETF_FLOWS))
    available = observed(seen, "days")
    res.metrics.update({"available_days": available, "written_days": res.metrics["rows"],
                        "fetch_status": "ok" if available else "empty_source"})
    return res


def run_exchange_flows(store: TableStore, pages: DataFrame, *, since: date, until: date,
                       source_updated_at: datetime, asset: str = "btc", exchange: str = "all_exchange") -> JobRun:
    rows = N.exchange_flows(pages, asset=F.lit(asset), exchange=F.lit(exchange), source_updated_at=source_updated_at)
    return run_job(store, EXCHANGE_FLOWS.identifier, window_inclusive(rows, "date", since, until),
                   quality_checks(EXCHANGE_FLOWS))


def run_macro_calendar(store: TableStore, pages: DataFrame, releases: DataFrame, *, run_date: date,
                       source_updated_at: datetime) -> JobRun:
    since = _midnight(run_date - timedelta(days=source("macro_calendar").lookback_days))
    rows = N.macro_calendar(pages, releases, source_updated_at=source_updated_at)
    rows = since_filter(rows, "event_time_utc", since)
    return run_job(store, MACRO_CALENDAR.identifier, rows, quality_checks(MACRO_CALENDAR))


def run_macro_series(store: TableStore, pages: DataFrame, *, run_date: date, source_updated_at: datetime) -> JobRun:
    since = run_date - timedelta(days=source("macro_series").lookback_days)
    rows = N.macro_series(pages, since=since, source_updated_at=source_updated_at)
    return run_job(store, MACRO_SERIES.identifier, rows, quality_checks(MACRO_SERIES))


def run_market_metrics(store: TableStore, asset_pages: DataFrame, total_pages: DataFrame, *, run_date: date,
                       snapshot_pct: float | None, snapshot_at: datetime) -> JobRun:
    """Run day from history, else from the snapshot; no snapshot and no history = no row."""
    history = N.dominance_history(asset_pages, total_pages)
    requested = store.spark.range(1).select(F.lit(run_date).alias("date"))
    rows = N.market_metric_rows(history, requested, F.lit(snapshot_pct).cast("double"), snapshot_at)
    rows = rows.filter(F.col("btc_dominance_pct").isNotNull())
    return run_job(store, MARKET_METRICS.identifier, rows, quality_checks(MARKET_METRICS))


def run_stablecoin_supply(store: TableStore, caps: DataFrame, *, run_date: date,
                          source_updated_at: datetime) -> JobRun:
    rows = run_day_rows(N.stablecoin_supply(caps, source_updated_at=source_updated_at).withColumn(
        "date", F.to_date("date")), "date", run_date)
    return run_job(store, STABLECOIN_SUPPLY.identifier, rows, quality_checks(STABLECOIN_SUPPLY))


def run_market_news(store: TableStore, feed_pages: DataFrame, feeds: DataFrame, *, fetched_at: datetime,
                    bodies: DataFrame | None = None) -> JobRun:
    """Items of every feed, first occurrence per content hash (feed order, item
    order), minus stored hashes, then the optional landed bodies by URL."""
    seen = Observation()
    items = N.news_items(feed_pages, xml="payload", keep=("feed_pos",)).observe(seen, F.count(F.lit(1)).alias("items"))
    firsts = first_wins(items, "content_hash", ["feed_pos", "item_pos"]).persist()
    try:
        new = store.unseen(MARKET_NEWS_ITEMS.identifier, firsts)
        feed_cols = feeds.select("feed_pos", "source_name", "source_type", "reliability_tier")
        new = new.join(F.broadcast(feed_cols), "feed_pos", "inner")
        if bodies is not None:
            new = new.join(bodies.select(F.col("url"), F.col("body").alias("content_raw")), "url", "left")
        else:
            new = new.withColumn("content_raw", F.lit(None).cast("string"))
        rows = new.select(
            F.col("url").alias("source_url"), "content_hash", "source_name", "source_domain", "source_type",
            F.col("reliability_tier").cast("long").alias("reliability_tier"), "published_at",
            _ts(fetched_at).alias("fetched_at"), "title", F.col("summary").alias("summary_raw"), "content_raw",
            _ts(fetched_at).alias("source_updated_at"))
        res = run_job(store, MARKET_NEWS_ITEMS.identifier, rows, quality_checks(MARKET_NEWS_ITEMS))
        res.metrics.update({"items_seen": observed(seen, "items"), "items_written": res.metrics["rows"]})
        return res
    finally:
        firsts.unpersist()


def run_onchain_metrics(store: TableStore, metric_pages: DataFrame, chart_pages: DataFrame, charts: DataFrame, *,
                        run_date: date, source_updated_at: datetime) -> JobRun:
    """Metrics for the run day and one row per configured chart (null when the chart
    has no value); each table gated on its own."""
    metrics = run_day_rows(N.onchain_metrics(metric_pages, source_updated_at=source_updated_at), "date", run_date)
    requested = charts.select("chart_name", F.lit(run_date).alias("date"))
    chart_rows = N.chart_first_values(requested, chart_pages.withColumn("date", F.lit(run_date))
                                      if "date" not in chart_pages.columns else chart_pages,
                                      source_updated_at=source_updated_at)
    return run_tables(store, [
        (ONCHAIN_METRICS.identifier, metrics, quality_checks(ONCHAIN_METRICS), "quality"),
        (BLOCKCHAIN_CHARTS.identifier, chart_rows, quality_checks(BLOCKCHAIN_CHARTS), "quality_charts"),
    ])


def run_sentiment_index(store: TableStore, fear_greed_pages: DataFrame, dvol_pages: DataFrame | None,
                        option_book: DataFrame | None, *, run_date: date, source_updated_at: datetime) -> JobRun:
    """Look-back fetch, but only the run day is written (three tables, separate gates)."""
    seen = Observation()
    fg = N.sentiment(fear_greed_pages, source_updated_at=source_updated_at).observe(seen, F.count(F.lit(1)).alias("days"))
    parts = [(SENTIMENT_INDEX.identifier, run_day_rows(fg, "date", run_date), quality_checks(SENTIMENT_INDEX),
              "quality")]
    if dvol_pages is not None:
        dvol = N.volatility_rows(dvol_pages, source_updated_at=source_updated_at)
        parts.append((VOLATILITY_INDEX.identifier, run_day_rows(dvol, "date", run_date),
                      quality_checks(VOLATILITY_INDEX), "quality_dvol"))
    if option_book is not None:
        pc = N.put_call(option_book).select(F.lit(run_date).alias("date"), "put_oi", "call_oi", "put_call_ratio",
                                            _ts(source_updated_at).alias("source_updated_at"))
        parts.append((PUT_CALL.identifier, pc, quality_checks(PUT_CALL), "quality_put_call"))
    res = run_tables(store, parts)
    res.metrics["available_days"] = observed(seen, "days")
    return res
