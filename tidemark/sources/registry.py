"""Source registry and landing convention.

Payloads are landed by a fetcher (outside this library) as files under
``<landing root>/<source>/dt=<yyyy-MM-dd>/page-<n>.<ext>``; a job reads them as
one dataset with ``dt`` partition pruning.  Config lists (feeds, releases,
series, charts) are small literal tables, broadcast into joins.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import file_names


@dataclass(frozen=True)
class Source:
    name: str
    tables: tuple[str, ...]
    fmt: str                      # json | html | xml
    page_size: int | None = None
    page_cap: int | None = None
    lookback_days: int | None = None
    instrument: str | None = None
    counterpart: str | None = None


# Source families, target tables, page sizes, page cap and look-back days.
SOURCES: dict[str, Source] = {s.name: s for s in (
    Source("candles", ("raw.candles",), "json", page_size=1000, instrument="BTC", counterpart="USDT"),
    Source("funding_rates", ("raw.funding_rates",), "json", page_size=1000, instrument="BTC", counterpart="USDT"),
    Source("futures_metrics", ("raw.futures_metrics",), "json", instrument="BTC", counterpart="USDT"),
    Source("long_short_ratio", ("raw.long_short_ratio",), "json", page_size=500, instrument="BTC", counterpart="USDT"),
    Source("cot_positioning", ("raw.cot_positioning",), "json", page_size=1000, lookback_days=30),
    Source("etf_flows", ("raw.etf_flows",), "html", lookback_days=7),
    Source("exchange_flows", ("raw.exchange_flows",), "json"),
    Source("macro_calendar", ("raw.macro_calendar",), "json", page_size=1000, lookback_days=30),
    Source("macro_series", ("raw.macro_series",), "json", lookback_days=14),
    Source("market_metrics", ("raw.market_metrics", "raw.stablecoin_supply"), "json"),
    Source("market_news", ("raw.market_news_items",), "xml"),
    Source("onchain_metrics", ("raw.onchain_metrics", "raw.blockchain_charts"), "json", page_size=10000,
           instrument="BTC", counterpart="USD"),
    Source("sentiment_index", ("raw.sentiment_index", "raw.deribit_dvol", "raw.deribit_put_call"), "json",
           page_cap=50, lookback_days=7),
)}

# Candle intervals.
CANDLE_INTERVALS = ("1d", "1w", "4h", "1h")

# News feeds (name, url, source type, reliability tier).
FEEDS = (
    ("SEC press releases", "https://www.sec.gov/news/pressreleases.rss", "official", 1),
    ("Federal Reserve press", "https://www.federalreserve.gov/feeds/press_all.xml", "official", 1),
    ("CoinDesk", "https://www.coindesk.com/arc/outboundfeeds/rss/", "rss_news", 3),
    ("Cointelegraph", "https://cointelegraph.com/rss", "rss_news", 3),
)

# Macro calendar releases (release id, name).
RELEASES = (
    (10, "Consumer Price Index"),
    (50, "Employment Situation"),
    (53, "Gross Domestic Product"),
    (54, "Personal Income and Outlays"),
    (18, "H.15 Selected Interest Rates"),
)

# Macro series ids.
SERIES_IDS = ("DGS10", "DGS2", "DTWEXBGS", "CPIAUCSL", "PCEPI", "UNRATE", "FEDFUNDS", "M2SL")

# Blockchain chart names.
CHARTS = ("miners-revenue", "transaction-fees-usd")

# Exchange-flow scope.
EXCHANGE_FLOW_ASSET = "btc"
EXCHANGE_FLOW_EXCHANGE = "all_exchange"


def source(name: str) -> Source:
    try:
        return SOURCES[name]
    except KeyError:
        raise KeyError(f"unknown source {name!r}; known: {sorted(SOURCES)}") from None


def landing_path(root: str, name: str, dt: date | None = None) -> str:
    base = f"{root.rstrip('/')}/{source(name).name}"
    return f"{base}/dt={dt.isoformat()}" if dt else base


def read_landed(spark: SparkSession, root: str, name: str, start: date | None = None,
                end: date | None = None) -> DataFrame:
    """Landed pages of a source as ``(dt, page, payload)``; only the day folders in ``[start, end)`` are
    listed and read.  Below a day folder pages may lie in folders that say more of them (``kind=...``)."""
    base = landing_path(root, name)
    days = [n[3:] for n in file_names(spark, base) if n.startswith("dt=")]
    kept = [d for d in sorted(days) if (start is None or d >= start.isoformat()) and (end is None or d < end.isoformat())]
    if not kept:
        return spark.createDataFrame([], "dt date, page string, payload string")
    pages = (spark.read.option("wholetext", "true").option("recursiveFileLookup", "true").format("text")
             .load([f"{base}/dt={d}" for d in kept]))
    page = F.input_file_name()
    return pages.select(F.regexp_extract(page, "/dt=([0-9-]+)/", 1).cast("date").alias("dt"), page.alias("page"), F.col("value").alias("payload"))


def config_frame(spark: SparkSession, rows, schema: str) -> DataFrame:
    """A config list as a DataFrame (bounded by construction; broadcast in joins)."""
    return spark.createDataFrame(list(rows), schema)


def feeds_frame(spark: SparkSession) -> DataFrame:
    return config_frame(spark, [(i, *f) for i, f in enumerate(FEEDS)],
                        "feed_pos int, source_name string, url string, source_type string, reliability_tier long")


def releases_frame(spark: SparkSession) -> DataFrame:
    return config_frame(spark, RELEASES, "release_id long, name string")


def series_frame(spark: SparkSession) -> DataFrame:
    return config_frame(spark, [(s,) for s in SERIES_IDS], "series_id string")


def charts_frame(spark: SparkSession) -> DataFrame:
    return config_frame(spark, [(c,) for c in CHARTS], "chart_name string")
