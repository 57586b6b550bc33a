"""The seventeen stored tables (schema, identity, partition transforms, sort)."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from tidemark.quality import expression, from_spec, in_range
from tidemark.spec import TableSpec, table_spec

# Names, columns and types, identities, partitions and sort orders of the stored tables.

CANDLES = table_spec(
    "raw.candles",
    {"instrument": str, "counterpart": str, "interval": str, "open_time": datetime, "close_time": datetime,
     "open": float, "high": float, "low": float, "close": float, "volume": float,
     "quote_asset_volume": float, "number_of_trades": int,
     "taker_buy_base_asset_volume": float, "taker_buy_quote_asset_volume": float},
    identity=("instrument", "counterpart", "interval", "open_time"),
    partition=("years(open_time)",),
    sort=("open_time", "instrument"),
)

FUNDING_RATES = table_spec(
    "raw.funding_rates",
    {"instrument": str, "counterpart": str, "funding_time": datetime, "funding_rate": float,
     "mark_price": float | None},
    identity=("instrument", "counterpart", "funding_time"),
    partition=("months(funding_time)",),
    sort=("funding_time", "instrument"),
)

FUTURES_METRICS = table_spec(
    "raw.futures_metrics",
    {"instrument": str, "counterpart": str, "date": date, "open_interest": float | None,
     "basis": float | None, "premium_index": float | None},
    identity=("instrument", "counterpart", "date"),
    partition=("years(date)",),
    sort=("date",),
)

LONG_SHORT_RATIO = table_spec(
    "raw.long_short_ratio",
    {"instrument": str, "counterpart": str, "date": date, "long_short_ratio": float,
     "long_account_pct": float, "short_account_pct": float, "source_updated_at": datetime},
    identity=("instrument", "counterpart", "date"),
    partition=("years(date)",),
    sort=("date",),
)

COT_POSITIONING = table_spec(
    "raw.cot_positioning",
    {"report_date": date, "open_interest": int | None, "dealer_long": int | None, "dealer_short": int | None,
     "asset_mgr_long": int | None, "asset_mgr_short": int | None, "lev_money_long": int | None,
     "lev_money_short": int | None, "source_updated_at": datetime},
    identity=("report_date",),
    sort=("report_date",),
)

ETF_FLOWS = table_spec(
    "raw.etf_flows",
    {"date": date, "net_flow_usd": float, "source_updated_at": datetime},
    identity=("date",),
    sort=("date",),
)

EXCHANGE_FLOWS = table_spec(
    "raw.exchange_flows",
    {"date": date, "asset": str, "exchange": str, "reserve": float | None, "reserve_usd": float | None,
     "inflow": float | None, "outflow": float | None, "netflow": float | None, "source_updated_at": datetime},
    identity=("date", "asset", "exchange"),
    partition=("years(date)",),
    sort=("date", "asset"),
)

MACRO_CALENDAR = table_spec(
    "raw.macro_calendar",
    {"event_id": str, "event_time_utc": datetime, "title": str, "source_updated_at": datetime},
    identity=("event_id", "event_time_utc"),
    partition=("years(event_time_utc)",),
    sort=("event_time_utc",),
)

MACRO_SERIES = table_spec(
    "raw.macro_series",
    {"series_id": str, "date": date, "value": float | None, "source_updated_at": datetime},
    identity=("series_id", "date"),
    sort=("series_id", "date"),
)

MARKET_METRICS = table_spec(
    "raw.market_metrics",
    {"date": date, "btc_dominance_pct": float, "source_updated_at": datetime},
    identity=("date",),
    sort=("date",),
)

STABLECOIN_SUPPLY = table_spec(
    "raw.stablecoin_supply",
    {"date": date, "usdt_market_cap_usd": float | None, "usdc_market_cap_usd": float | None,
     "total_stablecoin_market_cap_usd": float | None, "source_updated_at": datetime},
    identity=("date",),
    sort=("date",),
)

MARKET_NEWS_ITEMS = table_spec(
    "raw.market_news_items",
    {"source_url": str, "content_hash": str, "source_name": str | None, "source_domain": str | None,
     "source_type": str | None, "reliability_tier": int | None, "published_at": datetime | None,
     "fetched_at": datetime | None, "title": str | None, "summary_raw": str | None,
     "content_raw": str | None, "source_updated_at": datetime},
    identity=("content_hash",),
    sort=("published_at",),
    member="content_hash",
)

ONCHAIN_METRICS = table_spec(
    "raw.onchain_metrics",
    {"instrument": str, "counterpart": str, "date": date, "market_cap_usd": float | None, "mvrv": float | None,
     "supply": float | None, "active_addresses": int | None, "hash_rate": float | None, "sopr": float | None,
     "realized_price_usd": float | None, "source_updated_at": datetime},
    identity=("instrument", "counterpart", "date"),
    partition=("years(date)",),
    sort=("date", "instrument"),
)

BLOCKCHAIN_CHARTS = table_spec(
    "raw.blockchain_charts",
    {"chart_name": str, "date": date, "value": float | None, "source_updated_at": datetime},
    identity=("chart_name", "date"),
    partition=("years(date)",),
    sort=("chart_name", "date"),
)

SENTIMENT_INDEX = table_spec(
    "raw.sentiment_index",
    {"date": date, "fear_greed_value": int | None, "fear_greed_label": str | None, "source_updated_at": datetime},
    identity=("date",),
    sort=("date",),
)

VOLATILITY_INDEX = table_spec(
    "raw.deribit_dvol",
    {"date": date, "dvol": float | None, "source_updated_at": datetime},
    identity=("date",),
    sort=("date",),
)

PUT_CALL = table_spec(
    "raw.deribit_put_call",
    {"date": date, "put_oi": float | None, "call_oi": float | None, "put_call_ratio": float | None,
     "source_updated_at": datetime},
    identity=("date",),
    sort=("date",),
)

ALL_SPECS: dict[str, TableSpec] = {s.identifier: s for s in (
    CANDLES, FUNDING_RATES, FUTURES_METRICS, LONG_SHORT_RATIO, COT_POSITIONING, ETF_FLOWS, EXCHANGE_FLOWS,
    MACRO_CALENDAR, MACRO_SERIES, MARKET_METRICS, STABLECOIN_SUPPLY, MARKET_NEWS_ITEMS, ONCHAIN_METRICS,
    BLOCKCHAIN_CHARTS, SENTIMENT_INDEX, VOLATILITY_INDEX, PUT_CALL,
)}


def resolve(identifier: str, registry: dict[str, TableSpec] | None = None) -> TableSpec:
    """``namespace.name`` -> spec; unknown names raise KeyError listing the known ones."""
    registry = ALL_SPECS if registry is None else registry
    try:
        return registry[identifier]
    except KeyError:
        raise KeyError(f"unknown table {identifier!r}; known: {sorted(registry)}") from None


# ---- per-table quality rules: fixed names and bounds --------------------------

def candle_checks(spec: TableSpec = CANDLES) -> list:
    c = F.col
    return from_spec(spec, extra=[
        expression("high>=low", c("high") >= c("low")),
        expression("high_bounds_oc", (c("high") >= c("open")) & (c("high") >= c("close"))),
        expression("low_bounds_oc", (c("low") <= c("open")) & (c("low") <= c("close"))),
        expression("positive_prices", (c("open") > 0) & (c("close") > 0)),
        in_range("volume", 0, None),
    ])


def funding_checks(spec: TableSpec = FUNDING_RATES) -> list:
    return from_spec(spec, extra=[expression("funding_rate_sane", F.abs(F.col("funding_rate")) <= 1.0)])


def dominance_checks(spec: TableSpec = MARKET_METRICS) -> list:
    d = F.col("btc_dominance_pct")
    return from_spec(spec, extra=[expression("dominance_in_(0,100]", (d > 0) & (d <= 100))])


def sentiment_checks(spec: TableSpec = SENTIMENT_INDEX) -> list:
    return from_spec(spec, extra=[in_range("fear_greed_value", 0, 100, allow_null=True)])


def quality_checks(spec: TableSpec) -> list:
    rules = {
        CANDLES.identifier: candle_checks,
        FUNDING_RATES.identifier: funding_checks,
        MARKET_METRICS.identifier: dominance_checks,
        SENTIMENT_INDEX.identifier: sentiment_checks,
    }
    fn = rules.get(spec.identifier)
    return fn(spec) if fn else from_spec(spec)
