"""Normaliser jobs: landed payload DataFrames -> typed rows of a stored table.

Each function is pure Column logic over a DataFrame of payloads; strict sources
add a ``_bad`` flag instead of raising per row, and the run job aborts the whole
batch through one aggregate when any row is bad.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.casts import try_cast

from tidemark.functions import numbers as N
from tidemark.functions import text as X
from tidemark.functions import time as TM
from tidemark.operators.conform import bad_row_flag, no_bad_rows
from tidemark.operators.windows import since_filter
from tidemark.sources import feeds, html_tables
from tidemark.sources.json_pages import KLINE_SCHEMA, broken, element, kline_fields, last_element, payload_rows


def _lit_ts(value: datetime | None) -> Column:
    return F.lit(value).cast("timestamp")


def _any(*conditions: Column) -> Column:
    """True where any condition holds (null counts as not)."""
    return F.coalesce(reduce(lambda a, b: a | b, conditions), F.lit(False))


def _col(value, default_col: str | None = None, default_lit=None) -> Column:
    """Column argument: a Column as given, a name for a column, or a default."""
    if value is None:
        return F.col(default_col) if default_col is not None else F.lit(default_lit)
    return F.col(value) if isinstance(value, str) else value


# ---- N1 candles --------------------------------------------------------------

def candles(pages: DataFrame, *, payload: str = "payload", instrument: str | Column | None = None,
            counterpart: str | Column | None = None, interval: str | Column | None = None) -> DataFrame:
    """Positional klines -> ``raw.candles`` rows (+ ``_bad``)."""
    src = pages.select(_col(instrument, "instrument").alias("instrument"),
                       _col(counterpart, None, "USDT").alias("counterpart"),
                       _col(interval, None, "1h").alias("interval"), F.col(payload).alias("payload"))
    items = payload_rows(src, "payload", KLINE_SCHEMA, keep=("instrument", "counterpart", "interval"))
    k = items.select("instrument", "counterpart", "interval", "pos", *kline_fields(F.col("item")),
                     F.to_json(F.col("item")).alias("_payload"))
    return k.select(
        "instrument", "counterpart", "interval",
        TM.ms_to_timestamp(F.col("open_time_ms")).alias("open_time"),
        TM.ms_to_timestamp(F.col("close_time_ms")).alias("close_time"),
        "open", "high", "low", "close", "volume", "quote_asset_volume", "number_of_trades",
        "taker_buy_base_asset_volume", "taker_buy_quote_asset_volume", "_bad", "_payload")


# ---- N2 funding rates ----------------------------------------------------------

FUNDING_SCHEMA = "array<struct<symbol:string,fundingTime:bigint,fundingRate:string,markPrice:string>>"


def funding_rates(pages: DataFrame, *, payload: str = "payload", instrument: Column | None = None,
                  counterpart: Column | None = None) -> DataFrame:
    src = pages.select(_col(instrument, "instrument").alias("instrument"),
                       _col(counterpart, None, "USDT").alias("counterpart"), F.col(payload).alias("p"))
    items = payload_rows(src, "p", FUNDING_SCHEMA, keep=("instrument", "counterpart"))
    rate = try_cast(F.col("item.fundingRate"), "double")
    ts = F.col("item.fundingTime")
    return items.select(
        "instrument", "counterpart",
        TM.ms_to_timestamp(ts).alias("funding_time"),
        rate.alias("funding_rate"),
        N.optional_double(F.col("item.markPrice")).alias("mark_price"),
        (bad_row_flag([ts, rate]) | (F.col("item.markPrice").isNotNull() & (F.col("item.markPrice") != "")
                                      & N.optional_double(F.col("item.markPrice")).isNull())).alias("_bad"))


# ---- N4 long/short ratio ------------------------------------------------------

LONG_SHORT_SCHEMA = "array<struct<timestamp:string,longShortRatio:string,longAccount:string,shortAccount:string>>"


def long_short(pages: DataFrame, *, payload: str = "payload", instrument: Column | None = None,
               counterpart: Column | None = None, source_updated_at: datetime | None = None) -> DataFrame:
    src = pages.select(_col(instrument, "instrument").alias("instrument"),
                       _col(counterpart, None, "USDT").alias("counterpart"), F.col(payload).alias("p"))
    items = payload_rows(src, "p", LONG_SHORT_SCHEMA, keep=("instrument", "counterpart"))
    ms = try_cast(F.col("item.timestamp"), "long")
    vals = [try_cast(F.col(f"item.{f}"), "double") for f in ("longShortRatio", "longAccount", "shortAccount")]
    return items.select(
        "instrument", "counterpart", TM.ms_to_date(ms).alias("date"),
        vals[0].alias("long_short_ratio"), vals[1].alias("long_account_pct"), vals[2].alias("short_account_pct"),
        _lit_ts(source_updated_at).alias("source_updated_at"),
        bad_row_flag([ms, *vals]).alias("_bad"))


# ---- N5 COT positioning -------------------------------------------------------

# Source field -> stored column.
COT_FIELDS = (
    ("open_interest_all", "open_interest"),
    ("dealer_positions_long_all", "dealer_long"),
    ("dealer_positions_short_all", "dealer_short"),
    ("asset_mgr_positions_long", "asset_mgr_long"),
    ("asset_mgr_positions_short", "asset_mgr_short"),
    ("lev_money_positions_long", "lev_money_long"),
    ("lev_money_positions_short", "lev_money_short"),
)
COT_SCHEMA = ("array<struct<market_and_exchange_names:string,report_date_as_yyyy_mm_dd:string,"
              + ",".join(f"{src}:string" for src, _ in COT_FIELDS) + ">>")


def cot_positioning(pages: DataFrame, *, payload: str = "payload", since: date | None = None,
                    market_prefix: str | None = None, source_updated_at: datetime | None = None) -> DataFrame:
    items = payload_rows(pages.select(F.col(payload).alias("p")), "p", COT_SCHEMA)
    d = TM.leading_date(F.col("item.report_date_as_yyyy_mm_dd"))
    out = items
    if market_prefix is not None:
        out = out.filter(F.col("item.market_and_exchange_names").startswith(market_prefix) | F.col("item").isNull())
    bad = _any(d.isNull(), *(N.not_integral(F.col(f"item.{src}")) for src, _ in COT_FIELDS))
    rows = out.select(d.alias("report_date"),
                      *[N.int_via_double(F.col(f"item.{src}")).alias(dst) for src, dst in COT_FIELDS],
                      _lit_ts(source_updated_at).alias("source_updated_at"), bad.alias("_bad"))
    return since_filter(rows, "report_date", since)


# ---- N6 ETF flows (HTML) ------------------------------------------------------

def etf_flows(pages: DataFrame, *, html: str = "html", keep: tuple[str, ...] = (),
              source_updated_at: datetime | None = None) -> DataFrame:
    """Header row with Date and Total; lenient: bad dates, skipped cells and short rows dropped."""
    rows = html_tables.rows_after_header(pages, html, "date", "total", keep=keep)
    d = TM.day_month_year(F.get(F.col("cells"), F.col("idx_date")))
    v = N.flow_millions(F.get(F.col("cells"), F.col("idx_total")))
    return (rows.select(*keep, "row_pos", d.alias("date"), v.alias("net_flow_usd"),
                        _lit_ts(source_updated_at).alias("source_updated_at"))
            .filter(F.col("date").isNotNull() & F.col("net_flow_usd").isNotNull()))


# ---- N7 exchange flows --------------------------------------------------------

EXCHANGE_FIELDS = ("reserve", "reserve_usd", "inflow", "outflow", "netflow")
EXCHANGE_SCHEMA = ("struct<result:struct<data:array<struct<date:string,"
                   + ",".join(f"{f}:string" for f in EXCHANGE_FIELDS) + ">>>>")


def exchange_flows(pages: DataFrame, *, payload: str = "payload", asset: Column | None = None,
                   exchange: Column | None = None, source_updated_at: datetime | None = None) -> DataFrame:
    src = pages.select(_col(asset, "asset").alias("asset"), _col(exchange, "exchange").alias("exchange"),
                       F.col(payload).alias("p"))
    items = payload_rows(src, "p", EXCHANGE_SCHEMA, ("result", "data"), keep=("asset", "exchange"))
    d = TM.iso_wall_date(F.col("item.date"))
    vals = {f: N.optional_double_strict_empty(F.col(f"item.{f}")) for f in EXCHANGE_FIELDS}
    bad = d.isNull()
    for f in EXCHANGE_FIELDS:
        bad = bad | (F.col(f"item.{f}").isNotNull() & vals[f].isNull())
    return items.select(d.alias("date"), "asset", "exchange", *[v.alias(f) for f, v in vals.items()],
                        _lit_ts(source_updated_at).alias("source_updated_at"), bad.alias("_bad"))


# ---- N8 macro calendar ----------------------------------------------------------

RELEASE_SCHEMA = "struct<release_dates:array<struct<date:string>>>"


def macro_calendar(pages: DataFrame, releases: DataFrame, *, payload: str = "payload",
                   source_updated_at: datetime | None = None) -> DataFrame:
    """``pages`` (release_id, payload) joined to the bounded release config
    (release_id, name) -> event rows ``<release>:<date>`` at midnight UTC."""
    items = payload_rows(pages, payload, RELEASE_SCHEMA, ("release_dates",), keep=("release_id",))
    d = TM.leading_date(F.col("item.date"))
    rows = items.select("release_id", d.alias("d"))
    enriched = rows.join(F.broadcast(releases), "release_id", "inner")
    return enriched.select(
        X.composite_id(F.col("release_id").cast("string"), F.date_format("d", "yyyy-MM-dd")).alias("event_id"),
        TM.date_to_midnight(F.col("d")).alias("event_time_utc"),
        F.coalesce(F.col("name"), F.lit("")).alias("title"),
        _lit_ts(source_updated_at).alias("source_updated_at"),
        F.col("d").isNull().alias("_bad"))


# ---- N9 macro series -----------------------------------------------------------

OBSERVATION_SCHEMA = "struct<observations:array<struct<date:string,value:string>>>"


def macro_series(pages: DataFrame, *, payload: str = "payload", series_id: Column | None = None,
                 since: date | None = None, source_updated_at: datetime | None = None) -> DataFrame:
    src = pages.select(_col(series_id, "series_id").alias("series_id"), F.col(payload).alias("p"))
    items = payload_rows(src, "p", OBSERVATION_SCHEMA, ("observations",), keep=("series_id",))
    d = TM.leading_date(F.col("item.date"))
    bad = _any(d.isNull(), N.unparsable(F.col("item.value"), N.MISSING_MACRO))
    out = items.select("series_id", d.alias("date"), N.macro_value(F.col("item.value")).alias("value"),
                       _lit_ts(source_updated_at).alias("source_updated_at"), bad.alias("_bad"))
    return since_filter(out, "date", since)


# ---- N12 market news -----------------------------------------------------------

def news_items(feeds_df: DataFrame, *, xml: str = "payload", keep: tuple[str, ...] = ()) -> DataFrame:
    """Items of all feeds (RSS or Atom), with content hash."""
    items = feeds.feed_items(feeds_df, xml, keep)
    return items.withColumn("content_hash", X.content_hash(F.col("url"), F.col("title"), F.col("summary")))


# ---- N13 on-chain metrics --------------------------------------------------------

# Source metric names -> stored column and type.
ONCHAIN_FIELDS = (
    ("CapMrktCurUSD", "market_cap_usd", "double"),
    ("CapMVRVCur", "mvrv", "double"),
    ("SplyCur", "supply", "double"),
    ("AdrActCnt", "active_addresses", "long"),
    ("HashRate", "hash_rate", "double"),
    ("SOPR", "sopr", "double"),
    ("PriceRealizedUSD", "realized_price_usd", "double"),
)
ONCHAIN_SCHEMA = ("struct<data:array<struct<time:string,asset:string,"
                  + ",".join(f"{src}:string" for src, _, _ in ONCHAIN_FIELDS) + ">>>")


def onchain_metrics(pages: DataFrame, *, payload: str = "payload", instrument: Column | None = None,
                    counterpart: Column | None = None, source_updated_at: datetime | None = None) -> DataFrame:
    src = pages.select(_col(instrument, None, "BTC").alias("instrument"),
                       _col(counterpart, None, "USD").alias("counterpart"), F.col(payload).alias("p"))
    items = payload_rows(src, "p", ONCHAIN_SCHEMA, ("data",), keep=("instrument", "counterpart"))
    d = TM.iso_to_utc_date(F.col("item.time"))
    cols = []
    for s, dst, t in ONCHAIN_FIELDS:
        c = F.col(f"item.{s}")
        cols.append((N.int_via_double(c) if t == "long" else N.optional_double(c)).alias(dst))
    bad = _any(d.isNull(), F.col("item.asset").isNull(),
               *(N.not_integral(F.col(f"item.{s}")) if t == "long" else N.unparsable(F.col(f"item.{s}")) for s, _, t in ONCHAIN_FIELDS))
    return items.select("instrument", "counterpart", d.alias("date"), *cols,
                        _lit_ts(source_updated_at).alias("source_updated_at"), bad.alias("_bad"))


# ---- N15 sentiment -----------------------------------------------------------------

FEAR_GREED_SCHEMA = "struct<data:array<struct<timestamp:string,value:string,value_classification:string>>>"


def sentiment(pages: DataFrame, *, payload: str = "payload", source_updated_at: datetime | None = None) -> DataFrame:
    items = payload_rows(pages.select(F.col(payload).alias("p")), "p", FEAR_GREED_SCHEMA, ("data",))
    secs = try_cast(F.col("item.timestamp"), "long")
    return items.select(TM.seconds_to_date(secs).alias("date"),
                        N.int_via_double(F.col("item.value")).alias("fear_greed_value"),
                        F.col("item.value_classification").alias("fear_greed_label"),
                        _lit_ts(source_updated_at).alias("source_updated_at"),
                        _any(secs.isNull(), N.int_via_double(F.col("item.value")).isNull()).alias("_bad"))


# ---- N16 volatility index ------------------------------------------------------------

VOL_SCHEMA = "struct<result:struct<data:array<array<double>>>>"


def volatility_points(pages: DataFrame, *, payload: str = "payload", keep: tuple[str, ...] = ()) -> DataFrame:
    """Candles ``[ms, open, high, low, close]`` -> (ts, close, page order; ``_bad``: no time or no close)."""
    items = payload_rows(pages, payload, VOL_SCHEMA, ("result", "data"), keep=keep)
    ms, close = element(F.col("item"), 0), element(F.col("item"), 4)
    return items.select(*keep, "pos", TM.ms_to_timestamp(ms.cast("long")).alias("ts"), close.alias("dvol"),
                        (ms.isNull() | close.isNull()).alias("_bad"))


# ---- N17 put/call ---------------------------------------------------------------------

def put_call(book: DataFrame, *, name: str = "instrument_name", oi: str = "open_interest",
             keys: Sequence[str] = ()) -> DataFrame:
    """Conditional sums by option side (``-P`` / ``-C`` in the name, missing = 0),
    guarded ratio; an empty book still gives one all-null row per key."""
    from tidemark.operators.aggregates import conditional_sum
    put = conditional_sum(F.col(oi), F.col(name).contains("-P"))
    call = conditional_sum(F.col(oi), F.col(name).contains("-C"))
    agg = book.groupBy(*keys).agg(put.alias("put_oi"), call.alias("call_oi"))
    return agg.select(*keys, F.nullif(F.col("put_oi"), F.lit(0.0)).alias("put_oi"),
                      F.nullif(F.col("call_oi"), F.lit(0.0)).alias("call_oi"),
                      N.guarded_ratio(F.col("put_oi"), F.col("call_oi")).alias("put_call_ratio"))


# ---- N3 futures metrics: latest point of three sources per day, full assembly ------------

OPEN_INTEREST_SCHEMA = "array<struct<symbol:string,timestamp:bigint,sumOpenInterest:string>>"
BASIS_SCHEMA = "array<struct<pair:string,timestamp:bigint,basis:string,basisRate:string>>"
PREMIUM_SCHEMA = "array<array<string>>"


def _latest_per_page(pages: DataFrame, schema: str, value: Column, name: str, bad: Column, key: str = "date") -> DataFrame:
    """Last element of each page (payload order), one value per ``key``; several pages for one key: the
    last page wins.  ``_bad_<name>`` tells whether a page cannot be read or its last value is no number."""
    parsed = pages.select(key, F.col("page_no") if "page_no" in pages.columns else F.lit(0).alias("page_no"),
                          broken(F.col("payload")).alias("cut"), last_element(F.from_json(F.col("payload"), schema)).alias("item"))
    parsed = parsed.filter(F.col("cut") | F.col("item").isNotNull())
    points = parsed.select(key, "page_no", value.alias("value"), (F.col("cut") | _any(bad)).alias("bad"))
    return points.groupBy(key).agg(F.max_by("value", "page_no").alias(name), F.max("bad").alias(f"_bad_{name}"))


def futures_metrics(open_interest: DataFrame, basis: DataFrame, premium: DataFrame, *,
                    instrument: str = "BTC", counterpart: str = "USDT") -> DataFrame:
    """Per day: latest open interest, basis and premium-index close (+ ``_bad``); any source may be
    missing, all missing = no row.  Inputs: (date, payload[, page_no]) pages."""
    from tidemark.operators.joins import full_assembly
    oi_value, pm_value = try_cast(F.col("item.sumOpenInterest"), "double"), try_cast(element(F.col("item"), 4), "double")
    oi = _latest_per_page(open_interest, OPEN_INTEREST_SCHEMA, oi_value, "open_interest", oi_value.isNull())
    bs = _latest_per_page(basis, BASIS_SCHEMA, N.optional_double(F.col("item.basis")), "basis", N.unparsable(F.col("item.basis")))
    pm = _latest_per_page(premium, PREMIUM_SCHEMA, pm_value, "premium_index", pm_value.isNull())
    out = full_assembly([oi, bs, pm], "date")
    names = ("open_interest", "basis", "premium_index")
    return out.select(F.lit(instrument).alias("instrument"), F.lit(counterpart).alias("counterpart"), "date", *names,
                      _any(*(F.coalesce(f"_bad_{n}", F.lit(False)) for n in names)).alias("_bad"))


# ---- N10 market dominance: exact-ms ratio, last per day, history else snapshot -------------

ASSET_CAPS_SCHEMA = "struct<market_caps:array<array<double>>>"
TOTAL_CAPS_SCHEMA = "struct<market_cap_chart:struct<market_cap:array<array<double>>>>"


def dominance_history(asset_pages: DataFrame, total_pages: DataFrame) -> DataFrame:
    """(ts, date, btc_dominance_pct): asset cap / total cap * 100 on exactly equal
    epoch-ms keys, total > 0; the last total point wins on a repeated key.  A page that cannot be
    read, or a point without a time, aborts."""
    from tidemark.operators.joins import dedupe_last, ratio_join
    a = payload_rows(asset_pages, "payload", ASSET_CAPS_SCHEMA, ("market_caps",))
    point = lambda name: (element(F.col("item"), 0).cast("long").alias("ms"), element(F.col("item"), 1).alias(name),
                          element(F.col("item"), 0).isNull().alias("_bad"))
    a = no_bad_rows(a.select(*point("cap")))
    t = payload_rows(total_pages, "payload", TOTAL_CAPS_SCHEMA, ("market_cap_chart", "market_cap"))
    t = no_bad_rows(t.select(*point("total"), "pos"))
    total = dedupe_last(t, "ms", "total", "pos")
    ratio = ratio_join(a, total, "ms", "cap", "total", out="btc_dominance_pct")
    ts = TM.ms_to_timestamp(F.col("ms"))
    return ratio.select(ts.alias("ts"), F.to_date(ts).alias("date"), "btc_dominance_pct")


def market_metric_rows(history: DataFrame, requested: DataFrame, snapshot_pct: Column,
                       snapshot_at: datetime) -> DataFrame:
    """Per requested date: the day's last historical value stamped midnight UTC,
    else the snapshot stamped with its time.  ``requested`` has a ``date`` column
    (and may carry the snapshot value as a column)."""
    from tidemark.operators.aggregates import last_value_per_day
    from tidemark.operators.joins import fallback_join
    daily = last_value_per_day(history.select("ts", "btc_dominance_pct"), "ts", "btc_dominance_pct")
    return fallback_join(requested, daily, "date", {"btc_dominance_pct": snapshot_pct}, "source_updated_at",
                         TM.date_to_midnight(F.col("date")), _lit_ts(snapshot_at))


# ---- N11 stablecoin supply: two coins combined per day ---------------------------------------

COIN_CAP_SCHEMA = "struct<market_data:struct<market_cap:struct<usd:double>>>"


def stablecoin_supply(caps: DataFrame, *, source_updated_at: datetime | None = None) -> DataFrame:
    """``caps`` (date, coin, payload) for coins ``tether`` / ``usd-coin``; one or both
    may be missing (null); both missing = no row; total null-safe, zero = null."""
    parsed = caps.select("date", "coin", F.from_json("payload", COIN_CAP_SCHEMA)
                         .getField("market_data").getField("market_cap").getField("usd").alias("usd"))
    wide = parsed.groupBy("date").agg(
        F.max(F.when(F.col("coin") == "tether", F.col("usd"))).alias("usdt_market_cap_usd"),
        F.max(F.when(F.col("coin") == "usd-coin", F.col("usd"))).alias("usdc_market_cap_usd"))
    wide = wide.filter(F.col("usdt_market_cap_usd").isNotNull() | F.col("usdc_market_cap_usd").isNotNull())
    return wide.select("date", "usdt_market_cap_usd", "usdc_market_cap_usd",
                       N.null_safe_total(F.col("usdt_market_cap_usd"), F.col("usdc_market_cap_usd"))
                       .alias("total_stablecoin_market_cap_usd"),
                       _lit_ts(source_updated_at).alias("source_updated_at"))


# ---- N14 blockchain charts ----------------------------------------------------------------------

CHART_SCHEMA = "struct<values:array<struct<x:bigint,y:double>>>"


def chart_first_values(requested: DataFrame, pages: DataFrame, *,
                       source_updated_at: datetime | None = None) -> DataFrame:
    """Daily form: one row per requested (chart_name, date); the first value of the first page, or null
    when the page is missing, empty or unparsable."""
    page_no = F.col("page_no") if "page_no" in pages.columns else F.lit(0)
    value = F.get(F.from_json("payload", CHART_SCHEMA).getField("values"), 0).getField("y")
    first = pages.groupBy("chart_name", "date").agg(F.min_by(value, page_no).alias("value"))
    out = requested.join(first, ["chart_name", "date"], "left")
    return out.select("chart_name", "date", "value", _lit_ts(source_updated_at).alias("source_updated_at"))


def chart_range(pages: DataFrame, start: date | None = None, end: date | None = None, *,
                source_updated_at: datetime | None = None) -> DataFrame:
    """Backfill form: every point of each chart, half-open ``[start, end)`` by UTC date (None: open)."""
    items = payload_rows(pages, "payload", CHART_SCHEMA, ("values",), keep=("chart_name",)).filter("item is not null")
    rows = items.select("chart_name", TM.seconds_to_date(F.col("item.x")).alias("date"), F.col("item.y").alias("value"),
                        _lit_ts(source_updated_at).alias("source_updated_at"))
    rows = since_filter(rows, "date", start)
    return rows if end is None else rows.filter(F.col("date") < F.lit(end))


# ---- N16 volatility index: last close per day ------------------------------------------------------

def volatility_rows(pages: DataFrame, *, source_updated_at: datetime | None = None) -> DataFrame:
    """Candles -> (date, dvol): the last candle of a day (payload order across pages) wins."""
    order_cols = [c for c in ("page_no",) if c in pages.columns]
    pts = volatility_points(pages, keep=tuple(order_cols))
    order = F.struct(*[F.col(c) for c in order_cols], F.col("pos")) if order_cols else F.col("pos")
    daily = pts.groupBy(F.to_date("ts").alias("date")).agg(F.max_by("dvol", order).alias("dvol"), F.max("_bad").alias("_bad"))
    return daily.select("date", "dvol", _lit_ts(source_updated_at).alias("source_updated_at"), "_bad")
