"""Normaliser queries: payloads derived from the driver tables are parsed back
into typed rows; the oracles select the typed values directly from the tables."""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.conform import no_bad_rows
from tidemark.operators.windows import closed_bars
from tidemark.plans import landed, normalize
from tidemark.plans.registry import AS_OF, SOURCE_UPDATED_AT, finish, load, register

CANDLE_COLUMNS = ("instrument, counterpart, interval, open_time, close_time, open, high, low, close, volume, "
                  "quote_asset_volume, number_of_trades, taker_buy_base_asset_volume, taker_buy_quote_asset_volume")

BARS_SQL = """
WITH b AS (
  SELECT event_type AS instrument, date_trunc('hour', ts) AS open_time,
         arg_min(value, ts) AS open, max(value) AS high, min(value) AS low, arg_max(value, ts) AS close,
         round(sum(value), 2) AS volume, count(*) AS trades
  FROM events GROUP BY 1, 2)
SELECT instrument, 'USDT' AS counterpart, '1h' AS interval, open_time,
       open_time + INTERVAL 3599999 MILLISECOND AS close_time,
       open, high, low, close, volume, volume * 2 AS quote_asset_volume, trades AS number_of_trades,
       volume / 2 AS taker_buy_base_asset_volume, volume / 4 AS taker_buy_quote_asset_volume
FROM b
"""


def candle_rows(spark: SparkSession, sf_dir: str):
    pages = landed.kline_pages(load(spark, sf_dir, "events"))
    return normalize.candles(pages)


@register("kline_normalize", BARS_SQL)
def kline_normalize(spark: SparkSession, sf_dir: str):
    rows = candle_rows(spark, sf_dir)
    return finish(no_bad_rows(rows).drop("_payload"))


@register("closed_bar_filter", f"""
SELECT * FROM ({BARS_SQL}) c
WHERE close_time < TIMESTAMP '2024-01-15 12:30:00'
  AND open_time BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-15 12:29:59.999'
""")
def closed_bar_filter(spark: SparkSession, sf_dir: str):
    rows = no_bad_rows(candle_rows(spark, sf_dir)).drop("_payload")
    start = AS_OF.replace(day=10, hour=0, minute=0)
    out = closed_bars(rows, window_start=start, window_end=AS_OF + timedelta(days=3), as_of=AS_OF)
    return finish(out)


# ---- P11 strict policy: bad rows ------------------------------------------------------

@register("strict_bad_rows", f"""
SELECT instrument, open_time, number_of_trades FROM ({BARS_SQL}) b
WHERE instrument = 'error' AND number_of_trades >= 4
""")
def strict_bad_rows(spark: SparkSession, sf_dir: str):
    """Klines whose open field is not a number: the rows a strict job aborts on."""
    def inject(b):
        return F.when((F.col("event_type") == "error") & (F.col("trades") >= 4), F.lit("not_a_number")) \
            .otherwise(F.col("open").cast("string"))
    pages = landed.kline_pages(load(spark, sf_dir, "events"), open_text=inject)
    rows = normalize.candles(pages)
    return finish(rows.filter(F.col("_bad")).select("instrument", "open_time", "number_of_trades"))


STRICT_SOURCES = ("cot_positioning", "exchange_flows", "funding_rates", "long_short_ratio", "macro_series", "onchain_metrics", "sentiment_index")


@register("strict_source_bad_rows", """
SELECT source, 1 + (SELECT count(*) FROM events WHERE event_type = 'error') AS bad_rows,
       (SELECT count(*) FROM events WHERE event_type <> 'error') AS good_rows
FROM (VALUES """ + ", ".join(f"('{name}')" for name in STRICT_SOURCES) + """) s(source)
""")
def strict_source_bad_rows(spark: SparkSession, sf_dir: str):
    """For each strict source pages of all events, in which errors have a text for a number, and one page
    that is cut off: what a run would abort on."""
    ev = load(spark, sf_dir, "events")
    ts = landed.utc("ts")
    text = F.when(F.col("event_type") == "error", "oops").otherwise(F.col("value").cast("string"))
    day, iso = F.date_format(ts, "yyyy-MM-dd"), F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    lit = F.lit

    def pages(fields: dict, prefix: str = "[", suffix: str = "]"):
        item = F.to_json(F.struct(*(c.alias(name) for name, c in fields.items())))
        whole = landed.event_pages(ev, item, by=(), prefix=prefix, suffix=suffix).select("payload")
        return whole.union(spark.range(1).select(lit(prefix + '{"cut').alias("payload")))

    pair = {"instrument": lit("BTC"), "counterpart": lit("USDT")}
    made = {
        "cot_positioning": normalize.cot_positioning(pages({"market_and_exchange_names": lit("BITCOIN - X"), "report_date_as_yyyy_mm_dd": day,
                                                            "open_interest_all": text}), market_prefix="BITCOIN -"),
        "exchange_flows": normalize.exchange_flows(pages({"date": iso, "reserve": text}, '{"result": {"data": [', "]}}"), asset=lit("btc"), exchange=lit("all")),
        "funding_rates": normalize.funding_rates(pages({"symbol": lit("S"), "fundingTime": F.unix_millis(ts), "fundingRate": text}), **pair),
        "long_short_ratio": normalize.long_short(pages({"timestamp": F.unix_millis(ts).cast("string"), "longShortRatio": text,
                                                        "longAccount": lit("0.5"), "shortAccount": lit("0.5")}), **pair),
        "macro_series": normalize.macro_series(pages({"date": day, "value": text}, '{"observations": [', "]}"), series_id=lit("X")),
        "onchain_metrics": normalize.onchain_metrics(pages({"asset": lit("btc"), "time": iso, "CapMVRVCur": text}, '{"data": [', "]}")),
        "sentiment_index": normalize.sentiment(pages({"timestamp": F.unix_seconds(ts).cast("string"), "value": text}, '{"data": [', "]}")),
    }
    counted = [rows.agg(lit(name).alias("source"), F.count_if("_bad").alias("bad_rows"), F.count_if(~F.col("_bad")).alias("good_rows"))
               for name, rows in made.items()]
    return reduce(lambda x, y: x.unionByName(y), counted)


# ---- S3 JSON object pages under a path --------------------------------------------------

def _event_item(*fields: str):
    return F.to_json(F.struct(*[F.col(f) for f in fields]))


@register("json_pages_explode", """
SELECT event_id, event_type, value, page_no FROM (
  SELECT event_id, event_type, value, CAST(floor(event_id / 50) AS BIGINT) AS page_no FROM events)
WHERE event_type <> 'error'
""")
def json_pages_explode(spark: SparkSession, sf_dir: str):
    """``{"result": {"data": [...]}}`` pages; pages of one type land under another key
    (missing path = no rows, not an error)."""
    events = load(spark, sf_dir, "events")
    item = _event_item("event_id", "event_type", "value")
    pages = landed.event_pages(events, item, prefix='{"result": {"data": [', suffix="]}}")
    key = F.when(F.col("event_type") == "error", F.lit('{"results"')).otherwise(F.lit('{"result"'))
    pages = pages.withColumn("payload", F.concat(key, F.expr("substring(payload, 10)")))
    schema = "struct<result:struct<data:array<struct<event_id:bigint,event_type:string,value:double>>>>"
    from tidemark.sources.json_pages import payload_rows
    rows = payload_rows(pages, "payload", schema, ("result", "data"), keep=("page_no",))
    return rows.select("item.event_id", "item.event_type", "item.value", F.col("page_no").cast("long"))


# ---- S9 page union: overlapping pages, overlap removed by identity ----------------------

@register("page_union", "SELECT event_id, event_type, value, ts FROM events")
def page_union(spark: SparkSession, sf_dir: str):
    """Two overlapping page sets (offset pages and half-page-shifted cursor pages)
    read as one dataset; overlap removed on the identity, first page wins."""
    from tidemark.operators.dedup import first_wins
    from tidemark.sources.json_pages import payload_rows
    events = load(spark, sf_dir, "events").withColumn("us", F.unix_micros(landed.utc("ts")))
    item = _event_item("event_id", "event_type", "value", "us")
    a = landed.event_pages(events, item, by=()).withColumn("page_set", F.lit(0))
    shifted = events.withColumn("shift", F.col("event_id") + F.lit(landed.PAGE_ITEMS // 2))
    b = landed.event_pages(shifted, item, by=(), order="shift").withColumn("page_set", F.lit(1))
    schema = "array<struct<event_id:bigint,event_type:string,value:double,us:bigint>>"
    rows = payload_rows(a.unionByName(b), "payload", schema, keep=("page_set", "page_no"))
    flat = rows.select("item.*", "page_set", "page_no", "pos")
    dedup = first_wins(flat, "event_id", ["page_set", "page_no", "pos"])
    return finish(dedup.select("event_id", "event_type", "value", F.timestamp_micros("us").alias("ts")))


# ---- N2 funding rates -------------------------------------------------------------------

@register("funding_normalize", """
SELECT event_type AS instrument, 'USDT' AS counterpart, date_trunc('millisecond', ts) AS funding_time,
       (value - 100) / 1000 AS funding_rate,
       CASE WHEN event_type IN ('view', 'click') THEN NULL ELSE value * 100 END AS mark_price
FROM events
""")
def funding_normalize(spark: SparkSession, sf_dir: str):
    events = load(spark, sf_dir, "events")
    mark = (F.when(F.col("event_type") == "view", F.lit(""))
            .when(F.col("event_type") == "click", F.lit(None).cast("string"))
            .otherwise((F.col("value") * 100).cast("string")))
    item = F.to_json(F.struct(F.lit("BTCUSDT").alias("symbol"), F.unix_millis(landed.utc("ts")).alias("fundingTime"),
                              ((F.col("value") - 100) / 1000).cast("string").alias("fundingRate"),
                              mark.alias("markPrice")))
    pages = landed.event_pages(events, item)
    rows = normalize.funding_rates(pages, instrument=F.col("event_type"))
    return finish(no_bad_rows(rows))


# ---- N4 long/short ratio ----------------------------------------------------------------------

@register("long_short_normalize", """
SELECT event_type AS instrument, 'USDT' AS counterpart, CAST(ts AS DATE) AS date,
       value / 10 AS long_short_ratio, value / (value + 1) AS long_account_pct,
       1 / (value + 1) AS short_account_pct, TIMESTAMP '2024-02-01 00:00:00' AS source_updated_at
FROM events
""")
def long_short_normalize(spark: SparkSession, sf_dir: str):
    events = load(spark, sf_dir, "events")
    v = F.col("value")
    item = F.to_json(F.struct(F.unix_millis(landed.utc("ts")).cast("string").alias("timestamp"),
                              (v / 10).cast("string").alias("longShortRatio"),
                              (v / (v + 1)).cast("string").alias("longAccount"),
                              (F.lit(1.0) / (v + 1)).cast("string").alias("shortAccount")))
    rows = normalize.long_short(landed.event_pages(events, item), instrument=F.col("event_type"),
                                source_updated_at=SOURCE_UPDATED_AT)
    return finish(no_bad_rows(rows))


# ---- N7 exchange flows --------------------------------------------------------------------------

@register("exchange_flow_normalize", """
SELECT CAST(ts AS DATE) AS date, event_type AS asset, 'binance' AS exchange,
       value * 1000 AS reserve, value * 40000 AS reserve_usd, value AS inflow,
       CASE WHEN event_type = 'error' THEN NULL ELSE value / 2 END AS outflow, value / 2 AS netflow,
       TIMESTAMP '2024-02-01 00:00:00' AS source_updated_at
FROM events
""")
def exchange_flow_normalize(spark: SparkSession, sf_dir: str):
    """ISO dates with a +05:00 offset: the stored date is the wall date (not converted)."""
    events = load(spark, sf_dir, "events")
    v = F.col("value")
    wall = F.concat(F.date_format(landed.utc("ts"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+05:00"))
    item = F.to_json(F.struct(wall.alias("date"), (v * 1000).cast("string").alias("reserve"),
                              (v * 40000).cast("string").alias("reserve_usd"), v.cast("string").alias("inflow"),
                              F.when(F.col("event_type") != "error", (v / 2).cast("string")).alias("outflow"),
                              (v / 2).cast("string").alias("netflow")))
    pages = landed.event_pages(events, item, prefix='{"result": {"data": [', suffix="]}}")
    rows = normalize.exchange_flows(pages, asset=F.col("event_type"), exchange=F.lit("binance"),
                                    source_updated_at=SOURCE_UPDATED_AT)
    return finish(no_bad_rows(rows))


# ---- N5 COT positioning ---------------------------------------------------------------------------

COT_MARKET_SQL = """CASE o_orderstatus WHEN 'F' THEN 'BITCOIN - CHICAGO MERCANTILE EXCHANGE'
  WHEN 'O' THEN 'BITCOIN MICRO - CHICAGO MERCANTILE EXCHANGE' ELSE 'ETHER - CHICAGO MERCANTILE EXCHANGE' END"""


@register("cot_normalize", f"""
SELECT CAST(o_orderdate AS DATE) AS report_date, o_orderkey AS open_interest, o_custkey AS dealer_long,
       CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE CAST(floor(o_totalprice) AS BIGINT) END AS dealer_short,
       CAST(trunc(o_totalprice) AS BIGINT) AS asset_mgr_long, CAST(NULL AS BIGINT) AS asset_mgr_short,
       CAST(trunc(-o_totalprice) AS BIGINT) AS lev_money_long, o_custkey * 2 AS lev_money_short,
       TIMESTAMP '2024-02-01 00:00:00' AS source_updated_at
FROM orders
WHERE ({COT_MARKET_SQL}) LIKE 'BITCOIN -%' AND o_orderdate >= TIMESTAMP '1998-01-01 00:00:00'
""")
def cot_normalize(spark: SparkSession, sf_dir: str):
    """Prefix market filter + since bound; integers through floats (``"6000.0"``)."""
    from datetime import date
    orders = load(spark, sf_dir, "orders")
    market = (F.when(F.col("o_orderstatus") == "F", F.lit("BITCOIN - CHICAGO MERCANTILE EXCHANGE"))
              .when(F.col("o_orderstatus") == "O", F.lit("BITCOIN MICRO - CHICAGO MERCANTILE EXCHANGE"))
              .otherwise(F.lit("ETHER - CHICAGO MERCANTILE EXCHANGE")))
    item = F.to_json(F.struct(
        market.alias("market_and_exchange_names"),
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T00:00:00.000")).alias("report_date_as_yyyy_mm_dd"),
        F.concat(F.col("o_orderkey").cast("string"), F.lit(".0")).alias("open_interest_all"),
        F.col("o_custkey").cast("string").alias("dealer_positions_long_all"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("")).otherwise(
            F.floor("o_totalprice").cast("string")).alias("dealer_positions_short_all"),
        F.col("o_totalprice").cast("string").alias("asset_mgr_positions_long"),
        (-F.col("o_totalprice")).cast("string").alias("lev_money_positions_long"),
        (F.col("o_custkey") * 2).cast("string").alias("lev_money_positions_short")))
    pages = landed.event_pages(orders, item, by=(), order="o_orderkey")
    rows = normalize.cot_positioning(pages, since=date(1998, 1, 1), market_prefix="BITCOIN -",
                                     source_updated_at=SOURCE_UPDATED_AT)
    return finish(no_bad_rows(rows))


# ---- N13 on-chain metrics -------------------------------------------------------------------------

@register("onchain_normalize", """
SELECT upper(event_type) AS instrument, 'USD' AS counterpart, CAST(ts AS DATE) AS date,
       value * 1000000000 AS market_cap_usd, value / 100 AS mvrv, 19700000 + value AS supply,
       CAST(floor(value * 1000) AS BIGINT) AS active_addresses,
       CASE WHEN event_type = 'error' THEN NULL ELSE value * 1e15 END AS hash_rate,
       CAST(NULL AS DOUBLE) AS sopr, value * 100 AS realized_price_usd,
       TIMESTAMP '2024-02-01 00:00:00' AS source_updated_at
FROM events
""")
def onchain_normalize(spark: SparkSession, sf_dir: str):
    """ISO times with a -05:00 offset are converted to UTC before taking the date."""
    events = load(spark, sf_dir, "events")
    v = F.col("value")
    local = F.concat(F.date_format(landed.utc("ts") - F.expr("INTERVAL 5 HOURS"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
                     F.lit("-05:00"))
    item = F.to_json(F.struct(
        local.alias("time"), F.lit("btc").alias("asset"),
        (v * 1e9).cast("string").alias("CapMrktCurUSD"), (v / 100).cast("string").alias("CapMVRVCur"),
        (F.lit(19700000.0) + v).cast("string").alias("SplyCur"),
        F.concat(F.floor(v * 1000).cast("string"), F.lit(".0")).alias("AdrActCnt"),
        F.when(F.col("event_type") == "error", F.lit("")).otherwise((v * 1e15).cast("string")).alias("HashRate"),
        (v * 100).cast("string").alias("PriceRealizedUSD")))
    pages = landed.event_pages(events, item, prefix='{"data": [', suffix="]}")
    rows = normalize.onchain_metrics(pages, instrument=F.upper(F.col("event_type")), counterpart=F.lit("USD"),
                                     source_updated_at=SOURCE_UPDATED_AT)
    return finish(no_bad_rows(rows))


# ---- N15 sentiment -------------------------------------------------------------------------------------

@register("sentiment_normalize", """
SELECT CAST(ts AS DATE) AS date, CAST(floor(value / 4) AS BIGINT) AS fear_greed_value,
       CASE WHEN event_type = 'view' THEN NULL WHEN value > 50 THEN 'Greed' ELSE 'Fear' END AS fear_greed_label,
       TIMESTAMP '2024-02-01 00:00:00' AS source_updated_at
FROM events
""")
def sentiment_normalize(spark: SparkSession, sf_dir: str):
    events = load(spark, sf_dir, "events")
    v = F.col("value")
    label = F.when(F.col("event_type") == "view", F.lit(None).cast("string")) \
        .when(v > 50, F.lit("Greed")).otherwise(F.lit("Fear"))
    item = F.to_json(F.struct(F.unix_seconds(landed.utc("ts")).cast("string").alias("timestamp"),
                              F.floor(v / 4).cast("string").alias("value"),
                              label.alias("value_classification")))
    pages = landed.event_pages(events, item, prefix='{"data": [', suffix="]}")
    rows = normalize.sentiment(pages, source_updated_at=SOURCE_UPDATED_AT)
    return finish(no_bad_rows(rows))


# ---- F12-F15 sentinel numbers ----------------------------------------------------------------------------

@register("sentinel_numbers", """
SELECT event_id,
       CASE WHEN event_type IN ('error', 'view', 'click') THEN NULL ELSE value END AS as_optional,
       CASE WHEN event_type IN ('error', 'view', 'click') THEN NULL ELSE value END AS as_macro,
       CASE WHEN event_type IN ('error', 'view', 'click') THEN NULL ELSE CAST(trunc(value * 10) AS BIGINT) END AS as_int,
       event_type IN ('error', 'view') AS strict_bad
FROM events
""")
def sentinel_numbers(spark: SparkSession, sf_dir: str):
    """Sentinels injected by event type: ``""`` (error), ``"."`` (view), missing (click)."""
    from tidemark.functions import numbers as N
    events = load(spark, sf_dir, "events")
    text = (F.when(F.col("event_type") == "error", F.lit(""))
            .when(F.col("event_type") == "view", F.lit("."))
            .when(F.col("event_type") == "click", F.lit(None).cast("string"))
            .otherwise(F.col("value").cast("string")))
    int_text = F.when(text.isNull() | text.isin("", "."), text).otherwise((F.col("value") * 10).cast("string"))
    strict = N.optional_double_strict_empty(text)
    return events.select(
        "event_id",
        N.optional_double(text).alias("as_optional"),
        N.macro_value(text).alias("as_macro"),
        N.int_via_double(int_text).alias("as_int"),
        (text.isNotNull() & strict.isNull()).alias("strict_bad"))


# ---- N6 HTML tables --------------------------------------------------------------------------------------

@register("html_table_extract", """
SELECT CAST(o_orderdate AS DATE) AS date, round(sum(o_totalprice), 2) * 1000000.0 AS net_flow_usd,
       TIMESTAMP '2024-02-01 00:00:00' AS source_updated_at
FROM orders GROUP BY 1 HAVING count(*) > 1
""")
def html_table_extract(spark: SparkSession, sf_dir: str):
    """One page per month: a nav table, then Date/GBTC/Total with a trailing
    sentinel row; single-order days publish ``-`` (skipped)."""
    orders = load(spark, sf_dir, "orders")
    daily = (orders.groupBy(F.to_date("o_orderdate").alias("d"))
             .agg(F.round(F.sum("o_totalprice"), 2).alias("total"), F.count(F.lit(1)).alias("n")))
    total_text = F.when(F.col("n") > 1, F.format_number("total", 2)).otherwise(F.lit("-"))
    # every other day writes digits, spaces and the sign as character references
    odd = F.dayofmonth("d") % 2 == 1
    total_text = F.when(odd & (F.col("n") > 1), F.concat(F.lit("&#36;"), F.regexp_replace(F.regexp_replace(total_text, "1", "&#49;"), "0", "&#x30;"))) \
        .otherwise(total_text)
    day_text = F.replace(F.date_format("d", "dd MMM yyyy"), F.lit(" "), F.when(odd, "&#32;").otherwise(" "))
    row = F.format_string("<tr title='a>b'><td> %s&nbsp;</td><td>%s</td><td>%s</td></tr><!-- <tr><td>-->",
                          day_text, F.col("n").cast("string"), total_text)
    pages = (daily.select(F.date_format("d", "yyyy-MM").alias("month"), F.struct("d", row.alias("r")).alias("x"))
             .groupBy("month").agg(F.array_sort(F.collect_list("x")).alias("xs"))
             .select("month", F.concat(
                 F.lit("<html><body><table class='nav'><tr><td>Home</td><td>Flows</td></tr></table>"
                       "<table><thead><tr><th>Date</th><th>GBTC</th><th>Total</th></tr></thead><tbody>"),
                 F.array_join(F.transform("xs", lambda x: x["r"]), ""),
                 F.lit("<tr><td>Total</td><td>-</td><td>1,000.00</td></tr></tbody></table></body></html>"))
                 .alias("html")))
    rows = normalize.etf_flows(pages, keep=("month",), source_updated_at=SOURCE_UPDATED_AT)
    return finish(rows.select("date", "net_flow_usd", "source_updated_at"))


# ---- S6-S8 feeds, F10 RFC-822 dates, F17 content hash -------------------------------------------------

def _rss_item(e):
    desc = F.when(F.col("event_type") == "error", F.lit("")).otherwise(
        F.concat(F.lit("<description>"), F.col("props"), F.lit("</description>")))
    link = F.when(F.col("value") < 5, F.lit("")).otherwise(_news_url())
    return F.concat(F.lit("<item><title>  "), F.col("event_type"), F.lit(" "), F.col("event_id").cast("string"),
                    F.lit("  </title><link>"), link, F.lit("</link>"), desc, F.lit("<pubDate>"),
                    F.date_format(landed.utc("ts"), "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0000</pubDate></item>"))


def _news_url():
    return F.concat(F.lit("https://"), F.col("event_type"), F.lit(".example.com/e/"),
                    F.col("event_id").cast("string"), F.lit("?u="), F.col("user_id").cast("string"))


def _atom_entry(e):
    iso = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    ts = landed.utc("ts")
    link = F.when(F.col("value") < 5, F.lit("")).otherwise(
        F.concat(F.lit('<link rel="alternate" href="'), _news_url(), F.lit('"/>')))
    published = F.when(F.col("event_type") == "view", F.lit("")).otherwise(F.date_format(ts, iso))
    return F.concat(F.lit("<entry><title>"), F.col("event_type"), F.lit(" "), F.col("event_id").cast("string"),
                    F.lit("</title>"), link, F.lit("<published>"), published, F.lit("</published><updated>"),
                    F.date_format(ts + F.expr("INTERVAL 1 HOUR"), iso), F.lit("</updated><summary>"),
                    F.col("props"), F.lit("</summary></entry>"))


RSS_HEAD = '<?xml version="1.0" encoding="UTF-8"?><rss version="2.0"><channel><title>events</title>'
RSS_TAIL = "</channel></rss>"
ATOM_HEAD = '<?xml version="1.0" encoding="utf-8"?><feed xmlns="http://www.w3.org/2005/Atom"><title>events</title>'
ATOM_TAIL = "</feed>"
NEWS_COLUMNS = ["url", "title", "summary", "source_domain", "published_at", "content_hash"]

NEWS_SQL = """
SELECT url, title, summary, source_domain, published_at,
       sha256(url || chr(10) || title || chr(10) || coalesce(summary, '')) AS content_hash
FROM (SELECT 'https://' || event_type || '.example.com/e/' || event_id || '?u=' || user_id AS url,
             event_type || ' ' || event_id AS title, {summary} AS summary,
             event_type || '.example.com' AS source_domain, {published} AS published_at, event_type
      FROM events WHERE value >= 5 {where})
"""


def _rss_pages(events):
    return landed.event_pages(events, _rss_item(events), sep="", prefix=RSS_HEAD, suffix=RSS_TAIL)


def _atom_pages(events):
    return landed.event_pages(events, _atom_entry(events), sep="", prefix=ATOM_HEAD, suffix=ATOM_TAIL)


@register("rss_normalize", NEWS_SQL.format(
    summary="CASE WHEN event_type = 'error' THEN NULL ELSE props END",
    published="date_trunc('second', ts)", where=""))
def rss_normalize(spark: SparkSession, sf_dir: str):
    pages = _rss_pages(load(spark, sf_dir, "events"))
    return finish(normalize.news_items(pages, xml="payload").select(*NEWS_COLUMNS))


@register("atom_normalize", NEWS_SQL.format(
    summary="props",
    published="CASE WHEN event_type = 'view' THEN date_trunc('second', ts) + INTERVAL 1 HOUR "
              "ELSE date_trunc('second', ts) END", where=""))
def atom_normalize(spark: SparkSession, sf_dir: str):
    pages = _atom_pages(load(spark, sf_dir, "events"))
    return finish(normalize.news_items(pages, xml="payload").select(*NEWS_COLUMNS))


@register("feed_dispatch", NEWS_SQL.format(
    summary="props",
    published="CASE WHEN event_type = 'view' THEN date_trunc('second', ts) + INTERVAL 1 HOUR "
              "ELSE date_trunc('second', ts) END",
    where="AND event_type <> 'error'"))
def feed_dispatch(spark: SparkSession, sf_dir: str):
    """Mixed landing: click/view feeds are Atom, the rest RSS; error feeds land
    truncated (malformed -> no items, no exception)."""
    events = load(spark, sf_dir, "events")
    atom_types = ["click", "view"]
    atom = _atom_pages(events.filter(F.col("event_type").isin(atom_types)))
    rss_events = events.filter(~F.col("event_type").isin(atom_types))
    rss = landed.event_pages(rss_events, _atom_free_rss_item(), sep="", prefix=RSS_HEAD, suffix=RSS_TAIL)
    rss = rss.withColumn("payload", F.when(F.col("event_type") == "error",
                                           F.expr("substring(payload, 1, length(payload) - 20)"))
                         .otherwise(F.col("payload")))
    pages = atom.unionByName(rss)
    return finish(normalize.news_items(pages, xml="payload").select(*NEWS_COLUMNS))


def _atom_free_rss_item():
    """RSS items carrying the same fields as the Atom entries (description always present)."""
    link = F.when(F.col("value") < 5, F.lit("")).otherwise(_news_url())
    return F.concat(F.lit("<item><title>"), F.col("event_type"), F.lit(" "), F.col("event_id").cast("string"),
                    F.lit("</title><link>"), link, F.lit("</link><description>"), F.col("props"),
                    F.lit("</description><pubDate>"), F.date_format(landed.utc("ts"), "EEE, dd MMM yyyy HH:mm:ss"),
                    F.lit(" GMT</pubDate></item>"))


@register("rfc822_parse", """
SELECT event_id, CASE WHEN event_type = 'error' AND event_id % 4 = 0 THEN NULL WHEN event_type = 'error' AND event_id % 4 = 1 THEN date_trunc('minute', ts)
       ELSE date_trunc('second', ts) END AS published_at
FROM events
""")
def rfc822_parse(spark: SparkSession, sf_dir: str):
    """RFC-822 with/without weekday, numeric offsets, the zone table, comments, two-digit years, no seconds,
    the C library's order, ISO fallback, garbage -> null."""
    from tidemark.functions.time import rfc822_timestamp
    events = load(spark, sf_dir, "events")
    ts = landed.utc("ts")
    at = (F.pmod(F.shiftright("event_id", 2), F.lit(4)) + 1).cast("int")
    zone, hours = (F.element_at(F.array(*map(F.lit, values)), at) for values in (("PDT", "EST", "MDT", "UT"), (7, 5, 6, 0)))
    zoned = F.concat(F.date_format(ts - F.make_dt_interval(hours=hours), "EEEE, dd-MMM-yy HH:mm:ss"), F.lit(" "), zone, F.lit(" (zone (by name))"))
    kind = F.pmod("event_id", F.lit(4))
    odd = (F.when(kind == 0, "not a date").when(kind == 1, F.date_format(ts, "'(no seconds) 'd MMMM yyyy HH:mm"))
           .when(kind == 2, zoned).otherwise(F.date_format(ts, "EEE MMM d HH:mm:ss yyyy")))
    text = (F.when(F.col("event_type") == "click",
                   F.concat(F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0000")))
            .when(F.col("event_type") == "view", F.concat(F.date_format(ts, "dd MMM yyyy HH:mm:ss"), F.lit(" GMT")))
            .when(F.col("event_type") == "purchase",
                  F.concat(F.date_format(ts - F.expr("INTERVAL 5 HOURS"), "EEE, d MMM yyyy HH:mm:ss"),
                           F.lit(" -0500")))
            .when(F.col("event_type") == "signup", F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")))
            .otherwise(odd))
    return finish(events.select("event_id", rfc822_timestamp(text).alias("published_at")))


# ---- N16 volatility index: last close per day in payload order ------------------------------

@register("volatility_normalize", """
SELECT CAST(ts AS DATE) AS date, arg_max(value, event_id) AS dvol, TIMESTAMP '2024-02-01 00:00:00' AS source_updated_at
FROM events GROUP BY 1
""")
def volatility_normalize(spark: SparkSession, sf_dir: str):
    """Index candles ``[ms, o, h, l, c]`` landed in pages; the last candle of a day
    (page order, then position) gives the day's value."""
    ev = load(spark, sf_dir, "events")
    v = F.col("value").cast("string")
    item = F.format_string("[%d,%s,%s,%s,%s]", F.unix_millis(landed.utc("ts")), v, v, v, v)
    pages = landed.event_pages(ev, item, by=(), prefix='{"result": {"data": [', suffix="]}}")
    return finish(no_bad_rows(normalize.volatility_rows(pages, source_updated_at=SOURCE_UPDATED_AT)))


# ---- N3 futures metrics: three landed sources, latest point per day, full assembly --------------

@register("futures_day_normalize", """
WITH e AS (SELECT CAST(ts AS DATE) AS date, dayofweek(ts) AS d, event_type, event_id, value FROM events),
     oi AS (SELECT date, arg_max(value, event_id) AS open_interest FROM e WHERE event_type IN ('click', 'signup') AND d <> 0 GROUP BY 1),
     bs AS (SELECT date, max_by({'v': CASE WHEN value < 50 THEN NULL ELSE value END}, event_id).v AS basis
            FROM e WHERE event_type IN ('view', 'error') AND d NOT IN (0, 6) GROUP BY 1),
     pm AS (SELECT date, arg_max(value / 1000, event_id) AS premium_index FROM e WHERE event_type = 'purchase' AND d NOT IN (0, 5, 6) GROUP BY 1)
SELECT 'BTC' AS instrument, 'USDT' AS counterpart, coalesce(oi.date, bs.date, pm.date) AS date,
       open_interest, basis, premium_index
FROM oi FULL JOIN bs ON oi.date = bs.date FULL JOIN pm ON coalesce(oi.date, bs.date) = pm.date
""")
def futures_day_normalize(spark: SparkSession, sf_dir: str):
    """Open interest, basis (now and then without a value) and premium-index klines, to which all event
    types are dealt, landed as pages per day; the last point of the last page of a day is that day's
    value; each source rests on some days of the week."""
    ev = load(spark, sf_dir, "events").withColumn("date", F.to_date("ts"))
    ms = F.unix_millis(landed.utc("ts"))

    def dealt(resting, *kinds):
        return ev.filter(F.col("event_type").isin(*kinds) & ~F.dayofweek("date").isin(*resting))

    oi_item = F.to_json(F.struct(F.lit("BTCUSDT").alias("symbol"), ms.alias("timestamp"),
                                 F.col("value").cast("string").alias("sumOpenInterest")))
    bs_item = F.to_json(F.struct(F.lit("BTCUSDT").alias("pair"), ms.alias("timestamp"),
                                 F.when(F.col("value") >= 50, F.col("value").cast("string")).alias("basis")))
    pm_item = F.format_string('[%d,"0","0","0","%s","0",%d]', ms, (F.col("value") / 1000).cast("string"), ms)
    sources = ((dealt((1,), "click", "signup"), oi_item), (dealt((1, 7), "view", "error"), bs_item), (dealt((1, 6, 7), "purchase"), pm_item))
    return no_bad_rows(normalize.futures_metrics(*(landed.event_pages(src, item, by=("date",)) for src, item in sources)))


# ---- N14 chart backfill: every point in a half-open window ---------------------------------------

@register("chart_range_backfill", """
SELECT event_type AS chart_name, CAST(ts AS DATE) AS date, value,
       TIMESTAMP '2024-02-01 00:00:00' AS source_updated_at
FROM events
WHERE CAST(ts AS DATE) >= DATE '2024-01-05' AND CAST(ts AS DATE) < DATE '2024-01-20'
""")
def chart_range_backfill(spark: SparkSession, sf_dir: str):
    """Chart points ``{"x": epoch seconds, "y": value}`` over all time; the backfill
    keeps ``[start, end)`` by UTC date."""
    from datetime import date as _date
    ev = load(spark, sf_dir, "events").withColumnRenamed("event_type", "chart_name")
    item = F.to_json(F.struct(F.unix_seconds(landed.utc("ts")).alias("x"), F.col("value").alias("y")))
    pages = landed.event_pages(ev, item, by=("chart_name",), prefix='{"values": [', suffix="]}")
    rows = normalize.chart_range(pages, _date(2024, 1, 5), _date(2024, 1, 20), source_updated_at=SOURCE_UPDATED_AT)
    return finish(rows)


# ---- N11 stablecoin supply: two coins per day, one or both missing ---------------------------------

@register("stablecoin_normalize", """
WITH d AS (
  SELECT CAST(ts AS DATE) AS date,
         round(sum(CASE WHEN event_type = 'purchase' THEN value ELSE 0 END), 2) AS p,
         round(sum(CASE WHEN event_type IN ('signup', 'error') THEN value ELSE 0 END), 2) AS s,
         round(sum(CASE WHEN event_type = 'click' THEN value ELSE 0 END), 2) AS c,
         round(sum(CASE WHEN event_type = 'view' THEN value ELSE 0 END), 2) AS v
  FROM events GROUP BY 1),
k AS (SELECT date, CASE WHEN p >= s THEN p END AS usdt, CASE WHEN c >= v THEN s END AS usdc FROM d)
SELECT date, usdt AS usdt_market_cap_usd, usdc AS usdc_market_cap_usd,
       nullif(coalesce(usdt, 0) + coalesce(usdc, 0), 0) AS total_stablecoin_market_cap_usd,
       TIMESTAMP '2024-02-01 00:00:00' AS source_updated_at
FROM k WHERE usdt IS NOT NULL OR usdc IS NOT NULL
""")
def stablecoin_normalize(spark: SparkSession, sf_dir: str):
    """Per day one landed payload per coin (market cap = a rounded daily event sum);
    tether lands empty on days where purchases trail signups and errors, usd-coin on days where
    clicks trail views: days with both, one or no coin."""
    ev = load(spark, sf_dir, "events")

    def day_sum(*kinds):
        return F.round(F.sum(F.when(F.col("event_type").isin(*kinds), F.col("value")).otherwise(0.0)), 2)

    daily = ev.groupBy(F.to_date("ts").alias("date")).agg(
        day_sum("purchase").alias("p"), day_sum("signup", "error").alias("s"), day_sum("click").alias("c"),
        day_sum("view").alias("v"))
    caps = daily.select("date", F.explode(F.array(
        F.struct(F.lit("tether").alias("coin"), F.when(F.col("p") >= F.col("s"), F.col("p")).alias("usd")),
        F.struct(F.lit("usd-coin").alias("coin"), F.when(F.col("c") >= F.col("v"), F.col("s")).alias("usd")))).alias("x"))
    payload = F.to_json(F.struct(F.struct(F.struct(F.col("x.usd").alias("usd")).alias("market_cap")).alias("market_data")))
    caps = caps.select("date", F.col("x.coin").alias("coin"),
                       F.when(F.col("x.usd").isNotNull(), payload).otherwise(F.lit("{}")).alias("payload"))
    return finish(normalize.stablecoin_supply(caps, source_updated_at=SOURCE_UPDATED_AT))


@register("page_chain", """
WITH p AS (SELECT CAST(floor(event_id / 50) AS BIGINT) AS page_no, event_type, count(*) AS items FROM events GROUP BY 1, 2),
c AS (SELECT event_type || ':' || CAST(page_no // 64 AS BIGINT) AS chain, * FROM p)
SELECT chain, row_number() OVER (PARTITION BY chain ORDER BY page_no) - 1 AS position, page_no, items FROM c
""")
def page_chain(spark: SparkSession, sf_dir: str):
    """Chains of up to 64 cursor pages, landed in no order: a page knows its own cursor and the next one;
    places come from the cursors alone, and a lost page aborts."""
    from tidemark.sources.chains import BrokenChain, ranked_pages
    pages = landed.event_pages(load(spark, sf_dir, "events"), _event_item("event_id", "event_type", "value")).select("event_type", "page_no", "payload")
    pages = pages.withColumn("chain", F.concat("event_type", F.lit(":"), F.expr("page_no div 64").cast("string")))
    order = Window.partitionBy("chain").orderBy("page_no")       # 64 pages at most
    cursor = lambda c: F.sha2(F.concat_ws(":", "event_type", c.cast("string")), 256)
    chained = pages.select("chain", "page_no", F.size(F.from_json("payload", "array<struct<event_id:bigint>>")).cast("long").alias("items"),
                           F.when(F.lag("page_no").over(order).isNotNull(), cursor(F.col("page_no"))).alias("token"),
                           F.when(F.lead("page_no").over(order).isNotNull(), cursor(F.lead("page_no").over(order))).alias("next_token"))
    chained = chained.repartition("token").persist()
    try:
        ranked_pages(chained.where("token IS NULL OR page_no <> 7"))
        raise AssertionError("a lost page did not abort")
    except BrokenChain:
        pass
    return ranked_pages(chained).select("chain", "position", "page_no", "items")


@register("feed_malformed", NEWS_SQL.format(
    summary="CASE WHEN event_type = 'error' THEN NULL ELSE props END",
    published="date_trunc('second', ts)", where="AND CAST(floor(event_id / 50) AS BIGINT) % 5 = 0"))
def feed_malformed(spark: SparkSession, sf_dir: str):
    """Of five pages one is whole; in the others a tag is not closed, two are crossed, an end tag is alone,
    or the end is lost: these have no items, not those before the fault."""
    pages = _rss_pages(load(spark, sf_dir, "events"))
    fault = F.element_at(F.array(*map(F.lit, ("<b>", "<i><b></i></b>", "</item>", ""))), (F.col("page_no") % 5).cast("int"))
    spoilt = F.concat(F.expr(f"left(payload, length(payload) - {len(RSS_TAIL)})"), fault, F.when(F.col("page_no") % 5 < 4, F.lit(RSS_TAIL)).otherwise(F.lit("")))
    pages = pages.withColumn("payload", F.when(F.col("page_no") % 5 == 0, F.col("payload")).otherwise(spoilt))
    return finish(normalize.news_items(pages, xml="payload").select(*NEWS_COLUMNS))
