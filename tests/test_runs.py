"""Daily runs per source on the reference's fixture payload shapes."""

import json
from datetime import date, datetime, timedelta, timezone

from tidemark.plans import runs as R
from tidemark.store import TableStore

UTC = timezone.utc
OPEN = 1717200000000
KLINE = [OPEN, "12.25", "14.5", "11", "13.75", "80", 1717286399999,
         "1060", 17, "33", "440", "0"]


def _pages(spark, *payloads, **cols):
    names = list(cols)
    rows = [tuple(cols[n][i] for n in names) + (p,) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, ", ".join([f"{n} string" for n in names] + ["payload string"]))


def test_run_candles_closed_bars_and_metrics(spark, store_root):
    store = TableStore(spark, store_root)
    nxt = list(KLINE)
    nxt[0], nxt[6] = OPEN + 86400000, 1717286399999 + 86400000
    pages = _pages(spark, json.dumps([KLINE]), json.dumps([nxt]))
    start = datetime(2024, 6, 1, tzinfo=UTC)
    res = R.run_candles(store, pages, interval="1d", window_start=start, window_end=start + timedelta(days=2),
                        as_of=datetime(2024, 6, 2, 12, tzinfo=UTC))
    assert res.metrics["rows_affected"] == 1 and res.metrics["rows"] == 1 and res.metrics["symbol"] == "BTCUSDT"
    assert res.metrics["latest_source_close_time"] == "2024-06-01T23:59:59.999000+00:00"
    assert res.metrics["quality_checks_total"] == 7 and res.metrics["quality_failed_errors"] == 0
    again = R.run_candles(store, pages, interval="1d", window_start=start, window_end=start + timedelta(days=2),
                          as_of=datetime(2024, 6, 3, tzinfo=UTC))
    assert again.metrics["rows_affected"] == 1  # the second bar is now closed; the first is unchanged
    empty = R.run_candles(store, pages, interval="1d", window_start=start + timedelta(days=5),
                          window_end=start + timedelta(days=6), as_of=datetime(2024, 6, 3, tzinfo=UTC))
    assert empty.metrics["rows_affected"] == 0 and empty.reports == ()


def test_run_etf_and_sentiment(spark, store_root):
    store = TableStore(spark, store_root)
    html = ("<table><tr><th>Date</th><th>Fund A</th><th>Total</th></tr>"
            "<tr><td>01 Jun 2024</td><td>-31.7</td><td>88.4</td></tr>"
            "<tr><td>30 May 2024</td><td>12.2</td><td>-46.9</td></tr>"
            "<tr><td>14 Feb 2024</td><td>3</td><td>3.5</td></tr></table>")
    pages = spark.createDataFrame([("p0", html)], "page string, html string")
    stamp = datetime(2024, 6, 1, 18, tzinfo=UTC)
    res = R.run_etf_flows(store, pages, run_date=date(2024, 6, 1), source_updated_at=stamp)
    assert (res.metrics["available_days"], res.metrics["written_days"], res.metrics["rows_affected"]) == (3, 2, 2)
    fg = {"data": [{"timestamp": str(1717200000 - 86400 * i), "value": str(60 + i), "value_classification": "Greed"}
                   for i in range(7)]}
    dvol = {"result": {"data": [[OPEN, 31, 36, 30, 33], [OPEN + 3600000, 33, 37, 31, 34],
                                [OPEN - 86400000, 40, 41, 39, 40]]}}
    book = spark.createDataFrame([("BTC-28JUN24-42500-P", 317.5), ("BTC-27SEP24-91000-C", 1270.0), ("BTC-28JUN24-38000-P", 84.0)],
                                 "instrument_name string, open_interest double")
    res = R.run_sentiment_index(store, _pages(spark, json.dumps(fg)), _pages(spark, json.dumps(dvol)), book,
                                run_date=date(2024, 6, 1), source_updated_at=stamp)
    assert res.metrics["sentiment_index_rows_affected"] == 1 and res.metrics["deribit_dvol_rows_affected"] == 1
    assert res.metrics["deribit_put_call_rows_affected"] == 1 and res.metrics["available_days"] == 7
    assert res.metrics["quality_dvol_checks_total"] == 2 and res.metrics["quality_put_call_checks_total"] == 2
    assert [r.dvol for r in store.read("raw.deribit_dvol").collect()] == [34.0]
    assert [r.put_call_ratio for r in store.read("raw.deribit_put_call").collect()] == [(317.5 + 84.0) / 1270.0]


def test_run_market_metrics_and_stablecoins(spark, store_root):
    store = TableStore(spark, store_root)
    asset = _pages(spark, json.dumps({"market_caps": [[OPEN, 5.35e11]]}))
    total = _pages(spark, json.dumps({"market_cap_chart": {"market_cap": [[OPEN, 1e12]]}}))
    snap_at = datetime(2024, 6, 2, 9, tzinfo=UTC)
    R.run_market_metrics(store, asset, total, run_date=date(2024, 6, 1), snapshot_pct=55.0, snapshot_at=snap_at)
    R.run_market_metrics(store, asset, total, run_date=date(2024, 6, 2), snapshot_pct=55.0, snapshot_at=snap_at)
    got = sorted((r.date.isoformat(), r.btc_dominance_pct, r.source_updated_at) for r in store.read("raw.market_metrics").collect())
    assert got == [("2024-06-01", 53.5, datetime(2024, 6, 1)), ("2024-06-02", 55.0, datetime(2024, 6, 2, 9))]
    cap = lambda v: json.dumps({"market_data": {"market_cap": {"usd": v}}})
    caps = spark.createDataFrame([("2024-06-01", "tether", cap(80e9)), ("2024-06-01", "usd-coin", cap(25e9))],
                                 "date string, coin string, payload string")
    res = R.run_stablecoin_supply(store, caps, run_date=date(2024, 6, 1), source_updated_at=snap_at)
    assert res.metrics["rows_affected"] == 1
    assert store.read("raw.stablecoin_supply").collect()[0].total_stablecoin_market_cap_usd == 105e9


def test_run_news_and_onchain(spark, store_root):
    from tidemark.sources.registry import charts_frame, feeds_frame
    store = TableStore(spark, store_root)
    rss = ('<rss><channel><item><title>A</title><link>https://a.example.com/1</link><description>x</description>'
           '</item><item><title>B</title><link>https://b.example.com/2</link></item></channel></rss>')
    pages = spark.createDataFrame([(0, rss), (2, rss)], "feed_pos int, payload string")
    bodies = spark.createDataFrame([("https://a.example.com/1", "<html>body</html>")], "url string, body string")
    at = datetime(2024, 6, 1, tzinfo=UTC)
    first = R.run_market_news(store, pages, feeds_frame(spark), fetched_at=at, bodies=bodies)
    assert (first.metrics["items_seen"], first.metrics["items_written"], first.metrics["rows_affected"]) == (4, 2, 2)
    stored = {r.source_url: r for r in store.read("raw.market_news_items").collect()}
    assert stored["https://a.example.com/1"].source_name == "SEC press releases"
    assert stored["https://a.example.com/1"].content_raw == "<html>body</html>"
    assert R.run_market_news(store, pages, feeds_frame(spark), fetched_at=at).metrics["items_written"] == 0
    item = {"time": "2024-06-01T00:00:00Z", "asset": "btc", "CapMrktCurUSD": "1200000000000", "CapMVRVCur": "2.5"}
    charts = spark.createDataFrame([("miners-revenue", json.dumps({"values": [{"x": 1717200000, "y": 3e7}]}))],
                                   "chart_name string, payload string")
    res = R.run_onchain_metrics(store, _pages(spark, json.dumps({"data": [item]})), charts, charts_frame(spark),
                                run_date=date(2024, 6, 1), source_updated_at=at)
    assert res.metrics["onchain_metrics_rows_affected"] == 1 and res.metrics["blockchain_charts_rows_affected"] == 2
    vals = {r.chart_name: r.value for r in store.read("raw.blockchain_charts").collect()}
    assert vals == {"miners-revenue": 3e7, "transaction-fees-usd": None}


def test_run_news_empty_feeds(spark, store_root):
    from tidemark.sources.registry import feeds_frame
    store = TableStore(spark, store_root)
    pages = spark.createDataFrame([(0, "<rss><channel></channel></rss>"), (1, "not xml")], "feed_pos int, payload string")
    res = R.run_market_news(store, pages, feeds_frame(spark), fetched_at=datetime(2024, 6, 1, tzinfo=UTC))
    assert (res.metrics["rows_affected"], res.metrics["items_seen"], res.metrics["items_written"]) == (0, 0, 0)


def test_run_funding_window_clamped_and_inverted(spark, store_root):
    store = TableStore(spark, store_root)
    items = [{"symbol": "BTCUSDT", "fundingTime": OPEN + 8 * 3600000 * i, "fundingRate": "0.0031", "markPrice": ""}
             for i in range(6)]
    pages = _pages(spark, json.dumps(items))
    start = datetime(2024, 6, 1, tzinfo=UTC)
    res = R.run_funding_rates(store, pages, window_start=start, window_end=start + timedelta(days=2),
                              as_of=datetime(2024, 6, 2, 0, tzinfo=UTC))
    assert res.metrics["rows_affected"] == 3 and res.metrics["latest_funding_time"] == "2024-06-01T16:00:00+00:00"
    inverted = R.run_funding_rates(store, pages, window_start=start + timedelta(days=3), window_end=start,
                                   as_of=datetime(2024, 6, 9, tzinfo=UTC))
    assert inverted.metrics["rows_affected"] == 0 and inverted.reports == ()


def test_remaining_daily_runs(spark, store_root):
    from tidemark.sources.registry import releases_frame, series_frame
    store = TableStore(spark, store_root)
    at = datetime(2024, 6, 1, 6, tzinfo=UTC)
    cot = [{"market_and_exchange_names": "BITCOIN - CME", "report_date_as_yyyy_mm_dd": "2024-05-28T00:00:00.000",
            "open_interest_all": "120000"},
           {"market_and_exchange_names": "BITCOIN - CME", "report_date_as_yyyy_mm_dd": "2024-04-01T00:00:00.000",
            "open_interest_all": "1"}]
    assert R.run_cot_positioning(store, _pages(spark, json.dumps(cot)), run_date=date(2024, 6, 1),
                                 source_updated_at=at).metrics["rows_affected"] == 1      # 30-day look-back
    flows = {"result": {"data": [{"date": "2024-06-01T00:00:00", "reserve": "1.5", "inflow": "2", "outflow": "1",
                                  "netflow": "1", "reserve_usd": "3"}]}}
    assert R.run_exchange_flows(store, _pages(spark, json.dumps(flows)), since=date(2024, 5, 31),
                                until=date(2024, 6, 1), source_updated_at=at).metrics["rows_affected"] == 1
    ls = [{"timestamp": str(OPEN), "longShortRatio": "1.25", "longAccount": "0.555", "shortAccount": "0.445"}]
    assert R.run_long_short_ratio(store, _pages(spark, json.dumps(ls)), window_start=datetime(2024, 6, 1, tzinfo=UTC),
                                  window_end=datetime(2024, 6, 2, tzinfo=UTC), source_updated_at=at).metrics["rows_affected"] == 1
    oi = spark.createDataFrame([(json.dumps([{"symbol": "BTCUSDT", "timestamp": OPEN, "sumOpenInterest": "871.5"}]),)],
                               "payload string")
    empty = spark.createDataFrame([("[]",)], "payload string")
    res = R.run_futures_metrics(store, oi, empty, empty, window_start=datetime(2024, 6, 1, tzinfo=UTC))
    assert res.metrics["rows_affected"] == 1
    assert store.read("raw.futures_metrics").collect()[0].open_interest == 871.5
    nothing = R.run_futures_metrics(store, empty, empty, empty, window_start=datetime(2024, 6, 2, tzinfo=UTC))
    assert nothing.metrics["rows_affected"] == 0                                           # all sources missing: no row
    cal = spark.createDataFrame([(10, json.dumps({"release_dates": [{"date": "2024-06-12"}, {"date": "2024-01-01"}]}))],
                                "release_id long, payload string")
    assert R.run_macro_calendar(store, cal, releases_frame(spark), run_date=date(2024, 6, 1),
                                source_updated_at=at).metrics["rows_affected"] == 1
    assert store.read("raw.macro_calendar").collect()[0].title == "Consumer Price Index"
    first_series = series_frame(spark).first().series_id
    obs = {"observations": [{"date": "2024-05-30", "value": "4.5"}, {"date": "2024-01-01", "value": "."}]}
    series = spark.createDataFrame([(first_series, json.dumps(obs))], "series_id string, payload string")
    assert R.run_macro_series(store, series, run_date=date(2024, 6, 1), source_updated_at=at).metrics["rows_affected"] == 1
