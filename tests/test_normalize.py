"""Normalisers on the payload shapes of the reference's tests."""

import json
from datetime import date, datetime, timezone

from pyspark.sql import functions as F

from tidemark.plans import normalize as N

KLINE = [1717200000000, "12.25", "14.5", "11", "13.75", "80", 1717286399999,
         "1060", 17, "33", "440", "0"]
UTC = timezone.utc


def _pages(spark, payloads, **cols):
    names = list(cols)
    rows = [tuple(cols[n][i] for n in names) + (p,) for i, p in enumerate(payloads)]
    schema = ", ".join([f"{n} string" for n in names] + ["payload string"])
    return spark.createDataFrame(rows, schema)


def test_kline_valid_and_strict(spark):
    bad_len = KLINE[:11]
    bad_num = list(KLINE)
    bad_num[1] = "not_a_number"
    pages = _pages(spark, [json.dumps([KLINE]), json.dumps([bad_len, KLINE + ["x"], bad_num])],
                   instrument=["BTC", "BTC"])
    rows = N.candles(pages).orderBy("_bad").collect()
    good = [r for r in rows if not r._bad]
    assert len(good) == 1 and sum(r._bad for r in rows) == 3
    g = good[0]
    assert (g.open, g.close, g.number_of_trades) == (12.25, 13.75, 17)
    assert g.open_time == datetime(2024, 6, 1) and g.close_time == datetime(2024, 6, 1, 23, 59, 59, 999000)


def test_funding_mark_price(spark):
    items = [{"symbol": "BTCUSDT", "fundingTime": 1717200000000, "fundingRate": "0.0031", "markPrice": "12.75"},
             {"symbol": "BTCUSDT", "fundingTime": 1717228800000, "fundingRate": "-0.002", "markPrice": ""},
             {"symbol": "BTCUSDT", "fundingTime": 1717257600000, "fundingRate": "0.004", "markPrice": None}]
    rows = N.funding_rates(_pages(spark, [json.dumps(items)], instrument=["BTC"])).orderBy("funding_time").collect()
    assert [r.mark_price for r in rows] == [12.75, None, None]
    assert rows[0].funding_rate == 0.0031 and not any(r._bad for r in rows)
    missing = N.funding_rates(_pages(spark, [json.dumps([{"symbol": "BTCUSDT", "fundingTime": 1}])],
                                     instrument=["BTC"])).collect()
    assert missing[0]._bad


def test_long_short(spark):
    items = [{"timestamp": "1717200000000", "longShortRatio": "1.6", "longAccount": "0.615", "shortAccount": "0.385"}]
    r = N.long_short(_pages(spark, [json.dumps(items)], instrument=["BTC"])).collect()[0]
    assert (r.date, r.long_short_ratio, r._bad) == (date(2024, 6, 1), 1.6, False)


def test_cot_numbers(spark):
    item = {"market_and_exchange_names": "BITCOIN - CME", "report_date_as_yyyy_mm_dd": "2023-02-14T00:00:00.000",
            "open_interest_all": "87311", "dealer_positions_long_all": "4127.0",
            "dealer_positions_short_all": "", "asset_mgr_positions_long": None}
    other = dict(item, market_and_exchange_names="ETHER - CME")
    rows = N.cot_positioning(_pages(spark, [json.dumps([item, other])]), market_prefix="BITCOIN -").collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r.report_date, r.open_interest, r.dealer_long, r.dealer_short, r.asset_mgr_long) == (
        date(2023, 2, 14), 87311, 4127, None, None)


def test_etf_html(spark):
    html = ("<table><tr><td>nav</td></tr></table><table><tr><th>Date</th><th>GBTC</th><th>Total</th></tr>"
            "<tr><td>01 Jun 2024</td><td>-100</td><td>200</td></tr>"
            "<tr><td>31 May 2024</td><td>50</td><td>$1,150.5</td></tr>"
            "<tr><td>bad-date</td><td>1</td><td>5</td></tr>"
            "<tr><td>02 Jun 2024</td><td>1</td><td>-</td></tr>"
            "<tr><td>03 Jun 2024</td><td>1</td></tr>"
            "<tr><td>Total</td><td>1</td><td>(12)</td></tr></table>")
    no_total = "<table><tr><th>Date</th><th>GBTC</th></tr><tr><td>01 Jun 2024</td><td>1</td></tr></table>"
    pages = spark.createDataFrame([("a", html), ("b", no_total)], "page string, html string")
    rows = N.etf_flows(pages, keep=("page",)).orderBy("row_pos").collect()
    assert [(r.date, r.net_flow_usd) for r in rows] == [(date(2024, 6, 1), 200_000_000.0),
                                                        (date(2024, 5, 31), 1_150_500_000.0)]


def test_exchange_flows(spark):
    page = {"result": {"data": [{"date": "2024-06-01T00:00:00", "reserve": "125000.5", "reserve_usd": "8125032500.0",
                                 "inflow": "1200.0", "outflow": None, "netflow": "250.0"},
                                {"reserve": "1"}]}}
    rows = N.exchange_flows(_pages(spark, [json.dumps(page), json.dumps({"other": 1})], asset=["BTC", "BTC"],
                                   exchange=["binance", "binance"])).orderBy("_bad").collect()
    assert len(rows) == 2
    assert (rows[0].date, rows[0].reserve, rows[0].outflow, rows[0]._bad) == (date(2024, 6, 1), 125000.5, None, False)
    assert rows[1]._bad  # missing date is an error


def test_macro_calendar_and_series(spark):
    releases = spark.createDataFrame([(10, "Consumer Price Index"), (11, None)], "release_id long, name string")
    pages = spark.createDataFrame([(10, json.dumps({"release_dates": [{"date": "2024-06-01"}]})),
                                   (11, json.dumps({"release_dates": [{"date": "2024-06-02"}]}))],
                                  "release_id long, payload string")
    rows = {r.event_id: r for r in N.macro_calendar(pages, releases).collect()}
    assert rows["10:2024-06-01"].event_time_utc == datetime(2024, 6, 1)
    assert rows["10:2024-06-01"].title == "Consumer Price Index" and rows["11:2024-06-02"].title == ""
    obs = {"observations": [{"date": "2024-06-01", "value": "4.5"}, {"date": "2024-06-02", "value": "."},
                            {"date": "2024-06-03", "value": ""}, {"date": "2024-06-04", "value": None}]}
    vals = [r.value for r in N.macro_series(_pages(spark, [json.dumps(obs)], series_id=["DGS10"])).orderBy("date").collect()]
    assert vals == [4.5, None, None, None]


def test_feeds(spark):
    rss = ('<rss version="2.0"><channel><item><title>A</title><link>https://a.example.com/1</link>'
           '<description>first</description><pubDate>Sat, 01 Jun 2024 12:00:00 +0000</pubDate></item>'
           '<item><title>B</title><link>https://b.example.com/2</link></item>'
           '<item><title>C</title></item></channel></rss>')
    atom = ('<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>E</title><link href="https://e.example.com/x"/>'
            '<updated>2024-06-01T00:00:00Z</updated><summary>s</summary></entry><entry><title>none</title></entry></feed>')
    bad = "<rss><channel><item><title>X</title>"
    pages = spark.createDataFrame([("rss", rss), ("atom", atom), ("bad", bad)], "feed string, payload string")
    items = N.news_items(pages, keep=("feed",)).collect()
    by_url = {r.url: r for r in items}
    assert set(by_url) == {"https://a.example.com/1", "https://b.example.com/2", "https://e.example.com/x"}
    a = by_url["https://a.example.com/1"]
    assert a.published_at == datetime(2024, 6, 1, 12) and a.source_domain == "a.example.com"
    import hashlib
    assert a.content_hash == hashlib.sha256("https://a.example.com/1\nA\nfirst".encode()).hexdigest()
    assert by_url["https://b.example.com/2"].summary is None
    assert by_url["https://e.example.com/x"].published_at == datetime(2024, 6, 1)


def test_onchain_and_sentiment(spark):
    item = {"time": "2024-06-01T00:00:00Z", "asset": "btc", "CapMrktCurUSD": "1200000000000", "CapMVRVCur": "2.5",
            "SplyCur": "19700000", "AdrActCnt": "850000", "HashRate": "", "SOPR": None, "PriceRealizedUSD": "35000"}
    r = N.onchain_metrics(_pages(spark, [json.dumps({"data": [item, {"asset": "btc"}]})])).orderBy("_bad").collect()
    assert (r[0].instrument, r[0].date, r[0].market_cap_usd, r[0].active_addresses, r[0].hash_rate) == (
        "BTC", date(2024, 6, 1), 1.2e12, 850000, None)
    assert r[1]._bad
    fg = {"data": [{"timestamp": "1717286400", "value": "70"}, {"timestamp": "1717200000", "value": "65",
                                                                 "value_classification": "Greed"}]}
    rows = N.sentiment(_pages(spark, [json.dumps(fg)])).orderBy("date").collect()
    assert [(x.date, x.fear_greed_value, x.fear_greed_label) for x in rows] == [
        (date(2024, 6, 1), 65, "Greed"), (date(2024, 6, 2), 70, None)]


def test_dominance_history_and_snapshot(spark):
    asset = _pages(spark, [json.dumps({"market_caps": [[1717200000000, 5.35e11], [1717286400000, 1.0]]})])
    total = _pages(spark, [json.dumps({"market_cap_chart": {"market_cap": [[1717200000000, 2e12], [1717200000000, 1e12],
                                                                           [1717286400000, 0.0]]}})])
    hist = N.dominance_history(asset, total)
    assert [(r.date, r.btc_dominance_pct) for r in hist.collect()] == [(date(2024, 6, 1), 53.5)]
    req = spark.createDataFrame([(date(2024, 6, 1),), (date(2024, 6, 2),)], "date date")
    snap_at = datetime(2024, 6, 2, 10, tzinfo=UTC)
    rows = N.market_metric_rows(hist, req, F.lit(55.0), snap_at).orderBy("date").collect()
    assert [(r.btc_dominance_pct, r.source_updated_at) for r in rows] == [
        (53.5, datetime(2024, 6, 1)), (55.0, datetime(2024, 6, 2, 10))]


def test_stablecoin_supply(spark):
    cap = lambda v: json.dumps({"market_data": {"market_cap": {"usd": v}}})
    caps = spark.createDataFrame([("2024-06-01", "tether", cap(80e9)), ("2024-06-01", "usd-coin", cap(25e9)),
                                  ("2024-06-02", "tether", cap(80e9)), ("2024-06-02", "usd-coin", "{}"),
                                  ("2024-06-03", "tether", "{}")], "date string, coin string, payload string")
    rows = N.stablecoin_supply(caps).orderBy("date").collect()
    assert [(r.date, r.total_stablecoin_market_cap_usd, r.usdc_market_cap_usd) for r in rows] == [
        ("2024-06-01", 105e9, 25e9), ("2024-06-02", 80e9, None)]


def test_charts_and_volatility_and_put_call(spark):
    req = spark.createDataFrame([("miners-revenue", date(2024, 6, 1)), ("transaction-fees-usd", date(2024, 6, 1))],
                                "chart_name string, date date")
    pages = spark.createDataFrame([("miners-revenue", date(2024, 6, 1),
                                    json.dumps({"values": [{"x": 1717200000, "y": 30000000.0}]}))],
                                  "chart_name string, date date, payload string")
    rows = {r.chart_name: r.value for r in N.chart_first_values(req, pages).collect()}
    assert rows == {"miners-revenue": 30000000.0, "transaction-fees-usd": None}
    rng = N.chart_range(pages, date(2024, 6, 1), date(2024, 6, 2)).collect()
    assert len(rng) == 1 and N.chart_range(pages, date(2024, 5, 1), date(2024, 6, 1)).count() == 0
    vol = {"result": {"data": [[1717200000000, 31, 36, 30, 33], [1717203600000, 33, 37, 31, 34]]}}
    v = N.volatility_rows(_pages(spark, [json.dumps(vol)])).collect()
    assert [(r.date, r.dvol) for r in v] == [(date(2024, 6, 1), 34.0)]
    book = spark.createDataFrame([("BTC-1JUN24-60000-P", 1000.0), ("BTC-1JUN24-65000-C", 2000.0), ("BTC-X", None)],
                                 "instrument_name string, open_interest double")
    pc = N.put_call(book).collect()[0]
    assert (pc.put_oi, pc.call_oi, pc.put_call_ratio) == (1000.0, 2000.0, 0.5)
    empty = N.put_call(book.filter(F.lit(False))).collect()
    assert len(empty) == 1 and empty[0].put_call_ratio is None


def test_futures_day_assembly(spark):
    oi = spark.createDataFrame([(date(2024, 6, 1), json.dumps([{"symbol": "BTCUSDT", "timestamp": 1, "sumOpenInterest": "1.5"},
                                                               {"symbol": "BTCUSDT", "timestamp": 2, "sumOpenInterest": "871.5"}]))],
                               "date date, payload string")
    basis = spark.createDataFrame([(date(2024, 6, 2), json.dumps([{"pair": "BTCUSDT", "timestamp": 1, "basis": None}]))],
                                  "date date, payload string")
    prem = spark.createDataFrame([(date(2024, 6, 1), json.dumps([[1, "0.001", "0.002", "0.0005", "0.0012", "0", 2]])),
                                  (date(2024, 6, 3), "[]")], "date date, payload string")
    rows = {r.date: r for r in N.futures_metrics(oi, basis, prem).collect()}
    assert set(rows) == {date(2024, 6, 1), date(2024, 6, 2)}
    assert (rows[date(2024, 6, 1)].open_interest, rows[date(2024, 6, 1)].premium_index) == (871.5, 0.0012)
    assert rows[date(2024, 6, 2)].basis is None


def test_html_tag_soup_and_references(spark):
    from tidemark.sources import html_tables as H
    restart = ("<table><tr><th>Date<th>Total</th></tr><tr><td>01 Jun 2024</td><td>1,5</td></tr>"
               "<TR><TD>02 Jun 2024</TD><TD>7</TD></TR></table>")
    encoded = ("<table><tr><th>D&#97;te</th><th>T&#x6f;tal</th></tr>"
               "<tr><td>02 Jun 2024</td><td>&#55;</td></tr></table>")
    clean = "<table><tr><th>Date</th><th>Total</th></tr><tr><td>03 Jun 2024</td><td>&#36;2</td></tr></table>"
    pages = spark.createDataFrame([("restart", restart), ("encoded", encoded), ("clean", clean)],
                                  "page string, html string")
    parsed = {r.page: r._rows for r in pages.select("page", H.table_rows(F.col("html")).alias("_rows")).collect()}
    assert parsed["restart"][0] == ["Total"]          # a new cell start restarts the cell
    assert parsed["encoded"][0] == ["Date", "Total"] and parsed["clean"][1] == ["03 Jun 2024", "$2"]
    rows = N.etf_flows(pages, keep=("page",)).collect()
    assert sorted((r.page, r.date.isoformat(), r.net_flow_usd) for r in rows) == [
        ("clean", "2024-06-03", 2e6), ("encoded", "2024-06-02", 7e6)]


def test_single_kind_feed_parsers(spark):
    from tidemark.sources import feeds
    rss = '<rss><channel><item><title> T </title><link> https://r.example.com/1 </link></item></channel></rss>'
    atom = ('<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>A</title><link href="https://a.example.com/1"/>'
            '<published></published><updated>2024-06-01T00:00:00Z</updated></entry></feed>')
    df = spark.createDataFrame([(rss, atom)], "r string, a string")
    r = feeds.rss_items(df, "r").collect()
    a = feeds.atom_items(df, "a").collect()
    assert [(x.url, x.title) for x in r] == [("https://r.example.com/1", "T")]
    assert [(x.url, x.published_at) for x in a] == [("https://a.example.com/1", datetime(2024, 6, 1))]
    assert df.select(feeds.is_atom(F.col("a")).alias("x"), feeds.is_atom(F.col("r")).alias("y")).first() == (True, False)
