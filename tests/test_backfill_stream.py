"""Backfill over landed pages and the streaming forms."""

import json
import os
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from tidemark.plans.backfill import run_backfill
from tidemark.sources.registry import landing_path
from tidemark.store import TableStore


def _land(root, name, day, pages, sub=""):
    path = landing_path(root, name, day) + sub
    os.makedirs(path, exist_ok=True)
    for i, p in enumerate(pages):
        with open(f"{path}/page-{i}.json", "w") as fh:
            fh.write(p)


def test_backfill_sentiment_and_etf(spark, store_root):
    root = store_root.replace("file:", "") + "-landing"
    fg = {"data": [{"timestamp": str(1717200000 + 86400 * i), "value": str(40 + i), "value_classification": "Fear"}
                   for i in range(5)]}
    _land(root, "sentiment_index", date(2024, 6, 6), [json.dumps(fg)])
    html = ("<table><tr><th>Date</th><th>Total</th></tr><tr><td>01 Jun 2024</td><td>200</td></tr>"
            "<tr><td>02 Jun 2024</td><td>-</td></tr><tr><td>03 Jun 2024</td><td>1,000</td></tr></table>")
    _land(root, "etf_flows", date(2024, 6, 6), [html])
    store = TableStore(spark, store_root + "-wh")
    stamp = datetime(2024, 6, 6, tzinfo=timezone.utc)
    got = run_backfill(spark, root, store, "sentiment_index", date(2024, 6, 1), date(2024, 6, 4), source_updated_at=stamp)
    assert got == {"raw.sentiment_index": 3}
    again = run_backfill(spark, root, store, "sentiment_index", date(2024, 6, 1), date(2024, 6, 6), source_updated_at=stamp)
    assert again == {"raw.sentiment_index": 2}
    assert run_backfill(spark, root, store, "etf_flows", date(2024, 6, 1), date(2024, 7, 1)) == {"raw.etf_flows": 2}
    assert run_backfill(spark, root, None, "etf_flows", date(2024, 6, 1), date(2024, 7, 1), dry_run=True) == {
        "raw.etf_flows": 0}
    with pytest.raises(KeyError):
        run_backfill(spark, root, store, "nope", date(2024, 6, 1), date(2024, 7, 1))


def test_backfill_aborts_on_empty_window(spark, store_root):
    from tidemark.quality import QualityError
    root = store_root.replace("file:", "") + "-landing2"
    fg = {"data": [{"timestamp": "1717200000", "value": "40"}]}
    _land(root, "sentiment_index", date(2024, 6, 6), [json.dumps(fg)])
    with pytest.raises(QualityError, match="not_empty"):
        run_backfill(spark, root, TableStore(spark, store_root + "-wh2"), "sentiment_index",
                     date(2023, 1, 1), date(2023, 2, 1))


def test_stream_forms(spark):
    from tidemark.plans.stream_queries import stream_closed_bars, stream_upsert
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("driver data not present")
    bars = stream_closed_bars(spark, sf)
    ev = spark.read.parquet(f"{sf}/events.parquet")
    wm = ev.agg(F.max("ts")).collect()[0][0]
    latest_end = bars.agg(F.max(F.col("close_time"))).collect()[0][0]
    assert latest_end is not None and latest_end < wm
    assert stream_upsert(spark, sf).count() == ev.count()


@pytest.mark.parametrize("max_files", [64, 1])
def test_events_of_one_type_and_time_are_all_kept(spark, store_root, monkeypatch, max_files):
    """In one micro-batch, and in two, where the later one must not take the other's place."""
    from functools import partial

    from tidemark.plans.stream_queries import stream_upsert
    from tidemark.streaming import jobs as S
    monkeypatch.setattr(S, "read_table_stream", partial(S.read_table_stream, max_files=max_files))
    sf, at = store_root.replace("file:", "") + "-events", datetime(2024, 6, 1, 5)
    files = [[(1, at, "view", 90.0), (2, at, "click", 90.0), (None, datetime(2024, 7, 1), "view", 90.0)],
             [(3, at, "view", 110.0), (4, at, "view", 90.0), (None, datetime(2024, 7, 2), "view", 95.0)]]
    for rows in files if max_files == 1 else [files[0] + files[1]]:
        spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, event_type string, value double").coalesce(1) \
            .write.mode("append").parquet(f"{sf}/events.parquet")
    got = sorted(tuple(r) for r in stream_upsert(spark, sf).collect())
    assert got == sorted((kind, "USDT", ts, (v - 100) / 1000, v * 100) for _, ts, kind, v in files[0] + files[1])


def test_a_stopped_stream_goes_on_where_it_was(spark, store_root):
    """A batch that fails stops the stream; started again with the same checkpoint it takes up the files
    that are left, not those that were committed."""
    from tidemark.streaming.jobs import upsert_stream
    from tidemark.tables import FUNDING_RATES
    landing = store_root.replace("file:", "") + "-landing3"
    for k in range(3):
        spark.createDataFrame([(f"S{k}", "USDT", datetime(2024, 6, 1), 0.1, 1.0)], FUNDING_RATES.schema).coalesce(1) \
            .write.mode("append").parquet(landing)
    store = TableStore(spark, store_root + "-wh3", {FUNDING_RATES.identifier: FUNDING_RATES})
    source = lambda: spark.readStream.schema(FUNDING_RATES.schema).option("maxFilesPerTrigger", "1").parquet(landing)
    seen = []

    def second_fails(batch):
        seen.append(batch.first().instrument)
        if len(seen) == 2:
            raise RuntimeError("stopped")
        return batch

    with pytest.raises(Exception, match="stopped"):
        upsert_stream(source(), store, FUNDING_RATES.identifier, second_fails, store_root + "-ckpt3")
    assert store.read(FUNDING_RATES.identifier).count() == 1
    results = upsert_stream(source(), store, FUNDING_RATES.identifier, lambda b: b, store_root + "-ckpt3")
    assert len(results) == 2 and store.read(FUNDING_RATES.identifier).count() == 3
    assert upsert_stream(source(), store, FUNDING_RATES.identifier, lambda b: b, store_root + "-ckpt3") == []


def test_backfills_of_every_source(spark, store_root):
    """Pages of each kind that a source lands, under the names in their paths."""
    root = store_root.replace("file:", "") + "-landing4"
    day = date(2024, 6, 2)
    ms = 1717200000000                                       # 2024-06-01
    for kind, page in (("open_interest", [{"symbol": "S", "timestamp": ms, "sumOpenInterest": "11"}]),
                       ("basis", [{"pair": "S", "timestamp": ms, "basis": "2.5"}]), ("premium", [[ms, "0", "0", "0", "0.25"]])):
        _land(root, "futures_metrics", day, [json.dumps(page)], f"/kind={kind}/date=2024-06-01")
    _land(root, "macro_calendar", day, [json.dumps({"release_dates": [{"date": "2024-06-03"}]})], "/release=10")
    for kind, page in (("asset", {"market_caps": [[ms, 50.0], [ms + 1, 60.0]]}),
                       ("total", {"market_cap_chart": {"market_cap": [[ms, 100.0], [ms + 1, 100.0]]}})):
        _land(root, "market_metrics", day, [json.dumps(page)], f"/kind={kind}")
    for coin, cap in (("tether", 7.0), ("usd-coin", 3.0)):
        _land(root, "market_metrics", day, [json.dumps({"market_data": {"market_cap": {"usd": cap}}})], f"/coin={coin}/date=2024-06-01")
    _land(root, "onchain_metrics", day, [json.dumps({"values": [{"x": ms // 1000, "y": 4.0}, {"x": ms // 1000 + 86400, "y": 5.0}]})], "/chart=miners-revenue")
    _land(root, "sentiment_index", day, [json.dumps({"result": {"data": [[ms, 1, 2, 3, 44.0], [ms + 1, 1, 2, 3, 45.0]]}})], "/kind=dvol")
    store = TableStore(spark, store_root + "-wh4")
    stamp = datetime(2024, 6, 6, tzinfo=timezone.utc)
    got = {}
    for name in ("futures_metrics", "macro_calendar", "market_metrics", "onchain_metrics", "sentiment_index"):
        got |= run_backfill(spark, root, store, name, date(2024, 6, 1), date(2024, 7, 1), source_updated_at=stamp)
    assert got == {"raw.futures_metrics": 1, "raw.macro_calendar": 1, "raw.market_metrics": 1, "raw.stablecoin_supply": 1,
                   "raw.blockchain_charts": 2, "raw.deribit_dvol": 1}
    assert store.read("raw.futures_metrics").first()[-3:] == (11.0, 2.5, 0.25)
    assert store.read("raw.market_metrics").first().btc_dominance_pct == 60.0
    assert store.read("raw.deribit_dvol").first().dvol == 45.0


@pytest.mark.parametrize("name,sub,page", [
    ("sentiment_index", "", '{"data": [{"timestamp": "1717200000", "value": "forty"}]}'),
    ("sentiment_index", "", '{"data": [{"timestamp": "17172'),
    ("onchain_metrics", "", '{"data": [{"asset": "btc", "time": "2024-06-01T00:00:00Z", "CapMVRVCur": "abc"}]}'),
    ("cot_positioning", "", '[{"market_and_exchange_names": "BITCOIN - X", "report_date_as_yyyy_mm_dd": "2024-06-01", "open_interest_all": "abc"}]'),
    ("futures_metrics", "/kind=open_interest", '[{"timestamp": 1717200000000, "sumOpenInterest": "abc"}]'),
    ("macro_series", "/series=X", '{"observations": [{"date": "2024-06-01", "value": "abc"}]}'),
])
def test_bad_values_and_cut_pages_abort_a_backfill(spark, store_root, name, sub, page):
    root = store_root.replace("file:", "") + "-landing5"
    _land(root, name, date(2024, 6, 2), [page], sub)
    with pytest.raises(ValueError, match="Invalid payload"):
        run_backfill(spark, root, TableStore(spark, store_root + "-wh5"), name, date(2024, 6, 1), date(2024, 7, 1))


def test_a_bad_time_or_a_cut_page_aborts_a_run(spark, store_root):
    from tidemark.plans import runs as R
    store = TableStore(spark, store_root + "-wh6")
    window = dict(interval="1h", window_start=datetime(2024, 6, 1, tzinfo=timezone.utc), window_end=datetime(2024, 6, 2, tzinfo=timezone.utc),
                  as_of=datetime(2024, 6, 3, tzinfo=timezone.utc))
    bar = [1717200000000, "1", "2", "0.5", "1.5", "10", 1717203599999, "15", 3, "5", "7", "0"]
    for pages in (json.dumps([bar, [*bar[:6], "oops", *bar[7:]]]), json.dumps([bar])[:-9]):
        with pytest.raises(ValueError, match="Invalid payload"):
            R.run_candles(store, spark.createDataFrame([(pages,)], "payload string"), **window)
    assert R.run_candles(store, spark.createDataFrame([(json.dumps([bar]),)], "payload string"), **window).metrics["rows_affected"] == 1


def test_a_run_without_checks_writes(spark, store_root):
    from tidemark.plans.jobs import run_job
    store = TableStore(spark, store_root + "-wh7")
    rows = spark.createDataFrame([(date(2024, 6, 1), 52.0, datetime(2024, 6, 2))], "date date, dvol double, source_updated_at timestamp")
    res = run_job(store, "raw.deribit_dvol", rows, [])
    assert (res.metrics["rows"], res.metrics["rows_affected"]) == (1, 1)
    with pytest.raises(Exception, match="is required"):
        run_job(store, "raw.etf_flows", spark.createDataFrame([(date(2024, 6, 1), None, datetime(2024, 6, 2))],
                                                              "date date, net_flow_usd double, source_updated_at timestamp"), [])
