"""Streams that remember: late events, stored hashes, landed pages."""

import json
import os
from datetime import date, datetime, timezone

import pytest

from tidemark.sources.registry import landing_path
from tidemark.spec import table_spec
from tidemark.store import TableStore
from tidemark.streaming import jobs as S
from tidemark.streaming.landing import LANDED, run_landed

AT = datetime(2024, 6, 20, tzinfo=timezone.utc)
ITEMS = table_spec("raw.items", {"h": str, "t": datetime, "body": str | None}, sort=("t",), member="h")


def _land(root, name, day, file, text, sub=""):
    path = landing_path(root, name, day) + sub
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{file}", "w") as fh:
        fh.write(text)


def _greed(*days):
    return json.dumps({"data": [{"timestamp": str(1717200000 + 86400 * d), "value": str(v), "value_classification": "Fear"} for d, v in days]})


def test_late_events_change_their_bars(spark, store_root):
    landing, checkpoint = store_root.replace("file:", "") + "-ev", store_root + "-ck"
    store = TableStore(spark, store_root, {t.identifier: t for t in (S.EVENTS, S.BARS)})
    schema = "event_id long, instrument string, ts timestamp, v double"
    h = lambda day, hour, minute=0: datetime(2024, 3, day, hour, minute)
    batches = [[(1, "a", h(1, 5), 10.0), (2, "a", h(1, 5, 30), 20.0), (3, "b", h(1, 5), 1.0)], [(4, "a", h(30, 1), 7.0)],
               [(5, "a", h(1, 5, 45), 5.0), (6, "a", h(1, 6), 2.0)], [(2, "a", h(1, 5, 30), 20.0)]]
    results = []
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landing)
        results.append(S.reopened_bars(spark.readStream.schema(schema).parquet(landing), store, checkpoint))
    bars = {(r.instrument, r.open_time.day, r.open_time.hour): (r.open, r.high, r.low, r.close, r.volume, r.number_of_trades) for r in store.read(S.BARS.identifier).collect()}
    assert bars == {("a", 1, 5): (10.0, 20.0, 5.0, 5.0, 35.0, 3), ("b", 1, 5): (1.0, 1.0, 1.0, 1.0, 1.0, 1),
                    ("a", 30, 1): (7.0, 7.0, 7.0, 7.0, 7.0, 1), ("a", 1, 6): (2.0, 2.0, 2.0, 2.0, 2.0, 1)}
    assert [[(r.rows_inserted, r.rows_updated) for r in rs] for rs in results] == [[(2, 0)], [(1, 0)], [(1, 1)], [(0, 0)]]


def test_a_hash_stored_long_ago_is_not_stored_again(spark, store_root):
    landing, checkpoint = store_root.replace("file:", "") + "-it", store_root + "-ck"
    store = TableStore(spark, store_root, {ITEMS.identifier: ITEMS})
    store.append(ITEMS.identifier, spark.createDataFrame([("old", datetime(2019, 1, 1), "kept")], ITEMS.schema))
    schema = "h string, t timestamp, body string, n int"
    seen = []

    def to_rows(batch):
        seen.append(1)
        if len(seen) == 2:
            raise RuntimeError("stopped")
        return batch

    def stream():
        return S.append_unseen(spark.readStream.schema(schema).option("maxFilesPerTrigger", "1").parquet(landing), store, ITEMS.identifier, to_rows, ["n"], checkpoint)

    for rows in ([("old", datetime(2024, 1, 1), "again", 0), ("x", datetime(2024, 1, 1), "second", 2), ("x", datetime(2024, 1, 1), "first", 1)],
                 [("x", datetime(2024, 5, 1), "third", 0), ("y", datetime(2024, 5, 1), "y", 0)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(landing)
    with pytest.raises(Exception, match="stopped"):
        stream()
    assert [r.rows_inserted for r in stream()] == [1]
    assert sorted((r.h, r.body) for r in store.read(ITEMS.identifier).collect()) == [("old", "kept"), ("x", "first"), ("y", "y")]


def test_landed_pages_are_read_once(spark, store_root):
    root, checkpoint = store_root.replace("file:", "") + "-land", store_root + "-ck"
    store = TableStore(spark, store_root)
    go = lambda **how: run_landed(spark, store, root, "sentiment_index", checkpoint=checkpoint, at=AT, **how)
    assert go() == []
    _land(root, "sentiment_index", date(2024, 6, 6), "page-0.json", _greed((0, 40), (1, 41)))
    rows = [r.metrics for r in go()]
    assert [m["rows"] for m in rows] == [2, 0] and rows[0]["rows_affected"] == 2
    assert go() == []
    _land(root, "sentiment_index", date(2024, 6, 6), "page-1.json", _greed((1, 50), (2, 42)))      # an old day's folder
    _land(root, "sentiment_index", date(2024, 6, 7), "page-0.json", _greed((3, 43)))

    def lost(batch_id):
        raise RuntimeError("driver lost")

    with pytest.raises(Exception, match="driver lost"):
        go(after_write=lost)
    held = sorted((r.date.day, r.fear_greed_value) for r in store.read("raw.sentiment_index").collect())
    assert [r.metrics["rows_affected"] for r in go()] == [0, 0]      # read again, as its commit was lost; nothing changes
    assert held == [(1, 40), (2, 50), (3, 42), (4, 43)] == sorted((r.date.day, r.fear_greed_value) for r in store.read("raw.sentiment_index").collect())
    assert go() == []


def test_rows_of_several_pages_get_whole_days(spark, store_root):
    root, checkpoint = store_root.replace("file:", "") + "-land", store_root + "-ck"
    store, day = TableStore(spark, store_root), date(2024, 6, 1)
    ms = 1717200000000
    _land(root, "futures_metrics", day, "p.json", json.dumps([{"timestamp": ms, "sumOpenInterest": "5"}]), "/kind=open_interest")
    go = lambda: run_landed(spark, store, root, "futures_metrics", checkpoint=checkpoint, at=AT)
    go()
    _land(root, "futures_metrics", day, "p.json", json.dumps([{"timestamp": ms, "basis": "2.5"}]), "/kind=basis")
    go()
    [row] = store.read("raw.futures_metrics").collect()
    assert (row.date, row.open_interest, row.basis, row.premium_index) == (day, 5.0, 2.5, None)


def test_news_pages_by_feed(spark, store_root):
    root, store = store_root.replace("file:", "") + "-land", TableStore(spark, store_root)
    page = lambda n: f"<rss><channel><item><title>t{n}</title><link>https://a.b/{n}</link></item></channel></rss>"
    go = lambda: run_landed(spark, store, root, "market_news", checkpoint=store_root + "-ck", at=AT)
    _land(root, "market_news", date(2024, 6, 1), "a.xml", page(1), "/feed=0")
    [first] = go()
    _land(root, "market_news", date(2024, 6, 2), "a.xml", page(1), "/feed=2")
    _land(root, "market_news", date(2024, 6, 2), "b.xml", page(2), "/feed=2")
    [second] = go()
    assert (first.metrics["items_seen"], first.metrics["items_written"]) == (1, 1)
    assert (second.metrics["items_seen"], second.metrics["items_written"]) == (2, 1)
    assert sorted((r.source_url, r.source_name[:3]) for r in store.read("raw.market_news_items").collect()) == [("https://a.b/1", "SEC"), ("https://a.b/2", "Coi")]


def test_every_source_has_a_run(spark):
    from tidemark.sources.registry import SOURCES
    assert {*LANDED, "market_news"} == set(SOURCES)
    with pytest.raises(KeyError):
        run_landed(spark, None, "/nowhere", "nope", checkpoint="", at=AT)
