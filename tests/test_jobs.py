"""Run and backfill jobs: gating, empty batches, anti-join, dry-run, news dedup across runs."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark import quality as Q
from tidemark.plans.jobs import backfill_job, run_job
from tidemark.store import TableStore
from tidemark.tables import ETF_FLOWS, MARKET_NEWS_ITEMS, quality_checks


def _etf(spark, rows):
    return spark.createDataFrame(rows, "date date, net_flow_usd double, source_updated_at timestamp")


def test_run_job_writes_and_reports(spark, store_root):
    from datetime import date
    store = TableStore(spark, store_root)
    rows = _etf(spark, [(date(2024, 6, 1), 2e8, datetime(2024, 6, 2)), (date(2024, 5, 31), 1.5e8, datetime(2024, 6, 2))])
    res = run_job(store, ETF_FLOWS.identifier, rows, quality_checks(ETF_FLOWS))
    assert res.metrics["rows_affected"] == 2 and res.metrics["quality_checks_total"] == 2 and res.metrics["quality_failed_errors"] == 0
    assert len(res.reports) == 1 and res.reports[0].subject == "raw.etf_flows"
    again = run_job(store, ETF_FLOWS.identifier, rows, quality_checks(ETF_FLOWS))
    assert again.metrics["rows_affected"] == 0


def test_run_job_empty_and_gate(spark, store_root):
    from datetime import date
    store = TableStore(spark, store_root)
    empty = run_job(store, ETF_FLOWS.identifier, _etf(spark, []), quality_checks(ETF_FLOWS))
    assert empty.metrics["rows_affected"] == 0 and empty.reports == ()
    dup = _etf(spark, [(date(2024, 6, 1), 1.0, datetime(2024, 6, 2)), (date(2024, 6, 1), 2.0, datetime(2024, 6, 2))])
    blocked = run_job(store, ETF_FLOWS.identifier, dup, quality_checks(ETF_FLOWS))
    assert blocked.metrics["rows_affected"] == 0 and blocked.metrics["quality_failed_errors"] == 1
    assert not store.has_data(ETF_FLOWS.identifier)


def test_run_job_strict_abort(spark, store_root):
    store = TableStore(spark, store_root)
    rows = _etf(spark, [(None, 1.0, datetime(2024, 6, 2))]).withColumn("_bad", F.lit(True))
    with pytest.raises(ValueError, match="Invalid payload"):
        run_job(store, ETF_FLOWS.identifier, rows, quality_checks(ETF_FLOWS), strict_flag="_bad")


def test_backfill_anti_join_dry_run_and_abort(spark, store_root):
    from datetime import date
    store = TableStore(spark, store_root)
    ids = ETF_FLOWS.identity
    store.append(ETF_FLOWS.identifier, _etf(spark, [(date(2024, 6, 1), 1.0, datetime(2024, 6, 2))]))
    batch = _etf(spark, [(date(2024, 6, 1), 1.0, datetime(2024, 6, 2)), (date(2024, 6, 2), 2.0, datetime(2024, 6, 3))])
    checks = [Q.not_empty(), *quality_checks(ETF_FLOWS)]
    assert backfill_job(store, ETF_FLOWS.identifier, batch, ids, checks=checks, dry_run=True) == 0
    assert backfill_job(store, ETF_FLOWS.identifier, batch, ids, checks=checks) == 1
    assert backfill_job(store, ETF_FLOWS.identifier, batch, ids, checks=checks) == 0
    assert store.read(ETF_FLOWS.identifier).count() == 2
    dup = batch.unionByName(batch)
    with pytest.raises(Q.QualityError):
        backfill_job(store, ETF_FLOWS.identifier, dup, ids, checks=checks)
    assert store.read(ETF_FLOWS.identifier).count() == 2


def test_news_dedup_across_runs(spark, store_root):
    from tidemark.operators.dedup import first_wins
    from tidemark.operators.joins import anti_by_hash
    from tidemark.plans import normalize as N
    store = TableStore(spark, store_root)
    feed = ('<rss><channel><item><title>T</title><link>https://n.example.com/1</link><description>{s}</description>'
            '</item><item><title>T</title><link>https://n.example.com/1</link><description>{s}</description></item>'
            '</channel></rss>')

    def run(summary):
        pages = spark.createDataFrame([(0, feed.format(s=summary))], "feed_pos int, payload string")
        items = N.news_items(pages, keep=("feed_pos",))
        firsts = first_wins(items, "content_hash", ["feed_pos", "item_pos"])
        new = anti_by_hash(firsts, store.read(MARKET_NEWS_ITEMS.identifier, columns=["content_hash"]))
        rows = new.select(F.col("url").alias("source_url"), "content_hash", F.lit("feed").alias("source_name"),
                          "source_domain", F.lit("rss").alias("source_type"), F.lit(1).cast("long").alias("reliability_tier"),
                          "published_at", F.lit(None).cast("timestamp").alias("fetched_at"), "title",
                          F.col("summary").alias("summary_raw"), F.lit(None).cast("string").alias("content_raw"),
                          F.lit(datetime(2024, 6, 1)).cast("timestamp").alias("source_updated_at"))
        return run_job(store, MARKET_NEWS_ITEMS.identifier, rows, quality_checks(MARKET_NEWS_ITEMS)).metrics["rows_affected"]

    assert run("first") == 1
    assert run("first") == 0
    assert run("edited") == 1


def test_run_tables_and_cli_window(spark, store_root):
    from datetime import date, timezone

    from tidemark.plans.jobs import days_of, run_tables, window_parser
    from tidemark.tables import VOLATILITY_INDEX
    store = TableStore(spark, store_root)
    etf = _etf(spark, [(date(2024, 6, 1), 2e8, datetime(2024, 6, 2))])
    dvol = spark.createDataFrame([(date(2024, 6, 1), 52.0, datetime(2024, 6, 2))],
                                 "date date, dvol double, source_updated_at timestamp")
    res = run_tables(store, [(ETF_FLOWS.identifier, etf, quality_checks(ETF_FLOWS), "quality"),
                             (VOLATILITY_INDEX.identifier, dvol, quality_checks(VOLATILITY_INDEX), "quality_dvol")])
    assert res.metrics["rows_affected"] == 2 and res.metrics["quality_dvol_checks_total"] == 2 and len(res.reports) == 2
    given = window_parser("x", default_start="2024-05-30").parse_args(["--end", "2024-06-02"])
    assert (given.start, given.end, given.dry_run) == (datetime(2024, 5, 30, tzinfo=timezone.utc), datetime(2024, 6, 2, tzinfo=timezone.utc), False)
    assert [d.day for d in days_of(given.start, given.end)] == [30, 31, 1] and days_of(given.end, given.start) == []
    assert window_parser("x", default_start="2024-05-30").parse_args(["--dry-run"]).end.hour == 0


def test_landed_pages_prune_by_day(spark, store_root):
    import os
    from datetime import date

    from tidemark.sources.registry import landing_path, read_landed, source
    root = store_root.replace("file:", "")
    for d, payload in ((date(2024, 6, 1), "[1]"), (date(2024, 6, 2), "[2]")):
        path = landing_path(root, "candles", d)
        os.makedirs(path, exist_ok=True)
        with open(f"{path}/page-0.json", "w") as fh:
            fh.write(payload)
    got = read_landed(spark, root, "candles", start=date(2024, 6, 2)).collect()
    assert [(r.payload, str(r.dt)) for r in got] == [("[2]", "2024-06-02")]
    assert source("candles").page_size == 1000
    with pytest.raises(KeyError):
        source("nope")


def test_select_new_null_keys(spark):
    from tidemark.operators.joins import select_new
    frame = spark.createDataFrame([("a", 1), (None, 2), ("c", 3)], "k string, v long")
    stored = spark.createDataFrame([("a",)], "k string")
    assert sorted(r.v for r in select_new(frame, stored, ["k"]).collect()) == [3]
    none = stored.filter(F.lit(False))
    assert sorted(r.v for r in select_new(frame, none, ["k"]).collect()) == [1, 2, 3]


def test_identity_proven_only_by_passed_baseline(spark):
    from datetime import date

    from tidemark.plans.jobs import _identity_proven
    rows = _etf(spark, [(date(2024, 6, 1), 1.0, datetime(2024, 6, 2))])
    ok = Q.validate(rows, quality_checks(ETF_FLOWS))
    assert _identity_proven(ok, ETF_FLOWS.identity)
    warn_only = Q.validate(rows, [Q.not_null("date"), Q.unique("date", severity=Q.Severity.WARN)])
    assert not _identity_proven(warn_only, ETF_FLOWS.identity)
    assert not _identity_proven(Q.validate(rows, [Q.not_null("date")]), ETF_FLOWS.identity)
