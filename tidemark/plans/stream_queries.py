"""Streaming queries: the stream runs over the driver table's files to
completion (``availableNow``), then its sink is read back."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans import landed
from tidemark.plans.payload_queries import BARS_SQL
from tidemark.plans.registry import AS_OF, SOURCE_UPDATED_AT, finish, load, register
from tidemark.session import scratch_path
from tidemark.store import TableStore
from tidemark.streaming import jobs as S
from tidemark.tables import FUNDING_RATES

#: Funding rates made of events.  Events of one type may share their time, so the key holds the event's id too
#: (as text, empty if it is null).
EVENT_RATES = replace(FUNDING_RATES, schema=T.StructType([*FUNDING_RATES.schema.fields, T.StructField("event", T.StringType(), False)]),
                      identity=(*FUNDING_RATES.identity, "event"))


@register("stream_closed_bars", f"""
SELECT instrument, open_time, close_time, open, high, low, close, volume, number_of_trades
FROM ({BARS_SQL}) b
WHERE open_time + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR
""")
def stream_closed_bars(spark: SparkSession, sf_dir: str):
    """Watermarked hourly windows in append mode: only bars the watermark has closed."""
    bars = S.closed_bars(S.read_table_stream(spark, sf_dir, "events"))
    out = S.run_to_files(bars, scratch_path(spark, "stream-bars"))
    return finish(spark.read.parquet(out))


@register("stream_upsert", """
SELECT event_type AS instrument, 'USDT' AS counterpart, ts AS funding_time,
       (value - 100) / 1000 AS funding_rate, value * 100 AS mark_price
FROM events
""")
def stream_upsert(spark: SparkSession, sf_dir: str):
    """Micro-batches upserted into ``raw.funding_rates``, one row an event; the same
    stream replayed from a fresh checkpoint changes nothing (idempotent sink)."""
    store = TableStore(spark, scratch_path(spark, "stream-store"), {EVENT_RATES.identifier: EVENT_RATES})

    def to_rows(batch):
        return batch.select(F.col("event_type").alias("instrument"), F.lit("USDT").alias("counterpart"),
                            F.col("ts").cast("timestamp").alias("funding_time"),
                            ((F.col("value") - 100) / 1000).alias("funding_rate"),
                            (F.col("value") * 100).alias("mark_price"),
                            F.coalesce(F.col("event_id").cast("string"), F.lit("")).alias("event"))

    S.upsert_stream(S.read_table_stream(spark, sf_dir, "events"), store, EVENT_RATES.identifier, to_rows,
                    scratch_path(spark, "stream-upsert"))
    replay = S.upsert_stream(S.read_table_stream(spark, sf_dir, "events"), store, EVENT_RATES.identifier, to_rows,
                             scratch_path(spark, "stream-replay"))
    assert sum(r.rows_affected for r in replay) == 0, "replayed stream must not change the table"
    return finish(store.read(EVENT_RATES.identifier, columns=FUNDING_RATES.columns))


@register("stream_hash_dedup", """
SELECT DISTINCT sha256(event_type || chr(10) || chr(10) || CAST(CAST(floor(value) AS BIGINT) AS VARCHAR)) AS content_hash
FROM events
""")
def stream_hash_dedup(spark: SparkSession, sf_dir: str):
    """Items keyed by a content hash that repeats across events; the stream keeps
    the first of each hash within the watermark span (stateful dedup)."""
    from tidemark.functions.text import content_hash
    events = S.read_table_stream(spark, sf_dir, "events")
    items = events.select(
        content_hash(F.col("event_type"), F.lit(""), F.floor("value").cast("long").cast("string")).alias("content_hash"),
        F.col("ts").cast("timestamp").alias("published_at"))
    out = S.run_to_files(S.dedup_stream(items, delay="40 days"), scratch_path(spark, "stream-dedup"))
    return spark.read.parquet(out).select("content_hash")


@register("stream_dedup_history", """
SELECT sha256(lang || chr(10) || chr(10) || text) AS content_hash, max(CASE WHEN lang = 'de' THEN 'document' ELSE 'stream' END = 'document') AS stored_before
FROM documents GROUP BY 1
""")
def stream_dedup_history(spark: SparkSession, sf_dir: str):
    """The German documents were stored long ago; all documents are streamed, twice: each text is stored
    once, and the old ones stay as they were."""
    from tidemark.functions.text import content_hash
    from tidemark.plans.relational_queries import document_items
    from tidemark.plans.store_queries import news_store
    store = news_store(spark, document_items(spark, sf_dir).filter(F.col("lang") == "de"))
    none = lambda kind: F.lit(None).cast(kind)

    def to_rows(batch):
        return batch.select(
            "doc_id", F.col("lang").alias("source_url"), content_hash(F.col("lang"), F.lit(""), F.col("text")).alias("content_hash"),
            F.col("source").alias("source_name"), none("string").alias("source_domain"), F.lit("stream").alias("source_type"),
            none("long").alias("reliability_tier"), none("timestamp").alias("published_at"), none("timestamp").alias("fetched_at"),
            F.lit("").alias("title"), F.col("text").alias("summary_raw"), none("string").alias("content_raw"),
            F.lit(SOURCE_UPDATED_AT).cast("timestamp").alias("source_updated_at"))

    for _ in range(2):
        S.append_unseen(S.read_table_stream(spark, sf_dir, "documents"), store, "raw.market_news_items", to_rows, ["doc_id"], scratch_path(spark, "stream-unseen"))
    return store.read("raw.market_news_items").select("content_hash", (F.col("source_type") == "document").alias("stored_before"))


@register("stream_late_bars", f"""
SELECT instrument, open_time, close_time, open, high, low, close, volume, number_of_trades FROM ({BARS_SQL}) b
""")
def stream_late_bars(spark: SparkSession, sf_dir: str):
    """Every seventh event comes after all others, weeks behind the newest: the bars are those of all events."""
    landing, store = scratch_path(spark, "late-events"), TableStore(spark, scratch_path(spark, "late-store"), {t.identifier: t for t in (S.EVENTS, S.BARS)})
    events = load(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("instrument"), F.col("ts").cast("timestamp").alias("ts"),
                                                 F.col("value").cast("double").alias("v"))
    checkpoint = scratch_path(spark, "late-checkpoint")
    for late in (F.col("event_id") % 7 != 0, F.col("event_id") % 7 == 0):
        events.where(late).write.mode("append").parquet(landing)
        S.reopened_bars(spark.readStream.schema(events.schema).parquet(landing), store, checkpoint)
    return finish(store.read(S.BARS.identifier))


@register("run_landed", f"""
WITH h AS (SELECT date_trunc('hour', ts) AS open_time, arg_min(value, ts) AS open, max(value) AS high, min(value) AS low, arg_max(value, ts) AS close,
                  round(sum(value), 2) AS volume, count(*) AS trades FROM events GROUP BY 1)
SELECT 'BTC' AS instrument, 'USDT' AS counterpart, '1h' AS interval, open_time, open_time + INTERVAL 3599999 MILLISECOND AS close_time,
       open, high, low, close, volume, volume * 2 AS quote_asset_volume, trades AS number_of_trades,
       volume / 2 AS taker_buy_base_asset_volume, volume / 4 AS taker_buy_quote_asset_volume
FROM h
""")
def run_landed_query(spark: SparkSession, sf_dir: str):
    """Hourly klines land day by day, in two parts; the run finds each part's pages by itself, and a third
    run finds none."""
    from tidemark.plans.backfill_queries import land
    from tidemark.streaming.landing import run_landed
    root, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "landed-checkpoint")
    store = TableStore(spark, scratch_path(spark, "landed-store"))
    bars = landed.bars(load(spark, sf_dir, "events").withColumn("event_type", F.lit("all"))).withColumn("h", F.col("open_time")).persist()
    early = F.dayofmonth("h") % 2 == 0
    for part in (early, ~early):
        land(bars.where(part), landed.kline_json(bars), f"{root}/candles", interval=F.lit("1h"))
        assert run_landed(spark, store, root, "candles", checkpoint=checkpoint, at=AS_OF)
    assert run_landed(spark, store, root, "candles", checkpoint=checkpoint, at=AS_OF) == []
    return finish(store.read("raw.candles"))
