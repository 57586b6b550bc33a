"""Structured Streaming forms of the batch jobs.

* closed bars: event-time windows with a watermark; append mode emits a bar only
  once the watermark has passed its end (the streaming form of the closed-bar
  filter), into a file sink (no driver-side collection).
* late events: `reopened_bars` keeps the events and makes the bars again that a batch touches, so a bar is
  right however late its events come.
* dedup for good: `append_unseen` asks the stored table, not state that a watermark drops.
* keyed upsert per micro-batch: ``foreachBatch`` calls the same idempotent
  ``TableStore.upsert``; a replayed batch after a failure rewrites the same rows,
  so the sink is effectively exactly-once.

The caller names the checkpoint folder (shared, and the same at every start), so a restarted driver
resumes after the last committed batch.  ``MAX_FILES`` bounds a micro-batch.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.dedup import first_wins
from tidemark.spec import table_spec
from tidemark.store import TableStore, WriteResult

#: Files of one micro-batch.
MAX_FILES = 64


def read_table_stream(spark: SparkSession, sf_dir: str, name: str, max_files: int = MAX_FILES) -> DataFrame:
    """Stream the parquet files of one table (new files are picked up as they land).
    A table is either a folder of part files or a single file inside ``sf_dir``."""
    from tidemark.session import hadoop_fs
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", str(max_files))
    fs, hpath = hadoop_fs(spark, path)
    if fs.getFileStatus(hpath).isDirectory():
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def _finish(query) -> None:
    """Wait for an ``availableNow`` query to the end, however long it takes; its failure is raised here."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def closed_bars(events: DataFrame, *, ts: str = "ts", key: str = "event_type", value: str = "value",
                bar: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """Streaming OHLC bars; a bar is emitted once closed (watermark past its end)."""
    src = events.select(F.col(key).alias("instrument"), F.col(ts).cast("timestamp").alias("ts"), F.col(value).alias("v"))
    agg = (src.withWatermark("ts", delay)
           .groupBy(F.window("ts", bar), "instrument")
           .agg(F.min_by("v", "ts").alias("open"), F.max("v").alias("high"), F.min("v").alias("low"),
                F.max_by("v", "ts").alias("close"), F.round(F.sum("v"), 2).alias("volume"),
                F.count(F.lit(1)).alias("number_of_trades")))
    return agg.select("instrument", F.col("window.start").alias("open_time"),
                      (F.col("window.end") - F.expr("INTERVAL 1 MILLISECOND")).alias("close_time"),
                      "open", "high", "low", "close", "volume", "number_of_trades")


def run_to_files(stream: DataFrame, folder: str) -> str:
    """Run a streaming query over everything available (``availableNow``) into a parquet sink under
    ``folder``; returns the output folder.

    The checkpoint is there too: a run that was stopped goes on after its last committed batch when it
    is started again with the same folder, and a finished one takes up what has landed since."""
    q = (stream.writeStream.format("parquet").option("path", f"{folder}/out")
         .option("checkpointLocation", f"{folder}/checkpoint").outputMode("append")
         .trigger(availableNow=True).start())
    _finish(q)
    return f"{folder}/out"


def upsert_stream(stream: DataFrame, store: TableStore, table: str,
                  transform: Callable[[DataFrame], DataFrame], checkpoint: str) -> list[WriteResult]:
    """Each micro-batch -> ``transform`` -> keyed upsert.  Returns the write results of this run.

    ``checkpoint`` is the caller's: started again with the same one, the stream goes on after the last
    committed batch; a batch that was written but not committed is upserted once more, which changes
    nothing."""
    results: list[WriteResult] = []

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        results.append(store.upsert(table, transform(batch)))

    q = (stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    _finish(q)
    return results


def dedup_stream(items: DataFrame, *, key: str = "content_hash", ts: str = "published_at",
                 delay: str = "1 day") -> DataFrame:
    """Streaming first-seen dedup: state keeps each key until the watermark passes
    its event time plus ``delay``; duplicates arriving within that span are dropped
    (bounded state, unlike an unbounded ``dropDuplicates``)."""
    return items.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def append_unseen(stream: DataFrame, store: TableStore, table: str, to_rows: Callable[[DataFrame], DataFrame],
                  order: Sequence[str], checkpoint: str) -> list[WriteResult]:
    """Stream items into a table that keeps each value of its member column once, for good: a batch's first
    of each value (by ``order``) is appended if the table does not hold the value, however long ago it was
    stored and by whomever.  Unlike state within a watermark, the memory is the table itself, asked through
    its membership filters, so nothing is kept in the stream; a batch that is run again after a failure
    finds its own rows stored.  ``to_rows`` gives the table's columns, and those of ``order``."""
    spec, results = store.spec(table), []

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        firsts = first_wins(to_rows(batch), spec.member, list(order)).persist()
        try:
            results.append(store.append(table, store.unseen(table, firsts).select(*spec.columns)))
        finally:
            firsts.unpersist()

    _finish(stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    return results


#: Events as they are kept for bars that may have to be made again, and the bars.
EVENTS = table_spec("stream.events", {"event_id": int, "instrument": str, "ts": datetime, "v": float | None},
                    identity=("event_id", "ts"), partition=("days(ts)",), sort=("ts", "event_id"))
BARS = table_spec("stream.bars", {"instrument": str, "open_time": datetime, "close_time": datetime, "open": float | None, "high": float | None,
                                  "low": float | None, "close": float | None, "volume": float | None, "number_of_trades": int},
                  identity=("instrument", "open_time"), partition=("months(open_time)",), sort=("open_time", "instrument"))


def bars_of(events: DataFrame, bar: str = "1 hour") -> DataFrame:
    """OHLC bars of stored events."""
    made = events.groupBy("instrument", F.window("ts", bar).alias("w")).agg(
        F.min_by("v", "ts").alias("open"), F.max("v").alias("high"), F.min("v").alias("low"), F.max_by("v", "ts").alias("close"),
        F.round(F.sum("v"), 2).alias("volume"), F.count(F.lit(1)).alias("number_of_trades"))
    return made.select("instrument", F.col("w.start").alias("open_time"), (F.col("w.end") - F.expr("INTERVAL 1 MILLISECOND")).alias("close_time"),
                       "open", "high", "low", "close", "volume", "number_of_trades")


def reopened_bars(events: DataFrame, store: TableStore, checkpoint: str, bar: str = "1 hour") -> list[WriteResult]:
    """Bars that late events change: each micro-batch ``(event_id, instrument, ts, v)`` is kept in ``EVENTS``,
    and the bars that it touches, however old, are made again from all events kept for them and upserted.

    Only the windows of the batch are read: its first and last time prune the days, its windows the rest.
    A batch that is run again changes nothing."""
    results: list[WriteResult] = []

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.select(*EVENTS.columns).persist()
        try:
            store.upsert(EVENTS.identifier, batch)
            touched = batch.select("instrument", F.window("ts", bar).alias("w")).distinct()
            low, high = batch.agg(F.min(F.window("ts", bar)["start"]), F.max(F.window("ts", bar)["end"])).first()
            if low is None:
                return
            kept = store.read_window(EVENTS.identifier, "ts", low, high, include_high=False).withColumn("w", F.window("ts", bar))
            made = bars_of(kept.join(touched, ["instrument", "w"], "left_semi").drop("w"), bar)
            results.append(store.upsert(BARS.identifier, made))
        finally:
            batch.unpersist()

    _finish(events.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    return results
