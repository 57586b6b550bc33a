"""Landed pages found once: a file stream over a source's landing folder feeds its daily run.

The stream's checkpoint knows which pages have been read, so a run takes up those that landed since the
last one, whatever day folder they lie in, and nobody has to name them.  Each micro-batch is normalised,
tested, gated and upserted as a daily run does; a run that dies between its write and the stream's commit
reads the same pages again, which changes nothing.

Sources that make a row of several pages (``WHOLE_DAYS``) get the whole day folders that a batch touches.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans import normalize as N
from tidemark.plans.backfill import PLANS, Plan
from tidemark.plans.jobs import JobRun, run_job
from tidemark.plans.runs import run_market_news
from tidemark.session import file_names
from tidemark.sources.registry import EXCHANGE_FLOW_ASSET, EXCHANGE_FLOW_EXCHANGE, feeds_frame, landing_path, read_landed
from tidemark.store import TableStore
from tidemark.tables import quality_checks

#: Pages of one micro-batch.
MAX_PAGES = 10_000
#: Sources whose rows are assembled from the pages of a day.
WHOLE_DAYS = ("futures_metrics", "market_metrics")

#: What becomes of landed pages ``(dt, page, payload)``, by source: the plans of the backfills, and one more.
LANDED: dict[str, list[Plan]] = PLANS | {
    "exchange_flows": [Plan("raw.exchange_flows", "date", lambda p, at: N.exchange_flows(
        p, asset=F.lit(EXCHANGE_FLOW_ASSET), exchange=F.lit(EXCHANGE_FLOW_EXCHANGE), source_updated_at=at))]}


def landed_stream(spark: SparkSession, root: str, name: str, max_pages: int = MAX_PAGES) -> DataFrame:
    """New pages of a source as ``(dt, page, payload)``."""
    base, page = landing_path(root, name), F.input_file_name()
    files = (spark.readStream.format("text").schema("value string").option("wholetext", "true").option("recursiveFileLookup", "true")
             .option("maxFilesPerTrigger", str(max_pages)).load(base))
    return files.select(F.regexp_extract(page, "/dt=([0-9-]+)/", 1).cast("date").alias("dt"), page.alias("page"), F.col("value").alias("payload"))


def consume(store: TableStore, name: str, pages: DataFrame, at: datetime) -> list[JobRun]:
    """The run of a source over some of its pages: each of its tables is gated and written on its own."""
    if name == "market_news":       # the feed that a page belongs to is in its path
        feed = F.regexp_extract("page", "feed=([0-9]+)/", 1).cast("int")
        return [run_market_news(store, pages.select(feed.alias("feed_pos"), "payload"), feeds_frame(store.spark), fetched_at=at)]
    runs = []
    for plan in LANDED[name]:
        rows, spec = plan.build(pages, at), store.spec(plan.table)
        runs.append(run_job(store, plan.table, rows.select(*spec.columns, *(["_bad"] if "_bad" in rows.columns else [])), quality_checks(spec)))
    return runs


def run_landed(spark: SparkSession, store: TableStore, root: str, name: str, *, checkpoint: str, at: datetime,
               max_pages: int = MAX_PAGES, after_write: Callable[[int], None] | None = None) -> list[JobRun]:
    """Everything that a source has landed since the last run with this ``checkpoint``; ``at`` is the time of
    the run.  ``after_write`` is called with the batch's number once its rows are stored."""
    if name != "market_news" and name not in LANDED:
        raise KeyError(f"no run over landed pages for {name!r}; available: {sorted([*LANDED, 'market_news'])}")
    if not file_names(spark, landing_path(root, name)):
        return []                   # nothing has ever landed
    runs: list[JobRun] = []

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        pages = batch.persist()
        try:
            whole = pages
            if name in WHOLE_DAYS:
                first, last = pages.agg(F.min("dt"), F.max("dt")).first()
                if first is None:
                    return
                days = read_landed(spark, root, name, start=first, end=last + timedelta(days=1))
                whole = days.join(pages.select("dt").distinct(), "dt", "left_semi")
            runs.extend(consume(store, name, whole, at))
        finally:
            pages.unpersist()
        if after_write:
            after_write(batch_id)

    query = (landed_stream(spark, root, name, max_pages).writeStream.foreachBatch(write_batch)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return runs
