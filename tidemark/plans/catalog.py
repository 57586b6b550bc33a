"""All registered queries (importing the query modules fills the registry) and
the flagship job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans import (  # noqa: F401
    backfill_queries,
    payload_queries,
    quality_queries,
    relational_queries,
    store_queries,
    stream_queries,
)
from tidemark.plans.registry import AS_OF, ORACLES, QUERIES, finish
from tidemark.session import apply_session_settings, scratch_path
from tidemark.store import TableStore
from tidemark.tables import CANDLES, candle_checks

__all__ = ["ORACLES", "QUERIES", "flagship", "pinned_queries"]


def pinned_queries() -> dict:
    """The registered queries, each pinning the runtime settings it relies on
    (UTC session time zone, AQE, dynamic partition overwrite) before planning."""
    def pin(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_session_settings(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        return run
    return {name: pin(fn) for name, fn in QUERIES.items()}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily candles run: klines -> closed bars -> validate -> gate -> upsert -> read."""
    from tidemark.operators.windows import closed_bars
    from tidemark.plans.jobs import run_job
    from tidemark.plans.payload_queries import candle_rows

    apply_session_settings(spark)
    store = TableStore(spark, scratch_path(spark, "flagship-store"))
    rows = closed_bars(candle_rows(spark, sf_dir), as_of=AS_OF)
    result = run_job(store, CANDLES.identifier, rows, candle_checks(), max_columns=("close_time",))
    if result.reports and not result.reports[0].ok:
        result.reports[0].require_ok()
    return finish(store.read(CANDLES.identifier).orderBy(F.col("open_time"), F.col("instrument")))
