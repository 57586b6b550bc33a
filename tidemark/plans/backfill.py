"""Generic backfill over landed pages: one entry point for every source.

    python -m tidemark.plans.backfill --source etf_flows --landing <root> --warehouse <root> \\
        --start 2024-01-01 --end 2024-07-01 [--dry-run]

Per table: normalise the landed pages -> half-open date window ``[start, end)`` -> strict test and
checks (``not_empty``, ``time_in_window`` inclusive on both ends, table rules) -> hard gate ->
anti-join against stored identities -> append.

Pages that landed before the window's first day cannot hold its days and are pruned by their folder.
What a page belongs to, where a source lands several kinds, is in its path: ``kind=``, ``chart=``,
``series=``, ``release=``, ``date=``.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, time, timezone
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import quality as Q
from tidemark.operators.windows import window_half_open
from tidemark.plans import normalize as N
from tidemark.plans.jobs import backfill_job, window_parser
from tidemark.sources.registry import SOURCES, read_landed, releases_frame, source
from tidemark.store import TableStore
from tidemark.tables import quality_checks, resolve


class Plan(NamedTuple):
    """Rows of a table, by its time column, from the landed pages and the time of the run."""

    table: str
    time_col: str
    build: Callable[[DataFrame, datetime], DataFrame]


def _in_path(name: str) -> Column:
    """The value of ``name=`` in a page's path; null if it has none."""
    return F.nullif(F.regexp_extract("page", f"{name}=([^/]+)/", 1), F.lit(""))


def _of_kind(pages: DataFrame, kind: str) -> DataFrame:
    return pages.filter(_in_path("kind") == kind)


def _dated(pages: DataFrame, kind: str) -> DataFrame:
    """Pages of a kind by the day that they tell of: that in their path, else that of their landing."""
    day = F.coalesce(_in_path("date").cast("date"), F.col("dt").cast("date"))
    return _of_kind(pages, kind).select(day.alias("date"), F.col("page").alias("page_no"), "payload")


def _candles(pages: DataFrame, _: datetime) -> DataFrame:
    interval = F.coalesce(F.col("interval"), F.lit("1d")) if "interval" in pages.columns else F.coalesce(_in_path("interval"), F.lit("1d"))
    return N.candles(pages, instrument=F.lit("BTC"), counterpart=F.lit("USDT"), interval=interval)


def _dominance(pages: DataFrame, at: datetime) -> DataFrame:
    """History only: a day that it does not hold has no row (a snapshot tells of the day of its run)."""
    history = N.dominance_history(_of_kind(pages, "asset"), _of_kind(pages, "total"))
    return N.market_metric_rows(history, history.select("date").distinct(), F.lit(None).cast("double"), at)


def _caps(pages: DataFrame, at: datetime) -> DataFrame:
    coins = pages.select(F.coalesce(_in_path("date").cast("date"), F.col("dt").cast("date")).alias("date"), _in_path("coin").alias("coin"), "payload")
    return N.stablecoin_supply(coins.filter("coin is not null"), source_updated_at=at)


def _charts(pages: DataFrame, at: datetime) -> DataFrame:
    charts = pages.select(_in_path("chart").alias("chart_name"), "payload").filter("chart_name is not null")
    return N.chart_range(charts, source_updated_at=at)


def _usdt(make: Callable[..., DataFrame], counterpart: str = "USDT", **fixed) -> Callable[[DataFrame], DataFrame]:
    return lambda pages: make(pages, instrument=F.lit("BTC"), counterpart=F.lit(counterpart), **fixed)


PLANS: dict[str, list[Plan]] = {
    "candles": [Plan("raw.candles", "open_time", _candles)],
    "funding_rates": [Plan("raw.funding_rates", "funding_time", lambda p, at: _usdt(N.funding_rates)(p))],
    "futures_metrics": [Plan("raw.futures_metrics", "date", lambda p, at: N.futures_metrics(
        *(_dated(p, kind) for kind in ("open_interest", "basis", "premium"))))],
    "long_short_ratio": [Plan("raw.long_short_ratio", "date", lambda p, at: _usdt(N.long_short, source_updated_at=at)(p))],
    "cot_positioning": [Plan("raw.cot_positioning", "report_date", lambda p, at: N.cot_positioning(
        p, market_prefix="BITCOIN -", source_updated_at=at))],
    "etf_flows": [Plan("raw.etf_flows", "date", lambda p, at: N.etf_flows(
        p.withColumnRenamed("payload", "html"), keep=("page",), source_updated_at=at).drop("page", "row_pos"))],
    "macro_calendar": [Plan("raw.macro_calendar", "event_time_utc", lambda p, at: N.macro_calendar(
        p.select(_in_path("release").cast("long").alias("release_id"), "payload"), releases_frame(p.sparkSession), source_updated_at=at))],
    "macro_series": [Plan("raw.macro_series", "date", lambda p, at: N.macro_series(p, series_id=_in_path("series"), source_updated_at=at))],
    "market_metrics": [Plan("raw.market_metrics", "date", _dominance), Plan("raw.stablecoin_supply", "date", _caps)],
    "onchain_metrics": [
        Plan("raw.onchain_metrics", "date", lambda p, at: _usdt(N.onchain_metrics, "USD", source_updated_at=at)(p.filter(_in_path("chart").isNull()))),
        Plan("raw.blockchain_charts", "date", _charts)],
    "sentiment_index": [
        Plan("raw.sentiment_index", "date", lambda p, at: N.sentiment(p.filter(_in_path("kind").isNull()), source_updated_at=at)),
        Plan("raw.deribit_dvol", "date", lambda p, at: N.volatility_rows(
            _of_kind(p, "dvol").withColumnRenamed("page", "page_no"), source_updated_at=at))],
}


def _bound(day: date, kind: str) -> date | datetime:
    return datetime.combine(day, time(), timezone.utc) if kind == "timestamp" else day


def run_backfill(spark: SparkSession, landing: str, store: TableStore | None, name: str, start: date, end: date, *,
                 dry_run: bool = False, source_updated_at: datetime | None = None,
                 tables: tuple[str, ...] = ()) -> dict[str, int]:
    """Backfill a source's tables (all that it has landed pages for, or the named ones); returns rows
    appended per table."""
    source(name)  # unknown names raise with the known list
    if name not in PLANS:
        raise KeyError(f"no backfill plan for {name!r}; available: {sorted(PLANS)}")
    stamp = source_updated_at or datetime.now(timezone.utc)
    pages = read_landed(spark, landing, name, start=start)
    written: dict[str, int] = {}
    for plan in PLANS[name]:
        if tables and plan.table not in tables:
            continue
        spec = store.spec(plan.table) if store is not None else resolve(plan.table)
        rows = plan.build(pages, stamp)
        if len(PLANS[name]) > 1 and not tables and rows.isEmpty():
            continue            # nothing of this kind has landed
        lo, hi = (_bound(day, spec.schema[plan.time_col].dataType.simpleString()) for day in (start, end))
        flagged = [c for c in ("_bad",) if c in rows.columns]
        rows = window_half_open(rows.select(*spec.columns, *flagged), plan.time_col, lo, hi)
        checks = [Q.not_empty(), Q.time_in_window(plan.time_col, lo, hi), *quality_checks(spec)]
        written[plan.table] = backfill_job(store, plan.table, rows, spec.identity, checks=checks, dry_run=dry_run)
    return written


def main(argv=None) -> None:
    parser = window_parser("Backfill a source from landed pages", default_start="2017-01-01")
    parser.add_argument("--source", required=True, choices=sorted(set(SOURCES) & set(PLANS)))
    parser.add_argument("--landing", required=True)
    parser.add_argument("--warehouse", required=True)
    args = parser.parse_args(argv)
    from tidemark.session import build_session
    spark = build_session(app_name=f"tidemark-backfill-{args.source}")
    store = None if args.dry_run else TableStore(spark, args.warehouse)
    written = run_backfill(spark, args.landing, store, args.source, args.start.date(), args.end.date(), dry_run=args.dry_run)
    for table, n in written.items():
        print(f"[{table}] rows_written={n}")


if __name__ == "__main__":
    main()
