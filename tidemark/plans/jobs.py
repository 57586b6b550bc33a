"""Incremental run and backfill jobs.

``run_job``: normalised rows -> strict abort on bad rows -> validate (one pass) -> gate -> upsert ->
metrics.  ``backfill_job``: strict abort and validation -> hard gate -> dry-run stop -> anti-join
against stored identities -> append.

The batch is persisted once (``MEMORY_AND_DISK``) because it feeds the validation aggregate and the
write; a lost executor recomputes its blocks from lineage.  Row count, bad-row test and validation
share one aggregate job.
"""

from __future__ import annotations

import argparse
import logging
import time
from collections.abc import Sequence
from contextlib import contextmanager
from datetime import date, datetime, timedelta, timezone
from typing import NamedTuple

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import select_new
from tidemark.quality import Check, Report, expression, log_failures, report_frame, row_count_between
from tidemark.store import TableStore

BAD_ROWS, ALL_ROWS = "payload_valid", "rows"


class JobRun(NamedTuple):
    """What a run did: its metrics by name, and the quality report of each table it looked at."""

    metrics: dict[str, str | int | float | None]
    reports: tuple[Report, ...] = ()


@contextmanager
def _persisted(rows: DataFrame):
    batch = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield batch
    finally:
        batch.unpersist()


def validated(batch: DataFrame, columns: Sequence[str], checks: Sequence[Check], table: str, *,
              strict_flag: str | None = None, logger: logging.Logger | None = None,
              maxima: Sequence[str] = ()) -> tuple[int, Report, dict]:
    """``(rows, report, largest values)`` of a batch by one aggregate; raises if a row carries the strict flag.

    The strict test, the row count and the largest values of ``maxima`` ride along with the table's own checks.
    """
    strict = strict_flag if strict_flag in batch.columns else None
    own = [row_count_between(None, None), *([expression(BAD_ROWS, ~F.col(strict))] if strict else [])]
    frame = report_frame(batch, [*own, *checks], table, maxima)
    held = frame.collect()       # a row for each check
    combined = Report(batch.sparkSession.createDataFrame(held, frame.schema), [*own, *checks], table, batch.select(*columns))
    if strict and (bad := combined.results[1].failed_rows):
        raise ValueError(f"Invalid payload in {table}: {bad} bad rows, e.g. {batch.filter(F.col(strict)).first().asDict()!r}")
    report = combined.behind(len(own))
    log_failures(report, logger)
    return held[0]["total_rows"], report, {c: held[0][f"max_{c}"] for c in maxima}


def _identity_proven(report: Report, identity: Sequence[str]) -> bool:
    """Whether passed ERROR checks in the report show the identity to be complete and unique."""
    shown = {r.check.kind if r.check.kind == "unique" else r.check.name.split("(")[0] for r in report.results
             if r.passed and r.check.blocking and r.check.columns == tuple(identity)}
    return {"unique", "not_null"} <= shown


def _latest(values: dict) -> dict[str, str | None]:
    """The largest values of columns as text (timestamps in ISO form)."""
    said = {c: v.astimezone(timezone.utc) if isinstance(v, datetime) else v for c, v in values.items()}
    return {f"latest_{c}": None if v is None else v.isoformat() if isinstance(v, (date, datetime)) else str(v) for c, v in said.items()}


def run_job(store: TableStore, table: str, rows: DataFrame, checks: Sequence[Check], *,
            metrics_prefix: str = "quality", strict_flag: str | None = "_bad",
            logger: logging.Logger | None = None, extra_metrics: dict | None = None,
            max_columns: Sequence[str] = ()) -> JobRun:
    """Generic incremental run: an empty batch writes nothing; ERROR checks gate the upsert (a batch
    without checks is written); a flagged row aborts."""
    started = time.perf_counter()
    spec = store.spec(table)
    with _persisted(rows) as batch:
        n, report, largest = validated(batch, spec.columns, checks, table, strict_flag=strict_flag, logger=logger, maxima=max_columns)
        metrics, affected = {"rows": n}, 0
        if n:
            metrics |= report.metrics(prefix=metrics_prefix)
            if report.ok:
                data = batch.select(*spec.columns)
                affected = store.upsert(table, data, identity_proven=_identity_proven(report, spec.identity)).rows_affected
                metrics |= _latest(largest)
        metrics |= {"rows_affected": affected, "duration_seconds": round(time.perf_counter() - started, 3), **(extra_metrics or {})}
        return JobRun(metrics, (report,) if n else ())


def backfill_job(store: TableStore | None, table: str, rows: DataFrame, identity: Sequence[str], *,
                 checks: Sequence[Check], dry_run: bool = False, strict_flag: str | None = "_bad",
                 logger: logging.Logger | None = None) -> int:
    """Validate, raise on flagged rows and ERROR failures before any write, then append only the rows
    whose identity is not stored yet.  Returns the number of rows appended."""
    columns = [c for c in rows.columns if c != strict_flag]
    with _persisted(rows) as batch:
        _, report, _ = validated(batch, columns, checks, table, strict_flag=strict_flag, logger=logger)
        report.require_ok()
        if dry_run or store is None:
            return 0
        data = batch.select(*columns)
        stored = (store.read_keys(table, data) if tuple(identity) == tuple(store.spec(table).identity)
                  else store.read(table, columns=list(identity)))
        return store.append(table, select_new(data, stored, identity)).rows_inserted


def run_tables(store: TableStore, parts: Sequence[tuple[str, DataFrame, Sequence[Check], str]], *,
               logger: logging.Logger | None = None) -> JobRun:
    """Multi-table run: each (table, rows, checks, metrics prefix) is tested for flagged rows, gated and
    written on its own; metrics are merged, reports kept in order."""
    runs = [(table, prefix, run_job(store, table, rows, checks, metrics_prefix=prefix, logger=logger))
            for table, rows, checks, prefix in parts]
    metrics: dict = {}
    for table, prefix, run in runs:
        metrics |= {k: v for k, v in run.metrics.items() if k.startswith(prefix)}
        metrics[f"{table.partition('.')[2]}_rows_affected"] = run.metrics["rows_affected"]
    metrics["rows_affected"] = sum(run.metrics["rows_affected"] for *_, run in runs)
    return JobRun(metrics, tuple(report for *_, run in runs for report in run.reports))


def utc_midnight(day: str) -> datetime:
    """The first instant of an ISO day in UTC."""
    return datetime.fromisoformat(f"{day}T00:00:00+00:00")


def window_parser(description: str, *, default_start: str) -> argparse.ArgumentParser:
    """A command line with the backfill's window, ``[--start, --end)`` by days, and ``--dry-run``; the
    window comes out as UTC instants, up to the beginning of today by default."""
    today = datetime.now(timezone.utc).replace(hour=0, minute=0, second=0, microsecond=0)
    parser = argparse.ArgumentParser(description=description)
    for flag, default, said in (("--start", utc_midnight(default_start), "first day"), ("--end", today, "day after the last one")):
        parser.add_argument(flag, type=utc_midnight, default=default, metavar="YYYY-MM-DD", help=said)
    parser.add_argument("--dry-run", action="store_true", help="validate only")
    return parser


def days_of(start: datetime, end: datetime) -> list[datetime]:
    """The days of a window, ``end`` exclusive."""
    return [start + timedelta(days=k) for k in range(max(0, (end - start).days))]
