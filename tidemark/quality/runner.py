"""One-pass validation.

All row checks, the row total and every uniqueness check are computed by one
aggregation plan over one scan of the frame:

* no uniqueness check   -> one global aggregate (map-side partials, no shuffle
  of rows, one row per task to the final merge);
* one key set           -> ``groupBy(key)`` carrying the per-row failure counts
  as partial sums, then a global aggregate over the groups;
* several key sets      -> ``GROUPING SETS`` over the key sets (one scan, one
  shuffle) and conditional sums per grouping id.

Hot keys are harmless: the first level is a hash aggregate with map-side
combine, so a key holding a third of all rows still leaves each task with one
partial row for it.  Empty frames give zero counts (``coalesce`` guards the
null sums of an empty aggregate).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.quality.checks import Check
from tidemark.quality.report import Report


def _fail_sum(rule: Column) -> Column:
    # Null predicate = pass: ``when`` with a null condition takes ``otherwise``.
    return F.sum(F.when(~rule, F.lit(1)).otherwise(F.lit(0))).cast("long")


def _key_sets(checks: Sequence[Check]) -> list[tuple[str, ...]]:
    seen: list[tuple[str, ...]] = []
    for c in checks:
        if c.kind == "unique" and tuple(c.columns) not in seen:
            seen.append(tuple(c.columns))
    return seen


def stats_frame(frame: DataFrame, checks: Sequence[Check], maxima: Sequence[str] = ()) -> DataFrame:
    """One-row DataFrame: ``_total``, ``_f<i>`` per row check, ``_d<j>`` per key set, ``_max_<column>`` per
    column of ``maxima``; without key sets also ``_p<i>`` and ``_f<i>`` per aggregate check."""
    highest = [F.max(c).alias(f"_max_{c}") for c in maxima]
    merged = [F.max(f"_max_{c}").alias(f"_max_{c}") for c in maxima]
    by_aggregate: list[int] = []
    row_idx = [i for i, c in enumerate(checks) if c.rule is not None]
    key_sets = _key_sets(checks)

    if not key_sets:
        aggs = [F.count(F.lit(1)).cast("long").alias("_total")]
        aggs += [_fail_sum(checks[i].rule).alias(f"_f{i}") for i in row_idx]
        by_aggregate = [i for i, c in enumerate(checks) if c.kind == "aggregate"]
        stats = frame.agg(*aggs, *highest, *_verdicts(checks))
    elif len(key_sets) == 1:
        key = list(key_sets[0])
        level1 = frame.groupBy(*key).agg(
            F.count(F.lit(1)).alias("_n"),
            *[_fail_sum(checks[i].rule).alias(f"_f{i}") for i in row_idx], *highest,
        )
        stats = level1.agg(
            *merged,
            F.sum("_n").cast("long").alias("_total"),
            *[F.sum(f"_f{i}").cast("long").alias(f"_f{i}") for i in row_idx],
            F.sum(F.when(F.col("_n") > 1, F.col("_n")).otherwise(0)).cast("long").alias("_d0"),
        )
    else:
        all_cols: list[str] = []
        for ks in key_sets:
            for c in ks:
                if c not in all_cols:
                    all_cols.append(c)
        level1 = frame.groupingSets([list(ks) for ks in key_sets], *all_cols).agg(
            F.count(F.lit(1)).alias("_n"),
            *[_fail_sum(checks[i].rule).alias(f"_f{i}") for i in row_idx],
            F.grouping_id().alias("_gid"), *highest,
        )
        gids = []
        width = len(all_cols)
        for ks in key_sets:
            # grouping_id bit is 1 for a column NOT in the set; first column = most significant bit
            gid = sum(1 << (width - 1 - k) for k, c in enumerate(all_cols) if c not in ks)
            gids.append(gid)
        first = F.col("_gid") == F.lit(gids[0])
        stats = level1.agg(
            *merged,
            F.sum(F.when(first, F.col("_n")).otherwise(0)).cast("long").alias("_total"),
            *[F.sum(F.when(first, F.col(f"_f{i}")).otherwise(0)).cast("long").alias(f"_f{i}") for i in row_idx],
            *[F.sum(F.when((F.col("_gid") == F.lit(g)) & (F.col("_n") > 1), F.col("_n")).otherwise(0))
              .cast("long").alias(f"_d{j}") for j, g in enumerate(gids)],
        )
    cols = ["_total"] + [f"_f{i}" for i in row_idx] + [f"_d{j}" for j in range(len(key_sets))]
    return stats.select(*[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in cols],
                        *[f"_{kind}{i}" for i in by_aggregate for kind in "pf"], *[f"_max_{c}" for c in maxima])


def _verdicts(checks: Sequence[Check]) -> list[Column]:
    """``_p<i>`` and ``_f<i>`` of the aggregate checks."""
    return [column for i, c in enumerate(checks) if c.kind == "aggregate" for column in (
        F.coalesce(c.parameters["passed"], F.lit(True)).alias(f"_p{i}"), F.coalesce(c.parameters["failed_rows"], F.lit(0)).cast("long").alias(f"_f{i}"))]


def _report_struct(pos: int, check: Check, passed: Column, failed: Column, total: Column) -> Column:
    return F.struct(
        F.lit(pos).alias("position"),
        F.lit(check.name).alias("check"),
        F.lit(check.severity.value).alias("severity"),
        passed.alias("passed"),
        failed.cast("long").alias("failed_rows"),
        total.cast("long").alias("total_rows"),
    )


def report_frame(frame: DataFrame, checks: Sequence[Check], subject: str = "", maxima: Sequence[str] = ()) -> DataFrame:
    """Report DataFrame (``position, subject, check, severity, passed, failed_rows, total_rows``), with a
    column ``max_<column>`` for each of ``maxima``, the same in all rows.

    Lazy: nothing runs until the report is read.
    """
    checks = list(checks)
    key_sets = _key_sets(checks)
    stats = stats_frame(frame, checks, maxima)
    if key_sets and (verdicts := _verdicts(checks)):
        stats = stats.crossJoin(frame.agg(*verdicts))       # one row each: all aggregate checks by one more scan
    total = F.col("_total")
    structs = []
    for pos, c in enumerate(checks):
        if c.rule is not None:
            failed = F.col(f"_f{pos}")
            structs.append(_report_struct(pos, c, failed == 0, failed, total))
        elif c.kind == "unique":
            failed = F.col(f"_d{key_sets.index(tuple(c.columns))}")
            structs.append(_report_struct(pos, c, failed == 0, failed, total))
        elif c.kind == "aggregate":
            structs.append(_report_struct(pos, c, F.col(f"_p{pos}"), F.col(f"_f{pos}"), total))
        elif c.kind == "not_empty":
            structs.append(_report_struct(pos, c, total > 0, F.lit(0), total))
        elif c.kind == "row_count":
            low, high = c.parameters["low"], c.parameters["high"]
            ok = total.between(F.lit(0 if low is None else low), F.lit((1 << 63) - 1 if high is None else high))
            structs.append(_report_struct(pos, c, ok, F.when(ok, F.lit(0)).otherwise(total), total))
    if structs:
        report = stats.select(*[F.col(f"_max_{c}").alias(f"max_{c}") for c in maxima], F.inline(F.array(*structs)))
    else:
        report = stats.select(
            F.lit(0).alias("position"), F.lit("").alias("check"), F.lit("").alias("severity"),
            F.lit(True).alias("passed"), F.lit(0).cast("long").alias("failed_rows"),
            total.alias("total_rows"), *[F.col(f"_max_{c}").alias(f"max_{c}") for c in maxima]).filter(F.lit(False))
    custom = [(pos, c) for pos, c in enumerate(checks) if c.kind == "frame"]
    if custom:
        parts = [report]
        for pos, c in custom:
            res = c.parameters["evaluate"](frame)
            parts.append(res.select(
                F.lit(pos).alias("position"), F.lit(c.name).alias("check"), F.lit(c.severity.value).alias("severity"),
                F.col("passed").cast("boolean").alias("passed"), F.col("failed_rows").cast("long").alias("failed_rows"),
                F.lit(None).cast("long").alias("total_rows")))
        merged = parts[0]
        for p in parts[1:]:
            merged = merged.unionByName(p, allowMissingColumns=True)
        # the report holds one row per check: a global window over it is a handful of rows
        report = merged.withColumn("total_rows", F.max("total_rows").over(Window.partitionBy()))
    return report.select("position", F.lit(subject).alias("subject"), "check", "severity",
                         "passed", "failed_rows", "total_rows", *[f"max_{c}" for c in maxima])


def validate(frame: DataFrame, checks: Sequence[Check], *, subject: str = "") -> Report:
    """Evaluate every check in declaration order; results are positional, so two
    checks with the same name stay distinct, and a failure never stops the others."""
    return Report(report_frame(frame, checks, subject), checks, subject, source=frame)


def log_failures(report: Report, logger=None) -> None:
    """A warning for every failed check."""
    for r in report.failed() if logger is not None else ():
        logger.warning("quality_check_failed table=%s check=%s severity=%s failed_rows=%s total_rows=%s sample=%s",
                       report.subject, r.name, r.check.severity.value, r.failed_rows, r.total_rows, r.sample)


def check_frame(frame: DataFrame, checks: Sequence[Check], *, table: str, logger=None) -> Report:
    """Validation before a write of ``table``: nothing is raised, failures are logged, and the caller
    writes only if the report is ``ok``."""
    report = validate(frame, checks, subject=table)
    log_failures(report, logger)
    return report
