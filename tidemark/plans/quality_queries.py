"""Data-quality queries: report frames (one row per check) over the driver tables.

Oracles are built from the same check list: each check becomes one SQL row with
``SUM(CASE WHEN NOT (predicate) THEN 1 ELSE 0 END)`` (null predicate = pass) or
the duplicate-group count, unioned in check order.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import quality as Q
from tidemark.operators.conform import no_bad_rows
from tidemark.plans import landed
from tidemark.plans.payload_queries import BARS_SQL, candle_rows
from tidemark.plans.registry import finish, load, register
from tidemark.plans.relational_queries import DOMINANCE_HOURLY_SQL, dominance_hourly
from tidemark.tables import CANDLES, FUNDING_RATES, MARKET_METRICS, SENTIMENT_INDEX, candle_checks
from tidemark.tables import dominance_checks, funding_checks, sentiment_checks


def _row_sql(pos: int, subject: str, name: str, severity: str, failed: str, total: str = "count(*)",
             passed: str | None = None, src: str = "src") -> str:
    name_sql = name.replace("'", "''")
    passed = passed or "failed = 0"
    return (f"SELECT {pos} AS position, '{subject}' AS subject, '{name_sql}' AS \"check\", '{severity}' AS severity, "
            f"{passed} AS passed, failed AS failed_rows, total AS total_rows "
            f"FROM (SELECT CAST({failed} AS BIGINT) AS failed, CAST({total} AS BIGINT) AS total FROM {src})")


def report_sql(src_sql: str, subject: str, checks: Sequence[tuple]) -> str:
    """``checks``: (kind, name, severity, arg) with kind row (arg = keep predicate),
    unique (arg = key columns), not_empty, row_count (arg = (low, high))."""
    parts = []
    for pos, (kind, name, severity, arg) in enumerate(checks):
        if kind == "row":
            failed = f"coalesce(sum(CASE WHEN NOT ({arg}) THEN 1 ELSE 0 END), 0)"
            parts.append(_row_sql(pos, subject, name, severity, failed))
        elif kind == "unique":
            keys = ", ".join(arg)
            failed = (f"(SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM src GROUP BY {keys} "
                      f"HAVING count(*) > 1))")
            parts.append(_row_sql(pos, subject, name, severity, failed))
        elif kind == "not_empty":
            parts.append(_row_sql(pos, subject, name, severity, "0", passed="total > 0"))
        elif kind == "row_count":
            low, high = arg
            cond = " AND ".join([c for c in (f"total >= {low}" if low is not None else None,
                                             f"total <= {high}" if high is not None else None) if c]) or "true"
            parts.append(_row_sql(pos, subject, name, severity, "0", passed=cond).replace(
                "failed AS failed_rows", f"CASE WHEN {cond} THEN 0 ELSE total END AS failed_rows"))
    return f"WITH src AS ({src_sql})\n" + "\nUNION ALL\n".join(parts)


def _utc_ts(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, landed.utc(c))
    return df


# ---- Q11/Q12/A8: the full report -------------------------------------------------------------

LINEITEM_CHECKS = (
    ("row", "not_null(l_orderkey, l_partkey)", "error", "l_orderkey IS NOT NULL AND l_partkey IS NOT NULL"),
    ("unique", "unique(l_orderkey, l_linenumber)", "error", ("l_orderkey", "l_linenumber")),
    ("row", "in_range(l_discount)", "error", "l_discount IS NOT NULL AND l_discount >= 0 AND l_discount <= 0.08"),
    ("row", "in_range(l_tax)", "warn", "l_tax IS NOT NULL AND l_tax >= 0 AND l_tax <= 0.05"),
    ("row", "accepted_values(l_returnflag)", "error", "l_returnflag IN ('R', 'A', 'N')"),
    ("row", "matches_regex(l_linestatus)", "error", "regexp_matches(l_linestatus, '^[OF]$')"),
    ("row", "time_in_window(l_shipdate)", "error",
     "l_shipdate BETWEEN TIMESTAMP '1995-01-01 00:00:00' AND TIMESTAMP '1998-12-31 00:00:00'"),
    ("row", "price_positive", "error", "l_extendedprice > 0"),
    ("not_empty", "not_empty", "error", None),
    ("row_count", "row_count_between(1, None)", "error", (1, None)),
)


def lineitem_checks() -> list:
    return [
        Q.not_null("l_orderkey", "l_partkey"),
        Q.unique("l_orderkey", "l_linenumber"),
        Q.in_range("l_discount", 0, 0.08),
        Q.in_range("l_tax", 0, 0.05, severity=Q.Severity.WARN),
        Q.accepted_values("l_returnflag", ["R", "A", "N"]),
        Q.matches_regex("l_linestatus", "^[OF]$"),
        Q.time_in_window("l_shipdate", datetime(1995, 1, 1, tzinfo=timezone.utc),
                         datetime(1998, 12, 31, tzinfo=timezone.utc)),
        Q.expression("price_positive", F.col("l_extendedprice") > 0),
        Q.not_empty(),
        Q.row_count_between(1, None),
    ]


def lineitem_report(spark: SparkSession, sf_dir: str) -> Q.Report:
    li = _utc_ts(load(spark, sf_dir, "lineitem"), "l_shipdate")
    return Q.validate(li, lineitem_checks(), subject="raw.lineitem")


@register("qc_report", report_sql("SELECT * FROM lineitem", "raw.lineitem", LINEITEM_CHECKS))
def qc_report(spark: SparkSession, sf_dir: str):
    """Ten checks of every kind evaluated by one aggregation plan over one scan."""
    return lineitem_report(spark, sf_dir).frame


@register("qc_metrics", f"""
WITH r AS ({report_sql("SELECT * FROM lineitem", "raw.lineitem", LINEITEM_CHECKS)})
SELECT CAST(count(*) AS BIGINT) AS quality_checks_total,
       CAST(count(*) FILTER (WHERE NOT passed AND severity = 'error') AS BIGINT) AS quality_failed_errors,
       CAST(count(*) FILTER (WHERE NOT passed AND severity = 'warn') AS BIGINT) AS quality_failed_warns
FROM r
""")
def qc_metrics(spark: SparkSession, sf_dir: str):
    return lineitem_report(spark, sf_dir).metrics_frame()


# ---- single-check operators -------------------------------------------------------------------

@register("qc_unique", report_sql("SELECT * FROM lineitem", "raw.lineitem", (
    ("unique", "unique(l_orderkey, l_linenumber)", "error", ("l_orderkey", "l_linenumber")),
    ("unique", "unique(l_orderkey)", "error", ("l_orderkey",)),
    ("unique", "unique(l_suppkey, l_partkey)", "warn", ("l_suppkey", "l_partkey")))))
def qc_unique(spark: SparkSession, sf_dir: str):
    """Every row of every duplicated key group counts (nulls equal); three key sets
    share one scan through grouping sets."""
    li = load(spark, sf_dir, "lineitem")
    checks = [Q.unique("l_orderkey", "l_linenumber"), Q.unique("l_orderkey"),
              Q.unique("l_suppkey", "l_partkey", severity=Q.Severity.WARN)]
    return Q.validate(li, checks, subject="raw.lineitem").frame


@register("qc_expression", report_sql("SELECT * FROM lineitem", "raw.lineitem", (
    ("row", "price_covers_quantity", "error", "l_extendedprice >= l_quantity * 1000"),
    ("row", "tax_below_discount", "warn", "l_tax < l_discount"))))
def qc_expression(spark: SparkSession, sf_dir: str):
    li = load(spark, sf_dir, "lineitem")
    checks = [Q.expression("price_covers_quantity", F.col("l_extendedprice") >= F.col("l_quantity") * 1000,
                           columns=("l_extendedprice", "l_quantity")),
              Q.expression("tax_below_discount", F.col("l_tax") < F.col("l_discount"), severity=Q.Severity.WARN)]
    return Q.validate(li, checks, subject="raw.lineitem").frame


@register("qc_not_null", report_sql(
    "SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status_open FROM orders", "raw.orders", (
        ("row", "not_null(o_orderkey)", "error", "o_orderkey IS NOT NULL"),
        ("row", "not_null(o_orderkey, status_open)", "error", "o_orderkey IS NOT NULL AND status_open IS NOT NULL"))))
def qc_not_null(spark: SparkSession, sf_dir: str):
    o = load(spark, sf_dir, "orders").select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status_open"))
    return Q.validate(o, [Q.not_null("o_orderkey"), Q.not_null("o_orderkey", "status_open")],
                      subject="raw.orders").frame


@register("qc_in_range", report_sql("""
SELECT l_discount, nullif(l_tax, 0.0) AS tax, CAST(l_shipdate AS DATE) AS day, CAST(l_shipdate AS TIMESTAMP) AS shipped, l_returnflag AS flag,
       CASE l_linenumber WHEN 1 THEN 9223372036854775807 WHEN 2 THEN -9223372036854775808 ELSE CAST(l_orderkey AS BIGINT) END AS big,
       CASE l_linenumber WHEN 3 THEN CAST('inf' AS DOUBLE) WHEN 4 THEN CAST('-inf' AS DOUBLE) ELSE CAST(l_discount AS DOUBLE) END AS wide
FROM lineitem""", "raw.lineitem", (
        ("row", "in_range(l_discount)", "error", "l_discount IS NOT NULL AND l_discount >= 0 AND l_discount <= 0.05"),
        ("row", "in_range(l_discount)", "error", "l_discount IS NOT NULL AND l_discount > 0.02"),
        ("row", "in_range(tax)", "warn", "tax IS NULL OR (tax >= 0 AND tax <= 0.04)"),
        ("row", "in_range(tax)", "error", "tax IS NOT NULL AND tax >= 0 AND tax <= 0.04"),
        ("row", "in_range(day)", "error", "day BETWEEN DATE '1995-01-01' AND DATE '1996-12-31'"),
        ("row", "in_range(shipped)", "error", "shipped > TIMESTAMP '1995-01-01' AND shipped < TIMESTAMP '1997-06-01'"),
        ("row", "in_range(flag)", "error", "flag >= 'B' AND flag <= 'O'"),
        ("row", "in_range(big)", "error", "big >= -10"),
        ("row", "in_range(wide)", "error", "wide >= 0 AND wide <= CAST('inf' AS DOUBLE)"))))
def qc_in_range(spark: SparkSession, sf_dir: str):
    """Both bounds, exclusive bounds, null allowed / not allowed; numbers, dates, times, text, the extremes
    of long and infinities."""
    line = F.col("l_linenumber")
    ends = F.when(line == 1, F.lit((1 << 63) - 1)).when(line == 2, F.lit(-(1 << 63))).otherwise(F.col("l_orderkey").cast("long"))
    wide = F.when(line == 3, F.lit(float("inf"))).when(line == 4, F.lit(float("-inf"))).otherwise(F.col("l_discount").cast("double"))
    li = load(spark, sf_dir, "lineitem").select(
        "l_discount", F.nullif("l_tax", F.lit(0.0)).alias("tax"), F.to_date("l_shipdate").alias("day"), landed.utc("l_shipdate").alias("shipped"),
        F.col("l_returnflag").alias("flag"), ends.alias("big"), wide.alias("wide"))
    checks = [Q.in_range("l_discount", 0, 0.05), Q.in_range("l_discount", 0.02, None, inclusive=False),
              Q.in_range("tax", 0, 0.04, allow_null=True, severity=Q.Severity.WARN), Q.in_range("tax", 0, 0.04),
              Q.in_range("day", date(1995, 1, 1), date(1996, 12, 31)),
              Q.in_range("shipped", datetime(1995, 1, 1, tzinfo=timezone.utc), datetime(1997, 6, 1, tzinfo=timezone.utc), inclusive=False),
              Q.in_range("flag", "B", "O"), Q.in_range("big", -10, None), Q.in_range("wide", 0, float("inf"))]
    return Q.validate(li, checks, subject="raw.lineitem").frame


@register("qc_frame_check", """
WITH src AS (SELECT count(*) AS n, avg(l_quantity) AS mean, count(*) FILTER (l_extendedprice > 50000) AS dear,
                    sum(CASE WHEN l_discount > 0.09 THEN 1 ELSE 0 END) AS steep FROM lineitem)
SELECT 0 AS position, 'raw.lineitem' AS subject, 'mean quantity' AS "check", 'error' AS severity, mean BETWEEN 20 AND 30 AS passed,
       CAST(0 AS BIGINT) AS failed_rows, n AS total_rows FROM src
UNION ALL
SELECT 1, 'raw.lineitem', 'few dear lines', 'warn', dear * 100 <= n, dear, n FROM src
UNION ALL
SELECT 2, 'raw.lineitem', 'discount at most 0.09', 'error', steep = 0, CAST(steep AS BIGINT), n FROM src
""")
def qc_frame_check(spark: SparkSession, sf_dir: str):
    """Checks of the whole frame by aggregates, and one row check: one scan for all of them."""
    li = load(spark, sf_dir, "lineitem").select("l_quantity", "l_extendedprice", "l_discount")
    dear = F.count_if(F.col("l_extendedprice") > 50000)
    checks = [Q.aggregate_check("mean quantity", F.avg("l_quantity").between(20, 30)),
              Q.aggregate_check("few dear lines", dear * 100 <= F.count("*"), dear, severity=Q.Severity.WARN),
              Q.expression("discount at most 0.09", F.col("l_discount") <= 0.09)]
    return Q.validate(li, checks, subject="raw.lineitem").frame


@register("qc_accepted_values", report_sql("SELECT * FROM events", "raw.events", (
    ("row", "accepted_values(event_type)", "error", "event_type IN ('click', 'view', 'purchase')"),)))
def qc_accepted_values(spark: SparkSession, sf_dir: str):
    ev = load(spark, sf_dir, "events")
    return Q.validate(ev, [Q.accepted_values("event_type", ["click", "view", "purchase"])], subject="raw.events").frame


URL_PATTERN = r"^https://[a-z.]+\.example\.(com|net)/"


@register("qc_matches_regex", report_sql("SELECT * FROM pages", "raw.pages", (
    ("row", "matches_regex(url)", "error", f"regexp_matches(url, '{URL_PATTERN}')"),)))
def qc_matches_regex(spark: SparkSession, sf_dir: str):
    return Q.validate(load(spark, sf_dir, "pages"), [Q.matches_regex("url", URL_PATTERN)], subject="raw.pages").frame


@register("qc_time_in_window", report_sql("SELECT * FROM events", "raw.events", (
    ("row", "time_in_window(ts)", "error",
     "ts BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-20 00:00:00'"),)))
def qc_time_in_window(spark: SparkSession, sf_dir: str):
    ev = _utc_ts(load(spark, sf_dir, "events"), "ts")
    check = Q.time_in_window("ts", datetime(2024, 1, 5, tzinfo=timezone.utc), datetime(2024, 1, 20, tzinfo=timezone.utc))
    return Q.validate(ev, [check], subject="raw.events").frame


_NOT_EMPTY_CHECKS = (("not_empty", "not_empty", "error", None), ("row", "positive_value", "error", "value > 0"))


@register("qc_not_empty", "SELECT * FROM (" + report_sql("SELECT * FROM events", "raw.events", _NOT_EMPTY_CHECKS)
          + ") UNION ALL SELECT * FROM (" + report_sql("SELECT * FROM events WHERE event_type = 'none'",
                                                        "raw.events_none", _NOT_EMPTY_CHECKS) + ")")
def qc_not_empty(spark: SparkSession, sf_dir: str):
    """On an empty frame row checks pass and ``not_empty`` fails."""
    ev = load(spark, sf_dir, "events")
    checks = [Q.not_empty(), Q.expression("positive_value", F.col("value") > 0)]
    full = Q.validate(ev, checks, subject="raw.events").frame
    empty = Q.validate(ev.filter(F.col("event_type") == "none"), checks, subject="raw.events_none").frame
    return full.unionByName(empty)


@register("qc_row_count", report_sql("SELECT * FROM orders", "raw.orders", (
    ("row_count", "row_count_between(3, None)", "error", (3, None)),
    ("row_count", "row_count_between(None, 10)", "error", (None, 10)),
    ("row_count", "row_count_between(1, 1000000000000)", "warn", (1, 1000000000000)))))
def qc_row_count(spark: SparkSession, sf_dir: str):
    """Row-count bounds over the whole orders table: a lower bound that holds, an upper
    bound that fails (failed_rows = all rows) and a range that holds."""
    checks = [Q.row_count_between(3, None), Q.row_count_between(None, 10),
              Q.row_count_between(1, 1_000_000_000_000, severity=Q.Severity.WARN)]
    return Q.validate(load(spark, sf_dir, "orders"), checks, subject="raw.orders").frame


# ---- Q10/Q17-Q20: spec baselines and per-table rules ----------------------------------------------

CANDLE_IDS = ("instrument", "counterpart", "interval", "open_time")
CANDLE_RULES = (
    ("row", "not_null(instrument, counterpart, interval, open_time)", "error",
     " AND ".join(f"{c} IS NOT NULL" for c in CANDLE_IDS)),
    ("unique", "unique(instrument, counterpart, interval, open_time)", "error", CANDLE_IDS),
)


def _candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return no_bad_rows(candle_rows(spark, sf_dir)).select(*CANDLES.columns)


@register("qc_from_spec", report_sql(BARS_SQL, "raw.candles", CANDLE_RULES))
def qc_from_spec(spark: SparkSession, sf_dir: str):
    return Q.validate(_candles(spark, sf_dir), Q.from_spec(CANDLES), subject="raw.candles").frame


@register("qc_rules_candles", report_sql(BARS_SQL, "raw.candles", CANDLE_RULES + (
    ("row", "high>=low", "error", "high >= low"),
    ("row", "high_bounds_oc", "error", "high >= open AND high >= close"),
    ("row", "low_bounds_oc", "error", "low <= open AND low <= close"),
    ("row", "positive_prices", "error", "open > 0 AND close > 0"),
    ("row", "in_range(volume)", "error", "volume IS NOT NULL AND volume >= 0"))))
def qc_rules_candles(spark: SparkSession, sf_dir: str):
    return Q.validate(_candles(spark, sf_dir), candle_checks(), subject="raw.candles").frame


FUNDING_SQL = """
SELECT event_type AS instrument, 'USDT' AS counterpart, date_trunc('millisecond', ts) AS funding_time,
       (value - 100) / 100 AS funding_rate, value AS mark_price FROM events
"""


@register("qc_rules_funding", report_sql(FUNDING_SQL, "raw.funding_rates", (
    ("row", "not_null(instrument, counterpart, funding_time)", "error",
     "instrument IS NOT NULL AND counterpart IS NOT NULL AND funding_time IS NOT NULL"),
    ("unique", "unique(instrument, counterpart, funding_time)", "error", ("instrument", "counterpart", "funding_time")),
    ("row", "funding_rate_sane", "error", "abs(funding_rate) <= 1.0"))))
def qc_rules_funding(spark: SparkSession, sf_dir: str):
    ev = load(spark, sf_dir, "events")
    rows = ev.select(F.col("event_type").alias("instrument"), F.lit("USDT").alias("counterpart"),
                     F.timestamp_millis(F.unix_millis(landed.utc("ts"))).alias("funding_time"),
                     ((F.col("value") - 100) / 100).alias("funding_rate"), F.col("value").alias("mark_price"))
    return Q.validate(rows, funding_checks(), subject=FUNDING_RATES.identifier).frame


@register("qc_rules_dominance", report_sql(
    "SELECT CAST(ts AS DATE) AS date, btc_dominance_pct FROM (" + DOMINANCE_HOURLY_SQL + ")",
    "raw.market_metrics", (
        ("row", "not_null(date)", "error", "date IS NOT NULL"),
        ("unique", "unique(date)", "error", ("date",)),
        ("row", "dominance_in_(0,100]", "error", "btc_dominance_pct > 0 AND btc_dominance_pct <= 100"))))
def qc_rules_dominance(spark: SparkSession, sf_dir: str):
    """Hourly ratios checked against the daily table's rules (several per date fail ``unique``)."""
    rows = dominance_hourly(spark, sf_dir).select(F.to_date("ts").alias("date"), "btc_dominance_pct")
    return Q.validate(rows, dominance_checks(), subject=MARKET_METRICS.identifier).frame


@register("qc_rules_sentiment", report_sql(
    "SELECT CAST(ts AS DATE) AS date, CAST(floor(value / 4) AS BIGINT) AS fear_greed_value FROM events",
    "raw.sentiment_index", (
        ("row", "not_null(date)", "error", "date IS NOT NULL"),
        ("unique", "unique(date)", "error", ("date",)),
        ("row", "in_range(fear_greed_value)", "error",
         "fear_greed_value IS NULL OR (fear_greed_value >= 0 AND fear_greed_value <= 100)"))))
def qc_rules_sentiment(spark: SparkSession, sf_dir: str):
    ev = load(spark, sf_dir, "events")
    rows = ev.select(F.to_date("ts").alias("date"), F.floor(F.col("value") / 4).cast("long").alias("fear_greed_value"))
    return Q.validate(rows, sentiment_checks(), subject=SENTIMENT_INDEX.identifier).frame


# ---- Q14/Q21 check ids, Q15/Q16 gates ---------------------------------------------------------------

@register("qc_check_ids", r"""
WITH c AS (
  SELECT c_custkey,
         regexp_replace(regexp_replace('raw.' || lower(c_mktsegment), '[^A-Za-z0-9_]+', '_', 'g'), '^_+|_+$', '', 'g')
         || '__' ||
         regexp_replace(regexp_replace('in_range(acct_' || CAST(CAST(floor(c_acctbal / 1000) AS BIGINT) AS VARCHAR) || ')',
                        '[^A-Za-z0-9_]+', '_', 'g'), '^_+|_+$', '', 'g') AS base
  FROM customer)
SELECT c_custkey,
       CASE WHEN row_number() OVER (PARTITION BY base ORDER BY c_custkey) = 1 THEN base
            ELSE base || '_' || CAST(row_number() OVER (PARTITION BY base ORDER BY c_custkey) AS VARCHAR) END AS check_id
FROM c
""")
def qc_check_ids(spark: SparkSession, sf_dir: str):
    """Stable unique ids ``<subject>__<check>`` with ``_2``, ``_3`` suffixes in
    declaration order, over a catalogue of one check per customer (skew-safe
    ordinal instead of a window over a possibly hot id)."""
    cust = load(spark, sf_dir, "customer")
    check = F.concat(F.lit("in_range(acct_"), F.floor(F.col("c_acctbal") / 1000).cast("long").cast("string"), F.lit(")"))
    named = cust.select("c_custkey", F.concat(F.lit("raw."), F.lower("c_mktsegment")).alias("subject"), check.alias("check"))
    return Q.with_check_ids(named, position="c_custkey").select("c_custkey", "check_id")


@register("qc_gate_rows", BARS_SQL)
def qc_gate_rows(spark: SparkSession, sf_dir: str):
    """Write gate: rows pass on when the report has no ERROR failure (WARN never
    blocks); a failing gate yields no rows, and the hard gate raises."""
    rows = _candles(spark, sf_dir).persist()    # validated twice, then passed on
    report = Q.check_frame(rows, candle_checks() + [Q.row_count_between(None, 10, severity=Q.Severity.WARN)],
                           table=CANDLES.identifier)
    blocked = Q.check_frame(rows, [Q.row_count_between(None, 10)], table=CANDLES.identifier)
    try:
        blocked.require_ok()
        raise AssertionError("hard gate did not raise")
    except Q.QualityError:
        pass
    passed = rows.filter(F.lit(report.ok))
    stopped = rows.filter(F.lit(blocked.ok))
    return finish(passed.unionByName(stopped))
