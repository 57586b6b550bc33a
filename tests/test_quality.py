"""Check operators, one-pass batching, report and check ids."""

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark import quality as Q
from tidemark.quality.report import failing_rows, told


def _one(spark, rows, schema, check):
    return Q.validate(spark.createDataFrame(rows, schema), [check]).results[0]


def test_not_null_single_and_multi(spark):
    assert _one(spark, [(1,), (None,), (3,)], "a long", Q.not_null("a")).failed_rows == 1
    r = _one(spark, [(1, None), (None, 2)], "a long, b long", Q.not_null("a", "b"))
    assert r.failed_rows == 2 and r.name == "not_null(a, b)"


def test_not_null_needs_columns():
    with pytest.raises(ValueError):
        Q.not_null()
    with pytest.raises(ValueError):
        Q.unique()


def test_in_range_variants(spark):
    r = _one(spark, [(0.0,), (50.0,), (100.0,), (101.0,)], "v double", Q.in_range("v", 0, 100))
    assert (r.failed_rows, r.sample) == (1, [{"v": 101.0}])
    assert _one(spark, [(-1.0,), (0.0,), (5.0,)], "v double", Q.in_range("v", 0, None)).failed_rows == 1
    assert _one(spark, [(None,), (5.0,)], "v double", Q.in_range("v", 0, 10)).failed_rows == 1
    assert _one(spark, [(None,), (5.0,)], "v double", Q.in_range("v", 0, 10, allow_null=True)).failed_rows == 0
    assert _one(spark, [(0.0,), (5.0,)], "v double", Q.in_range("v", 0, 10, inclusive=False)).failed_rows == 1


def test_in_range_of_every_ordered_type(spark):
    day, first = date(2024, 3, 1), datetime(2024, 3, 1, 12)
    top = (1 << 63) - 1
    cases = [
        ("v date", [date(2024, 2, 29), day, date(2024, 3, 5), date(2024, 3, 6)], (day, date(2024, 3, 5)), 2, 4),
        ("v timestamp", [first, first + timedelta(hours=1), first - timedelta(seconds=1)], (first, first + timedelta(hours=1)), 1, 3),
        ("v string", ["a", "b", "bz", "c", "d"], ("b", "c"), 2, 4),
        ("v long", [top, -top - 1, 0], (-10, None), 1, 1),
        ("v long", [top, -top - 1, 0], (-top - 1, top), 0, 2),
        ("v double", [float("inf"), float("-inf"), 1.0], (float("-inf"), float("inf")), 0, 2),
        ("v double", [float("inf"), 2.0], (0, 10), 1, 1),
        ("v decimal(20,2)", [Decimal("1.00"), Decimal("1.01")], (None, Decimal("1.00")), 1, 2),
    ]
    for schema, values, (low, high), closed, opened in cases:
        rows = [(v,) for v in values]
        assert _one(spark, rows, schema, Q.in_range("v", low, high)).failed_rows == closed, schema
        assert _one(spark, rows, schema, Q.in_range("v", low, high, inclusive=False)).failed_rows == opened, schema
    assert _one(spark, [(1.0,)], "v double", Q.in_range("v", None, None)).passed


def test_samples_of_all_failed_row_checks_come_from_one_scan(spark):
    df = spark.range(0, 20000, numPartitions=6).select(F.col("id").alias("a"), (F.col("id") % 100).alias("b"))
    checks = {0: Q.in_range("a", 0, 9), 1: Q.accepted_values("b", [1, 2]), 2: Q.in_range("a", 0, 19990)}
    shown = Q.validate(df, list(checks.values())).results
    assert [r.sample for r in shown] == [[{"a": 10}, {"a": 11}, {"a": 12}], [{"b": 0}, {"b": 3}, {"b": 4}], [{"a": 19991}, {"a": 19992}, {"a": 19993}]]
    plan = failing_rows(df, checks)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1 and "WindowGroupLimit" in plan


def test_aggregate_checks_share_a_scan(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (9, "b")], "n long, k string")
    checks = [Q.aggregate_check("mean below 5", F.avg("n") < 5), Q.aggregate_check("few big", F.count_if(F.col("n") > 8) == 0, F.count_if(F.col("n") > 8)), Q.not_null("n")]
    got = [(r.name, r.passed, r.failed_rows, r.total_rows) for r in Q.validate(df, checks).results]
    assert got == [("mean below 5", True, 0, 3), ("few big", False, 1, 3), ("not_null(n)", True, 0, 3)]
    keyed = [(r.passed, r.failed_rows) for r in Q.validate(df, [*checks, Q.unique("k")]).results]
    assert keyed == [(True, 0), (False, 1), (True, 0), (False, 2)]
    empty = Q.validate(df.limit(0), checks).results
    assert [r.passed for r in empty] == [True, True, True]
    plan = Q.report_frame(df, checks)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1


def test_accepted_values_regex_and_nulls_pass(spark):
    assert _one(spark, [("a",), ("b",), ("z",), (None,)], "a string",
                Q.accepted_values("a", ["a", "b"])).failed_rows == 1
    assert _one(spark, [("btc-usd",), ("bad",), (None,)], "a string",
                Q.matches_regex("a", "^[a-z]+-[a-z]+$")).failed_rows == 1


def test_time_in_window_inclusive(spark):
    rows = [(datetime(2024, 1, 1),), (datetime(2024, 6, 1),), (datetime(2025, 1, 1),)]
    r = _one(spark, rows, "t timestamp", Q.time_in_window("t", datetime(2024, 1, 1), datetime(2024, 12, 31)))
    assert r.failed_rows == 1


def test_expression_and_unique(spark):
    r = _one(spark, [(10, 1), (5, 9)], "h long, l long", Q.expression("h>=l", F.col("h") >= F.col("l")))
    assert r.failed_rows == 1 and r.sample == []
    assert _one(spark, [(1,), (1,), (2,)], "k long", Q.unique("k")).failed_rows == 2
    r = _one(spark, [(1, "x"), (1, "x"), (1, "y")], "a long, b string", Q.unique("a", "b"))
    assert r.failed_rows == 2 and r.sample == [{"a": 1, "b": "x"}, {"a": 1, "b": "x"}]
    assert _one(spark, [(None,), (None,), (2,)], "k long", Q.unique("k")).failed_rows == 2


def test_row_count_and_not_empty(spark):
    r = _one(spark, [(1,), (2,)], "a long", Q.row_count_between(3, None))
    assert (r.passed, r.failed_rows) == (False, 2)
    assert _one(spark, [(1,)], "a long", Q.not_empty()).passed


def test_empty_frame_row_checks_pass(spark):
    df = spark.createDataFrame([], "a long")
    res = Q.validate(df, [Q.not_null("a"), Q.unique("a"), Q.not_empty(), Q.in_range("a", 0, 1)]).results
    assert [r.passed for r in res] == [True, True, False, True]
    assert all(r.total_rows == 0 for r in res)


def test_batch_equals_one_by_one_and_same_name(spark):
    df = spark.createDataFrame([(5.0, 1), (50.0, 1), (150.0, 2)], "v double, k long")
    checks = [Q.in_range("v", 0, 100), Q.in_range("v", 0, 10), Q.unique("k"), Q.not_null("v"),
              Q.unique("k", "v"), Q.row_count_between(None, 2)]
    batched = [(r.name, r.failed_rows, r.passed) for r in Q.validate(df, checks).results]
    single = [(r.name, r.failed_rows, r.passed) for c in checks for r in Q.validate(df, [c]).results]
    assert batched == single
    assert batched[0][1] == 1 and batched[1][1] == 2


def test_report_metrics_ok_and_raise(spark):
    df = spark.createDataFrame([(1, 10.0), (1, 999.0)], "id long, v double")
    report = Q.validate(df, [Q.unique("id"), Q.in_range("v", 0, 100, severity=Q.Severity.WARN),
                             Q.not_null("id")], subject="raw.t")
    assert report.metrics() == {"quality_checks_total": 3, "quality_failed_errors": 1, "quality_failed_warns": 1}
    assert report.metrics(prefix="quality_dvol")["quality_dvol_checks_total"] == 3
    assert not report.ok
    with pytest.raises(Q.QualityError, match=r"unique\(id\) \[error\]: 2/2 rows"):
        report.require_ok()
    m = report.metrics_frame().collect()[0]
    assert (m.quality_checks_total, m.quality_failed_errors, m.quality_failed_warns) == (3, 1, 1)
    assert told(report.results[2]) == "not_null(id): ok (2 rows)"


def test_warn_never_blocks(spark):
    df = spark.createDataFrame([(1, 999.0)], "id long, v double")
    assert Q.check_frame(df, [Q.in_range("v", 0, 1, severity=Q.Severity.WARN)], table="raw.t").ok


def test_custom_frame_check(spark):
    df = spark.createDataFrame([(1,), (2,)], "a long")
    chk = Q.frame_check("max_below_2", lambda f: f.agg((F.max("a") < 2).alias("passed"),
                                                       F.count_if(F.col("a") >= 2).alias("failed_rows")))
    r = Q.validate(df, [Q.not_null("a"), chk]).results
    assert (r[1].passed, r[1].failed_rows, r[1].total_rows) == (False, 1, 2)


def test_from_spec_and_check_ids(spark):
    from tidemark.tables import CANDLES
    names = [c.name for c in Q.from_spec(CANDLES)]
    assert names == ["not_null(instrument, counterpart, interval, open_time)",
                     "unique(instrument, counterpart, interval, open_time)"]
    ids = ["raw_candles__in_range_v", "raw_candles__in_range_v_2", "raw_candles__high_low",
                   "raw_candles__in_range_v_3"]
    frame = spark.createDataFrame([(i, "raw.candles", n) for i, n in enumerate(
        ["in_range(v)", "in_range(v)", "high>=low", "in_range(v)"])], "position long, subject string, check string")
    got = [r.check_id for r in Q.with_check_ids(frame).orderBy("position").collect()]
    assert got == ids


def test_skew_safe_ordinal_matches_window(spark):
    from pyspark.sql import Window

    from tidemark.operators.ranking import ordinal_within
    rows = [(("hot" if i % 3 else f"k{i % 7}"), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, o long").repartition(8)
    got = {(r.k, r.o): r.n for r in ordinal_within(df, "k", ["o"], out="n").collect()}
    want = {(r.k, r.o): r.n for r in df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("o"))).collect()}
    assert got == want


def test_subjects_catalog_matches_report_ids(spark):
    from tidemark.tables import CANDLES, candle_checks
    cat = Q.subjects_catalog(spark, [(CANDLES.identifier, candle_checks())]).orderBy("position").collect()
    assert [r.check_id for r in cat][:3] == ["raw_candles__not_null_instrument_counterpart_interval_open_time",
                                             "raw_candles__unique_instrument_counterpart_interval_open_time",
                                             "raw_candles__high_low"]
    assert [r.blocking for r in cat] == [True] * 7
    df = spark.createDataFrame([("BTC", "USDT", "1h", None, None, 2.0, 3.0, 1.0, 2.0, 1.0, 1.0, 1, 1.0, 1.0)],
                               CANDLES.schema.simpleString().replace("timestamp", "timestamp"))
    rep = Q.validate(df, candle_checks(), subject=CANDLES.identifier)
    ids = [r.check_id for r in Q.report_ids(rep).orderBy("position").collect()]
    assert ids == [r.check_id for r in cat]
