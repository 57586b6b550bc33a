"""Physical-plan properties the design relies on (checked with the formatted explain)."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def plan(spark, df) -> str:
    return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def nodes(p: str, name: str) -> int:
    """Number of physical operators called ``name`` (numbered detail lines)."""
    import re
    return len(re.findall(rf"^\(\d+\) {name}\b", p, flags=re.M))


def test_filters_reach_the_scan(spark):
    p = plan(spark, E.queries()["window_inclusive"](spark, SF))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in p and "LessThanOrEqual(ts," in p
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in p


def test_projected_read_prunes_columns(spark):
    p = plan(spark, E.queries()["table_read_projected"](spark, SF))
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in p


def test_validation_is_one_scan_and_one_key_shuffle(spark):
    p = plan(spark, E.queries()["qc_report"](spark, SF))
    assert nodes(p, "Scan parquet") == 1
    assert nodes(p, "Exchange") == 2      # the key shuffle + the single-partition final merge
    assert p.count("hashpartitioning(l_orderkey") == 1
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_linenumber:int," in p


def test_no_row_at_a_time_python_in_any_query(spark):
    from tidemark.plans.catalog import QUERIES
    for name, fn in QUERIES.items():
        if name.startswith(("stream_", "upsert", "append", "sorted", "relayout", "partition_", "select_new",
                            "table_read", "hash_dedup", "qc_gate")):
            continue  # these write first; their reads are plain scans
        p = plan(spark, fn(spark, SF))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_upsert_reads_only_touched_partitions(spark, store_root):
    from tidemark.spec import table_spec
    from tidemark.store import TableStore
    spec = table_spec("raw.px", {"k": str, "t": datetime, "v": float}, identity=("k", "t"), partition=("years(t)",))
    store = TableStore(spark, store_root, {spec.identifier: spec})
    rows = spark.createDataFrame([("a", datetime(2023, 1, 1), 1.0), ("b", datetime(2024, 1, 1), 2.0)],
                                 "k string, t timestamp, v double")
    store.append(spec.identifier, rows)
    reached = store._reached(spec.identifier, store.pointer(spec.identifier), [("2024",)])
    assert "PartitionFilters: [(cast(t_years" in plan(spark, reached)
    assert [r.k for r in reached.collect()] == ["b"]


def test_dedup_and_latest_are_partial_aggregates(spark):
    p = plan(spark, E.queries()["page_union"](spark, SF))
    assert "partial_min_by" in p
    p = plan(spark, E.queries()["last_value_per_day"](spark, SF))
    assert "partial_max_by" in p and "Window" not in p
