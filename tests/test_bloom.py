"""Membership filters, and the store's answer from them."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators.bloom import key_bits, maybe_members, merged_bits
from tidemark.spec import table_spec
from tidemark.store import TableStore

SPEC = table_spec("raw.items", {"h": str | None, "t": datetime | None}, partition=("years(t)",), member="h")


def _keys(spark, values):
    return spark.createDataFrame([(v,) for v in values], "h string")


def test_no_member_is_missed_and_few_strangers_pass(spark):
    held = [f"k{i}" for i in range(3000)] + [None]
    bits = key_bits(_keys(spark, held), "h")
    asked = _keys(spark, held + [f"x{i}" for i in range(3000)])
    passed = {r.h for r in maybe_members(asked, "h", bits).collect()}
    assert set(held) - {None} <= passed and len(passed) < 3010 and None not in passed


def test_merged_filters_hold_the_members_of_each(spark):
    parts = _keys(spark, [f"k{i}" for i in range(500)]).withColumn("part", F.expr("int(substring(h, 2)) % 3"))
    bits = key_bits(parts, "h", by=("part",))
    asked = _keys(spark, [f"k{i}" for i in range(600)])
    got = {(r.h, r.part) for r in maybe_members(asked, "h", bits, by=("part",)).collect()}
    assert {(f"k{i}", i % 3) for i in range(500)} <= got and len(got) < 510
    assert {f"k{i}" for i in range(500)} <= {r.h for r in maybe_members(asked, "h", merged_bits(bits)).collect()}


def test_unseen_equals_the_anti_join_and_reads_only_writes_that_may_hold_a_value(spark, store_root):
    store = TableStore(spark, store_root, {SPEC.identifier: SPEC})
    frame = lambda keys: _keys(spark, keys).withColumn("t", F.lit(datetime(2024, 1, 1)).cast("timestamp"))
    assert store.unseen(SPEC.identifier, frame(["a"])).count() == 1
    for k in range(3):
        store.append(SPEC.identifier, frame([f"w{k}-{i}" for i in range(200)] + [None]))
    batch = frame(["w1-5", "w1-6", "new", "new", None]).persist()
    got = store.unseen(SPEC.identifier, batch)
    assert sorted((r.h for r in got.collect()), key=str) == [None, "new", "new"]
    # the anti-join reads one of the three writes
    leaves = [x for x in got._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Relation [" in x and x.endswith("parquet")]
    assert len(leaves) == 1 and len(got.inputFiles()) == len([f for f in got.inputFiles() if f"write={store.pointer(SPEC.identifier).writes[1]}" in f]) > 0
    assert store.unseen(SPEC.identifier, frame(["new"]).persist()).inputFiles() == []
    plain = table_spec("raw.plain", {"h": str})
    with pytest.raises(ValueError, match="membership"):
        TableStore(spark, store_root, {plain.identifier: plain}).unseen(plain.identifier, batch)
    assert store.append(SPEC.identifier, frame([])).rows_inserted == 0
    store.relayout(SPEC.identifier, partition=())
    assert sorted((r.h for r in store.unseen(SPEC.identifier, batch).collect()), key=str) == [None, "new", "new"]
    assert store.vacuum(SPEC.identifier) == 4       # one of them held no rows
