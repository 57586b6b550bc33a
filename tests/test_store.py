"""Keyed table I/O: projected read, append, upsert semantics, layout."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.spec import table_spec
from tidemark.store import ConcurrentWrite, TableStore

SPEC = table_spec("raw.px", {"k": str, "t": datetime, "v": float, "note": str | None},
                  identity=("k", "t"), partition=("years(t)",), sort=("t", "k"))
FLAT = table_spec("raw.flat", {"d": str, "v": float}, identity=("d",), sort=("d",))


def _rows(spark, rows):
    return spark.createDataFrame(rows, "k string, t timestamp, v double, note string")


def _store(spark, root):
    return TableStore(spark, root, {SPEC.identifier: SPEC, FLAT.identifier: FLAT})


def _files(store, part="", table="raw.px"):
    """Files that hold rows that count."""
    names = {r.f for r in store.scan(table).select(F.col("_metadata.file_path").alias("f")).distinct().collect()}
    return {n for n in names if part in n}


def test_missing_table_reads_empty_with_schema(spark, store_root):
    store = _store(spark, store_root)
    df = store.read("raw.px", columns=["k", "v"])
    assert df.count() == 0 and df.columns == ["k", "v"]
    assert store.read("raw.px").schema == SPEC.schema
    with pytest.raises(KeyError):
        store.read("raw.unknown")


def test_upsert_insert_update_unchanged(spark, store_root):
    store = _store(spark, store_root)
    base = [("a", datetime(2023, 5, 1), 1.0, None), ("b", datetime(2024, 1, 1), 2.0, "x"),
            ("c", datetime(2024, 2, 1), 3.0, None)]
    r0 = store.upsert("raw.px", _rows(spark, base))
    assert (r0.rows_inserted, r0.rows_updated) == (3, 0)
    batch = [("b", datetime(2024, 1, 1), 2.5, "x"),      # changed
             ("c", datetime(2024, 2, 1), 3.0, None),     # unchanged (nulls equal)
             ("d", datetime(2024, 3, 1), 4.0, None)]     # new
    r1 = store.upsert("raw.px", _rows(spark, batch))
    assert (r1.rows_inserted, r1.rows_updated, r1.rows_affected) == (1, 1, 2)
    got = {r.k: r.v for r in store.read("raw.px").collect()}
    assert got == {"a": 1.0, "b": 2.5, "c": 3.0, "d": 4.0}
    again = store.upsert("raw.px", _rows(spark, batch))
    assert again.rows_affected == 0
    assert store.upsert("raw.px", _rows(spark, [])).rows_affected == 0


def test_upsert_touches_only_batch_partitions(spark, store_root):
    store = _store(spark, store_root)
    store.upsert("raw.px", _rows(spark, [("a", datetime(2023, 5, 1), 1.0, None), ("b", datetime(2024, 1, 1), 2.0, None)]))
    before = _files(store, "t_years=2023")
    store.upsert("raw.px", _rows(spark, [("b", datetime(2024, 1, 1), 9.0, None)]))
    assert before == _files(store, "t_years=2023")      # 2023 files untouched
    assert {r.k: r.v for r in store.read("raw.px").collect()} == {"a": 1.0, "b": 9.0}


def test_upsert_rejects_duplicate_and_null_keys(spark, store_root):
    store = _store(spark, store_root)
    dup = [("a", datetime(2024, 1, 1), 1.0, None), ("a", datetime(2024, 1, 1), 2.0, None)]
    with pytest.raises(ValueError, match="duplicate"):
        store.upsert("raw.px", _rows(spark, dup))
    with pytest.raises(Exception, match="'k' is required"):
        store.upsert("raw.px", _rows(spark, [(None, datetime(2024, 1, 1), 1.0, None)]))


def test_unpartitioned_upsert_and_append(spark, store_root):
    store = _store(spark, store_root)
    df = spark.createDataFrame([("2024-06-01", 1.0), ("2024-06-02", 2.0)], "d string, v double")
    assert store.append("raw.flat", df).rows_inserted == 2
    r = store.upsert("raw.flat", spark.createDataFrame([("2024-06-02", 5.0), ("2024-06-03", 6.0)], "d string, v double"))
    assert (r.rows_inserted, r.rows_updated) == (1, 1)
    assert sorted((x.d, x.v) for x in store.read("raw.flat").collect()) == [
        ("2024-06-01", 1.0), ("2024-06-02", 5.0), ("2024-06-03", 6.0)]
    assert store.append("raw.flat", df.filter(F.lit(False))).rows_inserted == 0


def test_layout_drift_and_relayout(spark, store_root):
    store = _store(spark, store_root)
    store.append("raw.px", _rows(spark, [("a", datetime(2023, 5, 1), 1.0, None), ("b", datetime(2024, 1, 9), 2.0, None)]))
    assert store.layout_drift("raw.px") == (True, True)
    store.specs[SPEC.identifier] = SPEC.with_layout(("months(t)",), ("t",))
    assert store.layout_drift("raw.px") == (False, False)
    store.create_all()   # reconciles: rewrites under the new layout
    assert store.layout_drift("raw.px") == (True, True)
    parts = sorted(r.t_months for r in store.read_storage("raw.px").collect())
    assert parts == ["2023-05", "2024-01"]
    assert store.read("raw.px").count() == 2


def test_sorted_files(spark, store_root):
    store = _store(spark, store_root)
    rows = [(f"k{i % 5}", datetime(2024, 1, 1 + i % 28), float(i), None) for i in range(200)]
    store.append("raw.px", _rows(spark, rows).repartition(4))
    data = store.read_storage("raw.px").withColumn("f", F.input_file_name()).collect()
    by_file = {}
    for r in data:
        by_file.setdefault(r.f, []).append((r.t, r.k))
    assert all(v == sorted(v) for v in by_file.values())


def test_upsert_large_batch_path_matches_broadcast_path(spark, store_root):
    """Beyond the broadcast bound the full-outer-join path gives the same table and counts."""
    base = [(f"k{i}", datetime(2023 + i % 2, 1 + i % 12, 1), float(i), None) for i in range(60)]
    batch = [(f"k{i}", datetime(2023 + i % 2, 1 + i % 12, 1), float(i) + (1 if i % 3 == 0 else 0),
              "n" if i % 4 == 0 else None) for i in range(30, 90)]
    results = []
    for threshold in ("64m", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            store = _store(spark, f"{store_root}-{threshold}")
            store.upsert("raw.px", _rows(spark, base))
            r = store.upsert("raw.px", _rows(spark, batch))
            table = sorted((x.k, x.t, x.v, x.note) for x in store.read("raw.px").collect())
            results.append(((r.rows_inserted, r.rows_updated), table))
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert results[0] == results[1]
    assert results[0][0] == (30, 15)


def test_read_keys_prunes_to_batch_partitions(spark, store_root):
    store = _store(spark, store_root)
    store.append("raw.px", _rows(spark, [("a", datetime(2023, 5, 1), 1.0, None), ("b", datetime(2024, 1, 1), 2.0, None)]))
    batch = _rows(spark, [("b", datetime(2024, 1, 1), 5.0, None), ("c", datetime(2024, 2, 1), 6.0, None)])
    keys = store.read_keys("raw.px", batch)
    assert sorted(r.k for r in keys.collect()) == ["b"]
    files = [r.f for r in keys.select(F.input_file_name().alias("f")).collect()]
    assert files and all("t_years=2024" in f for f in files)
    assert "PartitionFilters: [(cast(t_years" in keys._jdf.queryExecution().executedPlan().toString()
    assert store.read_keys("raw.flat", spark.createDataFrame([("x", 1.0)], "d string, v double")).count() == 0


BASE = [("a", datetime(2023, 5, 1), 1.0, None), ("b", datetime(2024, 1, 1), 2.0, None)]
BATCH = [("b", datetime(2024, 1, 1), 9.0, None), ("c", datetime(2024, 3, 1), 3.0, None)]
MERGED = [("a", 1.0), ("b", 9.0), ("c", 3.0)]


def _held(store):
    return sorted((r.k, r.v) for r in store.read("raw.px").collect())


def test_a_writer_lost_before_its_commit_changes_nothing(spark, store_root):
    store = _store(spark, store_root)
    store.upsert("raw.px", _rows(spark, BASE))

    def lost():
        raise RuntimeError("driver lost")

    with pytest.raises(RuntimeError):
        store.upsert("raw.px", _rows(spark, BATCH), before_commit=lost)
    assert _held(_store(spark, store_root)) == [("a", 1.0), ("b", 2.0)]
    assert store.upsert("raw.px", _rows(spark, BATCH)).rows_affected == 2
    assert _held(store) == MERGED
    assert store.vacuum("raw.px") >= 1 and _held(store) == MERGED and store.vacuum("raw.px") == 0


def test_two_writers(spark, store_root):
    """Of two upserts on one state one fails whole and can be run again; an append goes on top."""
    store, other = _store(spark, store_root), _store(spark, store_root)
    store.upsert("raw.px", _rows(spark, BASE))
    late = [("d", datetime(2024, 5, 1), 4.0, None)]
    with pytest.raises(ConcurrentWrite):
        store.upsert("raw.px", _rows(spark, BATCH), before_commit=lambda: other.upsert("raw.px", _rows(spark, late)))
    assert _held(store) == [("a", 1.0), ("b", 2.0), ("d", 4.0)]
    point, calls = TableStore._point, []

    def outrun(self, table, began, to):
        if not calls:
            calls.append(1)
            other.append("raw.px", _rows(spark, [("e", datetime(2024, 6, 1), 5.0, None)]))
        return point(self, table, began, to)

    TableStore._point = outrun
    try:
        store.append("raw.px", _rows(spark, [("f", datetime(2024, 6, 1), 6.0, None)]))
    finally:
        TableStore._point = point
    assert _held(store) == [("a", 1.0), ("b", 2.0), ("d", 4.0), ("e", 5.0), ("f", 6.0)]


def test_the_pointer_stays_small(spark, store_root):
    """It grows by a name a write and by an entry for a partition that was written anew, whatever is in them."""
    store = _store(spark, store_root)
    store.append("raw.px", _rows(spark, [(f"k{i}", datetime(2023 + i % 2, 1, 1), float(i), None) for i in range(400)]).repartition(8))
    for v in range(3):
        store.upsert("raw.px", _rows(spark, [("k0", datetime(2023, 1, 1), 100.0 + v, None)]))
    now = store.pointer("raw.px")
    assert len(now.writes) == 4 and now.since == ((("2023",), now.writes[-1]),)
    assert store.read("raw.px").count() == 400 and store.read("raw.px").where("k = 'k0'").first().v == 102.0
    assert len(_files(store, "t_years=2023")) == 1


def test_null_partitions_are_written_anew_too(spark, store_root):
    spec = table_spec("raw.np", {"k": str, "t": datetime | None, "v": float}, identity=("k",), partition=("years(t)",))
    store = TableStore(spark, store_root, {spec.identifier: spec})
    rows = lambda r: spark.createDataFrame(r, "k string, t timestamp, v double")
    store.append("raw.np", rows([("a", None, 1.0), ("b", datetime(2024, 1, 1), 2.0)]))
    r = store.upsert("raw.np", rows([("a", None, 5.0), ("c", None, 6.0)]))
    assert (r.rows_inserted, r.rows_updated) == (1, 1)
    r = store.upsert("raw.np", rows([("a", datetime(2025, 1, 1), 7.0)]))
    assert sorted((x.k, x.v) for x in store.read("raw.np").collect()) == [("a", 7.0), ("b", 2.0), ("c", 6.0)]


def test_a_read_during_a_write_sees_one_version(spark, store_root):
    store = _store(spark, store_root)
    store.upsert("raw.px", _rows(spark, BASE))
    seen, before = [], store.read("raw.px")
    store.upsert("raw.px", _rows(spark, BATCH), before_commit=lambda: seen.append(_held(store)))
    assert seen == [[("a", 1.0), ("b", 2.0)]] and _held(store) == MERGED
    assert sorted((r.k, r.v) for r in before.collect()) == seen[0]      # a reader that began before


@pytest.mark.parametrize("threshold", ["64m", "-1"])
def test_upsert_into_duplicate_identities(spark, store_root, threshold):
    """A key that is stored twice (two appends): both rows take the batch's values; new keys go in."""
    store = _store(spark, f"{store_root}{threshold}")
    for _ in range(2):
        store.append("raw.flat", spark.createDataFrame([("1", 1.0), ("7", 7.0)], "d string, v double"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        r = store.upsert("raw.flat", spark.createDataFrame([("1", 1.0), ("2", 2.0)], "d string, v double"))
        assert (r.rows_inserted, r.rows_updated) == (1, 0)
        r = store.upsert("raw.flat", spark.createDataFrame([("7", 8.0), ("2", 2.0)], "d string, v double"))
        assert (r.rows_inserted, r.rows_updated) == (0, 2)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted((x.d, x.v) for x in store.read("raw.flat").collect()) == [("1", 1.0), ("1", 1.0), ("2", 2.0), ("7", 8.0), ("7", 8.0)]


def test_a_key_that_changes_partition_moves(spark, store_root):
    spec = table_spec("raw.mv", {"k": str, "t": datetime, "v": float}, identity=("k",), partition=("years(t)",))
    store = TableStore(spark, store_root, {spec.identifier: spec})
    rows = lambda r: spark.createDataFrame(r, "k string, t timestamp, v double")
    store.upsert("raw.mv", rows([("1", datetime(2020, 1, 1), 1.0), ("2", datetime(2020, 1, 1), 2.0)]))
    batch = rows([("1", datetime(2021, 1, 1), 1.0), ("3", datetime(2021, 1, 1), 3.0)])
    assert sorted(r.k for r in store.read_keys("raw.mv", batch).collect()) == ["1", "2"]
    r = store.upsert("raw.mv", batch)
    assert (r.rows_inserted, r.rows_updated) == (1, 1)
    assert sorted((x.k, x.t.year) for x in store.read("raw.mv").collect()) == [("1", 2021), ("2", 2020), ("3", 2021)]


def test_small_upsert_writes_only_partitions_with_changed_keys_anew(spark, store_root):
    store = _store(spark, store_root)
    first = [(f"k{i}", datetime(2023 + i % 3, 1, 1 + i), float(i), None) for i in range(6)]
    store.append("raw.px", _rows(spark, first))
    before = _files(store)
    r = store.upsert("raw.px", _rows(spark, [("k9", datetime(2024, 2, 1), 9.0, None)]))
    assert (r.rows_inserted, r.rows_updated) == (1, 0)
    after_insert = _files(store)
    assert before < after_insert and len(after_insert) == len(before) + 1        # pure addition
    r = store.upsert("raw.px", _rows(spark, [("k4", datetime(2024, 1, 5), 40.0, None),
                                             ("k3", datetime(2023, 1, 4), 3.0, None)]))   # k3 unchanged
    assert (r.rows_inserted, r.rows_updated) == (0, 1)
    gone, new = after_insert - _files(store), _files(store) - after_insert
    assert all("t_years=2024" in f for f in gone) and len(gone) == 2 and len(new) == 1
    got = {x.k: x.v for x in store.read("raw.px").collect()}
    assert got == {"k0": 0.0, "k1": 1.0, "k2": 2.0, "k3": 3.0, "k4": 40.0, "k5": 5.0, "k9": 9.0}


def _scanned(df):
    """Partition filters of the plan, and the files that hold what it reads."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan, {r.f.split("/t_")[1].split("/")[0] for r in df.select("*", F.input_file_name().alias("f")).collect() if "/t_" in r.f}


@pytest.mark.parametrize("layout, folders", [("years(t)", {"years=2022", "years=2023"}), ("months(t)", {"months=2022-12", "months=2023-01"}),
                                             ("days(t)", {"days=2022-12-31", "days=2023-01-01"})])
def test_a_window_reads_only_its_partitions(spark, store_root, layout, folders):
    spec = table_spec("raw.w", {"k": int, "t": datetime | None}, partition=(layout,))
    store = TableStore(spark, store_root, {spec.identifier: spec})
    times = [datetime(2021, 6, 1), datetime(2022, 12, 31, 23), datetime(2023, 1, 1), datetime(2023, 1, 2), datetime(2024, 5, 5), None]
    store.append("raw.w", spark.createDataFrame(list(enumerate(times)), "k long, t timestamp"))
    low, high = datetime(2022, 12, 31, 23), datetime(2023, 1, 1)
    within = store.read_window("raw.w", "t", low, high)
    plan, read = _scanned(within)
    assert sorted(r.k for r in within.collect()) == [1, 2] and read == folders
    assert "PartitionFilters: [isnotnull(t_" in plan
    scanned = within._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scanned.selectedPartitions().partitionCount() == len(folders)
    assert [r.k for r in store.read_window("raw.w", "t", low, high, include_high=False).collect()] == [1]
    assert sorted(r.k for r in store.read_window("raw.w", "t", None, high, columns=["k"]).collect()) == [0, 1, 2]
    assert sorted(r.k for r in store.read_window("raw.w", "t", datetime(2023, 1, 2), None).collect()) == [3, 4]
    assert store.read_window("raw.w", "t").count() == 6
    assert sorted(r.k for r in store.read_window("raw.w", "k", 4, 5).collect()) == [4, 5]


@pytest.mark.parametrize("threshold", ["64m", "-1"])
def test_upsert_with_escaped_partition_values(spark, store_root, threshold):
    """Partition values Spark escapes in folder names (space, colon, percent, slash,
    non-ASCII) survive both commit paths without loss or duplicates."""
    spec = table_spec("raw.sp", {"k": str, "g": str, "v": float}, identity=("g", "k"), partition=("g",))
    store = TableStore(spark, f"{store_root}-{threshold}", {spec.identifier: spec})
    vals = ["a b", "x:y", "p%q", "s/t", "plain", "ü"]
    store.append(spec.identifier, spark.createDataFrame([(f"k{i}", g, float(i)) for i, g in enumerate(vals)],
                                                        "k string, g string, v double"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        r = store.upsert(spec.identifier, spark.createDataFrame(
            [(f"k{i}", g, float(i) + 100) for i, g in enumerate(vals)] + [("new", "a b", 1.0)],
            "k string, g string, v double"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert (r.rows_inserted, r.rows_updated) == (1, 6)
    got = sorted((x.g, x.k, x.v) for x in store.read(spec.identifier).collect())
    assert got == sorted([(g, f"k{i}", float(i) + 100) for i, g in enumerate(vals)] + [("a b", "new", 1.0)])
