"""Property: keyed upsert equals a dictionary merge (content and counts), on both strategies."""

import uuid
from datetime import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.spec import table_spec
from tidemark.store import TableStore

SPEC = table_spec("raw.pp", {"k": str, "t": datetime, "v": float, "note": str | None},
                  identity=("k", "t"), partition=("years(t)",), sort=("t",))
KEY = st.tuples(st.sampled_from(["a", "b", "c", "d"]), st.sampled_from([datetime(2023, 3, 1), datetime(2024, 7, 1)]))
VAL = st.tuples(st.sampled_from([1.0, 2.0, 3.0]), st.sampled_from([None, "x"]))
TABLE = st.dictionaries(KEY, VAL, max_size=8)


def _df(spark, d):
    return spark.createDataFrame([(k, t, v, n) for (k, t), (v, n) in d.items()],
                                 "k string, t timestamp, v double, note string")


def _check(spark, store_root, base, batch, threshold):
    store = TableStore(spark, f"{store_root}-{uuid.uuid4().hex[:8]}", {SPEC.identifier: SPEC})
    if base:
        store.append(SPEC.identifier, _df(spark, base))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        r = store.upsert(SPEC.identifier, _df(spark, batch))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    want = {**base, **batch}
    inserted = sum(1 for key in batch if key not in base)
    updated = sum(1 for key, val in batch.items() if key in base and base[key] != val)
    got = {(x.k, x.t): (x.v, x.note) for x in store.read(SPEC.identifier).collect()}
    assert store.read(SPEC.identifier).count() == len(got)      # no duplicate keys
    assert got == want
    assert (r.rows_inserted, r.rows_updated) == (inserted, updated)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(TABLE, TABLE)
def test_upsert_matches_dict_merge_broadcast(spark, store_root, base, batch):
    _check(spark, store_root, base, batch, "64m")


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(TABLE, TABLE)
def test_upsert_matches_dict_merge_shuffled(spark, store_root, base, batch):
    _check(spark, store_root, base, batch, "-1")
