"""Property: one-pass validation equals a brute-force evaluation of each check."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark import quality as Q

ROW = st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.one_of(st.none(), st.integers(-5, 15)),
                st.sampled_from(["a", "b", "c", None]))


def _brute(rows):
    n = len(rows)
    dup_k = Counter(r[0] for r in rows)
    dup_kc = Counter((r[0], r[2]) for r in rows)
    return {
        "not_null(k)": sum(1 for r in rows if r[0] is None),
        "in_range(v)": sum(1 for r in rows if r[1] is None or not (0 <= r[1] <= 10)),
        "in_range(v) allow_null": sum(1 for r in rows if r[1] is not None and not (0 < r[1] < 10)),
        "accepted_values(c)": sum(1 for r in rows if r[2] is not None and r[2] not in ("a", "b")),
        "v_even": sum(1 for r in rows if r[1] is not None and r[1] % 2 != 0),
        "unique(k)": sum(c for c in dup_k.values() if c > 1),
        "unique(k, c)": sum(c for c in dup_kc.values() if c > 1),
        "not_empty": 0,
        "rows": n,
    }


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(ROW, max_size=25))
def test_validate_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "k long, v long, c string")
    checks = [Q.not_null("k"), Q.in_range("v", 0, 10), Q.in_range("v", 0, 10, inclusive=False, allow_null=True),
              Q.accepted_values("c", ["a", "b"]), Q.expression("v_even", F.col("v") % 2 == 0),
              Q.unique("k"), Q.unique("k", "c"), Q.not_empty()]
    got = Q.validate(df, checks).results
    want = _brute(rows)
    assert [r.failed_rows for r in got] == [want["not_null(k)"], want["in_range(v)"], want["in_range(v) allow_null"],
                                            want["accepted_values(c)"], want["v_even"], want["unique(k)"],
                                            want["unique(k, c)"], 0]
    assert all(r.total_rows == want["rows"] for r in got)
    assert got[-1].passed == (want["rows"] > 0)
