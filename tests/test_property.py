"""Hypothesis: exclusive ranges, coverage and merging against brute force on
arbitrary small inputs, for the window and the bucketed plan."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from brute import depth_brute, exclusive_brute, merge_brute
from solospan.operators import cutting, events, exclusive

SCHEMA = "set_id bigint, begin bigint, end bigint"

ranges = st.lists(
    st.tuples(st.integers(0, 3), st.integers(0, 30), st.integers(0, 8)).map(lambda t: (t[0], t[1], t[1] + t[2])),
    min_size=0,
    max_size=40,
)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=ranges)
def test_exclusive_and_coverage_match_brute_force(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    want = exclusive_brute(data)
    depth = depth_brute(data)
    for strategy in ("window", "bucketed"):
        ex = exclusive.exclusive_ranges(df, strategy=strategy, target_rows=3)
        assert sorted(tuple(r) for r in ex.collect()) == want
        for r in events.coverage_depth(df, strategy=strategy, target_rows=3).collect():
            if r.next_point is not None:
                assert depth.get((r.set_id, r.point), 0) == r.depth
                assert depth.get((r.set_id, r.next_point - 1), 0) == r.depth
    merged = cutting.merge_touching(spark.createDataFrame(want, SCHEMA), strategy="window")
    assert sorted(tuple(r) for r in merged.collect()) == merge_brute(want)


seqs = st.lists(st.tuples(st.integers(0, 2), st.integers(-20, 20)), min_size=0, max_size=60)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=seqs)
def test_order_violations_match_brute_force(spark, data):
    from solospan.operators import audit

    rows = [(s, i, k) for i, (s, k) in enumerate(data)]  # seq unique
    by_set = {}
    for s, i, k in rows:
        by_set.setdefault(s, []).append((i, k))
    want = sorted(
        (s, a[0], a[1], b[0], b[1])
        for s, items in by_set.items()
        for a, b in zip(items, items[1:])
        if a[1] > b[1]
    )
    df = spark.createDataFrame(rows, "set_id bigint, seq bigint, key bigint")
    for strategy in ("window", "bucketed"):
        got = sorted(tuple(r) for r in audit.order_violations(df, "seq", "key", strategy=strategy, target_rows=2).collect())
        assert got == want


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=ranges, width=st.integers(1, 9))
def test_cut_exclusive_glue_round_trip(spark, data, width):
    df = spark.createDataFrame(data, SCHEMA)
    pieces = cutting.cut_at_buckets(df, width).drop("bucket")
    res = exclusive.exclusive_ranges(pieces, strategy="window")
    glued = cutting.glue_ranges(res, cutting.glue_points(df, width), width, strategy="bucketed", target_rows=3)
    assert sorted(tuple(r) for r in glued.collect()) == exclusive_brute(data)
