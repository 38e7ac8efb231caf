import pytest
from pyspark.sql import functions as F

from brute import big_sets, depth_brute, exclusive_brute, merge_brute, tiny_sets
from solospan.operators import cutting, events, exclusive

SCHEMA = "set_id bigint, begin bigint, end bigint"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def last_octet_cases():
    # (input, expected) pairs; numbers are offsets inside one set.
    return [
        ([(0, 3), (1, 1), (2, 2)], [(0, 0), (3, 3)]),
        ([(0, 0), (1, 1)], [(0, 0), (1, 1)]),
        ([(0, 5), (1, 2), (2, 3)], [(0, 0), (4, 5)]),
        ([(0, 5), (1, 2), (3, 4)], [(0, 0), (5, 5)]),
        ([(0, 1), (1, 1)], [(0, 0)]),
        ([(0, 1), (0, 0)], [(1, 1)]),
        ([(1, 4), (2, 2), (3, 3)], [(1, 1), (4, 4)]),
        ([(1, 8), (3, 4), (5, 6)], [(1, 2), (7, 8)]),
        ([(5, 9), (5, 9)], []),
        ([], []),
    ]


@pytest.mark.parametrize("strategy", ["window", "bucketed"])
def test_hand_cases(spark, strategy):
    base = 3318415360  # 197.203.0.0
    data, expected = [], []
    for sid, (inp, out) in enumerate(last_octet_cases()):
        data += [(sid, base + b, base + e) for b, e in inp]
        expected += [(sid, base + b, base + e) for b, e in out]
    df = spark.createDataFrame(data, SCHEMA)
    got = rows(exclusive.exclusive_ranges(df, strategy=strategy, target_rows=2))
    assert got == sorted(expected)


@pytest.mark.parametrize("strategy", ["window", "auto", "bucketed"])
def test_tiny_domain_against_brute_force(spark, strategy):
    data = tiny_sets(7)
    df = spark.createDataFrame(data, SCHEMA)
    got = rows(exclusive.exclusive_ranges(df, strategy=strategy, target_rows=4))
    assert got == exclusive_brute(data)


@pytest.mark.parametrize("target", [8, 40, 10**6])
def test_big_and_clustered_sets_against_brute_force(spark, target):
    data = big_sets(11)
    df = spark.createDataFrame(data, SCHEMA)
    got = rows(exclusive.exclusive_ranges(df, strategy="bucketed", target_rows=target))
    assert got == exclusive_brute(data)


def laid_out(points, plan, cols):
    """Rows of each partition of the range exchange."""
    laid = points.repartitionByRange(plan.partitions, *cols)
    return sorted(r["count"] for r in laid.groupBy(F.spark_partition_id()).count().collect())


def test_range_plan_only_for_big_groups(spark):
    from solospan.plans.scan import scan_plan

    ev = events.half_open_events(spark.createDataFrame(big_sets(11), SCHEMA))
    plan = scan_plan(ev, ["set_id"], "x", target_rows=40)
    assert plan.n_big == 2  # sets 1000 and 1001 only
    assert scan_plan(ev, ["set_id"], "x", target_rows=10**6) is None
    assert scan_plan(ev.where("set_id < 1000"), ["set_id"], "x", target_rows=40) is None


def test_clustering_at_several_scales_gives_even_partitions(spark):
    import random

    from solospan.plans.scan import RangePlan

    rnd = random.Random(3)
    data = [(9, 10**9 + k, 10**9 + k + 1) for k in range(0, 40, 4)]  # far away: huge span
    data += [(9, b, b + rnd.randint(0, 5)) for b in (rnd.randint(0, 3000) for _ in range(500))]
    data += [(9, b, b + rnd.randint(0, 2)) for b in (rnd.randint(0, 400) for _ in range(900))]
    df = spark.createDataFrame(data, SCHEMA)
    sizes = laid_out(events.half_open_events(df), RangePlan(8), ["set_id", "x"])
    assert len(sizes) == 8 and sizes[-1] < 3 * 2 * len(data) / 8
    got = rows(exclusive.exclusive_ranges(df, strategy="bucketed", target_rows=40))
    assert got == exclusive_brute(data)
    cov = events.coverage_depth(df, strategy="bucketed", target_rows=40)
    ref = events.coverage_depth(df, strategy="window")
    assert sorted(map(tuple, cov.collect())) == sorted(map(tuple, ref.collect()))


def test_coverage_depth_against_brute_force(spark):
    data = big_sets(3)
    df = spark.createDataFrame(data, SCHEMA)
    d = depth_brute(data)
    for strategy in ("window", "bucketed"):
        cov = events.coverage_depth(df, strategy=strategy, target_rows=16).collect()
        for r in cov:
            if r.next_point is None:
                assert r.depth == 0
                continue
            for p in (r.point, r.next_point - 1):
                assert d.get((r.set_id, p), 0) == r.depth


def test_cut_exclusive_glue_equals_uncut(spark):
    data = tiny_sets(5) + big_sets(5)
    df = spark.createDataFrame(data, SCHEMA)
    for width in (1, 3, 4, 16):
        pieces = cutting.cut_at_buckets(df, width).drop("bucket")
        res = exclusive.exclusive_ranges(pieces, strategy="window")
        glued = cutting.glue_ranges(res, cutting.glue_points(df, width), width, target_rows=8, strategy="bucketed")
        assert rows(glued) == exclusive_brute(data), width


def test_cut_pieces_that_coincide(spark):
    # width 8: [5,14] and [5,8] both give the piece [5,7]
    df = spark.createDataFrame([(0, 5, 14), (0, 5, 8)], SCHEMA)
    pieces = cutting.cut_at_buckets(df, 8).drop("bucket")
    res = exclusive.exclusive_ranges(pieces)
    glued = cutting.glue_ranges(res, cutting.glue_points(df, 8), 8)
    assert rows(glued) == [(0, 9, 14)]


def test_merge_touching_against_brute_force(spark):
    data = tiny_sets(9)
    df = spark.createDataFrame(data, SCHEMA)
    ex = exclusive.exclusive_ranges(df)
    for strategy in ("window", "bucketed"):
        got = rows(cutting.merge_touching(ex, strategy=strategy, target_rows=4))
        assert got == merge_brute(exclusive_brute(data))


def test_presorted_gate_raises_on_unsorted_input(spark):
    df = spark.createDataFrame([(0, 1, 10, 20), (0, 2, 5, 6)], "set_id bigint, seq bigint, begin bigint, end bigint")
    with pytest.raises(Exception, match="Order violation"):
        exclusive.exclusive_ranges_presorted(df, seq="seq").collect()
    ok = spark.createDataFrame([(0, 1, 5, 20), (0, 2, 10, 12)], "set_id bigint, seq bigint, begin bigint, end bigint")
    assert rows(exclusive.exclusive_ranges_presorted(ok, seq="seq")) == [(0, 5, 9), (0, 13, 20)]


def test_keys_are_generic(spark):
    df = spark.createDataFrame([("a", 1, 0, 5), ("a", 1, 3, 9), ("b", 2, 0, 5)], "k1 string, k2 int, lo bigint, hi bigint")
    got = rows(exclusive.exclusive_ranges(df, keys=["k1", "k2"], begin="lo", end="hi"))
    assert got == [("a", 1, 0, 2), ("a", 1, 6, 9), ("b", 2, 0, 5)]


def test_no_keys_is_one_global_set(spark):
    data = [(0, b, e) for (_s, b, e) in big_sets(2) if _s == 1000]
    df = spark.createDataFrame(data, SCHEMA).drop("set_id")
    for strategy in ("window", "bucketed"):
        got = sorted((0, r.begin, r.end) for r in exclusive.exclusive_ranges(df, keys=[], strategy=strategy, target_rows=8).collect())
        assert got == exclusive_brute(data)


def test_hot_point_is_combined_before_the_shuffle(spark):
    from solospan.plans.scan import scan_plan

    data = [(7, 5, 5 + k % 9) for k in range(300)] + [(7, b, b + 3) for b in range(0, 2000, 7)] + tiny_sets(4, n_sets=20)
    df = spark.createDataFrame(data, SCHEMA)
    plan = scan_plan(events.half_open_events(df), ["set_id"], "x", target_rows=40)
    assert plan.n_hot >= 1
    for strategy in ("bucketed", "window"):
        got = rows(exclusive.exclusive_ranges(df, strategy=strategy, target_rows=40))
        assert got == exclusive_brute(data)
    cov = {(r.set_id, r.point): r.depth for r in events.coverage_depth(df, strategy="bucketed", target_rows=40).collect()}
    assert cov[(7, 5)] == 300


def test_null_and_reversed_ranges_cover_nothing(spark):
    df = spark.createDataFrame(
        [(0, 0, 10), (0, 5, 3), (0, None, 4), (1, 2147483647, 2147483647)], "set_id bigint, begin int, end int"
    )
    for strategy in ("window", "bucketed"):
        got = rows(exclusive.exclusive_ranges(df, strategy=strategy, target_rows=1))
        assert got == [(0, 0, 10), (1, 2147483647, 2147483647)]


def test_string_keys_with_bucketed_plan(spark):
    data = big_sets(6)
    df = spark.createDataFrame([(f"s{s}", b, e) for s, b, e in data], "name string, begin bigint, end bigint")
    got = sorted((r.name, r.begin, r.end) for r in exclusive.exclusive_ranges(df, keys=["name"], strategy="bucketed", target_rows=30).collect())
    assert got == sorted((f"s{s}", b, e) for s, b, e in exclusive_brute(data))


def test_partitions_follow_the_rows(spark):
    from solospan.plans.scan import DEFAULT_TARGET_ROWS, scan_plan

    df = spark.createDataFrame(big_sets(8), SCHEMA)
    ev = events.half_open_events(df)
    assert scan_plan(ev, ["set_id"], "x", n_rows=10**9 * DEFAULT_TARGET_ROWS, target_rows=4).partitions == 10**9
    assert scan_plan(ev, ["set_id"], "x", n_rows=24, target_rows=4).partitions == 6
    assert scan_plan(ev, ["set_id"], "x", target_rows=4).partitions == 8  # the session's shuffle partitions
    got = rows(exclusive.exclusive_ranges(df, strategy="bucketed", target_rows=4))
    assert got == exclusive_brute(big_sets(8))


def test_negative_coordinates(spark):
    import random

    rnd = random.Random(5)
    data = [(0, b, b + rnd.randint(0, 6)) for b in (rnd.randint(-300, 300) for _ in range(300))]
    df = spark.createDataFrame(data, SCHEMA)
    for strategy in ("window", "bucketed"):
        assert rows(exclusive.exclusive_ranges(df, strategy=strategy, target_rows=20)) == exclusive_brute(data)
    pieces = cutting.cut_at_buckets(df, 16).drop("bucket")
    glued = cutting.glue_ranges(exclusive.exclusive_ranges(pieces), cutting.glue_points(df, 16), 16)
    assert rows(glued) == exclusive_brute(data)


def test_null_set_key_is_a_group(spark):
    data = [(None, 0, 9), (None, 3, 4), (1, 0, 9)]
    df = spark.createDataFrame(data, SCHEMA)
    want = [(None, 0, 2), (None, 5, 9), (1, 0, 9)]
    key = lambda t: (t[0] is not None, t[0] or 0, t[1])
    for strategy in ("window", "bucketed"):
        got = sorted(map(tuple, exclusive.exclusive_ranges(df, strategy=strategy, target_rows=1).collect()), key=key)
        assert got == sorted(want, key=key)
    pieces = cutting.cut_at_buckets(df, 4).drop("bucket")
    glued = cutting.glue_ranges(exclusive.exclusive_ranges(pieces), cutting.glue_points(df, 4), 4)
    assert sorted(map(tuple, glued.collect()), key=key) == sorted(want, key=key)


def test_null_set_is_split(spark):
    import random

    from solospan.plans.scan import scan_plan

    rnd = random.Random(4)
    data = [(None if i % 3 == 0 else i % 5, b, b + rnd.randint(0, 9)) for i, b in enumerate(rnd.randint(0, 10**6) for _ in range(3000))]
    df = spark.createDataFrame(data, SCHEMA)
    ev = events.half_open_events(df)
    plan = scan_plan(ev, ["set_id"], "x", target_rows=200)
    sizes = laid_out(ev, plan, ["set_id", "x"])
    assert plan.n_big > 1 and sizes[-1] < 2 * sum(sizes) / len(sizes)
    key = lambda t: (t[0] is not None, t[0] or 0, t[1])
    got, want = (exclusive.exclusive_ranges(df, strategy=s, target_rows=200).collect() for s in ("bucketed", "window"))
    assert sorted(map(tuple, got), key=key) == sorted(map(tuple, want), key=key)


def test_one_far_coordinate_and_a_dense_region(spark):
    import random

    rnd = random.Random(3)
    data = [(9, 10**9 + k, 10**9 + k + 1) for k in range(0, 40, 4)]
    data += [(9, b, b + rnd.randint(0, 2)) for b in (rnd.randint(0, 20000) for _ in range(2000))]
    df = spark.createDataFrame(data, SCHEMA)
    assert rows(exclusive.exclusive_ranges(df, strategy="bucketed", target_rows=40)) == exclusive_brute(data)
