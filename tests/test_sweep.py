"""The sweep of range partitions against windows over whole groups."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from solospan.plans.scan import RangePlan, ordered_scan, scan_plan

KW = dict(
    sums={"s": "v", "t": "one"},
    leads={"na": "a", "nb": "b", "nd": "d", "nk": "k2"},
    lags={"pb": "b", "pa": "a", "pd": "d", "pk": "k2"},
)


def nulls_first(r):
    return tuple((x is not None, x) for x in r)


def table(spark, n, sets, seed):
    rnd = random.Random(seed)
    day = datetime.date(2024, 1, 1)
    rows = [
        (rnd.choice(sets), rnd.choice("xy") if rnd.random() < 0.9 else None, rnd.randint(0, 200) if rnd.random() < 0.9 else None, i, rnd.randint(-3, 3), 1, day + datetime.timedelta(i % 50) if i % 7 else None)
        for i in range(n)
    ]
    return spark.createDataFrame(rows, "k bigint, k2 string, a bigint, b bigint, v int, one bigint, d date")


@pytest.fixture
def small_batches(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "7")
    yield
    spark.conf.set(name, before)


@pytest.mark.parametrize("keys", [["k"], ["k", "k2"], []])
@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_sweep_equals_windows(spark, small_batches, keys, partitions):
    for n, sets in ((600, [None, 0, 0, 0, 1, 2]), (60, list(range(40))), (1, [5]), (0, [1])):
        df = table(spark, n, sets, n + partitions)
        want = ordered_scan(df, keys, ["a", "b"], plan=None, **KW)
        got = ordered_scan(df, keys, ["a", "b"], plan=RangePlan(partitions), **KW)
        assert got.columns == want.columns
        assert sorted(map(tuple, got.collect()), key=nulls_first) == sorted(map(tuple, want.collect()), key=nulls_first)


def test_a_group_over_many_partitions(spark):
    df = spark.range(5000).select((F.col("id") * 3).alias("x"), F.lit(1).cast("bigint").alias("one"))
    got = ordered_scan(df, [], ["x"], {"n": "one"}, {"next": "x"}, RangePlan(16), {"last": "x"}).orderBy("x").collect()
    assert [r.n for r in got] == list(range(1, 5001))
    assert [r.next for r in got] == [3 * i for i in range(1, 5000)] + [None]
    assert [r.last for r in got] == [None] + [3 * i for i in range(4999)]


def test_sums_beyond_bigint_fail(spark):
    df = spark.range(6).select("id", F.lit(4 * 10**18).cast("bigint").alias("v"))
    with pytest.raises(Exception, match="does not fit BIGINT"):
        ordered_scan(df, [], ["id"], {"s": "v"}, plan=RangePlan(1)).collect()


def test_plan_of_an_unknown_strategy(spark):
    with pytest.raises(ValueError, match="unknown strategy"):
        scan_plan(spark.range(3), [], "id", "magic")


def tops_brute(rows, keyed):
    out, seen = [], {}
    for r in sorted(rows, key=lambda r: ((r[1] is not None, r[1] or 0), r[2])):
        mine = seen.setdefault(r[0] if keyed else 0, [])
        mine += [] if r[3] is None else [r[3]]
        top = sorted(mine, reverse=True) + [None, None]
        out.append((*r, top[0], top[1]))
    return sorted(out, key=nulls_first)


@pytest.mark.parametrize("keys", [["k"], []])
def test_the_two_largest_so_far(spark, small_batches, keys):
    rnd = random.Random(1)
    rows = [(rnd.choice([None, 0, 0, 0, 1, 2]), rnd.randint(0, 200) if rnd.random() < 0.9 else None, i, rnd.randint(-30, 30) if rnd.random() < 0.9 else None) for i in range(400)]
    df = spark.createDataFrame(rows, "k bigint, a bigint, b bigint, v bigint")
    for plan in (None, RangePlan(1), RangePlan(7), RangePlan(60)):
        got = ordered_scan(df, keys, ["a", "b"], tops={("m", "n"): "v"}, plan=plan)
        assert sorted(map(tuple, got.collect()), key=nulls_first) == tops_brute(rows, bool(keys))


# sorted files


def test_sorted_files_are_swept_as_they_lie(spark, small_batches, tmp_path):
    from brute import big_sets, exclusive_brute, tiny_sets
    from solospan.operators import exclusive

    data = [(None, 3, 9), (None, 4, 4), *big_sets(21), *tiny_sets(22, n_sets=30), (5000, 0, 10**6)]
    df = spark.createDataFrame(data, "set_id bigint, begin bigint, end bigint")
    plain = [r for r in data if r[0] is not None]
    for n in (1, 6, 40):
        path = f"{tmp_path}/t{n}"
        exclusive.write_sorted_ranges(df, path, num_partitions=n)
        plan = exclusive.swept_files(spark, path, ["set_id"], "begin", "end")._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Sort" not in plan and plan.count("FileScan") == 1
        got = [tuple(r) for r in exclusive.exclusive_ranges_of_sorted(spark, path).collect()]
        small = [r for r in plain if r[0] != 5000]
        assert sorted(r for r in got if r[0] is not None and r[0] != 5000) == exclusive_brute(small)
        assert sorted(r for r in got if r[0] is None) == [(None, 3, 3), (None, 5, 9)] and (5000, 0, 10**6) in got


def test_files_out_of_order_fail(spark, tmp_path):
    from solospan.operators import exclusive

    rows = lambda a: spark.createDataFrame(a, "set_id bigint, begin bigint, end bigint").coalesce(1)
    rows([(0, 5, 9), (0, 2, 3)]).write.parquet(f"{tmp_path}/rows")
    with pytest.raises(Exception, match="Order violation"):
        exclusive.exclusive_ranges_of_sorted(spark, f"{tmp_path}/rows").count()
    rows([(0, 1, 2), (0, 9, 9), (1, 4, 4)]).write.parquet(f"{tmp_path}/files")
    rows([(0, 5, 6), (0, 7, 7)]).write.mode("append").parquet(f"{tmp_path}/files")  # inside the other file's stretch
    with pytest.raises(Exception, match="files overlap"):
        exclusive.exclusive_ranges_of_sorted(spark, f"{tmp_path}/files").count()
    rows([(0, 1, 2), (0, 9, 9)]).write.parquet(f"{tmp_path}/good")
    rows([(0, 9, 12), (1, 7, 7)]).write.mode("append").parquet(f"{tmp_path}/good")
    got = exclusive.exclusive_ranges_of_sorted(spark, f"{tmp_path}/good").collect()
    assert sorted(map(tuple, got)) == [(0, 1, 2), (0, 10, 12), (1, 7, 7)]
