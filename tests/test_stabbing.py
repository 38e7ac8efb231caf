"""Open ranges as rows: the dyadic join against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from solospan.operators import events, stabbing

SCHEMA = "set_id bigint, begin bigint, end bigint"


def brute(rows):
    out = {}
    for s, b, e in rows:
        for s2, p, e2 in rows:
            if None not in (b, e, p, e2) and s == s2 and p <= e2 and b <= p <= e:
                out.setdefault((s, p, b, e), set())
    for key in out:
        s, p, b, e = key
        out[key] = sum(r == (s, b, e) for r in rows)
    return out


@pytest.mark.parametrize("width", [1, 4, 64])
def test_open_rows_against_brute_force(spark, width):
    rnd = random.Random(width)
    rows = [(rnd.choice([None, 1, 2]), b := rnd.randint(-40, 90), b + rnd.randint(0, rnd.choice([0, 3, 130]))) for _ in range(150)]
    rows += rows[::7] + [(1, 5, 2), (1, None, 4), (2, 3, None), (1, -200, 300)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r.set_id, r.point, r.begin, r.end): r.n for r in stabbing.open_range_rows(df, width=width).collect()}
    assert got == brute(rows)
    counts = {(r.set_id, r.point): r.n_open for r in events.open_ranges(df).collect()}
    mine = {}
    for (s, p, _, _), n in got.items():
        mine[s, p] = mine.get((s, p), 0) + n
    assert mine == counts


def test_a_range_over_all_buckets_is_filed_a_few_times(spark):
    n = 100_000
    wide = spark.createDataFrame([(0, 0, 64 * n - 1), (0, 3, 64 * n - 5)], SCHEMA)
    filed = stabbing.file_ranges(wide, 64).groupBy("begin").count().collect()
    assert all(r["count"] <= 2 + 2 * 17 for r in filed)
    points = spark.range(0, 64 * n, 640).select(F.lit(0).cast("bigint").alias("set_id"), F.col("id").alias("point"))
    met = stabbing.ranges_containing(points, wide, width=64)
    assert met.count() == 2 * points.count() - 1  # the second begins behind the first point


def test_the_cover_is_exact(spark):
    rnd = random.Random(8)
    spans = [(0, a := rnd.randint(-300, 300), a + rnd.randint(0, 200)) for _ in range(120)]
    filed = stabbing.file_ranges(spark.createDataFrame(spans, SCHEMA).distinct(), 1).where("_level >= 0").collect()
    covered = {}
    for r in filed:
        covered.setdefault((r.begin, r.end), []).extend(range(r._node << r._level, (r._node + 1) << r._level))
    for _, a, b in spans:
        assert sorted(covered.get((a, b), [])) == list(range(a + 1, b))


def test_clashing_columns_and_empty_tables(spark):
    df = spark.createDataFrame([(0, 1, 5)], SCHEMA)
    with pytest.raises(ValueError, match="columns of both"):
        stabbing.ranges_containing(df.selectExpr("set_id", "begin as point", "end"), df)
    assert stabbing.open_range_rows(df.limit(0)).count() == 0
    no_keys = stabbing.open_range_rows(df.drop("set_id"), keys=[])
    assert no_keys.columns == ["point", "begin", "end", "n"] and no_keys.count() == 1


def test_the_join_is_an_equi_join(spark):
    plan = stabbing.open_range_rows(spark.range(100).selectExpr("id % 3 as set_id", "id as begin", "id + 50 as end"))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    physical = plan._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in physical and "NestedLoop" not in physical and "Join" in text
