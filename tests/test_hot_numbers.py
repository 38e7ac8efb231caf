"""Numbering of sets with hot begins and equal rows, gates of invalid and overlapping ranges, long spans."""

import random

import pytest

from solospan.operators import cutting, events, exclusive
from solospan.plans.scan import scan_plan
from solospan.sources import sinks

SCHEMA = "set_id bigint, begin bigint, end bigint"


def skewed_rows():
    rnd = random.Random(5)
    rows = [(0, 50, 50 + rnd.randint(0, 5000)) for _ in range(4000)]  # a hot begin
    rows += [(0, 70, 90)] * 2500  # equal rows
    rows += [(None, rnd.randint(0, 10**6), 10**6) for _ in range(2000)]  # a NULL set
    rows += [(0, b := rnd.randint(0, 100), b + rnd.randint(0, 9)) for _ in range(1500)]
    return rows + [(2, 5, 6), (2, None, 6)]


@pytest.mark.parametrize("keys", [("set_id",), ()])
def test_hot_begins_and_equal_rows_are_numbered(spark, keys):
    rows = skewed_rows()
    df = spark.createDataFrame(rows, SCHEMA)
    plan = scan_plan(df, list(keys), ["begin", "end"], target_rows=200)
    assert plan.n_hot >= 1  # the equal rows; those that share a begin only are parted by end
    places = {}
    for s, b, e in sorted(rows, key=lambda r: (r[0] or 0, r[1] is not None, r[1] or 0, r[2])) if keys else sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2])):
        places.setdefault(s if keys else "all", []).append((b, e))
    got = {}
    for r in sinks._numbered(
        df.selectExpr("set_id" if keys else "0 as set_id", "begin", "end", "1L as _one"), ["set_id"], ["begin", "end"], "bucketed", 200
    ).collect():
        got.setdefault(r.set_id if keys else "all", {})[r.n] = (r.begin, r.end)
    assert {s: [got[s][n + 1] for n in range(len(got[s]))] for s in got} == places
    listed = sinks.numbered_listing(df, keys, strategy="bucketed", target_rows=200)
    assert listed.count() == len(rows) and listed.columns == [*keys, "n", "line"]


def test_invalid_ranges_are_listed_or_refused(spark):
    df = spark.createDataFrame([(0, 1, 4), (0, 9, 5), (0, None, 3), (1, 2, 2)], SCHEMA)
    assert sorted(r.reason for r in events.invalid_ranges(df).collect()) == ["null bound", "reversed"]
    assert exclusive.exclusive_ranges(df).count() == 2
    for read in (lambda d: d.count(), lambda d: d.select("end").collect(), lambda d: d.where("set_id = 0").collect()):
        with pytest.raises(Exception, match="Invalid range"):
            read(exclusive.exclusive_ranges(df, on_invalid="raise"))
    good = df.where("begin <= end")
    assert sorted(exclusive.exclusive_ranges(good, on_invalid="raise").collect()) == sorted(exclusive.exclusive_ranges(df).collect())


@pytest.mark.parametrize("target", [None, 2])
def test_overlapping_ranges_are_not_merged(spark, target):
    df = spark.createDataFrame([(0, 1, 9), (0, 2, 3), (0, 4, 5)], SCHEMA)
    with pytest.raises(Exception, match="Overlapping ranges"):
        cutting.merge_touching(df, target_rows=target).collect()


def test_spans_of_many_edges(spark):
    df = spark.createDataFrame([(0, -5, 200_000), (0, 3, 199_990), (0, 7, 1), (None, 2, 3), (1, None, 3)], SCHEMA)
    pieces = cutting.cut_at_buckets(df, 1)
    assert pieces.where("set_id = 0").count() == 200_006 + 199_988
    assert pieces.where("begin <> end or bucket <> begin").count() == 0
    points = cutting.glue_points(df, 1)
    assert points.where("set_id = 0").selectExpr("min(bucket)", "max(bucket)", "count(*)").first()[:] == (-4, 200_000, 200_005)
    assert points.where("set_id is null").selectExpr("collect_list(bucket)").first()[0] == [3]
