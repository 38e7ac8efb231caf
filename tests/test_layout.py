"""The z-order layout: its keys, and the row groups that a lookup has to read."""

import glob
import random

import pyarrow.parquet as pq
import pytest

from solospan.operators import cutting

SCHEMA = "set_id bigint, begin bigint, end bigint"


def interleaved(x, y):
    return sum(((x >> i) & 1) << (2 * i + 1) | ((y >> i) & 1) << (2 * i) for i in range(16))


def test_keys(spark):
    rnd = random.Random(3)
    rows = [(0, b := rnd.randint(-(10**9), 10**9), b + rnd.randint(0, 10**8)) for _ in range(300)]
    low, high = min(r[1] for r in rows), max(r[2] for r in rows)
    step = -(-(high - low + 1) // 65536)
    got = {(r.begin, r.end): r.zkey for r in cutting.zorder_layout(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {(b, e): interleaved((b - low) // step, (e - low) // step) for _, b, e in rows}
    odd = spark.createDataFrame([(0, 1, 1), (0, None, 4)], SCHEMA)
    assert sorted((r.zkey is None) for r in cutting.zorder_layout(odd).collect()) == [False, True]
    assert cutting.zorder_layout(odd.limit(0)).columns == ["set_id", "begin", "end", "zkey"]
    clipped = cutting.zorder_layout(spark.createDataFrame([(0, -5, 10**6)], SCHEMA), bounds=(0, 65535)).first()
    assert clipped.zkey == interleaved(0, 65535)


def groups_that_match(path, point):
    """Row groups whose statistics allow a range that contains the point."""
    n = total = 0
    for f in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        names = [meta.schema.column(i).name for i in range(meta.num_columns)]
        for g in range(meta.num_row_groups):
            stats = {c: meta.row_group(g).column(names.index(c)).statistics for c in ("begin", "end")}
            total += 1
            n += stats["begin"].min <= point <= stats["end"].max
    return n, total


@pytest.mark.parametrize("long_share", [0.02, 0.2])
def test_fewer_row_groups_hold_a_point(spark, tmp_path, long_share):
    rnd = random.Random(7)
    rows = [(0, b := rnd.randint(0, 10**6), b + rnd.randint(0, 4 * 10**5 if rnd.random() < long_share else 100)) for _ in range(20_000)]
    df = spark.createDataFrame(rows, SCHEMA)
    cutting.bucket_layout(df, width=4096, num_partitions=64).write.parquet(f"{tmp_path}/bucket")
    cutting.zorder_layout(df, num_partitions=64).write.parquet(f"{tmp_path}/z")
    points = range(50_000, 10**6, 95_000)
    bucket, z = ([groups_that_match(f"{tmp_path}/{name}", p) for p in points] for name in ("bucket", "z"))
    assert all(t >= 50 for _, t in bucket + z)
    assert sum(n for n, _ in z) < 0.7 * sum(n for n, _ in bucket)
    wanted = "begin <= 500000 and end >= 500000"
    assert spark.read.parquet(f"{tmp_path}/z").where(wanted).count() == df.where(wanted).count()
