"""Batches taken into a range store, and tables that are committed as a whole."""

import random

import pytest
from pyspark.sql import functions as F

from brute import depth_brute, exclusive_brute
from solospan.operators import events
from solospan.sources.committed import CommitConflict, CommittedTable
from solospan.streaming.incremental import RangeStore, foreach_batch_updater

SCHEMA = "set_id bigint, begin bigint, end bigint"


def ranges(seed, n, sets=3, top=400):
    rnd = random.Random(seed)
    return [(rnd.randrange(sets), b := rnd.randint(-50, top), b + rnd.randint(0, rnd.choice([2, 9, 300]))) for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def stored(store):
    return sorted(map(tuple, store.exclusive_ranges().collect()))


@pytest.mark.parametrize("width", [16, 1000])
def test_batches_equal_the_whole(spark, tmp_path, width):
    store, all_rows = RangeStore(spark, f"{tmp_path}/s", width=width), []
    for i in range(4):
        rows = ranges(i, 40)
        all_rows += rows
        assert store.apply(frame(spark, rows), i)
        assert stored(store) == exclusive_brute(all_rows)
    want = sorted(map(tuple, events.coverage_depth(frame(spark, all_rows)).collect()), key=repr)
    assert sorted(map(tuple, store.coverage().collect()), key=repr) == want
    assert depth_brute(all_rows)


def test_only_touched_buckets_are_read_and_written(spark, tmp_path):
    store = RangeStore(spark, f"{tmp_path}/s", width=100)
    rows = [(s, b, b + 30) for s in range(3) for b in range(0, 2000, 37)]
    store.apply(frame(spark, rows), 0)
    before = store.cells.state()
    more = [(1, 510, 520), (1, 450, 1760)]  # endpoints in the buckets 4, 5 and 17; all between are covered anew
    assert len(before.parts) == 21
    touched = store.touched_parts(events.half_open_events(frame(spark, more)).selectExpr("x div 100 as bucket"))
    assert sorted(touched) == ["bucket=17", "bucket=4", "bucket=5"]
    files = store.cells.read(touched).inputFiles()
    assert files and all(any(f"/{p}/" in f for p in touched) for f in files)
    store.apply(frame(spark, more), 1)
    after = store.cells.state()
    assert {p for p in after.parts if after.parts[p] != before.parts.get(p)} == set(touched)
    assert store.sums.state().parts == after.parts
    assert stored(store) == exclusive_brute(rows + more)
    plan = store.exclusive_ranges()._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_replays_and_retracted_ranges(spark, tmp_path):
    store = RangeStore(spark, f"{tmp_path}/s", width=64)
    a, b = ranges(1, 50), ranges(2, 50)
    assert store.apply(frame(spark, a), 0) and store.apply(frame(spark, b), 1)
    number = store.cells.state().number
    assert not store.apply(frame(spark, b), 1) and not store.apply(frame(spark, a), 0)
    assert store.cells.state().number == number
    assert store.apply(frame(spark, b), 7, source="corrections", retract=True)
    assert stored(store) == exclusive_brute(a)
    assert store.apply(frame(spark, a), 2, retract=True)
    assert stored(store) == [] and store.cells.read().count() == 0 and store.carries().count() == 0


def test_a_run_that_stops_between_the_commits_is_finished(spark, tmp_path, monkeypatch):
    store = RangeStore(spark, f"{tmp_path}/s", width=64)
    a, b = ranges(3, 50), ranges(4, 50)
    store.apply(frame(spark, a), 0)
    with monkeypatch.context() as m:
        m.setattr(store.sums, "commit", lambda *args: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            store.apply(frame(spark, b), 1)
    again = RangeStore(spark, f"{tmp_path}/s", width=64)
    assert not again.apply(frame(spark, b), 1)
    assert stored(again) == exclusive_brute(a + b)


def test_a_write_that_fails_leaves_the_old_rows(spark, tmp_path, monkeypatch):
    store = RangeStore(spark, f"{tmp_path}/s", width=64)
    a, b = ranges(5, 50), ranges(6, 50)
    store.apply(frame(spark, a), 0)
    bad = frame(spark, b).withColumn("end", F.when(F.col("begin") >= 0, F.raise_error(F.lit("broken")).cast("bigint")).otherwise(F.col("end")))
    with pytest.raises(Exception, match="broken"):
        store.apply(bad, 1)
    with monkeypatch.context() as m:  # staged, and then the writer dies before it commits
        m.setattr(store.cells, "commit", lambda *args: (_ for _ in ()).throw(RuntimeError("died")))
        with pytest.raises(RuntimeError, match="died"):
            store.apply(frame(spark, b), 1)
    assert stored(RangeStore(spark, f"{tmp_path}/s", width=64)) == exclusive_brute(a)
    store.vacuum()
    assert store.apply(frame(spark, b), 1)
    assert stored(store) == exclusive_brute(a + b)
    store.vacuum()
    assert stored(store) == exclusive_brute(a + b)


def test_invalid_null_and_empty_batches(spark, tmp_path):
    store = RangeStore(spark, f"{tmp_path}/s", width=64)
    rows = [(None, 1, 5), (None, 3, 9), (0, 9, 2), (0, None, 4), (0, 4, 4)]
    assert store.apply(frame(spark, rows), 0)
    assert store.apply(frame(spark, []), 1) and not store.apply(frame(spark, rows), 1)
    assert sorted(map(tuple, store.exclusive_ranges().collect()), key=repr) == sorted([(None, 1, 2), (None, 6, 9), (0, 4, 4)], key=repr)
    one = RangeStore(spark, f"{tmp_path}/one", width=64, keys="")
    assert one.exclusive_ranges().count() == 0
    one.apply(frame(spark, rows).drop("set_id"), 0)
    assert sorted(map(tuple, one.exclusive_ranges().collect())) == [(1, 2), (6, 9)]


def test_a_stream_of_lines(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "1.txt").write_text("1.0.0.0, 1.0.0.9\nbad\n1.0.0.5, 1.0.0.20\n")
    (src / "2.txt").write_text("1.0.0.3, 1.0.0.6\n")
    store = RangeStore(spark, f"{tmp_path}/s", width=8)
    body = foreach_batch_updater(store, lambda df: df.withColumn("set_id", F.lit(4).cast("bigint")))
    q = spark.readStream.option("maxFilesPerTrigger", 1).text(str(src)).writeStream.foreachBatch(body)
    q.option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start().awaitTermination(120)
    base = 16777216
    assert stored(store) == exclusive_brute([(4, base, base + 9), (4, base + 5, base + 20), (4, base + 3, base + 6)])


# the committed table by itself


def test_two_writers_at_once(spark, tmp_path):
    table = CommittedTable(spark, f"{tmp_path}/t", "begin bigint, set_id int")
    rows = lambda n: spark.range(n).selectExpr("id as begin", "5 as set_id")
    seen = table.state()
    table.commit(seen, table.stage(rows(3), "set_id"), ["set_id=5"])
    with pytest.raises(CommitConflict):
        table.commit(seen, table.stage(rows(9), "set_id"), ["set_id=5"])
    assert table.read().count() == 3
    table.replace(rows(0), "set_id", 5, "sets", 2)
    assert table.read().count() == 0 and table.taken("sets", 2) and not table.taken("sets", 3)
    with pytest.raises(ValueError, match="given for"):
        table.replace(rows(2), "set_id", 6)


def test_readers_keep_the_state_they_opened(spark, tmp_path):
    table = CommittedTable(spark, f"{tmp_path}/t", "begin bigint, set_id int")
    table.replace(spark.range(4).selectExpr("id as begin", "1 as set_id"), "set_id", 1)
    old = table.read()
    table.replace(spark.range(9).selectExpr("id as begin", "1 as set_id"), "set_id", 1)
    assert old.count() == 4 and table.read().count() == 9
    assert len(table.vacuum()) == 1 and table.read().count() == 9
