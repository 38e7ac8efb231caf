"""Publishing again, empty inputs and stores."""

import pytest

from solospan import app
from solospan.streaming.publish import foreach_batch_publisher, publish

RANGES = "begin bigint, end bigint"


def stored(spark, table):
    return sorted(map(tuple, spark.read.schema("begin bigint, end bigint, set_id int").parquet(table).select("set_id", "begin", "end").collect()))


def test_an_empty_result_replaces_the_old_one(spark, tmp_path):
    sinks = dict(input_sink=f"{tmp_path}/in", output_sink=f"{tmp_path}/out", documents=f"{tmp_path}/docs")
    publish(spark.createDataFrame([(1, 5)], RANGES), 1, **sinks)
    assert stored(spark, f"{tmp_path}/out") == [(1, 1, 5)]
    publish(spark.createDataFrame([(1, 5), (1, 5)], RANGES), 1, **sinks)
    assert stored(spark, f"{tmp_path}/out") == []
    assert stored(spark, f"{tmp_path}/in") == [(1, 1, 5), (1, 1, 5)]


def test_a_replayed_epoch_leaves_one_document(spark, tmp_path):
    body = foreach_batch_publisher(3, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/docs")
    for _ in range(2):
        body(spark.createDataFrame([("1.2.3.4,1.2.3.9",)], "value string"), 0)
    assert spark.read.json(f"{tmp_path}/docs").count() == 1
    body(spark.createDataFrame([], "value string"), 1)  # an empty batch is a set without rows
    assert len(stored(spark, f"{tmp_path}/in")) == 1


def test_clean_and_empty_files(spark, tmp_path):
    (tmp_path / "clean.txt").write_text("1.2.3.4, 1.2.3.9\n")
    (tmp_path / "bad.txt").write_text("garbage\n")
    (tmp_path / "empty.txt").write_text("")
    tables = str(tmp_path / "tables")
    ids = app.run(spark, [f"{tmp_path}/{n}.txt" for n in ("clean", "bad", "empty")], tables, listing=f"{tmp_path}/listing")
    assert ids == [1, 2, 3]
    assert len(stored(spark, f"{tables}/output")) == 1
    assert app.first_free_set_id(spark, f"{tables}/input") == 4
    lines = spark.read.text(f"{tmp_path}/listing").collect()
    assert [(r.set_id, r.value) for r in lines] == [(1, "1\t1.2.3.4, 1.2.3.9")]


def test_a_store_that_cannot_be_read_is_an_error(spark):
    with pytest.raises(Exception):
        app.first_free_set_id(spark, "nosuchscheme://store/input")
