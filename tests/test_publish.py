import os
import time

from pyspark.sql import functions as F

from solospan.streaming.publish import foreach_batch_publisher, publish
from solospan.sources.text import ranges_from_pairs

PAIRS = [
    ("197.203.0.0", "197.206.9.255"),
    ("197.204.0.0", "197.204.0.24"),
    ("201.233.7.160", "201.233.7.168"),
    ("201.233.7.164", "201.233.7.168"),
    ("201.233.7.167", "201.233.7.167"),
    ("203.133.0.0", "203.133.255.255"),
]


def test_publish_writes_input_then_checked_output(spark, tmp_path):
    inp, out, docs = str(tmp_path / "input"), str(tmp_path / "output"), str(tmp_path / "docs")
    res = publish(ranges_from_pairs(spark, PAIRS), 7, input_sink=inp, output_sink=out, documents=docs, target_rows=2)
    assert res.count() == 4
    assert spark.read.parquet(inp).where("set_id = 7").count() == 6
    assert spark.read.parquet(out).where("set_id = 7").count() == 4
    d = spark.read.json(docs).orderBy("begin").first()
    assert (d["begin"], d["end"]) == ("197.203.0.0", "197.203.255.255")
    # publishing the same set again replaces it (idempotent micro-batches)
    publish(ranges_from_pairs(spark, PAIRS), 7, input_sink=inp, output_sink=out)
    assert spark.read.parquet(out).where("set_id = 7").count() == 4


def test_publish_without_table_sink_uses_checkpoint(spark):
    res = publish(ranges_from_pairs(spark, PAIRS), 1)
    assert res.count() == 4


def test_foreach_batch_stream_of_text_files(spark, tmp_path):
    src = tmp_path / "lines"
    src.mkdir()
    (src / "a.txt").write_text("\n".join(f"{a}, {b}" for a, b in PAIRS) + "\nnot a range\n")
    out = str(tmp_path / "out")
    q = (
        spark.readStream.text(str(src))
        .writeStream.foreachBatch(foreach_batch_publisher(100, output_sink=out))
        .option("checkpointLocation", str(tmp_path / "ckpt"))
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination(120)
    got = spark.read.parquet(out)
    assert got.where("set_id = 100").count() == 4


def test_each_micro_batch_is_one_set(spark, tmp_path):
    from solospan.streaming.publish import range_line_stream

    src = tmp_path / "in"
    src.mkdir()
    (src / "1.txt").write_text("1.0.0.0, 1.0.0.9\n1.0.0.5, 1.0.0.20\n")
    (src / "2.txt").write_text("2.0.0.0, 2.0.0.3\nbad\n")
    out, rej = str(tmp_path / "out"), str(tmp_path / "rejects")

    def body(batch, epoch):
        batch.persist()
        batch.where("reason is not null").select("line", "reason").write.mode("append").json(rej)
        publish(batch.where("reason is null").select("begin", "end"), 10 + epoch, output_sink=out, verify=False)
        batch.unpersist()

    q = (
        range_line_stream(spark, str(src), max_files_per_trigger=1)
        .writeStream.foreachBatch(body)
        .option("checkpointLocation", str(tmp_path / "ck"))
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination(120)
    got = sorted((r.set_id, r.begin, r.end) for r in spark.read.parquet(out).collect())
    assert [g[0] for g in got] == [10, 10, 11]
    assert [(r.line, r.reason) for r in spark.read.json(rej).collect()] == [("bad", "malformed")]
