"""The pipeline on a small table, stage by stage."""

import corpus_pipeline
import __spark_entry__


def test_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, n = docs.columns, docs.count()
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "personal_data", "mixing", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns == columns
        if name != "mixing":
            assert 0 < docs.count() <= n
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf).toPandas()
    assert packed.groupby("sequence_id").length.sum().max() <= 2048


def test_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(k.startswith(f"op{i}_") for k in names) for i in range(1, 11))
