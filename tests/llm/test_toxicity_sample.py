"""The bounded training sample of the toxicity classifier."""

from solospan.llm import op10_toxicity


def tables(spark, texts, labels):
    return spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_labels_without_a_document_take_no_place(spark):
    texts = [(i, f"{'vile' if i % 2 else 'kind'} words number n{i}") for i in range(200)]
    labels = [(i, i % 2) for i in range(200)] + [(i, 0) for i in range(1000, 9000)]
    out = op10_toxicity.toxicity_scores(*tables(spark, texts, labels), sample_rows=100).collect()
    assert all(r.predicted == r.doc_id % 2 for r in out)


def test_repeats_count_but_take_one_place(spark):
    texts = [(1, "a b"), (2, "c d"), (2, None)] + [(3, "e f")] * 500
    labels = [(1, 0)] * 700 + [(2, 1), (3, 1), (3, 1), (3, 0)]
    sample = lambda n: op10_toxicity.training_sample(*tables(spark, texts, labels), 5, 9, n)
    rows = sorted((r.text or "", r.y, r.n) for r in sample(50).collect())
    assert rows == [("", 1, 1), ("a b", 0, 700), ("c d", 1, 1), ("e f", 0, 500), ("e f", 1, 1000)]
    assert sample(2).count() == 2
