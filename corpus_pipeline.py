"""The training-data pipeline: quality, near duplicates, personal data, mixing, packing.

``STAGES`` are applied in order; each takes (spark, docs, sf_dir) and returns a
DataFrame, which is written as Parquet and read again as the next one's docs.
All stages but the last return the columns of ``documents``, further columns
of any name included.

Nulls, empty tables and odd rows: a null text is judged, linked and packed as an
empty one and stays null; all empty texts are one near-duplicate group; repeated
rows are one document to the second stage and each for itself to the others;
rows with a null id or source are kept like any other; an empty table gives an
empty result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from solospan.llm.common import read_table, remove_folder, shared_folder
from solospan.llm.op2_pii import redact
from solospan.llm.op4_simhash import drop_near_duplicates
from solospan.llm.op5_mixing import mixed_documents
from solospan.llm.op6_quality import keep_quality
from solospan.llm.op9_packing import pack_documents


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return keep_quality(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return drop_near_duplicates(docs, shingle_words=3, max_distance=2)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    return redact(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents appear as often as the mix takes them; one at the end of a quota may be cut."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the remaining documents and their places in the sequences."""
    # the workers serve all stages: small caches that go with the task, the same result
    return pack_documents(docs, capacity=2048, cached=(150_000, 150_000), kept=False)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixing", mixing),
    ("packing", packing),
]

#: The models and the tokenizer cannot be expressed in SQL; tests/llm checks the stages one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each one's result is written to the shared checkpoint folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    packed = STAGES[-1][1](spark, docs, sf_dir)
    remove_folder(spark, folder)  # the last stage has read its documents: its pieces are checkpointed
    return packed
