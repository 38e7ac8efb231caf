"""Registered queries of the training-data operators, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from solospan.llm.common import read_table
from solospan.llm.op1_license import document_paths, scan_licences
from solospan.llm.op10_toxicity import toxicity_scores
from solospan.llm.op11_runs import planted_run_digests
from solospan.llm.op12_repair import damaged, repair_digests
from solospan.llm.op13_tokens import token_counts
from solospan.llm.op2_pii import find_pii
from solospan.llm.op3_topk import exact_top_k
from solospan.llm.op4_simhash import simhash_components
from solospan.llm.op5_mixing import mix_sources
from solospan.llm.op6_quality import quality_scores
from solospan.llm.op7_lm import lm_scores
from solospan.llm.op8_ann import nearest
from solospan.llm.op9_packing import pack_documents


def op1_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licences(document_paths(read_table(spark, sf_dir, "documents")))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(read_table(spark, sf_dir, "documents"))


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top_k(read_table(spark, sf_dir, "embeddings"), k=10, query_modulus=100)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(read_table(spark, sf_dir, "documents"), shingle_words=3, max_distance=2)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(read_table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op7_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(read_table(spark, sf_dir, "documents"))


def op8_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read_table(spark, sf_dir, "embeddings"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"), capacity=2048)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return planted_run_digests(read_table(spark, sf_dir, "documents"))


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_digests(damaged(read_table(spark, sf_dir, "conversations")))


def op13_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read_table(spark, sf_dir, "documents"), limit=4096)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license": op1_license,
    "op2_pii": op2_pii,
    "op3_topk": op3_topk,
    "op4_simhash": op4_simhash,
    "op5_mixing": op5_mixing,
    "op6_quality": op6_quality,
    "op7_lm": op7_lm,
    "op8_ann": op8_ann,
    "op9_packing": op9_packing,
    "op10_toxicity": op10_toxicity,
    "op11_runs": op11_runs,
    "op12_repair": op12_repair,
    "op13_tokens": op13_tokens,
}
ORACLE: dict[str, str] = {
    "op3_topk": """
        with rows as (
            select vec_id, list_transform(embedding, lambda c: cast(floor(1024 * cast(c as double)) as bigint)) as v
            from embeddings
            where embedding is not null and len(embedding) = list_count(embedding)
              and len(list_filter(embedding, lambda c: not isfinite(c))) = 0
        ), scored as (
            select q.vec_id as query_id, d.vec_id,
                   cast(list_sum(list_transform(list_zip(q.v, d.v), lambda p: p[1] * p[2])) as bigint) as score
            from rows q join rows d on q.vec_id % 100 = 0 and d.vec_id <> q.vec_id
        ), ranked as (
            select query_id, vec_id, score,
                   cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank
            from scored
        )
        select query_id, rank, vec_id, score from ranked where rank <= 10
    """,
}
