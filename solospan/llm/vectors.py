"""Vectors as rows of packed doubles."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from solospan.llm.common import map_batches


def valid_vectors(table: DataFrame, vector: str = "embedding") -> DataFrame:
    """vec_id and ``x`` (array of doubles) of the vectors that take part.

    Those are neither null nor empty, hold no null or non-finite component, and
    have the table's most frequent length (the smaller of two that tie): vectors
    of other lengths have no product with them.  A null vec_id takes no part.
    """
    x = F.col(vector).cast("array<double>")
    sound = F.size(x).between(1, 1 << 30) & ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = table.where(F.col("vec_id").isNotNull() & F.col(vector).isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")).where(sound)
    sizes = rows.groupBy(F.size("x").alias("n")).count().orderBy(F.col("count").desc(), "n").limit(1).collect()
    return rows.where(F.size("x") == (sizes[0].n if sizes else 0))


def packed(rows: DataFrame) -> DataFrame:
    """(vec_id, v): the doubles of ``x`` as bytes."""

    def f(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = matrix(batch.column(1))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in x], pa.binary())], ["vec_id", "v"])

    return map_batches(rows.select("vec_id", "x"), f, "vec_id long, v binary")


def matrix(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def unpacked(values: object) -> np.ndarray:
    """Packed vectors as a matrix."""
    rows = list(values)
    return np.frombuffer(b"".join(rows), np.float64).reshape(len(rows), -1)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id, best first."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        place = np.flatnonzero(scores >= least)
    else:
        place = np.arange(len(scores))
    return place[np.lexsort((ids[place], -scores[place]))][:k]
