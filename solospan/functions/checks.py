"""Checks that fail the job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def refuse(df: DataFrame, bad: Column, message: Column) -> DataFrame:
    """``df``, failing the job with ``message`` at a row where ``bad`` holds.

    The error stands in a filter condition: unlike a projected column, it is
    evaluated whatever columns are read afterwards, for a count as well."""
    return df.where(F.when(bad, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
