"""Bucket arithmetic on integer coordinates (native expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bucket width used for IPv4 by default: 2**28, i.e. 16 buckets over the
# address space (fixed value).
IP4_BUCKET_WIDTH = 268435456


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def idiv(x, w) -> Column:
    """Integral division (Spark ``div``, truncates toward zero), BIGINT."""
    w = w if isinstance(w, Column) else F.lit(w)
    return F.call_function("div", _col(x), w)


def floor_div(x, w) -> Column:
    """floor(x / w) for w > 0 in exact integer arithmetic (also for x < 0)."""
    x = _col(x)
    w = w if isinstance(w, Column) else F.lit(w)
    return idiv(x - F.pmod(x, w), w)


def bucket_of(c, width: int = IP4_BUCKET_WIDTH) -> Column:
    """Bucket number of a coordinate: floor(x / width)."""
    if width <= 0:
        raise ValueError("bucket width must be positive")
    return floor_div(c, width)


def junctions(bucket, width: int = IP4_BUCKET_WIDTH) -> tuple[Column, Column]:
    """The two coordinates on both sides of the lower edge of ``bucket``:
    (bucket*width - 1, bucket*width)."""
    b = _col(bucket)
    return b * width - 1, b * width
