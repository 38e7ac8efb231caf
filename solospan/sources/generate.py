"""Synthetic IPv4 ranges (S2.A3) as a scalable column generator.

Shape of the ranges (fixed values): first octet 1..223, the other three
0..254, length floor(sqrt(u)) with u uniform in [0, 10**16), upper end
clamped to 2**32 - 1.

``mode="random"`` draws with ``rand(seed)`` (repeatable for the same input
partitioning); ``mode="hash"`` derives every draw from the id column with
integer arithmetic only, so a SQL engine can repeat it exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from solospan.functions.ipv4 import IP4_MAX

LENGTH_SPACE = 10**16


def _hash_draw(idc: Column, mult: int, mod: int) -> Column:
    return F.pmod(idc * mult + 12345, F.lit(mod))


def synthetic_ranges(
    df: DataFrame, id_col: str, set_col: str | None = None, mode: str = "hash", seed: int = 42
) -> DataFrame:
    """One range per input row: ``set_id, begin, end`` (``set_id`` from
    ``set_col`` or 0)."""
    idc = F.col(id_col).cast("bigint")
    if mode == "hash":
        a = 1 + _hash_draw(idc, 7, 223)
        b = _hash_draw(idc, 13, 255)
        c = _hash_draw(idc, 17, 255)
        d = _hash_draw(idc, 19, 255)
        u = _hash_draw(idc, 2654435761, LENGTH_SPACE)
    elif mode == "random":
        a = 1 + F.floor(F.rand(seed) * 223)
        b = F.floor(F.rand(seed + 1) * 255)
        c = F.floor(F.rand(seed + 2) * 255)
        d = F.floor(F.rand(seed + 3) * 255)
        u = F.floor(F.rand(seed + 4) * LENGTH_SPACE)
    else:
        raise ValueError(f"unknown mode {mode!r}")
    begin = (a * 16777216 + b * 65536 + c * 256 + d).cast("bigint")
    length = F.floor(F.sqrt(u.cast("double"))).cast("bigint")
    set_id = F.col(set_col) if set_col else F.lit(0).cast("bigint")
    return df.select(
        set_id.alias("set_id"), begin.alias("begin"), F.least(begin + length, F.lit(IP4_MAX)).alias("end")
    )
