"""Range inputs derived from the driver tables.

Each function reads the given parquet tables and returns ranges
``(set_id, begin, end)`` (plus helper columns); the same rows are written
as SQL in ``solospan.queries`` for the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from solospan.functions.ipv4 import ip4_text


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


SPREAD, ADDRESSES = 2654435761, 3758096384


def spread(key) -> Column:
    """``key * SPREAD % ADDRESSES`` of a key from 0 on, without overflow: reducing the key first leaves the
    remainder as it is, and so does taking ``ADDRESSES`` from the factor, which keeps the product below 2^63."""
    return F.pmod((key % ADDRESSES) * (SPREAD - ADDRESSES), F.lit(ADDRESSES).cast("bigint"))


def grid_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense small domain: duplicates, single points, touching results."""
    o = table(spark, sf_dir, "orders")
    b = (F.col("o_orderkey") * 7919) % 61
    return o.select(
        F.col("o_custkey").alias("set_id"),
        b.alias("begin"),
        (b + F.col("o_orderkey") % 5).alias("end"),
    )


def ip_ranges(spark: SparkSession, sf_dir: str, sets: int | None = 16) -> DataFrame:
    """IPv4-scale ranges from lineitem; ``sets=None`` gives one set (id 0)."""
    li = table(spark, sf_dir, "lineitem")
    b = (spread(F.col("l_orderkey")) + F.col("l_linenumber") * 40503) % ADDRESSES
    set_id = (F.col("l_suppkey") % sets) if sets else F.lit(0).cast("bigint")
    return li.select(
        set_id.alias("set_id"),
        b.alias("begin"),
        (b + F.floor("l_extendedprice").cast("bigint") % 131072).alias("end"),
    )


def skewed_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IPv4 ranges where set 0 holds a third of all rows and, inside it, every
    first line item of an order begins at the same address (a hot point)."""
    li = table(spark, sf_dir, "lineitem")
    b = (spread(F.col("l_orderkey")) + F.col("l_linenumber") * 40503) % ADDRESSES
    hot_set = F.col("l_orderkey") % 3 == 0
    begin = F.when(hot_set & (F.col("l_linenumber") == 1), F.lit(167772160).cast("bigint")).otherwise(b)
    return li.select(
        F.when(hot_set, F.lit(0).cast("bigint")).otherwise(F.col("l_suppkey") % 16 + 1).alias("set_id"),
        begin.alias("begin"),
        (begin + F.floor("l_extendedprice").cast("bigint") % 131072).alias("end"),
    )


def _epoch_seconds(df: DataFrame, ts_col: str):
    """Whole seconds since 1970-01-01 00:00:00.  A timestamp without time
    zone is measured from the same wall-clock epoch (independent of the
    session time zone); a timestamp with time zone is an instant."""
    if isinstance(df.schema[ts_col].dataType, T.TimestampNTZType):
        micros = F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{ts_col}`)")
    else:
        micros = F.unix_micros(F.col(ts_col).cast("timestamp"))
    return F.call_function("div", micros, F.lit(1000000))


def event_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One set per user, seconds since the epoch."""
    ev = table(spark, sf_dir, "events")
    start = _epoch_seconds(ev, "ts")
    return ev.select(
        F.col("event_id"),
        F.col("user_id").alias("set_id"),
        start.alias("begin"),
        (start + F.floor(F.col("value") * 600).cast("bigint")).alias("end"),
    )


def range_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text lines ``(event_id, set_id, line)`` with malformed and reversed
    records mixed in (rules in FIXTURES.md section 3)."""
    ev = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    b = spread(eid)
    coords = ev.select(eid, (F.col("user_id") % 10).alias("set_id"), b.alias("_b")).select(
        "event_id", "set_id", "_b", (F.col("_b") + (eid * 7919) % 1000003).alias("_e")
    )
    texts = coords.select("event_id", "set_id", ip4_text("_b").alias("_sb"), ip4_text("_e").alias("_se"))
    sb, se = F.col("_sb"), F.col("_se")
    line = (
        F.when(eid % 97 == 0, F.concat(sb, F.lit(", 300.1.2.3")))
        .when(eid % 101 == 0, F.lit("garbage"))
        .when(eid % 103 == 0, F.concat(se, F.lit(","), sb))
        .when(eid % 2 == 0, F.concat(sb, F.lit(", "), se))
        .otherwise(F.concat(sb, F.lit(","), se))
    )
    return texts.select("event_id", "set_id", line.alias("line"))
