"""JDBC source and sinks for range tables (S2.A4-A6, A10).

Thin option assembly around Spark's own ``jdbc`` format: a partitioned read on
``begin`` so a large table is fetched by many tasks, cursor fetch size, and
appends of input or output ranges.  The schema of both tables is
``solospan.schema.RANGES_SCHEMA``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from solospan.schema import RANGES_SCHEMA

DDL = ", ".join(f"`{f.name}` {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in RANGES_SCHEMA)


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None, **extra) -> dict:
    opts = {"url": url, "dbtable": table, "fetchsize": "10000"}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def read_ranges_jdbc(
    spark: SparkSession,
    options: dict,
    num_partitions: int | None = None,
    lower: int = 0,
    upper: int = 4294967296,
) -> DataFrame:
    """Scan a range table; with ``num_partitions`` the scan is split into
    ``begin`` strides (filters and column pruning are pushed to the database)."""
    reader = spark.read.format("jdbc").options(**options)
    if num_partitions:
        reader = reader.options(
            partitionColumn="begin", lowerBound=str(lower), upperBound=str(upper), numPartitions=str(num_partitions)
        )
    return reader.load()


def append_ranges_jdbc(df: DataFrame, options: dict) -> None:
    """Append ``set_id, begin, end`` rows; creates the table with the shared
    column types when it does not exist."""
    (
        df.select("set_id", "begin", "end")
        .write.mode("append")
        .format("jdbc")
        .options(**options)
        .option("createTableColumnTypes", "set_id INT, begin BIGINT, end BIGINT")
        .save()
    )
