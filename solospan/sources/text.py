"""Range sources: text lines, text pairs, empty (S2.A1, A2, A9, B1, C1, C2).

Text record: ``begin, end`` as dotted quads separated by a comma, blanks
allowed around each address.  Trailing empty fields are ignored (``a,b,,``).
Lines that do not parse are ``malformed``; ``begin > end`` is ``reversed``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from solospan.functions.ipv4 import with_ip4
from solospan.schema import PAIRS_SCHEMA, RANGES_SCHEMA, REJECT_MALFORMED, REJECT_REVERSED


def parse_range_lines(df: DataFrame, line: str = "line") -> DataFrame:
    """Add ``begin``, ``end`` (NULL when malformed) and ``reason`` (NULL when
    the range is good) to a DataFrame of text lines."""
    fields = F.split(F.regexp_replace(F.col(line), r",+\z", ""), ",", -1)
    two = df.select("*", fields.alias("_fields")).select(
        *df.columns,
        F.when(F.size("_fields") == 2, F.try_element_at("_fields", F.lit(1))).alias("_bt"),
        F.when(F.size("_fields") == 2, F.try_element_at("_fields", F.lit(2))).alias("_et"),
    )
    parsed = with_ip4(two, {"_b": "_bt", "_e": "_et"})
    bad = F.col("_b").isNull() | F.col("_e").isNull()
    reason = F.when(bad, F.lit(REJECT_MALFORMED)).when(F.col("_b") > F.col("_e"), F.lit(REJECT_REVERSED))
    return parsed.select(
        *df.columns,
        F.when(~bad, F.col("_b")).alias("begin"),
        F.when(~bad, F.col("_e")).alias("end"),
        reason.alias("reason"),
    )


def _split_rows(parsed: DataFrame, ok, cols: list[str]) -> DataFrame:
    # A generator instead of a filter: a Filter would be pushed through the
    # parse projections with every parsed column inlined into its condition
    # (many copies of the address expression, too big for codegen).  The
    # array is NULL for rows that are not wanted, and inline emits nothing.
    return parsed.select(F.inline(F.when(ok, F.array(F.struct(*[F.col(c) for c in cols])))))


def good_ranges(parsed: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """Well-formed, ordered ranges of a parsed DataFrame."""
    return _split_rows(parsed, F.col("reason").isNull(), [*keep, "begin", "end"])


def parsed_ranges(parsed: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """All ranges that parse, reversed ones included (for order audits)."""
    return _split_rows(parsed, F.col("begin").isNotNull(), [*keep, "begin", "end"])


def rejected_lines(parsed: DataFrame, keep: Iterable[str] = (), line: str = "line") -> DataFrame:
    """``keep..., line, reason`` for malformed and reversed lines."""
    return _split_rows(parsed, F.col("reason").isNotNull(), [*keep, line, "reason"])


def read_range_text(
    spark: SparkSession, path: str, set_id: int | None = None, strict: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Text file(s) of ranges -> ``(ranges, rejects)``; ``set_id`` attaches a
    set number to the good ranges.  ``strict=True`` fails the job that reads
    the ranges on the first reversed line (malformed lines are still only
    rejected)."""
    parsed = parse_range_lines(spark.read.text(path).withColumnRenamed("value", "line"))
    if strict:
        msg = F.concat(F.lit("Reversed range: "), F.col("line"))
        ok = F.when(F.col("reason") == REJECT_REVERSED, F.raise_error(msg).cast("boolean")).otherwise(F.col("reason").isNull())
        ranges = _split_rows(parsed, ok, ["begin", "end"])
    else:
        ranges = good_ranges(parsed)
    if set_id is not None:
        ranges = ranges.select(F.lit(set_id).alias("set_id"), "begin", "end")
    return ranges, rejected_lines(parsed)


def ranges_from_pairs(
    spark: SparkSession, pairs: Iterable[tuple[str, str]], on_error: str = "raise"
) -> DataFrame:
    """Collection of ``(begin_text, end_text)`` -> ranges ``begin, end``.

    ``on_error="raise"`` fails the job on the first pair that does not parse
    (``Wrong input range: (a, b)``); ``"drop"`` keeps only good pairs.  Pairs
    are not checked for order (as the collection source of the reference);
    use ``interval_order_violations`` for that."""
    df = spark.createDataFrame(list(pairs), PAIRS_SCHEMA)
    return ranges_from_pair_columns(df, on_error=on_error)


def ranges_from_pair_columns(
    df: DataFrame, begin_text: str = "begin_text", end_text: str = "end_text", on_error: str = "raise"
) -> DataFrame:
    parsed = with_ip4(df.select(begin_text, end_text), {"begin": begin_text, "end": end_text})
    ok = F.col("begin").isNotNull() & F.col("end").isNotNull()
    if on_error == "raise":
        msg = F.concat(F.lit("Wrong input range: ("), F.col(begin_text), F.lit(","), F.col(end_text), F.lit(")"))
        return _split_rows(parsed, F.when(ok, F.lit(True)).otherwise(F.raise_error(msg).cast("boolean")), ["begin", "end"])
    if on_error == "drop":
        return _split_rows(parsed, ok, ["begin", "end"])
    raise ValueError(f"unknown on_error {on_error!r}")


def empty_ranges(spark: SparkSession) -> DataFrame:
    """An empty range table with the shared schema."""
    return spark.createDataFrame([], RANGES_SCHEMA)
