"""Exclusive ranges: for each input range, the maximal sub-ranges that no
other range of the same set touches (S2.D3, D4, D8).

Formulation: along the begins, let ``far`` be the largest end so far and
``second`` the second largest.  From a begin to just before the next one no
range begins, so the points up to ``second`` are in two ranges or more, those
behind it up to ``far`` in exactly one, and those behind ``far`` in none.  Each
distinct begin gives at most one result, ``[max(begin, second + 1), min(far,
next begin - 1)]``.  Duplicates cancel, touching results stay separate, and
single points are ordinary ranges.  Only the ranges themselves are shuffled and
sorted, one row each, and what a scan carries is two numbers a set, however many
ranges are open.

Plans (``strategy``):

* ``window``   one window per set (the sort of a set is one task);
* ``bucketed`` / ``auto`` sets above the per-task row target are range
  partitioned and swept with the two ends carried (see ``solospan.plans.scan``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from solospan.operators.events import levels, valid_ranges
from solospan.plans.scan import bounded, ordered_scan, scan_plan
from solospan.plans.sweep import carried, check_files, sweep
from solospan.schema import as_keys
from solospan.session import ensure_checkpoint_dir

TOPS = {("_far", "_second"): "_e"}
LEADS = {"_next": "_b"}


def _results(scanned: DataFrame, keys: list[str], begin: str, end: str) -> DataFrame:
    """The result that each begin gives, if any, from the scanned ranges."""
    alone = F.col("_second").isNull() | (F.col("_second") < F.col("_far"))
    low = F.greatest("_b", F.when(F.col("_second") < F.col("_far"), F.col("_second") + 1))
    high = F.when(F.col("_next") <= F.col("_far"), F.col("_next") - 1).otherwise(F.col("_far"))
    out = scanned.select(*keys, alone.alias("_alone"), low.alias(begin), high.alias(end))
    return out.where(F.col("_alone") & (F.col(begin) <= F.col(end))).drop("_alone")


def _ranges(df: DataFrame, keys: list[str], begin: str, end: str, on_invalid: str = "drop", seq: str | None = None) -> DataFrame:
    named = [F.col(begin).cast("bigint").alias("_b"), F.col(end).cast("bigint").alias("_e")]
    return valid_ranges(df, begin, end, on_invalid).select(*keys, *named, *([F.col(seq).alias("_seq")] if seq else []))


def exclusive_ranges(
    df: DataFrame,
    keys=("set_id",),
    begin: str = "begin",
    end: str = "end",
    strategy: str = "auto",
    target_rows: int | None = None,
    on_invalid: str = "drop",
) -> DataFrame:
    """``keys, begin, end`` of the parts covered by exactly one input range.

    Ranges with a NULL bound or ``begin > end`` cover no point; they are left
    out (``events.invalid_ranges`` lists them) or, with ``on_invalid="raise"``,
    fail the job."""
    keys = as_keys(keys)
    n_rows = None if strategy == "window" else df.count()
    rows = _ranges(df, keys, begin, end, on_invalid)
    plan = scan_plan(rows, keys, ["_b", "_e"], strategy, n_rows=n_rows, target_rows=target_rows)
    if plan is not None and plan.n_hot:
        # of equal ranges two do what all do; counted partly before the shuffle
        counted = rows.groupBy(*keys, "_b", "_e").agg(F.least(F.count(F.lit(1)), F.lit(2)).cast("int").alias("_n"))
        rows = counted.select(*keys, "_b", "_e", F.explode(F.array_repeat(F.lit(0), F.col("_n"))).alias("_copy")).drop("_copy")
    # the order of equal begins is of no matter; in the range plan the ends part them
    scanned = ordered_scan(rows, keys, ["_b"] if plan is None else ["_b", "_e"], leads=LEADS, plan=plan, tops=TOPS)
    out = _results(scanned, keys, begin, end)
    return out if n_rows is None else bounded(out, n_rows)  # a result for each begin at most


def exclusive_ranges_by_level(
    df: DataFrame, keys=("set_id",), begin: str = "begin", end: str = "end", strategy: str = "auto", target_rows: int | None = None
) -> DataFrame:
    """The same result by another formula, for cross-checks: the stretches
    between endpoints at which the running sum of begins and ends is 1."""
    keys = as_keys(keys)
    lv = levels(df, keys, begin, end, strategy=strategy, target_rows=target_rows, values=())
    return lv.where(F.col("level") == 1).select(*keys, F.col("x").alias(begin), (F.col("next_x") - 1).alias(end))


def exclusive_ranges_bucketed(
    df: DataFrame, keys=("set_id",), begin: str = "begin", end: str = "end", target_rows: int | None = None
) -> DataFrame:
    """The distributed plan for few, huge sets (always planned)."""
    return exclusive_ranges(df, keys, begin, end, strategy="bucketed", target_rows=target_rows)


def exclusive_ranges_presorted(
    df: DataFrame,
    seq: str,
    keys=("set_id",),
    begin: str = "begin",
    end: str = "end",
    strategy: str = "auto",
    target_rows: int | None = None,
) -> DataFrame:
    """Exclusive ranges of input declared sorted by ``begin`` along ``seq``
    (unique in a set).

    The declaration is checked by the scan that computes the result: by begin,
    the ``seq`` must grow from row to row.  A row whose ``begin`` is larger than
    that of a later one fails the job with ``Order violation``.  The result
    equals ``exclusive_ranges``."""
    keys = as_keys(keys)
    n_rows = None if strategy == "window" else df.count()
    rows = _ranges(df, keys, begin, end, seq=seq)
    plan = scan_plan(rows, keys, ["_b", "_seq"], strategy, n_rows=n_rows, target_rows=target_rows)
    lags = {"_last_seq": "_seq", "_last_b": "_b"}
    scanned = ordered_scan(rows, keys, ["_b", "_seq"], leads=LEADS, plan=plan, lags=lags, tops=TOPS)
    msg = F.concat(F.lit("Order violation: "), F.col("_b").cast("string"), F.lit(" then "), F.col("_last_b").cast("string"), F.lit(f" by {seq}"))
    # a filter on the result must not keep rows from the check: it stays above a condition that is not deterministic
    checked = scanned.where(F.when(F.col("_last_seq") > F.col("_seq"), F.raise_error(msg).cast("boolean")).otherwise(F.spark_partition_id() >= 0))
    out = _results(checked, keys, begin, end)
    return out if n_rows is None else bounded(out, n_rows)


def write_sorted_ranges(df: DataFrame, path: str, keys=("set_id",), begin: str = "begin", end: str = "end", num_partitions: int | None = None) -> None:
    """Write the valid ranges sorted by (keys, begin, end), each file a stretch of that order, for ``exclusive_ranges_of_sorted``."""
    keys = as_keys(keys)
    n = [num_partitions] if num_partitions else []
    rows = valid_ranges(df, begin, end).select(*keys, F.col(begin).cast("bigint").alias(begin), F.col(end).cast("bigint").alias(end))
    rows.repartitionByRange(*n, *keys, begin, end).sortWithinPartitions(*keys, begin, end).write.parquet(path)


def swept_files(spark: SparkSession, path: str, keys: list[str], begin: str, end: str) -> DataFrame:
    """The sorted files swept one by one, in one scan without a sort or an exchange."""
    where = [F.col("_metadata.file_path"), F.col("_metadata.file_block_start").cast("string")]
    rows = spark.read.parquet(path).select(*keys, F.col(begin).alias("_b"), F.col(end).alias("_e"), F.concat_ws("@", *where).alias("_file"))
    return sweep(rows, keys, {}, LEADS, {}, TOPS, order=["_b", "_e"], segment="_file")


def exclusive_ranges_of_sorted(spark: SparkSession, path: str, keys=("set_id",), begin: str = "begin", end: str = "end") -> DataFrame:
    """Exclusive ranges of a table written by ``write_sorted_ranges``.

    Each file is swept as it lies and takes the two largest ends of its set from
    the files before it: the rows are neither sorted nor exchanged.  The same
    scan checks the order; a row or a file out of order fails the job with
    ``Order violation``.  The sweep is stored in the shared checkpoint folder
    when this is called, since its rows and its edges are both needed."""
    keys = as_keys(keys)
    ensure_checkpoint_dir(spark)
    order = ["_b", "_e"]
    swept = swept_files(spark, path, keys, begin, end).checkpoint()
    check_files(swept, keys, order)
    return _results(carried(swept, keys, order, {}, LEADS, {}, TOPS), keys, begin, end)
