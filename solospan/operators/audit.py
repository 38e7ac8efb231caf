"""Data audits as violation tables (S2.C2-C5).

A DataFrame has no order, so every order check names an explicit sequence
column.  Each audit returns the offending rows; ``raise_on`` turns a
violation table into a lazy failure of the job that consumes it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from solospan.operators.events import half_open_events, levels
from solospan.plans.scan import ordered_scan, point_scan, scan_plan
from solospan.schema import as_keys


def order_violations(
    df: DataFrame,
    seq: str,
    key: str,
    keys=("set_id",),
    strategy: str = "auto",
    target_rows: int | None = None,
) -> DataFrame:
    """Rows whose ``key`` is larger than the ``key`` of the next row by ``seq``
    (``seq`` unique within a group): ``keys, seq, key, next_seq, next_key``."""
    keys = as_keys(keys)
    base = df.select(*keys, seq, key) if key != seq else df.select(*keys, seq)
    plan = scan_plan(base, keys, seq, strategy, target_rows=target_rows)
    leads = {f"next_{seq}": seq}
    if key != seq:
        leads[f"next_{key}"] = key
    sc = ordered_scan(base, keys, [seq], leads=leads, plan=plan)
    out = sc.where(F.col(key) > F.col(f"next_{key}"))
    cols = [*keys, seq] + ([key] if key != seq else []) + list(leads)
    return out.select(*cols)


def interval_order_violations(
    df: DataFrame,
    seq: str,
    keys=("set_id",),
    begin: str = "begin",
    end: str = "end",
    strategy: str = "auto",
    target_rows: int | None = None,
) -> DataFrame:
    """``reversed``: begin > end; ``unordered``: begin > begin of the next row
    by ``seq`` (overlap is allowed).  Columns ``keys, seq, begin, end, kind``."""
    keys = as_keys(keys)
    base = df.select(*keys, seq, begin, end)
    plan = scan_plan(base, keys, seq, strategy, target_rows=target_rows)
    sc = ordered_scan(base, keys, [seq], leads={"_next_begin": begin}, plan=plan)
    # one pass flags both kinds; a row can carry both
    kinds = F.array(
        F.when(F.col(begin) > F.col(end), F.lit("reversed")),
        F.when(F.col(begin) > F.col("_next_begin"), F.lit("unordered")),
    )
    flagged = sc.select(*keys, seq, begin, end, F.explode(kinds).alias("kind"))
    return flagged.where(F.col("kind").isNotNull())


def balance_audit(
    df: DataFrame,
    keys=("set_id",),
    begin: str = "begin",
    end: str = "end",
    strategy: str = "auto",
    target_rows: int | None = None,
) -> DataFrame:
    """Sweep invariants per set: ``n_ranges`` begins, ``n_ends`` ends,
    ``n_points`` distinct coordinates, lowest and final coverage level, and
    ``balanced`` (level never below 0 and back to 0 at the end).  A reversed
    range drives the level below 0."""
    keys = as_keys(keys)
    raw = half_open_events(df, keys, begin, end)
    plan = scan_plan(raw, keys, "x", strategy, target_rows=target_rows)
    sc = point_scan(raw, keys, "x", ["starts", "ends", "delta"], "delta", plan)
    agg = sc.groupBy(*keys).agg(
        F.sum("starts").alias("n_ranges"),
        (-F.sum("ends")).alias("n_ends"),
        F.count(F.lit(1)).alias("n_points"),
        F.min("level").alias("min_level"),
        F.sum("delta").alias("final_level"),
    )
    return agg.withColumn("balanced", (F.col("min_level") >= 0) & (F.col("final_level") == 0))


def raise_on(violations: DataFrame, message: Column | str) -> DataFrame:
    """A one-column DataFrame that fails the job (``raise_error``) as soon as
    ``violations`` has a row; union or join it into the guarded result."""
    msg = F.lit(message) if isinstance(message, str) else message
    return violations.select(F.raise_error(msg).alias("_violation"))


def observed_exclusive_ranges(df: DataFrame, keys=("set_id",), begin: str = "begin", end: str = "end", **kw) -> tuple[DataFrame, Observation]:
    """The exclusive ranges and the audit of the same rows, taken as they pass: no second scan.

    The observation has its numbers once some action has run the result to its
    end (a write, say): ``n_ranges`` and ``n_ends``, ``n_points`` distinct
    coordinates, the lowest level and the net change of all sets together
    (``balance_audit`` has them set by set), and ``n_exclusive`` results."""
    keys = as_keys(keys)
    lv = levels(df, keys, begin, end, values=("starts", "ends"), **kw)
    seen = Observation()
    out = lv.observe(
        seen,
        F.coalesce(F.sum("starts"), F.lit(0)).alias("n_ranges"),
        F.coalesce(-F.sum("ends"), F.lit(0)).alias("n_ends"),
        F.count(F.lit(1)).alias("n_points"),
        F.coalesce(F.min("level"), F.lit(0)).alias("min_level"),
        F.coalesce(F.sum("delta"), F.lit(0)).alias("final_level"),
        F.count_if(F.col("level") == 1).alias("n_exclusive"),
    )
    return out.where(F.col("level") == 1).select(*keys, F.col("x").alias(begin), (F.col("next_x") - 1).alias(end)), seen


def observed_intervals(df: DataFrame, begin: str = "begin", end: str = "end") -> tuple[DataFrame, Observation]:
    """``df`` and the counts of its ``reversed`` ranges and ``null`` bounds, taken as the rows pass to whoever reads them."""
    seen = Observation()
    null = F.col(begin).isNull() | F.col(end).isNull()
    return df.observe(seen, F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(begin) > F.col(end)).alias("reversed"), F.count_if(null).alias("null")), seen
