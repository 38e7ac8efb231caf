"""Endpoint events, per-point totals and coverage depth (S2.D1, D2, F1-F3, F5, G6).

Two event forms are used:

* closed form (``endpoint_events``): ``(begin, starts=1, ends=0)`` and
  ``(end, starts=0, ends=-1)``, the end still belonging to the range;
* half-open form (``half_open_events``): ``+1`` at ``begin`` and ``-1`` at
  ``end + 1``.  The running sum of the half-open deltas is the number of ranges
  covering ``[x, next_x - 1]``; every coverage computation uses it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from solospan.functions.checks import refuse
from solospan.plans.scan import ordered_scan, point_scan, scan_plan
from solospan.schema import as_keys


def _one(v: int):
    return F.lit(v).cast("bigint")


def endpoint_events(df: DataFrame, keys=("set_id",), begin: str = "begin", end: str = "end") -> DataFrame:
    """Two rows per range: ``keys, point, starts, ends`` (closed form)."""
    keys = as_keys(keys)
    ev = F.array(
        F.struct(F.col(begin).alias("point"), _one(1).alias("starts"), _one(0).alias("ends")),
        F.struct(F.col(end).alias("point"), _one(0).alias("starts"), _one(-1).alias("ends")),
    )
    return df.select(*keys, F.inline(ev))


def endpoint_totals(df: DataFrame, keys=("set_id",), begin: str = "begin", end: str = "end") -> DataFrame:
    """Per point: number of ranges beginning there and minus the number ending
    there (partial + final hash aggregate)."""
    keys = as_keys(keys)
    return (
        endpoint_events(df, keys, begin, end)
        .groupBy(*keys, "point")
        .agg(F.sum("starts").alias("starts"), F.sum("ends").alias("ends"))
    )


def valid_ranges(df: DataFrame, begin: str = "begin", end: str = "end", on_invalid: str = "drop") -> DataFrame:
    """``df`` without the ranges that cover no point, or failing the job on one with ``on_invalid="raise"``."""
    b, e = F.col(begin).cast("bigint"), F.col(end).cast("bigint")
    if on_invalid == "raise":
        shown = [F.coalesce(c.cast("string"), F.lit("NULL")) for c in (b, e)]
        return refuse(df, F.coalesce(b > e, F.lit(True)), F.concat(F.lit("Invalid range: "), shown[0], F.lit(", "), shown[1]))
    if on_invalid == "drop":
        return df.where(b.isNotNull() & e.isNotNull() & (b <= e))
    raise ValueError(f"unknown on_invalid {on_invalid!r}")


def half_open_events(
    df: DataFrame, keys=("set_id",), begin: str = "begin", end: str = "end", valid_only: bool = False, on_invalid: str = "drop"
) -> DataFrame:
    """Raw (not aggregated) half-open events ``keys, x, starts, ends, delta``
    where ``ends`` is -1 at ``end + 1`` (coordinates as BIGINT).

    ``valid_only`` leaves out ranges that cover no point (NULL bound or
    ``begin > end``; ``invalid_ranges`` lists them), or fails the job on one
    with ``on_invalid="raise"``; the audits keep them on purpose."""
    keys = as_keys(keys)
    b, e = F.col(begin).cast("bigint"), F.col(end).cast("bigint")
    if valid_only:
        df = valid_ranges(df, begin, end, on_invalid)
    ev = F.array(
        F.struct(b.alias("x"), _one(1).alias("starts"), _one(0).alias("ends")),
        F.struct((e + 1).alias("x"), _one(0).alias("starts"), _one(-1).alias("ends")),
    )
    return df.select(*keys, F.inline(ev)).withColumn("delta", F.col("starts") + F.col("ends"))


def invalid_ranges(df: DataFrame, begin: str = "begin", end: str = "end") -> DataFrame:
    """The rows of ``df`` that cover no point, with the ``reason`` (``null bound`` or ``reversed``)."""
    b, e = F.col(begin), F.col(end)
    reason = F.when(b.isNull() | e.isNull(), "null bound").when(b > e, "reversed")
    return df.withColumn("reason", reason).where(F.col("reason").isNotNull())


def point_deltas(df: DataFrame, keys=("set_id",), begin: str = "begin", end: str = "end") -> DataFrame:
    """Half-open events summed per coordinate: ``keys, x, starts, ends, delta``.
    Coordinates whose deltas cancel are kept (they separate touching ranges)."""
    keys = as_keys(keys)
    return (
        half_open_events(df, keys, begin, end)
        .groupBy(*keys, "x")
        .agg(F.sum("starts").alias("starts"), F.sum("ends").alias("ends"))
        .withColumn("delta", F.col("starts") + F.col("ends"))
    )


def levels(
    df: DataFrame,
    keys=("set_id",),
    begin: str = "begin",
    end: str = "end",
    strategy: str = "auto",
    target_rows: int | None = None,
    n_rows: int | None = None,
    values: tuple[str, ...] = ("starts", "ends", "delta"),
    on_invalid: str = "drop",
) -> DataFrame:
    """``keys, x, <values>, level, next_x`` (``values`` summed per coordinate;
    none for just the levels, the cheapest form): ``level`` ranges cover
    every point of ``[x, next_x - 1]``; ``next_x`` is NULL after the last
    coordinate of a group (where the level is 0).  Ranges with a NULL bound
    or ``begin > end`` cover no point and are left out, or refused with
    ``on_invalid="raise"``."""
    keys = as_keys(keys)
    plan = None
    raw = half_open_events(df, keys, begin, end, valid_only=True, on_invalid=on_invalid)
    if strategy != "window":
        if n_rows is None:
            n_rows = 2 * df.count()
        plan = scan_plan(raw, keys, "x", strategy, n_rows=n_rows, target_rows=target_rows)
    # only what the caller reads is shuffled; with no values the rows are not
    # aggregated per coordinate at all (see point_scan)
    values = list(dict.fromkeys([*values, "delta"])) if values else []
    return point_scan(raw.select(*keys, "x", "delta", *[v for v in values if v != "delta"]), keys, "x", values, "delta", plan)


def coverage_depth(df: DataFrame, keys=("set_id",), begin: str = "begin", end: str = "end", **kw) -> DataFrame:
    """Piecewise-constant coverage: ``keys, point, depth, next_point``; the row
    holds for ``[point, next_point - 1]`` (gaps have depth 0)."""
    keys = as_keys(keys)
    lv = levels(df, keys, begin, end, values=(), **kw)
    return lv.select(
        *keys, F.col("x").alias("point"), F.col("level").alias("depth"), F.col("next_x").alias("next_point")
    )


def open_ranges(df: DataFrame, keys=("set_id",), begin: str = "begin", end: str = "end", **kw) -> DataFrame:
    """At every point where some range begins: ``n_starting`` ranges begin
    there and ``n_open`` ranges (including those) contain the point."""
    keys = as_keys(keys)
    lv = levels(df, keys, begin, end, values=("starts",), **kw)
    return lv.where(F.col("starts") > 0).select(
        *keys, F.col("x").alias("point"), F.col("starts").alias("n_starting"), F.col("level").alias("n_open")
    )


def end_counts(df: DataFrame, keys=("set_id",), end: str = "end") -> DataFrame:
    """Number of ranges ending at each point (duplicates counted)."""
    keys = as_keys(keys)
    return df.groupBy(*keys, F.col(end).alias("point")).agg(F.count(F.lit(1)).alias("n_ends"))


def ends_by_begin(df: DataFrame, keys=("set_id",), begin: str = "begin", end: str = "end") -> DataFrame:
    """The ends of the ranges sharing a begin, one row per distinct end with
    its multiplicity (a list per begin, kept flat so no group is collected)."""
    keys = as_keys(keys)
    return df.groupBy(*keys, F.col(begin).alias("begin"), F.col(end).alias("end")).agg(
        F.count(F.lit(1)).alias("n")
    )


def begin_counts(df: DataFrame, keys=("set_id",), begin: str = "begin", end: str = "end") -> DataFrame:
    """Per begin point: number of ranges beginning there and their end span."""
    keys = as_keys(keys)
    return df.groupBy(*keys, F.col(begin).alias("begin")).agg(
        F.count(F.lit(1)).alias("n_ranges"), F.min(end).alias("min_end"), F.max(end).alias("max_end")
    )


def consecutive_runs(
    df: DataFrame, seq: str, key: str, keys=("set_id",), strategy: str = "auto", target_rows: int | None = None, n_rows: int | None = None
) -> DataFrame:
    """Runs of rows with an equal ``key`` one after the other by ``seq`` (unique
    in a group): ``keys, run, <key>, length, first_<seq>, last_<seq>``, runs
    numbered from 1.  The same key further on is another run; NULL is a key.

    A run is its first and its last row; the second scan sees only those."""
    keys = as_keys(keys)
    rows = df.select(*keys, F.col(seq).alias("_seq"), F.col(key).alias("_key"), _one(1).alias("_one"))
    plan = scan_plan(rows, keys, "_seq", strategy, n_rows=n_rows, target_rows=target_rows)
    near = ordered_scan(rows, keys, ["_seq"], {"_at": "_one"}, {"_next": "_key", "_behind": "_one"}, plan, {"_last": "_key", "_before": "_one"})
    starts = F.col("_before").isNull() | ~F.col("_key").eqNullSafe(F.col("_last"))
    ends = F.col("_behind").isNull() | ~F.col("_key").eqNullSafe(F.col("_next"))
    bounds = near.select(*keys, "_seq", "_key", "_at", starts.cast("bigint").alias("_starts"), ends.alias("_ends")).where("_starts = 1 or _ends")
    paired = ordered_scan(bounds, keys, ["_seq"], {"_run": "_starts"}, {"_end_seq": "_seq", "_end_at": "_at"}, plan).where("_starts = 1")
    end = lambda one, other: F.when(F.col("_ends"), F.col(one)).otherwise(F.col(other))
    return paired.select(
        *keys,
        F.col("_run").alias("run"),
        F.col("_key").alias(key),
        (end("_at", "_end_at") - F.col("_at") + 1).alias("length"),
        F.col("_seq").alias(f"first_{seq}"),
        end("_seq", "_end_seq").alias(f"last_{seq}"),
    )
