"""Ordered scans per group: running sums and the neighbouring rows' values.

Every range operator reduces to the same primitive: inside each group
(``keys``, e.g. one set of ranges), ordered by a coordinate, compute

* inclusive running sums of some columns, and
* the values of the next row (``lead``) or the one before (``lag``).

Two physical plans are offered.

``plan=None`` - one window ``partitionBy(keys).orderBy(order)`` after one
shuffle by group.  Right when every group is small; a group is one task.

``RangePlan`` - when some group is too big for one task.  The rows are range
partitioned by (keys, order), which balances the tasks whatever the groups and
however clustered the coordinates; every partition is swept as it lies, and a
piece of a group takes its offset from the pieces before it (see
:mod:`solospan.plans.sweep`).  Rows that agree in all of (keys, order) cannot
be parted; if a sample shows a value so frequent that it would fill a task,
equal rows are combined first, partly before that shuffle.

No rows pass through the driver: planning reads three numbers.  The plan never
changes results.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from solospan.plans.sweep import Tops, carried, sweep
from solospan.session import ensure_checkpoint_dir

# Tunables (session conf keys and defaults).
CONF_TARGET_ROWS = "solospan.scan.targetRows"  # rows one window task should hold at most
DEFAULT_TARGET_ROWS = 2_000_000
SAMPLE_HITS = 64  # expected sample rows for a group of exactly target_rows

_Keys = list[str]


@dataclass
class RangePlan:
    """``partitions`` of the range exchange; number of big groups and of frequent values of ``keys, order`` seen in the sample."""

    partitions: int
    n_big: int = 0
    n_hot: int = 0


def _conf_int(spark, key: str, default: int) -> int:
    value = spark.conf.get(key, None)
    return int(value) if value else default


def scan_target(df: DataFrame, target_rows: int | None = None) -> int:
    """Rows that one window task should hold at most: the caller's number, or the session's."""
    return max(1, int(target_rows or _conf_int(df.sparkSession, CONF_TARGET_ROWS, DEFAULT_TARGET_ROWS)))


def bounded(df: DataFrame, rows: int) -> DataFrame:
    """``df``, known to have ``rows`` rows at most; the note is lost by any further operation."""
    df._solospan_rows = rows
    return df


def row_bound(df: DataFrame) -> int | None:
    return getattr(df, "_solospan_rows", None)


def scan_plan(
    points: DataFrame,
    keys: _Keys,
    order: str | list[str],
    strategy: str = "auto",
    n_rows: int | None = None,
    target_rows: int | None = None,
    seed: int = 20230117,
) -> RangePlan | None:
    """``window`` -> None (plain per-group window); ``auto`` / ``bucketed`` ->
    a ``RangePlan`` if some group of ``points`` exceeds ``target_rows``, else None.

    ``points`` may be the raw, not yet aggregated rows (cheaper: no shuffle),
    since only their distribution is used.  ``n_rows`` is their number if
    known, or a bound of it."""
    if strategy == "window":
        return None
    if strategy not in ("auto", "bucketed"):
        raise ValueError(f"unknown strategy {strategy!r}")
    spark, order = points.sparkSession, [order] if isinstance(order, str) else list(order)
    target = scan_target(points, target_rows)
    if n_rows is None:
        n_rows = points.count()
    if n_rows <= target:
        return None
    # a sweep streams through its partition, so a small target need not cut
    # finer than the session's shuffles do
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    partitions = max(1, min(math.ceil(n_rows / target), max(shuffles, math.ceil(n_rows / DEFAULT_TARGET_ROWS))))
    # One pass over the sample finds big groups (half a target) and values that
    # would fill a partition by themselves.
    p = min(1.0, SAMPLE_HITS / target)
    sample = points.select(*keys, *order).sample(False, p, seed)
    sets = [[*keys, *order], keys] if keys else [order, []]
    counts = sample.groupingSets(sets, *keys, *order).agg(F.count(F.lit(1)).alias("_n"), F.grouping_id().alias("_g"))
    is_hot = (F.col("_g") == 0) & (F.col("_n") >= p * n_rows / partitions)
    is_big = (F.col("_g") != 0) & (F.col("_n") >= SAMPLE_HITS // 2)
    n_big, n_hot = counts.agg(F.count_if(is_big), F.count_if(is_hot)).first()
    if not n_big:
        return None
    return RangePlan(partitions, n_big, n_hot)


def ordered_scan(
    df: DataFrame,
    keys: _Keys,
    order: list[str],
    sums: dict[str, str] | None = None,
    leads: dict[str, str] | None = None,
    plan: RangePlan | None = None,
    lags: dict[str, str] | None = None,
    tops: Tops | None = None,
) -> DataFrame:
    """Per group of ``keys`` ordered by ``order``: ``sums`` maps output name ->
    integral column (inclusive running sum), ``leads`` / ``lags`` map output
    name -> column (value of the next row / the row before), ``tops`` (name of
    the largest, name of the second) -> integral column (of the rows so far).
    Returns ``df`` with those columns appended.

    With a ``RangePlan`` the sweep is stored in the shared checkpoint folder
    when this is called: its rows and its edges must come from one exchange."""
    sums, leads, lags, tops, keys, order = sums or {}, leads or {}, lags or {}, tops or {}, list(keys), list(order)
    if plan is None:
        w = Window.partitionBy(*keys).orderBy(*order) if keys else Window.orderBy(*order)
        running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        out = df.select(
            "*",
            *[F.sum(source).over(running).alias(name) for name, source in sums.items()],
            *[F.max(source).over(running).cast("bigint").alias(one) for (one, _), source in tops.items()],
            *[F.max(source).over(w.rowsBetween(Window.unboundedPreceding, -1)).alias(f"_ss_{two}") for (_, two), source in tops.items()],
            *[F.lead(source).over(w).alias(name) for name, source in leads.items()],
            *[F.lag(source).over(w).alias(name) for name, source in lags.items()],
        )
        # the second largest is the largest of what a larger one before or behind has beaten
        for (one, two), source in tops.items():
            beaten = F.when(F.col(f"_ss_{two}").isNotNull() & F.col(source).isNotNull(), F.least(F.col(source), F.col(f"_ss_{two}")))
            out = out.withColumn(f"_ss_{two}", beaten).withColumn(two, F.max(f"_ss_{two}").over(running).cast("bigint")).drop(f"_ss_{two}")
        made = [*df.columns, *sums, *[n for pair in tops for n in pair], *leads, *lags]
        return out.select(*made) if tops else out
    ensure_checkpoint_dir(df.sparkSession)
    laid = df.repartitionByRange(plan.partitions, *keys, *order).sortWithinPartitions(*keys, *order)
    swept = sweep(laid, keys, sums, leads, lags, tops).checkpoint()
    return carried(swept, keys, order, sums, leads, lags, tops)


def point_scan(
    raw: DataFrame,
    keys: _Keys,
    coord: str,
    sum_cols: list[str],
    level_of: str,
    plan: RangePlan | None = None,
    level: str = "level",
    next_name: str = "next_x",
) -> DataFrame:
    """Scan ``raw`` rows per group in coordinate order, one output row per
    coordinate.

    Returns ``keys, coord, sum_cols`` (summed per coordinate), ``level`` (the
    inclusive running sum of ``level_of`` up to and including the
    coordinate) and ``next_name`` (the next coordinate of the group; NULL
    after the last).  With no ``sum_cols`` the rows are not aggregated: the
    last row of each coordinate has the sum of all and is kept.

    The window plan shuffles once, by group.  The range plan shuffles the rows
    once as well, unless there are ``sum_cols`` or frequent coordinates: then they
    are first summed per coordinate (partly before that shuffle).
    """
    keys = list(keys)
    per_point = bool(sum_cols)
    values = {c: F.sum(c) for c in (sum_cols if per_point else [level_of])}
    rows = raw.select(*keys, coord, *values)
    if plan is None:
        if keys:
            rows = rows.repartition(*keys)
        w = Window.partitionBy(*keys).orderBy(coord) if keys else Window.orderBy(coord)
        if per_point:
            rows = rows.groupBy(*keys, coord).agg(*[v.alias(c) for c, v in values.items()])
            frame = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        else:
            frame = w.rangeBetween(Window.unboundedPreceding, Window.currentRow)
        out = rows.select(*keys, coord, *sum_cols, F.sum(level_of).over(frame).alias(level), F.lead(coord).over(w).alias(next_name))
    else:
        if per_point or plan.n_hot:
            rows = rows.groupBy(*keys, coord).agg(*[v.alias(c) for c, v in values.items()])
        scanned = ordered_scan(rows, keys, [coord], {level: level_of}, {next_name: coord}, plan)
        out = scanned.select(*keys, coord, *sum_cols, level, next_name)
    return out if per_point else out.where(F.col(next_name).isNull() | (F.col(next_name) != F.col(coord)))
