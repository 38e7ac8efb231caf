"""Cutting ranges at bucket edges, gluing results again, merging touching
results and a bucket-ordered table layout (S2.C7, D5-D7, D9, B5, H1, E1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from solospan.functions.buckets import IP4_BUCKET_WIDTH, bucket_of, idiv
from solospan.functions.checks import refuse
from solospan.operators.events import coverage_depth
from solospan.operators.exclusive import exclusive_ranges
from solospan.plans.scan import ordered_scan, row_bound, scan_plan, scan_target
from solospan.schema import as_keys
from solospan.session import ensure_checkpoint_dir


STEP = 65536  # numbers that one row's array may hold


def _each_number(df: DataFrame, kept: list[str], first: str, last: str, name: str) -> DataFrame:
    """``kept`` and a row for each whole number from ``first`` to ``last``, made
    a step at a time: no row ever holds an array of all its numbers."""
    steps = df.select("*", F.explode(F.sequence(bucket_of(F.col(first), STEP), bucket_of(F.col(last), STEP))).alias("_step"))
    low = F.col("_step") * STEP
    return steps.select(*kept, F.explode(F.sequence(F.greatest(F.col(first), low), F.least(F.col(last), low + (STEP - 1)))).alias(name))


def cut_at_buckets(
    df: DataFrame, width: int = IP4_BUCKET_WIDTH, keys=("set_id",), begin: str = "begin", end: str = "end"
) -> DataFrame:
    """Cut every range at the bucket edges it crosses: ``keys, bucket, begin,
    end`` with one piece per bucket touched (a range inside one bucket stays
    whole).  A range crossing k edges becomes k+1 pieces; a reversed range
    covers no point and gives none."""
    keys = as_keys(keys)
    bb, be = bucket_of(F.col(begin), width), bucket_of(F.col(end), width)
    spans = df.where(F.col(begin) <= F.col(end)).select(*keys, begin, end, bb.alias("_first"), be.alias("_last"))
    pieces = _each_number(spans, [*keys, begin, end], "_first", "_last", "bucket")
    lo = F.col("bucket") * width
    return pieces.select(
        *keys,
        "bucket",
        F.greatest(F.col(begin), lo).alias(begin),
        F.least(F.col(end), lo + (width - 1)).alias(end),
    )


def glue_points(
    df: DataFrame, width: int = IP4_BUCKET_WIDTH, keys=("set_id",), begin: str = "begin", end: str = "end"
) -> DataFrame:
    """Distinct ``keys, bucket`` whose lower edge cuts some range, with the two
    coordinates on both sides of the edge (``left_point``, ``right_point``).

    A range's edges are a span of bucket numbers; the spans' coverage gives
    each edge once, so ranges that share edges cost two events each and no
    edge is made to be dropped again."""
    keys = as_keys(keys)
    bb, be = bucket_of(F.col(begin), width), bucket_of(F.col(end), width)
    crossing = df.where(be > bb).select(*keys, (bb + 1).alias("_first"), be.alias("_last"))
    spans = coverage_depth(crossing, keys, "_first", "_last", n_rows=2 * df.count())  # a bound that costs no scan of the bounds
    spans = spans.where("depth > 0").select(*keys, "point", (F.col("next_point") - 1).alias("_last"))
    edges = _each_number(spans, keys, "point", "_last", "bucket")
    return edges.select(
        *keys, "bucket", (F.col("bucket") * width - 1).alias("left_point"), (F.col("bucket") * width).alias("right_point")
    )


def edge_ranges(
    df: DataFrame, width: int = IP4_BUCKET_WIDTH, keys=("set_id",), begin: str = "begin", end: str = "end"
) -> DataFrame:
    """Ranges that begin on a bucket edge or end just before one, flagged."""
    keys = as_keys(keys)
    on_begin = F.pmod(F.col(begin), F.lit(width)) == 0
    on_end = F.pmod(F.col(end), F.lit(width)) == width - 1
    return df.where(on_begin | on_end).select(
        *keys, begin, end, on_begin.alias("starts_on_edge"), on_end.alias("ends_on_edge")
    )


def bucket_layout(
    df: DataFrame,
    width: int = IP4_BUCKET_WIDTH,
    num_partitions: int | None = None,
    keys=("set_id",),
    begin: str = "begin",
) -> DataFrame:
    """Rows unchanged plus ``bucket``; range-partitioned by (keys, bucket,
    begin) and sorted inside partitions, for writing a table laid out by
    bucket.  Ranging on ``begin`` too splits a crowded bucket."""
    keys = as_keys(keys)
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    d = df.withColumn("bucket", bucket_of(F.col(begin), width))
    return d.repartitionByRange(n, *keys, "bucket", begin).sortWithinPartitions(*keys, "bucket", begin)


ZBITS = 16  # bits of each end in a z-order key
#: (shift, mask) pairs that move the 16 low bits of a number to its even places (fixed values)
SPREAD = ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555))


def zorder_key(begin, end, low: int, step: int) -> Column:
    """The cells of both ends, counted in ``step`` from ``low``, with their bits taken in turn (begin's first)."""

    def spread(x) -> Column:
        cell = F.least(F.greatest(idiv(F.col(x) - low, step), F.lit(0)), F.lit((1 << ZBITS) - 1))
        c = F.when(F.col(x).isNotNull(), cell.cast("bigint"))
        for shift, mask in SPREAD:
            c = c.bitwiseOR(F.shiftleft(c, shift)).bitwiseAND(F.lit(mask).cast("bigint"))
        return c

    return F.shiftleft(spread(begin), 1).bitwiseOR(spread(end))


def zorder_layout(
    df: DataFrame, num_partitions: int | None = None, keys=("set_id",), begin: str = "begin", end: str = "end", bounds: tuple[int, int] | None = None
) -> DataFrame:
    """Rows unchanged plus ``zkey``; range-partitioned by (keys, zkey) and
    sorted inside partitions, for writing a table whose row groups are small
    boxes of (begin, end), so that a lookup by either end, or of the ranges that
    contain a point, prunes row groups; a layout by begin leaves one long range
    in every group.

    ``bounds`` are the smallest and largest coordinate, if known; otherwise they
    are read (two numbers).  Coordinates beyond them fall in the outer cells; a
    NULL bound gives a NULL key."""
    keys = as_keys(keys)
    low, high = bounds or df.agg(F.least(F.min(begin), F.min(end)), F.greatest(F.max(begin), F.max(end))).first()
    low, high = low or 0, high or 0
    step = -(-(high - low + 1) // (1 << ZBITS))
    d = df.withColumn("zkey", zorder_key(begin, end, low, step))
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return d.repartitionByRange(n, *keys, "zkey", begin).sortWithinPartitions(*keys, "zkey", begin)


def _islands(d: DataFrame, keys: list[str], begin: str, end: str, strategy: str, target_rows: int | None, n_rows: int | None) -> DataFrame:
    """Unite runs of disjoint ranges (sorted by begin) where each range touches
    the previous one and may join it (column ``_join``).

    With ``S`` the total length of the earlier rows
    of the group and ``B`` the number of rows so far that may not join their
    predecessor, ``key = begin - S + B`` never decreases and stays equal
    exactly across touching rows that may join; an island is a ``key``.

    Ranges that overlap fail the job: the formula holds for disjoint ones.

    ``n_rows`` bounds the number of ranges.  Without it, or if it is more than
    a task takes, the ranges are stored first, since planning reads them too."""
    if strategy != "window" and (n_rows is None or n_rows > scan_target(d, target_rows)):
        ensure_checkpoint_dir(d.sparkSession)
        d, n_rows = d.checkpoint(), None
    plan = scan_plan(d, keys, begin, strategy, n_rows=n_rows, target_rows=target_rows)
    d = d.select(
        *keys,
        begin,
        end,
        (F.col(end) - F.col(begin) + 1).alias("_len"),
        F.when(F.col("_join"), 0).otherwise(1).cast("bigint").alias("_nj"),
    )
    sc = ordered_scan(d, keys, [begin], sums={"_s": "_len", "_b": "_nj"}, leads={"_next": begin}, plan=plan)
    shown = [F.col(c).cast("string") for c in (begin, end, "_next")]
    sc = refuse(sc, F.col("_next") <= F.col(end), F.concat(F.lit("Overlapping ranges: "), shown[0], F.lit(".."), shown[1], F.lit(" and "), shown[2]))
    key = F.col(begin) - (F.col("_s") - F.col("_len")) + F.col("_b")
    return sc.groupBy(*keys, key.alias("_island")).agg(F.min(begin).alias(begin), F.max(end).alias(end)).drop(
        "_island"
    )


def glue_ranges(
    results: DataFrame,
    points: DataFrame,
    width: int = IP4_BUCKET_WIDTH,
    keys=("set_id",),
    begin: str = "begin",
    end: str = "end",
    strategy: str = "auto",
    target_rows: int | None = None,
    n_rows: int | None = None,
) -> DataFrame:
    """Glue exclusive results computed on cut pieces back together: a result
    ending at ``k*width - 1`` and the next one starting at ``k*width`` are one
    range when edge ``k`` is a glue point (a range was cut there).  Chains over
    several edges are glued in one pass.

    ``n_rows`` bounds the number of results if known; results straight from
    ``exclusive_ranges`` carry their bound."""
    keys = as_keys(keys)
    starts_on_edge = F.pmod(F.col(begin), F.lit(width)) == 0
    # One pass: a result starting on an edge looks up (set, edge); any other
    # result gets the key (set, false, begin), unique (results are disjoint)
    # and never a glue point, so the join neither skews nor matches it.
    r = results.select(
        *keys,
        begin,
        end,
        starts_on_edge.alias("_e"),
        F.when(starts_on_edge, bucket_of(F.col(begin), width)).otherwise(F.col(begin)).alias("_k"),
    )
    glue = (
        points.select(*[F.col(c).alias(f"_g_{c}") for c in keys], F.col("bucket").alias("_g__k"))
        .distinct()
        .withColumn("_g__e", F.lit(True))
        .withColumn("_join", F.lit(True))
    )
    cond = None
    for c in keys + ["_e", "_k"]:  # null-safe: a NULL set key is a group like any other
        term = r[c].eqNullSafe(glue[f"_g_{c}"])
        cond = term if cond is None else cond & term
    d = r.join(glue, cond, "left").select(*keys, begin, end, F.coalesce(F.col("_join"), F.lit(False)).alias("_join"))
    return _islands(d, keys, begin, end, strategy, target_rows, n_rows if n_rows is not None else row_bound(results))


def merge_touching(
    results: DataFrame,
    keys=("set_id",),
    begin: str = "begin",
    end: str = "end",
    strategy: str = "auto",
    target_rows: int | None = None,
    n_rows: int | None = None,
) -> DataFrame:
    """Unite disjoint ranges that touch (``next.begin = end + 1``); the set of
    covered points is unchanged.  ``n_rows`` as for ``glue_ranges``."""
    keys = as_keys(keys)
    d = results.select(*keys, begin, end, F.lit(True).alias("_join"))
    return _islands(d, keys, begin, end, strategy, target_rows, n_rows if n_rows is not None else row_bound(results))


def exclusive_by_cutting(
    df: DataFrame, width: int = IP4_BUCKET_WIDTH, keys=("set_id",), begin: str = "begin", end: str = "end", target_rows: int | None = None
) -> DataFrame:
    """Exclusive ranges by another way than ``exclusive_ranges`` of the whole
    input: cut at bucket edges, solve each bucket by itself, glue the results."""
    keys = as_keys(keys)
    cut = cut_at_buckets(df, width, keys, begin, end)
    parts = exclusive_ranges(cut, [*keys, "bucket"], begin, end, target_rows=target_rows).drop("bucket")
    return glue_ranges(parts, glue_points(df, width, keys, begin, end), width, keys, begin, end, target_rows=target_rows)
