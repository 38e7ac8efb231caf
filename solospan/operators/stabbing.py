"""Which ranges contain a point: a join by a bucketed dyadic tree (S2.G6, E).

Coordinates are cut into leaves of ``width``.  A range is filed at the leaf of
its begin, at that of its end, and for the leaves in between at the fewest
nodes of the dyadic tree over the leaves that cover them: at most two a level,
so a range over all leaves is filed a few dozen times and never once for each
leaf.  A point looks at its leaf and, on each level that the ranges of its set
use, at the one node above it.  Range and point meet at exactly one node, by an
equi-join on (keys, level, node); only in a leaf the bounds must be compared.
Every pair that meets inside the tree is a result, so a hot node's pairs are
output, and adaptive execution splits its join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from solospan.functions.buckets import bucket_of
from solospan.schema import as_keys

LEAF = -1  # level of the leaves, where bounds are compared
LEAF_WIDTH = 65536


def _nodes(first: Column, last: Column, level: Column) -> Column:
    """The nodes of ``level`` in the smallest cover of the leaves ``first`` to ``last``: up to two.

    ``[a, b]`` are the nodes of the level inside, ``[c, d]`` those of the next
    level; a node inside whose parent is inside too is left to the parent.
    """

    def inside(up: Column) -> tuple[Column, Column]:
        size = F.call_function("shiftleft", F.lit(1).cast("bigint"), up)
        return -F.call_function("div", -first - F.pmod(-first, size), size), F.call_function("div", last + 1 - F.pmod(last + 1, size), size) - 1

    a, b = inside(level)
    c, d = inside(level + 1)
    none_above = c > d
    left = F.when((a <= b) & (none_above | (a < c * 2)), a)
    right = F.when((a <= b) & (none_above | (b > d * 2 + 1)), b)
    return F.array_distinct(F.array_compact(F.array(left, right)))


def file_ranges(ranges: DataFrame, width: int, begin: str = "begin", end: str = "end") -> DataFrame:
    """Every range once for each node that it is filed at: ``_level`` and ``_node``."""
    first, last = bucket_of(F.col(begin), width), bucket_of(F.col(end), width)
    spans = ranges.withColumns({"_first": first, "_last": last})
    leaf = F.lit(LEAF)
    ends = F.array_distinct(F.array(F.col("_first"), F.col("_last")))
    at_leaves = F.transform(ends, lambda n: F.struct(leaf.alias("_level"), n.alias("_node")))
    lo, hi = F.col("_first") + 1, F.col("_last") - 1
    top = F.floor(F.log2((hi - lo + 1).cast("double"))).cast("int") + 1  # log2 may round: one level more holds no node
    inner = F.flatten(
        F.transform(F.sequence(F.lit(0), top), lambda j: F.transform(_nodes(lo, hi, j), lambda n: F.struct(j.alias("_level"), n.alias("_node"))))
    )
    filed = F.when(lo <= hi, F.concat(at_leaves, inner)).otherwise(at_leaves)
    return spans.select(*ranges.columns, F.inline(filed))


def ranges_containing(points: DataFrame, ranges: DataFrame, keys=("set_id",), point: str = "point", begin: str = "begin", end: str = "end", width: int = LEAF_WIDTH) -> DataFrame:
    """Every row of ``points`` with every row of ``ranges`` of the same keys that contains it.

    ``keys, point``, the other columns of ``points``, then those of ``ranges``;
    the names of the two must differ but for the keys.  NULL keys are keys like
    any other; a NULL point or bound and a reversed range match nothing.
    """
    keys = as_keys(keys)
    mine = [c for c in points.columns if c not in keys]
    theirs = [c for c in ranges.columns if c not in keys]
    if clash := set(mine) & set(theirs):
        raise ValueError(f"columns of both: {sorted(clash)}")
    filed = file_ranges(ranges.where(F.col(begin) <= F.col(end)), width, begin, end)
    filed = filed.select(*[F.col(c).alias(f"_r_{c}") for c in keys], *theirs, F.col("_level").alias("_at"), F.col("_node").alias("_in"))
    levels = filed.groupBy(*[f"_r_{c}" for c in keys]).agg(F.collect_set("_at").alias("_levels"))  # up to 64 numbers
    same = F.lit(True)
    for c in keys:
        same = same & points[c].eqNullSafe(F.col(f"_r_{c}"))
    leaf = bucket_of(F.col(point), width)
    size = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.greatest(F.col("_level"), F.lit(0)))
    looked = points.where(F.col(point).isNotNull()).join(levels, same, "inner").select(*points.columns, leaf.alias("_leaf"), F.explode("_levels").alias("_level"))
    looked = looked.select(*points.columns, "_level", F.call_function("div", F.col("_leaf") - F.pmod(F.col("_leaf"), size), size).alias("_node"))
    met = (F.col("_level") == F.col("_at")) & (F.col("_node") == F.col("_in"))
    for c in keys:
        met = met & looked[c].eqNullSafe(filed[f"_r_{c}"])
    met = met & (F.col(begin) <= F.col(point)) & (F.col(point) <= F.col(end))
    return looked.join(filed, met, "inner").select(*keys, *mine, *theirs)


def open_range_rows(df: DataFrame, keys=("set_id",), begin: str = "begin", end: str = "end", width: int = LEAF_WIDTH) -> DataFrame:
    """``keys, point, begin, end, n``: at every point where some range begins, each range that is open there.

    The rows behind the counts of ``open_ranges``: those that end there or
    later and begin there or earlier.  Equal ranges are one row with their
    number ``n`` (combined before they are filed).
    """
    keys = as_keys(keys)
    distinct = df.where(F.col(begin) <= F.col(end)).groupBy(*keys, begin, end).agg(F.count(F.lit(1)).alias("n"))
    points = df.where(F.col(begin) <= F.col(end)).select(*keys, F.col(begin).alias("point")).distinct()
    return ranges_containing(points, distinct, keys, "point", begin, end, width)
