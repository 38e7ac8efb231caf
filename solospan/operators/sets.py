"""Result comparison, set numbering and replication (S2.H3, F4, E2, I2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from solospan.plans.scan import ordered_scan, scan_plan
from solospan.schema import as_keys
from solospan.session import ensure_checkpoint_dir

SMALL_TABLE = 100_000  # rows of a table that is broadcast after it was counted


def cross_check(left: DataFrame, right: DataFrame) -> DataFrame:
    """Bag difference both ways, tagged by ``side`` (``left_only`` /
    ``right_only``); empty when the two results agree row for row.

    One aggregate over the tagged union counts every distinct row on each
    side (each input is computed once, one shuffle with map-side combine);
    a row found more often on one side is repeated by the difference."""
    cols = left.columns
    tagged = left.select(*cols, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
        right.select(*cols, F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    )
    counts = tagged.groupBy(*cols).agg(F.sum("_l").alias("_nl"), F.sum("_r").alias("_nr"))
    diff = counts.where(F.col("_nl") != F.col("_nr"))
    surplus = F.abs(F.col("_nl") - F.col("_nr"))
    return diff.select(
        *cols,
        F.when(F.col("_nl") > F.col("_nr"), F.lit("left_only")).otherwise(F.lit("right_only")).alias("side"),
        F.explode(F.sequence(F.lit(1).cast("bigint"), surplus.cast("bigint"))).alias("_copy"),
    ).drop("_copy")


def cross_check_summary(left: DataFrame, right: DataFrame, keys=("set_id",)) -> DataFrame:
    """Per group: rows on each side and rows found on one side only
    (``only_left``/``only_right`` are 0 when both results agree)."""
    keys = as_keys(keys)
    cols = left.columns
    tagged = left.select(*cols, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
        right.select(*cols, F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    )
    per_row = tagged.groupBy(*cols).agg(F.sum("_l").alias("_nl"), F.sum("_r").alias("_nr"))
    return per_row.groupBy(*keys).agg(
        F.sum("_nl").cast("bigint").alias("rows_left"),
        F.sum("_nr").cast("bigint").alias("rows_right"),
        F.sum(F.greatest(F.col("_nl") - F.col("_nr"), F.lit(0))).cast("bigint").alias("only_left"),
        F.sum(F.greatest(F.col("_nr") - F.col("_nl"), F.lit(0))).cast("bigint").alias("only_right"),
    )


def next_set_id(df: DataFrame, col: str = "set_id") -> DataFrame:
    """One row ``next_set_id``: largest set number + 1, or 1 for an empty table."""
    return df.agg(F.coalesce(F.max(col) + 1, F.lit(1)).cast("bigint").alias("next_set_id"))


def with_set_id(df: DataFrame, set_id, col: str = "set_id") -> DataFrame:
    """Attach a set number to every range (``set_id`` first among columns)."""
    return df.select(F.lit(set_id).alias(col), *[c for c in df.columns if c != col])


def replicate_rows(df: DataFrame, n: int, col: str = "copy") -> DataFrame:
    """Every row ``n`` times, numbered 1..n in ``col``."""
    if n < 0:
        raise ValueError("n must be >= 0")
    one, last = F.lit(1).cast("bigint"), F.lit(n).cast("bigint")
    if n == 0:
        return df.where(F.lit(False)).withColumn(col, one)
    return df.select("*", F.explode(F.sequence(one, last)).alias(col))


def source_numbers(sources: DataFrame, source: str = "source", first: DataFrame | int = 1, col: str = "set_id") -> DataFrame:
    """``source`` and its set number: distinct sources in their order, from ``first`` on (a number, or a one-row
    table like that of ``next_set_id``, which is read)."""
    distinct = sources.select(source).distinct().withColumn("_one", F.lit(1).cast("bigint"))
    plan = scan_plan(distinct, [], source)
    ranked = ordered_scan(distinct, [], [source], {"_n": "_one"}, plan=plan)
    low = first if isinstance(first, int) else int(first.first()[0])
    return ranked.select(source, (F.col("_n") + (low - 1)).alias(col))


def number_sets(rows: DataFrame, source: str = "source", first: DataFrame | int = 1, col: str = "set_id", numbers: DataFrame | None = None) -> DataFrame:
    """``rows`` with the set number of their source in front: all inputs in one plan, whatever their number.

    ``numbers`` (``source``, ``col``) if they are known already, e.g. because
    sources without rows count too."""
    numbers = source_numbers(rows, source, first, col) if numbers is None else numbers
    numbers = numbers.select(F.col(source).alias("_source"), F.col(col).alias("_number"))
    joined = rows.join(numbers, F.col(source).eqNullSafe(F.col("_source")))
    return joined.select(F.col("_number").alias(col), *[c for c in rows.columns if c != col])


def bag_digest(df: DataFrame, cell: dict[str, Column]) -> DataFrame:
    """For each cell (named expressions) the number of its rows and two sums over their hashes, free of order.

    Equal bags of rows have equal digests; different ones differ but for a
    chance of about 2**-128."""
    hashed = df.select(*[c.alias(n) for n, c in cell.items()], F.xxhash64(*df.columns).alias("_h"), F.xxhash64(F.lit("again"), *df.columns).alias("_g"))
    return hashed.groupBy(*cell).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("_h").cast("decimal(20,0)")).alias("h"), F.sum(F.col("_g").cast("decimal(20,0)")).alias("g"))


def compared_cells(left: DataFrame, right: DataFrame, cell: dict[str, Column]) -> DataFrame:
    """For each cell ``n_left``, ``n_right`` and whether the two bags of rows differ (``differs``): only digests are shuffled."""
    a, b = bag_digest(left, cell), bag_digest(right, cell)
    none = F.lit(0).cast("decimal(20,0)")
    sides = [F.col("n").alias("n_left"), F.lit(0).cast("bigint").alias("n_right"), F.col("h").alias("dh"), F.col("g").alias("dg")]
    other = [F.lit(0).cast("bigint").alias("n_left"), F.col("n").alias("n_right"), (none - F.col("h")).alias("dh"), (none - F.col("g")).alias("dg")]
    both = a.select(*cell, *sides).unionByName(b.select(*cell, *other)).groupBy(*cell)
    met = both.agg(*[F.sum(c).alias(c) for c in ("n_left", "n_right", "dh", "dg")])
    differs = (F.col("n_left") != F.col("n_right")) | (F.col("dh") != 0) | (F.col("dg") != 0)
    return met.select(*cell, "n_left", "n_right", differs.alias("differs"))


def digest_summary(left: DataFrame, right: DataFrame, cell: dict[str, Column], keys=("set_id",)) -> DataFrame:
    """Per group: rows on each side and the number of cells whose rows differ; ``cell`` holds the keys."""
    return compared_cells(left, right, cell).groupBy(*as_keys(keys)).agg(
        F.sum("n_left").alias("rows_left"), F.sum("n_right").alias("rows_right"), F.count_if("differs").alias("cells_differing")
    )


def cross_check_digest(left: DataFrame, right: DataFrame, cell: dict[str, Column]) -> DataFrame:
    """The bag difference of ``cross_check`` by way of digests: first the cells that differ, then the rows of those only.

    ``cell`` names expressions over the columns of both (say the set and the
    bucket of ``begin``).  The inputs are read twice; what is shuffled is a row
    for each cell, and the rows of cells that differ."""
    ensure_checkpoint_dir(left.sparkSession)
    cells = compared_cells(left, right, cell).where("differs").select(*cell).checkpoint()
    few = cells.count() <= SMALL_TABLE
    cells = cells.select(*[F.col(n).alias(f"_c_{n}") for n in cell])

    def within(df: DataFrame) -> DataFrame:
        cond = F.lit(True)
        for n, c in cell.items():
            cond = cond & c.eqNullSafe(F.col(f"_c_{n}"))
        return df.join(F.broadcast(cells) if few else cells, cond, "left_semi")

    return cross_check(within(left), within(right))
