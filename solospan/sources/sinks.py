"""Readable views, documents, numbered listings and their writers
(S2.A7, A8, B2, B3, B9)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from solospan.functions.buckets import bucket_of
from solospan.functions.checks import refuse
from solospan.functions.ipv4 import ip4_text
from solospan.plans.scan import ordered_scan, scan_plan
from solospan.schema import as_keys


def readable_ranges(df: DataFrame, keys=("set_id",), begin: str = "begin", end: str = "end") -> DataFrame:
    """``keys, sbegin, send`` with both ends as dotted quads (the ``sinput`` /
    ``soutput`` views)."""
    keys = as_keys(keys)
    return df.select(*keys, ip4_text(F.col(begin)).alias("sbegin"), ip4_text(F.col(end)).alias("send"))


def register_readable_view(df: DataFrame, name: str, **kw) -> DataFrame:
    """Register ``readable_ranges(df)`` as a temp view ``name``."""
    view = readable_ranges(df, **kw)
    view.createOrReplaceTempView(name)
    return view


def range_documents(df: DataFrame, begin: str = "begin", end: str = "end") -> DataFrame:
    """Rows for a document index: every column kept, ``begin``/``end``
    replaced by their dotted text."""
    return df.withColumns({begin: ip4_text(F.col(begin)), end: ip4_text(F.col(end))})


def write_documents(df: DataFrame, target: str | None, fmt: str = "json", mode: str = "append", **options) -> bool:
    """Append documents through any installed format (``json`` by default; a
    search-index connector's format name when one is on the class path).
    A blank ``target`` disables the sink; returns whether it wrote."""
    if target is None or not target.strip():
        return False
    range_documents(df).write.mode(mode).format(fmt).options(**options).save(target)
    return True


CHUNK = 4096  # equal rows that are numbered in one go


def _numbered(df: DataFrame, keys: list[str], order: list[str], strategy: str, target_rows: int | None) -> DataFrame:
    """``df`` (``keys``, ``order`` and ``_one``) with ``n``, the row's place in its group in the order of ``order``.

    If equal rows are too many for one task, equal rows go through the scan as
    one with their count; their numbers are made from it, chunk by chunk."""
    cols = [*keys, *order]
    plan = scan_plan(df, keys, order, strategy, target_rows=target_rows)
    if plan is None or not plan.n_hot:
        return ordered_scan(df, keys, order, sums={"n": "_one"}, plan=plan).select(*cols, "n")
    counted = df.groupBy(*cols).agg(F.sum("_one").alias("_one"))  # partial on the map side
    scanned = ordered_scan(counted, keys, order, sums={"n": "_one"}, plan=plan)
    first = F.col("n") - F.col("_one") + 1
    chunks = scanned.select(*cols, "n", "_one", F.explode(F.sequence(F.lit(0).cast("bigint"), bucket_of(F.col("_one") - 1, CHUNK))).alias("_chunk"))
    low = first + F.col("_chunk") * CHUNK
    return chunks.select(*cols, F.explode(F.sequence(low, F.least(F.col("n"), low + (CHUNK - 1)))).alias("n"))


def numbered_listing(
    df: DataFrame,
    keys=("set_id",),
    begin: str = "begin",
    end: str = "end",
    strategy: str = "auto",
    target_rows: int | None = None,
    on_reversed: str = "keep",
) -> DataFrame:
    """``keys, n, line`` where ``n`` numbers the ranges of a set from 1 in
    (begin, end) order and ``line`` is ``n<TAB>begin, end`` in dotted form
    (plain numbers outside the IPv4 range).
    ``on_reversed="raise"`` fails the job on a range with begin > end."""
    keys = as_keys(keys)
    if on_reversed == "raise":
        msg = F.concat(F.lit("Reversed range: "), F.col(begin).cast("string"), F.lit(" > "), F.col(end).cast("string"))
        df = refuse(df, F.col(begin) > F.col(end), msg)
    elif on_reversed != "keep":
        raise ValueError(f"unknown on_reversed {on_reversed!r}")
    base = df.select(*keys, begin, end, F.lit(1).cast("bigint").alias("_one"))
    sc = _numbered(base, keys, [begin, end], strategy, target_rows)

    def shown(c: str):  # dotted quad, or the plain number outside the IPv4 range
        return F.coalesce(ip4_text(F.col(c)), F.col(c).cast("string"))

    line = F.concat(F.col("n").cast("string"), F.lit("\t"), shown(begin), F.lit(", "), shown(end))
    return sc.select(*keys, "n", line.alias("line"))


def write_ranges(
    df: DataFrame,
    path: str | None = None,
    table: str | None = None,
    mode: str = "append",
    set_col: str = "set_id",
    layout: str = "by_set",
    hash_partitions: int = 64,
) -> None:
    """Store ranges with the shared table schema (``set_id INT, begin BIGINT,
    end BIGINT``): as parquet under ``path``, or as the catalog table
    ``table`` (``saveAsTable``).  Rows with a NULL bound are refused (the
    table columns are NOT NULL).

    ``layout="by_set"`` makes one directory per set (few, large sets: a
    later read of one set prunes to its directory); ``layout="hashed"``
    spreads sets over ``hash_partitions`` directories by a hash of the set
    (many small sets, where a directory per set would not scale)."""
    out = df.select(
        F.col(set_col).cast("int").alias("set_id"), F.col("begin").cast("bigint"), F.col("end").cast("bigint")
    )
    bad = F.col("set_id").isNull() | F.col("begin").isNull() | F.col("end").isNull()
    out = refuse(out, bad, F.lit("NULL in a NOT NULL range column"))
    if layout == "by_set":
        # a large set is written by many tasks, a small one by one or two
        writer = out.repartitionByRange("set_id", "begin").write.mode(mode).partitionBy("set_id")
    elif layout == "hashed":
        out = out.withColumn("set_hash", F.pmod(F.xxhash64("set_id"), F.lit(hash_partitions)))
        writer = out.repartitionByRange("set_hash", "set_id", "begin").write.mode(mode).partitionBy("set_hash")
    else:
        raise ValueError(f"unknown layout {layout!r}")
    if table:
        writer.format("parquet").saveAsTable(table)
    elif path:
        writer.parquet(path)
    else:
        raise ValueError("give a path or a table name")


def write_listing(listing: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write the ``line`` column as text files, a folder for each set (``key=value``); a set's files, by name,
    hold its lines in order."""
    keys = [c for c in listing.columns if c not in ("n", "line")]
    ordered = listing.repartitionByRange(*keys, "n").sortWithinPartitions(*keys, "n").select(*keys, "line")
    ordered.write.mode(mode).partitionBy(*keys).text(path)
