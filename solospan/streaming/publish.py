"""Publish a set of ranges: store the input, compute the exclusive ranges by
two independent plans, cross-check them, then store the result (S2.I1, A5-A7,
H3).  The same body serves as a ``foreachBatch`` function, so every
micro-batch of a text stream becomes one numbered set.

Order of effects (as in the reference): the input is written whatever
happens next; the output only after both plans agree.  The computation reads
the *written* input when it is a table path, which also cuts the lineage, and
otherwise a reliable checkpoint in the cluster's shared checkpoint folder.

A sink is a path (a set's folder is overwritten), a function, or a
``CommittedTable``: then a write that stops half way, or a reader in between,
still finds the old rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from solospan.functions.buckets import bucket_of
from solospan.operators.cutting import exclusive_by_cutting
from solospan.operators.exclusive import exclusive_ranges
from solospan.operators.sets import compared_cells, cross_check, number_sets, source_numbers
from solospan.plans.scan import CONF_TARGET_ROWS, DEFAULT_TARGET_ROWS
from solospan.session import ensure_checkpoint_dir
from solospan.sources.committed import CommittedTable
from solospan.sources.sinks import write_documents
from solospan.sources.text import good_ranges, parse_range_lines, rejected_lines

Sink = str | Callable[[DataFrame], None] | CommittedTable | None


class CrossCheckFailed(RuntimeError):
    pass


def _write(df: DataFrame, sink: Sink) -> None:
    if sink is None:
        return
    if callable(sink):
        sink(df)
        return
    df.write.mode("overwrite").parquet(sink)


def set_folder(table: str, set_id: int) -> str:
    """Where a set of a table is kept.  Its rows replace the folder, with no
    rows as well: publishing a set again leaves just what it gives now."""
    return f"{table.rstrip('/')}/set_id={set_id}"


def _write_set(df: DataFrame, sink: Sink, set_id: int) -> None:
    if isinstance(sink, CommittedTable):  # readers see the old rows of the set until the new ones are all there
        sink.replace(df, "set_id", set_id)
    elif isinstance(sink, str):
        _write(df.drop("set_id"), set_folder(sink, set_id))
    else:
        _write(df, sink)


def _stable_input(spark: SparkSession, df: DataFrame, sink: Sink, set_id) -> DataFrame:
    if isinstance(sink, CommittedTable):
        return sink.read([f"set_id={set_id}"]).select("set_id", "begin", "end")
    if isinstance(sink, str):
        stored = spark.read.schema("begin bigint, end bigint").parquet(set_folder(sink, set_id))
        return stored.select(F.lit(set_id).alias("set_id"), "begin", "end")
    ensure_checkpoint_dir(spark)
    return df.checkpoint(eager=True)


def publish(
    ranges: DataFrame,
    set_id: int,
    input_sink: Sink = None,
    output_sink: Sink = None,
    documents: str | None = None,
    documents_format: str = "json",
    target_rows: int | None = None,
    verify: bool = True,
) -> DataFrame:
    """Store ``ranges`` (columns ``begin, end``) as set ``set_id``, compute its
    exclusive ranges, cross-check them against a second plan (``verify``),
    store them; returns the result.

    The check goes another way: ranges are cut at the edges of fixed buckets,
    each bucket's exclusive ranges are computed by themselves, and pieces that
    a cut had parted are glued; a set of any size is never one task."""
    spark = ranges.sparkSession
    numbered = ranges.select(F.lit(set_id).alias("set_id"), "begin", "end")
    _write_set(numbered, input_sink, set_id)
    stable = _stable_input(spark, numbered, input_sink, set_id)

    # used by the check and by both writers: computed once (a lost block is
    # recomputed from the stable input, not from the original lineage)
    result = exclusive_ranges(stable, strategy="auto", target_rows=target_rows).persist(
        StorageLevel.MEMORY_AND_DISK
    )
    try:
        if verify:
            target = target_rows or int(spark.conf.get(CONF_TARGET_ROWS, None) or DEFAULT_TARGET_ROWS)
            other = exclusive_by_cutting(stable, target_rows=max(1, target // 4))
            n_diff = cross_check(result, other).count()
            if n_diff:
                raise CrossCheckFailed(f"set {set_id}: the two plans differ in {n_diff} rows")
        _write_set(result, output_sink, set_id)
        if documents and documents.strip():  # a folder for each set, replaced when the set is published again
            write_documents(result, set_folder(documents, set_id), fmt=documents_format, mode="overwrite")
    finally:
        result.unpersist()
    return result


def range_line_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A streaming DataFrame of parsed range lines from text files arriving
    in ``path``: ``line, begin, end, reason`` (the parse is a stateless
    projection, so it runs inside every micro-batch)."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return parse_range_lines(reader.load(path).withColumnRenamed("value", "line"))


def foreach_batch_publisher(
    first_set_id: int,
    input_sink: Sink = None,
    output_sink: Sink = None,
    documents: str | None = None,
    line: str = "value",
    target_rows: int | None = None,
):
    """A ``foreachBatch`` function for a stream of text lines: micro-batch
    ``epoch`` is published as set ``first_set_id + epoch``.  Malformed and
    reversed lines are left out (see ``parse_range_lines`` for the reasons)."""

    def body(batch: DataFrame, epoch_id: int) -> None:
        parsed = parse_range_lines(batch.withColumnRenamed(line, "line"))
        publish(
            good_ranges(parsed),
            first_set_id + epoch_id,
            input_sink=input_sink,
            output_sink=output_sink,
            documents=documents,
            target_rows=target_rows,
        )

    return body


def publish_files(
    spark: SparkSession,
    path: str | list[str],
    tables: str,
    first: int = 1,
    documents: str | None = None,
    documents_format: str = "json",
    verify: bool = True,
    target_rows: int | None = None,
) -> DataFrame:
    """Every text file under ``path`` (files, folders or globs) as one set, all in one plan: the number of Spark
    jobs does not grow with the number of files.

    Sets are numbered from ``first`` in the order of the files' names, files
    without a good line too; a file without a byte is no set.  Stores ``input``, ``rejects`` and ``output`` under
    ``tables`` (a folder for each set) and, if asked, documents; the numbers must
    be free.  Returns the numbers: ``source, set_id``."""
    ensure_checkpoint_dir(spark)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)  # contents are not read
    numbers = source_numbers(files.select(F.col("_metadata.file_path").alias("source")), first=first).checkpoint()
    lines = spark.read.option("recursiveFileLookup", "true").text(path).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("source"))
    parsed = parse_range_lines(number_sets(lines, numbers=numbers).select("set_id", "line")).checkpoint()  # for both writers

    def store(rows: DataFrame, name: str) -> str:
        rows.repartitionByRange("set_id", *rows.columns[1:]).write.mode("append").partitionBy("set_id").parquet(f"{tables}/{name}")
        return f"{tables}/{name}"

    last = numbers.agg(F.max("set_id")).first()[0]
    if last is None:
        return numbers
    store(rejected_lines(parsed, keep=("set_id",)), "rejects")
    kept = store(good_ranges(parsed, keep=("set_id",)), "input")
    stable = spark.read.schema("set_id bigint, begin bigint, end bigint").parquet(kept).where(F.col("set_id").between(first, last))
    result = exclusive_ranges(stable, target_rows=target_rows).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if verify:
            other = exclusive_by_cutting(stable, target_rows=target_rows)
            cell = {"set_id": F.col("set_id"), "bucket": bucket_of("begin")}
            if n_cells := compared_cells(result, other, cell).where("differs").count():
                raise CrossCheckFailed(f"sets {first} to {last}: the two plans differ in {n_cells} cells")
        store(result, "output")
        if documents and documents.strip():
            write_documents(result, documents, fmt=documents_format)
    finally:
        result.unpersist()
    return numbers
