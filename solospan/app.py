"""Command-line run: text files of ranges -> numbered sets -> published.

    python -m solospan.app --input ranges.txt [--input more.txt] \
        --tables out/ [--documents out/docs] [--listing out/listing] [--strict]

(or ``spark-submit solospan/app.py ...`` on a cluster).

Each input file becomes one set, numbered after the largest set already
stored under ``out/input`` (1 for an empty store).  Every set is published:
its input is stored, its exclusive ranges are computed by two plans and
cross-checked, then stored under ``out/output`` (and as documents when
asked).  Rejected lines (malformed, reversed) are stored with their reason
under ``out/rejects``; ``--strict`` fails on a reversed line instead.
``--listing`` writes the numbered listing of the results.

``--files`` takes every text file of a folder or glob as a set of its own, all
in one plan (``streaming.publish.publish_files``), for many files.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession

from solospan.operators.sets import next_set_id
from solospan.session import ensure_checkpoint_dir
from solospan.sources.sinks import numbered_listing, write_listing
from solospan.sources.text import read_range_text
from solospan.streaming.publish import publish, publish_files, set_folder


def first_free_set_id(spark: SparkSession, input_table: str) -> int:
    """Largest stored set number + 1, or 1 when nothing is stored yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(input_table)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):  # any other failure to read it must be seen
        return 1
    # the folders of stored sets count, also of those without rows
    stored = [int(f.getPath().getName().split("=")[1]) for f in files.listStatus(folder) if f.getPath().getName().startswith("set_id=")]
    return int(next_set_id(spark.createDataFrame([(i,) for i in stored], "set_id int")).first()["next_set_id"])


def run(spark: SparkSession, inputs: list[str], tables: str, documents: str | None = None,
        listing: str | None = None, strict: bool = False) -> list[int]:
    ensure_checkpoint_dir(spark)
    input_table, output_table = os.path.join(tables, "input"), os.path.join(tables, "output")
    set_id = first_free_set_id(spark, input_table)
    published = []
    for path in inputs:
        ranges, rejects = read_range_text(spark, path, strict=strict)
        rejected = set_folder(os.path.join(tables, "rejects"), set_id)
        rejects.select("line", "reason").write.mode("overwrite").parquet(rejected)
        n_rej = spark.read.schema("line string, reason string").parquet(rejected).count()
        if n_rej:
            print(f"Warning: set {set_id}: {n_rej} input lines rejected (see {tables}/rejects)")
        publish(ranges, set_id, input_sink=input_table, output_sink=output_table, documents=documents)
        published.append(set_id)
        set_id += 1
    if listing:
        stored = spark.read.schema("begin bigint, end bigint, set_id int").option("basePath", output_table)
        out = stored.parquet(*[set_folder(output_table, i) for i in published]).select("set_id", "begin", "end")
        write_listing(numbered_listing(out), listing)
    return published


def run_files(spark: SparkSession, path: str, tables: str, documents: str | None = None, listing: str | None = None) -> list[int]:
    """Every text file of ``path`` as one set, numbered behind those stored: one plan for all."""
    input_table, output_table = os.path.join(tables, "input"), os.path.join(tables, "output")
    first = first_free_set_id(spark, input_table)
    numbers = publish_files(spark, path, tables, first, documents=documents)
    n = numbers.count()
    files = spark._jvm.org.apache.hadoop.fs.Path(input_table).getFileSystem(spark._jsc.hadoopConfiguration())
    for i in range(first, first + n):  # a set without rows has its number too
        files.mkdirs(spark._jvm.org.apache.hadoop.fs.Path(set_folder(input_table, i)))
    if listing and n:
        out = spark.read.schema("set_id int, begin bigint, end bigint").parquet(output_table)
        write_listing(numbered_listing(out.where(f"set_id between {first} and {first + n - 1}")), listing)
    return list(range(first, first + n))


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    what = ap.add_mutually_exclusive_group(required=True)
    what.add_argument("--input", action="append", help="text file (or glob) of ranges; one set each")
    what.add_argument("--files", help="folder (or glob) of text files; one set each file, all in one plan")
    ap.add_argument("--tables", required=True, help="folder of the input/ and output/ range tables")
    ap.add_argument("--documents", help="folder for result documents (json)")
    ap.add_argument("--listing", help="folder for the numbered listing of the results")
    ap.add_argument("--strict", action="store_true", help="fail on a reversed line")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName("solospan").getOrCreate()
    if args.files:
        print(f"published sets {run_files(spark, args.files, args.tables, args.documents, args.listing)}")
        return
    ids = run(spark, args.input, args.tables, args.documents, args.listing, args.strict)
    print(f"published sets {ids}")


if __name__ == "__main__":
    main()
