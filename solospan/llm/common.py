"""Helpers shared by the training-data operators."""

from __future__ import annotations

import sys
import tempfile
import types
from collections.abc import Callable, Hashable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of characters other than space, tab, LF, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a local session (one machine, as in tests) may go without the
    setting; it gets a scratch folder.  Elsewhere that is an error, since the
    executors could not read the files back.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not sc.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            folder = tempfile.mkdtemp(prefix="solospan-ckpt-")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def plain_names(docs: DataFrame, *kept: str) -> DataFrame:
    """``docs`` with its columns renamed to ``c0``, ``c1``, ... but for the ``kept`` ones.

    So no name of a user's column can clash with one that an operator adds;
    ``toDF(*docs.columns)`` on the columns in their order gives the names back.
    """
    return docs.toDF(*[c if c in kept else f"c{i}" for i, c in enumerate(docs.columns)])


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder of the shared storage."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows of ``df``, kept in the shared folder; later jobs read them there, with no lineage behind."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def other_key(key: Column) -> Column:
    """A bijection of a BIGINT key.

    A join on it gets an exchange of its own on a side that an aggregate has
    already dealt out by the key; adaptive execution can then split the hot
    partitions of both sides.
    """
    return F.bitwise_not(key)


def crc_of_id(doc_id: str) -> Column:
    """crc32 of the id as text; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary"))


def held_out(doc_id: str, modulus: int, remainder: int) -> Column:
    """Whether the id's crc32 has the remainder; a row without an id is held out, as it has no label."""
    return F.coalesce(crc_of_id(doc_id) % modulus == remainder, F.lit(True))


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null as empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def map_batches(df: DataFrame, f: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``f`` on every Arrow batch of ``df``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := f(batch)) is not None:
                yield out

    return df.mapInArrow(run, schema)


def kept_in_worker(key: Hashable, make: Callable[[], Any]) -> Any:
    """What ``make`` returns, made once in a Python worker process and used by its later tasks too.

    Functions of this subpackage travel by value, so a module global would be
    new in every task.  Only what can be made again at any time (a tokenizer, a
    bounded cache) may be kept.
    """
    kept = sys.modules.setdefault("_solospan_kept", types.ModuleType("_solospan_kept")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]
