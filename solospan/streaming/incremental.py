"""Exclusive ranges kept up to date batch by batch (S2.I1).

A store keeps, for each (set, bucket of coordinates), the endpoint counts at
every coordinate with the running level *inside that cell* and the next
coordinate of the cell, and a summary of the cell (its net change and first
coordinate).  Both depend on the cell's own rows only.  What a cell needs from
the cells before it, the carried level, and from the next one, its first
coordinate, is a window over the summaries, a row for each cell.

So a batch reads and rewrites only the buckets in which its ranges begin or
end; the carries behind them follow from the summaries.  Reading the exclusive
ranges is a scan of the stored cells joined with the carries: no sort and no
shuffle of the endpoints.

Writes are committed as a whole (:mod:`solospan.sources.committed`): a batch
that fails leaves the old state, a batch that is replayed changes nothing.
Ranges can be taken back by a batch with ``retract=True``; a coordinate at
which nothing begins or ends any more disappears.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from solospan.functions.buckets import IP4_BUCKET_WIDTH, bucket_of
from solospan.operators.events import half_open_events
from solospan.plans.scan import ordered_scan, scan_plan
from solospan.session import ensure_checkpoint_dir
from solospan.sources.committed import Commit, CommittedTable
from solospan.sources.text import good_ranges, parse_range_lines


class RangeStore:
    """Sets of ranges under ``path``; ``keys`` name the columns of a set's number with their types."""

    def __init__(self, spark: SparkSession, path: str, width: int = IP4_BUCKET_WIDTH, keys: str = "set_id bigint", target_rows: int | None = None):
        self.spark, self.width, self.target_rows = spark, width, target_rows
        self.keys = T.StructType.fromDDL(keys).fieldNames() if keys else []
        lead = f"{keys}, " if keys else ""
        self.cells = CommittedTable(spark, f"{path}/cells", f"{lead}x bigint, starts bigint, ends bigint, level bigint, next_x bigint, bucket bigint")
        self.sums = CommittedTable(spark, f"{path}/sums", f"{lead}net bigint, first_x bigint, bucket bigint")

    # -- writing

    def apply(self, ranges: DataFrame, batch: int, source: str = "batches", begin: str = "begin", end: str = "end", retract: bool = False) -> bool:
        """Take in (or back) the ranges of a batch; False if this batch of ``source`` was taken in before.

        Ranges with a NULL bound or ``begin > end`` cover no point and are left
        out.  ``batch`` numbers of a source must grow.
        """
        before = self.cells.state()
        if batch <= before.taken.get(source, -1):
            self._follow(before)  # the summaries, if the last run stopped between the two commits
            return False
        sign = -1 if retract else 1
        ev = half_open_events(ranges, self.keys, begin, end, valid_only=True)
        counts = [F.sum(F.col(c) * sign).alias(c) for c in ("starts", "ends")]
        here = [*self.keys, "bucket", "x"]
        ensure_checkpoint_dir(self.spark)
        new = ev.withColumn("bucket", bucket_of("x", self.width)).groupBy(*here).agg(*counts).checkpoint()
        touched = self.touched_parts(new)
        old = self.cells.read(touched, before).select(*here, "starts", "ends")
        merged = old.unionByName(new.select(*here, "starts", "ends")).groupBy(*here).agg(F.sum("starts").alias("starts"), F.sum("ends").alias("ends"))
        merged = merged.where("starts <> 0 or ends <> 0").withColumn("delta", F.col("starts") + F.col("ends"))
        cell = [*self.keys, "bucket"]
        plan = scan_plan(merged, cell, "x", "auto", target_rows=self.target_rows)
        swept = ordered_scan(merged, cell, ["x"], sums={"level": "delta"}, leads={"next_x": "x"}, plan=plan).drop("delta")
        # a bucket's rows are written by a few tasks, in order
        version = self.cells.stage(swept.repartitionByRange("bucket", *self.keys, "x").sortWithinPartitions("bucket", *self.keys, "x"), "bucket")
        after = self.cells.commit(before, version, touched, source, batch)
        self._follow(after)
        return True

    @staticmethod
    def touched_parts(events: DataFrame) -> list[str]:
        """The parts that a batch's events lie in: bucket numbers, as many as folders to rewrite."""
        return [f"bucket={r.bucket}" for r in events.select("bucket").distinct().toLocalIterator()]

    def _follow(self, state: Commit) -> None:
        """Bring the summaries to the cells' state: those of the parts with another version."""
        have = self.sums.state()
        behind = [p for p in state.parts.keys() | have.parts.keys() if have.parts.get(p) != state.parts.get(p)]
        if not behind:
            return
        rows = self.cells.read(behind, state)
        sums = rows.groupBy(*self.keys, "bucket").agg(F.sum(F.col("starts") + F.col("ends")).alias("net"), F.min("x").alias("first_x"))
        for version in {state.parts.get(p) for p in behind} - {None}:
            # a summary has its cells' version, so that a run that stopped half way is seen
            mine = [int(p.split("=")[1]) for p in behind if state.parts.get(p) == version]
            self.sums._files.delete(self.sums._at(f"data/v={version}"), True)
            self.sums.stage(sums.where(F.col("bucket").isin(mine)).repartitionByRange("bucket"), "bucket", version)
            have = self.sums.commit(have, version, [f"bucket={b}" for b in mine])
        gone = [p for p in behind if p not in state.parts]
        if gone:
            self.sums.commit(have, "none", gone)

    # -- reading

    def carries(self) -> DataFrame:
        """For each cell the level carried into it and the first coordinate behind it."""
        w = Window.partitionBy(*self.keys).orderBy("bucket")
        before = F.sum("net").over(w.rowsBetween(Window.unboundedPreceding, -1))
        return self.sums.read().select(*self.keys, "bucket", F.coalesce(before, F.lit(0)).alias("carried"), F.lead("first_x").over(w).alias("after"))

    def coverage(self) -> DataFrame:
        """``keys, point, depth, next_point`` as ``coverage_depth`` gives them for all ranges taken in."""
        cells, carries = self.cells.read(), self.carries()
        carries = carries.select(*[F.col(c).alias(f"_c_{c}") for c in [*self.keys, "bucket"]], "carried", "after")
        cond = F.lit(True)
        for c in [*self.keys, "bucket"]:
            cond = cond & cells[c].eqNullSafe(carries[f"_c_{c}"])
        return cells.join(carries, cond, "left").select(
            *self.keys,
            F.col("x").alias("point"),
            (F.col("level") + F.col("carried")).alias("depth"),
            F.coalesce("next_x", "after").alias("next_point"),
        )

    def exclusive_ranges(self, begin: str = "begin", end: str = "end") -> DataFrame:
        """The parts that exactly one of the ranges taken in covers."""
        return self.coverage().where("depth = 1").select(*self.keys, F.col("point").alias(begin), (F.col("next_point") - 1).alias(end))

    def vacuum(self) -> None:
        self.cells.vacuum()
        self.sums.vacuum()

    def drop(self) -> None:
        self.cells.drop()
        self.sums.drop()


def foreach_batch_updater(store: RangeStore, set_of: Callable[[DataFrame], DataFrame], source: str = "stream", line: str = "value") -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function for a stream of text lines: each micro-batch's good ranges are taken in once.

    ``set_of`` adds the columns of the set's number to the parsed rows.
    """

    def body(batch: DataFrame, epoch_id: int) -> None:
        parsed = parse_range_lines(batch.withColumnRenamed(line, "line"))
        keep = [c for c in parsed.columns if c not in ("line", "begin", "end", "reason")]
        store.apply(set_of(good_ranges(parsed, keep=keep)), epoch_id, source)

    return body
