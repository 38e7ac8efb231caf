"""Running sums and neighbours along sorted partitions, and the carry between them.

A partition whose rows are sorted by (keys, order) is swept once, batch by
batch: inclusive running sums of a group, its largest and second largest values
so far (tops), the values of its next row (leads) and of the one before (lags),
all counted from where the group begins *in this
partition*.  A group's rows in one partition are a piece.  Only the first and
the last piece of a partition (or file) can go on in another one; for these two an edge
row is put out with the piece's totals, its first row and its last values.  The
edges, two rows for each partition at most, give the carry of each piece by a
window over them.

Spark has no running sum along a partition as it lies (a window would exchange
the rows by its keys first), so the sweep is numpy on Arrow batches; it holds
one batch and the row before it.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# the sweep travels to the executors by value, so the package need not be installed there
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PIECE, EDGE, FIRST, LAST = "_sw_piece", "_sw_edge", "_sw_first", "_sw_last"
# a piece is numbered by its partition, its segment (file) there and its place in that
PARTITION_SHIFT, SEGMENT_SHIFT = 40, 28

Tops = dict[tuple[str, str], str]


def _starts(batch: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    """For each row but the first whether its keys differ from those of the row before (null is a key)."""
    n = batch.num_rows
    differs = np.zeros(n - 1, bool)
    for k in keys:
        c = batch.column(k)
        a, b = c.slice(0, n - 1), c.slice(1)
        unequal = pc.fill_null(pc.not_equal(a, b), False).to_numpy(zero_copy_only=False)
        nulls = c.is_null().to_numpy(zero_copy_only=False)
        differs |= unequal | (nulls[1:] != nulls[:-1])
    return differs


def _running(v: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums from the start of each group; ``starts`` are positions, the first row always is one."""
    with np.errstate(over="ignore"):
        c = np.cumsum(v)
        if np.abs(np.cumsum(v.astype(np.float64))).max() > 9e18:
            raise OverflowError("a running sum does not fit BIGINT")
        before = np.r_[0, c[starts[1:] - 1]]
        return c - np.repeat(before, np.diff(starts, append=len(v)))


def _neighbours(values: pa.Array, same: np.ndarray, step: int) -> pa.Array:
    """For each neighbouring pair of rows the value of the second (``step`` 1) or first (0), null if their groups differ."""
    return values.take(pa.array(np.arange(step, len(same) + step), mask=~same))


NOTHING = np.iinfo(np.int64).min  # no value yet


def _running_max(v: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Largest values from the start of each group, by ranks that grow from group to group."""
    order = np.argsort(v, kind="stable")
    rank = np.empty(len(v), np.int64)
    rank[order] = np.arange(len(v))
    group = np.repeat(np.arange(len(starts)), np.diff(starts, append=len(v))) * len(v)
    return v[order[np.maximum.accumulate(rank + group) - group]]


def _or_null(v: np.ndarray) -> pa.Array:
    return pa.array(v, mask=v == NOTHING)


def _values(column: pa.Array) -> np.ndarray:
    return pc.fill_null(column.cast(pa.int64()), int(NOTHING)).to_numpy(zero_copy_only=False)


class _Sweep:
    """One partition; ``sums`` and the like as for :func:`sweep`, ``order`` if the rows are to be checked."""

    def __init__(self, keys: list[str], sums: dict[str, str], leads: dict[str, str], lags: dict[str, str], tops: Tops, order: list[str], piece: int):
        self.keys, self.sums, self.leads, self.lags, self.tops, self.order = keys, sums, leads, lags, tops, order
        self.totals = [*sums, *[n for pair in tops for n in pair]]
        self.piece = piece
        self.held: pa.RecordBatch | None = None  # the last row, with sums and lags, whose next row is not known yet
        self.edges: list[dict] = []  # first piece, and the piece that is under way

    def batch(self, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        names = rows.schema.names
        extra = 0 if self.held is None else 1
        if self.held is not None:
            plain = self.held.select(names)
            rows = pa.Table.from_batches([plain, rows.cast(plain.schema)]).combine_chunks().to_batches()[0]
        differs = np.r_[not extra, _starts(rows, self.keys)]  # row 0 goes on with the held row's piece
        starts = np.flatnonzero(np.r_[True, differs[1:]])
        piece = self.piece + np.cumsum(differs[1:], dtype=np.int64)
        piece = np.r_[self.piece, piece]
        out: dict[str, pa.Array] = dict(zip(names, rows.columns, strict=True))
        for name, source in self.sums.items():
            v = pc.fill_null(rows.column(source).cast(pa.int64()), 0).to_numpy(zero_copy_only=False)
            if extra:
                v = np.r_[self.held.column(name)[0].as_py(), v[1:]]  # what the held row's running sum has already
            out[name] = pa.array(_running(v, starts))
        for (name, second), source in self.tops.items():
            v = _values(rows.column(source))
            if extra:
                v = np.r_[_values(self.held.column(name)), v[1:]]
            largest = _running_max(v, starts)
            beaten = np.minimum(v, np.r_[NOTHING, largest[:-1]])  # the smaller of a value and the largest before it
            beaten[starts] = NOTHING
            if extra:
                beaten[0] = _values(self.held.column(second))[0]
            out[name], out[second] = _or_null(largest), _or_null(_running_max(beaten, starts))
        same = ~differs[1:]
        if self.order:
            self._check(rows, same)
        for name, source in self.lags.items():
            c = rows.column(source)
            first = self.held.column(name) if extra else pa.nulls(1, c.type)
            out[name] = pa.concat_arrays([first, _neighbours(c, same, 0)])
        firsts = differs.copy()
        if extra:
            firsts[0] = self.held.column(FIRST)[0].as_py()
        out[FIRST] = pa.array(firsts)
        self._edges(rows, out, np.flatnonzero(differs), piece)
        for name, source in self.leads.items():
            out[name] = _neighbours(rows.column(source), same, 1)
        n = rows.num_rows - 1
        if n:
            done = {k: v.slice(0, n) for k, v in out.items()}
            done |= {PIECE: pa.array(piece[:n]), EDGE: pa.array(np.zeros(n, bool)), LAST: pa.array(differs[1:])}
            yield pa.RecordBatch.from_pydict(done)
        self.held = pa.RecordBatch.from_pydict({k: v.slice(n, 1) for k, v in out.items() if k not in self.leads})
        self.piece = int(piece[n])

    def _check(self, rows: pa.RecordBatch, same: np.ndarray) -> None:
        """Fail on a row that is before the one above it by keys and order (nulls come first)."""
        level = np.ones(len(same), bool)  # equal so far
        for name in [*self.keys, *self.order]:
            c = rows.column(name)
            a, b = c.slice(0, len(same)), c.slice(1)
            null = c.is_null().to_numpy(zero_copy_only=False)
            after = pc.fill_null(pc.greater(a, b), False).to_numpy(zero_copy_only=False) | (~null[:-1] & null[1:])
            if (bad := np.flatnonzero(level & after)).size:
                i = int(bad[0])
                raise ValueError(f"Order violation: {rows.slice(i, 1).to_pylist()[0]} before {rows.slice(i + 1, 1).to_pylist()[0]}")
            level &= pc.fill_null(pc.equal(a, b), False).to_numpy(zero_copy_only=False) | (null[:-1] & null[1:])

    def _edges(self, rows: pa.RecordBatch, out: dict[str, pa.Array], begins: np.ndarray, piece: np.ndarray) -> None:
        """Note the pieces that begin here: their first row, and for the one before its end."""
        if len(begins) > 0:
            if len(self.edges) == 1 and begins[0] > 0:
                self._end(self.edges[0], rows, out, int(begins[0]) - 1)
            fresh = [begins[0], begins[-1]] if not self.edges and len(begins) > 1 else [begins[-1]]
            if not self.edges and len(fresh) > 1:
                first = self._begin(rows, int(begins[0]), int(piece[begins[0]]))
                self._end(first, rows, out, int(begins[1]) - 1)
                self.edges = [first]
            del self.edges[1:]
            self.edges.append(self._begin(rows, int(begins[-1]), int(piece[begins[-1]])))
        self._end(self.edges[-1], rows, out, rows.num_rows - 1)  # as far as is known

    def _begin(self, rows: pa.RecordBatch, at: int, piece: int) -> dict:
        return {"row": rows.slice(at, 1), "piece": piece}

    def _end(self, edge: dict, rows: pa.RecordBatch, out: dict[str, pa.Array], at: int) -> None:
        edge["totals"] = {name: out[name].slice(at, 1) for name in self.totals}
        edge["last"] = {name: rows.column(source).slice(at, 1) for name, source in self.lags.items()}

    def finish(self) -> Iterator[pa.RecordBatch]:
        if self.held is None:
            return
        last = dict(zip(self.held.schema.names, self.held.columns, strict=True))
        nothing = {name: pa.nulls(1, last[source].type) for name, source in self.leads.items()}
        flags = {PIECE: pa.array([self.piece]), EDGE: pa.array([False]), LAST: pa.array([True])}
        yield pa.RecordBatch.from_pydict(last | nothing | flags)
        for edge in self.edges:
            row = dict(zip(edge["row"].schema.names, edge["row"].columns, strict=True))
            flags = {PIECE: pa.array([edge["piece"]]), EDGE: pa.array([True]), FIRST: pa.array([False]), LAST: pa.array([False])}
            yield pa.RecordBatch.from_pydict(row | edge["totals"] | nothing | edge["last"] | flags)


def _segments(batch: pa.RecordBatch, segment: str | None) -> Iterator[tuple[object, pa.RecordBatch]]:
    """The batch in stretches of one segment, without that column."""
    if segment is None:
        yield None, batch
        return
    at = [0, *(np.flatnonzero(_starts(batch, [segment])) + 1).tolist(), batch.num_rows]
    names = [n for n in batch.schema.names if n != segment]
    for a, b in zip(at, at[1:], strict=False):
        yield batch.column(segment)[a].as_py(), batch.slice(a, b - a).select(names)


def sweep(
    rows: DataFrame,
    keys: list[str],
    sums: dict[str, str],
    leads: dict[str, str],
    lags: dict[str, str],
    tops: Tops | None = None,
    order: list[str] | None = None,
    segment: str | None = None,
) -> DataFrame:
    """``rows`` (partitions sorted by keys and order) with sums, tops, leads and lags within their pieces, and the edge rows.

    ``tops`` maps (name of the largest, name of the second largest) to a column
    of integers.  With ``order`` a row that is out of order fails the job.
    ``segment`` names a column (the file, say) each of whose stretches is sorted
    by itself: a partition of several is swept stretch by stretch; the column is
    dropped."""
    tops = tops or {}
    kept = [f for f in rows.schema.fields if f.name != segment]
    types = {f.name: f.dataType for f in kept}
    fields = [T.StructField(f.name, f.dataType) for f in kept]
    fields += [T.StructField(name, T.LongType()) for name in [*sums, *[n for pair in tops for n in pair]]]
    fields += [T.StructField(name, types[source]) for name, source in [*leads.items(), *lags.items()]]
    fields += [T.StructField(PIECE, T.LongType()), *[T.StructField(c, T.BooleanType()) for c in (EDGE, FIRST, LAST)]]
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here: object = None
        state, n = None, 0
        for whole in batches:
            for of, batch in _segments(whole, segment) if whole.num_rows else ():
                if state is None or of != here:
                    if state is not None:
                        yield from (out.select(names) for out in state.finish())
                    base = (TaskContext.get().partitionId() << PARTITION_SHIFT) + (n << SEGMENT_SHIFT)  # type: ignore[union-attr]
                    state, here, n = _Sweep(keys, sums, leads, lags, tops, order or [], base), of, n + 1
                yield from (out.select(names) for out in state.batch(batch))
        if state is not None:
            yield from (out.select(names) for out in state.finish())

    return rows.mapInArrow(run, T.StructType(fields))


def _larger(a: Column, b: Column) -> Column:
    return F.greatest(a, b)  # of one value and a null the value


def _second(a1: Column, a2: Column, b1: Column, b2: Column) -> Column:
    """The second largest of two groups from the two largest of each (null: there is none)."""
    return F.greatest(a2, b2, F.when(a1.isNotNull() & b1.isNotNull(), F.least(a1, b1)))


def carried(
    swept: DataFrame, keys: list[str], order: list[str], sums: dict[str, str], leads: dict[str, str], lags: dict[str, str], tops: Tops | None = None
) -> DataFrame:
    """The rows of a *stored* sweep with what their pieces take over from the pieces before and behind.

    ``swept`` is read twice, so it must be rows that stay as they are (a
    checkpoint): read anew from an exchange, pieces could be cut elsewhere.
    """
    tops = tops or {}
    w = Window.partitionBy(*keys).orderBy(*order, PIECE)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    # two rows for each partition at most
    edges = swept.where(EDGE)
    for i, (one, two) in enumerate(tops):
        edges = edges.withColumn(f"_sw_o{i}", F.max(one).over(before))
        edges = edges.withColumn(f"_sw_b{i}", _second(F.col(one), F.col(two), F.col(f"_sw_o{i}"), F.lit(None).cast("bigint")))
        edges = edges.withColumn(f"_sw_t{i}", F.max(f"_sw_b{i}").over(before))
    carry = edges.select(
        F.col(PIECE).alias("_sw_of"),
        *[F.sum(name).over(before).alias(f"_sw_s_{name}") for name in sums],
        *[F.lead(source).over(w).alias(f"_sw_n_{name}") for name, source in leads.items()],
        *[F.lag(name).over(w).alias(f"_sw_p_{name}") for name in lags],
        *[c for i in range(len(tops)) for c in (f"_sw_o{i}", f"_sw_t{i}")],
    )
    d = swept.where(~F.col(EDGE)).join(F.broadcast(carry), F.col(PIECE) == F.col("_sw_of"), "left")
    made = {*sums, *leads, *lags, *[n for pair in tops for n in pair], PIECE, EDGE, FIRST, LAST}
    return d.select(
        *[c for c in swept.columns if c not in made],
        *[(F.col(n) + F.coalesce(F.col(f"_sw_s_{n}"), F.lit(0))).alias(n) for n in sums],
        *[
            c
            for i, (one, two) in enumerate(tops)
            for c in (
                _larger(F.col(one), F.col(f"_sw_o{i}")).alias(one),
                _second(F.col(one), F.col(two), F.col(f"_sw_o{i}"), F.col(f"_sw_t{i}")).alias(two),
            )
        ],
        *[F.when(F.col(LAST), F.col(f"_sw_n_{n}")).otherwise(F.col(n)).alias(n) for n in leads],
        *[F.when(F.col(FIRST), F.col(f"_sw_p_{n}")).otherwise(F.col(n)).alias(n) for n in lags],
    )


def check_files(swept: DataFrame, keys: list[str], order: list[str]) -> None:
    """Raise if the rows of one segment of ``swept`` (stored) reach into those of another.

    Along (keys, order) of their first rows the edges of a segment must
    follow each other: two rows for each segment at most are compared."""
    w = Window.orderBy(*keys, *order, PIECE)
    part = F.shiftright(F.col(PIECE), SEGMENT_SHIFT)
    met = swept.where(EDGE).select(part.alias("_p"), F.lag(part).over(w).alias("_q"))
    torn = met.where("_q is null or _p <> _q").groupBy("_p").count().where("count > 1")
    if n := torn.count():
        raise ValueError(f"Order violation: files overlap ({n} of them)")
