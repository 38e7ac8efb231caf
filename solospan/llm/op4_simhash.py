"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints of all documents are reduced to the distinct ones.  Distinct
fingerprints that can be within ``max_distance`` bits meet in a bucket: the 64
bits are cut into ``max_distance + 2`` bands, two fingerprints that close agree
on at least two whole bands, and each pair of bands is a key.  In a task the
bucket rows stand sorted, their bits stored as vertical planes (64 rows to a
machine word); comparing every row with the one ``d`` places on is then an
exclusive-or of planes and their shifted copies.  Carry-save counters add up
the differing bits of 64 comparisons at once and saturate past the radius, and
words whose comparisons have all left the radius are abandoned.

A bucket of more than ``block_rows`` fingerprints is cut into blocks and its
pairs of blocks are separate units, so no task gets an unbounded bucket.  A
task emits a spanning forest of the links it found, never all pairs; the
components of the forest's union are those of all links.  They are found with
alternating star contractions (Kiveris et al., "Connected Components in
MapReduce and Beyond"), each round checkpointed.

Defined results: a null text counts as empty; an empty text has fingerprint
zero and is linked like any other; rows with the same id or text are rows of
their own; a null id is never a component's id (a component without any id has
a null one); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from solospan.llm.common import as_bytes, checkpointed, map_batches, other_key, plain_names

SEED = 42
SHINGLES_AT_ONCE = 65536
BATCH_ROWS = 65536


def fingerprint(text: bytes, shingle_words: int = 3) -> int:
    """The 64-bit SimHash of a UTF-8 text."""
    words = text.lower().split()  # of bytes: A-Z only, and exactly the six ASCII blanks
    if not words:
        return 0
    n = max(1, len(words) - shingle_words + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, SHINGLES_AT_ONCE):
        m = min(SHINGLES_AT_ONCE, n - at)
        shingles = zip(*(words[at + i : at + i + m] for i in range(min(shingle_words, len(words)))), strict=False)
        h = np.fromiter((xxhash.xxh64_intdigest(b" ".join(s), SEED) for s in shingles), "<u8", m)
        ones += np.unpackbits(h.view(np.uint8).reshape(m, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def with_fingerprints(df: DataFrame, text: str = "text", shingle_words: int = 3) -> DataFrame:
    """``df`` and a BIGINT column ``_fp``."""

    def add(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = as_bytes(batch.column(batch.schema.get_field_index(text)))
        fps = np.array([fingerprint(t, shingle_words) for t in texts], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(fps)], [*batch.schema.names, "_fp"])

    schema = df.select("*", F.lit(0).cast("long").alias("_fp")).schema
    return map_batches(df, add, schema)


def _planes(fp: np.ndarray, pad: int) -> np.ndarray:
    """Bit planes of the rows: 64 x words, row i at bit i % 64 of word i // 64, with ``pad`` empty words after them."""
    words = -(-len(fp) // 64)
    bits = np.zeros((words * 64, 64), np.uint8)
    bits[: len(fp)] = np.unpackbits(fp.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    planes = np.zeros((64, words + pad), np.uint64)
    planes[:, :words] = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")
    return planes


def _lanes(mask: np.ndarray) -> np.ndarray:
    """A boolean per row as one bit per row, 64 to a word."""
    padded = np.zeros(-(-len(mask) // 64) * 64, np.uint8)
    padded[: len(mask)] = mask
    return np.packbits(padded, bitorder="little").view("<u8")


def _close(planes: np.ndarray, words: np.ndarray, lanes: np.ndarray, d: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Words and lanes of the rows that are within ``radius`` bits of the row ``d`` places on."""
    skip, shift = divmod(d, 64)
    counter_bits = max(1, (radius + 1).bit_length())
    counters = [np.zeros(len(words), np.uint64) for _ in range(counter_bits)]
    past = ~lanes  # lanes that have left the radius or never counted
    for first in range(0, 64, 8):
        for b in range(first, first + 8):
            there = planes[b, words + skip]
            if shift:
                there = (there >> np.uint64(shift)) | (planes[b, words + skip + 1] << np.uint64(64 - shift))
            carry = planes[b, words] ^ there
            for k in range(counter_bits):
                counters[k], carry = counters[k] ^ carry, counters[k] & carry
            reached = ~np.uint64(0) * np.ones(len(words), np.uint64)  # counter at radius + 1: saturate
            for k in range(counter_bits):
                reached &= counters[k] if (radius + 1) >> k & 1 else ~counters[k]
            past |= reached
        alive = past != ~np.uint64(0)
        if not alive.all():
            words, past, counters = words[alive], past[alive], [c[alive] for c in counters]
            if not len(words):
                break
    return words, ~past


def _join(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (smallest row of the component) after joining a[i] with b[i]."""
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        while not np.array_equal(label, nxt := label[label]):
            label = nxt
        if np.array_equal(label, before):
            return label


def bit_sliced_links(unit: np.ndarray, fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links within units; ``unit`` is sorted (equal units stand together)."""
    n = len(fp)
    starts = np.flatnonzero(np.r_[True, unit[1:] != unit[:-1]])
    left = np.repeat(np.r_[starts[1:], n], np.diff(np.r_[starts, n])) - np.arange(n) - 1  # rows of the unit after this one
    longest = int(left.max(initial=0))
    planes = _planes(fp, longest // 64 + 2)
    label, rows = np.arange(n), np.arange(n)
    pend_a: list[np.ndarray] = []
    pend_b: list[np.ndarray] = []
    pending = 0
    for d in range(1, longest + 1):
        rows = rows[left[rows] >= d]
        mask = np.zeros(n, bool)
        mask[rows] = True
        lanes = _lanes(mask)
        words = np.flatnonzero(lanes)
        words, hits = _close(planes, words, lanes[words], d, radius)
        if len(words):
            bits = np.unpackbits(hits.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            w, lane = np.nonzero(bits)
            a = words[w] * 64 + lane
            a = a[label[a] != label[a + d]]
            pend_a.append(a)
            pend_b.append(a + d)
            pending += len(a)
            if pending > 4 * n:
                label = _join(label, np.concatenate(pend_a), np.concatenate(pend_b))
                pend_a, pend_b, pending = [], [], 0
    if pending:
        label = _join(label, np.concatenate(pend_a), np.concatenate(pend_b))
    member = np.flatnonzero(label != np.arange(n))
    return fp[member], fp[label[member]]


def _whole_units(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(unit, fp) arrays of at least BATCH_ROWS rows that end where a unit ends."""
    units: list[np.ndarray] = []
    fps: list[np.ndarray] = []
    for batch in batches:
        units.append(batch.column(0).to_numpy(zero_copy_only=False))
        fps.append(batch.column(1).to_numpy(zero_copy_only=False))
        if sum(map(len, units)) >= BATCH_ROWS:
            u, f = np.concatenate(units), np.concatenate(fps)
            cut = int(np.flatnonzero(u != u[-1])[-1]) + 1 if u[0] != u[-1] else 0
            if cut:
                yield u[:cut], f[:cut]
            units, fps = [u[cut:]], [f[cut:]]
    if units and sum(map(len, units)):
        yield np.concatenate(units), np.concatenate(fps)


def fingerprint_links(distinct: DataFrame, max_distance: int = 2, block_rows: int = 1024) -> DataFrame:
    """Spanning links (a > b) between the distinct BIGINT fingerprints ``fp`` within ``max_distance`` bits."""
    bands = max_distance + 2
    edges = [64 * i // bands for i in range(bands + 1)]
    masks = [sum(1 << b for band in pair for b in range(edges[band], edges[band + 1])) for pair in combinations(range(bands), 2)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keys = F.array(*(F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m).cast("long"))) for i, m in enumerate(signed)))
    rows = distinct.select("fp", F.explode(keys).alias("bucket"))
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select(other_key(F.col("bucket")).alias("key"), "n")
    blocks = F.ceil(F.col("n") / block_rows).cast("int")
    mine = F.pmod(F.xxhash64(F.col("fp"), F.lit(7)), F.col("blocks")).cast("int")
    units = (
        rows.withColumn("key", other_key(F.col("bucket")))
        .join(sizes, "key")
        .select("fp", "bucket", blocks.alias("blocks"))
        .withColumn("mine", mine)
        .select("fp", "bucket", "mine", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        .select(F.xxhash64("bucket", F.least("mine", "other"), F.greatest("mine", "other")).alias("unit"), "fp")
    )

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for unit, fp in _whole_units(batches):
            a, b = bit_sliced_links(unit, fp, max_distance)
            yield pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], ["a", "b"])

    return units.repartition("unit").sortWithinPartitions("unit").mapInArrow(link, "a long, b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of the graph of the links (a > b): root is the smallest node reachable; roots themselves are left out."""
    edges = checkpointed(links)
    previous = None
    while True:
        # large star: every larger neighbour of a node is tied to the node's smallest one
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(other_key(F.col("a")).alias("k"), F.least("a", "m").alias("m"))
        large = both.withColumn("k", other_key(F.col("a"))).join(low, "k").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: a node and its smaller neighbours are tied to the smallest of them
        low = large.groupBy("a").agg(F.min("b").alias("m")).select(other_key(F.col("a")).alias("k"), "m")
        tied = large.withColumn("k", other_key(F.col("a"))).join(low, "k")
        small = tied.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(tied.select("a", F.col("m").alias("b")))
        edges = checkpointed(small.distinct())
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == previous:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        previous = state


def fingerprint_components(fps: DataFrame, doc_id: str = "doc_id", max_distance: int = 2) -> DataFrame:
    """(fp, root, component_id) of every distinct ``_fp``; component_id is the smallest id of its component."""
    distinct = checkpointed(fps.groupBy(F.col("_fp").alias("fp")).agg(F.min(doc_id).alias("rep")))
    roots = components(fingerprint_links(distinct.select("fp"), max_distance))
    rooted = distinct.join(roots, distinct.fp == roots.node, "left").select("fp", "rep", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("rep").alias("component_id")).select(other_key(F.col("root")).alias("k"), "component_id")
    return checkpointed(rooted.withColumn("k", other_key(F.col("root"))).join(least, "k").select("fp", "root", "component_id"))


def simhash_components(docs: DataFrame, shingle_words: int = 3, max_distance: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row of ``docs`` (doc_id, text)."""
    fps = checkpointed(with_fingerprints(docs.select("doc_id", "text"), shingle_words=shingle_words).select("doc_id", "_fp"))
    found = fingerprint_components(fps, max_distance=max_distance)
    hexed = F.lower(F.lpad(F.hex("_fp"), 16, "0"))
    return fps.join(found, fps._fp == found.fp).select("doc_id", hexed.alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, shingle_words: int = 3, max_distance: int = 2) -> DataFrame:
    """``docs`` with one row of every component: the smallest id; of rows that repeat it, the least by all columns.

    All columns come back as they are, whatever their names.  A null text counts
    as empty, and all empty texts are one component; rows without an id stay
    only where a whole component has none; an empty table stays empty.
    """
    plain = plain_names(docs, "doc_id", "text")
    marked = with_fingerprints(plain, shingle_words=shingle_words)
    found = fingerprint_components(checkpointed(marked.select("doc_id", "_fp")), max_distance=max_distance)
    kept = marked.join(found.withColumnRenamed("fp", "_fp"), "_fp").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    one = kept.groupBy("root").agg(F.min(F.struct(*plain.columns)).alias("row"))
    return one.select("row.*").toDF(*docs.columns)
