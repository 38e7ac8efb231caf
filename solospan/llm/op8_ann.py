"""Approximate nearest neighbours by learned partitions.

On a bounded sample of the vectors, the graph of exact nearest neighbours is
cut into balanced parts: seeded by a capacity-bounded clustering, then improved
by moving vertices to the part of most of their neighbours while sizes stay
within ``SLACK``.  A small neural network learns, for each sample vector, in
which parts its neighbours are.  Every row of the table is filed under its most
probable part; a query goes to its most probable parts, as many as give the
sample ``target_recall`` of its true neighbours, and is ranked there against
all vectors exactly.

A part of any size is dealt to blocks of about ``block_rows``, the queries sent
to it to chunks, and each block meets each chunk in a task of its own, which
returns a query's best ``k`` only.

Defined results: vectors that are null, zero, of another length than most, or
hold null or non-finite components take no part, nor do rows without an id;
rows that repeat an id are neighbours each for itself (never of their own id);
equal scores rank by id; fewer candidates than ``k`` are all returned; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from solospan.llm.common import checkpointed, map_batches
from solospan.llm.vectors import best, packed, unpacked, valid_vectors

SLACK = 1.05


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The k nearest others of each row by inner product."""
    out = np.zeros((len(x), min(k, len(x) - 1)), np.int64)
    for at in range(0, len(x), 1024):
        s = x[at : at + 1024] @ x.T
        s[np.arange(len(s)), np.arange(at, at + len(s))] = -np.inf
        out[at : at + 1024] = np.argpartition(-s, out.shape[1] - 1, axis=1)[:, : out.shape[1]] if out.shape[1] else 0
    return out


def balanced_partition(x: np.ndarray, graph: np.ndarray, parts: int, seed: int = 8, sweeps: int = 12) -> np.ndarray:
    """A part for each vertex; no part has more than ``SLACK`` times its even share."""
    rng = np.random.default_rng(seed)
    n, most = len(x), int(np.ceil(SLACK * len(x) / parts))
    centres = x[rng.choice(n, parts, replace=False)]
    label = np.zeros(n, np.int64)
    for _ in range(8):
        s = x @ centres.T
        size, label = np.zeros(parts, np.int64), np.full(n, -1)
        ranked = np.argsort(-s, axis=1)
        for v in np.argsort(-(np.take_along_axis(s, ranked[:, :1], 1)[:, 0])):
            for p in ranked[v]:
                if size[p] < most:
                    label[v], size[p] = p, size[p] + 1
                    break
        centres = np.stack([x[label == p].mean(axis=0) if (label == p).any() else centres[p] for p in range(parts)])
    source = np.r_[np.repeat(np.arange(n), graph.shape[1]), graph.ravel()]
    other = np.r_[graph.ravel(), np.repeat(np.arange(n), graph.shape[1])]
    for _ in range(sweeps):
        links = np.bincount(source * parts + label[other], minlength=n * parts).reshape(n, parts)
        wish = links.argmax(axis=1)
        gain = links[np.arange(n), wish] - links[np.arange(n), label]
        size, moved = np.bincount(label, minlength=parts), 0
        for v in np.argsort(-gain, kind="stable")[: int((gain > 0).sum())]:
            if size[wish[v]] < most:
                size[label[v]] -= 1
                size[wish[v]] += 1
                label[v], moved = wish[v], moved + 1
        if not moved:
            break
    return label


@dataclass
class Router:
    """A network with one hidden layer; ``probes`` is the number of parts a query visits."""

    layers: list[np.ndarray]
    probes: int = 1

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        s = np.maximum(x @ w1 + b1, 0) @ w2 + b2
        e = np.exp(s - s.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def parts(self, x: np.ndarray, n: int) -> np.ndarray:
        return np.argsort(-self.probabilities(x), axis=1, kind="stable")[:, :n]


def fit_router(x: np.ndarray, wanted: np.ndarray, hidden: int = 64, epochs: int = 30, rate: float = 2e-3, seed: int = 9) -> Router:
    """Cross-entropy with the shares ``wanted``, by Adam."""
    rng = np.random.default_rng(seed)
    d, parts = x.shape[1], wanted.shape[1]
    scale = 1 / np.sqrt((x * x).mean() * d + 1e-30)
    layers = [rng.standard_normal((d, hidden)) * scale, np.zeros(hidden), rng.standard_normal((hidden, parts)) / np.sqrt(hidden), np.zeros(parts)]
    first, second, t = [np.zeros_like(p) for p in layers], [np.zeros_like(p) for p in layers], 0
    rates = [rate * scale, rate, rate, rate]
    router = Router(layers)
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(order), 256):
            i = order[at : at + 256]
            h = np.maximum(x[i] @ layers[0] + layers[1], 0)
            ds = (router.probabilities(x[i]) - wanted[i]) / len(i)
            dh = (ds @ layers[2].T) * (h > 0)
            t += 1
            for j, g in enumerate((x[i].T @ dh, dh.sum(axis=0), h.T @ ds, ds.sum(axis=0))):
                first[j] = 0.9 * first[j] + 0.1 * g
                second[j] = 0.999 * second[j] + 0.001 * g * g
                layers[j] -= rates[j] * (first[j] / (1 - 0.9**t)) / (np.sqrt(second[j] / (1 - 0.999**t)) + 1e-12)
    return router


def learn_router(x: np.ndarray, parts: int, k: int, target_recall: float) -> Router:
    """Partition the neighbour graph of the sample, train the classifier, choose the number of parts to visit."""
    parts = max(1, min(parts, len(x) // 32))
    graph = neighbour_graph(x, 10)
    label = balanced_partition(x, graph, parts)
    # a vector's own part counts as well: rows are filed by the same network
    near = np.c_[label[graph], label]
    wanted = np.stack([(near == p).mean(axis=1) for p in range(parts)], axis=1)
    router = fit_router(x, wanted)
    filed, visits = router.parts(x, 1)[:, 0], router.parts(x, parts)
    true = neighbour_graph(x, k)
    position = np.argsort(visits, axis=1)
    if true.size:
        reached = np.take_along_axis(position, filed[true], axis=1)
        recall = [(reached < m).mean() for m in range(1, parts + 1)]
        router.probes = next((m for m, r in enumerate(recall, 1) if r >= target_recall), parts)
    return router


def rank_pairs(queries: np.ndarray, query_ids: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[int, int, float]]:
    """(query, vec_id, score): the k best others of each query.

    The products are first taken in blocks; those near the k-th are taken
    again one by one, so that equal vectors get equal scores.
    """
    out = []
    scores = queries @ x.T
    scores[query_ids[:, None] == ids[None, :]] = -np.inf
    slack = 1e-9 * (1 + np.abs(np.where(np.isfinite(scores), scores, 0)).max(initial=0.0))
    for q, query in enumerate(queries):
        s = scores[q]
        least = np.partition(s, len(s) - k)[len(s) - k] - slack if len(s) > k else -np.inf
        place = np.flatnonzero((s >= least) & (s > -np.inf))
        exact = np.sum(x[place] * query, axis=1)
        for j in best(exact, ids[place], k):
            out.append((int(query_ids[q]), int(ids[place[j]]), float(exact[j])))
    return out


def nearest(
    table: DataFrame, k: int = 20, query_modulus: int = 20, parts: int = 16, sample_rows: int = 8192, target_recall: float = 0.97, block_rows: int = 8192
) -> DataFrame:
    """query_id, rank, vec_id and score: the k nearest found of each row whose vec_id is divisible by ``query_modulus``."""
    rows = checkpointed(packed(valid_vectors(table).where(F.exists("x", lambda v: v != 0))))
    sample = rows.withColumn("_h", F.xxhash64(F.lit(8), "vec_id", "v")).orderBy("_h").limit(sample_rows).select("v").collect()
    if not sample:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0.0).alias("score")).where("false")
    router = learn_router(unpacked(bytes(r.v) for r in sample), parts, k, target_recall)

    def file(batch: pa.RecordBatch) -> pa.RecordBatch:
        part = router.parts(unpacked(batch.column(1).to_pylist()), 1)[:, 0]
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(part.astype(np.int32))], ["vec_id", "v", "part"])

    def route(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts_of = router.parts(unpacked(batch.column(1).to_pylist()), router.probes).astype(np.int32)
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(parts_of.tolist(), pa.list_(pa.int32()))], ["vec_id", "v", "visits"])

    filed = map_batches(rows, file, "vec_id long, v binary, part int")
    routed = map_batches(rows.where(F.col("vec_id") % query_modulus == 0), route, "vec_id long, v binary, visits array<int>")
    routed = routed.select("vec_id", "v", F.explode("visits").alias("part"))
    # a row for each part at most
    n_blocks = {r.part: -(-r.n // block_rows) for r in filed.groupBy("part").agg(F.count("*").alias("n")).collect()}
    n_chunks = {r.part: -(-r.n // block_rows) for r in routed.groupBy("part").agg(F.count("*").alias("n")).collect()}
    all_parts = range(len(router.layers[3]))
    blocks = F.array(*(F.lit(n_blocks.get(p, 0)) for p in all_parts))[F.col("part")]
    chunks = F.array(*(F.lit(n_chunks.get(p, 0)) for p in all_parts))[F.col("part")]

    def each(n: object) -> object:
        return F.explode(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")))

    block = F.pmod(F.xxhash64("vec_id", F.lit(1)), blocks).cast("int")
    chunk = F.pmod(F.xxhash64("vec_id", F.lit(2)), chunks).cast("int")
    left = filed.select("vec_id", "v", "part", block.alias("block"), each(chunks).alias("chunk"))
    right = routed.select("vec_id", "v", "part", chunk.alias("chunk"), each(blocks).alias("block"))
    unit = ["part", "block", "chunk"]

    def rank(data: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(data) or not len(queries):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        got = []
        x, ids = unpacked(data["v"]), data["vec_id"].to_numpy()
        for at in range(0, len(queries), 512):
            some = queries.iloc[at : at + 512]
            got += rank_pairs(unpacked(some["v"]), some["vec_id"].to_numpy(), x, ids, k)
        return pd.DataFrame(got, columns=["query_id", "vec_id", "score"])

    found = left.groupBy(*unit).cogroup(right.groupBy(*unit)).applyInPandas(rank, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
