"""Exact top-k by inner product: dual-tree search on cover trees.

Rows and queries are dealt to cells around far-apart centres (the top level of
the trees), cells to blocks of bounded size.  A block's rows stand in a cover
tree: children lie within a radius that shrinks by ``BASE`` at every level,
and centres of siblings are farther apart than it.  So do a group's queries.

For a query node (centre a, radius r) and a data node (centre b, radius s) no
inner product exceeds ``a.b + r |b| + s |a| + r s``.  A pair of nodes is
dropped as soon as that bound is below the worst k-th score of the node's
queries.  First each group meets the blocks of its own cells, which gives
those k-th scores; then pairs of groups and blocks are tested by their roots
alone, and only the pairs that survive bring their rows together, where the
trees are walked down.  Pruning is by strict inequality, so ties are kept and
the result is exact.

Vectors are turned into the integers floor(1024 * x).  A product of two whose
norms multiply to less than 2^52 is exact in doubles.  Others are searched
with an upper bound that allows for the rounding, and what passes it is scored
again in integers, so that components of any size take part.

Defined results: vectors that are null or empty, hold null or non-finite
components, or another length than most take no part, nor do rows without an
id (a zero vector does take part); as in the SQL, a scaled component that no
BIGINT holds fails the query, and so does a score to be returned that none
holds;
rows that repeat an id are candidates each for itself (never of their own id);
equal scores rank by id; fewer candidates than k are all returned; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from solospan.llm.common import checkpointed, map_batches
from solospan.llm.vectors import best, matrix, packed, unpacked, valid_vectors

BASE = 1.3
LEAF = 64
SCALE = 1024
EXACT = 2.0**52  # norms that multiply to less have products, and partial sums, that doubles hold
BIGGEST = (1 << 63) - 1


def distances(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(((x - centre) ** 2).sum(axis=1), 0))


@dataclass
class Node:
    centre: np.ndarray
    radius: float
    rows: np.ndarray
    children: list[Node]


def cover_tree(x: np.ndarray, leaf: int = LEAF) -> Node:
    """A cover tree over the rows of x; small siblings share a leaf around their parent's centre."""

    def node(rows: np.ndarray, centre: np.ndarray) -> Node:
        d = distances(x[rows], centre)
        radius = float(d.max())
        if len(rows) <= leaf or radius == 0:
            return Node(centre, radius, rows, [])
        reach, left, children, small = radius / BASE, rows, [], []
        while len(left):
            d = distances(x[left], x[left[0]])
            inside = d <= reach
            members = left[inside]
            if len(members) == len(rows):  # the first row alone covers all: go on one level down
                reach /= BASE
                continue
            if len(members) > leaf:
                children.append(node(members, x[members].mean(axis=0)))
            else:
                small.append(members)
            left = left[~inside]
        bundle: list[np.ndarray] = []
        for members in small:
            if bundle and sum(map(len, bundle)) + len(members) > leaf:
                children.append(bundled(bundle))
                bundle = []
            bundle.append(members)
        if bundle:
            children.append(bundled(bundle))
        return Node(centre, radius, rows, children)

    def bundled(parts: list[np.ndarray]) -> Node:
        rows = np.concatenate(parts)
        centre = x[rows].mean(axis=0)
        return Node(centre, float(distances(x[rows], centre).max()), rows, [])

    return node(np.arange(len(x)), x.mean(axis=0))


def leaves(tree: Node) -> list[Node]:
    return [tree] if not tree.children else [n for c in tree.children for n in leaves(c)]


def bounds(a: np.ndarray, r: np.ndarray, b: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Upper bounds of the inner products between query nodes (a, r) and data nodes (b, s), rounding allowed for."""
    an, bn = np.sqrt((a * a).sum(axis=1)), np.sqrt((b * b).sum(axis=1))
    top = a @ b.T + np.outer(r, bn) + np.outer(an, s) + np.outer(r, s)
    return top + 1e-9 * np.outer(an + r, bn + s) + 1e-9


def norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x * x).sum(axis=1))


def integer_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The exact products of a with the rows of b (integers below 2^63), cut to +-BIGGEST."""
    rough = b @ a
    with np.errstate(over="ignore"):
        scores = (b.astype(np.int64) * a.astype(np.int64)).sum(axis=1)  # right modulo 2^64
    for i in np.flatnonzero(np.abs(rough) + 1e-9 * norms(b) * norms(a[None]) >= 2.0**62):
        exact = sum(int(x) * int(y) for x, y in zip(a, b[i], strict=True))
        scores[i] = min(max(exact, -BIGGEST), BIGGEST)
    return scores


def at_most(score: float) -> float:
    """A double that is not above the integer."""
    return float(score) if abs(score) < 2**53 else float(np.nextafter(float(score), -np.inf))


def dual_tree(queries: np.ndarray, query_ids: np.ndarray, worst: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """(query, vec_id, score): each query's k best of x that score at least its ``worst``."""
    groups = leaves(cover_tree(queries, 16))
    qc, qr = np.stack([g.centre for g in groups]), np.array([g.radius for g in groups])
    worst = worst.astype(np.float64).copy()
    found: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in queries]
    low = np.array([worst[g.rows].min() for g in groups])
    level, alive = [cover_tree(x)], np.ones((len(groups), 1), bool)
    ends: list[tuple[float, Node, np.ndarray]] = []
    while level:  # pairs of query nodes and data nodes, a level of the data's tree at a time
        top = bounds(qc, qr, np.stack([n.centre for n in level]), np.array([n.radius for n in level]))
        alive &= top >= low[:, None]
        nxt, masks = [], []
        for j, n in enumerate(level):
            if alive[:, j].any():
                if n.children:
                    nxt += n.children
                    masks += [alive[:, j]] * len(n.children)
                else:
                    ends.append((float(top[alive[:, j], j].max()), n, top[:, j]))
        level, alive = nxt, np.stack(masks, axis=1) if masks else np.ones((len(groups), 0), bool)
    query_norms, row_norms = norms(queries), norms(x)
    wide = query_norms.max() * row_norms.max() >= EXACT
    for _, n, top in sorted(ends, key=lambda e: -e[0]):
        chosen = np.flatnonzero(top >= low)
        if not len(chosen):
            continue
        q = np.concatenate([groups[g].rows for g in chosen])
        scores, rounded = queries[q] @ x[n.rows].T, None
        if wide:
            rounded = np.outer(query_norms[q], row_norms[n.rows])
            rounded[rounded < EXACT] = 0
            scores += 1e-9 * rounded  # upper bounds
        scores[query_ids[q][:, None] == ids[n.rows][None, :]] = -np.inf
        for i in np.flatnonzero((scores >= worst[q][:, None]).any(axis=1)):
            place = np.flatnonzero(scores[i] >= max(worst[q[i]], -1e300))
            mine, exact = found[q[i]], scores[i][place]
            if wide:
                exact = np.where(rounded[i][place] == 0, exact, 0).astype(np.int64)
                again = np.flatnonzero(rounded[i][place])
                exact[again] = integer_scores(queries[q[i]], x[n.rows[place[again]]])
            mine.append((exact.astype(np.int64), ids[n.rows[place]]))
            if sum(len(m[0]) for m in mine) >= 2 * k:
                s, v = (np.concatenate([m[t] for m in mine]) for t in (0, 1))
                keep = best(s, v, k)
                found[q[i]] = [(s[keep], v[keep])]
                worst[q[i]] = max(worst[q[i]], at_most(s[keep[-1]]))
        for g in chosen:
            low[g] = worst[groups[g].rows].min()
    out = []
    for i, mine in enumerate(found):
        if mine:
            s, v = (np.concatenate([m[t] for m in mine]) for t in (0, 1))
            out += [(int(query_ids[i]), int(v[j]), int(s[j])) for j in best(s, v, k)]
    return out


def far_centres(x: np.ndarray, n: int) -> np.ndarray:
    """Up to n rows, each the farthest from those before."""
    chosen, d = [0], distances(x, x[0])
    while len(chosen) < n and d.max() > 0:
        chosen.append(int(d.argmax()))
        d = np.minimum(d, distances(x, x[chosen[-1]]))
    return x[chosen]


def integer_vectors(table: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): floor(scale * component) of the vectors that take part, packed."""

    def whole(c: Column) -> Column:
        c = c * scale
        fractions = F.abs(c) < 2.0**53  # from there on all doubles are integers
        return F.when(fractions, F.floor(c).cast("double")).when(F.abs(c) < 2.0**63, c).otherwise(F.raise_error(F.lit("a scaled component does not fit BIGINT")))

    return packed(valid_vectors(table).select("vec_id", F.transform("x", whole).alias("x")))


def exact_top_k(
    table: DataFrame, k: int = 10, query_modulus: int = 100, scale: int = SCALE, cells: int = 16, sample_rows: int = 4096, block_rows: int = 8192, group_rows: int = 512
) -> DataFrame:
    """query_id, rank, vec_id and score: the k highest of each row whose vec_id is divisible by ``query_modulus``."""
    rows = checkpointed(integer_vectors(table, scale))
    sample = rows.withColumn("_h", F.xxhash64(F.lit(3), "vec_id", "v")).orderBy("_h").limit(sample_rows).select("v").collect()
    if not sample:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0).cast("long").alias("score")).where("false")
    centres = far_centres(unpacked(bytes(r.v) for r in sample), cells)
    lengths = (centres**2).sum(axis=1)

    def to_cells(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = unpacked(batch.column(1).to_pylist())
        cell = (lengths - 2 * x @ centres.T).argmin(axis=1).astype(np.int32)
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], ["vec_id", "v", "cell"])

    celled = checkpointed(map_batches(rows, to_cells, "vec_id long, v binary, cell int"))
    is_query = F.col("vec_id") % query_modulus == 0
    sizes = celled.groupBy("cell").agg(F.count("*").alias("n"), F.sum(is_query.cast("long")).alias("q")).collect()  # a row for each cell
    n_blocks = {r.cell: -(-r.n // block_rows) for r in sizes}
    # neighbouring cells share a query group until it is full; a cell of more queries has several
    base, split, filled = {}, {}, 0
    for r in sorted(sizes):
        base[r.cell], split[r.cell] = filled // group_rows, max(1, -(-r.q // group_rows))
        filled = filled + r.q if r.q <= group_rows else (filled // group_rows + split[r.cell] + 1) * group_rows
    lookup = lambda d: F.array(*(F.lit(int(d.get(c, 1))) for c in range(len(centres))))[F.col("cell")]
    salt = lambda seed, n: F.pmod(F.xxhash64("vec_id", F.lit(seed)), n).cast("int")
    data = celled.select("vec_id", "v", "cell", (F.col("cell") * 1_000_000 + salt(1, lookup(n_blocks))).alias("block"))
    queries = celled.where(is_query).select("vec_id", "v", "cell", (lookup(base) + salt(2, lookup(split))).alias("grp"))

    found_schema = "query_id long, vec_id long, score long"

    def search(data: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        got = []
        if len(data) and len(queries):
            got = dual_tree(unpacked(queries["v"]), queries["vec_id"].to_numpy(), queries["worst"].to_numpy(), unpacked(data["v"]), data["vec_id"].to_numpy(), k)
        return pd.DataFrame(got, columns=["query_id", "vec_id", "score"])

    def meet(pairs: DataFrame, queries: DataFrame) -> DataFrame:
        """The search of each (block, grp) of ``pairs``."""
        left = data.join(pairs, "block").select("block", "grp", "vec_id", "v")
        right = queries.join(pairs, "grp").select("block", "grp", "vec_id", "v", "worst")
        right = right.toDF(*right.columns)  # columns of its own, though both sides stem from one table
        return left.groupBy("block", "grp").cogroup(right.groupBy("block", "grp")).applyInPandas(search, found_schema)

    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    top = lambda found: found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    blocks_of = data.select("cell", "block").distinct()
    own = checkpointed(queries.select("cell", "grp").distinct().join(blocks_of, "cell").select("block", "grp").distinct())
    seeds = checkpointed(top(meet(own, queries.withColumn("worst", F.lit(float("-inf"))))).select("query_id", "vec_id", "score"))
    least = F.min("score").cast("double")
    least = least - F.when(F.abs(least) >= 2.0**53, F.abs(least) * 2.0**-52).otherwise(0.0)  # not above the integer
    known = seeds.groupBy("query_id").agg(least.alias("worst"), F.count("*").alias("n")).where(F.col("n") == k)
    bounded = queries.join(known, queries.vec_id == known.query_id, "left").select("vec_id", "v", "grp", F.coalesce("worst", F.lit(float("-inf"))).alias("worst"))
    bounded = checkpointed(bounded)

    def root(rows: pd.DataFrame) -> dict:
        x = unpacked(rows["v"])
        centre = x.mean(axis=0)
        return {"centre": [centre.tolist()], "radius": [float(distances(x, centre).max())]}

    def block_root(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"block": rows["block"].iloc[:1].to_numpy(), **root(rows)})

    def group_root(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"grp": rows["grp"].iloc[:1].to_numpy(), "low": [float(rows["worst"].min())], **root(rows)})

    shards = 16
    roots = data.groupBy("block").applyInPandas(block_root, "block int, centre array<double>, radius double").withColumn("shard", F.pmod("block", F.lit(shards)))
    groups = bounded.groupBy("grp").applyInPandas(group_root, "grp int, low double, centre array<double>, radius double")
    groups = groups.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))

    def survivors(blocks: pd.DataFrame, groups: pd.DataFrame) -> pd.DataFrame:
        if not len(blocks) or not len(groups):
            return pd.DataFrame({"block": [], "grp": []})
        column = lambda f: matrix(pa.array(f["centre"].tolist(), pa.list_(pa.float64())))
        bound = bounds(column(groups), groups["radius"].to_numpy(), column(blocks), blocks["radius"].to_numpy())
        g, b = np.nonzero(bound >= groups["low"].to_numpy()[:, None])
        return pd.DataFrame({"block": blocks["block"].to_numpy()[b], "grp": groups["grp"].to_numpy()[g]})

    pairs = roots.groupBy("shard").cogroup(groups.groupBy("shard")).applyInPandas(survivors, "block int, grp int").join(own, ["block", "grp"], "left_anti")
    rest = meet(checkpointed(pairs), bounded)
    score = F.when(F.abs("score") < BIGGEST, F.col("score")).otherwise(F.raise_error(F.lit("a score does not fit BIGINT")).cast("long")).alias("score")
    return top(rest.unionByName(seeds)).select("query_id", "rank", "vec_id", score)
