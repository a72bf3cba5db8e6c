"""Approximate nearest neighbours by inner product: a hierarchical k-means
tree, best-bin-first.

The tree is grown on the driver from a sample of at most ``SAMPLE`` vectors;
every vector is indexed, in the leaf it descends to. A query walks the tree
through a priority queue on the inner product with the centres and so meets
the leaves in the order of their promise; only leaves with rows count, and a query
goes on until it has met enough rows for a full list. How many it visits is calibrated:
for at most ``CALIBRATE`` queries the exact neighbours among all vectors are
found, and visits are widened until ``TARGET`` of those lie in visited
leaves. Leaves are searched on Spark, as a join of blocks of vectors with the
queries that visit them; a leaf with very many vectors is many blocks.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut
from .vectors import CHUNK, QUERY, TopK, block_key, blocks, clean, matrix, named, ranked, subs_of, unpack

K = 20
SAMPLE = 20_000
CALIBRATE = 128
TARGET = 0.95
LEAF_ROWS = 512
BRANCH = 8


@dataclass
class Tree:
    centres: list[np.ndarray] = field(default_factory=list)  # of a node's children
    children: list[list[int]] = field(default_factory=list)  # node, or -1 - leaf
    leaves: int = 0

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector: down to the nearest centre at each node."""
        out = np.zeros(len(x), np.int64)
        todo = [(0, np.arange(len(x)))] if self.children else []
        while todo:
            node, rows = todo.pop()
            near = _nearest(x[rows], self.centres[node])
            for i, child in enumerate(self.children[node]):
                part = rows[near == i]
                if not len(part):
                    continue
                if child < 0:
                    out[part] = -1 - child
                else:
                    todo.append((child, part))
        return out

    def visits(self, q: np.ndarray, most: int, counts: dict[int, int], least: int = 0) -> list[int]:
        """The first ``most`` leaves that hold rows (``counts``), best bin first,
        and more until they hold ``least`` rows together, if there are as many."""
        if not self.children:
            return [0]
        out: list[int] = []
        held, heap = 0, [(0.0, 0)]
        while heap and (len(out) < most or held < least):
            _, node = heapq.heappop(heap)
            if node < 0:
                if n := counts.get(-1 - node):
                    out.append(-1 - node)
                    held += n
                continue
            for p, child in zip((-(self.centres[node] @ q)).tolist(), self.children[node]):
                heapq.heappush(heap, (p, child))
        return out


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres * centres).sum(1) - 2 * (x @ centres.T), axis=1)


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    centres = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = _nearest(x, centres)
        n = np.bincount(near, minlength=k)
        sums = np.zeros((k, x.shape[1]))
        np.add.at(sums, near, x)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


def grow(sample: np.ndarray, leaf: float, seed: int = 5) -> Tree:
    """A tree whose leaves hold at most about ``leaf`` vectors of the sample."""
    tree, rng = Tree(), np.random.default_rng(seed)

    def node(rows: np.ndarray) -> int:
        x = sample[rows]
        distinct = np.unique(x, axis=0) if len(rows) > leaf else x[:1]
        if len(rows) <= leaf or len(distinct) < 2:
            tree.leaves += 1
            return -tree.leaves  # -1 - leaf number
        at = len(tree.children)
        tree.centres.append(_kmeans(distinct, min(BRANCH, len(distinct)), rng))
        tree.children.append([])
        near = _nearest(x, tree.centres[at])
        for i in range(len(tree.centres[at])):
            tree.children[at].append(node(rows[near == i]))
        return at

    if node(np.arange(len(sample))) < 0:
        tree.leaves = 1
    return tree


def _exact(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Row-wise inner products, summed from the first component to the last."""
    out = np.zeros(len(x))
    for i in range(x.shape[1]):
        out += x[:, i] * y[:, i]
    return out


def search_block(best: TopK, qids, queries, ids, vecs) -> None:
    """Add the block's nearest to the lists of the queries (never a query's own row)."""
    k = best.k + 1
    scores = queries @ vecs.T
    if scores.shape[1] > k:
        floor = np.partition(scores, -k, axis=1)[:, -k]
    else:
        floor = np.full(len(qids), -np.inf)
    floor = np.maximum(floor, [best.least(q) for q in qids.tolist()])
    # rounding depends on the blocking: keep what is that near, and score it in one order
    slack = 1e-12 * (1 + np.abs(queries).sum(1) * np.abs(vecs).max(initial=0))
    rows, cols = np.nonzero((scores >= (floor - slack)[:, None]) & (qids[:, None] != ids[None, :]))
    exact = _exact(queries[rows], vecs[cols])
    edges = np.searchsorted(rows, np.arange(len(qids) + 1))
    for i, q in enumerate(qids.tolist()):
        a, b = edges[i], edges[i + 1]
        if b > a:
            best.add(q, exact[a:b], ids[cols[a:b]])


def _brute(rows: DataFrame, ids: np.ndarray, queries: np.ndarray, dim: int, tree: Tree, k: int) -> DataFrame:
    """Exact neighbours of a bounded set of queries among all rows, with the leaf of each."""

    def run(batches):
        best = TopK(k, pa.float64())
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                part = b.slice(at, 4096)
                search_block(best, ids, queries, np.asarray(part.column("vec_id")), matrix(part, "vec", dim))
        yield from best.rows()

    return ranked(rows.mapInArrow(run, "query_id long, vec_id long, score double"), k)


def nearest(vectors: DataFrame, every: int = 20, k: int = K, id_col: str = "vec_id", vec_col: str = "embedding", target: float = TARGET) -> DataFrame:
    """(query_id, rank, vec_id, score) of the rows whose id is divisible by
    ``every``, against all other rows; score is the inner product in double
    precision, ties go to the smaller id.

    Rows left out are those of ``vectors.clean`` and zero vectors; rows with
    equal ids are queries and candidates each; fewer candidates than k give
    fewer rows, an empty table none.
    """
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    rows, dim = clean(vectors, id_col, vec_col)
    rows = cut(rows.where(F.exists("vec", lambda x: x != 0)))
    n = rows.count()
    if not n:
        return spark.createDataFrame([], schema)
    sample = np.array([r["vec"] for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()])
    tree = grow(sample, max(1.0, LEAF_ROWS * len(sample) / n))
    is_query = F.col("own") % every == 0

    def assign(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(tree.assign(matrix(b, "vec", dim)))], ["vec_id", "vec", "leaf"])

    placed = cut(rows.select("vec_id", "vec").mapInArrow(assign, "vec_id long, vec array<double>, leaf long"))
    counts = {r["leaf"]: r["count"] for r in placed.groupBy("leaf").count().collect()}

    # calibration
    chosen = sorted(rows.where(is_query).orderBy(F.xxhash64("vec_id", F.lit(1)), "vec_id").limit(CALIBRATE).collect(), key=lambda r: r["vec_id"])
    if not chosen:
        return spark.createDataFrame([], schema)
    qids, queries = np.array([r["vec_id"] for r in chosen]), np.array([r["vec"] for r in chosen])
    true = _brute(rows.select("vec_id", "vec"), qids, queries, dim, tree, k).join(placed.select("vec_id", "leaf"), "vec_id").select("query_id", "leaf").collect()
    places = {q: {leaf: i for i, leaf in enumerate(tree.visits(v, tree.leaves, counts))} for q, v in zip(qids.tolist(), queries)}
    needed = np.sort([places[r["query_id"]][r["leaf"]] + 1 for r in true]) if true else np.array([1])
    width = int(needed[min(len(needed) - 1, int(np.ceil(target * len(needed))) - 1)])

    def send(batches):
        for b in batches:
            ids, vecs = np.asarray(b.column("vec_id")), matrix(b, "vec", dim)
            for at in range(0, len(ids), CHUNK):
                by: dict[int, list[int]] = {}
                for i in range(at, min(at + CHUNK, len(ids))):
                    for leaf in tree.visits(vecs[i], width, counts, k + 1):  # its own row and k others
                        by.setdefault(leaf, []).append(i)
                keys, rows_ = [], []
                for leaf, r in by.items():
                    for sub in range(subs_of(counts[leaf])):
                        keys.append((leaf << 20) + sub)
                        rows_.append(r)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), pa.array([ids[r].tobytes() for r in rows_], pa.binary()), pa.array([vecs[r].tobytes() for r in rows_], pa.binary()), pa.array([b""] * len(keys), pa.binary())],
                    ["key", "ids", "vecs", "bounds"])

    def search(batches):
        best = TopK(k, pa.float64())
        for b in batches:
            for qi, qv, ci, cv in zip(*(b.column(i).to_pylist() for i in range(4))):
                search_block(best, np.frombuffer(qi, np.int64), unpack(qv, dim), np.frombuffer(ci, np.int64), unpack(cv, dim))
                if len(best.best) >= TopK.FLUSH:
                    yield from best.rows()
        yield from best.rows()

    packed = blocks(placed.withColumn("key", block_key(F.col("leaf"), counts)), dim).select("key", F.col("ids").alias("c_ids"), F.col("vecs").alias("c_vecs"))
    sent = rows.where(is_query).select("vec_id", "vec").mapInArrow(send, QUERY)
    pairs = sent.join(packed, "key").select("ids", "vecs", "c_ids", "c_vecs")
    return named(ranked(pairs.mapInArrow(search, "query_id long, vec_id long, score double"), k), rows)
