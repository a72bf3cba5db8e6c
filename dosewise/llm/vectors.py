"""Shared by the two vector searches: clean tables, blocks of vectors, top-k lists."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .merkle import numbered

BLOCK_ROWS = 1024  # about so many vectors in a block
CHUNK = 256  # queries that travel together
BLOCK = "key long, ids binary, vecs binary"
QUERY = "key long, ids binary, vecs binary, bounds binary"


def clean(vectors: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, int]:
    """(vec_id long, own long, vec array<double>) of the rows that take part,
    and their dimension. vec_id is a key of the row here, 0, 1, ... in the order
    of the id (``own``), then the vector: rows with equal ids stay rows each,
    and ties of the key are those of the id. Left out: NULL ids, NULL or empty
    vectors, those with NULL or non-finite components, and those of another
    dimension than most (ties: the greater), which have no product with them."""
    ok = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec"))
    rows = rows.where(F.col("vec_id").isNotNull() & (F.size("vec") > 0) & ok)
    common = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    dim = common["d"] if common else 0
    keyed = numbered(rows.where(F.size("vec") == dim).withColumn("tree", F.lit("")), "vec_id", "vec")
    return keyed.select(F.col("idx").alias("vec_id"), F.col("vec_id").alias("own"), "vec"), dim


def named(found: DataFrame, rows: DataFrame) -> DataFrame:
    """(query_id, rank, vec_id, score) with the rows' own ids for their keys."""
    ids = rows.select(F.col("vec_id").alias("_key"), "own")
    for c in ("query_id", "vec_id"):
        found = found.join(ids.withColumnsRenamed({"_key": c, "own": "_own"}), c).drop(c).withColumnRenamed("_own", c)
    return found.select("query_id", "rank", "vec_id", "score")


def matrix(batch: pa.RecordBatch, column: str, dim: int) -> np.ndarray:
    flat = batch.column(column).flatten()
    return np.asarray(flat, dtype=np.float64).reshape(-1, dim)


def unpack(cell: bytes, dim: int) -> np.ndarray:
    return np.frombuffer(cell, np.float64).reshape(-1, dim)


def subs_of(count: int) -> int:
    """Blocks that a cell (a leaf or a band) of so many vectors is dealt to."""
    return max(1, math.ceil(count / BLOCK_ROWS))


def block_key(cell: Column, counts: dict[int, int]) -> Column:
    """cell * 2^20 + a hash of vec_id among the blocks of the cell: a cell with very many vectors has many blocks."""
    subs = {c: subs_of(n) for c, n in counts.items() if subs_of(n) > 1}
    n = F.lit(1)
    if subs:
        n = F.coalesce(F.element_at(F.create_map(*(F.lit(x) for kv in subs.items() for x in kv)), cell), F.lit(1))
    return cell.cast("long") * F.lit(1 << 20) + F.pmod(F.xxhash64("vec_id"), n.cast("long"))


def blocks(rows: DataFrame, dim: int, by: str = "vec_id") -> DataFrame:
    """rows(key, vec_id, vec, ...) -> one row a block, vectors in the order of ``by``."""

    def run(batches):
        held: list[tuple[int, np.ndarray, np.ndarray]] = []

        def settle():
            ids, vecs = np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])
            out = [[held[0][0]], [ids.tobytes()], [vecs.tobytes()]]
            return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.binary())], ["key", "ids", "vecs"])

        for b in batches:
            keys, ids, vecs = np.asarray(b.column("key")), np.asarray(b.column("vec_id")), matrix(b, "vec", dim)
            edges = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])).tolist()
            for a, e in zip(edges, [*edges[1:], len(keys)]):
                if held and (held[0][0] != keys[a] or sum(len(h[1]) for h in held) >= 2 * BLOCK_ROWS):
                    yield settle()
                    held = []
                held.append((int(keys[a]), ids[a:e], vecs[a:e]))
        if held:
            yield settle()

    order = ["key", *([by] if by == "vec_id" else [F.desc(by), "vec_id"])]
    return rows.repartition("key").sortWithinPartitions(*order).select("key", "vec_id", "vec").mapInArrow(run, BLOCK)


class TopK:
    """Best ``k`` (score descending, id ascending) of each query of a task."""

    FLUSH = 20_000  # queries a task holds at a time

    def __init__(self, k: int, score_type: pa.DataType):
        self.k, self.kind = k, score_type
        self.best: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def least(self, query: int) -> float:
        got = self.best.get(query)
        return got[0][-1] if got is not None and len(got[0]) == self.k else -np.inf

    def add(self, query: int, scores: np.ndarray, ids: np.ndarray) -> None:
        got = self.best.get(query)
        if got is not None:
            scores, ids = np.concatenate([got[0], scores]), np.concatenate([got[1], ids])
        order = np.lexsort((ids, -scores))[: self.k]
        self.best[query] = (scores[order], ids[order])

    def rows(self):
        q = np.repeat(np.fromiter(self.best, np.int64, len(self.best)), [len(s) for s, _ in self.best.values()])
        scores = np.concatenate([s for s, _ in self.best.values()] or [np.zeros(0)])
        ids = np.concatenate([i for _, i in self.best.values()] or [np.zeros(0, np.int64)])
        self.best = {}
        for at in range(0, len(q), 8192):
            to = at + 8192
            yield pa.RecordBatch.from_arrays([pa.array(q[at:to]), pa.array(ids[at:to], pa.int64()), pa.array(scores[at:to].astype(self.kind.to_pandas_dtype()), self.kind)], ["query_id", "vec_id", "score"])


def ranked(found: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score) of all tasks -> the k best of each query with their rank."""
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
