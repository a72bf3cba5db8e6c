"""Exact top-k search by integer inner product: norm-sorted vectors, partial
sums in an SVD-rotated basis, Cauchy-Schwarz bounds.

Components become floor(1024 x). Vectors are dealt to bands of descending
length; a query has a first threshold (its k-th best among the ``HEAD``
longest vectors) and is sent to the bands whose longest vector could still
reach it. In a block, vectors are taken in descending length, a slab at a
time: the search of a query ends where |q||x| falls below its threshold, and
within a slab the sum over the leading rotated dimensions plus the product of
the residual lengths prunes before exact integer products are made. Bounds
carry a margin for rounding, so nothing is lost; equal scores are kept.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut
from .vectors import CHUNK, QUERY, TopK, block_key, blocks, clean, matrix, named, ranked, subs_of, unpack

K = 10
SCALE = 1024
HEAD = 2048
BAND_ROWS = 4096
BANDS = 1024  # at most
SLAB = 256
_EXACT = float(1 << 53)


def _products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact row-wise inner products of integral vectors."""
    sizes = np.abs(x).max(initial=0), np.abs(y).max(initial=0)
    if sizes[0] * sizes[1] * x.shape[1] < _EXACT:
        return np.einsum("ij,ij->i", x, y)
    return np.array([sum(int(a) * int(b) for a, b in zip(u, v)) for u, v in zip(x, y)], object)


def rotation(gram: np.ndarray) -> tuple[np.ndarray, int]:
    """Right singular vectors of the vectors (eigenvectors of their Gram
    matrix), strongest first, and how many leading dimensions carry half of the energy
    (a quarter of the dimensions at least)."""
    value, vector = np.linalg.eigh(gram)
    order = np.argsort(value)[::-1]
    energy = np.cumsum(np.maximum(value[order], 0))
    lead = int(np.searchsorted(energy, 0.5 * energy[-1])) + 1 if energy[-1] > 0 else 1
    return vector[:, order], min(len(gram), max(lead, math.ceil(len(gram) / 4)))


def search_block(best: TopK, qids, queries, floors, ids, vecs, basis: np.ndarray, lead: int) -> None:
    """Add what reaches the thresholds; vecs in descending length."""
    q_len, x_len = np.sqrt((queries * queries).sum(1)), np.sqrt((vecs * vecs).sum(1))
    rq, rx = queries @ basis, vecs @ basis
    q_rest = np.sqrt(np.maximum((rq[:, lead:] ** 2).sum(1), 0))
    x_rest = np.sqrt(np.maximum((rx[:, lead:] ** 2).sum(1), 0))
    for at in range(0, len(ids), SLAB):
        s = slice(at, at + SLAB)
        floor = np.maximum(floors, [best.least(q) for q in qids.tolist()])
        margin = 1e-9 * (1 + q_len * x_len[at])
        live = np.flatnonzero(q_len * x_len[at] + margin >= floor)  # the slab's longest is its first
        if not len(live):
            break
        bound = rq[live, :lead] @ rx[s, :lead].T + q_rest[live, None] * x_rest[None, s] + margin[live, None]
        rows, cols = np.nonzero((bound >= floor[live, None]) & (qids[live, None] != ids[None, s]))
        scores = _products(queries[live[rows]], vecs[s][cols])
        keep = scores >= floor[live[rows]]
        rows, cols, scores = rows[keep], cols[keep], scores[keep]
        edges = np.searchsorted(rows, np.arange(len(live) + 1))
        for i, q in enumerate(qids[live].tolist()):
            a, b = edges[i], edges[i + 1]
            if b > a:
                best.add(q, scores[a:b], ids[s][cols[a:b]])


def top_k(vectors: DataFrame, every: int = 100, k: int = K, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score long): the k highest integer inner
    products of the rows whose id is divisible by ``every`` with all other
    rows, ties to the smaller id.

    Rows left out are those of ``vectors.clean``; zero vectors take part;
    rows with equal ids are queries and candidates each; fewer candidates than k
    give fewer rows, an empty table none. Exact while scores fit 53 bits (beyond that
    in Python integers, while they fit a long).
    """
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score long"
    rows, dim = clean(vectors, id_col, vec_col)
    whole = F.transform("vec", lambda x: F.floor(x * SCALE).cast("double"))
    rows = rows.select("vec_id", "own", whole.alias("vec"))
    rows = cut(rows.withColumn("length", F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x))))
    n = rows.count()
    if not n:
        return spark.createDataFrame([], schema)

    def gram(batches):
        total = np.zeros((dim, dim))
        for b in batches:
            x = matrix(b, "vec", dim)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim * dim)), pa.array(total.ravel())], ["cell", "value"])

    cells = rows.select("vec").mapInArrow(gram, "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value")).collect()
    flat = np.zeros(dim * dim)
    flat[[r["cell"] for r in cells]] = [r["value"] for r in cells]
    basis, lead = rotation(flat.reshape(dim, dim))

    bands = min(BANDS, math.ceil(n / BAND_ROWS))
    steps = sorted(set(rows.approxQuantile("length", [i / bands for i in range(1, bands)], 0.25 / bands)), reverse=True) if bands > 1 else []
    longest = rows.agg(F.max("length")).first()[0]
    tops = [longest, *steps]  # the longest that each band may hold
    band = F.lit(0)
    if steps:
        band = F.size(F.filter(F.array(*map(F.lit, steps)), lambda s: s >= F.col("length")))
    placed = cut(rows.withColumn("band", band.cast("long")))
    counts = {r["band"]: r["count"] for r in placed.groupBy("band").count().collect()}
    head = rows.orderBy(F.desc("length"), "vec_id").limit(HEAD).collect()
    h_ids, h_vecs = np.array([r["vec_id"] for r in head]), np.array([r["vec"] for r in head])

    def send(batches):
        for b in batches:
            for at in range(0, b.num_rows, CHUNK):
                part = b.slice(at, CHUNK)
                ids, vecs = np.asarray(part.column("vec_id")), matrix(part, "vec", dim)
                best = TopK(k, pa.int64())
                search_block(best, ids, vecs, np.full(len(ids), -np.inf), h_ids, h_vecs, basis, lead)
                floors = np.array([best.least(q) for q in ids.tolist()], float)
                length = np.sqrt((vecs * vecs).sum(1))
                keys, take = [], []
                for g, c in counts.items():
                    live = np.flatnonzero(length * tops[g] * (1 + 1e-9) + 1e-6 >= floors)
                    if len(live):
                        for sub in range(subs_of(c)):
                            keys.append((g << 20) + sub)
                            take.append(live)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), *(pa.array([x[r].tobytes() for r in take], pa.binary()) for x in (ids, vecs, floors))], ["key", "ids", "vecs", "bounds"])

    def search(batches):
        best = TopK(k, pa.int64())
        for b in batches:
            for qi, qv, qf, ci, cv in zip(*(b.column(i).to_pylist() for i in range(5))):
                search_block(best, np.frombuffer(qi, np.int64), unpack(qv, dim), np.frombuffer(qf, np.float64), np.frombuffer(ci, np.int64), unpack(cv, dim), basis, lead)
                if len(best.best) >= TopK.FLUSH:
                    yield from best.rows()
        yield from best.rows()

    packed = blocks(placed.withColumn("key", block_key(F.col("band"), counts)), dim, by="length").select("key", F.col("ids").alias("c_ids"), F.col("vecs").alias("c_vecs"))
    sent = rows.where(F.col("own") % every == 0).select("vec_id", "vec").mapInArrow(send, QUERY)
    pairs = sent.join(packed, "key").select("ids", "vecs", "bounds", "c_ids", "c_vecs")
    return named(ranked(pairs.mapInArrow(search, "query_id long, vec_id long, score long"), k), rows)
