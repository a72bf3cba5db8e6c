"""Conflict-constrained best-fit packing of documents into bins of fixed size.

Documents are dealt by hash to shards of about ``SHARD_ROWS`` rows that are
packed on their own, largest first, ties by id. The open bins of a shard are
kept in the order of their residual room, each with a bitmap of the sources
and one of the duplicate clusters it holds. A piece goes to the tightest
compatible bin: the search starts at the successor of its size in that order
and goes on until a bin holds neither its source nor its cluster; if there is
none, a bin is opened. So no bin holds two pieces of one source or of one
cluster (or of one document).

A document longer than a bin is cut into full bins and a rest; a full bin is
closed at once. Sources and clusters are numbered within a shard; a cluster
with one member in the shard needs no bit.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import simhash
from .common import cut, word_count

CAPACITY = 2048
SHARD_ROWS = 4096


class Bins:
    """Open bins of a shard in the order of (residual, number)."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.residual = np.zeros(64, np.int64)  # in order
        self.number = np.zeros(64, np.int64)
        self.open = 0
        self.sources: list[int] = []  # bitmaps by bin number
        self.clusters: list[int] = []

    def _insert(self, residual: int, number: int) -> None:
        if self.open == len(self.residual):
            self.residual, self.number = (np.concatenate([a, np.zeros_like(a)]) for a in (self.residual, self.number))
        lo, hi = np.searchsorted(self.residual[: self.open], [residual, residual + 1])
        at = int(lo + np.searchsorted(self.number[lo:hi], number))
        for a, x in ((self.residual, residual), (self.number, number)):
            a[at + 1 : self.open + 1] = a[at : self.open]
            a[at] = x
        self.open += 1

    def place(self, size: int, source: int, cluster: int) -> int:
        """The bin of a piece; source and cluster are bits (0: no constraint)."""
        at = int(np.searchsorted(self.residual[: self.open], size))
        sources, clusters = self.sources, self.clusters
        for i in range(at, self.open):  # successors, tightest first
            n = int(self.number[i])
            if not (sources[n] & source or clusters[n] & cluster):
                left = int(self.residual[i]) - size
                for a in (self.residual, self.number):
                    a[i : self.open - 1] = a[i + 1 : self.open]
                self.open -= 1
                break
        else:
            n, left = len(sources), self.capacity - size
            sources.append(0)
            clusters.append(0)
        sources[n] |= source
        clusters[n] |= cluster
        if left:
            self._insert(left, n)
        return n


def pack_shard(sizes: list[int], sources: list, clusters: list, capacity: int = CAPACITY) -> list[tuple[int, int, int, int]]:
    """Pieces (row, first word, words, bin) of the rows of a shard, given by
    size descending. A row of size 0 takes no room but keeps its constraints;
    a NULL source or cluster puts no constraint."""
    bins, out = Bins(capacity), []
    source_bit = {s: 1 << i for i, s in enumerate(dict.fromkeys(x for x in sources if x is not None))}
    often = [c for c, n in Counter(x for x in clusters if x is not None).items() if n > 1]
    cluster_bit = {c: 1 << i for i, c in enumerate(often)}
    rests = []
    for row, size in enumerate(sizes):
        full = max(0, size - 1) // capacity if size > capacity else 0
        for k in range(full):
            out.append((row, k * capacity, capacity, bins.place(capacity, 0, 0)))
        rests.append((size - full * capacity, row, full * capacity))
    for size, row, first in sorted(rests, key=lambda r: (-r[0], r[1])):
        out.append((row, first, size, bins.place(size, source_bit.get(sources[row], 0), cluster_bit.get(clusters[row], 0))))
    return out


PACKED = "doc_id long, piece int, first_word long, words long, shard long, bin int, bin_words long"


def pack(docs: DataFrame, cluster: Column | None = None, size: Column | None = None, capacity: int = CAPACITY,
         id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row for each piece of each row of docs: (doc_id, piece, first_word,
    words, shard, bin, bin_words); (shard, bin) names a bin and bin_words is
    what it holds, at most ``capacity``.

    ``size`` defaults to the words of the text, ``cluster`` to a hash of the
    text (copies conflict). NULL and empty texts give one piece of no words;
    NULL ids, sources and repeated rows are packed like any other (a NULL
    source puts no constraint); an empty table gives an empty result. Only
    sizes and keys are shuffled, not texts.
    """
    size = word_count(F.col(text_col)) if size is None else size
    cluster = F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))) if cluster is None else cluster
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), size.cast("long").alias("size"), F.col(source_col).cast("string").alias("source"), cluster.cast("long").alias("cluster"))
    shards = max(1, math.ceil(docs.count() / SHARD_ROWS))
    # repeated ids are told apart by size and cluster; equal rows beyond that are cut below
    dealt = slim.withColumn("shard", F.pmod(F.xxhash64("doc_id", "size", "cluster"), F.lit(shards)))

    def run(batches):
        held: list[pa.RecordBatch] = []

        def settle(rows: pa.Table, part: int):
            cols = {n: rows.column(n).to_pylist() for n in rows.column_names}
            pieces = pack_shard(cols["size"], cols["source"], cols["cluster"], capacity)
            fill = Counter()
            for _, _, words, b in pieces:
                fill[b] += words
            nth: Counter = Counter()
            out = []
            for row, first, words, b in sorted(pieces, key=lambda p: (p[0], p[1])):
                out.append((cols["doc_id"][row], nth[row], first, words, cols["shard"][0] + part * shards, b, fill[b]))
                nth[row] += 1
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            for at in range(0, len(out), 8192):
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out[at : at + 8192]), kinds)], [f.split()[0] for f in PACKED.split(", ")])

        now, part, rows = None, 0, 0
        for b in batches:
            shard = np.asarray(b.column(4))
            at = 0
            while at < b.num_rows:
                same = int(np.searchsorted(shard, shard[at], "right"))
                # a shard made large by equal rows is packed in parts of bounded size
                full = rows >= 2 * SHARD_ROWS
                if held and (shard[at] != now or full):
                    yield from settle(pa.Table.from_batches(held), part)
                    held, rows = [], 0
                    part = part + 1 if shard[at] == now else 0
                elif shard[at] != now:
                    part = 0
                now = shard[at]
                to = min(same, at + 2 * SHARD_ROWS - rows)
                held.append(b.slice(at, to - at))
                rows += to - at
                at = to
        if held:
            yield from settle(pa.Table.from_batches(held), part)

    parts = max(1, min(shards, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    ordered = dealt.repartition(parts, "shard").sortWithinPartitions("shard", F.col("size").desc(), "doc_id", "cluster", "source")
    return ordered.mapInArrow(run, PACKED)


def pack_apart(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pack`` with the near-duplicates among docs, and the rows of one
    doc_id, as the clusters; nothing but ids, sources, sizes and clusters
    comes back from the search for them."""
    carry = {"source": F.col("source").cast("string"), "size": word_count(F.col("text"))}
    found = cut(simhash.duplicate_clusters(docs, carry))
    return pack(found, cluster=F.col("cluster"), size=F.col("size"), capacity=capacity)
