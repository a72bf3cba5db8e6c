"""Periodic runs of words: maximal stretches in which words one period apart are identical.

Descending-LCP Kruskal. The suffixes of a text are sorted, and neighbours in
that order are joined by edges that weigh their longest common prefix (LCP).
Edges are taken from the heaviest to the lightest: union-find classes then
hold the positions whose suffixes share at least that many words, each as an
ordered set, the smaller one poured into the larger. Two positions p < q that
become neighbours in a set at LCP l agree in exactly l words; with q - p <= l
the words from p to q + l have period q - p, and nothing can be added at the
right. If the words before p and q differ too, that is a run. Its period is
the smallest, as a smaller one would have put a position between p and q into
the set earlier; and every run is met so, from its first two periods.

A run of ``least`` words or more needs l >= least / 2, so positions whose next
least / 2 words occur once in the text are set aside before sorting.
"""

from __future__ import annotations

import itertools
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_map

LEAST = 12  # words of a run
_SHELF = 16  # log2 of the range of positions that a shelf of an ordered set holds


class Positions:
    """An ordered set of positions, on shelves of 2^16 neighbouring values, so that adding stays cheap in very long texts."""

    __slots__ = ("size", "shelves", "keys")

    def __init__(self, p: int):
        self.size, self.shelves, self.keys = 1, {p >> _SHELF: [p]}, [p >> _SHELF]

    def __iter__(self) -> Iterator[int]:
        for k in self.keys:
            yield from self.shelves[k]

    def add(self, p: int) -> tuple[int, int]:
        """Adds p; returns the neighbours it gets (-1 for none)."""
        key = p >> _SHELF
        self.size += 1
        shelf = self.shelves.get(key)
        if shelf is None:
            insort(self.keys, key)
            shelf = self.shelves[key] = []
        i = bisect_left(shelf, p)
        before = shelf[i - 1] if i else -1
        after = shelf[i] if i < len(shelf) else -1
        shelf.insert(i, p)
        if (before < 0 or after < 0) and len(self.keys) > 1:
            k = bisect_left(self.keys, key)
            if before < 0 and k:
                before = self.shelves[self.keys[k - 1]][-1]
            if after < 0 and k + 1 < len(self.keys):
                after = self.shelves[self.keys[k + 1]][0]
        return before, after


def suffix_ranks(ids: np.ndarray) -> list[np.ndarray]:
    """Prefix doubling: for 1, 2, 4, ... words, the class of each position by
    that many words, as the place of the class's first suffix in their order;
    only what is still tied is sorted again. Place n stands for the text's end."""
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    new = np.ones(n, bool)
    new[1:] = ids[order[1:]] != ids[order[:-1]]
    rank = np.full(n + 1, n)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    levels, tied, k = [rank], order, 1
    while True:
        r = rank[tied]
        same = np.zeros(len(r) + 1, bool)
        same[1:-1] = r[1:] == r[:-1]
        tied = tied[same[1:] | same[:-1]]
        if not len(tied):
            return levels
        r, then = rank[tied], rank[np.minimum(tied + k, n)]
        o = np.lexsort((then, r))
        tied, r, then = tied[o], r[o], then[o]
        place = np.arange(len(r))
        old = np.ones(len(r), bool)
        old[1:] = r[1:] != r[:-1]
        new = old.copy()
        new[1:] |= then[1:] != then[:-1]
        starts = [np.maximum.accumulate(np.where(x, place, 0)) for x in (new, old)]
        rank = rank.copy()
        rank[tied] = r + starts[0] - starts[1]
        levels.append(rank)
        k *= 2


def common_prefixes(levels: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Number of words that the suffixes at x and y share, pair by pair (x and y differ)."""
    n = len(levels[0]) - 1
    shared = np.zeros(len(x), np.int64)
    for j in range(len(levels) - 1, -1, -1):
        shared += (levels[j][np.minimum(x + shared, n)] == levels[j][np.minimum(y + shared, n)]).astype(np.int64) << j
    return shared


def runs(ids: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of ``least`` words or more."""
    half = max(1, -(-least // 2))
    n = len(ids)
    if n < max(2, least):
        return []
    seen = ids.astype(np.uint64)
    mixed = np.zeros(n - half + 1, np.uint64)
    for j in range(half):  # equal words give equal sums; unequal ones that meet are told apart by sorting
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + seen[j : n - half + 1 + j] + np.uint64(1)
        mixed ^= mixed >> np.uint64(29)
    ordered = np.sort(mixed)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return []
    at = np.flatnonzero(np.isin(mixed, twice))
    levels = suffix_ranks(ids)
    order = at[np.argsort(levels[-1][at])]
    lcp = np.append(0, common_prefixes(levels, order[:-1], order[1:]))
    heavy = np.flatnonzero(lcp >= half)
    heavy = heavy[np.argsort(-lcp[heavy], kind="stable")]
    out: list[tuple[int, int, int]] = []
    up: dict[int, int] = {}
    sets: dict[int, Positions] = {}

    def root(p: int) -> int:
        while (q := up.get(p, p)) != p:
            up[p] = up.get(q, q)
            p = q
        return p

    words = ids.tolist()
    for a, b, l in zip(order[heavy - 1].tolist(), order[heavy].tolist(), lcp[heavy].tolist()):
        a, b = root(a), root(b)
        into, poured = sets.pop(a, None) or Positions(a), sets.pop(b, None) or Positions(b)
        if into.size < poured.size:
            a, b, into, poured = b, a, poured, into
        up[b] = a
        sets[a] = into
        new = list(poured)
        mine = set(new)
        for p, later in zip(new, [*new[1:], n]):
            left, right = into.add(p)
            # neighbours that were poured too have met before, at a greater LCP
            if left >= 0 and left not in mine and p - left <= l and (left == 0 or words[left - 1] != words[p - 1]) and p - left + l >= least:
                out.append((left, p - left + l, p - left))
            if 0 <= right < later and right - p <= l and (p == 0 or words[p - 1] != words[right - 1]) and right - p + l >= least:
                out.append((p, right - p + l, right - p))
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapse(words: list[bytes], found: list[tuple[int, int, int]]) -> bytes:
    """The words joined by one space, without those that a run holds after its first period."""
    if found:
        edge = np.zeros(len(words) + 1, np.int64)
        for start, length, period in found:
            edge[start + period] += 1
            edge[start + length] -= 1
        words = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]
    return b" ".join(words)


def _numbered(texts: list[list[bytes]]) -> Iterator[np.ndarray]:
    for words in texts:
        number = defaultdict(itertools.count().__next__)
        yield np.fromiter(map(number.__getitem__, words), np.int64, len(words))


FOUND = "array<struct<start:long,length:long,period:long>>"


def periodic_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(doc_id, runs, collapsed) for each row of docs(doc_id, text): all runs
    of ``least`` words or more by start, then period, and the text without the
    repeats. Words are runs of anything but ASCII white space. NULL and empty
    texts have no runs and collapse to the empty text; a NULL doc_id stays
    NULL; repeated rows are rows each; other columns are not read."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches):
        for b in batches:
            texts = [(t or "").encode().split() for t in b.column(1).to_pylist()]
            found = [runs(ids, least) for ids in _numbered(texts)]
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array([[dict(zip(("start", "length", "period"), r)) for r in f] for f in found], kind),
                pa.array([collapse(w, f).decode() for w, f in zip(texts, found)], pa.string()),
            ], ["doc_id", "runs", "collapsed"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return arrow_map(rows, run, f"doc_id long, runs {FOUND}, collapsed string")


def folded(doc_id: Column, text: Column) -> Column:
    """The contract's texts: of every tenth document (by crc32 of its decimal
    id), the words from place a on repeat the p words from a; NULL ids have none."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    words = F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n = F.size(words).cast("long")
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8)).cast("long")
    block = F.slice(words, (a + 1).cast("int"), p.cast("int"))
    again = F.flatten(F.array_repeat(block, F.ceil((n - a) / p).cast("int")))
    joined = F.concat_ws(" ", F.concat(F.slice(words, F.lit(1), a.cast("int")), F.slice(again, F.lit(1), (n - a).cast("int"))))
    return F.when((h % 10 == 0) & text.rlike(r"[^\x20\x09-\x0D]"), joined).otherwise(text)


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns from ``periodic_runs``."""
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p"))))
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), F.concat(r["period"].cast("string"), F.lit("\n")))))
    got = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"))
    length, period = -F.col("best.l"), F.col("best.p")
    return got.select("doc_id", "n_runs", F.col("best.s").alias("start"), length.alias("length"), period.alias("period"),
                      F.floor(1000 * length / period).cast("long").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
