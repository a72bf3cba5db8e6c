"""SimHash near-duplicates by meet-in-the-middle ball hashing (radius 3).

Two fingerprints at distance d <= 3 meet in a variant between them, so each
emits the variants within half the radius, 1.5 bits: every fingerprint its
ball of one flipped bit (65 variants), which finds distances up to 2; a
distance of 3 needs two flips on one side and one on the other. Distance 3
is odd, so of such a pair exactly one fingerprint has an even number of set
bits, and only those emit the two-bit variants. Of three differing bits two
lie in the same 32-bit half, so two-bit variants within one half are enough
(2 x 496).

Whatever meets in a variant is a link by the triangle inequality when one
side is a one-bit variant (1 + 1 or 2 + 1 bits), so a bucket needs no list of
pairs: its members are linked to its first one-bit member and the distance is
verified on that star. Buckets of two-bit variants alone give nothing.

A variant is dealt by 40 of its bits (the half that its two-bit flips leave
alone, and 8 more); the flips that don't touch those bits are made after the
shuffle, which so carries some 160 short rows a fingerprint instead of over
1,000 variants. Equal fingerprints are folded to one row first, so copies
cost one row each.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_map, cut, quoted
from .components import connected_components

RADIUS = 3
SEED = 42
_FLUSH = 200_000  # shingle hashes counted at a time

# bits of a byte spread over the 8 byte lanes of a 64-bit word
_LANES = np.packbits(
    np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").reshape(256, 8, 1), axis=2, bitorder="little"
).reshape(256, 8).view(np.uint64).ravel()


def _add(counts: np.ndarray, digests: list[bytes], spans: list[tuple[int, int, int]]) -> None:
    """Add the set bits of digests[a:b] to counts[doc], for spans (doc, a, b)."""
    lanes = _LANES[np.frombuffer(b"".join(digests), np.uint8)].reshape(-1, 8)
    # a lane is a byte: sum at most 255 rows at a time
    starts = np.concatenate([np.arange(a, b, 255) for _, a, b in spans])
    docs = np.repeat([d for d, _, _ in spans], [-(-(b - a) // 255) for _, a, b in spans])
    sums = np.ascontiguousarray(np.add.reduceat(lanes, starts, axis=0)).view(np.uint8).reshape(-1, 64)
    np.add.at(counts, docs, sums)


def fingerprints(texts: list[str | None], width: int = 3) -> np.ndarray:
    """Fingerprints (uint64) of texts: ASCII lower-cased words, shingles of
    ``width`` words with repeats, XXH64 seed 42; a bit is set if over half of
    the hashes have it. Fewer words: one shingle of them all. None: zero."""
    digest = xxhash.xxh64_digest
    counts, totals = np.zeros((len(texts), 64), np.int64), np.zeros(len(texts), np.int64)
    buf: list[bytes] = []
    spans: list[tuple[int, int, int]] = []
    for d, text in enumerate(texts):
        words = (text or "").encode().lower().split()
        if not words:
            continue
        s = b" ".join(words)
        n = max(1, len(words) - width + 1)
        ends = list(itertools.accumulate(map(len, words)))
        del words
        k = min(width, len(ends)) - 1
        totals[d] = n
        for at in range(0, n, _FLUSH):
            to, first = min(n, at + _FLUSH), len(buf)
            # shingle i: from word i to word i + k; a space stands between words
            begin = [0, *(e + i + 1 for i, e in enumerate(ends[: to - 1]))][at:to] if at == 0 else [ends[i - 1] + i for i in range(at, to)]
            buf += [digest(s[a:e + i + k], SEED) for i, (a, e) in enumerate(zip(begin, ends[at + k : to + k]), at)]
            spans.append((d, first, len(buf)))
            if len(buf) >= _FLUSH:
                _add(counts, buf, spans)
                buf, spans = [], []
    if buf:
        _add(counts, buf, spans)
    on = (2 * counts > totals[:, None]).astype(np.uint8)
    return np.packbits(on.reshape(-1, 8, 8), axis=2, bitorder="little").reshape(-1, 8).view(">u8").ravel().astype(np.uint64)


def with_fingerprint(docs: DataFrame, id_col: str, text_col: str, width: int = 3, carry: dict[str, Column] | None = None) -> DataFrame:
    """(doc_id long, fp long, and the columns of ``carry``): one row for each row of docs; fp holds the 64 bits."""
    more = [c.alias(n) for n, c in (carry or {}).items()]
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *more)
    names = ["doc_id", "fp", *(carry or {})]

    def run(batches):
        for b in batches:
            fps = fingerprints(b.column(1).to_pylist(), width)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64)), *b.columns[2:]], names)

    return arrow_map(read, run, ", ".join(["doc_id long", "fp long", *(f"{f.name} {f.dataType.simpleString()}" for f in read.schema.fields[2:])]))


# --- variants: the keys that are shuffled, and those made after the shuffle

_U = np.uint64
_ONE = _U(1)
_SUB = 8  # bits of the flipped half that the shuffle key keeps
_PAIRS = np.array([(1 << i) | (1 << j) for i, j in itertools.combinations(range(32), 2)], np.uint64)
_SINGLES = np.array([1 << i for i in range(32)], np.uint64)
_TOP = _U(((1 << _SUB) - 1) << (32 - _SUB))


def _swap(fp: np.ndarray) -> np.ndarray:
    return (fp << _U(32)) | (fp >> _U(32))


def _even(fp: np.ndarray) -> np.ndarray:
    return np.bitwise_count(fp) % 2 == 0


def _by_key(flips: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Flips of the low half, grouped by what they do to the key's 8 bits of it."""
    top = flips & _TOP
    return [(int(t), flips[top == t]) for t in np.unique(top)]


_TWO_BY_KEY = _by_key(_PAIRS)
_ONE_BY_KEY = _by_key(np.concatenate([np.zeros(1, np.uint64), _SINGLES]))
# role codes: 0..len-1 two-bit groups, then one-bit groups, then a flip of the kept half
_N2, _N1 = len(_TWO_BY_KEY), len(_ONE_BY_KEY)


def _emit(batches):
    """fp -> rows (key, fp, role): the 40 shuffled bits of a set of variants."""
    for b in batches:
        raw = np.asarray(b.column(0)).view(np.uint64)
        keys, fps, roles = [], [], []
        for half in (0, 1):  # 0: two-bit flips in the low half, 1: in the high half
            fp = raw if half == 0 else _swap(raw)

            def put(rows, moved, role, half=half):
                high = moved >> _U(32 - _SUB)  # kept half and 8 bits of the other
                keys.append((high << _ONE) | _U(half))
                fps.append(rows)
                roles.append(np.full(len(rows), role, np.int32))

            even = _even(fp)
            for r, (t, _) in enumerate(_TWO_BY_KEY):
                put(fp[even], fp[even] ^ _U(t), r)
            for r, (t, _) in enumerate(_ONE_BY_KEY):
                put(fp, fp ^ _U(t), _N2 + r)
            for i in range(32):  # a flip of the kept half: the variant is complete
                put(fp, fp ^ _U(1 << (32 + i)), _N2 + _N1 + i)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(fps).view(np.int64)), pa.array(np.concatenate(roles))], ["key", "fp", "role"])


def _expand(fp: np.ndarray, role: np.ndarray, which: range, flips) -> tuple[np.ndarray, np.ndarray]:
    """Variants of the rows with a role in ``which``, and the fingerprints that made them."""
    var, own = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    for r in which:
        f = fp[role == r]
        if len(f):
            fl = flips(r)
            var.append((f[:, None] ^ fl[None, :]).ravel())
            own.append(np.repeat(f, len(fl)))
    return np.concatenate(var), np.concatenate(own)


class _Forest:
    """Union-find over the fingerprints of one task: keeps a spanning forest."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        up = self.up
        root = x
        while up.get(root, root) != root:
            root = up[root]
        while up.get(x, x) != root:
            up[x], x = root, up[x]
        return root

    def link(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.up.setdefault(a, a)
        self.up.setdefault(b, b)
        self.up[max(a, b)] = min(a, b)
        return True


_CHUNK = 1 << 20  # variants compared at a time


def _slot(var: np.ndarray, bits: int) -> np.ndarray:
    return (var * _U(0x9E3779B97F4A7C15)) >> _U(64 - bits)


def _links(key: np.ndarray, fp: np.ndarray, role: np.ndarray):
    """Verified links (a, b) among the rows of whole keys of one half."""
    ones, own1 = _expand(fp, role, range(_N2, _N2 + _N1), lambda r: _ONE_BY_KEY[r - _N2][1])
    kept, own0 = _expand(fp, role, range(_N2 + _N1, _N2 + _N1 + 32), lambda r: np.array([1 << (32 + r - _N2 - _N1)], np.uint64))
    ones, own1 = np.concatenate([ones, kept]), np.concatenate([own1, own0])
    order = np.lexsort((own1, ones))
    ones, own1 = ones[order], own1[order]
    first = np.flatnonzero(np.concatenate([[True], ones[1:] != ones[:-1]])) if len(ones) else np.zeros(0, np.int64)
    bucket, star = ones[first], own1[first]  # each bucket and its first one-bit member
    centre = np.repeat(star, np.diff(np.append(first, len(ones))))
    yield own1, centre
    if not len(bucket):
        return
    bits = min(24, len(bucket).bit_length() + 5)
    seen = np.zeros(1 << bits, bool)  # a first look before the binary search
    seen[_slot(bucket, bits)] = True
    for r in range(_N2):
        f = fp[role == r]
        fl = _TWO_BY_KEY[r][1]
        step = max(1, _CHUNK // len(fl))
        for at in range(0, len(f), step):
            var = (f[at : at + step, None] ^ fl[None, :]).ravel()
            may = np.flatnonzero(seen[_slot(var, bits)])
            pos = np.searchsorted(bucket, var[may])
            pos[pos == len(bucket)] = 0
            hit = bucket[pos] == var[may]
            yield f[at + may[hit] // len(fl)], star[pos[hit]]


def _collide(batches):
    """Rows sorted by key -> a spanning forest of the task's links."""
    forest = _Forest()
    held: list[np.ndarray] = []

    def settle(rows: np.ndarray):
        out = []
        for half in (0, 1):
            part = rows[(rows["key"] & 1) == half]
            for a, b in _links(part["key"], part["fp"].view(np.uint64), part["role"]):
                near = (a != b) & (np.bitwise_count(a ^ b) <= RADIUS)  # the verification
                if near.any():
                    x, y = (a[near], b[near]) if half == 0 else (_swap(a[near]), _swap(b[near]))
                    for u, v in np.unique(np.stack([x, y], axis=1), axis=0).view(np.int64).tolist():
                        if forest.link(u, v):
                            out.append((u, v))
        if out:
            u, v = zip(*out)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    kind = np.dtype([("key", np.int64), ("fp", np.int64), ("role", np.int32)])
    size = 0
    for b in batches:
        rows = np.empty(b.num_rows, kind)
        for name in kind.names:
            rows[name] = np.asarray(b.column(name))
        held.append(rows)
        size += len(rows)
        if size >= 400_000:  # settle all but the last key, which may go on
            rows = np.concatenate(held)
            whole = rows["key"] != rows["key"][-1]
            if whole.any():
                yield from settle(rows[whole])
            held = [rows[~whole]]
            size = len(held[0])
    if size:
        yield from settle(np.concatenate(held))


def fingerprint_links(fps: DataFrame) -> DataFrame:
    """Distinct ``fps(fp long)`` -> (u, v): links that connect exactly the
    fingerprints connected by distances of 3 bits or fewer."""
    rows = fps.mapInArrow(_emit, "key long, fp long, role int")
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(_collide, "u long, v long")


def _grouped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, carry: dict[str, Column] | None = None) -> DataFrame:
    """(doc_id, fp, root, component_id, and the columns of ``carry``): one row
    for each row of docs; root, a fingerprint, names the component also where
    its rows have no or repeated ids."""
    fp = cut(with_fingerprint(docs, id_col, text_col, width, carry))
    own = cut(fp.groupBy("fp").agg(F.min("doc_id").alias("least")))
    root = connected_components(fingerprint_links(own.select("fp")))
    named = own.join(root, own["fp"] == root["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = cut(named)
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = named.select("fp", "root").join(least, "root").select("fp", "root", "component_id")
    return fp.join(by_fp, "fp").select("doc_id", "fp", "root", "component_id", *(carry or {}))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """(doc_id, fp, fingerprint, component_id): one row for each row of docs.

    component_id is the least doc_id reachable over links of 3 or fewer
    differing bits, the row's own included. NULL and empty texts have
    fingerprint zero and are linked like any other; rows with equal ids each
    give a row; a NULL doc_id never names a component (NULL if a component
    has no other); an empty table gives an empty result. Other columns are
    not read.
    """
    return _grouped(docs, id_col, text_col, width).select("doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def duplicate_clusters(docs: DataFrame, carry: dict[str, Column]) -> DataFrame:
    """(doc_id, cluster, and the columns of ``carry``): one row for each row of
    docs. Near-duplicates share a cluster, and so do the rows of one doc_id,
    with all that is near to either."""
    rows = cut(_grouped(docs, carry=carry).select("doc_id", "root", *carry))
    pairs = rows.where("doc_id IS NOT NULL").select("doc_id", "root").distinct()
    apart = pairs.groupBy("doc_id").agg(F.min("root").alias("u"), F.count("*").alias("n")).where("n > 1")
    links = cut(pairs.join(apart, "doc_id").select("u", F.col("root").alias("v")))
    if links.isEmpty():
        return rows.withColumnRenamed("root", "cluster")
    one = connected_components(links).select("node", F.col("root").alias("_one"))
    return rows.join(one, rows["root"] == one["node"], "left").select("doc_id", F.coalesce("_one", "root").alias("cluster"), *carry)


def keep_one(docs: DataFrame) -> DataFrame:
    """docs without the documents that are near-duplicates of one kept: of
    each component the row with the least doc_id stays, whole, the first by
    text if it has several of that id. Rows are told apart by id and text, so
    rows of one id with unlike texts are decided each in its own component;
    rows without a doc_id can't be named as copies and stay."""
    rows = cut(_grouped(docs, carry={"hash": F.xxhash64("text")}).where("doc_id IS NOT NULL").select("doc_id", "hash", "root", "component_id"))
    by_key = rows.groupBy("doc_id", "hash").agg(F.max(F.col("doc_id") == F.col("component_id")).alias("first"), F.min("root").alias("root"), F.count("*").alias("times"))
    gone = by_key.where(~F.col("first")).select(F.col("doc_id").alias("_gone"), F.col("hash").alias("_gone_hash"))
    kept = docs.join(gone, (docs["doc_id"] == gone["_gone"]) & (F.xxhash64(docs["text"]) == gone["_gone_hash"]), "left_anti")
    stay = by_key.where("first")
    twice = cut(stay.join(stay.groupBy("doc_id", "root").agg(F.sum("times").alias("all")).where("all > 1"), ["doc_id", "root"])
                .select(F.col("doc_id").alias("_twice"), F.col("hash").alias("_twice_hash"), "root"))
    if twice.isEmpty():
        return kept
    nth, part = "_n", "_part"
    while {nth, part} & {c.lower() for c in docs.columns}:
        nth, part = nth + "_", part + "_"
    same = (kept["doc_id"] == twice["_twice"]) & (F.xxhash64(kept["text"]) == twice["_twice_hash"])
    order = Window.partitionBy("doc_id", part).orderBy("text", *quoted(docs.drop("doc_id", "text")))
    repeated = kept.join(twice, same).select(*(kept[f"`{c}`"] for c in docs.columns), twice["root"].alias(part)).withColumn(nth, F.row_number().over(order)).where(F.col(nth) == 1).drop(nth, part)
    return kept.join(twice, same, "left_anti").unionByName(repeated)
