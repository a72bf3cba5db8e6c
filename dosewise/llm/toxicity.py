"""Toxicity by non-negative positive-unlabelled learning (Kiryo et al., 2017).

A logistic model over the distinct words of a text and their prefixes is
learned on the driver from confirmed toxic examples P and unlabelled text U:

    R = pi * R_p(+) + max(0, R_u(-) - pi * R_p(-))

with class prior pi; when the corrected negative risk falls below zero, its
gradient is taken back instead, so that U's hidden positives aren't fitted as
negatives. P and U hold at most ``positives`` and ``unlabelled`` documents;
the model is a vector of 2^17 floats that travels with the scoring tasks.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, held_out, labelled_ids, sigmoid

BUCKETS = 1 << 17
THRESHOLD = 0.7
MODULUS, REMAINDER = 3, 1  # the held-out fold
_WORD = re.compile(r"[^\W\d_]+")
_MEMO = 200_000  # words whose features a task remembers at a time


class Featurizer:
    """Distinct feature buckets of a text: its words, and prefixes of 4 and 5 letters."""

    def __init__(self):
        self.memo: dict[str, tuple[int, ...]] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        out: set[int] = set()
        for w in set(_WORD.findall((text or "").lower())):
            got = self.memo.get(w)
            if got is None:
                if len(self.memo) >= _MEMO:
                    self.memo.clear()
                got = self.memo[w] = tuple(zlib.crc32(x.encode()) % BUCKETS for x in {w, *(f"{w[:k]}*" for k in (4, 5) if len(w) > k)})
            out.update(got)
        return np.fromiter(out, np.int64, len(out))


class PUModel:
    def __init__(self, w: np.ndarray, bias: float):
        self.w, self.bias = w.astype(np.float32), bias

    def score(self, docs: list[np.ndarray]) -> np.ndarray:
        rows = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
        return sigmoid(self.bias + np.bincount(rows, self.w[np.concatenate([*docs, np.zeros(0, np.int64)])].astype(float), len(docs)))


def copy_weights(docs: list[np.ndarray], least: float = 0.8) -> np.ndarray:
    """1 / size of each document's group of near copies, which would make every
    word of theirs look telling: documents meet in bands of min-hashes and are
    copies from a Jaccard similarity of ``least`` of their features on."""
    up = list(range(len(docs)))

    def root(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    factor = np.random.default_rng(5).integers(1, 1 << 61, (1, 64), np.uint64) | np.uint64(1)
    signs = [((d.astype(np.uint64) + np.uint64(1))[:, None] * factor).min(0, initial=np.uint64(2**64 - 1)) for d in docs]
    for band in range(0, 64, 4):
        first: dict[bytes, int] = {}
        for i, sign in enumerate(signs):
            j = first.setdefault(sign[band : band + 4].tobytes(), i)
            if root(i) != root(j):
                both = len(np.intersect1d(docs[i], docs[j]))
                if both >= least * (len(docs[i]) + len(docs[j]) - both):
                    up[root(i)] = root(j)
    group = np.array([root(i) for i in range(len(docs))], np.int64)
    return 1.0 / np.bincount(group)[group] if docs else np.zeros(0)


def pu_risk(f: np.ndarray, pos: np.ndarray, weight: np.ndarray, prior: float) -> tuple[float, np.ndarray]:
    """The risk of logits f with the logistic loss, and the step's direction by
    f: the gradient, or, where the corrected negative risk is below zero, that
    of taking it back. ``weight`` sums to 1 over P and over U."""
    q = sigmoid(f)
    p_neg, u_neg = (weight * np.logaddexp(0, f))[pos].sum(), (weight * np.logaddexp(0, f))[~pos].sum()
    p_pos = (weight * np.logaddexp(0, -f))[pos].sum()
    negative = weight * np.where(pos, -prior * q, q)
    if u_neg - prior * p_neg < 0:
        return prior * p_pos, -negative
    return prior * p_pos + u_neg - prior * p_neg, negative - np.where(pos, prior * weight * (1 - q), 0)


def telling(in_p: np.ndarray, in_u: np.ndarray, n_p: int, n_u: int, least: int = 3, deviations: float = 4.0) -> np.ndarray:
    """Features that are in at least ``least`` examples, and in a larger share
    of the examples than of the unlabelled texts by so many deviations."""
    share = (in_p + in_u) / (n_p + n_u)
    sd = np.sqrt(share * (1 - share) * (1 / n_p + 1 / n_u)) + 1e-12
    return np.flatnonzero((in_p >= least) & (in_p / n_p - in_u / n_u >= deviations * sd))


def fit(p: list[np.ndarray], u: list[np.ndarray], prior: float, steps: int = 150, decay: float = 1e-4) -> PUModel:
    """Logistic loss, Adam over the whole sample; a group of near copies in P
    weighs as one example. Without P or U every score is the prior."""
    bias = float(np.log(prior / (1 - prior)))
    if not p or not u:
        return PUModel(np.zeros(BUCKETS), bias)
    docs = [*p, *u]
    pos = np.arange(len(docs)) < len(p)
    one = np.concatenate([copy_weights(p), np.ones(len(u))])
    groups = one[pos].sum()
    weight = np.where(pos, one / groups, one / len(u))
    at = np.concatenate(docs)
    row = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    mine = pos[row]
    used = telling(np.bincount(at[mine], one[row[mine]], BUCKETS), np.bincount(at[~mine], minlength=BUCKETS), groups, len(u))
    place = np.full(BUCKETS, -1)
    place[used] = np.arange(len(used))
    at = place[at]
    at, row = at[at >= 0], row[at >= 0]
    w = np.zeros(len(used) + 1)
    m, s = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        _, g = pu_risk(bias + w[-1] + np.bincount(row, w[at], len(docs)), pos, weight, prior)
        d = np.append(np.bincount(at, g[row], len(used)), g.sum())
        d[:-1] += decay * w[:-1] * prior
        m += 0.1 * (d - m)
        s += 0.01 * (d * d - s)
        w -= 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.99**t)) + 1e-8)
    full = np.zeros(BUCKETS)
    full[used] = w[:-1]
    return PUModel(full, bias + float(w[-1]))


def _features(docs: DataFrame) -> DataFrame:
    """(doc_id, at): documents, one for each doc_id, as feature lists."""
    one = docs.groupBy("doc_id").agg(F.min("text").alias("text"))

    def run(batches):
        make = Featurizer()
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([make(t).tolist() for t in b.column(1).to_pylist()], pa.list_(pa.int32()))], ["doc_id", "at"])

    return arrow_map(one.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, at array<int>")


def learn(docs: DataFrame, labels: DataFrame, positives: int = 2000, unlabelled: int = 4000) -> PUModel:
    """A model of ``labels.toxic``; nothing of the held-out fold is read."""
    rows = labels.where(~held_out(F.col("doc_id"), MODULUS, REMAINDER)).select("toxic").dropna()
    toxic, total = rows.agg(F.sum(F.col("toxic").cast("long")), F.count("*")).first()
    prior = min(0.5, ((toxic or 0) + 1) / (total + 2))
    known = labelled_ids(labels, "toxic", MODULUS, REMAINDER, positives)[1].select("doc_id", F.lit(1).alias("y"))
    ids = docs.select("doc_id").dropna().where(~held_out(F.col("doc_id"), MODULUS, REMAINDER))
    other = ids.orderBy(F.xxhash64("doc_id", F.lit("u")), "doc_id").limit(unlabelled).select("doc_id", F.lit(0).alias("y"))
    chosen = F.broadcast(known.union(other).groupBy("doc_id").agg(F.max("y").alias("p"), F.max(F.when(F.col("y") == 0, 1).otherwise(0)).alias("u")))
    text = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    picked = _features(text.join(chosen.select("doc_id"), "doc_id", "left_semi")).join(chosen, "doc_id")
    got = sorted(picked.collect(), key=lambda r: r["doc_id"])
    lists = [(np.array(r["at"], np.int64), r["p"], r["u"]) for r in got]
    return fit([a for a, p, _ in lists if p], [a for a, _, u in lists if u], prior)


def score_toxicity(docs: DataFrame, model: PUModel) -> DataFrame:
    """docs(doc_id, text) -> (doc_id, held_out, score, predicted), one row for
    each row. NULL and empty texts have no features and get the bias' score; a
    NULL doc_id counts as held out; other columns are not read."""

    def run(batches):
        make = Featurizer()
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score([make(t) for t in b.column(1).to_pylist()]), pa.float64())], ["doc_id", "score"])

    rows = arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), run, "doc_id long, score double")
    return rows.select("doc_id", held_out(F.col("doc_id"), MODULUS, REMAINDER).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
