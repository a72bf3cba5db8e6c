"""Quality classifier: a factorisation machine over hashed words, structure
statistics and the recorded length.

score = sigmoid(b + w.x + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2]):
all pairwise interactions in time linear in the features of a document.

Learned on the driver from at most ``per_class`` labelled documents of each
class (features are made on the executors, at most ``WORD_BUCKETS`` of them a
document); the model is some 100 kB and travels with the scoring tasks.
doc_id, lang, source and labels are not inputs of a score.
"""

from __future__ import annotations

import operator
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, held_out, labelled_ids, sigmoid

WORD_BUCKETS = 2048
STATS = (
    "log_words", "word_length", "distinct", "top_word", "repeat_next", "upper", "digit", "stops", "symbols",
    "lines", "repeated_lines", "bytes_per_char", "short_words", "log_recorded", "recorded_off",
)
FACTORS = 8
THRESHOLD = 0.3
MODULUS, REMAINDER = 5, 0  # the held-out fold
_SYMBOL = np.zeros(256)
_SYMBOL[list(b"!\"#$%&*+/<=>@[\\]^_`{|}~")] = 1
_STOP = np.zeros(256)
_STOP[list(b".,;:?")] = 1


def features(text: str | None, recorded: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word buckets, their values, structure statistics) of a whole text."""
    text = text or ""
    words = text.split()
    n = len(words)
    counts = Counter(text.lower().split())
    at, val = np.zeros(0, np.int64), np.zeros(0)
    if counts:
        by = np.bincount([zlib.crc32(w.encode()) % WORD_BUCKETS for w in counts], list(counts.values()), WORD_BUCKETS)
        at = np.flatnonzero(by)
        val = np.log1p(by[at])
        val /= np.sqrt((val * val).sum())
    raw = np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=256)
    size, chars = max(1, int(raw.sum())), len(text)
    upper, lower = raw[65:91].sum(), raw[97:123].sum()
    lines = [x for x in text.split("\n") if x]
    stats = np.array([
        np.log1p(n), sum(map(len, words)) / max(1, n), len(counts) / max(1, n), max(counts.values(), default=0) / max(1, n),
        sum(map(operator.eq, words, words[1:])) / max(1, n), upper / max(1, upper + lower), raw[48:58].sum() / size,
        (raw * _STOP).sum() / size, (raw * _SYMBOL).sum() / size, len(lines) / max(1, n), 1 - len(set(lines)) / max(1, len(lines)),
        size / max(1, chars), sum(len(w) < 4 for w in words) / max(1, n),
        np.log1p(max(0, chars if recorded is None else recorded)), float(recorded is not None and recorded != chars),
    ])
    return at, val, stats


@dataclass
class FactorisationMachine:
    bias: float
    w: np.ndarray  # WORD_BUCKETS + len(STATS)
    v: np.ndarray  # the same, by FACTORS
    mean: np.ndarray
    std: np.ndarray

    def score(self, docs: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
        return sigmoid(self.raw(*flat(docs, self.mean, self.std)))

    def raw(self, row: np.ndarray, at: np.ndarray, x: np.ndarray, n: int) -> np.ndarray:
        z = self.bias + np.bincount(row, x * self.w[at], n)
        for f in range(self.v.shape[1]):
            vx = x * self.v[at, f]
            z += 0.5 * (np.bincount(row, vx, n) ** 2 - np.bincount(row, vx * vx, n))
        return z


def flat(docs, mean, std):
    """Documents as (row, feature, value) arrays; statistics are standardised, and held to three deviations."""
    if not docs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), 0
    extra = np.clip((np.stack([s for _, _, s in docs]) - mean) / std, -3, 3) / 2
    k = extra.shape[1]
    row = np.concatenate([np.repeat(np.arange(len(docs)), [len(a) for a, _, _ in docs]), np.repeat(np.arange(len(docs)), k)])
    at = np.concatenate([*(a for a, _, _ in docs), np.tile(WORD_BUCKETS + np.arange(k), len(docs))]).astype(np.int64)
    return row, at, np.concatenate([*(v for _, v, _ in docs), extra.ravel()]), len(docs)


def fit(docs: list, y: np.ndarray, prior: float, steps: int = 80, seed: int = 7) -> FactorisationMachine:
    """Logistic loss, Adam over the whole sample. The classes weigh alike while
    learning; then the bias is moved to the ``prior`` of label 1. With no
    example of a class, every score is the prior."""
    dim = WORD_BUCKETS + len(STATS)
    fm = FactorisationMachine(float(np.log(prior / (1 - prior))), np.zeros(dim), np.zeros((dim, FACTORS)), np.zeros(len(STATS)), np.ones(len(STATS)))
    if not len(y) or y.min() == y.max():
        return fm
    stats = np.stack([s for _, _, s in docs])
    fm.mean, fm.std = stats.mean(0), stats.std(0) + 1e-6
    row, at, x, n = flat(docs, fm.mean, fm.std)
    weight = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum())
    fm.bias, fm.v = 0.0, np.random.default_rng(seed).normal(0, 0.05, (dim, FACTORS))
    mom = [[np.zeros(1), np.zeros(1)], [np.zeros(dim), np.zeros(dim)], [np.zeros((dim, FACTORS)), np.zeros((dim, FACTORS))]]
    decay = 2e-4
    for t in range(1, steps + 1):
        sums = np.stack([np.bincount(row, x * fm.v[at, f], n) for f in range(FACTORS)], 1)
        g = weight * (sigmoid(fm.raw(row, at, x, n)) - y)
        gx = g[row] * x
        gv = np.stack([np.bincount(at, gx * sums[row, f], dim) for f in range(FACTORS)], 1) - fm.v * np.bincount(at, gx * x, dim)[:, None]
        grads = [np.array([g.sum()]), np.bincount(at, gx, dim) + decay * fm.w, gv + decay * fm.v]
        moves = []
        for (m, s), d in zip(mom, grads):
            m += 0.1 * (d - m)
            s += 0.01 * (d * d - s)
            moves.append(0.05 * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.99**t)) + 1e-8))
        fm.bias -= float(moves[0][0])
        fm.w -= moves[1]
        fm.v -= moves[2]
    fm.bias += float(np.log(prior / (1 - prior)))
    return fm


def _texts(docs: DataFrame) -> DataFrame:
    recorded = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")
    return docs.select("doc_id", F.col("text").cast("string").alias("text"), recorded.alias("n_chars"))


def learn(docs: DataFrame, labels: DataFrame, per_class: int = 1000) -> FactorisationMachine:
    """A model of ``labels.quality`` from at most ``per_class`` documents a class, none of the held-out fold."""
    ids = labelled_ids(labels, "quality", MODULUS, REMAINDER, per_class)
    rows = labels.where(~held_out(F.col("doc_id"), MODULUS, REMAINDER)).select("quality").dropna()
    good, total = rows.agg(F.sum(F.col("quality").cast("long")), F.count("*")).first()
    prior = ((good or 0) + 1) / (total + 2)
    chosen = F.broadcast(ids[0].union(ids[1]))  # at most 2 x per_class ids
    one = _texts(docs).join(chosen, "doc_id").groupBy("doc_id").agg(F.min(F.struct("text", "n_chars")).alias("d"), F.max("y").alias("y"))

    def run(batches):
        for b in batches:
            f = [features(t, n) for t, n in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(3).cast(pa.int32()), *(pa.array([x[i].tolist() for x in f], t) for i, t in enumerate((pa.list_(pa.int32()), pa.list_(pa.float32()), pa.list_(pa.float64()))))],
                ["doc_id", "y", "at", "val", "stats"])

    flat_rows = arrow_map(one.select(F.col("doc_id").cast("long").alias("doc_id"), "d.text", "d.n_chars", F.col("y").cast("int").alias("y")), run,
                          "doc_id long, y int, at array<int>, val array<float>, stats array<double>")
    got = sorted(flat_rows.collect(), key=lambda r: r["doc_id"])
    sample = [(np.array(r["at"], np.int64), np.array(r["val"], np.float32).astype(float), np.array(r["stats"])) for r in got]
    return fit(sample, np.array([r["y"] for r in got], float), prior)


def score_quality(docs: DataFrame, model: FactorisationMachine) -> DataFrame:
    """docs(doc_id, text[, n_chars]) -> (doc_id, held_out, score, predicted),
    one row for each row. NULL and empty texts are scored as empty; a NULL
    doc_id counts as held out; other columns are not read."""

    def run(batches):
        for b in batches:
            s = model.score([features(t, n) for t, n in zip(b.column(1).to_pylist(), b.column(2).to_pylist())])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64())], ["doc_id", "score"])

    rows = arrow_map(_texts(docs).withColumn("doc_id", F.col("doc_id").cast("long")), run, "doc_id long, score double")
    return rows.select("doc_id", held_out(F.col("doc_id"), MODULUS, REMAINDER).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: FactorisationMachine) -> DataFrame:
    """The rows of docs that the model doesn't reject, all columns unchanged."""
    columns = docs.columns
    t, c = columns.index("text"), columns.index("n_chars") if "n_chars" in columns else None

    def run(batches):
        for b in batches:
            recorded = b.column(c).to_pylist() if c is not None else [None] * b.num_rows
            keep = model.score([features(x, n) for x, n in zip(b.column(t).to_pylist(), recorded)]) >= THRESHOLD
            yield b.filter(pa.array(keep, pa.bool_()))

    return arrow_map(docs, run, docs.schema)
