"""Secrets: fixed patterns, and a character convolutional network over every other candidate and its surroundings.

Base kinds (contract): assign (a name such as password or token, an operator
and a value of six characters or more), access (AKIA..., 20 or more), hex (24
or more). They stay whatever the network says.

Candidates are the runs of value characters that hold a digit (``SHORTEST`` or
more characters) or are long (``LONG`` or more). The network reads a
candidate's whole run and ``NEAR`` characters on either side: characters
inside and outside the run have embeddings of their own, a convolution of
``WIDTH`` characters makes ``FILTERS`` features, their maxima over the text
go through one hidden layer to a logit. As embedding and kernel meet in a
table of (place in kernel, character), a text costs WIDTH look-ups a character.

It learns from labelled findings, all of them: candidates with a flag whether
they are secrets. Executors learn: findings are dealt by a hash of their text
into parts, each part makes its steps from the network of the round before, and
the round's network is the mean of the parts', weighted by their findings. Only
networks meet on the driver. A quarter of the findings (by a hash of their
text) isn't learned from but calibrates: Platt scaling makes the logit a
probability, and for candidates behind an operator and for bare ones the
threshold is the one with the fewest false findings that still finds ``RECALL``
of the calibration part's secrets. Both are told from counts of the logits in
bins of ``BIN``, so that the driver holds bins, not findings.
A finding of the network that touches a base span tells nothing new and goes.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, cut, sigmoid

# Fixed values of the contract.
BASE = ("assign", "access", "hex")
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
VALUE = "A-Za-z0-9+/_.=-"

ADDED = "learned"
SHORTEST, LONG, NEAR = 8, 20, 24
WIDTH, EMBEDDING, FILTERS, HIDDEN = 5, 6, 24, 12
RECALL = 0.95
LEAST_SECRETS = 10  # calibration secrets of a group that has a threshold of its own
EPOCHS, BATCH, BATCH_CHARS = 24, 64, 1 << 16
ROUNDS, PART = 6, 10_000  # rounds of learning in parts, about so many findings a part
BIN = 1 / 64  # of a logit
PIECE = 4096  # places of a long text that are convolved at once

_OPERATOR = re.compile("[:=]")
_AFTER = re.compile(rf"\x20*[\"']?([{VALUE}]+)")
_ACCESS = re.compile("AKIA[A-Z0-9]+")
_HEX = re.compile("[0-9a-f]{24,}")
_LONG = re.compile(rf"(?<![{VALUE}])[{VALUE}]{{{LONG},}}")
_DIGIT = re.compile(rf"[0-9][{VALUE}]*")
_IN_VALUE = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")
_KEYED = re.compile("[:=][\x20\"']*$")


def _named(text: str, op: int) -> int:
    """Start of the name that ends before the operator at ``op``, past spaces and a quote; -1 if there is none."""
    end = op
    while end and text[end - 1] == " ":
        end -= 1
    for e in (end, end - 1) if end and text[end - 1] in "\"'" else (end,):
        tail = text[max(0, e - 8) : e].translate(_LOWER)
        for name in NAMES:
            if tail.endswith(name):
                return e - len(name)
    return -1


_LOWER = {c: c + 32 for c in range(65, 91)}


def _base(text: str) -> Iterator[tuple[str, int, int]]:
    end = 0
    for m in _OPERATOR.finditer(text):
        at = m.start()
        if at >= end and (start := _named(text, at)) >= end and (v := _AFTER.match(text, at + 1)):
            end = v.end()
            if end - v.start(1) >= 6:
                yield "assign", start, end
    for m in _ACCESS.finditer(text):
        if m.end() - m.start() >= 20:
            yield "access", m.start(), m.end()
    for m in _HEX.finditer(text):
        yield "hex", m.start(), m.end()


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns by start, then kind."""
    return sorted(_base(text or ""), key=lambda s: (s[1], BASE.index(s[0])))


def candidates(text: str) -> list[tuple[int, int]]:
    """Runs of value characters for the network, without dots and signs at their ends, in order."""
    spans, end = set(), 0
    for m in _DIGIT.finditer(text):
        start = m.start()
        while start > end and text[start - 1] in _IN_VALUE:
            start -= 1
        end = m.end()
        if end - start >= SHORTEST:
            spans.add((start, end))
    spans.update(m.span() for m in _LONG.finditer(text))
    out = []
    for a, b in sorted(spans):
        run = text[a:b].rstrip(".=-")
        b = a + len(run)
        a = b - len(run.lstrip(".=-"))
        if b - a >= SHORTEST:
            out.append((a, b))
    return out


class Overlaps:
    """Whether a span touches one of the given ones, by binary search."""

    def __init__(self, spans):
        self.merged: list[list[int]] = []
        for a, b in sorted(spans):
            if self.merged and a < self.merged[-1][1]:
                self.merged[-1][1] = max(b, self.merged[-1][1])
            else:
                self.merged.append([a, b])
        self.ends = [b for _, b in self.merged]

    def __call__(self, a: int, b: int) -> bool:
        i = bisect_right(self.ends, a)
        return i < len(self.merged) and self.merged[i][0] < b


# characters: 0 padding, 1 to 95 printable ASCII, 96 other white space, 97 any other; then the same inside a candidate
_OUTSIDE = 98
_CHAR = np.full(256, 97, np.int64)
_CHAR[32:127] = np.arange(1, 96)
_CHAR[[9, 10, 11, 12, 13]] = 96


def _encoded(left: str, value: str, right: str) -> np.ndarray:
    """A candidate and its surroundings as characters, padded so that every place of it is in every place of the kernel."""
    pad = " " * (WIDTH - 1)
    raw = f"{pad}{left}{value}{right}{pad}".encode("latin-1", "replace")
    ids = _CHAR[np.frombuffer(raw, np.uint8)]
    ids[: WIDTH - 1] = 0
    ids[-(WIDTH - 1) :] = 0
    at = WIDTH - 1 + len(left)
    ids[at : at + len(value)] += _OUTSIDE
    return ids


def views(text: str, a: int, b: int) -> tuple[str, str, str]:
    return text[max(0, a - NEAR) : a], text[a:b], text[b : b + NEAR]


def keyed(left: str) -> bool:
    """Whether a candidate stands behind an operator."""
    return bool(_KEYED.search(left))


@dataclass
class CharNet:
    embedding: np.ndarray  # 2 * _OUTSIDE, EMBEDDING
    kernel: np.ndarray  # WIDTH, EMBEDDING, FILTERS
    bias: np.ndarray
    hidden: np.ndarray  # FILTERS + 1, HIDDEN
    hidden_bias: np.ndarray
    out: np.ndarray  # HIDDEN
    out_bias: np.ndarray
    scale: tuple[float, float] = (1.0, 0.0)
    thresholds: dict[bool, float] = field(default_factory=lambda: {True: 2.0, False: 2.0})

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, self.kernel, self.bias, self.hidden, self.hidden_bias, self.out, self.out_bias]

    def forward(self, texts: list[np.ndarray]):
        table = np.einsum("ce,jef->jcf", self.embedding, self.kernel)
        ids = np.concatenate(texts)
        sizes = np.array([len(t) for t in texts])
        starts = np.cumsum(sizes) - sizes
        # windows that reach into the next text hold padding only at the border, as each text ends and begins with it
        ends = np.minimum(starts + sizes - WIDTH + 1, len(ids) - WIDTH + 1)

        def convolved(at: int, end: int) -> np.ndarray:
            conv = table[0][ids[at:end]]
            for j in range(1, WIDTH):
                conv = conv + table[j][ids[at + j : end + j]]
            return conv

        if len(ids) <= 2 * BATCH_CHARS:
            conv = convolved(0, len(ids) - WIDTH + 1)
            top = np.stack([conv[s:e].argmax(0) for s, e in zip(starts, ends)]) + starts[:, None]
            pooled = np.take_along_axis(conv, top, 0)
        else:  # long texts, piece by piece
            top, pooled = np.zeros((len(texts), FILTERS), np.int64), np.full((len(texts), FILTERS), -np.inf)
            for i, (start, end) in enumerate(zip(starts, ends)):
                for at in range(start, end, PIECE):
                    conv = convolved(at, min(at + PIECE, end))
                    best = conv.argmax(0)
                    value = conv[best, np.arange(FILTERS)]
                    better = value > pooled[i]
                    top[i][better], pooled[i][better] = best[better] + at, value[better]
        pooled = pooled + self.bias
        length = np.log1p((np.add.reduceat(ids >= _OUTSIDE, starts)))[:, None] / 5
        x = np.concatenate([np.maximum(pooled, 0), length], 1)
        h = np.maximum(x @ self.hidden + self.hidden_bias, 0)
        return ids, top, pooled, x, h, h @ self.out + self.out_bias[0]

    def logits(self, texts: list[np.ndarray]) -> np.ndarray:
        return self.forward(texts)[-1]

    def gradients(self, texts: list[np.ndarray], y: np.ndarray, weight: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Weighted logistic loss and its gradient by each parameter."""
        ids, top, pooled, x, h, z = self.forward(texts)
        loss = float((weight * (np.logaddexp(0, z) - y * z)).sum())
        dz = weight * (sigmoid(z) - y)
        dh = np.outer(dz, self.out) * (h > 0)
        dx = dh @ self.hidden.T
        dp = dx[:, :-1] * (pooled > 0)
        table = np.zeros((WIDTH, 2 * _OUTSIDE, FILTERS))
        filters = np.broadcast_to(np.arange(FILTERS), top.shape)
        for j in range(WIDTH):
            np.add.at(table[j], (ids[top + j], filters), dp)
        return loss, [np.einsum("jcf,jef->ce", table, self.kernel), np.einsum("jcf,ce->jef", table, self.embedding), dp.sum(0), x.T @ dh, dh.sum(0), h.T @ dz, np.array([dz.sum()])]

    def probability(self, texts: list[np.ndarray]) -> np.ndarray:
        a, b = self.scale
        return sigmoid(a * self.logits(texts) + b) if texts else np.zeros(0)


def start_net(seed: int = 11) -> CharNet:
    rng = np.random.default_rng(seed)
    return CharNet(
        rng.normal(0, 0.5, (2 * _OUTSIDE, EMBEDDING)), rng.normal(0, 0.3, (WIDTH, EMBEDDING, FILTERS)), np.zeros(FILTERS),
        rng.normal(0, 0.3, (FILTERS + 1, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.3, HIDDEN), np.zeros(1),
    )


def platt(z: np.ndarray, y: np.ndarray, steps: int = 50, count: np.ndarray | None = None) -> tuple[float, float]:
    """Scale and shift of the logits with the least logistic loss on smoothed
    targets (Platt 1999), by damped Newton steps; a logit never turns round.
    ``count``: how often each (logit, class) was met."""
    c = np.ones(len(z)) if count is None else count
    pos, neg = c[y == 1].sum(), c[y == 0].sum()
    target = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, 0.0
    for _ in range(steps):
        q = sigmoid(a * z + b)
        g = np.array([(c * (q - target) * z).sum(), (c * (q - target)).sum()])
        r = c * (q * (1 - q) + 1e-9)
        step = np.linalg.solve([[(r * z * z).sum() + 1e-6, (r * z).sum()], [(r * z).sum(), r.sum() + 1e-6]], g)
        a, b = max(1e-3, a - float(np.clip(step[0], -0.5, 0.5))), b - float(np.clip(step[1], -1.0, 1.0))
    return a, b


def recalling(z: np.ndarray, y: np.ndarray, recall: float, count: np.ndarray | None = None) -> float:
    """The threshold with the fewest false findings at which so large a share
    of the secrets is found: of all that find the same, the middle between the
    last secret above and the next other finding below. ``count`` as in ``platt``."""
    c = np.ones(len(z), np.int64) if count is None else count
    order = np.argsort(-z[y == 1], kind="stable")
    found, reached = z[y == 1][order], np.cumsum(c[y == 1][order])
    last = found[np.searchsorted(reached, max(1, int(np.ceil(recall * reached[-1]))))]
    below = z[(y == 0) & (z < last)]
    return float((last + below.max()) / 2 if len(below) else last)


@dataclass(frozen=True)
class Finding:
    left: str
    value: str
    right: str
    secret: bool


def held(f: Finding) -> bool:
    """Whether a finding calibrates, instead of being learned from."""
    return zlib.crc32(f"{f.left}\0{f.value}".encode("utf-8", "replace")) % 4 == 0


def _batches(sizes: np.ndarray, batch: int) -> Iterator[tuple[int, int]]:
    """Ranges of at most ``batch`` texts and, unless one text alone is longer, ``BATCH_CHARS`` characters."""
    start = chars = 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and (i - start == batch or chars + n > BATCH_CHARS):
            yield start, i
            start, chars = i, 0
        chars += n
    if start < len(sizes):
        yield start, len(sizes)


def improve(net: CharNet, findings: list[Finding], epochs: int, classes: tuple[int, int], batch: int = BATCH, seed: int = 3) -> CharNet:
    """The network after ``epochs`` passes over the findings (Adam). Every one
    also comes without its surroundings, and both with upper and lower case
    exchanged, so that a value counts beside its name. ``classes``: how many of
    all findings, here and elsewhere, are (not secret, secret); the two weigh alike."""
    texts = [_encoded(*v) for f in findings for v in ((f.left, f.value, f.right), ("", f.value, ""), (f.left, f.value.swapcase(), f.right), ("", f.value.swapcase(), ""))]
    labels = np.repeat(np.array([f.secret for f in findings], float), 4)
    weight = np.where(labels == 1, 0.5 / classes[1], 0.5 / classes[0]) * sum(classes)  # 1 on average
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in net.parameters()]
    rng, t, sizes = np.random.default_rng(seed), 0, np.array([len(x) for x in texts])
    for _ in range(epochs):
        deal = rng.permutation(len(texts))
        for lo, hi in _batches(sizes[deal], batch):
            some = deal[lo:hi]
            _, grads = net.gradients([texts[i] for i in some], labels[some], weight[some] / len(some))
            t += 1
            for p, (m, s), g in zip(net.parameters(), moments, grads):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                p -= 0.01 * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-8)
    return net


def binned(net: CharNet, findings: list[Finding]) -> dict[tuple[bool, bool, int], int]:
    """How many calibrating views are (behind an operator, secret, in a bin of
    logits): each finding counts with its surroundings and as its bare value."""
    out: dict[tuple[bool, bool, int], int] = {}
    views = [(v, f.secret) for f in findings for v in ((f.left, f.value, f.right), ("", f.value, ""))]
    texts = [_encoded(*v) for v, _ in views]
    for lo, hi in _batches(np.array([len(x) for x in texts]), 512):
        for (v, secret), z in zip(views[lo:hi], net.logits(texts[lo:hi])):
            k = keyed(v[0]), secret, int(np.floor(z / BIN))
            out[k] = out.get(k, 0) + 1
    return out


def calibrate(net: CharNet, bins: dict[tuple[bool, bool, int], int], recall: float) -> CharNet:
    """Sets scale and thresholds; without a calibration secret nothing is found."""
    items = sorted(bins.items())
    behind, y = np.array([k[0] for k, _ in items], bool), np.array([k[1] for k, _ in items], float)
    z, count = (np.array([k[2] for k, _ in items], float) + 0.5) * BIN, np.array([n for _, n in items], np.int64)
    if not y.any():
        return net
    a, b = net.scale = platt(z, y, count=count)
    for k in (True, False):
        some = behind == k if count[(behind == k) & (y == 1)].sum() >= LEAST_SECRETS else np.ones(len(z), bool)
        net.thresholds[k] = float(sigmoid(a * recalling(z[some], y[some], recall, count[some]) + b))
    return net


def fit(findings: list[Finding], recall: float = RECALL, epochs: int = EPOCHS, batch: int = BATCH) -> CharNet:
    """A calibrated network of findings in memory. Without calibration secrets or
    without examples of both classes no threshold can hold: nothing is found."""
    net = start_net()
    learned, calibrating = [f for f in findings if not held(f)], [f for f in findings if held(f)]
    secrets = sum(f.secret for f in learned)
    if not secrets or secrets == len(learned) or not any(f.secret for f in calibrating):
        return net
    improve(net, learned, epochs, (len(learned) - secrets, secrets), batch)
    return calibrate(net, binned(net, calibrating), recall)


def mean_net(nets: list[tuple[int, list[bytes]]]) -> CharNet:
    """The mean of networks given as (findings, parameters), weighted by their findings."""
    net, total = start_net(), sum(n for n, _ in nets)
    for i, p in enumerate(net.parameters()):
        p[...] = sum(n * np.frombuffer(x[i], float).reshape(p.shape) for n, x in nets) / total
    return net


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def labelled_findings(docs: DataFrame) -> DataFrame:
    """(doc_id, start, left, value, right, secret) of every candidate of docs,
    labelled by the fixed patterns: a candidate is a secret if a base span touches it."""

    def run(batches):
        for b in batches:
            out: list[tuple] = []
            for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if t:
                    touched = Overlaps((x, y) for _, x, y in base_spans(t))
                    out += [(d, x, *views(t, x, y), touched(x, y)) for x, y in candidates(t)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate((pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.bool_()))],
                                             ["doc_id", "start", "left", "value", "right", "secret"])

    return arrow_map(_rows(docs), run, "doc_id long, start long, left string, value string, right string, secret boolean")


def _in_parts(rows: DataFrame, fn, schema: str) -> DataFrame:
    """``fn(part, findings)`` of each part of rows, in order of their text."""

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by([(c, "ascending") for c in ("left", "value", "right")])
        got = [Finding(*x) for x in zip(*(t[c].to_pylist() for c in ("left", "value", "right", "secret")))]
        return fn(t["part"][0].as_py(), got)

    return rows.groupBy("part").applyInArrow(run, schema)


def learn(findings: DataFrame, recall: float = RECALL, part: int = PART) -> CharNet:
    """A network from all labelled findings, one of each text (see ``Finding``
    and ``fit``), learned on the executors in parts of about ``part`` findings:
    ``EPOCHS`` passes over each part, between which the parts' networks are
    ``ROUNDS`` times averaged. A single part makes all its passes at once."""
    one = findings.groupBy("left", "value", "right").agg(F.max("secret").alias("secret"))
    one = cut(one.withColumn("held", F.crc32(F.concat("left", F.lit("\0"), "value").cast("binary")) % 4 == 0))
    seen = {(r["held"], r["secret"]): r["count"] for r in one.groupBy("held", "secret").count().collect()}
    classes = seen.get((False, False), 0), seen.get((False, True), 0)
    net = start_net()
    if not all(classes) or not seen.get((True, True)):
        return net

    def dealt(held: bool) -> DataFrame:  # parts in tasks of their own
        parts = max(1, -(-sum(n for (h, _), n in seen.items() if h == held) // part))
        at = F.pmod(F.xxhash64("left", "value", "right"), F.lit(parts)).cast("int")
        return one.where(F.col("held") == held).withColumn("part", at).repartition(parts, "part")

    rounds = ROUNDS if sum(classes) > part else 1
    for turn in range(rounds):
        net = _round(dealt(False), net, EPOCHS // rounds, classes, turn)

    def counted(_, some: list[Finding]) -> pa.Table:
        items = sorted(binned(net, some).items())
        return pa.table({"behind": pa.array([k[0] for k, _ in items], pa.bool_()), "secret": pa.array([k[1] for k, _ in items], pa.bool_()),
                         "bin": pa.array([k[2] for k, _ in items], pa.int64()), "n": pa.array([n for _, n in items], pa.int64())})

    bins = _in_parts(dealt(True), counted, "behind boolean, secret boolean, bin long, n long").groupBy("behind", "secret", "bin").agg(F.sum("n").alias("n"))
    return calibrate(net, {(r["behind"], r["secret"], r["bin"]): r["n"] for r in bins.collect()}, recall)


def _round(rows: DataFrame, net: CharNet, epochs: int, classes: tuple[int, int], turn: int) -> CharNet:
    """The mean of the parts' networks after so many passes, each from ``net``.
    Means of up to 64 parts are made on the executors, so that the driver's few
    networks don't grow with the findings as long as parts are fewer than some thousands."""
    kind = "grp int, n long, parameters array<binary>"

    def better(at: int, some: list[Finding]) -> pa.Table:
        new = improve(mean_net([(1, [p.tobytes() for p in net.parameters()])]), some, epochs, classes, seed=3 + 1000 * turn + at)
        return pa.table({"grp": pa.array([at // 64], pa.int32()), "n": pa.array([len(some)], pa.int64()), "parameters": pa.array([[p.tobytes() for p in new.parameters()]], pa.list_(pa.binary()))})

    def mean(t: pa.Table) -> pa.Table:
        nets = sorted(zip(t["n"].to_pylist(), t["parameters"].to_pylist()))
        return pa.table({"grp": t["grp"].slice(0, 1), "n": pa.array([sum(n for n, _ in nets)], pa.int64()), "parameters": pa.array([[p.tobytes() for p in mean_net(nets).parameters()]], pa.list_(pa.binary()))})

    means = _in_parts(rows, better, kind).groupBy("grp").applyInArrow(mean, kind).collect()
    return mean_net([(r["n"], r["parameters"]) for r in sorted(means, key=lambda r: r["grp"])])


def find(texts: list[str | None], net: CharNet) -> list[list[tuple[str, int, int, float | None]]]:
    """(kind, start, end, score) of each text by start, then kind; base spans have no score."""
    out: list[list[tuple[str, int, int, float | None]]] = []
    asked: list[tuple[int, int, int, bool, np.ndarray]] = []
    for i, t in enumerate(texts):
        base = base_spans(t)
        out.append([(k, a, b, None) for k, a, b in base])
        if t and min(net.thresholds.values()) <= 1:
            touched = Overlaps((a, b) for _, a, b in base)
            for a, b in candidates(t):
                if not touched(a, b):
                    around = views(t, a, b)
                    asked.append((i, a, b, keyed(around[0]), _encoded(*around)))
    for lo, hi in _batches(np.array([len(x[-1]) for x in asked]), 512):
        some = asked[lo:hi]
        for (i, a, b, behind, _), p in zip(some, net.probability([s[-1] for s in some]).tolist()):
            if p >= net.thresholds[behind]:
                out[i].append((ADDED, a, b, p))
    place = {k: n for n, k in enumerate((*BASE, ADDED))}
    return [sorted(spans, key=lambda s: (s[1], place[s[0]])) for spans in out]


SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"


def find_secrets(docs: DataFrame, net: CharNet) -> DataFrame:
    """(doc_id, found): one row for each row of docs(doc_id, text), found an
    array of (kind, start, end, score) by start, then kind. NULL and empty texts
    have none; a NULL doc_id stays NULL; other columns are not read."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches):
        for b in batches:
            found = [[{"kind": k, "start": x, "end": y, "score": s} for k, x, y, s in spans] for spans in find(b.column(1).to_pylist(), net)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, kind)], ["doc_id", "found"])

    return arrow_map(_rows(docs), run, f"doc_id long, found {SPANS}")


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns from ``find_secrets``: counts, the hash of the base spans, all spans."""
    name = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    base = F.filter("found", lambda s: s["kind"] != ADDED)

    def count(kind: str):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, BASE), F.sha2(F.concat_ws(",", F.transform(base, name)), 256).alias("base_sha256"), F.concat_ws(",", F.transform("found", name)).alias("spans"),
    )
