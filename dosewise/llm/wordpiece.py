"""Token counts by a linear longest-match automaton (Song et al., 2021).

The vocabulary is a byte trie. Where the next byte has no edge, the failure
link of a node leads to the node of what remains after its greedy pieces are
taken off, and their precomputed number is added: one pass over the bytes
counts the greedy word pieces without building any.

A word is matched with a space before it: entries that start with a space
are the pieces that begin words, the others continue them. Words are the runs
between white space; all 256 single bytes must be entries, so every text has
a count.
"""

from __future__ import annotations

import base64
from collections import deque
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"  # default of the path parameter
_MEMO = 200_000  # words a task remembers at a time


def read_vocabulary(path: str) -> list[bytes]:
    """Entries of a file of lines 'base64 rank'."""
    return [base64.b64decode(line.split()[0]) for line in Path(path).read_bytes().splitlines() if line.strip()]


@dataclass
class Automaton:
    edges: np.ndarray  # node * 256 + byte of the edge to node i + 1
    fail: np.ndarray
    pops: np.ndarray  # pieces taken off when the failure link is followed

    def counter(self) -> "Counter":
        return Counter({int(e): i + 1 for i, e in enumerate(self.edges)}, self.fail.tolist(), self.pops.tolist())


def build(vocabulary: list[bytes]) -> Automaton:
    """The trie of the entries with failure links, nodes in breadth-first order; its size is that of the vocabulary."""
    children: list[dict[int, int]] = [{}]
    entry = [False]
    for word in vocabulary:
        at = 0
        for byte in word:
            nxt = children[at].get(byte)
            if nxt is None:
                nxt = children[at][byte] = len(children)
                children.append({})
                entry.append(False)
            at = nxt
        entry[at] = True
    if missing := [b for b in range(256) if b not in children[0] or not entry[children[0][b]]]:
        raise ValueError(f"the vocabulary lacks {len(missing)} single bytes")
    fail, pops = [0] * len(children), [0] * len(children)
    order, number = [0], {0: 0}
    queue = deque([0])
    edges = []
    while queue:
        u = queue.popleft()
        for byte, v in children[u].items():
            if entry[v]:
                fail[v], pops[v] = 0, 1
            else:
                z, n = fail[u], pops[u]
                while byte not in children[z]:
                    z, n = fail[z], n + pops[z]
                fail[v], pops[v] = children[z][byte], n
            number[v] = len(order)
            order.append(v)
            edges.append(number[u] * 256 + byte)
            queue.append(v)
    return Automaton(np.array(edges, np.int64), np.array([number[fail[v]] for v in order], np.int32), np.array([pops[v] for v in order], np.int32))


class Counter:
    def __init__(self, edges: dict[int, int], fail: list[int], pops: list[int]):
        self.edges, self.fail, self.pops = edges, fail, pops
        self.memo: dict[bytes, int] = {}

    def word(self, word: bytes) -> int:
        """Greedy pieces of one word."""
        edges, fail, pops = self.edges, self.fail, self.pops
        at = n = 0
        for byte in b" " + word:
            nxt = edges.get(at * 256 + byte)
            while nxt is None:
                n += pops[at]
                at = fail[at]
                nxt = edges.get(at * 256 + byte)
            at = nxt
        while at:
            n += pops[at]
            at = fail[at]
        return n

    def text(self, text: str | None) -> tuple[int, int]:
        """(words, pieces) of a whole text."""
        words = (text or "").encode().split()
        memo, total = self.memo, 0
        for w in words:
            n = memo.get(w)
            if n is None:
                n = self.word(w)
                if len(w) <= 64:
                    if len(memo) >= _MEMO:
                        memo.clear()
                    memo[w] = n
            total += n
        return len(words), total


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_tokens): one row for each row of docs. NULL and
    empty texts have no tokens; a NULL doc_id stays NULL; other columns are
    not read. The vocabulary is read on the driver; the automaton (a few MB,
    whatever the size of docs) goes to the executors as a broadcast variable."""
    automaton = docs.sparkSession.sparkContext.broadcast(build(read_vocabulary(vocabulary)))

    def run(batches):
        counter = automaton.value.counter()
        for b in batches:
            got = [counter.text(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x for x, _ in got], pa.int64()), pa.array([y for _, y in got], pa.int64())], ["doc_id", "n_words", "n_tokens"])

    return arrow_map(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")), run, "doc_id long, n_words long, n_tokens long")
