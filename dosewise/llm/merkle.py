"""Merkle manifest of a dataset as a persistent tree.

Every row is a leaf, every lang a binary tree over its leaves by doc_id, and
the subroots of the langs, ordered by lang, form one more tree with the root.

A tree is cut into aligned blocks of 2^bits leaves, so that a block's nodes
depend on its own leaves alone; the block roots are the leaves of the next
round, until one node is left. No task ever holds more than one block.
Proofs go back the same way: a block gets the path of its root from the round
above and adds the siblings inside. A tampered leaf makes a new version of
the tree by path copying: only its ancestors are copied, in its block and then
in every block above up to the root, all other nodes are shared with the
original. Each version is copied beside the row that it belongs to. Every
row's proof is folded, a tampered one's from the tampered leaf.

Defined results: NULL fields hash as ``-``; rows of a NULL lang form a tree
of their own, the first; NULL doc_ids come first in their tree, rows of equal
doc_id are ordered by leaf; repeated rows are leaves each; an empty table has
no rows. Only doc_id, source, lang, n_chars and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

BITS = 12  # leaves of a block: 4,096
_ROW = (1 << 33) - 1  # the row's part of monotonically_increasing_id
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def height(n: int, bits: int) -> int:
    """Levels above the nodes of a block: all of them if its tree has other blocks, else up to the tree's root."""
    return bits if n > 1 << bits else (n - 1).bit_length()


@dataclass
class Block:
    """The nodes of a block by level, lowest first."""

    levels: list[list[str]]

    @classmethod
    def of(cls, hashes: list[str], height: int) -> Block:
        levels = [hashes]
        for _ in range(height):
            low = levels[-1]
            levels.append([digest(*low[i : i + 2]) for i in range(0, len(low), 2)])
        return cls(levels)

    @property
    def root(self) -> str:
        return self.levels[-1][0]

    def path(self, at: int) -> list[str]:
        """Siblings of a leaf from its level up: ``<`` + hash (to its left), ``>`` + hash, or ``-`` for none."""
        out = []
        for level in self.levels[:-1]:
            other = at ^ 1
            out.append("-" if other >= len(level) else "<>"[other > at] + level[other])
            at >>= 1
        return out

    def version(self, at: int, leaf: str) -> list[str]:
        """The nodes that a changed leaf copies, the leaf first, the version's
        root last; whatever isn't on this path is shared with the block."""
        copied = [leaf]
        for level in self.levels[:-1]:
            pair = level[at & ~1 : (at | 1) + 1]
            pair[at & 1] = copied[-1]
            copied.append(digest(*pair))
            at >>= 1
        return copied


def copied(node: str, path: list[str]) -> list[str]:
    """The nodes that a changed node copies along a path, itself first, the
    version's root last; each shares the sibling that the path names."""
    out = [node]
    for step in path:
        out.append(digest(step[1:], out[-1]) if step[0] == "<" else digest(out[-1], step[1:]) if step[0] == ">" else digest(out[-1]))
    return out


def follow(node: str, path: list[str]) -> str:
    """A proof folded: the node at the end of a path, from a node at its beginning."""
    return copied(node, path)[-1]


def leaf_hash(n_chars: Column | None = None) -> Column:
    """sha256 of a row: each field its UTF-8 byte count, a colon and its value, or ``-`` for NULL."""

    def field(name: str) -> Column:
        value = (n_chars if name == "n_chars" and n_chars is not None else F.col(name)).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*map(field, FIELDS)), 256)


def leaves(docs: DataFrame, tampered: Column) -> DataFrame:
    """(tree, doc_id, hash, forged): the leaf of each row and, where
    ``tampered`` holds, the leaf that the row has with 1 added to n_chars."""
    forged = F.when(tampered, leaf_hash(F.col("n_chars").cast("long") + 1))
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit(""))  # NULL first, then by lang
    return docs.select(*FIELDS).select(tree.alias("tree"), F.col("doc_id").cast("long").alias("doc_id"), leaf_hash().alias("hash"), forged.alias("forged"))


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """rows (written and read again) with n, the size of their tree, and idx,
    their place in it by ``order``. Ranges of (tree, order) are sorted apart;
    the places of a range go on from the rows before it, so that no tree has
    to fit into a task. Rows equal in ``order`` may be split."""
    ranged = rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange("tree", *order, "tie").sortWithinPartitions("tree", *order, "tie")
    placed = cut(ranged.drop("tie").withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.spark_partition_id()))
    by = Window.partitionBy("tree")
    ranges = placed.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count("*").alias("rows"))
    before = F.sum("rows").over(by.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    ranges = ranges.select("tree", "part", "first", F.coalesce(before, F.lit(0)).alias("before"), F.sum("rows").over(by).alias("n"))
    idx = F.col("before") + F.col("at").bitwiseAND(_ROW) - F.col("first").bitwiseAND(_ROW)
    return placed.join(ranges, ["tree", "part"]).withColumn("idx", idx).drop("part", "at", "first", "before")


def _ordered(t: pa.Table) -> pa.Table:
    return t.sort_by("idx")


def _dealt(nodes: DataFrame, bits: int) -> DataFrame:
    return nodes.withColumn("block", F.shiftright("idx", bits)).groupBy("tree", "block")


def parents(nodes: DataFrame, bits: int) -> DataFrame:
    """Block roots of the nodes (tree, idx, n, hash), as nodes of the next round."""

    def up(t: pa.Table) -> pa.Table:
        t = _ordered(t)
        n = t["n"][0].as_py()
        root = Block.of(t["hash"].to_pylist(), height(n, bits)).root
        return pa.table({"tree": t["tree"].slice(0, 1), "idx": t["block"].slice(0, 1), "n": pa.array([-(-n >> bits)], pa.int64()), "hash": [root]})

    columns = nodes.select("tree", "idx", "n", "hash")
    return cut(_dealt(columns, bits).applyInArrow(up, "tree string, idx long, n long, hash string"))


def rounds(nodes: DataFrame, bits: int) -> list[DataFrame]:
    """The nodes, their block roots, and so on; the last round has one node of each tree, its root."""
    out = [nodes]
    n = nodes.agg(F.max("n")).first()[0] or 0
    while n > 1:
        out.append(parents(out[-1], bits))
        n = -(-n >> bits)
    return out


Upper = "tree string, idx long, path array<string>, subroot string, root string"


def _met(below: DataFrame, above: DataFrame, bits: int, schema: str, rows: Callable[[pa.Table, Block, int, list[str], dict], dict]) -> DataFrame:
    """Blocks of ``below`` with the path of their root from ``above``: ``rows``
    makes the columns of the result from a block's nodes."""

    def down(t: pa.Table, a: pa.Table) -> pa.Table:
        t, top = _ordered(t), a.to_pylist()[0]
        first = t["block"][0].as_py() << bits
        block = Block.of(t["hash"].to_pylist(), height(t["n"][0].as_py(), bits))
        return pa.table(rows(t, block, first, top["path"], top))

    upper = above.select("tree", F.col("idx").alias("block"), "path", "subroot", "root")
    return _dealt(below, bits).cogroup(upper.groupBy("tree", "block")).applyInArrow(down, schema)


def _descend(below: DataFrame, above: DataFrame, bits: int) -> DataFrame:
    """The full path of each node, as ``Upper``."""

    def rows(t, block, first, path, top):
        k = t.num_rows
        paths = [block.path(i - first) + path for i in t["idx"].to_pylist()]
        return {"tree": t["tree"], "idx": t["idx"], "path": pa.array(paths, pa.list_(pa.string())),
                "subroot": pa.array([top["subroot"]] * k, pa.string()), "root": pa.array([top["root"]] * k, pa.string())}

    return _met(below, above, bits, Upper, rows)


Manifest = "doc_id long, leaf string, subroot string, root string, proof array<string>, folded_root string, version array<string>"


def proven(t: pa.Table, block: Block, first: int, path: list[str], top: dict) -> dict:
    """The manifest's columns of a block's leaves: their proofs, what these fold to, the versions of the forged."""
    k, proofs, folded, versions = t.num_rows, [], [], []
    for i, leaf, forged in zip(t["idx"].to_pylist(), t["hash"].to_pylist(), t["forged"].to_pylist()):
        proofs.append(block.path(i - first) + path)
        folded.append(follow(leaf if forged is None else forged, proofs[-1]))
        inside = None if forged is None else block.version(i - first, forged)
        versions.append(inside and inside[:-1] + copied(inside[-1], path))
    return {"doc_id": t["doc_id"], "leaf": t["hash"], "subroot": pa.array([top["subroot"]] * k, pa.string()), "root": pa.array([top["root"]] * k, pa.string()),
            "proof": pa.array(proofs, pa.list_(pa.string())), "folded_root": pa.array(folded, pa.string()), "version": pa.array(versions, pa.list_(pa.string()))}


def manifest(leaves: DataFrame, bits: int = BITS) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof, folded_root, version) of ``leaves``'s rows.

    proof lists the siblings from the leaf to the root: ``<`` or ``>`` and the
    hash (to the left, to the right), ``-`` where a node has none. folded_root is
    the proof folded from the forged leaf, from the leaf if there is none.
    version lists the nodes that the forged leaf copies, itself first, the
    version's root last; NULL without one.
    """
    docs = numbered(cut(leaves), "doc_id", "hash")
    low = rounds(docs, bits)
    subroots = low[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), "hash")
    langs = numbered(subroots, "name")
    high = rounds(langs, bits)
    above = high[-1].select("tree", "idx", F.array().cast("array<string>").alias("path"), F.lit(None).cast("string").alias("subroot"), F.col("hash").alias("root"))
    for nodes in reversed(high[:-1]):
        above = _descend(nodes.select("tree", "idx", "n", "hash"), above, bits)
    above = above.withColumnRenamed("idx", "place").drop("tree", "subroot").join(langs.select("idx", "name", "hash").withColumnRenamed("idx", "place"), "place")
    above = above.select(F.col("name").alias("tree"), F.lit(0).cast("long").alias("idx"), "path", F.col("hash").alias("subroot"), "root")
    for nodes in reversed(low[1:-1]):
        above = _descend(nodes, above, bits)

    return _met(docs, above, bits, Manifest, proven)


def report(manifest: DataFrame) -> DataFrame:
    """The contract's columns: the proof as the hash of its siblings, and whether the folded root is the root."""
    siblings = F.concat_ws("", F.transform("proof", lambda s: F.substr(s, F.lit(2))))
    return manifest.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def tampered_rows() -> Column:
    """The rows that the contract tampers with: 7 divides the crc32 of the decimal doc_id; none of a NULL doc_id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
