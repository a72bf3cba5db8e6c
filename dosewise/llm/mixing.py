"""Mixing sources to target weights by a multivariate-hypergeometric splitting
tree. DataFrame and SQL functions only.

1. Sizes and targets. Sources in code-point order (NULL last) weigh 3, 1, 2,
   repeating, and share 150 % of all words; a target stops at twice its
   source's size and the excess goes to the others by weight. The level at
   which nothing is left over has a closed form (``targets``).
2. Streams. The documents of a source, permuted by md5 of their id, form a
   stream of words that may be read twice. The mix takes its first
   floor(target) words, in blocks of ``block_words``; so every source meets
   its target to the word, at most one document a source is cut, and none is
   taken more than twice. Prefix sums are made in two levels (within buckets
   of the permutation, then over buckets), so no task holds a whole source.
3. Tree. The blocks are dealt to 2^depth shards: at each node a draw decides
   how many of each source's blocks go to the left half. The draws of a node
   are conditional hypergeometric, one source after the other, so together
   multivariate hypergeometric, and quotas are conserved exactly. The draws
   come from hashes of node and source: reruns agree.
4. Shards draw disjoint runs of blocks from the permuted streams, and
   ``slot`` shuffles the blocks within a shard. ``mixed_documents`` puts whole
   documents out in that order: each goes where its first word's block goes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, quoted, word_count

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2
BLOCK_WORDS = 4096
SHARD_WORDS = 1 << 22
BUCKET_ROWS = 2048
_SIGMAS = 8  # a draw is made within so many deviations: the rest has a probability under 1e-14


def targets(sizes: DataFrame) -> DataFrame:
    """sizes(source, source_size long) -> with target double, one row a source.

    Raising a common level L, source s takes min(CAP * size, L * weight); the
    sum is concave in L and piecewise linear, so the level that gives the
    share is the largest of the levels of its pieces. One row a source passes
    through the windows: their size is that of the list of sources.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    rank = F.row_number().over(order) - 1
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (rank % len(WEIGHTS) + 1).cast("int"))
    level = (F.lit(SHARE) * F.sum("source_size").over(every)
             - F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
             ) / F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    return (
        sizes.withColumn("weight", weight)
        .withColumn("cap", F.lit(CAP) * F.col("source_size"))
        .withColumn("ratio", F.col("cap").cast("double") / F.col("weight"))
        .withColumn("level", level)
        .withColumn("target", F.least(F.col("cap").cast("double"), F.max("level").over(every) * F.col("weight")))
        .select("source", "source_size", "target")
    )


# --- the splitting tree, as SQL expressions over one row a node


def _ln_factorial(x: str) -> str:
    """ln(x!) by Stirling's series at x + 8."""
    z = f"(({x}) + 8D)"
    low = " * ".join(f"(({x}) + {i}D)" for i in range(1, 8))
    return f"(({z} - 0.5D) * ln({z}) - {z} + 0.9189385332046727D + 1D / (12D * {z}) - 1D / (360D * {z} * {z} * {z}) - ln({low}))"


def _let(name: str, value: str, body: str) -> str:
    """SQL has no let: a lambda over an array of one element binds the name."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _draw(m: str, k: str, t: str, u: str) -> str:
    """Hypergeometric draw by inversion: of m blocks, k are the source's, t go left; u is uniform in [0, 1)."""
    log_w = lambda j: "-(" + " + ".join(_ln_factorial(x) for x in (f"{j}", f"p.k - {j}", f"p.t - {j}", f"p.m - p.k - p.t + {j}")) + ")"
    par = f"named_struct('m', cast({m} as double), 'k', cast({k} as double), 't', cast({t} as double), 'u', {u})"
    mid = "floor((p.t + 1D) * (p.k + 1D) / (p.m + 2D))"
    sd = "sqrt(p.t * (p.k / p.m) * (1D - p.k / p.m) * (p.m - p.t) / greatest(p.m - 1D, 1D))"
    box = (
        f"named_struct('mid', {mid}, 'lo', greatest(0, p.t - (p.m - p.k), {mid} - ceil({_SIGMAS}D * {sd}) - 8), "
        f"'hi', least(p.k, p.t, {mid} + ceil({_SIGMAS}D * {sd}) + 8))"
    )
    weights = f"transform(sequence(cast(b.lo as bigint), cast(b.hi as bigint)), j -> exp(({log_w('cast(j as double)')}) - top))"
    pick = (
        "aggregate(w, named_struct('sum', 0D, 'n', 0L), (a, x) -> named_struct('sum', a.sum + x, 'n', a.n + if(a.sum + x <= p.u * total, 1L, 0L)), a -> a.n)"
    )
    total = "aggregate(w, 0D, (a, x) -> a + x)"
    inner = _let("top", log_w("b.mid"), _let("w", weights, _let("total", total, f"least(cast(b.lo as bigint) + {pick}, cast(b.hi as bigint))")))
    drawn = _let("p", par, _let("b", box, inner))
    return f"if({k} = 0 or {t} = 0, 0L, if({k} = {m}, cast({t} as bigint), {drawn}))"


def split_tree(quotas: DataFrame, depth: int, seed: int = 11) -> DataFrame:
    """quotas(source_no long, blocks long) -> (shard long, source_no, blocks):
    each source's blocks dealt to 2^depth shards of equal total (up to one).

    A node is one row with an array of one entry a source; children are made
    from it in place, without a shuffle. The root is the list of sources.
    """
    nodes = quotas.agg(F.array_sort(F.collect_list(F.struct("source_no", "blocks"))).alias("srcs")).select(F.lit(0).cast("long").alias("node"), "srcs")
    for level in range(depth):
        # the fold carries what remains of the node's blocks and of the left half's room
        u = f"(pmod(xxhash64(cast({seed} as int), cast({level} as int), node, s.source_no), 9007199254740992L) / 9007199254740992D)"
        fold = (
            "aggregate(srcs, named_struct('m', whole, 't', half, 'out', cast(array() as array<bigint>)), "
            f"(acc, s) -> {_let('d', _draw('acc.m', 's.blocks', 'acc.t', u), '''named_struct('m', acc.m - s.blocks, 't', acc.t - d, 'out', concat(acc.out, array(d)))''')}, acc -> acc.out)"
        )
        nodes = (
            nodes.withColumn("whole", F.expr("aggregate(srcs, 0L, (a, s) -> a + s.blocks)"))
            .withColumn("half", F.expr("(whole + node % 2) div 2"))
            .withColumn("drawn", F.expr(fold))
            .select("node", F.explode(F.array(
                F.struct(F.lit(0).cast("long").alias("side"), F.expr("zip_with(srcs, drawn, (s, d) -> named_struct('source_no', s.source_no, 'blocks', d))").alias("srcs")),
                F.struct(F.lit(1).cast("long").alias("side"), F.expr("zip_with(srcs, drawn, (s, d) -> named_struct('source_no', s.source_no, 'blocks', s.blocks - d))").alias("srcs")),
            )).alias("c"))
            .select((F.col("node") * 2 + F.col("c.side")).alias("node"), "c.srcs")
        )
        if level % 6 == 5:
            nodes = nodes.repartition("node")
    return nodes.select(F.col("node").alias("shard"), F.explode("srcs").alias("s")).select("shard", "s.source_no", "s.blocks")


# --- streams and pieces


def _least_digits(rows: int) -> int:
    """Hex digits of the permutation that make buckets of about BUCKET_ROWS rows."""
    return max(1, math.ceil(math.log(max(1.0, rows / BUCKET_ROWS), 16)))


def streams(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> tuple[DataFrame, DataFrame, int]:
    """(rows, sources, words): docs, each row as the struct _doc, with their
    place in their source's stream (_id, _source, size, _bucket, _row, start);
    one row a source with its number, size and target; the words of all targets."""
    sized = docs.select(
        F.struct(*quoted(docs)).alias("_doc"), F.col(id_col).alias("_id"), F.col(source_col).alias("_source"), word_count(F.col(text_col)).alias("size"),
        F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit(""))).alias("_key"), F.xxhash64(text_col).alias("_tie"))
    digits = _least_digits(docs.count())
    sized = sized.withColumn("_bucket", F.substring("_key", 1, digits))
    buckets = cut(sized.groupBy("_source", "_bucket").agg(F.sum("size").alias("words")))
    before = Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = buckets.select(F.col("_source").alias("o_source"), F.col("_bucket").alias("o_bucket"), F.coalesce(F.sum("words").over(before), F.lit(0)).alias("_offset"))
    sources = targets(buckets.groupBy(F.col("_source").alias("source")).agg(F.sum("words").alias("source_size")))
    sources = cut(
        sources.withColumn("take", F.floor("target").cast("long"))
        .withColumn("blocks", F.ceil(F.col("take") / BLOCK_WORDS).cast("long"))
        .withColumn("source_no", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).cast("long"))
    )
    within = Window.partitionBy("_source", "_bucket").orderBy("_key", "_id", "_tie")
    rows = (
        sized.withColumn("_row", F.row_number().over(within))
        .withColumn("_local", F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
        .join(offsets, F.col("_source").eqNullSafe(F.col("o_source")) & (F.col("_bucket") == F.col("o_bucket")))
        .withColumn("start", F.col("_offset") + F.col("_local"))
        .drop("_local", "_offset", "o_source", "o_bucket")
    )
    words = sources.agg(F.sum("take")).first()[0] or 0
    return rows, sources, words


def _placed(rows: DataFrame, sources: DataFrame) -> DataFrame:
    s = sources.select(F.col("source").alias("s_source"), "source_no", "source_size", "target", "take")
    return rows.join(s, F.col("_source").eqNullSafe(F.col("s_source"))).drop("s_source")


def _taken(epoch: int) -> Column:
    """Words of the document that the mix takes in this reading of the stream."""
    return F.greatest(F.lit(0), F.least(F.col("size"), F.col("take") - epoch * F.col("source_size") - F.col("start"))).cast("long")


def _dealt(sources: DataFrame, words: int) -> DataFrame:
    """(source_no, block, shard, slot): where the tree deals each block, one row a block."""
    depth = max(0, math.ceil(math.log2(max(1.0, words / SHARD_WORDS))))
    quotas = split_tree(sources.select("source_no", "blocks"), depth)
    last = F.sum("blocks").over(Window.partitionBy("source_no").orderBy("shard"))
    return (
        quotas.withColumn("last", last).where("blocks > 0")
        .select("source_no", "shard", F.explode(F.sequence(F.col("last") - F.col("blocks"), F.col("last") - 1)).alias("block"))
        .withColumn("slot", F.xxhash64("shard", "source_no", "block"))
        # it grows with the words, which its estimate does not show, so it must not be broadcast
        .hint("merge")
    )


def mix_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> tuple[DataFrame, DataFrame]:
    """(pieces, rows) of the mix.

    rows: one row for each row of docs, with _source, _bucket, _row (together
    a key), _doc, _id, size, source_size and target. pieces: the runs of words that the shards take: the key, epoch (0 or 1), first (word
    of the document), words, block, shard, slot (order within the shard).
    NULL and empty texts have no words and no pieces; a NULL source is a
    source of its own, the last; repeated rows are rows like any other; an
    empty table gives empty results.
    """
    rows, sources, words = streams(docs, id_col, text_col, source_col)
    placed = _placed(rows, sources)
    runs = placed.select("_source", "_bucket", "_row", "source_no", "source_size", "size", "start", F.explode(F.array(*(
        F.struct(F.lit(e).alias("epoch"), _taken(e).alias("words")) for e in range(CAP)))).alias("r")).where("r.words > 0")
    begin = F.col("start") + F.col("r.epoch") * F.col("source_size")
    runs = runs.select("_source", "_bucket", "_row", "source_no", F.col("r.epoch").alias("epoch"), begin.alias("begin"), (begin + F.col("r.words")).alias("end"))
    cuts = runs.withColumn("block", F.explode(F.sequence(F.floor(F.col("begin") / BLOCK_WORDS), F.floor((F.col("end") - 1) / BLOCK_WORDS))))
    a = F.greatest("begin", F.col("block") * BLOCK_WORDS)
    b = F.least("end", (F.col("block") + 1) * BLOCK_WORDS)
    pieces = (
        cuts.withColumn("first", a - F.col("begin")).withColumn("words", b - a)
        .join(_dealt(sources, words), ["source_no", "block"])
        .select("_source", "_bucket", "_row", "epoch", "first", "words", "block", "shard", "slot")
    )
    return pieces, placed


def mix_digest(docs: DataFrame) -> DataFrame:
    """The contract's columns: (doc_id, size, source_size, target, taken), one row for each row of docs."""
    pieces, rows = mix_plan(docs)
    per_row = pieces.groupBy(F.col("_source").alias("p_source"), F.col("_bucket").alias("p_bucket"), F.col("_row").alias("p_row")).agg(F.sum("words").alias("taken"))
    match = F.col("_source").eqNullSafe(F.col("p_source")) & (F.col("_bucket") == F.col("p_bucket")) & (F.col("_row") == F.col("p_row"))
    return rows.join(per_row, match, "left").select(
        F.col("_id").alias("doc_id"), "size", F.col("source_size").cast("long").alias("source_size"), "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_rows(docs: DataFrame) -> DataFrame:
    """(_doc, size, source_no, begin, took, block, shard, slot): one row for
    each reading of a document that the mix takes words of, whole in the block
    where it begins, and so in that block's shard. A shard's words of a source
    are its quota of blocks but for the documents over the two ends of its run
    of blocks: they differ by less than the longest document."""
    rows, sources, words = streams(docs)
    epochs = F.explode(F.array(*(F.struct(F.lit(e).alias("epoch"), _taken(e).alias("took")) for e in range(CAP))))
    begin = F.col("start") + F.col("r.epoch") * F.col("source_size")
    return (
        _placed(rows, sources).withColumn("r", epochs).where("r.took > 0")
        .select("_doc", "size", "source_no", begin.alias("begin"), F.col("r.took").alias("took"), F.floor(begin / BLOCK_WORDS).alias("block"))
        .join(_dealt(sources, words), ["source_no", "block"])
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents of the mix with the columns of docs, in the order of
    their shards and, within a shard, of its shuffled blocks: so the shards
    are runs of the output's partitions and rows. A document taken twice gives
    two rows; one that is cut (at most one a source) gives the words taken,
    separated by single spaces, with n_chars set to match."""
    out = mixed_rows(docs).orderBy("shard", "slot", "source_no", "begin")
    words = F.filter(F.split("_doc.text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    cut_off = F.col("took") < F.col("size")
    text = F.when(cut_off, F.array_join(F.slice(words, 1, F.col("took").cast("int")), " ")).otherwise(F.col("_doc.text"))
    out = out.withColumn("_text", text)
    new = {"text": F.col("_text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(cut_off, F.char_length("_text")).otherwise(F.col("_doc.n_chars"))
    return out.select(*(new.get(f.name, F.col(f"_doc.`{f.name}`")).cast(f.dataType).alias(f.name) for f in docs.schema))
