"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

# A document word of the contracts: a run of anything but space and \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"
# Arrow batches may hold whole texts: they are kept to so many bytes, and to so
# many rows at a time in Python, however long the documents are.
BATCH_BYTES = 8 << 20
BATCH_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``df.mapInArrow`` over texts, ``BATCH_ROWS`` rows at a time."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def short():
            for b in batches:
                for at in range(0, b.num_rows, BATCH_ROWS):
                    yield b.slice(at, BATCH_ROWS)

        return fn(short())

    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    if any("." in c for c in df.columns):  # mapInArrow takes a dot for a field of a struct
        df = df.toDF(*(c.replace(".", "_") + f"_{i}" for i, c in enumerate(df.columns)))
    return df.mapInArrow(run, schema)


def quoted(df: DataFrame) -> list[Column]:
    """All columns of df, also those with dots in their names."""
    return [F.col(f"`{c}`") for c in df.columns]


def cut(df: DataFrame) -> DataFrame:
    """The same rows with their lineage cut: written to the shared folder that
    the cluster names in ``spark.checkpoint.dir`` and read back from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def word_count(text: Column) -> Column:
    """Number of contract words of a text; NULL counts as empty. JVM only."""
    parts = F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+")
    # a separator at either end leaves one empty part there
    ends = (F.element_at(parts, 1) == "").cast("int") + ((F.size(parts) > 1) & (F.element_at(parts, -1) == "")).cast("int")
    return (F.size(parts) - ends).cast("long")


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """True for the rows of the held-out fold: crc32(doc_id as text) mod modulus = remainder; NULL ids are held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == remainder, F.lit(True))


def labelled_ids(labels: DataFrame, label: str, modulus: int, remainder: int, per_class: int) -> dict[int, DataFrame]:
    """Ids to learn from, by class: at most ``per_class`` rows of each class,
    chosen by a hash of the id, none of the held-out fold. A doc_id with
    contradicting labels is left out."""
    one = (
        labels.select(F.col("doc_id"), F.col(label).alias("y")).dropna()
        .where(~held_out(F.col("doc_id"), modulus, remainder))
        .groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("y2")).where("y = y2")
    )
    return {y: one.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class).select("doc_id", "y") for y in (0, 1)}


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35.0, 35.0)))
