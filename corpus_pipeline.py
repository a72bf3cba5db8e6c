"""Training-corpus pipeline: quality filter, near-duplicates, personal data,
source mixing, packing. Each stage takes (spark, docs, sf_dir) and works on
all that its predecessor kept; all but the last return the columns of docs.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from dosewise.llm import mixing, packing, pii, quality_fm, simhash
from dosewise.llm.common import table
from dosewise.session import ensure_checkpoint_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality_fm.keep_good(docs, quality_fm.learn(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates stays."""
    return simhash.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    return pii.mask(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are mixed to their target weights; a document taken twice gives two rows."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are packed into bins. The near-duplicates that are left are
    the readings of a document taken twice, one of them perhaps cut, and texts
    that masking has made alike: the clusters are those of this stage's own
    input, so neither kind shares a bin."""
    return packing.pack_apart(docs)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("personal_data", personal_data), ("mix", mix), ("pack", pack)]

# SimHash, the learned classifier and greedy packing are beyond SQL; tests/llm holds brute-force versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    out = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{out}/{name}")
        docs = spark.read.parquet(f"{out}/{name}")
    return docs
