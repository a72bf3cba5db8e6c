"""Streaming twin of the incremental extract (ST1 / IN1).

The batch extract starts the day after the last delivered invoice. The
streaming form gets the same high-water mark from the stream checkpoint:
each ``availableNow`` run processes only files not yet seen. A sale is
delivered once, however late its file comes: the ids delivered so far are the
stream's state, looked up by key in RocksDB, so no batch reads what earlier
ones have written, and a batch saves its own new ids only (changelog). There
is no watermark, as a late sale must not be lost: the state holds one key for
each sale. A batch writes a folder of its own that a repeated attempt
replaces; its state is committed after that. The checkpoint lives under the cluster's shared
``spark.checkpoint.dir``, so a lost executor or a restarted driver resumes
where the last run ended.
"""

from __future__ import annotations

import os
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..sources import binding as b


def sales_stream(spark: SparkSession, source_dir: str, table: str = "events") -> DataFrame:
    """Sale events of the files named ``table*.parquet`` in ``source_dir``
    (new files dropped there are picked up by the next run)."""
    schema = spark.read.option("pathGlobFilter", f"{table}*.parquet").parquet(source_dir).schema
    s = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 64)
         .option("pathGlobFilter", f"{table}*.parquet").parquet(source_dir))
    return s.where(F.col("event_type") == b.NSAID_SALE_EVENT).select(
        F.col("event_id").alias("lineitem_id"), F.col("user_id").alias("patient_id"),
        F.date_sub(F.col("ts").cast("date"), b.EVENT_SHIFT_DAYS).alias("invoice_date"),
        "ts", F.col("value").cast("decimal(18,2)").alias("cost"),
    )


STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]):
    """The session with some settings, which it then has as before."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def run_incremental_extract(spark: SparkSession, source_dir: str, out_path: str, name: str = "sales_extract") -> int:
    """Process everything new since the last run, then stop. Returns the
    number of rows that this run has written."""
    ckpt = os.path.join(ensure_checkpoint_dir(spark), name)
    written: list[int] = []

    def deliver(rows: DataFrame, batch: int) -> None:
        folder = f"{out_path}/batch_id={batch}"
        rows.write.mode("overwrite").parquet(folder)
        written.append(spark.read.schema(rows.schema).parquet(folder).count())  # from the footers

    with _settings(spark, STATE_CONF):
        q = (sales_stream(spark, source_dir).dropDuplicates(["lineitem_id"]).writeStream.foreachBatch(deliver)
             .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
        q.awaitTermination()
    return sum(written)
