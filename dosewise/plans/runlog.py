"""AP5, OP1: the log that report runs write, and its latest state.

A row (run, process, attempt, flag) is a folder of its own, which a repeated
write of the same row replaces, so each is there once however often a driver
tries. Nothing else is rewritten: the log is append-only.
"""

from __future__ import annotations

from contextlib import contextmanager
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..context import RunContext
from . import admin

# fixed values: the flags of a log row
FLAGS = ("RUNID", "STARTED", "INFO", "SUCCESS", "ERROR", "DELIVERED")
DATA = "location_number long, end_date date, report_type string, update_flag long, message string, logged_at timestamp"
KEYS = "run_id long, process string, attempt int, flag string"


class RunLog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def write(self, ctx: RunContext, process: str, flag: str, message: str = "", attempt: int = 1) -> None:
        if flag not in FLAGS:
            raise ValueError(flag)
        row = [(ctx.location_number, ctx.end_date, ctx.report_type, ctx.update_flag, message)]
        df = self.spark.createDataFrame(row, DATA.rsplit(",", 1)[0]).withColumn("logged_at", F.current_timestamp())
        df.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/run_id={ctx.run_id}/process={process}/attempt={attempt}/flag={flag}")

    def read(self) -> DataFrame:
        """(run_id, process, attempt, flag, and the values of the row)."""
        schema = f"{DATA}, {KEYS}"
        try:
            return self.spark.read.schema(schema).parquet(self.path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def next_attempt(self, ctx: RunContext, process: str) -> int:
        """One more than the attempts of the run's process that have ended."""
        mine = (F.col("run_id") == ctx.run_id) & (F.col("process") == process) & F.col("flag").isin("SUCCESS", "ERROR")
        return (self.read().where(mine).agg(F.max("attempt")).first()[0] or 0) + 1

    @contextmanager
    def process(self, ctx: RunContext, name: str):
        """Logs a step of a run: STARTED, then SUCCESS or, with the message, ERROR."""
        attempt = self.next_attempt(ctx, name)
        self.write(ctx, name, "STARTED", attempt=attempt)
        try:
            yield attempt
        except Exception as e:
            self.write(ctx, name, "ERROR", str(e)[:2000], attempt)
            raise
        self.write(ctx, name, "SUCCESS", attempt=attempt)

    def latest(self) -> DataFrame:
        """The newest row of each run's process: its last attempt, ended or not."""
        order = F.struct("attempt", F.when(F.col("flag") == "STARTED", 0).otherwise(1))
        rows = self.read().where(F.col("flag").isin("STARTED", "SUCCESS", "ERROR"))
        return rows.groupBy("run_id", "process").agg(
            F.max("attempt").alias("attempt"), F.max_by("flag", order).alias("flag"), F.max_by("message", order).alias("message"),
            F.max_by("end_date", order).alias("end_date"))

    def states(self, requested: DataFrame) -> DataFrame:
        """OP1 over this log for the ``run_id`` of ``requested``."""
        log = self.read()
        # an attempt is open until it has ended, whatever the ones before it
        step = F.concat_ws("#", "process", F.col("attempt").cast("string"))
        return admin.states_of(log.select("run_id", "flag", step.alias("process"), F.col("end_date"), (F.col("flag") == "DELIVERED").alias("delivered")), requested)
