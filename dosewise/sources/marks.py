"""Stored high-water marks of the delivered history.

One row for each invoice month, clinic and client: the last delivered day and
whether a dog was among the delivered pets. The incremental start and the
lapsed-client list read these rows instead of the history's lines. Kept beside
the line fact, partitioned by the same months; a month is computed again only
when its files in the fact have changed.
"""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import binding as b
from .facts import MONTH, LineFact

SCHEMA = f"h_id long, client_id long, last_day date, dogs boolean, files string, {MONTH} int"
DOG = 3


def _files_by_month(fact: LineFact) -> dict[int, str]:
    """A digest of the file names of each month of the fact: a rewritten month has new ones."""
    names: dict[int, list[str]] = {}
    for f in fact.read().inputFiles():
        month = f.rsplit(f"/{MONTH}=", 1)[1].split("/", 1)[0]
        if month.isdigit():  # lines without a day were never delivered
            names.setdefault(int(month), []).append(f.rsplit("/", 1)[1])
    return {m: hashlib.md5("\n".join(sorted(n)).encode()).hexdigest() for m, n in names.items()}


class DeliveryMarks:
    def __init__(self, t):
        self.t, self.spark = t, t.spark
        self.path = t.line_fact().path + "_marks"

    def _stored(self) -> DataFrame:
        try:
            self.spark.read.parquet(self.path)
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(self.path)

    def sync(self) -> list[int]:
        """Computes the months whose lines changed since the last time; returns them."""
        now = _files_by_month(self.t.line_fact())
        # a row a month: it has no client, and keeps a month that lost its last delivered line from going stale
        seen = {r[MONTH]: r["files"] for r in self._stored().where("client_id IS NULL").select(MONTH, "files").collect()}
        stale = sorted(m for m in now.keys() | seen.keys() if now.get(m) != seen.get(m))
        if not stale:
            return []
        products = b.products(self.t).where(F.col("type").isNotNull()).select("service_id")
        species = b.patients(self.t).select("patient_id", "vi_species_id")
        lines = (self.t.line_fact().read().where(F.col(MONTH).isin(stale) & ~F.col("voided") & (F.col("quantity_norm") != 0))
                 .select("patient_id", "client_id", "h_id", "invoice_date", F.col("l_partkey").alias("service_id"), MONTH))
        rows = (lines.join(products, "service_id", "left_semi").join(species, "patient_id")
                .groupBy(MONTH, "h_id", "client_id")
                .agg(F.max("invoice_date").alias("last_day"), F.coalesce(F.max(F.col("vi_species_id") == DOG), F.lit(False)).alias("dogs"))
                .withColumn("files", F.lit(None).cast("string")))
        marker = self.spark.createDataFrame([(None, None, None, None, now.get(m), m) for m in stale], SCHEMA)
        (rows.unionByName(marker).hint("rebalance", MONTH).sortWithinPartitions(MONTH, "h_id")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(self.path))
        return stale

    def read(self) -> DataFrame:
        """(invoice_month, h_id, client_id, last_day, dogs), as of the last ``sync``."""
        return self._stored().where("client_id IS NOT NULL").select(MONTH, "h_id", "client_id", "last_day", "dogs")


_READY: dict[tuple[str, str], tuple[int, DataFrame]] = {}  # marks that this session has brought in step


def delivery_marks(t) -> DataFrame:
    """The marks of a set of tables, in step with its line fact; in a scoped
    run, of its clinics. Only the first use after a change runs a job."""
    fact = t.line_fact()
    if _READY.get(fact.key, (None, None))[0] != fact.changes():
        marks = DeliveryMarks(t.whole())
        marks.sync()
        _READY[fact.key] = fact.changes(), marks.read()
    x = _READY[fact.key][1]
    return x if t.clinics is None else x.where(F.col("h_id").isin(*t.clinics))
