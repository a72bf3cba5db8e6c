"""Invoice-line fact: lineitem joined to its order once, kept by invoice month.

The source has no date on its line rows, so every report would scan all lines
and shuffle them to their orders. The fact is that join, written as a Parquet
table partitioned by invoice month (``PartitionFilters`` prune a report's
window) and, from ``BUCKET_BYTES`` a month on, bucketed by patient (a
patient-level aggregate or join then needs no shuffle of the lines). Files are
sorted by clinic, so that a clinic's rows sit in few row groups.

``line_seq`` is a line's place, by line key, among the lines of its client and
day: (day, line_seq) orders a client's lines as (day, line key) does, in fixed
width, which lets "the latest line's value" be a hash aggregate.

Late or corrected lines rewrite the months that they touch and no others.
"""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.sizing import estimated_bytes
from ..session import ensure_checkpoint_dir

MONTH = "invoice_month"  # year * 100 + month, NULL for lines without a day
LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
BUCKET_BYTES = 256 * 1024 * 1024  # of a month's lines in a bucket
SLICE_BYTES = 16 * 1024 * 1024  # of the source's line files, that a task numbers and sorts
_MONTHS = 84  # of lines, for the estimate of bytes a month
_CHANGES: dict[tuple[str, str], int] = {}
FACT_CONF, BUCKETS_CONF = "spark.dosewise.lineFact", "spark.dosewise.lineFact.buckets"


def month_of(day: Column) -> Column:
    return F.year(day) * 100 + F.month(day)


def line_cost() -> Column:
    """Net line amount, exact: decimal(18,2) price times decimal(4,2) factor."""
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    disc = F.col("l_discount").cast("decimal(4,2)")
    return (price * (F.lit(1).cast("decimal(4,2)") - disc)).cast("decimal(18,4)")


def _headers(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Each order with its patient and day, the patient's clinic and the clinic
    of the patient's client. Joined here, not to the lines: orders are fewer and narrower."""
    o = orders.select("o_orderkey", F.col("o_custkey").alias("patient_id"), F.col("o_orderdate").cast("date").alias("invoice_date"))
    c = customer.select(F.col("c_custkey").alias("patient_id"), F.col("c_nationkey").cast("long").alias("h_id"))
    head = c.where(F.col("patient_id") % 3 == 0).select((F.col("patient_id") / 3).cast("long").alias("client_id"), F.col("h_id").alias("client_h_id"))
    o = o.where(F.col("o_orderkey").isNotNull()).join(c, "patient_id", "left")
    return o.withColumn("client_id", client_of()).join(head, "client_id", "left").drop("client_id")


def client_of() -> Column:
    return F.floor(F.col("patient_id") / 3).cast("long")


def _joined(lineitem: DataFrame, orders: DataFrame, customer: DataFrame, tasks: int = 0) -> DataFrame:
    """The lines with their headers, in the few columns that the others are told from."""
    x = lineitem.select(*LINE_KEY, "l_quantity", line_cost().alias("cost"), (F.col("l_returnflag") == "R").alias("voided")).where(F.col("l_orderkey").isNotNull())
    x = x.repartition(tasks, "l_orderkey") if tasks else x
    return x.join(_headers(orders, customer), F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")


def _told(joined: DataFrame) -> DataFrame:
    """The fact's columns that a joined line tells by itself."""
    return joined.select(
        *LINE_KEY, "patient_id", client_of().alias("client_id"), "h_id", "client_h_id", "invoice_date",
        F.col("l_quantity").cast("decimal(18,4)").alias("quantity"),
        F.ceil(F.col("l_quantity") / 10).cast("int").alias("quantity_norm"),
        "cost", "voided", F.col(MONTH) if MONTH in joined.columns else month_of(F.col("invoice_date")).alias(MONTH),
        *(c for c in ("_slice",) if c in joined.columns),
    )


def fact_rows(lineitem: DataFrame, orders: DataFrame, customer: DataFrame) -> DataFrame:
    """The fact's rows without ``line_seq``: each line with its order's patient
    and day, the patient's clinic and the clinic of the patient's client."""
    return _told(_joined(lineitem, orders, customer))


def _numbered(rows: DataFrame, *placed: str) -> DataFrame:
    """rows with ``line_seq``; ``placed``: columns told from client and day that the rows are already dealt by."""
    of_day = Window.partitionBy(*placed, "client_id", "invoice_date").orderBy(*LINE_KEY)
    return rows.withColumn("line_seq", F.row_number().over(of_day))


COLUMNS = [*LINE_KEY, "patient_id", "client_id", "h_id", "client_h_id", "invoice_date", "quantity", "quantity_norm", "cost", "voided", "line_seq", MONTH]


def suggested_buckets(lineitem: DataFrame) -> int:
    """Buckets that hold about ``BUCKET_BYTES`` of a month's lines; 0 where a month is smaller."""
    n = (estimated_bytes(lineitem) or 0) // _MONTHS // BUCKET_BYTES
    return int(n) if n > 1 else 0


def _slices(lineitem: DataFrame, orders: DataFrame) -> tuple[int, int]:
    """(slices of a month, tasks): a slice of the largest month has at most
    ``SLICE_BYTES`` of lines; with four tasks for that much, few slices meet in
    one, so that a task sorts in memory. (1, 0): the lines are few, the session's tasks will do."""
    size = estimated_bytes(lineitem) or 0
    if size <= SLICE_BYTES:
        return 1, 0
    months = orders.groupBy(month_of(F.col("o_orderdate").cast("date")).alias(MONTH)).count()
    most, total = months.agg(F.max("count"), F.sum("count")).first()
    tasks = -(-4 * size // SLICE_BYTES)
    usual = int(orders.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, -(-size * (most or 0) // ((total or 1) * SLICE_BYTES))), tasks if tasks > usual else 0


class LineFact:
    """The fact in a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 0):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets
        self.key = (spark.sparkContext.applicationId, self.path)
        self.name = "line_fact_" + hashlib.md5(self.path.encode()).hexdigest()[:12]

    def _laid_out(self, rows: DataFrame) -> DataFrame:
        """A month's rows (of a bucket) together, hot ones split and small ones merged by AQE."""
        rows = rows.select(*COLUMNS)
        bucket = F.pmod(F.hash("patient_id"), F.lit(self.buckets)) if self.buckets else F.lit(0)
        rows = rows.withColumn("_bucket", bucket).hint("rebalance", MONTH, "_bucket").drop("_bucket")
        return rows.sortWithinPartitions(MONTH, "h_id", "patient_id")

    def _sliced(self, lineitem: DataFrame, orders: DataFrame, customer: DataFrame) -> DataFrame:
        """All rows, numbered and laid out by one shuffle after the join: a
        client's lines of a month are in one slice of it, so a slice holds
        whole days of a client to number, and makes a file of its month."""
        slices, tasks = _slices(lineitem, orders)
        x = _joined(lineitem, orders, customer, tasks)
        x = x.withColumn(MONTH, month_of(F.col("invoice_date")))
        x = x.withColumn("_slice", F.pmod(F.hash(client_of()), F.lit(slices))) if slices > 1 else x
        placed = [c for c in (MONTH, "_slice") if c in x.columns]
        x = x.repartition(*([tasks] if tasks else []), *placed)
        return _numbered(_told(x), *placed).select(*COLUMNS).sortWithinPartitions(MONTH, "h_id", "patient_id")

    def build(self, lineitem: DataFrame, orders: DataFrame, customer: DataFrame) -> LineFact:
        """Writes the whole fact; an older one in the folder is replaced."""
        rows = self._laid_out(_numbered(fact_rows(lineitem, orders, customer))) if self.buckets else self._sliced(lineitem, orders, customer)
        w = rows.write.format("parquet").mode("overwrite").partitionBy(MONTH)
        if self.buckets:
            w = w.bucketBy(self.buckets, "patient_id")
        w.option("path", self.path).saveAsTable(self.name)
        _CHANGES[self.key] = self.changes() + 1
        return self

    def changes(self) -> int:
        """How often this session has written the fact; what is derived from it is in step with one such number."""
        return _CHANGES.get(self.key, 0)

    def open(self) -> bool:
        """Makes a fact that is already in the folder readable; False if there is none."""
        if self.spark.catalog.tableExists(self.name):
            return True
        try:
            schema = self.spark.read.parquet(self.path).schema
        except AnalysisException as e:
            if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return False
            raise
        columns = ", ".join(f"{c} {'int' if c == MONTH else schema[c].dataType.simpleString()}" for c in COLUMNS)
        clustered = f"CLUSTERED BY (patient_id) INTO {self.buckets} BUCKETS" if self.buckets else ""
        self.spark.sql(f"CREATE TABLE {self.name} ({columns}) USING parquet PARTITIONED BY ({MONTH}) {clustered} LOCATION '{self.path}'")
        self.spark.catalog.recoverPartitions(self.name)
        return True

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def months(self) -> list[int | None]:
        return sorted((r[0] for r in self.read().select(MONTH).distinct().collect()), key=lambda m: m or 0)

    def refresh(self, lineitem: DataFrame, orders: DataFrame, customer: DataFrame) -> list[int | None]:
        """Adds late lines, or replaces those of equal line key (a line keeps
        its month); returns the months that were rewritten. The new months are
        complete in the shared checkpoint folder before an old one goes, so a
        failed run can be repeated with the same lines."""
        ensure_checkpoint_dir(self.spark)
        new = fact_rows(lineitem, orders, customer).checkpoint()
        touched = [r[0] for r in new.select(MONTH).distinct().collect()]  # one value a month
        if not touched:
            return []
        old = self.read().where(F.col(MONTH).isin([m for m in touched if m is not None]) | (F.col(MONTH).isNull() if None in touched else F.lit(False)))
        kept = old.drop("line_seq").join(new.select(*LINE_KEY).distinct(), LINE_KEY, "left_anti")
        staged = _numbered(kept.unionByName(new)).checkpoint()
        mode = "spark.sql.sources.partitionOverwriteMode"
        before = self.spark.conf.get(mode)
        self.spark.conf.set(mode, "dynamic")
        try:
            self._laid_out(staged).write.mode("overwrite").insertInto(self.name)
        finally:
            self.spark.conf.set(mode, before)
        _CHANGES[self.key] = self.changes() + 1
        return sorted(touched, key=lambda m: m or 0)


def line_fact(t) -> LineFact:
    """The fact of a set of tables: the one in the folder that the session
    names in ``spark.dosewise.lineFact``, if that holds one, or else one that is
    built now, there or beside the checkpoints."""
    conf = t.spark.conf
    path = conf.get(FACT_CONF, None)
    buckets = int(conf.get(BUCKETS_CONF, None) or suggested_buckets(t.lineitem))
    key = hashlib.md5(f"{t.spark.sparkContext.applicationId} {t.root}".encode()).hexdigest()
    fact = LineFact(t.spark, path or f"{ensure_checkpoint_dir(t.spark)}/facts/{key}", buckets)
    return fact if fact.open() else fact.build(t.lineitem, t.orders, t.customer)
