"""MX1 keyed lookup with unambiguous-only fallbacks (package -> doses).

The reference computes doses per row in a scalar function with up to four
lookups. Here every tier is a join against a pre-aggregated view of the
matrix that keeps only keys with exactly one row (an ambiguous key falls
back to the raw quantity instead of failing). The matrix is a small
control table, so the joins are broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sizing import maybe_broadcast


def digits(c: Column) -> Column:
    d = F.regexp_replace(c, "[^0-9]+", "")
    return F.when(d == "", F.lit(None).cast("string")).otherwise(d)


def _unique(m: DataFrame, keys: list, value: str, name: str) -> DataFrame:
    return m.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.max(value).alias(name)).where("_n = 1").drop("_n")


def dental_doses(df: DataFrame, matrix: DataFrame, qty: str = "quantity", info: str = "product_info",
                 pkg_qty: str = "package_quantity", size: str = "package_size", vol: str = "package_volume") -> DataFrame:
    """Adds ``doses``: first tier that applies -
    1 package quantity: equal to qty -> its digits; numeric -> pq * qty; else qty;
    2 size and volume digits: unique matrix row (product, volume digits, size);
    3 volume digits: unique row among matrix rows whose raw volume equals the
      digits (the reference's filter), then the unique row with those digits;
    4 size: unique (product, size) row;
    5 qty. A tier that applies but finds no unique row returns qty."""
    m = matrix.select("product", "treat_size", "package_volume", "package_count")
    m = m.withColumn("dv", digits(F.col("package_volume")))
    t2 = maybe_broadcast(_unique(m, ["product", "dv", "treat_size"], "package_count", "c2"))
    inner3 = m.where(F.col("package_volume") == F.col("dv")).groupBy("product", "package_volume").count().where("count = 1")
    t3 = maybe_broadcast(_unique(
        m.join(inner3.select("product", F.col("package_volume").alias("dv")), ["product", "dv"], "left_semi"),
        ["product", "dv"], "package_count", "c3"))
    t4 = maybe_broadcast(_unique(m, ["product", "treat_size"], "package_count", "c4"))
    # matrix key columns get private names, so the input may carry columns
    # called ``product`` / ``treat_size`` of its own
    t2 = t2.select(F.col("product").alias("_p2"), F.col("dv").alias("_v2"), F.col("treat_size").alias("_s2"), "c2")
    t3 = t3.select(F.col("product").alias("_p3"), F.col("dv").alias("_v3"), "c3")
    t4 = t4.select(F.col("product").alias("_p4"), F.col("treat_size").alias("_s4"), "c4")
    x = df.withColumn("_dv", digits(F.col(vol)))
    x = x.join(t2, (F.col(info) == F.col("_p2")) & (F.col("_dv") == F.col("_v2")) & (F.col(size) == F.col("_s2")), "left")
    x = x.join(t3, (F.col(info) == F.col("_p3")) & (F.col("_dv") == F.col("_v3")), "left")
    x = x.join(t4, (F.col(info) == F.col("_p4")) & (F.col(size) == F.col("_s4")), "left")
    x = x.drop("_p2", "_v2", "_s2", "_p3", "_v3", "_p4", "_s4")
    q, pq = F.col(qty), F.col(pkg_qty)
    pq_num = pq.try_cast("decimal(18,4)")
    doses = (
        F.when(pq.isNotNull(),
               F.when(pq == q.cast("string"), digits(pq).cast("decimal(18,4)"))
               .when(pq_num.isNotNull(), pq_num * q).otherwise(q))
        .when(F.col(size).isNotNull() & F.col(vol).isNotNull() & F.col("_dv").isNotNull(),
              F.coalesce(F.col("c2") * q, q))
        .when(F.col("_dv").isNotNull(), F.coalesce(F.col("c3") * q, q))
        .when(F.col(size).isNotNull(), F.coalesce(F.col("c4") * q, q))
        .otherwise(q)
    )
    return x.withColumn("doses", doses.cast("decimal(18,4)")).drop("_dv", "c2", "c3", "c4")
