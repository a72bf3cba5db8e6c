"""One aggregate of the lines from which the wellness masters are derived.

The product and month masters count only patients with wellness care in the
window, which a second scan of the lines for those patients would need. Here
the lines are summed once by patient, family, type and month, the wellness
lines with them; a patient's care is a window over his few dozen sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators import compliance as cp


def is_wellness(kind: Column, info: Column) -> Column:
    """Services that make a visit a wellness visit: vaccines, spay/neuter surgery, heartworm tests."""
    return (kind == "vaccine") | (info == "Surgery - spay") | (kind == "test")


def wellness_rollup(lines: DataFrame, period: tuple[str, ...] = ()) -> DataFrame:
    """Lines with product attributes -> one row per ``period``, clinic,
    patient, month, family and type of the patients with wellness care in the
    period. Sales without cost, dose or product type keep a row (their family
    and type are NULL), so that a patient seen in a month is one of its patients."""
    sold = F.col("type").isNotNull() & (F.col("cost") != 0) & (F.col("quantity_norm") != 0) & ~F.col("voided")
    typ, q = F.when(sold, F.col("type")), F.col("quantity_norm").cast("long")
    sums = lines.groupBy(
        *period, "h_id", "patient_id", "vi_species_id", F.trunc("invoice_date", "MM").alias("data_month"),
        F.when(sold, F.col("family_name")).alias("family_name"), typ.alias("type"),
    ).agg(
        F.sum(F.when(sold, q)).alias("doses"),
        F.sum(cp.ft_doses(typ, q)).alias("ft_doses"), F.sum(cp.hw_doses(typ, q)).alias("hw_doses"),
        F.sum(cp.ft_revenue(typ, F.col("cost"))).alias("ft_rev"), F.sum(cp.hw_revenue(typ, F.col("cost"))).alias("hw_rev"),
        F.count(F.when(is_wellness(F.col("service_kind"), F.col("product_info")), 1)).alias("_care"),
    )
    care = F.sum("_care").over(Window.partitionBy(*period, "h_id", "patient_id"))
    return sums.withColumn("_care", care).where("_care > 0").drop("_care")


def product_sums(rollup: DataFrame, *keys: str) -> DataFrame:
    """Per key, species, family and type (f folded into ft): patients, doses and revenue by market."""
    typ = F.when(F.col("type") == "f", F.lit("ft")).otherwise(F.col("type")).alias("type")
    return rollup.where(F.col("type").isNotNull()).groupBy(*keys, "vi_species_id", "family_name", typ).agg(
        F.countDistinct("patient_id").alias("patients"), F.sum("doses").alias("doses"),
        F.sum("hw_rev").alias("hw_rev"), F.sum("ft_rev").alias("ft_rev"))
