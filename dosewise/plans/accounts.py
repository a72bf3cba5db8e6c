"""Dimension views: approved accounts, accounts per performance period,
completed PSR runs, and the PSR wellness-service set.

Bindings: clinic status fields come from fixed rules on the nation key
(status 'HID Validated (R2)' unless key % 6 = 5, final approval 'No' when
key % 7 = 3, portal status key % 5); completed runs are the years of the
run history, ended each December.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..context import RunContext
from ..operators.grid import spine
from ..operators.sizing import maybe_broadcast
from ..sources import binding as b
from ..sources.tables import Tables
from . import last_dose, ppr, psr

VALIDATED = "HID Validated (R2)"


def enrolled_clinics(t: Tables) -> DataFrame:
    """The enrollment side of the account view: clinics with at least one
    enrolled patient (a distinct over the patient table)."""
    return b.patients(t).select("h_id").distinct()


def clinic_status(t: Tables) -> DataFrame:
    """Cross-reference rows of the enrolled clinics with their status fields."""
    n = F.col("h_id")
    return b.clinics(t).join(enrolled_clinics(t), "h_id", "left_semi").select(
        "*",
        F.when(n % 6 == 5, F.lit("Pending")).otherwise(F.lit(VALIDATED)).alias("status"),
        F.when(n % 7 == 3, F.lit("No")).otherwise(F.lit("Yes")).alias("final_approval"),
        (n % 5).alias("status_vi_portal"),
    )


def accounts(t: Tables, ctx: RunContext) -> DataFrame:
    """DI1: validated, approved clinics with an active portal."""
    c = clinic_status(t)
    return c.where((F.col("status") == VALIDATED) & (F.col("final_approval") == "Yes")
                   & ~F.col("status_vi_portal").isin(0)).select(
        F.col("h_id").alias("hid"), "location_number", "clinic_name", F.col("state").alias("ship_state"),
        "dose_rec_ft_dog", "dose_rec_hw_dog", "dose_rec_ft_cat", "dose_rec_hw_cat", "account_number").distinct()


def ppr_accounts(t: Tables, ctx: RunContext) -> DataFrame:
    """DI2: approved clinics x performance periods (portal status not in
    0, 11, 12, 16, 20)."""
    c = clinic_status(t).where((F.col("status") == VALIDATED) & (F.col("final_approval") == "Yes")
                               & ~F.col("status_vi_portal").isin(0, 11, 12, 16, 20))
    per = [p[0] for p in ppr.periods(ctx)]
    g = spine(c.select("h_id", "location_number", "clinic_name", "dose_rec_ft_dog", "dose_rec_hw_dog",
                       "dose_rec_ft_cat", "dose_rec_hw_cat", "account_number"), "period_desc", per)
    return g.select(F.col("h_id").alias("hid"), "*").drop("h_id").withColumn("end_date", F.lit(ctx.end_date))


def psr_meta(t: Tables, ctx: RunContext) -> DataFrame:
    """DI3: completed PSR runs of approved clinics with their 12-month label."""
    runs = last_dose.run_summary(t, ctx).select("h_id", "run_id", "update_flag").distinct()
    runs = runs.withColumn("end_date", F.make_date(F.col("update_flag") + last_dose.FIRST_YEAR, F.lit(12), F.lit(1)))
    acc = maybe_broadcast(accounts(t, ctx))
    j = runs.join(acc, runs["h_id"] == acc["hid"])
    label = F.concat(F.date_format(F.add_months("end_date", -11), "MMM ''yy"), F.lit(" - "),
                     F.date_format("end_date", "MMM ''yy"))
    return j.select("run_id", "h_id", "account_number", "location_number", "end_date",
                    label.alias("report_period"), "clinic_name", F.col("ship_state").alias("clinic_state"))


def wellness_services(t: Tables, ctx: RunContext) -> DataFrame:
    """PS0: the services that make a visit a wellness visit, with the rule."""
    p = b.products(t)
    w = psr.wellness_services(t).join(p.select("service_id", "service_kind", "product_info"), "service_id")
    return w.select("service_id", F.when(F.col("service_kind") == "vaccine", F.lit("vaccine"))
                    .when(F.col("service_kind") == "test", F.lit("heartworm test"))
                    .otherwise(F.lit("spay/neuter")).alias("reason"))


XREF_OK, XREF_MISSING = 1, -20004


def clinic_xref_check(t: Tables, ctx: RunContext) -> DataFrame:
    """AP1 as a set job: for every requested (clinic, location) pair, 1 when
    it is an approved account, -20004 otherwise. Requests are each clinic's
    own location and its neighbour's (one of them must fail)."""
    c = b.clinics(t).select("h_id", "location_number")
    req = c.unionByName(c.select("h_id", (F.col("location_number") + 1).alias("location_number")))
    acc = maybe_broadcast(accounts(t, ctx).select(F.col("hid").alias("h_id"), "location_number", F.lit(True).alias("_ok")))
    return req.join(acc, ["h_id", "location_number"], "left").select(
        "h_id", "location_number",
        F.when(F.col("_ok").isNotNull(), F.lit(XREF_OK)).otherwise(F.lit(XREF_MISSING)).alias("xref_status"))


def legacy_wellness_services(t: Tables, ctx: RunContext) -> DataFrame:
    """BK2: services classified as wellness by the keyword lists (the
    service lookup is the part list: handle = name, descr = type and brand;
    medications, tests and 'Service - test' lines excluded), united
    (distinct) with the coded vaccines, spay/neuter surgeries and tests."""
    from ..operators.keywords import keyword_classify

    p = b.products(t)
    lookup = t.part.select(F.col("p_partkey").alias("service_id"), F.col("p_name").alias("handle"),
                           F.concat_ws(" ", F.col("p_type"), F.col("p_brand")).alias("descr"))
    excl = p.where(F.col("service_kind").isin("nsaid", "fth", "test")
                   | (F.col("product_info") == "Service - test")).select("service_id")
    by_words = (lookup.join(excl, "service_id", "left_anti")
                .where(keyword_classify(F.col("handle"), F.col("descr"))).select("service_id"))
    coded = psr.wellness_services(t).select("service_id")
    return by_words.unionByName(coded).distinct()
