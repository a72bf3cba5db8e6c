"""Dimension upsert (enrollment), run-state check over the event log, and
the per-clinic data readiness profile.

Bindings: the enrollment target and staging twin are two overlapping,
perturbed slices of ``supplier`` (key s_suppkey); the run log is the event
stream (signup = run registered, view = started, purchase/error/click =
finished with success/error/info, purchase worth more than 45 = delivered
run); clinics of the readiness profile are the nations.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..context import RunContext
from ..functions.semantics import ratio_round
from ..operators import upsert as up
from ..operators.sizing import maybe_broadcast
from ..sources import binding as b
from ..sources.tables import Tables

ENROLLMENT_COLUMNS = ["account_name", "nation_key", "balance"]


# ------------------------------------------------------------------ DI4
def enrollment_target(t: Tables) -> DataFrame:
    k = F.col("s_suppkey")
    return t.supplier.where((k % 4) != 3).select(
        k.alias("location_number"), F.col("s_name").alias("account_name"),
        F.col("s_nationkey").cast("long").alias("nation_key"),
        F.when((k % 11) == 0, F.lit(None)).otherwise(F.col("s_acctbal")).cast("decimal(18,2)").alias("balance"),
        F.lit(date(2000, 1, 1)).alias("last_update"))


def enrollment_staging(t: Tables) -> DataFrame:
    k = F.col("s_suppkey")
    return t.supplier.where((k % 4) != 0).select(
        k.alias("location_number"),
        F.when((k % 5) == 0, F.concat(F.col("s_name"), F.lit(" v2"))).otherwise(F.col("s_name")).alias("account_name"),
        F.when((k % 13) == 0, (F.col("s_nationkey") + 1) % 25).otherwise(F.col("s_nationkey")).cast("long").alias("nation_key"),
        F.when((k % 7) == 0, F.lit(None)).otherwise(F.col("s_acctbal")).cast("decimal(18,2)").alias("balance"))


def merge_enrollment(t: Tables, ctx: RunContext, null_safe: bool = False, mode: str = "update_if_changed") -> DataFrame:
    """Update-if-changed upsert of the enrollment dimension (null-blind
    change test by default, as the reference's <> comparison)."""
    out = up.upsert(enrollment_target(t), enrollment_staging(t), ["location_number"], ENROLLMENT_COLUMNS,
                    ctx.as_of, null_safe=null_safe, mode=mode)
    return out.withColumn("balance", F.col("balance").cast("double"))


def refresh_enrollment(t: Tables, ctx: RunContext) -> DataFrame:
    """DM3: the merge that always takes the staging values of a matched row."""
    return merge_enrollment(t, ctx, mode="update_always")


# ------------------------------------------------------------------ OP1
def run_log(t: Tables) -> DataFrame:
    flag = (F.when(F.col("event_type") == "signup", F.lit("RUNID"))
            .when(F.col("event_type") == "view", F.lit("STARTED"))
            .when(F.col("event_type") == "purchase", F.lit("SUCCESS"))
            .when(F.col("event_type") == "error", F.lit("ERROR"))
            .otherwise(F.lit("INFO")))
    return t.events.select(F.col("user_id").alias("run_id"), flag.alias("flag"),
                           F.lit("RUN_CLINIC").alias("process"), F.col("ts").cast("date").alias("end_date"),
                           F.col("value"))


def states_of(log: DataFrame, requested: DataFrame) -> DataFrame:
    """(run_id, state) for every requested run id: unknown / already_run /
    in_progress / ok, checked in the reference's order. 'In progress' is a
    set difference: started (process, day) minus finished (process, day).
    ``log`` has run_id, flag, process, end_date and, as delivered, whether the
    row stands for a run that was completed."""
    registered = log.where(F.col("flag") == "RUNID").select("run_id").distinct()
    delivered = log.where("delivered").select("run_id").distinct()
    started = log.where(F.col("flag") == "STARTED").select("run_id", "process", "end_date")
    finished = log.where(F.col("flag").isin("SUCCESS", "ERROR", "INFO")).select("run_id", "process", "end_date")
    open_runs = started.subtract(finished).select("run_id").distinct()
    j = (requested.select("run_id").join(registered.withColumn("_reg", F.lit(True)), "run_id", "left")
         .join(delivered.withColumn("_done", F.lit(True)), "run_id", "left")
         .join(open_runs.withColumn("_open", F.lit(True)), "run_id", "left"))
    state = (F.when(F.col("_reg").isNull(), F.lit("unknown"))
             .when(F.col("_done").isNotNull(), F.lit("already_run"))
             .when(F.col("_open").isNotNull(), F.lit("in_progress"))
             .otherwise(F.lit("ok")))
    return j.select("run_id", state.alias("state"))


def run_states(t: Tables, ctx: RunContext) -> DataFrame:
    """OP1 for every requested run id (customers) over the supplied log."""
    log = run_log(t).withColumn("delivered", (F.col("flag") == "SUCCESS") & (F.col("value") > 45))
    return states_of(log, t.customer.select(F.col("c_custkey").alias("run_id")))


# ------------------------------------------------------------------ DQ1
def readiness(t: Tables, ctx: RunContext, months_back: int = 12, profiled: DataFrame | None = None) -> DataFrame:
    """Per clinic over the last ``months_back`` months: missing months,
    dog/cat share of patients (reported when <= .5) and share of lines on
    the catch-all patient 0 (reported when >= .2). Clinics in ``profiled``
    (h_id; those that the project has profiled before) are left out.

    Intent over letter: the reference restricts its patient join to dogs
    and cats *inside* the left join, so its ratio is 1 whenever any exist;
    here the denominator is all patients of the clinic's lines."""
    lo, hi = ctx.months_window(-(months_back - 1), 0)
    pats = b.patients(t).select("patient_id", "h_id", "vi_species_id")
    x = b.lines(t, lo, hi, pats).select("patient_id", "h_id", "vi_species_id", "invoice_date")
    g = x.groupBy("h_id").agg(
        F.countDistinct(F.trunc("invoice_date", "MM")).alias("month_count"),
        F.countDistinct(F.when(F.col("vi_species_id").isin(3, 7), F.col("patient_id"))).alias("cats_dogs_total"),
        F.countDistinct("patient_id").alias("total_patients"),
        F.sum(F.when(F.col("patient_id") == 0, 1).otherwise(0)).alias("patient_0"),
        F.count(F.lit(1)).alias("total_rows"),
    )
    clin = maybe_broadcast(b.clinics(t).select("h_id", (F.col("h_id") % 5).alias("status_vi_portal")))
    if profiled is not None:
        clin = clin.join(profiled.select("h_id").distinct(), "h_id", "left_anti")
    j = clin.join(g, "h_id", "left")
    ratio = ratio_round(F.col("cats_dogs_total"), F.col("total_patients"), 4)
    share0 = ratio_round(F.col("patient_0"), F.col("total_rows"), 4, when_zero=None)
    missing = F.lit(months_back) - F.coalesce(F.col("month_count"), F.lit(0))
    return j.select(
        "h_id",
        F.when(missing > 0, missing).cast("long").alias("missing_months"),
        F.when(F.coalesce(F.col("total_patients"), F.lit(0)) == 0, F.lit(0.0))
        .when(ratio > 0.5, F.lit(None)).otherwise(ratio).alias("missing_species"),
        F.when(share0 < 0.2, F.lit(None)).otherwise(share0).alias("pat_id_0"),
        # DM6: the portal status is reported only when it is not 1
        F.when(F.col("status_vi_portal") != 1, F.col("status_vi_portal")).cast("long").alias("status_not_1"),
    )
