"""Report runs: build every table of a report from shared masters and
write them out.

A master that feeds many tables (the PSR patient master feeds nine) is
materialised once with a reliable ``checkpoint()`` into the cluster's
shared ``spark.checkpoint.dir``; that cuts the lineage, so a lost executor
re-reads the checkpoint instead of re-running the line scan. Outputs are
Parquet folders written with ``mode("overwrite")`` (a rerun replaces them).
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..context import RunContext
from ..session import ensure_checkpoint_dir
from ..sources.tables import Tables
from pyspark.sql import functions as F

from . import calllist, consumer, control, last_dose, nsaid, ppr, psr
from .runlog import RunLog


def shared(df: DataFrame) -> DataFrame:
    """Materialise ``df`` once in the shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def psr_tables(t: Tables, ctx: RunContext) -> dict[str, DataFrame]:
    pm = shared(psr.patient_master(t, ctx))
    rollup = shared(psr.wellness_rollup(t, ctx))
    pm2 = shared(psr.product_master(t, ctx, rollup))
    mm = psr.month_master(t, ctx, rollup)
    return {
        "psr_patient_master": pm,
        "psr_product_master": pm2,
        "psr_month_master": mm,
        "psr_t1": psr.t1_coverage(t, ctx, pm),
        "psr_t2": psr.t2_dose_histogram(t, ctx, pm),
        "psr_t3": psr.t3_baby_coverage(t, ctx, pm),
        "psr_t5": psr.t5_dose_share(t, ctx, pm2),
        "psr_t6": psr.t6_doses_per_patient(t, ctx, pm2),
        "psr_t7": psr.t7_potential_revenue(t, ctx, pm),
        "psr_t8": psr.t8_kpis(t, ctx, pm),
        "psr_t10": psr.t10_revenue_share(t, ctx, pm2),
        "psr_t11": psr.t11_trend(t, ctx, mm),
        "psr_t12": psr.t12_dose_histogram(t, ctx, pm),
        "psr_t13a": psr.t13a_coarse_histogram(t, ctx, pm),
        "psr_t13": psr.t13_rec_histogram(t, ctx, pm),
        "psr_t14": psr.t14_missed_revenue(t, ctx, pm),
    }


def ppr_tables(t: Tables, ctx: RunContext) -> dict[str, DataFrame]:
    pm = shared(ppr.patient_master(t, ctx))
    pm2 = shared(ppr.product_master(t, ctx))
    return {
        "ppr_patient_master": pm,
        "ppr_product_master": pm2,
        "ppr_t1_pre": ppr.t1_pre(t, ctx, pm),
        "ppr_t1": ppr.t1_trend(t, ctx, pm),
        "ppr_t2": ppr.t2_histogram(t, ctx, pm),
        "ppr_t3": ppr.t3_rec_histogram(t, ctx, pm),
        "ppr_t4": ppr.t4_revenue(t, ctx, pm),
        "ppr_t5": ppr.t5_dose_share(t, ctx, pm2),
    }


def consumer_tables(t: Tables, ctx: RunContext) -> dict[str, DataFrame]:
    # the 24-month line frame feeds four stages of different grain (client
    # metrics, competitor ranks, header counts, NSAID clients): materialise
    # it once instead of re-joining lineitem for each
    cp = shared(consumer.consumer_patients(t, ctx))
    lines = shared(consumer.consumer_lines(t, ctx, cp))
    return {"consumer_report": consumer.consumer_file(t, ctx, cp, lines, materialize=shared)}


def control_tables(t: Tables, ctx: RunContext) -> dict[str, DataFrame]:
    lines = shared(control.control_lines(t, ctx))
    return {"control_report": control.control_file(t, ctx, lines, materialize=shared)}


def last_dose_tables(t: Tables, ctx: RunContext) -> dict[str, DataFrame]:
    return {"last_dose_report": last_dose.last_dose_file(t, ctx)}


def update_lapsed_list(t: Tables, out_dir: str, ctx: RunContext) -> dict[str, DataFrame]:
    """Merges a run's lapsed clients into the list that ``out_dir`` keeps for
    all runs (nothing before the second delivery); returns the list's file."""
    if last_dose.current_flag(ctx) <= 1:
        return {}
    kept = last_dose.LapsedList(t.spark, os.path.join(out_dir, "last_dose_nic"))
    kept.run(t, ctx)
    return {"last_dose_nic_report": kept.file()}


def nsaid_tables(t: Tables, ctx: RunContext) -> dict[str, DataFrame]:
    return {"nsaid_purch_report": nsaid.nsaid_purchase_file(t, ctx)}


def upl_tables(t: Tables, ctx: RunContext) -> dict[str, DataFrame]:
    return {"upl_report": calllist.call_list(t, ctx)}


REPORTS: dict[str, Callable[[Tables, RunContext], dict[str, DataFrame]]] = {
    "PSR": psr_tables, "PPR": ppr_tables, "CONSUMER": consumer_tables, "CONTROL": control_tables,
    "LAST DOSE": last_dose_tables, "NSAID": nsaid_tables, "UPL": upl_tables,
}


def run_report(spark: SparkSession, sf_dir: str, out_dir: str, report: str = "PSR",
               ctx: RunContext | None = None, append: bool = False, publish: bool = False,
               by_clinic: bool = False, log: RunLog | None = None) -> dict[str, str]:
    """Build and write every table of ``report``; returns name -> path.

    ``append=True`` keeps other runs: each has a folder ``run_id=<id>`` of
    its own, which a repeated run with the same id replaces. ``by_clinic=True`` also partitions by ``h_id``, so each
    clinic's file is its own folder. ``publish=True`` registers each table
    as a temp view, file-shaped tables ordered header, detail, trailer on
    read. With a ``log``, the run is registered and its attempt logged as
    started and then as a success or an error; a success is a delivery."""
    ctx = ctx or RunContext()
    if log is not None:
        log.write(ctx, "RUN", "RUNID")
        with log.process(ctx, f"BUILD {report.upper()}"):
            paths = run_report(spark, sf_dir, out_dir, report, ctx, append, publish, by_clinic)
        log.write(ctx, "RUN", "DELIVERED")
        return paths
    t = Tables(spark, sf_dir)
    paths = {}
    tables = REPORTS[report.upper()](t, ctx)
    if report.upper() == "LAST DOSE":
        tables |= update_lapsed_list(t, out_dir, ctx)
    for name, df in tables.items():
        path = os.path.join(out_dir, name)
        target = f"{path}/run_id={ctx.run_id}" if append else path
        if by_clinic and "h_id" in df.columns:  # one file a clinic, however many tasks held its rows
            df.repartition("h_id").write.mode("overwrite").partitionBy("h_id").parquet(target)
        else:
            df.write.mode("overwrite").parquet(target)
        paths[name] = path
        if publish:
            publish_view(spark, name, path)
    return paths


def publish_view(spark: SparkSession, name: str, path: str) -> None:
    """SK6: a read view over a written table; header/detail/trailer files
    read back in file order within each clinic (record type first)."""
    df = spark.read.parquet(path)
    if "record_type" in df.columns:
        keys = ("run_id", "h_id", "record_type", "client_id", "patient_id", "lineitem_id")
        df = df.orderBy(*(k for k in keys if k in df.columns))
    df.createOrReplaceTempView(name)


def run_clinic(spark: SparkSession, sf_dir: str, out_dir: str, report: str, ctx: RunContext) -> dict[str, str]:
    """AP3 for one clinic: check the cross-reference (AP1), guard the
    stages the reference guards (CT0, CO1/LD12 no patients, LD12 no
    details), then write the clinic's slice of every table.

    The run reads scoped tables: the clinic is a filter of the nation,
    customer and line-fact scans, before any join or shuffle, so that masters
    and line frames hold the clinic's rows only. Its clients' pets that belong
    to another clinic count where a table counts per client (their lines are
    read, too), but LAST DOSE, whose start day is the pet's clinic's, lists the
    clinic's own pets."""
    from ..operators.guards import NoDetails, NoPatients, NotInXref, require_rows
    from . import accounts as acc

    if ctx.location_number is None:
        raise ValueError("run_clinic needs ctx.location_number")
    t = Tables(spark, sf_dir)
    xref = acc.accounts(t, ctx).where(F.col("location_number") == ctx.location_number)
    require_rows(xref, NotInXref, str(ctx.location_number))
    h_id = xref.select("hid").first()[0]
    t = t.scoped([h_id])
    rt = report.upper()
    if rt == "CONTROL":
        control.require_control_clinic(t, h_id)
    if rt in ("CONSUMER", "LAST DOSE"):
        pats = (consumer.consumer_patients(t, ctx) if rt == "CONSUMER" else nsaid.last_dose_patients(t, ctx))
        require_rows(pats.where(F.col("h_id") == h_id), NoPatients, str(h_id))
    paths = {}
    for name, df in REPORTS[rt](t, ctx).items():
        part = df.where(F.col("h_id") == h_id) if "h_id" in df.columns else df
        if rt == "LAST DOSE" and name == "last_dose_report":
            require_rows(part.where(F.col("record_type") == "2DT"), NoDetails, str(h_id))
        path = os.path.join(out_dir, f"{name}_{ctx.location_number}")
        part.write.mode("overwrite").parquet(path)
        paths[name] = path
    if rt == "LAST DOSE":  # one file for all clinics
        for name, df in update_lapsed_list(t, out_dir, ctx).items():
            paths[name] = os.path.join(out_dir, name)
            df.write.mode("overwrite").parquet(paths[name])
    return paths
