from datetime import date
import tempfile

import pytest

from dosewise.context import RunContext
from dosewise.plans import catalog, consumer, control, last_dose, nsaid, ppr, psr
from dosewise.plans.runs import run_clinic, run_report
from dosewise.sources import binding as b
from dosewise.sources.tables import Tables

from .conftest import SMALL, SMOKE


def test_psr_run_writes_every_table(spark):
    out = tempfile.mkdtemp(prefix="psr-run-", dir="/tmp")
    paths = run_report(spark, SMOKE, out, "PSR", RunContext())
    assert len(paths) == 16
    t14 = spark.read.parquet(paths["psr_t14"])
    assert t14.count() == 100  # 25 clinics x 2 markets x 2 species


def test_file_reports_append_and_publish(spark):
    out = tempfile.mkdtemp(prefix="files-", dir="/tmp")
    for report in ("NSAID", "UPL", "CONTROL", "CONSUMER"):
        paths = run_report(spark, SMOKE, out, report, RunContext(run_id=7), append=True, publish=True)
        for name, p in paths.items():
            df = spark.read.parquet(p)
            assert "run_id" in df.columns and df.where("run_id = 7").count() == df.count()
            assert spark.table(name).count() == df.count()


def test_run_clinic_guards(spark):
    import pytest

    from dosewise.operators.guards import NotInXref

    out = tempfile.mkdtemp(prefix="clinic-", dir="/tmp")
    ok = run_clinic_for(spark, out, 1001)
    assert spark.read.parquet(ok["nsaid_purch_report"]).select("h_id").distinct().count() <= 1
    with pytest.raises(NotInXref):
        run_clinic_for(spark, out, 99999)


def run_clinic_for(spark, out, location):
    from dosewise.plans.runs import run_clinic

    return run_clinic(spark, SMOKE, out, "NSAID", RunContext(location_number=location))


def test_by_clinic_partitioning(spark):
    out = tempfile.mkdtemp(prefix="byclinic-", dir="/tmp")
    paths = run_report(spark, SMOKE, out, "NSAID", RunContext(), by_clinic=True)
    import os

    assert any(d.startswith("h_id=") for d in os.listdir(paths["nsaid_purch_report"]))


def test_cluster_defaults_respect_operator(spark):
    from dosewise.session import apply_cluster_defaults

    before = spark.conf.get("spark.sql.shuffle.partitions")
    apply_cluster_defaults(spark)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before  # operator-owned, left alone
    assert spark.conf.get("spark.sql.adaptive.skewJoin.skewedPartitionFactor") == "5"
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "5")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
    spark.conf.unset("spark.dosewise.broadcastCapBytes")


def test_same_run_twice_keeps_its_rows(spark, tmp_path):
    from dosewise.context import make_run
    from dosewise.plans.runs import run_report

    ctx = make_run("UPL", end_date=date(2001, 7, 1))
    for _ in range(2):
        paths = run_report(spark, "/root/testdata/sf0.001", str(tmp_path), "UPL", ctx, append=True)
        rows = spark.read.parquet(paths["upl_report"])
        first = rows.count() if _ == 0 else first  # noqa: F821
        assert rows.count() == first and "run_id" in rows.columns


REPORTS = ("PSR", "PPR", "CONSUMER", "CONTROL", "LAST DOSE", "NSAID", "UPL")


@pytest.mark.parametrize("report", REPORTS)
def test_a_clinics_run_equals_its_slice_of_the_whole(spark, tmp_path, report):
    """Scoped scans change no row of the clinic."""
    ctx = RunContext(location_number=1001)
    sf = SMALL if report == "LAST DOSE" else SMOKE  # the clinic has no details of that report in the smaller tables
    scoped = run_clinic(spark, sf, f"{tmp_path}/one", report, ctx)
    whole = run_report(spark, sf, f"{tmp_path}/all", report, ctx)
    assert scoped.keys() == whole.keys()
    for name, path in scoped.items():
        a, b = spark.read.parquet(path), spark.read.parquet(whole[name])
        b = b.where("h_id = 1") if "h_id" in b.columns else b
        if name == "last_dose_report":  # the whole run also has purchases of the clients' pets that belong to other clinics
            t = Tables(spark, sf)
            theirs = last_dose.last_dose_purchases(t, ctx, nsaid.last_dose_patients(t, ctx), last_dose.incremental_start(t, ctx)).where("h_id = 1").select("lineitem_id")
            a, b = a.where("record_type = '2DT'"), b.where("record_type = '2DT'").join(theirs, "lineitem_id", "left_semi").select(*a.columns)
            assert a.count() > 0
        if name == "last_dose_nic_report":  # so a client may have lapsed at the clinic that another clinic still serves
            a, b = (x.where("record_type = '2DT' AND creation_date = '1001'").select("client_id") for x in (a, b))
            a = a.join(b, "client_id", "left_semi")
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name


def test_a_scoped_run_reads_its_clinic_only(spark):
    t = Tables(spark, SMOKE).scoped([3])
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    for df in (psr.patient_master(t, RunContext()), consumer.consumer_report(t, RunContext()), ppr.t5_dose_share(t, RunContext()), control.control_file(t, RunContext())):
        plan = df._jdf.queryExecution().executedPlan().toString()
        scans = [line for line in plan.splitlines() if "FileScan parquet spark_catalog" in line]
        assert scans
        for scan in scans:
            assert "Or(EqualTo(h_id,3),EqualTo(client_h_id,3))" in scan.replace("In(h_id, [3])", "EqualTo(h_id,3)").replace("In(client_h_id, [3])", "EqualTo(client_h_id,3)"), scan
    lines = b.lines(t).select("patient_id", "client_id").distinct()
    theirs = t.customer.where("c_nationkey = 3").select("c_custkey").distinct().collect()
    keys = {r[0] for r in theirs}
    assert all(r["patient_id"] in keys or 3 * r["client_id"] in keys for r in lines.collect())
    assert {3 * r["client_id"] for r in b.clients(t).collect()} == {k - k % 3 for k in keys} - {0} and b.clinics(t).count() == 1


def test_wellness_masters_scan_the_lines_once(spark):
    for name in ("psr_product_master", "psr_month_master", "psr_t5_dose_share", "psr_t6_doses_per_patient", "psr_t10_revenue_share", "psr_t11_trend", "ppr_product_master", "ppr_t5_dose_share", "consumer_report"):
        plan = catalog.QUERIES[name](spark, SMOKE)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan parquet spark_catalog") == 1, name
