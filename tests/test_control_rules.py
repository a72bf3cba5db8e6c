"""CONTROL categories on hand-made lines, expected values worked out from the report's rules."""

from datetime import date

from dosewise.functions.semantics import scaled_round
from dosewise.plans import control
from pyspark.sql import functions as F

LINE = "in_control boolean, cost decimal(18,4), service_kind string, product_info string, type string, quantity_norm int, start_date date, invoice_date date"
START, DAY = date(2001, 1, 1), date(2001, 2, 1)


def counts(spark, rows):
    frame = spark.createDataFrame([(*r[:6], START, r[6] if len(r) > 6 else DAY) for r in rows], LINE)
    since = date(1999, 8, 1)
    got = frame.agg(*control.service_aggs((F.col("start_date"), F.lit(date(2001, 7, 31))), since)).first()
    return {tag: (got[f"num_{tag}_purch"], got[f"dollar_{tag}_purch"]) for tag in control.service_tags(since)} | {"last_pm": got["last_pm_purch"]}


def test_only_control_patients_and_paid_lines_count(spark):
    from decimal import Decimal as D

    got = counts(spark, [
        (True, D(10), "general", "Surgery - dental", None, None), (False, D(99), "general", "Surgery - dental", None, None),  # an inactive patient
        (True, D(0), "general", "Surgery - spay", None, None), (True, D(7), "general", "Surgery - spay", None, None),  # one without cost
        (True, D(5), "general", "Service - test", None, None),  # a general service of no named group
        (True, D(3), "general", "Service - Boarding", None, None), (True, D(2), "diet", "Food", None, None),
        (True, D(4), "fth", "x", "ft", 6), (True, D(8), "fth", "x", "ft", 0), (True, D(0), "nsaid", "y", None, None), (True, D(6), "nsaid", "y", None, None),
    ])
    assert got.pop("last_pm") == DAY
    assert got == {"pm": (1, 6.0), "dental": (1, 10.0), "surg": (1, 7.0), "vacc": (0, 0.0), "board": (1, 3.0), "groom": (0, 0.0), "other": (2, 13.0)}


def test_medication_starts_23_months_before_the_end(spark):
    from decimal import Decimal as D

    old = [(True, D(5), "nsaid", "y", None, None, date(1999, 7, 31))]
    assert counts(spark, old)["last_pm"] is None
    assert counts(spark, [*old, (True, D(5), "nsaid", "y", None, None, date(1999, 8, 1))])["last_pm"] == date(1999, 8, 1)


def test_thirds_of_a_pill_add_up(spark):
    frame = spark.createDataFrame([(1, 3)] * 3 + [(2, 3)] * 3, "q int, dv int")
    pills = scaled_round(F.sum(scaled_round(F.col("q"), F.col("dv"), 9)), F.lit(10**9), 2) / 100.0
    assert frame.where("q = 1").agg(pills.alias("p")).first()[0] == 1.0 and frame.agg(pills.alias("p")).first()[0] == 3.0


def test_last_dose_rows_have_ids_of_their_own_and_lapsed_clients_have_dogs(spark):
    from dosewise.context import DEFAULT_CONTEXT as ctx
    from dosewise.plans import last_dose
    from dosewise.sources import binding as b
    from dosewise.sources.tables import Tables

    t = Tables(spark, "/root/testdata/sf0.01")
    file = last_dose.last_dose_file(t, ctx).cache()
    detail = file.where("record_type = '2DT'")
    assert detail.count() == detail.select("lineitem_id").distinct().count()
    head = file.where("record_type = '1HD'").first()
    assert (head["lineitem_id"], head["address1"], head["address2"], head["city"]) == ("08/01/2001", "7", "2001", "PH")
    gone = last_dose.newly_inactive(t, ctx)
    dogs = b.patients(t).where("vi_species_id = 3").select("client_id").distinct()
    assert gone.join(dogs, "client_id", "left_anti").count() == 0
    assert gone.join(last_dose.last_dose_clients(t, ctx).where("canines > 0"), "client_id", "left_semi").count() == 0
    assert {r["update_flag"] for r in last_dose.newly_inactive(t, ctx.with_(update_flag=3)).select("update_flag").distinct().collect()} == {3}


def test_the_run_before_flag_1_delivered_nothing(spark):
    from dosewise.context import DEFAULT_CONTEXT as ctx
    from dosewise.plans import last_dose
    from dosewise.sources.tables import Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    assert (last_dose.current_flag(ctx), last_dose.current_flag(ctx.with_(update_flag=0))) == (6, 0)
    assert last_dose.newly_inactive(t, ctx.with_(update_flag=0)).count() == 0
    merged = last_dose.newly_inactive_merged(t, ctx.with_(update_flag=1))
    assert {r["update_flag"] for r in merged.select("update_flag").distinct().collect()} <= {1}


def test_sale_days_are_bounds_of_the_scan(spark):
    from datetime import date as day

    from dosewise.sources import binding as b
    from dosewise.sources.tables import Tables

    plan = b.nsaid_sales(Tables(spark, "/root/testdata/sf0.01"), day(2001, 6, 5), day(2001, 6, 9))._jdf.queryExecution().toString()
    pushed = plan[plan.index("PushedFilters"):]
    assert "GreaterThanOrEqual(ts" in pushed


def test_last_dose_file_is_planned_without_a_job(spark):
    from dosewise.context import DEFAULT_CONTEXT as ctx
    from dosewise.plans import last_dose
    from dosewise.sources.tables import Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    for name in ("customer", "orders", "lineitem", "part", "nation", "region", "events"):
        t[name]  # reading a footer may be a job
    jobs = lambda: len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    before = jobs()
    file = last_dose.last_dose_file(t, ctx)
    assert jobs() == before
    assert "scalar-subquery" in file._jdf.queryExecution().optimizedPlan().toString()


def test_sales_before_the_launch_month_are_no_purchases(spark):
    from dosewise.context import DEFAULT_CONTEXT as ctx
    from dosewise.plans import calllist
    from dosewise.sources import binding as b
    from dosewise.sources.tables import Tables

    t = Tables(spark, "/root/testdata/sf0.01")
    families = [r[0] for r in b.products(t).where("type IS NOT NULL").select("family_name").distinct().collect()]
    seen = ("last_purch_ft_canine", "last_purch_hw_canine", "last_purch_ft_feline", "last_purch_hw_feline")
    # launched after the window: no client has a purchase; before it: the same as without a rule
    none = calllist.call_list(t, ctx, {f: date(2001, 8, 1) for f in families})
    assert none.count() > 0 and none.where(" OR ".join(f"{c} IS NOT NULL" for c in seen)).isEmpty()
    plain, early = calllist.call_list(t, ctx, {}), calllist.call_list(t, ctx, {f: date(2000, 8, 20) for f in families})
    assert plain.exceptAll(early).isEmpty() and early.exceptAll(plain).isEmpty()


def test_profiled_clinics_are_left_out(spark):
    from dosewise.context import DEFAULT_CONTEXT as ctx
    from dosewise.plans import admin
    from dosewise.sources.tables import Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    done = spark.createDataFrame([(3,), (3,), (7,)], "h_id long")
    every = {r["h_id"] for r in admin.readiness(t, ctx).collect()}
    assert {r["h_id"] for r in admin.readiness(t, ctx, profiled=done).collect()} == every - {3, 7}
