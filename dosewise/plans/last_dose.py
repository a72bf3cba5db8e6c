"""LAST DOSE - incremental purchase history file and newly inactive clients.

Runs are keyed by (clinic, update flag). The supplied data has no run log,
so the history is bound to calendar years of the invoice lines: year
1995 + f is the run with update flag f of each clinic, and its delivered
detail is the clinic's flea/tick/heartworm lines of that year. The current
run is the run context's year.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..context import RunContext, add_months
from ..functions.semantics import id_remap, mdy, money_text, ratio_round
from ..operators import contact as cl
from ..operators import events as ev
from ..operators import trailing as tm
from ..operators.sizing import maybe_broadcast
from ..operators.versioned import VersionedTable, replace_rows
from ..sources import binding as b
from ..sources.facts import MONTH
from ..sources.marks import delivery_marks
from ..sources.tables import Tables
from .nsaid import _pills_below, last_dose_patients

FIRST_YEAR = 1995
FULL_YEAR_FLAG = 11
DOG = 3
FILE_TYPE = "PH"  # purchase history


def current_flag(ctx: RunContext) -> int:
    """The run's update flag; a run that names none has that of its year."""
    return ctx.end_date.year - FIRST_YEAR if ctx.update_flag is None else ctx.update_flag


def line_id(source: str, *parts: str) -> Column:
    """One id for each delivered row: invoice lines and sale events have
    number ranges of their own, and an order has many lines."""
    return F.concat_ws("-", F.lit(source), id_remap(F.col(parts[0])).cast("string"), *(F.col(p).cast("string") for p in parts[1:]))


# ------------------------------------------------------------ run history
def run_summary(t: Tables, ctx: RunContext) -> DataFrame:
    """Delivered detail of earlier runs by (clinic, run, flag, client): last
    delivered invoice day, and whether the delivered rows count dogs. Both the
    incremental start and the lapsed-client list derive from it. It is read
    from the stored marks (a row a client and month), not from the lines."""
    hi = ctx.end_date.replace(month=1, day=1)
    flag = (F.floor(F.col(MONTH) / 100) - FIRST_YEAR).cast("int")
    x = delivery_marks(t).where(F.col(MONTH) < hi.year * 100 + hi.month)
    return (x.select("h_id", (F.col("h_id") * 100 + flag).alias("run_id"), flag.alias("update_flag"), "client_id", "last_day", "dogs")
            .groupBy("h_id", "run_id", "update_flag", "client_id")
            .agg(F.max("last_day").alias("last_invoice"), F.max("dogs").alias("dogs")))


# ------------------------------------------------------------------ IN1
def incremental_start(t: Tables, ctx: RunContext, update_flag: int | None = None,
                      hist: DataFrame | None = None) -> DataFrame:
    """Start day per clinic: day after the last delivered invoice of the
    latest earlier run (smaller update flag); end - 12 months when there is
    none or the flag asks for a full year (11)."""
    flag = current_flag(ctx) if update_flag is None else update_flag
    fallback = add_months(ctx.end_date, -12)
    clin = maybe_broadcast(b.clinics(t).select("h_id"))
    if flag == FULL_YEAR_FLAG:
        return clin.select("h_id", F.lit(fallback).alias("start_date"))
    hist = hist if hist is not None else run_summary(t, ctx)
    per_run = hist.where(F.col("update_flag") < flag).groupBy("h_id", "run_id").agg(
        F.max("last_invoice").alias("last_delivered"))
    latest = per_run.groupBy("h_id").agg(F.max_by("last_delivered", "run_id").alias("last_delivered"))
    return clin.join(latest, "h_id", "left").select(
        "h_id", F.coalesce(F.date_add("last_delivered", 1), F.lit(fallback)).alias("start_date"))


# ------------------------------------------------------------------ LD2-LD4
def last_dose_clients(t: Tables, ctx: RunContext, pats: DataFrame | None = None,
                      split: DataFrame | None = None) -> DataFrame:
    """LD2-LD4: clients of the run's patients, cleansed, minus missing
    state/city, excluded regions, bad zips and the extended deny list;
    with a split list (LD3) only listed clients of split clinics stay."""
    pats = pats if pats is not None else last_dose_patients(t, ctx)
    s, pid = F.col("vi_species_id"), F.col("patient_id")
    hh = tm.household(pats, ["client_id"], [
        F.max("dogs_over_6").alias("dogs_over_6"), F.sum("dogs_over_4").alias("dogs_over_4"),
        F.max("puppy").alias("puppy"),
        F.countDistinct(F.when(s == DOG, pid)).alias("canines"),
        F.countDistinct(F.when(s == 7, pid)).alias("felines"),
        F.min("first_active").alias("first_visit"),
    ])
    email = F.regexp_replace(cl._strip(F.col("primary_email"), cl.NAME_CHARS), "\n", " ")
    c = b.clients(t).where((F.col("enabled") == "1") & F.coalesce(F.col("pms_client_code"), F.lit(2)).isin(2, 3, 4))
    c = c.join(hh, "client_id")
    if split is not None:
        from .consumer import apply_split

        c = apply_split(c, split)
    c = c.select(
        "client_id", "h_id",
        cl.clean_name(F.col("first_name")).alias("first_name"), cl.clean_name(F.col("last_name")).alias("last_name"),
        cl.clean_control(F.col("title")).alias("prefix"),
        cl.clean_address(F.col("address1"), cl.NONE_GIVEN).alias("address1"),
        cl.clean_address(F.col("address2")).alias("address2"),
        cl.clean_control(F.col("city")).alias("city"), cl.clean_control(F.col("state")).alias("state"),
        cl.clean_zip(F.col("postal_code")).alias("postal_code"), cl.clean_phone(F.col("phone1")).alias("phone1"),
        email.alias("primary_email"), "dogs_over_6", F.col("dogs_over_4").cast("long").alias("dogs_over_4"),
        "puppy", "canines", "felines", "first_visit",
    )
    z = F.col("postal_code")
    drop = (
        F.col("state").isNull() | F.col("city").isNull() | cl.excluded_region(F.col("state"))
        | z.isNull() | z.contains("0000") | z.isin("000000", "0", "00", "000")
        | cl.denied_client(F.col("first_name"), F.col("last_name"), F.col("address1"), F.col("address2"), extended=True)
    )
    return c.where(~F.coalesce(drop, F.lit(False)))


# ------------------------------------------------------------------ LD5-LD8
def last_dose_purchases(t: Tables, ctx: RunContext, pats: DataFrame, starts: DataFrame) -> DataFrame:
    """Flea/tick/heartworm lines and NSAID sales of the run's patients from
    the clinic's start month to the end month, with same-day appointment
    flags; short NSAID courses near a surgery are dropped."""
    end_excl = add_months(ctx.end_date, 1)
    # the scan bound: a scalar subquery, so that no job runs while the plan is built
    lo = starts.agg(F.trunc(F.min("start_date"), "MM").alias("lo")).scalar()
    st = maybe_broadcast(starts.select("h_id", F.trunc("start_date", "MM").alias("start_month")))
    p = pats.select("patient_id", "client_id", "h_id")
    from ..operators.matrix import dental_doses
    from .calllist import dental_matrix, package_fields
    from .control import DENTAL_HYG_GROUPS

    # FTH products and dental-hygiene services: one line frame, split by kind
    prod = maybe_broadcast(
        b.products(t).where(F.col("type").isNotNull() | F.col("product_info").isin(*DENTAL_HYG_GROUPS))
        .select("service_id", "type", "family_name", "product_info")
        .join(package_fields(t).drop("product_info"), "service_id", "left"))
    x = (
        b.lines(t, lo, end_excl, p.select("patient_id", "h_id")).where(~F.col("voided") & (F.col("quantity_norm") != 0))
        .select(*b.LINE_KEY, "patient_id", "client_id", "h_id", "invoice_date", "service_id", "quantity",
                "quantity_norm", "cost")
        .join(prod, "service_id").join(st, "h_id")
        .where(F.col("invoice_date") >= F.col("start_month"))
    )
    x = ev.same_day_flag(x, b.appointments(t), ["patient_id"], "invoice_date", "appointment_date")
    # the dose function takes the raw line quantity (not the normalised one)
    x = dental_doses(x.withColumn("quantity", F.col("quantity").cast("long")), dental_matrix(t.spark))
    is_fth = F.col("type").isNotNull()
    fth = x.select(
        line_id("L", *b.LINE_KEY).alias("lineitem_id"), "patient_id", "client_id", "h_id", "invoice_date",
        F.when(is_fth, F.col("family_name")).otherwise(F.col("product_info")).alias("product"),
        F.when(is_fth, F.col("quantity_norm").cast("decimal(18,4)")).otherwise(F.col("doses")).cast("decimal(18,4)").alias("quantity"),
        F.col("cost").cast("decimal(18,4)").alias("cost"),
        F.when(is_fth, F.lit(None)).otherwise(F.col("doses")).cast("decimal(18,4)").alias("pills"),
        "appointment_flag", F.coalesce(F.col("type"), F.lit("DENTALHYGIENE")).alias("type"),
    )
    q, dv = F.col("quantity"), F.col("dosage_volume")
    min_dvv = b._map(F.col("product"), b.NSAID_MIN_DVV)
    ns = (
        b.nsaid_sales(t, lo, end_excl).where(~F.col("voided") & (F.col("invoice_date") >= lo)
                               & (F.col("invoice_date") < F.lit(end_excl)) & F.col("product").isin(*b.NSAID_PRODUCTS)
                               & (F.col("cost") != 0))
        .where(((min_dvv != 0) & q.isNotNull() & (q != 0)) | (min_dvv == 0))
        .drop("client_id").join(p, "patient_id").join(st, "h_id")
        .where(F.col("invoice_date") >= F.col("start_month"))
    )
    ns = ev.same_day_flag(ns, b.appointments(t), ["patient_id"], "invoice_date", "appointment_date")
    surg = b.surgeries(t).where(F.col("surgery_family").isin(*b.EXCUSED_SURGERY_FAMILIES) & (F.col("cost") > 0))
    qn = F.when(q.isNull() | (q == 0), F.lit(1)).otherwise(q)
    dvn = F.when(dv.isNull() | (dv == 0), F.lit(1)).otherwise(dv)
    # pills = quantity / dosage volume (a NULL quantity counts as 1 pill);
    # short courses (< 10 pills) within 5 x 24 hours of a surgery are dropped; the file keeps
    # whole pills, 0 shown as 1
    short = F.when(q.isNull(), F.lit(True)).otherwise(_pills_below(ns["quantity"], dvn, 10))
    ns = ev.exclude_near_instant(ns, surg, ["patient_id"], "invoice_ts", "surgery_ts", 5, when=short)
    pills = F.when(q.isNull(), qn.cast("double")).otherwise(ratio_round(q, dvn, 0))
    cost = F.when(F.col("cost").isNull(), F.col("cost")).when(F.col("cost") == 0, F.lit(1)).otherwise(F.col("cost"))
    ns = ns.select(
        line_id("E", "lineitem_id").alias("lineitem_id"), "patient_id", "client_id", "h_id", "invoice_date", "product",
        qn.cast("decimal(18,4)").alias("quantity"), cost.cast("decimal(18,4)").alias("cost"),
        F.when(pills == 0, F.lit(1)).otherwise(pills).cast("decimal(18,4)").alias("pills"),
        "appointment_flag", F.lit("NSAID").alias("type"),
    )
    return fth.unionByName(ns)


# ------------------------------------------------------------------ LD9-LD11
def last_dose_file(t: Tables, ctx: RunContext) -> DataFrame:
    """Header, detail and trailer per clinic; the trailer carries details + 2."""
    pats = last_dose_patients(t, ctx)
    cli = last_dose_clients(t, ctx, pats)
    starts = incremental_start(t, ctx)
    pur = last_dose_purchases(t, ctx, pats, starts)
    dob = b.patients(t).select("patient_id", "dob", "vi_species_id")
    typ = F.col("type")
    cat = (F.when(typ.isin("fh", "fth"), F.lit("COMBO")).when(typ.isin("f", "ft"), F.lit("FLEATICK"))
           .when(typ == "h", F.lit("HEARTWORM")).otherwise(typ))
    age = F.floor(F.months_between(F.lit(ctx.end_date), F.col("dob"), False) / 12)
    dog = F.col("vi_species_id") == DOG
    x = cli.join(pur.drop("h_id"), "client_id").join(pats.select("patient_id", "weight"), "patient_id").join(dob, "patient_id")
    detail = x.select(
        F.lit("2DT").alias("record_type"),
        "lineitem_id",
        F.col("client_id").cast("string").alias("client_id"),
        F.substring("first_name", 1, 30).alias("first_name"), F.substring("last_name", 1, 30).alias("last_name"),
        F.substring("address1", 1, 40).alias("address1"), F.substring("address2", 1, 40).alias("address2"),
        F.substring("city", 1, 30).alias("city"), F.substring("state", 1, 2).alias("state"),
        F.trim("postal_code").alias("postal_code"), cl.valid_email(F.col("primary_email")).alias("primary_email"),
        F.col("canines").cast("long").alias("canines"), F.col("felines").cast("long").alias("felines"),
        mdy("invoice_date").alias("invoice_date"), cat.alias("product_category"), F.col("product").alias("family_name"),
        F.round(F.when(typ != "NSAID", F.col("quantity")).otherwise(F.col("pills")), 1).cast("double").alias("quantity_norm"),
        money_text(F.coalesce(F.col("cost"), F.lit(0))).alias("cost_norm"),
        F.col("appointment_flag").alias("appointment"), "h_id",
        F.when(dog & (F.col("product") == "Previcox"), F.col("pills")).cast("double").alias("pills"),
        F.when(dog, F.least(F.greatest(age, F.lit(0)), F.lit(99))).cast("long").alias("age_years"),
        F.when(dog, F.round("weight", 0)).cast("double").alias("weight"),
        F.col("dogs_over_4").cast("long").alias("dogs_over_4"),
    ).distinct()
    clin = maybe_broadcast(b.clinics(t))
    heads = clin.select(
        F.lit("1HD").alias("record_type"), F.lit(ctx.as_of.strftime("%m/%d/%Y")).alias("lineitem_id"),
        F.col("account_number").alias("client_id"), F.col("location_number").cast("string").alias("first_name"),
        F.substring("clinic_name", 1, 40).alias("last_name"), F.lit(str(current_flag(ctx) + 1)).alias("address1"),
        F.lit(str(ctx.end_date.year)).alias("address2"), F.lit(FILE_TYPE).alias("city"), "h_id")
    return ev.with_header_trailer(detail, heads, "h_id", trailer_offset=2)


# ------------------------------------------------------------------ NI1
def newly_inactive(t: Tables, ctx: RunContext) -> DataFrame:
    """Clients that the latest run of any earlier update flag delivered with
    dogs, and who are not among the current run's clients with dogs (NC1)."""
    flag = current_flag(ctx)
    earlier = run_summary(t, ctx).where(F.col("update_flag") < flag)
    # J12: the latest run of every earlier flag (window max, no self join)
    latest = F.max("run_id").over(Window.partitionBy("h_id", "update_flag"))
    before = (earlier.withColumn("_latest", latest).where((F.col("run_id") == F.col("_latest")) & F.col("dogs"))
              .select("h_id", "client_id").distinct())
    now = last_dose_clients(t, ctx).where(F.col("canines") != 0).select("client_id")
    lapsed = before.join(now, "client_id", "left_anti")
    clin = maybe_broadcast(b.clinics(t).select("h_id", "location_number"))
    return lapsed.join(clin, "h_id").select("h_id", "location_number", "client_id",
                                            F.lit(ctx.end_date.year).alias("report_year"), F.lit(flag).alias("update_flag"))


# ------------------------------------------------------------- NI2-NI4
LIST_SCHEMA = ("record_type string, report_year long, update_flag long, h_id long, client_id long, "
               "location_number long, value string, last_update date")
LIST_KEY = ["record_type", "report_year", "update_flag", "h_id", "client_id"]


def list_changes(kept: DataFrame, nic: DataFrame, ctx: RunContext) -> DataFrame:
    """Rows that a run puts into the lapsed list ``kept``: the lapsed clients
    that it has not yet for this year and flag, the one header of the year and
    flag with this run's date, and their one trailer: rows of the list + 2
    (none while the list has no row)."""
    year, flag = ctx.end_date.year, current_flag(ctx)
    mine = kept.where((F.col("record_type") == "2DT") & (F.col("report_year") == year) & (F.col("update_flag") == flag))

    def rows(df: DataFrame, kind: str, **values) -> DataFrame:
        cols = {"record_type": F.lit(kind), "report_year": F.lit(year), "update_flag": F.lit(flag), "last_update": F.lit(ctx.as_of), **values}
        schema = df.sparkSession.createDataFrame([], LIST_SCHEMA).schema
        return df.select(*(cols.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema))

    new = rows(nic.join(mine.select("h_id", "client_id"), ["h_id", "client_id"], "left_anti"), "2DT",
               h_id=F.col("h_id"), client_id=F.col("client_id"), location_number=F.col("location_number"))
    header = rows(nic.sparkSession.range(1), "1HD", value=F.lit(ctx.as_of.strftime("%m/%d/%Y")))
    n = mine.select("client_id").unionByName(new.select("client_id")).agg(F.count(F.lit(1)).alias("n")).where("n > 0")
    trailer = rows(n, "3TR", value=F.col("n") + 2)
    return new.unionByName(header).unionByName(trailer)


def list_file(rows: DataFrame) -> DataFrame:
    """The lapsed list as its file: header (creation date, flag), a row a
    client, trailer (record count)."""
    kind, text = F.col("record_type"), lambda c: F.col(c).cast("string")
    return rows.select(
        "record_type",
        F.when(kind == "2DT", text("location_number")).otherwise(F.col("value")).alias("creation_date"),
        F.when(kind == "1HD", text("update_flag")).when(kind == "2DT", text("client_id")).alias("client_id"),
        F.when(kind == "1HD", F.col("report_year")).alias("cc_year"), "report_year", "update_flag")


def _year_before(ctx: RunContext) -> RunContext:
    return ctx.with_(end_date=ctx.end_date.replace(year=ctx.end_date.year - 1), as_of=add_months(ctx.as_of, -12),
                     update_flag=current_flag(ctx) - 1)


def newly_inactive_file(t: Tables, ctx: RunContext) -> DataFrame:
    """The file of the lapsed list after the runs of the year before and of
    ``ctx``: one header and one trailer for each year and update flag."""
    kept = t.spark.createDataFrame([], LIST_SCHEMA)
    for run in (_year_before(ctx), ctx):
        if current_flag(run) > 1:  # the list follows later deliveries only
            kept = replace_rows(kept, list_changes(kept, newly_inactive(t, run), run), LIST_KEY)
    return list_file(kept)


class LapsedList:
    """The stored lapsed list: one table for all clinics, years and flags. A
    run adds its lapsed clients and updates its header and trailer in place;
    the files of other hash buckets stay."""

    def __init__(self, spark, path: str, buckets: int = 64):
        self.table = VersionedTable(spark, path, LIST_SCHEMA, LIST_KEY, buckets)

    def run(self, t: Tables, ctx: RunContext) -> list[int]:
        return self.table.merge(list_changes(self.table.read(), newly_inactive(t, ctx), ctx))

    def file(self) -> DataFrame:
        return list_file(self.table.read())


def last_dose_clients_split(t: Tables, ctx: RunContext) -> DataFrame:
    """LD3: the split-location variant of the last-dose client list."""
    return last_dose_clients(t, ctx, split=b.split_clients(t))


# ------------------------------------------------------------------ DM1
def newly_inactive_merged(t: Tables, ctx: RunContext) -> DataFrame:
    """NI1 as the reference stores it: the current lapsed clients merged
    insert-only into the list kept from the previous year's run. A client is
    in the list once for each year and update flag, so a client who lapses
    again has another row, and rows that are there stay as they are."""
    from ..operators.upsert import upsert

    prev_ctx = _year_before(ctx)
    prev = newly_inactive(t, prev_ctx).withColumn("last_update", F.lit(prev_ctx.as_of))
    key = ["h_id", "client_id", "update_flag", "report_year"]
    out = upsert(prev, newly_inactive(t, ctx), key, ["location_number"], ctx.as_of, mode="insert_only")
    return out.select("h_id", "client_id", F.col("location_number").cast("long").alias("location_number"),
                      F.col("report_year").cast("long").alias("report_year"), F.col("update_flag").cast("long").alias("update_flag"),
                      "last_update", "action")
