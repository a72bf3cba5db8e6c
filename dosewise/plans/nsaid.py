"""NSAID purchases: the consumer NSAID stage (same-day appointment flag,
short courses near a surgery dropped) and the NSAID purchase file
(patients with latest weight, cleansed clients, detail rows, header and
trailer per clinic)."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..context import RunContext, add_months
from ..functions.semantics import age_years, id_remap, mdy, money_text, ratio_round, scaled_round
from ..operators import contact as cl
from ..operators import events as ev
from ..operators import trailing as tm
from ..operators.sizing import maybe_broadcast
from ..sources import binding as b
from ..sources.tables import Tables
from .consumer import consumer_patients

DOG = 3
SURGERY_DAYS = 5
SHORT_COURSE_PILLS = 10


def _pills_below(q, dv, n: int):
    """pills = quantity / dosage volume < n, without division."""
    return F.when(dv > 0, q < dv * n).otherwise(q > dv * n)


# ------------------------------------------------------------------ CO28
def consumer_nsaid(t: Tables, ctx: RunContext, product: str = "Previcox", cp: DataFrame | None = None) -> DataFrame:
    """NSAID purchases of consumer patients in the last 12 months with a
    same-day appointment flag; purchases of fewer than 10 pills within
    +-5 days of a surgery are dropped."""
    end = ctx.end_date
    cp = (cp if cp is not None else consumer_patients(t, ctx)).select("patient_id", "client_id", "h_id", "vi_species_id")
    q, dv = F.col("quantity"), F.col("dosage_volume")
    s = (
        b.nsaid_sales(t, add_months(end, -12), end + timedelta(days=1))
        .where((F.col("product") == product) & ~F.col("voided")
               & F.col("invoice_date").between(F.lit(add_months(end, -12)), F.lit(end))
               & dv.isNotNull() & (dv != 0) & (q != 0))
        .drop("client_id")
        .join(cp, "patient_id")
    )
    s = ev.same_day_flag(s, b.appointments(t), ["patient_id"], "invoice_date", "appointment_date")
    surg = b.surgeries(t).where(F.col("surgery_family").isin(*b.EXCUSED_SURGERY_FAMILIES) & (F.col("cost") > 0))
    s = ev.exclude_near(s, surg, ["patient_id"], "invoice_date", "surgery_date", SURGERY_DAYS,
                        when=_pills_below(s["quantity"], s["dosage_volume"], SHORT_COURSE_PILLS))
    return s.select(
        "lineitem_id", "patient_id", "client_id", "h_id", "vi_species_id", "invoice_date", "product",
        F.col("quantity").cast("long").alias("quantity"), F.col("dosage_volume").cast("long").alias("dosage_volume"),
        F.col("cost").cast("double").alias("cost"),
        ratio_round(q, dv, 4).alias("pills"),
        "appointment_flag",
    )


# ------------------------------------------------------------------ CO29
def consumer_nsaid_metrics(t: Tables, ctx: RunContext, cp: DataFrame | None = None) -> DataFrame:
    """Per client: NSAID purchases, revenue, doses and pills in the last 12
    months and the 12 before, patients treated, pet species at the last
    purchase (TM1)."""
    x = consumer_nsaid(t, ctx, cp=cp)
    w12, w24 = ctx.trailing(0), ctx.trailing(1)
    d = F.col("invoice_date")
    # the exact ratios are summed (nine digits hold them) and rounded once, at the end
    pills = F.coalesce(scaled_round(F.col("quantity"), F.col("dosage_volume"), 9), F.lit(10**9))
    extra = [
        F.countDistinct(F.when(tm.in_window(d, w12), F.col("patient_id"))).alias("prev_pats_12"),
        (scaled_round(F.sum(F.when(tm.in_window(d, w12), pills)), F.lit(10**9), 2) / 100.0).alias("prev_pills_12"),
        (scaled_round(F.sum(F.when(tm.in_window(d, w24), pills)), F.lit(10**9), 2) / 100.0).alias("prev_pills_24"),
    ]
    out = tm.tagged_metrics(
        x, ["client_id"], {"prev": F.lit(True)}, {"12": w12, "24": w24},
        revenue=F.col("cost"), doses=F.coalesce(F.col("quantity"), F.lit(1)),
        last_value=F.col("vi_species_id"), order_key=[F.col("lineitem_id")], extra=extra,
    )
    return out.withColumn("prev_rev_12", F.col("prev_rev_12").cast("double")).withColumn(
        "prev_rev_24", F.col("prev_rev_24").cast("double"))


# --------------------------------------------------------------- NS1 / LD1
def patients_with_weight(t: Tables, ctx: RunContext, dogs_only: bool = True, max_weight=None,
                         months_active: int = 23, code_filter: bool = False, age_digits: int = 3) -> DataFrame:
    """Active living patients seen within ``months_active`` months with the
    converted weight of their latest vitals row (WU1 + LB1)."""
    end = ctx.end_date
    species = [DOG] if dogs_only else [3, 7]
    p = b.patients(t, species=tuple(species)).join(b.patient_activity(t), "patient_id")
    p = p.where(
        (F.col("last_active") > F.lit(add_months(end, -months_active)))
        & F.col("is_active") & ~F.col("is_deceased")
        & F.col("vi_species_id").isin(*species) & (F.col("patient_id") > 0)
    )
    if code_filter:
        # unmapped patient codes count as allowed (coalesce to 2)
        p = p.where(F.coalesce(F.col("pms_code"), F.lit(2)).isin(2, 3, 4))
    w = ev.latest_weight(b.vitals(t))
    if max_weight is not None:
        w = w.where(F.col("weight") < max_weight)
    months = F.months_between(F.lit(end), F.col("dob"), False)
    dog = F.col("vi_species_id") == DOG
    return p.join(w, "patient_id", "left").select(
        "patient_id", "client_id", "h_id", "vi_species_id", "first_active", "last_active", "pms_code",
        F.col("weight").cast("double").alias("weight"),
        age_years(F.lit(end), F.col("dob"), age_digits).alias("age_years"),
        F.when((months > 60) & dog, 1).otherwise(0).alias("dogs_over_5"),
        F.when((months > 72) & dog, 1).otherwise(0).alias("dogs_over_6"),
        F.when((months < 12) & dog, 1).otherwise(0).alias("puppy"),
        F.when((months > 48) & dog, 1).otherwise(0).alias("dogs_over_4"),
    )


# ------------------------------------------------------------- NS2 / NS3
def nsaid_clients(t: Tables, ctx: RunContext, pats: DataFrame | None = None) -> DataFrame:
    pats = pats if pats is not None else patients_with_weight(t, ctx)
    hh = tm.household(pats, ["client_id"], [
        F.max("dogs_over_5").alias("dogs_over_5"),
        F.countDistinct(F.when(F.col("vi_species_id") == DOG, F.col("patient_id"))).alias("canines"),
        F.min("first_active").alias("first_visit"),
    ])
    first = F.coalesce(cl._strip(cl._strip(F.col("first_name"), cl.NAME_JUNK), cl.CONTROL), F.lit(cl.NONE_GIVEN))
    last = F.coalesce(cl._strip(cl._strip(F.col("last_name"), cl.NAME_JUNK), cl.CONTROL), F.lit(cl.NONE_GIVEN))
    c = b.clients(t).join(hh, "client_id").select(
        "client_id", "h_id", first.alias("first_name"), last.alias("last_name"),
        cl.clean_control(F.col("title")).alias("prefix"),
        cl.clean_address(F.col("address1"), cl.NONE_GIVEN).alias("address1"),
        cl.clean_address(F.col("address2")).alias("address2"),
        cl.clean_control(F.col("city")).alias("city"),
        cl.clean_control(F.col("state")).alias("state"),
        cl.clean_zip(F.col("postal_code")).alias("postal_code"),
        cl.clean_phone(F.col("phone1")).alias("phone1"),
        "primary_email", "dogs_over_5", "canines", "first_visit",
    )
    fn, ln, a1, a2 = (F.col(x) for x in ("first_name", "last_name", "address1", "address2"))
    zipc = F.col("postal_code")
    drop = (
        (fn == cl.NONE_GIVEN) | (ln == cl.NONE_GIVEN) | (a1 == " ") | (a1 == cl.NONE_GIVEN)
        | a1.contains("*") | a2.contains("*")
        | F.col("state").isNull() | F.col("city").isNull()
        | cl.excluded_region(F.col("state"))
        | zipc.isNull() | zipc.contains("0000") | zipc.isin("000000", "0", "00", "000")
        | F.upper(fn).isin("OTC", "OVER THE COUNTER", "NEW", "NEW CLIENT", "TEST")
        | F.upper(ln).isin("OTC", "OVER THE COUNTER", "CLIENT", "NEW CLIENT", "TEST CLIENT")
        | F.upper(a1).isin("OTC", "OVER THE COUNTER") | F.upper(a2).isin("OTC", "OVER THE COUNTER")
        | ((F.upper(fn) == "CASH") & F.upper(ln).isin("CLIENT", "CASH"))
    )
    return c.where(~F.coalesce(drop, F.lit(False)))


# ------------------------------------------------------------- NS4 - NS6
def nsaid_purchase_file(t: Tables, ctx: RunContext) -> DataFrame:
    """Header '1HD', detail '2DT' and trailer '3TR' rows per clinic. The
    trailer counts the rows written before it (header + details) + 1."""
    end = ctx.end_date
    start = add_months(end, -11)  # the run's start date for NSAID files
    pats = patients_with_weight(t, ctx)
    cli = nsaid_clients(t, ctx, pats)
    q, dv = F.col("quantity"), F.col("dosage_volume")
    s = b.nsaid_sales(t, start, add_months(end, 1)).where(
        (F.col("invoice_date") >= F.lit(start)) & (F.col("invoice_date") < F.lit(add_months(end, 1)))
        & ~F.col("voided") & (F.col("cost") != 0) & F.col("product").isin(*b.NSAID_PRODUCTS)
    ).drop("client_id").join(pats.select("patient_id", "client_id", F.round("weight", 0).alias("pat_weight")), "patient_id")
    product = F.when(F.col("product").startswith("Rimadyl"), F.lit("Rimadyl")).otherwise(F.col("product"))
    detail = s.join(cli, "client_id").select(
        F.lit("2DT").alias("record_type"),
        id_remap(F.col("lineitem_id")).cast("string").alias("lineitem_id"),
        F.col("client_id").cast("string").alias("client_id"),
        F.substring("first_name", 1, 30).alias("first_name"),
        F.substring("last_name", 1, 30).alias("last_name"),
        F.substring("address1", 1, 40).alias("address1"),
        F.substring("address2", 1, 40).alias("address2"),
        F.substring("city", 1, 30).alias("city"),
        F.substring("state", 1, 2).alias("state"),
        F.trim(F.col("postal_code")).alias("postal_code"),
        cl.valid_email(F.col("primary_email")).alias("primary_email"),
        F.col("canines").cast("long").alias("canines"),
        mdy("invoice_date").alias("purchase_date"),
        product.alias("product"),
        ratio_round(q, dv, 4).alias("pills"),
        money_text(F.coalesce(F.col("cost"), F.lit(0))).alias("purchase_price"),
        F.coalesce(F.col("pat_weight"), F.lit(0)).cast("double").alias("weight"),
        "h_id",
    )
    clin = maybe_broadcast(b.clinics(t))
    heads = clin.select(
        F.lit("1HD").alias("record_type"),
        F.lit(ctx.as_of.strftime("%m/%d/%Y")).alias("lineitem_id"),
        F.col("account_number").alias("client_id"),
        F.col("location_number").cast("string").alias("first_name"),
        F.substring("clinic_name", 1, 40).alias("last_name"),
        "h_id",
    )
    return ev.with_header_trailer(detail, heads, "h_id", trailer_offset=2)


# ------------------------------------------------------------------ LD1
def last_dose_patients(t: Tables, ctx: RunContext) -> DataFrame:
    """Dogs and cats active in the last 24 months with an allowed patient
    code and their latest weight in pounds when below 500."""
    return patients_with_weight(t, ctx, dogs_only=False, max_weight=500, months_active=24, code_filter=True,
                                age_digits=6)
