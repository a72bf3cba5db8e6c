"""Legacy call list (UPL) and dental purchases with matrix doses.

Bindings for the dental matrix: dental services are the 'Surgery - dental'
parts; their package quantity / size / volume follow from ``p_size``; the
matrix itself is a small control table generated by a rule (volumes 1-7
oz in two treat sizes, with one ambiguous key and some unit-less volumes).
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..context import RunContext, add_months, month_start
from ..functions.semantics import mdy
from ..operators import contact as cl
from ..operators import trailing as tm
from ..operators.matrix import dental_doses
from ..operators.sizing import maybe_broadcast
from ..sources import binding as b
from ..sources.tables import Tables

DENTAL = "Surgery - dental"
# Product families whose sales before their launch month are
# not counted as purchases (default of the call list's parameter).
LAUNCH_DATES = {"Certifect": date(2011, 7, 1)}


def dental_matrix_rows() -> list[tuple]:
    rows = []
    for v in range(1, 8):
        vol = str(v) if v % 3 == 0 else f"{v} oz"
        rows.append((DENTAL, "small", vol, 2 * v))
        rows.append((DENTAL, "large", vol, 2 * v + 1))
    rows.append((DENTAL, "small", "5 oz", 99))  # ambiguous key (5, small)
    return rows


def dental_matrix(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(dental_matrix_rows(), "product string, treat_size string, package_volume string, package_count long")


def package_fields(t: Tables) -> DataFrame:
    """Package quantity / size / volume of every service part (by rule)."""
    s = F.col("package_size")
    return b.products(t).where(F.col("product_info").isNotNull()).select(
        "service_id", "product_info",
        F.when(s % 4 == 0, s.cast("string")).when(s % 4 == 1, F.concat(s.cast("string"), F.lit(" ct"))).alias("package_quantity"),
        F.when(s % 3 == 0, F.lit("small")).when(s % 3 == 1, F.lit("large")).alias("package_size"),
        F.when(s % 5 < 3, F.concat(((s % 7) + 1).cast("string"), F.when(s % 2 == 0, F.lit(" oz")).otherwise(F.lit(""))))
        .alias("package_volume"),
    )


def dental_services(t: Tables) -> DataFrame:
    return package_fields(t).where(F.col("product_info") == DENTAL)


def dental_purchases(t: Tables, ctx: RunContext) -> DataFrame:
    """Dental lines of the last 12 calendar months with doses from the
    package matrix (MX1), summed per client."""
    lo, hi = ctx.months_window(-11, 0)
    svc = maybe_broadcast(dental_services(t))
    x = (b.lines(t, lo, hi).where(~F.col("voided"))
         .select("client_id", "service_id", F.col("quantity").cast("long").alias("quantity"), "cost")
         .join(svc, "service_id"))
    x = dental_doses(x, dental_matrix(t.spark))
    return x.groupBy("client_id").agg(
        F.count(F.lit(1)).alias("dental_lines"),
        F.sum("doses").cast("double").alias("dental_doses"),
        F.sum("cost").cast("double").alias("dental_spend"),
    )


def call_list(t: Tables, ctx: RunContext, launch_dates: dict[str, date] | None = None) -> DataFrame:
    """UPL: clients with a dog or cat short of 6 flea/tick or 12 heartworm
    doses in the last 12 months, with their last purchase per species and
    market, a 10-digit phone and a valid email. Lines of a family in
    ``launch_dates`` count from its launch month on."""
    end = ctx.end_date
    launch_dates = LAUNCH_DATES if launch_dates is None else launch_dates
    pats = b.patients(t).where(F.col("is_active") & F.col("vi_species_id").isin(3, 7) & (F.col("patient_id") > 0)).select(
        "patient_id", "client_id", "h_id", "vi_species_id")
    s, pid = F.col("vi_species_id"), F.col("patient_id")
    hh = pats.groupBy("client_id").agg(F.countDistinct(F.when(s == 3, pid)).alias("canines"),
                                       F.countDistinct(F.when(s == 7, pid)).alias("felines"))
    cli = b.clients(t).join(hh, "client_id").select(
        "client_id", "h_id",
        F.coalesce(cl._strip(F.col("first_name"), cl.NAME_JUNK), F.lit(cl.NONE_GIVEN)).alias("first_name"),
        F.coalesce(cl._strip(F.col("last_name"), cl.NAME_JUNK), F.lit(cl.NONE_GIVEN)).alias("last_name"),
        "canines", "felines",
        F.when(F.col("primary_email") == "0", F.lit(None)).otherwise(F.col("primary_email")).alias("primary_email"),
        F.substring(F.when(F.col("phone1").rlike("[^0-9]"), cl.blank_to_null(F.regexp_replace("phone1", "[^0-9]", "")))
                    .otherwise(F.col("phone1")), 1, 10).alias("phone"),
    )
    lo, hi = ctx.months_window(-11, 0)
    prod = maybe_broadcast(b.products(t).where(F.col("type").isNotNull()).select("service_id", "type", "family_name"))
    fth = (b.lines(t, lo, hi, pats.select("patient_id", "vi_species_id")).where(~F.col("voided") & (F.col("cost") != 0))
           .select("patient_id", "client_id", "vi_species_id", "invoice_date", "service_id", "quantity_norm")
           .join(prod, "service_id"))
    for family, launch in launch_dates.items():
        fth = fth.where((F.col("family_name") != family) | (F.col("invoice_date") >= F.lit(month_start(launch))))
    typ, q = F.col("type"), F.col("quantity_norm")
    per_pat = pats.select("patient_id", "client_id").join(
        fth.groupBy("patient_id").agg(
            F.sum(F.when(typ.isin("f", "ft", "fth", "fh"), q).otherwise(0)).alias("ft_doses"),
            F.sum(F.when(typ.isin("h", "fth", "fh"), q).otherwise(0)).alias("hw_doses")), "patient_id", "left")
    ft, hw = F.coalesce(F.col("ft_doses"), F.lit(0)), F.coalesce(F.col("hw_doses"), F.lit(0))
    good = per_pat.where((ft < 6) | (hw < 12)).select("client_id").distinct()
    d = F.col("invoice_date")
    last = fth.where(q != 0).groupBy("client_id").agg(
        F.max(F.when((s == 3) & typ.isin("f", "ft", "fth", "fh"), d)).alias("ft_canine"),
        F.max(F.when((s == 7) & typ.isin("f", "ft", "fth", "fh"), d)).alias("ft_feline"),
        F.max(F.when((s == 3) & typ.isin("h", "fth", "fh"), d)).alias("hw_canine"),
        F.max(F.when((s == 7) & typ.isin("h", "fth", "fh"), d)).alias("hw_feline"))
    phone = F.regexp_replace(F.col("phone"), r"[() \-]", "")
    clin = maybe_broadcast(b.clinics(t).select("h_id", "account_number", "location_number", "clinic_name"))
    period = (add_months(end, -11).strftime("%d-%b-%y") + " - "
              + (add_months(end, 1) - timedelta(days=1)).strftime("%d-%b-%y"))
    return (cli.join(good, "client_id", "left_semi").join(last, "client_id", "left").join(clin, "h_id")
            .select(F.substring("last_name", 1, 30).alias("last_name"), F.substring("first_name", 1, 30).alias("first_name"),
                    F.when(F.length(phone) == 10, phone).alias("phone"),
                    cl.valid_email(F.col("primary_email")).alias("primary_email"),
                    F.col("canines").alias("canine_count"), mdy("ft_canine").alias("last_purch_ft_canine"),
                    mdy("hw_canine").alias("last_purch_hw_canine"), F.col("felines").alias("feline_count"),
                    mdy("ft_feline").alias("last_purch_ft_feline"), mdy("hw_feline").alias("last_purch_hw_feline"),
                    "client_id", "h_id", "account_number", "location_number", F.lit(period).alias("time_period"),
                    "clinic_name"))
