"""PSR - practice status report over the 12 calendar months ending in the
run's end month, for all clinics at once.

Shape of the plan: one pass over the window's invoice lines builds the
patient master (PS1); every T-table is an aggregate of that master in
"patient x market" long form, left-joined onto the clinic x market x species
grid. The master is the one DataFrame worth persisting when several
T-tables are produced together (see ``plans.runs.psr_tables``, which
checkpoints it once into the shared checkpoint folder).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..context import RunContext
from ..functions.semantics import ceil_long, dec, ratio_round, scaled_round, species_name
from ..operators import compliance as cp
from ..operators import histogram as hb
from ..operators import shares as sh
from ..operators.grid import MARKETS, dense_fill, report_grid, spine
from ..operators.sizing import maybe_broadcast
from ..sources import binding as b
from ..sources.tables import Tables
from . import rollup as ru

DOG, CAT = 3, 7


# ------------------------------------------------------------------ PS0
def wellness_services(t: Tables) -> DataFrame:
    """Services that make a visit a wellness visit: vaccines, spay/neuter
    surgery, heartworm tests."""
    return b.products(t).where(ru.is_wellness(F.col("service_kind"), F.col("product_info"))).select("service_id", F.lit(1).alias("is_wellness"))


def _window_lines(t: Tables, ctx: RunContext, first: int = -11, last: int = 0,
                  patients: DataFrame | None = None) -> DataFrame:
    lo, hi = ctx.months_window(first, last)
    return b.lines(t, lo, hi, patients).where(~F.col("voided"))


def _product_attrs(t: Tables) -> DataFrame:
    """Product columns the patient master needs, with the wellness flag
    computed in the same projection (one scan of the product dimension)."""
    p = b.products(t)
    well = ru.is_wellness(F.col("service_kind"), F.col("product_info"))
    return maybe_broadcast(p.select(
        "service_id", "type", "family_name", "service_kind", "product_info",
        F.when(well, F.lit(1)).alias("is_wellness"),
    ))


# ------------------------------------------------------------------ PS1
def patient_master(t: Tables, ctx: RunContext, first: int = -11, last: int = 0) -> DataFrame:
    """One row per (clinic, patient) of species dog/cat with any unvoided
    line in the window: doses, revenue, opportunity per market, visits,
    wellness, baby flag, tests."""
    pats = b.patients(t, species=(DOG, CAT)).where(F.col("vi_species_id").isin(DOG, CAT)).select(
        "patient_id", "h_id", "vi_species_id", "dob"
    )
    x = (
        _window_lines(t, ctx, first, last, pats)
        .select("patient_id", "h_id", "vi_species_id", "dob", "invoice_date", "service_id", "quantity_norm", "cost")
        .join(_product_attrs(t), "service_id", "left")
    )
    typ = F.col("type")
    fth = (
        typ.isNotNull()
        & (F.col("cost") != 0)
        & F.col("quantity_norm").isNotNull()
        & (F.col("quantity_norm") != 0)
    )
    ftype = F.when(fth, typ)
    qty = F.col("quantity_norm").cast("long")
    cost = F.col("cost")
    # level 1: patient-day (partial aggregation happens before the shuffle)
    day = x.groupBy("h_id", "patient_id", "vi_species_id", "invoice_date").agg(
        F.sum(cp.ft_doses(ftype, qty)).alias("ft_doses"),
        F.sum(cp.hw_doses(ftype, qty)).alias("hw_doses"),
        F.sum(cp.ft_revenue(ftype, cost)).alias("ft_rev"),
        F.sum(cp.hw_revenue(ftype, cost)).alias("hw_rev"),
        F.max(F.when(ftype.isin(*cp.FT_TYPES), 1).otherwise(0)).alias("ft_day"),
        F.max(F.when(ftype.isin(*cp.HW_TYPES), 1).otherwise(0)).alias("hw_day"),
        F.sum(cost).alias("total_rev"),
        F.count(F.col("is_wellness")).alias("wellness_lines"),
        F.count(F.when(F.col("service_kind") == "test", 1)).alias("hw_tests"),
        F.min(F.datediff(F.col("invoice_date"), F.col("dob"))).alias("min_age_days"),
    )
    # level 2: patient
    pat = day.groupBy("h_id", "patient_id", "vi_species_id").agg(
        F.sum("ft_doses").alias("ft_doses"),
        F.sum("hw_doses").alias("hw_doses"),
        F.sum("ft_rev").alias("ft_rev"),
        F.sum("hw_rev").alias("hw_rev"),
        F.sum("ft_day").alias("ft_visits"),
        F.sum("hw_day").alias("hw_visits"),
        F.sum("total_rev").alias("total_rev"),
        F.count(F.lit(1)).alias("visits"),
        F.sum("wellness_lines").alias("wellness_lines"),
        F.sum("hw_tests").alias("hw_tests"),
        F.min("min_age_days").alias("min_age_days"),
    )
    clin = maybe_broadcast(b.clinics(t).select(
        "h_id", "location_number", "dose_rec_ft_dog", "dose_rec_hw_dog", "dose_rec_ft_cat", "dose_rec_hw_cat"
    ))
    s = F.col("vi_species_id")
    rec_ft = cp.rec_for(s, F.col("dose_rec_ft_dog"), F.col("dose_rec_ft_cat"))
    rec_hw = cp.rec_for(s, F.col("dose_rec_hw_dog"), F.col("dose_rec_hw_cat"))
    ftd, htd, ftr, htr = (F.col(c) for c in ("ft_doses", "hw_doses", "ft_rev", "hw_rev"))
    return pat.join(clin, "h_id", "left").select(
        "h_id",
        "location_number",
        "patient_id",
        "vi_species_id",
        cp.null_unless_bought(ftd, ftd, ftr).alias("ft_doses"),
        cp.null_unless_bought(htd, htd, htr).alias("hw_doses"),
        cp.null_unless_bought(ftr, ftd, ftr).alias("ft_rev"),
        cp.null_unless_bought(htr, htd, htr).alias("hw_rev"),
        cp.opportunity(ftd, ftr, rec_ft).alias("ft_opp_doses"),
        cp.opportunity(htd, htr, rec_hw).alias("hw_opp_doses"),
        F.greatest(F.col("total_rev"), F.lit(0).cast("decimal(38,4)")).alias("total_rev"),
        "visits",
        F.when(F.col("wellness_lines") > 0, F.lit(1)).alias("wellness_care"),
        F.when(F.col("min_age_days") < 365, F.lit(1)).alias("baby"),
        F.when(cp.not_bought(ftd, ftr), F.lit(0)).otherwise(F.col("ft_visits")).cast("long").alias("ft_visits"),
        F.when(cp.not_bought(htd, htr), F.lit(0)).otherwise(F.col("hw_visits")).cast("long").alias("hw_visits"),
        "hw_tests",
        rec_ft.alias("rec_ft"),
        rec_hw.alias("rec_hw"),
    )


def by_market(pm: DataFrame) -> DataFrame:
    """Patient master in long form: one row per patient and market."""
    cells = F.array(
        F.struct(F.lit("Flea/Tick").alias("report_name"), F.col("ft_doses").alias("doses"),
                 F.col("ft_rev").cast("decimal(38,6)").alias("rev"), F.col("ft_opp_doses").alias("opp"),
                 F.col("rec_ft").alias("rec"), F.col("ft_visits").alias("mkt_visits")),
        F.struct(F.lit("Heartworm").alias("report_name"), F.col("hw_doses").alias("doses"),
                 F.col("hw_rev").cast("decimal(38,6)").alias("rev"), F.col("hw_opp_doses").alias("opp"),
                 F.col("rec_hw").alias("rec"), F.col("hw_visits").alias("mkt_visits")),
    )
    return pm.select(
        "h_id", "location_number", "patient_id", "vi_species_id",
        species_name(F.col("vi_species_id")).alias("species"),
        "total_rev", "visits", "wellness_care", "baby", "hw_tests",
        F.explode(cells).alias("m"),
    ).select("*", "m.*").drop("m")


def _grid(t: Tables) -> DataFrame:
    return report_grid(maybe_broadcast(b.clinics(t)))


CELL = ["h_id", "location_number", "report_name", "species"]


# ------------------------------------------------------------------ T14
def t14_missed_revenue(t: Tables, ctx: RunContext, pm: DataFrame | None = None) -> DataFrame:
    """Wellness patients: non-compliant count, missed doses, revenue per
    dose, potential revenue of the missed doses, total revenue."""
    pm = pm if pm is not None else patient_master(t, ctx)
    m = by_market(pm).where(F.col("wellness_care").isNotNull())
    agg = m.groupBy(*CELL).agg(
        F.count(F.when(F.col("opp") > 0, F.col("patient_id"))).alias("non_compliant_pats"),
        F.sum("opp").alias("missed"),
        F.sum("rev").alias("rev"),
        F.sum("doses").alias("doses"),
    )
    per_dose = ratio_round(F.col("rev"), F.col("doses"), 2, scale=6)
    pot = ratio_round(F.col("rev") * F.col("missed"), F.col("doses"), 0, scale=6)
    out = agg.select(
        *CELL,
        "non_compliant_pats",
        F.coalesce(F.col("missed"), F.lit(0)).cast("long").alias("total_missed_doses"),
        per_dose.alias("avg_rev_dose"),
        pot.alias("pot_rev"),
        F.coalesce(F.round(F.col("rev"), 0), F.lit(0)).cast("double").alias("total_rev"),
    )
    return dense_fill(
        _grid(t).select(*CELL), out, CELL,
        {"non_compliant_pats": 0, "total_missed_doses": 0, "avg_rev_dose": 0.0, "pot_rev": 0.0, "total_rev": 0.0},
    ).withColumn("end_date", F.lit(ctx.end_date))


# ------------------------------------------------------------ shared bits
def _w(c: str) -> F.Column:
    """Column value only for wellness patients."""
    return F.when(F.col("wellness_care").isNotNull(), F.col(c))


def _cnt(cond) -> F.Column:
    return F.count(F.when(cond, F.col("patient_id")))


def _units_pct(num: str, den: str, digits: int = 2) -> F.Column:
    """round(num/den, digits) as integer units, 0 when den = 0."""
    return F.when(F.col(den) == 0, F.lit(0)).otherwise(scaled_round(F.col(num), F.col(den), digits))


def _avg_doses_units() -> F.Column:
    """round(sum(wellness doses) / distinct wellness patients with doses, 1) * 10."""
    n = F.count(F.when(F.col("wellness_care").isNotNull() & F.col("doses").isNotNull(), F.col("patient_id")))
    s = F.sum(_w("doses"))
    return F.when(n == 0, F.lit(0)).otherwise(F.coalesce(scaled_round(s, n, 1), F.lit(0)))


def _market(pm: DataFrame) -> DataFrame:
    return by_market(pm)


def _finish(grid: DataFrame, agg: DataFrame, ctx: RunContext, fills: dict, keys=CELL) -> DataFrame:
    return dense_fill(grid, agg, keys, fills).withColumn("end_date", F.lit(ctx.end_date))


# ------------------------------------------------------------------ T1
def t1_coverage(t: Tables, ctx: RunContext, pm: DataFrame | None = None) -> DataFrame:
    """Coverage of wellness patients: with product, partial, fully protected,
    what-if scenarios (10 %, 25 %, 80 %), shares reconciled to 100 %."""
    pm = pm if pm is not None else patient_master(t, ctx)
    m = _market(pm)
    well = F.col("wellness_care").isNotNull()
    d = F.col("doses")
    agg = m.groupBy(*CELL, "rec").agg(
        F.count("patient_id").alias("num_pats"),
        _cnt(d > 0).alias("pats_prod"),
        F.count("wellness_care").alias("pats_well"),
        _cnt((d > 0) & well).alias("pats_prod_well"),
        _avg_doses_units().alias("avg10"),
        _cnt(well & d.between(F.lit(1), F.col("rec") - 1)).alias("partial_pats"),
        ceil_long(_cnt(well & d.between(1, 5)) * dec("0.25")).alias("twentyfive_part_prod"),
        F.coalesce(ceil_long(F.sum(F.when(well & d.between(1, 5), F.lit(6) - d)) * dec("0.25")), F.lit(0)).alias("twentyfive_part_prod_doses"),
        ceil_long(_cnt(well & d.between(7, 11)) * dec("0.10")).alias("ten_part_prod"),
        F.coalesce(ceil_long(F.sum(F.when(well & d.between(7, 11), F.lit(12) - d)) * dec("0.10")), F.lit(0)).alias("ten_part_prod_doses"),
        _cnt(well & (F.col("opp") == 0)).alias("fully_protected_pats"),
        ceil_long(_cnt(well & (d == 1)) * dec("0.8")).alias("eighty_single_pats"),
    ).drop("rec")
    grid = _grid(t).select(*CELL, "dose_rec")
    g = _finish(grid, agg, ctx, {
        "num_pats": 0, "pats_prod": 0, "pats_well": 0, "pats_prod_well": 0, "avg10": 0, "partial_pats": 0,
        "twentyfive_part_prod": 0, "twentyfive_part_prod_doses": 0, "ten_part_prod": 0,
        "ten_part_prod_doses": 0, "fully_protected_pats": 0, "eighty_single_pats": 0,
    })
    gap = F.col("pats_well") - F.col("pats_prod_well")
    pp = _units_pct("partial_pats", "pats_well")
    fp = _units_pct("fully_protected_pats", "pats_well")
    up = F.lit(100) - (pp + fp)
    p2, f2, u2 = sh.reconcile_three(F.col("pp"), F.col("fp"), F.col("up"))
    return g.select(
        *CELL, "end_date", "num_pats", "pats_prod", "pats_well", "pats_prod_well",
        gap.alias("pats_no_prod_well"),
        F.col("dose_rec").cast("long").alias("dose_rec"),
        (F.col("avg10") / 10.0).alias("avg_doses"),
        F.coalesce(scaled_round(gap, F.lit(10), 0), F.lit(0)).alias("ten_unpro"),
        F.coalesce(scaled_round(gap * F.col("avg10"), F.lit(100), 0), F.lit(0)).alias("ten_unpro_doses"),
        F.coalesce(scaled_round(gap, F.lit(4), 0), F.lit(0)).alias("twentyfive_unpro"),
        F.coalesce(scaled_round(gap * F.col("avg10"), F.lit(40), 0), F.lit(0)).alias("twentyfive_unpro_doses"),
        "partial_pats", "twentyfive_part_prod", "twentyfive_part_prod_doses", "ten_part_prod",
        "ten_part_prod_doses", "fully_protected_pats", "eighty_single_pats",
        (F.col("eighty_single_pats") * 2).alias("eighty_single_pats_doses"),
        (F.col("pats_well") - (F.col("fully_protected_pats") + F.col("partial_pats"))).alias("unprotected_pats"),
        pp.alias("pp"), fp.alias("fp"), up.alias("up"),
    ).select(
        "*",
        (p2 / 100.0).alias("partial_pats_pct"),
        (f2 / 100.0).alias("fully_protected_pats_pct"),
        (u2 / 100.0).alias("unprotected_pats_pct"),
    ).drop("pp", "fp", "up")


# ------------------------------------------------------------------ T2
T2_LABELS = hb.bucket_labels(12, with_zero=True)


def t2_dose_histogram(t: Tables, ctx: RunContext, pm: DataFrame | None = None) -> DataFrame:
    """Wellness patients with product by doses bought (1..11, 12+) and the
    doses they miss to the recommendation. Bucket '0' has no numeric value
    in the report decode, so its missed doses stay NULL."""
    pm = pm if pm is not None else patient_master(t, ctx)
    m = _market(pm).where(F.col("wellness_care").isNotNull())
    agg = m.groupBy(*CELL, hb.capped_bucket(F.col("doses"), 12).alias("doses")).agg(
        F.count(F.when(F.col("doses") > 0, F.col("patient_id"))).alias("patients")
    )
    grid = spine(_grid(t).select(*CELL, "dose_rec"), "doses", T2_LABELS)
    g = _finish(grid, agg, ctx, {"patients": 0}, CELL + ["doses"])
    v = F.when(F.col("doses") != "0", hb.bucket_value(F.col("doses")))
    diff = F.col("dose_rec") - v
    return g.select(
        *CELL, "end_date", F.col("dose_rec").cast("long").alias("dose_rec"), "doses",
        F.col("patients").cast("long").alias("patients"),
        F.when(diff < 0, F.lit(0)).otherwise(diff * F.col("patients")).cast("long").alias("missed_doses"),
    )


# ------------------------------------------------------------------ T3
def t3_baby_coverage(t: Tables, ctx: RunContext, pm: DataFrame | None = None) -> DataFrame:
    """T1 for patients under one year old, with 10/25/50 % what-if on the
    patients that bought 0-5 doses."""
    pm = pm if pm is not None else patient_master(t, ctx)
    m = _market(pm).where(F.col("baby") == 1)
    well = F.col("wellness_care").isNotNull()
    d = F.col("doses")
    d0 = F.coalesce(d, F.lit(0))
    low = well & d0.between(0, 5)
    short = F.sum(F.when(low, F.lit(6) - d0))
    n_low = _cnt(low)
    agg = m.groupBy(*CELL, "rec").agg(
        F.count("patient_id").alias("num_pats"),
        F.count("wellness_care").alias("num_pats_wellness"),
        _cnt((d > 0) & well).alias("pats_prod"),
        _avg_doses_units().alias("avg10"),
        _cnt(well & d.between(F.lit(1), F.col("rec") - 1)).alias("partial_pats"),
        ceil_long(n_low * dec("0.1")).alias("ten_pats"),
        ceil_long(short * dec("0.1")).alias("ten_doses"),
        ceil_long(n_low * dec("0.25")).alias("twentyfive_pats"),
        ceil_long(short * dec("0.25")).alias("twentyfive_doses"),
        ceil_long(n_low * dec("0.5")).alias("fifty_pats"),
        ceil_long(short * dec("0.5")).alias("fifty_doses"),
        _cnt(well & (F.col("opp") == 0)).alias("fully_protected_pats"),
    ).drop("rec")
    grid = _grid(t).select(*CELL, "dose_rec")
    g = _finish(grid, agg, ctx, {
        "num_pats": 0, "num_pats_wellness": 0, "pats_prod": 0, "avg10": 0, "partial_pats": 0,
        "ten_pats": 0, "twentyfive_pats": 0, "fifty_pats": 0, "fully_protected_pats": 0,
    })
    W = "num_pats_wellness"
    pp = _units_pct("partial_pats", W)
    fp = _units_pct("fully_protected_pats", W)
    return g.select(
        *CELL, "end_date", "num_pats", "pats_prod",
        (_units_pct("pats_prod", W) / 100.0).alias("pats_prod_pct"),
        (F.col(W) - F.col("pats_prod")).alias("pats_no_prod"),
        F.when(F.col(W) == 0, F.lit(0.0)).otherwise(
            scaled_round(F.col(W) - F.col("pats_prod"), F.col(W), 2) / 100.0).alias("pats_no_prod_pct"),
        F.col("dose_rec").cast("long").alias("dose_rec"),
        (F.col("avg10") / 10.0).alias("avg_doses"),
        "partial_pats", (pp / 100.0).alias("partial_pats_pct"),
        "ten_pats", "ten_doses", "twentyfive_pats", "twentyfive_doses", "fifty_pats", "fifty_doses",
        "fully_protected_pats", (fp / 100.0).alias("fully_protected_pats_pct"),
        (F.col(W) - (F.col("fully_protected_pats") + F.col("partial_pats"))).alias("unprotected_pats"),
        ((F.lit(100) - (pp + fp)) / 100.0).alias("unprotected_pats_pct"),
        W,
    )


# ------------------------------------------------------------------ T7
def t7_potential_revenue(t: Tables, ctx: RunContext, pm: DataFrame | None = None) -> DataFrame:
    """Revenue that the wellness patients without product would bring at
    the average and at the recommended dose count."""
    pm = pm if pm is not None else patient_master(t, ctx)
    m = _market(pm)
    well = F.col("wellness_care").isNotNull()
    d = F.col("doses")
    agg = m.groupBy(*CELL, "rec").agg(
        F.count("patient_id").alias("num_pats"),
        _cnt(d > 0).alias("pats_prod"),
        _cnt(well).alias("pats_well"),
        _cnt((d > 0) & well).alias("pats_prod_well"),
        _avg_doses_units().alias("avg10"),
        F.sum(F.when(well, F.col("rev")).otherwise(F.lit(0))).alias("w_rev"),
        F.sum(F.when(well, d).otherwise(F.lit(0))).alias("w_doses"),
        F.sum(_w("rev")).alias("w_rev_n"),
        _cnt(well & d.between(F.lit(1), F.col("rec") - 1)).alias("partial_pats"),
        _cnt(well & (F.col("opp") == 0)).alias("protected_pats"),
    ).drop("rec")
    grid = _grid(t).select(*CELL, "dose_rec")
    g = _finish(grid, agg, ctx, {
        "num_pats": 0, "pats_prod": 0, "pats_well": 0, "pats_prod_well": 0, "avg10": 0,
        "w_doses": 0, "partial_pats": 0, "protected_pats": 0,
    })
    W, gap = F.col("pats_well"), F.col("pats_well") - F.col("pats_prod_well")
    price100 = F.when(F.col("w_doses") == 0, F.lit(0)).otherwise(
        F.coalesce(scaled_round(F.col("w_rev"), F.col("w_doses"), 2, scale=6), F.lit(0)))
    pot_doses = scaled_round(gap * F.col("avg10"), F.lit(10), 0)
    rec_doses = gap * F.col("dose_rec")
    pp = _units_pct("partial_pats", "pats_well")
    fp = _units_pct("protected_pats", "pats_well")
    return g.select(
        *CELL, "end_date", "num_pats", "pats_prod", "pats_well", "pats_prod_well",
        (_units_pct("pats_prod_well", "pats_well") / 100.0).alias("pats_prod_well_pct"),
        gap.alias("pats_no_prod_well"),
        F.when(W == 0, F.lit(0.0)).otherwise(scaled_round(gap, W, 2) / 100.0).alias("pats_no_prod_well_pct"),
        F.col("dose_rec").cast("long").alias("dose_rec"),
        (F.col("avg10") / 10.0).alias("avg_doses"),
        (price100 / 100.0).alias("avg_price_dose"),
        F.coalesce(F.round(F.col("w_rev_n"), 0), F.lit(0)).cast("double").alias("total_rev"),
        pot_doses.alias("avg_pot_doses"),
        scaled_round(pot_doses * price100, F.lit(100), 0).alias("avg_pot_rev"),
        rec_doses.cast("long").alias("rec_doses_pot_doses"),
        scaled_round(rec_doses * price100, F.lit(100), 0).alias("rec_doses_pot_rev"),
        "partial_pats", (pp / 100.0).alias("partial_pats_pct"),
        F.col("protected_pats").alias("fully_protected_pats"), (fp / 100.0).alias("fully_protected_pats_pct"),
        (W - (F.col("partial_pats") + F.col("protected_pats"))).alias("unprotected_pats"),
        ((F.lit(100) - (pp + fp)) / 100.0).alias("unprotected_pats_pct"),
    )


# ------------------------------------------------------------------ T8
def t8_kpis(t: Tables, ctx: RunContext, pm: DataFrame | None = None) -> DataFrame:
    """KPIs over wellness patients: revenue per patient and visit, median
    visits, doses per transaction, compliance, market revenue share."""
    pm = pm if pm is not None else patient_master(t, ctx)
    m = _market(pm).where(F.col("wellness_care").isNotNull())
    d = F.col("doses")
    no_prod = d.isNull()
    agg = m.groupBy(*CELL).agg(
        F.count("patient_id").alias("num_pats"),
        _cnt(F.col("baby").isNotNull()).alias("num_babies"),
        F.sum("total_rev").alias("sum_total_rev"),
        F.sum("visits").alias("total_visits"),
        F.median("visits").alias("median_visits"),
        F.sum("rev").alias("mkt_rev"),
        F.sum(d).alias("total_doses"),
        F.sum(d).alias("sum_doses"),
        F.sum("mkt_visits").alias("total_market_trans"),
        _cnt(no_prod).alias("pats_no_prod"),
        _cnt(no_prod & (F.col("baby") == 1)).alias("babies_no_prod"),
        _cnt(F.col("opp") == 0).alias("pats_compliant"),
        F.count(F.when(F.col("hw_tests") > 0, F.col("hw_tests"))).alias("num_pats_hw_test"),
        F.count(F.when(no_prod & (F.col("hw_tests") > 0), F.col("hw_tests"))).alias("num_pats_hw_test_no_prod"),
    )
    grid = _grid(t).select(*CELL, "dose_rec")
    g = _finish(grid, agg, ctx, {
        "num_pats": 0, "num_babies": 0, "total_visits": 0, "total_doses": 0, "total_market_trans": 0,
        "pats_no_prod": 0, "babies_no_prod": 0, "pats_compliant": 0, "num_pats_hw_test": 0,
        "num_pats_hw_test_no_prod": 0,
    })
    n = F.col("num_pats")
    rounded_total = F.coalesce(F.round(F.col("sum_total_rev"), 0), F.lit(0))
    return g.select(
        *CELL, "end_date", "num_pats", "num_babies",
        ratio_round(F.col("sum_total_rev"), n, 2, scale=4).alias("avg_rev_pat"),
        F.col("total_visits").cast("long").alias("total_visits"),
        ratio_round(F.col("sum_total_rev"), F.col("total_visits"), 2, scale=4).alias("avg_rev_visit"),
        F.coalesce(F.round(F.col("median_visits"), 0), F.lit(0.0)).cast("double").alias("median_visits"),
        F.coalesce(F.round(F.col("mkt_rev"), 0), F.lit(0)).cast("double").alias("total_market_rev"),
        F.col("total_doses").cast("long").alias("total_doses"),
        F.col("total_market_trans").cast("long").alias("total_market_trans"),
        ratio_round(F.col("total_doses"), F.col("total_market_trans"), 2).alias("avg_doses_trans"),
        F.col("dose_rec").cast("long").alias("dose_rec"),
        ratio_round(F.col("sum_doses"), n, 2, when_null=None).alias("avg_doses_pat"),
        "pats_no_prod", "babies_no_prod", "pats_compliant",
        ratio_round(F.col("pats_compliant"), n, 2).alias("pct_pats_compliant"),
        F.when(rounded_total == 0, F.lit(0.0)).otherwise(
            ratio_round(F.col("mkt_rev"), rounded_total, 2, scale=6, when_null=None)
        ).alias("market_rev_pct"),
        "num_pats_hw_test", "num_pats_hw_test_no_prod",
    )


# ------------------------------------------------------------------ PS2
def wellness_rollup(t: Tables, ctx: RunContext) -> DataFrame:
    """The window's lines by patient, family, type and month, of patients with wellness care."""
    pats = b.patients(t, species=(DOG, CAT)).where(F.col("vi_species_id").isin(DOG, CAT)).select("patient_id", "h_id", "vi_species_id")
    x = _window_lines(t, ctx, patients=pats).select("patient_id", "h_id", "vi_species_id", "invoice_date", "service_id", "quantity_norm", "cost", "voided")
    return ru.wellness_rollup(x.join(_product_attrs(t), "service_id", "left"))


def product_master(t: Tables, ctx: RunContext, rollup: DataFrame | None = None) -> DataFrame:
    """Per clinic, species, family and type (f folded into ft): distinct
    wellness patients, doses and market revenue."""
    return ru.product_sums(rollup if rollup is not None else wellness_rollup(t, ctx), "h_id")


def _pm2_market(pm2: DataFrame) -> DataFrame:
    """Product master in long form per market, keeping only rows whose
    market revenue is non-zero (the report's filter)."""
    cells = F.array(
        F.struct(F.lit("Flea/Tick").alias("report_name"), F.col("ft_rev").cast("decimal(38,6)").alias("rev")),
        F.struct(F.lit("Heartworm").alias("report_name"), F.col("hw_rev").cast("decimal(38,6)").alias("rev")),
    )
    x = pm2.select("h_id", "vi_species_id", "family_name", "type", "patients", "doses", F.explode(cells).alias("m"))
    x = x.select("*", "m.*").drop("m").where((F.col("doses") != 0) & (F.col("rev") != 0))
    return x.withColumn("species", species_name(F.col("vi_species_id")))


PCELL = ["h_id", "report_name", "species"]


def _with_location(t: Tables, df: DataFrame) -> DataFrame:
    return df.join(maybe_broadcast(b.clinics(t).select("h_id", "location_number")), "h_id", "left")


# ------------------------------------------------------------------ T5
def _family_totals(pm2: DataFrame) -> DataFrame:
    """Per cell and family: doses and (summed) patients of the families
    with market revenue; shared by T5 and T6 so the plan reuses it."""
    return _pm2_market(pm2).groupBy(*PCELL, "family_name").agg(
        F.sum("doses").alias("qty"), F.sum("patients").alias("patients"))


def _t5_units(fam: DataFrame, digits: int = 2) -> DataFrame:
    fam = fam.withColumn("total_qty", F.sum("qty").over(Window.partitionBy(*PCELL)))
    fam = fam.where(F.when(F.col("total_qty") == 0, F.lit(0)).otherwise(scaled_round(F.col("qty"), F.col("total_qty"), digits)) > 0)
    top = sh.topn_other(fam, PCELL, "family_name", "qty", "total_qty", digits=digits)
    units = sh.reconcile_leader(top, PCELL, "share_units", F.col("measure_rank") == 1, digits)
    return top.select(*PCELL, "family_name", "row_order", units.alias("units"))


def t5_dose_share(t: Tables, ctx: RunContext, pm2: DataFrame | None = None, digits: int = 2) -> DataFrame:
    """Share of doses by product family, top five (priority families
    first) plus 'Other', reconciled to 100 % on the largest family."""
    pm2 = pm2 if pm2 is not None else product_master(t, ctx)
    top = _t5_units(_family_totals(pm2), digits)
    out = top.select(*PCELL, F.col("family_name").alias("product_name"), "row_order",
                     (F.col("units") / float(10 ** digits)).alias("dose_pct"))
    return _with_location(t, out).withColumn("end_date", F.lit(ctx.end_date))


# ------------------------------------------------------------------ T6
def t6_doses_per_patient(t: Tables, ctx: RunContext, pm2: DataFrame | None = None) -> DataFrame:
    """Doses per patient for the named (non-Other) families of T5.

    The named families of T5 are exactly the family rows whose priority
    rank is below 6, so this is one window over the family aggregate - no
    join back to T5."""
    pm2 = pm2 if pm2 is not None else product_master(t, ctx)
    fam = _family_totals(pm2)
    w = Window.partitionBy(*PCELL)
    fam = fam.withColumn("total_qty", F.sum("qty").over(w))
    fam = fam.where(F.when(F.col("total_qty") == 0, F.lit(0)).otherwise(scaled_round(F.col("qty"), F.col("total_qty"), 2)) > 0)
    r1 = F.dense_rank().over(w.orderBy(sh.priority(F.col("family_name")), F.col("qty").desc(), F.col("family_name")))
    out = fam.withColumn("row_order", r1.cast("long")).where(F.col("row_order") < 6).select(
        *PCELL, F.col("family_name").alias("product_name"), "row_order",
        ratio_round(F.col("qty"), F.col("patients"), 1).alias("doses_pat"),
    )
    return _with_location(t, out).withColumn("end_date", F.lit(ctx.end_date))


# ------------------------------------------------------------------ T10
def t10_revenue_share(t: Tables, ctx: RunContext, pm2: DataFrame | None = None) -> DataFrame:
    """Share of market revenue by product family, top five + Other."""
    pm2 = pm2 if pm2 is not None else product_master(t, ctx)
    x = _pm2_market(pm2)
    fam = x.groupBy(*PCELL, "family_name").agg(F.sum("rev").alias("rev_exact"))
    w = Window.partitionBy(*PCELL)
    fam = fam.select(
        "*",
        F.sum("rev_exact").over(w).alias("total_exact"),
    ).select(
        *PCELL, "family_name",
        F.round(F.col("rev_exact"), 0).cast("long").alias("rev"),
        F.round(F.col("total_exact"), 0).cast("long").alias("total_rev"),
        F.when(F.col("total_exact") == 0, F.lit(0)).otherwise(
            scaled_round(F.col("rev_exact"), F.col("total_exact"), 2, scale=6)).alias("pct"),
    ).where(F.col("pct") > 0)
    top = sh.topn_other(fam, PCELL, "family_name", "rev", "total_rev", digits=2)
    units = sh.reconcile_leader(top, PCELL, "share_units", F.col("measure_rank") == 1, 2)
    out = top.select(*PCELL, F.col("family_name").alias("product_name"), "row_order",
                     (units / 100.0).alias("rev_pct"))
    return _with_location(t, out).withColumn("end_date", F.lit(ctx.end_date))


# ------------------------------------------------------------------ PS3
def month_master(t: Tables, ctx: RunContext, rollup: DataFrame | None = None) -> DataFrame:
    """Per clinic, species and month: patients with flea/tick or heartworm
    product, all patients, and doses of patients whose year total is
    positive. Wellness patients only."""
    x = rollup if rollup is not None else wellness_rollup(t, ctx)
    pmon = x.groupBy("h_id", "patient_id", "vi_species_id", "data_month").agg(F.sum("ft_doses").alias("ft_doses"), F.sum("hw_doses").alias("hw_doses"))
    wp = Window.partitionBy("h_id", "patient_id")
    pmon = pmon.withColumn("ft_year", F.sum("ft_doses").over(wp)).withColumn("hw_year", F.sum("hw_doses").over(wp))
    out = pmon.groupBy("h_id", "vi_species_id", "data_month").agg(
        F.countDistinct(F.when(F.col("ft_doses") > 0, F.col("patient_id"))).alias("ft_patients"),
        F.countDistinct(F.when(F.col("hw_doses") > 0, F.col("patient_id"))).alias("hw_patients"),
        F.countDistinct("patient_id").alias("total_patients"),
        F.sum(F.when(F.col("ft_year") > 0, F.col("ft_doses"))).alias("ft_doses"),
        F.sum(F.when(F.col("hw_year") > 0, F.col("hw_doses"))).alias("hw_doses"),
    )
    return out


# ------------------------------------------------------------------ T11
def t11_trend(t: Tables, ctx: RunContext, mm: DataFrame | None = None) -> DataFrame:
    """Twelve-month trend per market and species, zero-filled."""
    mm = mm if mm is not None else month_master(t, ctx)
    cells = F.array(
        F.struct(F.lit("Flea/Tick").alias("report_name"), F.col("ft_patients").alias("pats_prod"), F.col("ft_doses").alias("doses")),
        F.struct(F.lit("Heartworm").alias("report_name"), F.col("hw_patients").alias("pats_prod"), F.col("hw_doses").alias("doses")),
    )
    m = mm.select("h_id", species_name(F.col("vi_species_id")).alias("species"), "data_month", "total_patients",
                  F.explode(cells).alias("c")).select("*", "c.*").drop("c")
    months = [(k, ctx.month(-(k - 1))) for k in range(1, 13)]
    grid = spine(_grid(t).select(*CELL), "row_order", [k for k, _ in months])
    month_of = None
    for k, dt in months:
        month_of = F.when(F.col("row_order") == k, F.lit(dt)) if month_of is None else month_of.when(F.col("row_order") == k, F.lit(dt))
    grid = grid.withColumn("data_month", month_of)
    g = grid.join(m, ["h_id", "report_name", "species", "data_month"], "left")
    return g.select(
        *CELL, F.lit(ctx.end_date).alias("end_date"),
        F.date_format("data_month", "MMM").alias("month"),
        (F.lit(13) - F.col("row_order")).alias("column_order"),
        F.coalesce(F.col("total_patients"), F.lit(0)).cast("long").alias("total_patients"),
        F.coalesce(F.col("total_patients") - F.col("pats_prod"), F.lit(0)).cast("long").alias("pats_no_prod"),
        F.coalesce(F.col("pats_prod"), F.lit(0)).cast("long").alias("pats_prod"),
        F.coalesce(F.col("doses"), F.lit(0)).cast("long").alias("total_doses"),
    )


# ------------------------------------------------------------------ T12
T12_LABELS = hb.bucket_labels(13, with_zero=True)


def t12_dose_histogram(t: Tables, ctx: RunContext, pm: DataFrame | None = None) -> DataFrame:
    """All wellness patients by doses bought (0..12, 13+): patients, missed
    doses per patient of the bucket, and total missed doses."""
    pm = pm if pm is not None else patient_master(t, ctx)
    m = _market(pm).where(F.col("wellness_care").isNotNull())
    agg = m.groupBy(*CELL, hb.capped_bucket(F.col("doses"), 13).alias("doses")).agg(
        F.count("patient_id").alias("patients"),
        F.sum("opp").alias("total_missed_doses"),
    )
    grid = spine(_grid(t).select(*CELL, "dose_rec"), "doses", T12_LABELS)
    g = _finish(grid, agg, ctx, {"patients": 0, "total_missed_doses": 0}, CELL + ["doses"])
    v = F.when(F.col("doses") == "13+", F.lit(None)).otherwise(F.col("doses").cast("long"))
    diff = F.when(F.col("doses") == "13+", F.lit(0)).otherwise(F.col("dose_rec") - v)
    return g.select(
        *CELL, "end_date", F.col("dose_rec").cast("long").alias("dose_rec"), "doses",
        F.col("patients").cast("long").alias("patients"),
        F.when(diff < 0, F.lit(0)).otherwise(diff).cast("long").alias("missed_doses"),
        F.col("total_missed_doses").cast("long").alias("total_missed_doses"),
    )


# ----------------------------------------------------------------- T13a
def t13a_coarse_histogram(t: Tables, ctx: RunContext, pm: DataFrame | None = None) -> DataFrame:
    """Wellness patients in four dose buckets with shares reconciled to
    100 % on the largest bucket(s)."""
    pm = pm if pm is not None else patient_master(t, ctx)
    m = _market(pm).where(F.col("wellness_care").isNotNull())
    agg = m.groupBy(*CELL, hb.coarse_bucket(F.col("doses")).alias("doses")).agg(F.count("patient_id").alias("patients"))
    grid = spine(_grid(t).select(*CELL, "dose_rec"), "doses", hb.COARSE_LABELS)
    g = _finish(grid, agg, ctx, {"patients": 0}, CELL + ["doses"])
    w = Window.partitionBy(*CELL)
    total = F.sum("patients").over(w)
    g = g.withColumn("u", F.when(total == 0, F.lit(None)).otherwise(scaled_round(F.col("patients"), total, 2)))
    g = g.withColumn("row_order", F.dense_rank().over(w.orderBy(F.col("patients").desc())))
    s = F.sum("u").over(w)
    u = (
        F.when((s > 100) & (F.col("row_order") == 1), F.col("u") - (s - 100))
        .when((s < 100) & (F.col("row_order") == 1), F.col("u") + (100 - s))
        .otherwise(F.col("u"))
    )
    return g.select(
        *CELL, "end_date", F.col("dose_rec").cast("long").alias("dose_rec"), "doses",
        F.col("patients").cast("long").alias("patients"), (u / 100.0).alias("pct_pats"),
    )


# ------------------------------------------------------------------ T13
def t13_rec_histogram(t: Tables, ctx: RunContext, pm: DataFrame | None = None) -> DataFrame:
    """Wellness patients by dose label relative to the recommendation
    ('0 Doses', '1 Dose', '2-5 Doses', '6+ Doses', ...); if the rounded
    shares miss 100 %, every row at the maximum takes the residual."""
    pm = pm if pm is not None else patient_master(t, ctx)
    m = _market(pm).where(F.col("wellness_care").isNotNull())
    d0 = F.coalesce(F.col("doses"), F.lit(0))
    agg = m.groupBy(*CELL, hb.rec_label(d0, F.col("rec")).alias("doses")).agg(
        F.count("patient_id").alias("patients"))
    grid = _grid(t).select(*CELL, "dose_rec")
    grid = grid.select("*", F.posexplode(hb.rec_label_list(F.col("dose_rec"))).alias("pos", "doses"))
    g = _finish(grid, agg, ctx, {"patients": 0}, CELL + ["doses"])
    w = Window.partitionBy(*CELL)
    total = F.sum("patients").over(w)
    g = g.withColumn("u", F.when(total == 0, F.lit(0)).otherwise(scaled_round(F.col("patients"), total, 2)))
    u = sh.reconcile_maxima(CELL, "u", 2)
    return g.select(
        *CELL, "end_date", F.col("dose_rec").cast("long").alias("dose_rec"), "doses",
        F.col("patients").cast("long").alias("patients"), (u / 100.0).alias("pct_pats"),
        (F.col("pos") + 1).cast("long").alias("row_order"),
    )
