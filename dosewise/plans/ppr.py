"""PPR - period-over-period progress report: the last three months against
the same three months a year earlier, for all clinics at once.

Both periods come from one scan (the Parquet bound covers months -14..0;
rows outside the two periods are dropped by the period label). Patient-
month rows are the grain of the master; every table aggregates it.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..context import RunContext
from ..functions.semantics import ratio_round, scaled_round
from ..operators import compliance as cp
from ..operators import shares as sh
from ..operators.grid import spine
from ..operators.sizing import maybe_broadcast
from ..sources import binding as b
from ..sources.tables import Tables
from . import rollup as ru

DOG, CAT = 3, 7
SPECIES_NAMES = ("Canine", "Feline")


def periods(ctx: RunContext) -> list[tuple[str, int, int]]:
    y = ctx.end_date.year
    return [(f"Total {y}", -2, 0), (f"Total {y - 1}", -14, -12)]


def _period_of(month: Column, ctx: RunContext) -> Column:
    out = None
    for name, a, z in periods(ctx):
        cond = month.between(F.lit(ctx.month(a)), F.lit(ctx.month(z)))
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return out


def _species_name(c: Column) -> Column:
    return F.when(c == DOG, F.lit("Canine")).otherwise(F.lit("Feline"))


# ------------------------------------------------------------------ PP1
def patient_master(t: Tables, ctx: RunContext) -> DataFrame:
    """Per period, clinic, patient and month: doses and revenue by market
    (doses <= 0 -> NULL, revenue rounded to cents), visits; patients without
    a wellness visit in the period are removed."""
    lo, hi = ctx.month(-14), ctx.month(1)
    pats = b.patients(t, species=(DOG, CAT)).where(F.col("vi_species_id").isin(DOG, CAT)).select("patient_id", "h_id", "vi_species_id")
    prod = maybe_broadcast(b.products(t).select(
        "service_id", "type",
        ((F.col("service_kind") == "vaccine") | (F.col("product_info") == "Surgery - spay")
         | (F.col("service_kind") == "test")).alias("is_wellness")))
    x = (
        b.lines(t, lo, hi, pats).where(~F.coalesce("voided", F.lit(False)))  # an unknown flag counts as not voided
        .select("patient_id", "h_id", "vi_species_id", "invoice_date", "service_id", "quantity_norm", "cost")
        .join(prod, "service_id", "left")
        .withColumn("month", F.trunc("invoice_date", "MM"))
        .withColumn("time_period", _period_of(F.col("month"), ctx))
        .where(F.col("time_period").isNotNull())
    )
    fth = F.col("type").isNotNull() & F.col("quantity_norm").isNotNull() & (F.col("quantity_norm") != 0) & (F.col("cost") != 0)
    ftype = F.when(fth, F.col("type"))
    q = F.col("quantity_norm").cast("long")
    keys = ["time_period", "h_id", "patient_id", "vi_species_id", "month"]
    day = x.groupBy(*keys, "invoice_date").agg(
        F.sum(cp.ft_doses(ftype, q)).alias("ft_doses"),
        F.sum(cp.hw_doses(ftype, q)).alias("hw_doses"),
        F.sum(cp.ft_revenue(ftype, F.col("cost"))).alias("ft_rev"),
        F.sum(cp.hw_revenue(ftype, F.col("cost"))).alias("hw_rev"),
        F.max(F.when(ftype.isin(*cp.FT_TYPES), 1).otherwise(0)).alias("ft_day"),
        F.max(F.when(ftype.isin(*cp.HW_TYPES), 1).otherwise(0)).alias("hw_day"),
        F.count(F.when(F.col("is_wellness"), 1)).alias("wellness"),
    )
    mon = day.groupBy(*keys).agg(
        F.sum("ft_doses").alias("ft_doses"), F.sum("hw_doses").alias("hw_doses"),
        F.round(F.sum("ft_rev"), 2).alias("ft_rev"), F.round(F.sum("hw_rev"), 2).alias("hw_rev"),
        F.count(F.lit(1)).alias("visits"), F.sum("ft_day").alias("ft_visits"), F.sum("hw_day").alias("hw_visits"),
        F.sum("wellness").alias("wellness"),
    )
    well = F.sum("wellness").over(Window.partitionBy("time_period", "h_id", "patient_id"))
    ftd, hwd = F.col("ft_doses"), F.col("hw_doses")
    return mon.select(
        *keys,
        F.when(ftd <= 0, F.lit(None)).otherwise(ftd).alias("ft_doses"),
        F.when(hwd <= 0, F.lit(None)).otherwise(hwd).alias("hw_doses"),
        F.when(ftd <= 0, F.lit(None)).otherwise(F.col("ft_rev")).alias("ft_rev"),
        F.when(hwd <= 0, F.lit(None)).otherwise(F.col("hw_rev")).alias("hw_rev"),
        "visits", F.col("ft_visits").cast("long").alias("ft_visits"), F.col("hw_visits").cast("long").alias("hw_visits"),
        well.alias("wellness_care"),
    ).where(F.col("wellness_care") > 0)


def _by_market(pm: DataFrame) -> DataFrame:
    cells = F.array(
        F.struct(F.lit("Flea/Tick").alias("report_name"), F.col("ft_doses").alias("doses"),
                 F.col("ft_rev").alias("rev"), F.col("ft_visits").alias("mkt_visits")),
        F.struct(F.lit("Heartworm").alias("report_name"), F.col("hw_doses").alias("doses"),
                 F.col("hw_rev").alias("rev"), F.col("hw_visits").alias("mkt_visits")),
    )
    return pm.select("time_period", "h_id", "patient_id", "vi_species_id", "month", "visits",
                     F.explode(cells).alias("m")).select("*", "m.*").drop("m")


# ------------------------------------------------------------------ PP2
def product_master(t: Tables, ctx: RunContext) -> DataFrame:
    """Per period, clinic, species, family and type: distinct patients with
    wellness care in the period (those of its master) and doses."""
    pats = b.patients(t, species=(DOG, CAT)).where(F.col("vi_species_id").isin(DOG, CAT)).select("patient_id", "h_id", "vi_species_id")
    prod = maybe_broadcast(b.products(t).select("service_id", "type", "family_name", "service_kind", "product_info"))
    x = (
        b.lines(t, ctx.month(-14), ctx.month(1), pats).where(~F.coalesce("voided", F.lit(False)))
        .select("patient_id", "h_id", "vi_species_id", "invoice_date", "service_id", "quantity_norm", "cost", "voided")
        .join(prod, "service_id", "left")
        .withColumn("time_period", _period_of(F.trunc("invoice_date", "MM"), ctx))
        .where(F.col("time_period").isNotNull())
    )
    return ru.product_sums(ru.wellness_rollup(x, ("time_period",)), "time_period", "h_id").drop("hw_rev", "ft_rev")


# ------------------------------------------------------------- PP3 / PP4
def _metrics(df: DataFrame, keys: list[str]) -> DataFrame:
    pid = F.col("patient_id")
    g = df.groupBy(*keys).agg(
        F.countDistinct(pid).alias("unique_patients"),
        F.countDistinct(F.when(F.col("doses").isNotNull(), pid)).alias("unique_pat_with_prod"),
        F.sum("doses").alias("prod_doses"),
        F.sum("mkt_visits").alias("trans"),
        F.sum("rev").alias("rev"),
    )
    return g.select(
        *keys, "unique_patients", (F.col("unique_patients") - F.col("unique_pat_with_prod")).alias("unique_pat_no_prod"),
        "unique_pat_with_prod", "prod_doses", "trans",
        F.when(F.col("trans") == 0, F.lit(0.0)).otherwise(
            ratio_round(F.col("prod_doses"), F.col("trans"), 2, when_null=None)).alias("prod_doses_per_trans"),
        "rev",
    )


def t1_pre(t: Tables, ctx: RunContext, pm: DataFrame | None = None) -> DataFrame:
    """Period totals per clinic, species and market."""
    pm = pm if pm is not None else patient_master(t, ctx)
    m = _by_market(pm)
    out = _metrics(m, ["h_id", "vi_species_id", "report_name", "time_period"])
    return (out.withColumn("rev", F.col("rev").cast("double"))
            .withColumn("prod_doses", F.col("prod_doses").cast("long")).withColumn("trans", F.col("trans").cast("long")))


METRICS = ["unique_patients", "unique_pat_no_prod", "unique_pat_with_prod", "prod_doses", "trans",
           "prod_doses_per_trans", "rev"]


def report_columns(ctx: RunContext) -> list[tuple[int, str, object, str]]:
    """(column_order, description, key, year) of the 12 report columns: the
    two period totals and three month pairs, each followed by a change
    column (key None)."""
    (cur, *_), (prior, *_) = periods(ctx)
    cols = [(1, prior, prior, str(ctx.end_date.year - 1)), (2, cur, cur, str(ctx.end_date.year)),
            (3, "% Change", None, "")]
    k = 4
    for off in (-2, -1, 0):
        p, c = ctx.month(off - 12), ctx.month(off)
        cols += [(k, p.strftime("%b %Y"), p.isoformat(), str(p.year)),
                 (k + 1, c.strftime("%b %Y"), c.isoformat(), str(c.year)),
                 (k + 2, "% Change", None, "")]
        k += 3
    return cols


def pct_change(value: str, order: str, part: list[str], change_cols=(3, 6, 9, 12)) -> Column:
    """PC1: on change columns, (lag1 - lag2) / lag2 rounded to 3 places;
    lag2 = 0 -> 0; lag1 = 0 or NULL -> -1; other columns: the value."""
    w = Window.partitionBy(*part).orderBy(order)
    l1, l2 = F.lag(value, 1).over(w), F.lag(value, 2).over(w)
    chg = (
        F.when(l2 == 0, F.lit(0.0))
        .when(l1.isNull() | (l1 == 0), F.lit(-1.0))
        .otherwise(ratio_round(l1 - l2, l2, 3, scale=2, when_null=None))
    )
    return F.coalesce(F.when(F.col(order).isin(*change_cols), chg).otherwise(F.coalesce(F.col(value).cast("double"), F.lit(0.0))), F.lit(0.0))


def t1_trend(t: Tables, ctx: RunContext, pm: DataFrame | None = None) -> DataFrame:
    """Twelve report columns per clinic, species and market: period totals,
    month pairs and their percentage change."""
    pm = pm if pm is not None else patient_master(t, ctx)
    m = _by_market(pm)
    monthly = _metrics(m.withColumn("col_key", F.col("month").cast("string")),
                       ["h_id", "vi_species_id", "report_name", "col_key"])
    totals = _metrics(m.withColumn("col_key", F.col("time_period")),
                      ["h_id", "vi_species_id", "report_name", "col_key"])
    vals = monthly.unionByName(totals).withColumn("species", _species_name(F.col("vi_species_id"))).drop("vi_species_id")
    cols = report_columns(ctx)
    base = maybe_broadcast(b.clinics(t).select("h_id"))
    grid = spine(base, "species", SPECIES_NAMES, ("report_name", ["Flea/Tick", "Heartworm"]),
                 ("column_order", [c[0] for c in cols]))
    lut = F.array(*[F.struct(F.lit(o).alias("o"), F.lit(desc).alias("desc"), F.lit(key).cast("string").alias("key"),
                             F.lit(year).alias("year")) for o, desc, key, year in cols])
    grid = grid.withColumn("_c", F.filter(lut, lambda s: s["o"] == F.col("column_order"))[0]).select(
        "*", F.col("_c.desc").alias("desc"), F.col("_c.key").alias("col_key"), F.col("_c.year").alias("report_year_desc")
    ).drop("_c")
    j = grid.join(vals, ["h_id", "species", "report_name", "col_key"], "left")
    part = ["h_id", "species", "report_name"]
    out = j.select(
        "h_id", "species", "report_name",
        F.when(F.col("column_order") <= 3, F.concat(F.lit("Summary Totals: "), F.col("desc"))).otherwise(F.col("desc")).alias("report_month"),
        "column_order",
        *[pct_change(mname, "column_order", part).alias(mname) for mname in METRICS],
        "report_year_desc",
    )
    return out.withColumn("end_date", F.lit(ctx.end_date))


# ------------------------------------------------------------------ PP5
def _patient_period(t: Tables, ctx: RunContext, pm: DataFrame) -> DataFrame:
    """Per period, clinic, patient and market: doses and revenue summed
    over the period's months, recommendation, missed doses (clamped)."""
    m = _by_market(pm)
    g = m.groupBy("time_period", "h_id", "patient_id", "vi_species_id", "report_name").agg(
        F.sum(F.coalesce(F.col("doses"), F.lit(0))).alias("doses"),
        F.sum("rev").alias("rev"),
    )
    clin = maybe_broadcast(b.clinics(t).select("h_id", "dose_rec_ft_dog", "dose_rec_hw_dog", "dose_rec_ft_cat", "dose_rec_hw_cat"))
    s, mk = F.col("vi_species_id"), F.col("report_name")
    rec = F.coalesce(
        F.when(mk == "Heartworm", F.when(s == DOG, F.col("dose_rec_hw_dog")).otherwise(F.col("dose_rec_hw_cat")))
        .otherwise(F.when(s == DOG, F.col("dose_rec_ft_dog")).otherwise(F.col("dose_rec_ft_cat"))), F.lit(0))
    g = g.join(clin, "h_id", "left").withColumn("rec", rec)
    gap = F.col("rec") - F.col("doses")
    return g.select(
        "time_period", F.substring("time_period", 7, 4).alias("report_year"), "h_id", "patient_id",
        _species_name(s).alias("species"), "report_name", "doses", "rev", "rec",
        F.when(gap < 0, F.lit(0)).when(gap > F.col("rec"), F.col("rec")).otherwise(gap).alias("missed_doses"),
        F.when(F.col("rec") > F.col("doses"), F.lit(True)).otherwise(F.lit(False)).alias("non_compliant"),
    )


def t2_histogram(t: Tables, ctx: RunContext, pm: DataFrame | None = None) -> DataFrame:
    """Patients per period by doses received (0..12, 13 = more), their
    missed doses, and the missed doses of the bucket."""
    pm = pm if pm is not None else patient_master(t, ctx)
    pp = _patient_period(t, ctx, pm)
    d = F.col("doses")
    agg = pp.groupBy("h_id", "species", "report_name", "report_year",
                     F.when(d < 0, F.lit(0)).when(d <= 12, d).otherwise(F.lit(13)).cast("long").alias("doses_received")).agg(
        F.countDistinct("patient_id").alias("unique_patients"), F.sum("missed_doses").alias("total_missed_doses"))
    years = [p[0][6:10] for p in periods(ctx)]
    clin = maybe_broadcast(b.clinics(t).select("h_id", "dose_rec_ft_dog", "dose_rec_hw_dog", "dose_rec_ft_cat", "dose_rec_hw_cat"))
    grid = spine(clin, "species", SPECIES_NAMES, ("report_name", ["Flea/Tick", "Heartworm"]),
                 ("report_year", years), ("doses_received", list(range(14))))
    dog = F.col("species") == "Canine"
    rec = F.coalesce(F.when(F.col("report_name") == "Heartworm",
                            F.when(dog, F.col("dose_rec_hw_dog")).otherwise(F.col("dose_rec_hw_cat")))
                     .otherwise(F.when(dog, F.col("dose_rec_ft_dog")).otherwise(F.col("dose_rec_ft_cat"))), F.lit(0))
    gap = rec - F.col("doses_received")
    g = grid.join(agg, ["h_id", "species", "report_name", "report_year", "doses_received"], "left")
    return g.select(
        "h_id", "species", "report_name", "report_year", F.col("doses_received").cast("long").alias("doses_received"),
        F.when(gap < 0, F.lit(0)).otherwise(gap).cast("long").alias("missed_doses"),
        F.coalesce(F.col("unique_patients"), F.lit(0)).alias("unique_patients"),
        F.coalesce(F.col("total_missed_doses"), F.lit(0)).cast("long").alias("total_missed_doses"),
    )


# ------------------------------------------------------------------ PP7
def t4_revenue(t: Tables, ctx: RunContext, pm: DataFrame | None = None) -> DataFrame:
    """Per period, species and market: non-compliant patients, missed doses,
    price per dose, potential additional and actual revenue."""
    pm = pm if pm is not None else patient_master(t, ctx)
    pp = _patient_period(t, ctx, pm)
    agg = pp.groupBy("h_id", "report_year", "species", "report_name").agg(
        F.countDistinct(F.when(F.col("non_compliant"), F.col("patient_id"))).alias("non_compliant_patients"),
        F.sum("missed_doses").alias("missed"), F.sum("rev").alias("rev"), F.sum("doses").alias("doses"),
    )
    grid = spine(maybe_broadcast(b.clinics(t).select("h_id")), "report_year", [p[0][6:10] for p in periods(ctx)],
                 ("species", SPECIES_NAMES), ("report_name", ["Flea/Tick", "Heartworm"]))
    g = grid.join(agg, ["h_id", "report_year", "species", "report_name"], "left")
    return g.select(
        "h_id", F.col("report_year").alias("time_period"), "species", "report_name",
        F.concat(F.lit("Total "), F.col("report_year")).alias("report_time_period"),
        F.coalesce(F.col("non_compliant_patients"), F.lit(0)).alias("non_compliant_patients"),
        F.coalesce(F.col("missed"), F.lit(0)).cast("long").alias("total_missed_doses"),
        ratio_round(F.col("rev"), F.col("doses"), 2, scale=2).alias("avg_price_per_dose"),
        ratio_round(F.col("missed") * F.col("rev"), F.col("doses"), 2, scale=2).alias("pot_addl_rev"),
        F.coalesce(F.col("rev"), F.lit(0)).cast("double").alias("actual_rev"),
    )


# ------------------------------------------------------------------ PP8
PPR_MARKET_TYPES = {"Heartworm": ("fh", "h"), "Flea/Tick": ("fh", "ft")}


def t5_dose_share(t: Tables, ctx: RunContext, pm2: DataFrame | None = None) -> DataFrame:
    """Dose share by family per period: top five (priority families first)
    plus 'Other', three decimals, reconciled on the largest family; names
    upper-cased with a registered mark."""
    pm2 = pm2 if pm2 is not None else product_master(t, ctx)
    # a combination product counts in both markets: explode the market list
    markets = F.filter(
        F.array(*[F.when(F.col("type").isin(*types), F.lit(m)) for m, types in PPR_MARKET_TYPES.items()]),
        lambda m: m.isNotNull())
    x = pm2.withColumn("report_name", F.explode(markets)).withColumn("species", _species_name(F.col("vi_species_id")))
    cell = ["h_id", "report_name", "species", "time_period"]
    fam = x.groupBy(*cell, "family_name").agg(F.sum("doses").alias("qty"))
    tot = F.sum("qty").over(Window.partitionBy(*cell))
    fam = fam.withColumn("pct", scaled_round(F.col("qty"), F.when(tot == 0, F.lit(1)).otherwise(tot), 3))
    w = Window.partitionBy(*cell)
    r1 = F.dense_rank().over(w.orderBy(sh.priority(F.col("family_name")), F.col("qty").desc(), F.col("family_name")))
    r2 = F.dense_rank().over(w.orderBy(F.col("qty").desc(), F.col("family_name")))
    ranked = fam.select(
        *cell, "pct",
        F.when(r1 >= 6, F.concat(F.lit("Other "), F.col("report_name"))).otherwise(F.col("family_name")).alias("family_name"),
        F.least(r1, F.lit(6)).alias("row_order"), F.least(r2, F.lit(6)).alias("qty_rank"),
    )
    g = ranked.groupBy(*cell, "family_name").agg(
        F.sum("pct").alias("units"), F.min("row_order").alias("row_order"), F.min("qty_rank").alias("measure_rank"))
    units = sh.reconcile_leader(g, cell, "units", F.col("measure_rank") == 1, 3)
    name = F.when(F.col("family_name").like("Other%"), F.col("family_name")).otherwise(
        F.concat(F.upper(F.col("family_name")), F.lit("®")))
    return g.select(*cell, name.alias("product_name"), F.col("row_order").cast("long").alias("row_order"),
                    (units / 1000.0).alias("dose_pct"))


# ------------------------------------------------------------------ PP6
def t3_rec_histogram(t: Tables, ctx: RunContext, pm: DataFrame | None = None) -> DataFrame:
    """Per period, market and species: patients by dose label relative to
    the recommendation; rounded shares, residual to every maximum."""
    from ..operators import histogram as hb

    pm = pm if pm is not None else patient_master(t, ctx)
    pp = _patient_period(t, ctx, pm)
    cell = ["h_id", "time_period", "report_name", "species"]
    agg = pp.groupBy(*cell, hb.rec_label(F.col("doses"), F.col("rec")).alias("doses")).agg(
        F.countDistinct("patient_id").alias("patients"))
    clin = maybe_broadcast(b.clinics(t).select("h_id", "dose_rec_ft_dog", "dose_rec_hw_dog", "dose_rec_ft_cat", "dose_rec_hw_cat"))
    grid = spine(clin, "time_period", [p[0] for p in periods(ctx)], ("species", SPECIES_NAMES),
                 ("report_name", ["Flea/Tick", "Heartworm"]))
    dog = F.col("species") == "Canine"
    rec = F.coalesce(F.when(F.col("report_name") == "Heartworm",
                            F.when(dog, F.col("dose_rec_hw_dog")).otherwise(F.col("dose_rec_hw_cat")))
                     .otherwise(F.when(dog, F.col("dose_rec_ft_dog")).otherwise(F.col("dose_rec_ft_cat"))), F.lit(0))
    grid = grid.select(*cell, F.posexplode(hb.rec_label_list(rec)).alias("pos", "doses"))
    g = grid.join(agg, cell + ["doses"], "left").withColumn("patients", F.coalesce(F.col("patients"), F.lit(0)))
    w = Window.partitionBy(*cell)
    total = F.sum("patients").over(w)
    g = g.withColumn("u", F.when(total == 0, F.lit(0)).otherwise(scaled_round(F.col("patients"), total, 2)))
    u = sh.reconcile_maxima(cell, "u", 2)
    return g.select(*cell, F.concat(F.lit("Total "), F.substring("time_period", 7, 4)).alias("report_time_period"),
                    "doses", F.col("patients").cast("long").alias("total_patients"),
                    (u / 100.0).alias("percent_patients"), (F.col("pos") + 1).cast("long").alias("order_number"))
