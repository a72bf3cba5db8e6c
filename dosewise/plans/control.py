"""CONTROL - client metrics since each clinic's campaign start.

Same shape as CONSUMER: one scan of the 24-month lines of the clinic's
clients, then one aggregation pass per stage family (product sets,
service categories). The campaign window is per clinic, so its bounds are
columns (the clinic dimension is broadcast) rather than literals.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..context import RunContext, add_months
from ..operators import trailing as tm
from ..operators.sizing import maybe_broadcast
from ..sources import binding as b
from ..sources.tables import Tables
from .consumer import line_at



def control_lines(t: Tables, ctx: RunContext) -> DataFrame:
    """Unvoided lines with a client, calendar months [end-24, end] and
    [as_of-24m, as_of); patient species, product attributes and the
    clinic's campaign start attached. ``in_control`` marks the lines of the
    control clients' patients (active, living dogs and cats): every stage but
    the activity dates and visits (CT2, CT3) counts those only."""
    end, as_of = ctx.end_date, ctx.as_of
    lo = max(add_months(end, -24), add_months(as_of, -24))
    hi = min(add_months(end, 1), as_of)
    ours = F.col("is_active") & ~F.col("is_deceased") & F.col("vi_species_id").isin(3, 7)
    pats = b.patients(t).select("patient_id", "h_id", "vi_species_id", F.coalesce(ours, F.lit(False)).alias("in_control"))
    prod = maybe_broadcast(b.products(t).select("service_id", "product", "family_name", "type", "service_kind", "product_info"))
    clin = maybe_broadcast(b.clinics(t).select("h_id", "start_date"))
    return (
        b.lines(t, lo, hi, pats).where(~F.col("voided") & F.col("client_id").isNotNull())
        .select("patient_id", "client_id", "h_id", "vi_species_id", "in_control", "invoice_date", "line_seq", "service_id",
                "quantity", "quantity_norm", "cost")
        .join(prod, "service_id", "left").join(clin, "h_id")
    )


def control_tags() -> dict:
    p, typ = F.col("product"), F.col("type")
    return {
        "combo": typ.isin("fh", "fth"),
        "hg": p.startswith("Heartgard"),
        "fl": p.startswith("Frontline") & ~p.startswith("Frontline Tritak"),
        "flt": p.startswith("Frontline Tritak"),
        "ce": p.startswith("Certifect"),
        "nex": p.startswith("NexGard"),
        "comp_hg": (typ == "h") & ~p.startswith("Heartgard"),
        "comp_fl": typ.isin("f", "ft") & ~p.startswith("Frontline") & ~p.startswith("NexGard") & ~p.startswith("Certifect"),
    }


def is_purchase() -> Column:
    """A flea, tick or heartworm purchase of a control client's patient."""
    q = F.col("quantity_norm")
    return F.col("in_control") & F.col("type").isNotNull() & q.isNotNull() & (q != 0)


def product_extras(ctx: RunContext, camp) -> list:
    """Interceptor doses (12 m, 24 m, campaign), three families' campaign
    doses, and the last competitor product (none if bought before the start)."""
    q, d, fam, ok = F.col("quantity_norm"), F.col("invoice_date"), F.col("family_name"), is_purchase()
    inter = F.col("product").startswith("Interceptor")
    doses = {
        "int_doses_12": inter & tm.in_window(d, ctx.trailing(0)), "int_doses_24": inter & tm.in_window(d, ctx.trailing(1)),
        "int_doses_camp": inter & tm.in_window(d, camp), "trif_doses": (fam == "Trifexis") & tm.in_window(d, camp),
        "rev_doses": (fam == "Revolution") & tm.in_window(d, camp), "adv_doses": (fam == "Advantage Multi") & tm.in_window(d, camp),
    }
    return [F.sum(F.when(ok & hit, q).otherwise(0)).alias(name) for name, hit in doses.items()] + [
        tm.flagged_id(F.max(F.when(ok & control_tags()[tag], tm.latest_id(d, F.col("line_seq"), tm.in_window(d, camp), F.col("service_id"))))).alias(f"{tag}_service")
        for tag in ("comp_hg", "comp_fl")]


def with_products(t: Tables, metrics: DataFrame) -> DataFrame:
    """The names of the last competitor products, for their services."""
    for tag in ("comp_hg", "comp_fl"):
        name = b.products(t).select(F.col("service_id").alias(f"{tag}_service"), F.col("product").alias(f"{tag}_prod"))
        metrics = metrics.join(maybe_broadcast(name), f"{tag}_service", "left").drop(f"{tag}_service")
    return metrics


def service_tags(since: date) -> dict:
    """Categories of the control patients' paid lines; medication counts from
    the day ``since`` on. ``other`` is what is in none of the named general
    services, diets, flea/tick/heartworm purchases, medications and vaccines."""
    info, kind, low = F.col("product_info"), F.col("service_kind"), F.lower(F.col("product_info"))
    paid, general = F.col("in_control") & (F.col("cost") != 0), kind == "general"
    named = general & (info.like("Surgery%") | low.like("%dental%") | low.isin("service - boarding", "service - grooming"))
    return {
        "pm": paid & (kind == "nsaid") & (F.col("invoice_date") >= F.lit(since)),
        "dental": paid & general & (info == "Surgery - dental"),
        "surg": paid & general & info.like("Surgery%") & (info != "Surgery - dental"),
        "vacc": paid & (kind == "vaccine"),
        "board": paid & general & (low == "service - boarding"),
        "groom": paid & general & (low == "service - grooming"),
        "other": paid & ~F.coalesce(named, F.lit(False)) & ~F.coalesce(kind.isin("diet", "nsaid", "vaccine"), F.lit(False))
        & ~F.coalesce(is_purchase(), F.lit(False)),
    }


def service_aggs(camp, since: date) -> list:
    """Per category: purchases and spend since the campaign start, last purchase."""
    d, aggs = F.col("invoice_date"), []
    for tag, pred in service_tags(since).items():
        hit = pred & tm.in_window(d, camp)
        aggs += [
            F.count(F.when(hit, F.lit(1))).alias(f"num_{tag}_purch"),
            F.max(F.when(pred, d)).alias(f"last_{tag}_purch"),
            F.coalesce(F.sum(F.when(hit, F.col("cost"))), F.lit(0)).cast("double").alias(f"dollar_{tag}_purch"),
        ]
    return aggs


def control_product_metrics(t: Tables, ctx: RunContext) -> DataFrame:
    """Per client and product set: last purchase; purchases, revenue and
    doses since the campaign start; pet species at the last purchase.
    Plus Interceptor doses (12 m, 24 m, campaign) and three named
    families' doses since the start (CT8-CT17)."""
    x = control_lines(t, ctx).where(is_purchase())
    camp = (F.col("start_date"), F.lit(ctx.as_of - timedelta(days=1)))
    q = F.col("quantity_norm")
    extra = product_extras(ctx, camp)
    out = tm.tagged_metrics(
        x, ["client_id"], control_tags(), {"camp": camp}, revenue=F.col("cost"), doses=q,
        last_at=line_at(), extra=extra,
    )
    out = with_products(t, out)
    return out.select(*[F.col(c).cast("double").alias(c) if "_rev_" in c else F.col(c) for c in out.columns])


def control_service_metrics(t: Tables, ctx: RunContext) -> DataFrame:
    """Per client: purchases and spend since the campaign start and the
    last purchase, for medication, dental, surgery, vaccine, boarding,
    grooming and uncategorised lines;
    visits in the last 12 months; first and last activity (CT2, CT3,
    CT18-CT26)."""
    x = control_lines(t, ctx)
    end = ctx.end_date
    d = F.col("invoice_date")
    aggs = service_aggs((F.col("start_date"), F.lit(ctx.as_of - timedelta(days=1))), ctx.month(-23))
    aggs += [
        F.countDistinct(F.when(d.between(F.lit(add_months(end, -12)), F.lit(end)), d)).alias("num_visits"),
        F.max(d).alias("last_active"), F.min(d).alias("first_active"),
    ]
    return x.groupBy("client_id").agg(*aggs)


# ------------------------------------------------------------ CT4-CT5
def control_clients(t: Tables, ctx: RunContext, lines: DataFrame | None = None) -> DataFrame:
    """Clients with a line in the control window (same clinic), with their
    active living dogs and cats rolled up (HH1) and names cleansed (first
    pass only, as in the reference)."""
    from ..operators import contact as cl

    x = lines if lines is not None else control_lines(t, ctx)
    temp = x.select("h_id", "client_id").distinct()
    pats = b.patients(t).join(b.patient_activity(t), "patient_id").where(
        F.col("is_active") & ~F.col("is_deceased") & F.col("vi_species_id").isin(3, 7))
    months = F.months_between(F.lit(ctx.end_date), F.col("dob"), False)
    dog = F.col("vi_species_id") == 3
    hh = pats.groupBy("client_id").agg(
        F.max(F.when((months > 60) & dog, 1).otherwise(0)).alias("dogs_over_5"),
        F.sum(F.when((months > 48) & dog, 1).otherwise(0)).cast("long").alias("dogs_over_4"),
        F.sum(F.when(dog, 1).otherwise(0)).cast("long").alias("canine_count"),
        F.sum(F.when(F.col("vi_species_id") == 7, 1).otherwise(0)).cast("long").alias("feline_count"),
        F.min("first_active").alias("first_visit"))
    c = b.clients(t).join(temp, ["h_id", "client_id"], "left_semi").join(hh, "client_id")
    return c.select(
        "client_id", "h_id",
        F.coalesce(cl._strip(F.col("first_name"), cl.NAME_JUNK), F.lit(cl.NONE_GIVEN)).alias("first_name"),
        F.coalesce(cl._strip(F.col("last_name"), cl.NAME_JUNK), F.lit(cl.NONE_GIVEN)).alias("last_name"),
        F.col("title").alias("prefix"),
        cl.clean_address(F.col("address1"), cl.NONE_GIVEN).alias("address1"),
        cl.clean_address(F.col("address2")).alias("address2"),
        cl.clean_control(F.col("city")).alias("city"), cl.clean_control(F.col("state")).alias("state"),
        F.trim(cl.clean_zip(F.col("postal_code"))).alias("postal_code"), cl.clean_phone(F.col("phone1")).alias("phone1"),
        cl.valid_email(F.col("primary_email")).alias("primary_email"),
        "dogs_over_5", "dogs_over_4", "canine_count", "feline_count", "first_visit")


# ----------------------------------------------------------- CT27-CT29
def at_least_0(name: str) -> Column:
    """Doses of the file: returns may make a sum negative, which is shown as 0."""
    return F.greatest(F.coalesce(F.col(name), F.lit(0)), F.lit(0))


def control_file(t: Tables, ctx: RunContext, lines: DataFrame | None = None, materialize=None) -> DataFrame:
    """Detail row per client (product-set and service metrics fused into
    one aggregation pass), excluded regions (a NULL state is dropped too),
    placeholder names and clients without a first visit removed; one
    '1HD' header per clinic with details, record count = details + 1."""
    from ..functions.semantics import mdy, money_text
    from ..operators import contact as cl

    x = lines if lines is not None else control_lines(t, ctx)
    cli = control_clients(t, ctx, x)
    ok = is_purchase()
    camp = (F.col("start_date"), F.lit(ctx.as_of - timedelta(days=1)))
    q = F.col("quantity_norm")
    prod = tm.tagged_aggs({k: ok & v for k, v in control_tags().items()}, {"camp": camp}, revenue=F.col("cost"), doses=q,
                          last_at=line_at())
    d = F.col("invoice_date")
    extra = product_extras(ctx, camp) + [
        F.countDistinct(F.when(d.between(F.lit(add_months(ctx.end_date, -12)), F.lit(ctx.end_date)), d)).alias("num_visits")]
    svc = service_aggs(camp, ctx.month(-23))
    # dental hygiene (CT21) in the same pass: matrix doses on the line frame
    from ..operators.matrix import dental_doses
    from .calllist import dental_matrix, package_fields

    grp = b._map(F.col("product_info"), DENTAL_HYG_GROUPS)
    xd = x.join(maybe_broadcast(package_fields(t).drop("product_info")), "service_id", "left")
    xd = dental_doses(xd.withColumn("qty_raw", F.col("quantity").cast("long")), dental_matrix(t.spark), qty="qty_raw")
    hyg = []
    for name, g in (("oravet", "Oravet"), ("dental_hyg", "Competitive")):
        is_g = F.col("in_control") & (grp == g) & (F.col("cost") != 0)
        hyg += [F.max(F.when(is_g, d)).alias(f"last_{name}_purch"),
                F.count(F.when(is_g & tm.in_window(d, camp), F.lit(1))).alias(f"num_{name}_purch"),
                F.coalesce(F.sum(F.when(is_g & tm.in_window(d, camp), F.col("cost"))), F.lit(0)).cast("double").alias(f"dollar_{name}_purch"),
                F.coalesce(F.sum(F.when(is_g & tm.in_window(d, camp), F.col("doses"))), F.lit(0)).cast("double").alias(f"doses_{name}_purch")]
    metrics = xd.groupBy("client_id").agg(*prod, *extra, *svc, *hyg, F.max(d).alias("last_active"))
    metrics = with_products(t, metrics)
    # client-level NSAID stage for the client-level row
    prev = control_nsaid(t, ctx, keys=("client_id",))
    r = (cli.join(metrics, "client_id", "left").join(prev, "client_id", "left")).where(
        ~F.col("state").isin(*cl.REGION_PREFIXES)
        & ~((F.col("first_name") == cl.NONE_GIVEN) | (F.col("last_name") == cl.NONE_GIVEN) | (F.col("address1") == cl.NONE_GIVEN))
        & F.col("first_visit").isNotNull())
    cols = [F.lit("1DT").alias("record_type"), "client_id", "h_id", "first_name", "last_name", "prefix", "address1",
            "address2", "city", "state", "postal_code", "phone1", "primary_email", "dogs_over_5", "dogs_over_4",
            "canine_count", "feline_count", mdy("first_visit").alias("first_visit"), mdy("last_active").alias("last_active")]
    for tag in control_tags():
        cols += [mdy(f"last_{tag}_purch").alias(f"last_{tag}_purch"),
                 F.coalesce(F.col(f"{tag}_purch_camp"), F.lit(0)).alias(f"{tag}_purch_camp"),
                 money_text(F.coalesce(F.col(f"{tag}_rev_camp"), F.lit(0))).alias(f"{tag}_rev_camp"),
                 at_least_0(f"{tag}_doses_camp").cast("long").alias(f"{tag}_doses_camp")]
        cols.append(F.col(f"{tag}_last_pet_species"))
    for tag in service_tags(ctx.month(-23)):
        out = "unk" if tag == "other" else tag  # the file calls the uncategorised group "unknown"
        cols += [F.coalesce(F.col(f"num_{tag}_purch"), F.lit(0)).alias(f"num_{out}_purch"),
                 mdy(f"last_{tag}_purch").alias(f"last_{out}_purch"),
                 money_text(F.coalesce(F.col(f"dollar_{tag}_purch").cast("decimal(28,4)"), F.lit(0))).alias(f"dollar_{out}_purch")]
    cols += [at_least_0(c).cast("long").alias(c) for c in
             ("int_doses_12", "int_doses_24", "int_doses_camp", "trif_doses", "rev_doses", "adv_doses")]
    cols += [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in
             ("num_visits", "num_prev_purch", "num_dogs", "num_oravet_purch", "num_dental_hyg_purch")]
    cols += ["comp_hg_prod", "comp_fl_prod"]
    cols += [mdy(c).alias(c) for c in ("last_prev_purch", "last_oravet_purch", "last_dental_hyg_purch")]
    cols += [money_text(F.coalesce(F.col(c), F.lit(0))).alias(c) for c in
             ("dollar_prev_purch", "dollar_oravet_purch", "dollar_dental_hyg_purch")]
    cols += [at_least_0(c).cast("double").alias(c) for c in ("prev_pills", "doses_oravet_purch", "doses_dental_hyg_purch")]
    detail = r.select(*cols)
    if materialize is not None:  # report runs: compute the detail once, count from it
        detail = materialize(detail)
    n = detail.groupBy("h_id").agg(F.count(F.lit(1)).alias("_n"))
    clin = maybe_broadcast(b.clinics(t).select("h_id", "account_number", "location_number", "clinic_name"))
    heads = clin.join(n, "h_id").select(
        F.lit("1HD").alias("record_type"), F.lit(ctx.as_of.strftime("%m/%d/%Y")).alias("first_name"),
        (F.col("_n") + 1).cast("string").alias("last_name"), F.col("account_number").alias("prefix"),
        F.col("location_number").cast("string").alias("address1"), F.substring("clinic_name", 1, 40).alias("address2"), "h_id")
    return detail.unionByName(heads, allowMissingColumns=True)


# ----------------------------------------------------------------- CT0
def require_control_clinic(t: Tables, h_id: int) -> None:
    """CT0: a CONTROL run is refused for a clinic without a campaign start."""
    from ..operators.guards import NotInControlFile, require_rows

    require_rows(b.clinics(t).where(F.col("h_id") == h_id).where(F.col("start_date").isNotNull()), NotInControlFile)


# ----------------------------------------------------------------- CT19
def control_nsaid(t: Tables, ctx: RunContext, keys: tuple = ("h_id", "client_id")) -> DataFrame:
    """Per client: Previcox purchases since the campaign start, last
    purchase, spend, pills and distinct dogs (months end-23..end)."""
    lo, hi = ctx.months_window(-23, 0)
    clin = maybe_broadcast(b.clinics(t).select("h_id", "start_date"))
    pats = b.patients(t).where(F.col("is_active") & ~F.col("is_deceased") & F.col("vi_species_id").isin(3, 7)).select(
        "patient_id", "h_id", "vi_species_id")
    s = (b.nsaid_sales(t, lo, hi).where((F.col("product") == "Previcox") & ~F.col("voided") & (F.col("cost") != 0)
                                & F.col("quantity").isNotNull() & (F.col("quantity") != 0)
                                & (F.col("invoice_date") >= F.lit(lo)) & (F.col("invoice_date") < F.lit(hi)))
         .join(pats, "patient_id").join(clin, "h_id"))
    camp = tm.in_window(F.col("invoice_date"), (F.col("start_date"), F.lit(ctx.as_of - timedelta(days=1))))
    from ..functions.semantics import scaled_round

    pills = F.sum(F.when(camp, scaled_round(F.col("quantity"), F.col("dosage_volume"), 9)))
    return s.groupBy(*keys).agg(
        F.count(F.when(camp, F.col("lineitem_id"))).alias("num_prev_purch"),
        F.max("invoice_date").alias("last_prev_purch"),
        F.coalesce(F.sum(F.when(camp, F.col("cost"))), F.lit(0)).cast("double").alias("dollar_prev_purch"),
        (F.coalesce(scaled_round(pills, F.lit(10**9), 2), F.lit(0)) / 100.0).alias("prev_pills"),
        F.countDistinct(F.when(camp & (F.col("vi_species_id") == 3), F.col("patient_id"))).alias("num_dogs"),
    )


# ----------------------------------------------------------------- CT21
# fixed values of the binding: dental-hygiene product groups by service
DENTAL_HYG_GROUPS = {"Surgery - dental": "Oravet", "Service - Grooming": "Competitive"}


def control_dental_hygiene(t: Tables, ctx: RunContext, keys: tuple = ("h_id", "client_id"),
                           lines: DataFrame | None = None) -> DataFrame:
    """Own-brand vs competitive dental hygiene per client since the
    campaign start: last purchase, purchases, spend and doses (MX1)."""
    from ..operators.matrix import dental_doses
    from .calllist import dental_matrix, package_fields

    x = (lines if lines is not None else control_lines(t, ctx)).where(
        F.col("in_control") & (F.col("cost") != 0) & F.col("product_info").isin(*DENTAL_HYG_GROUPS))
    grp = b._map(F.col("product_info"), DENTAL_HYG_GROUPS)
    x = x.withColumn("product_group", grp).join(maybe_broadcast(package_fields(t).drop("product_info")), "service_id")
    x = dental_doses(x.withColumn("quantity", F.col("quantity").cast("long")), dental_matrix(t.spark))
    camp = tm.in_window(F.col("invoice_date"), (F.col("start_date"), F.lit(ctx.as_of - timedelta(days=1))))
    aggs = []
    for name, g in (("oravet", "Oravet"), ("dental_hyg", "Competitive")):
        is_g = F.col("product_group") == g
        aggs += [F.max(F.when(is_g, F.col("invoice_date"))).alias(f"last_{name}_purch"),
                 F.count(F.when(is_g & camp, F.lit(1))).alias(f"num_{name}_purch"),
                 F.coalesce(F.sum(F.when(is_g & camp, F.col("cost"))), F.lit(0)).cast("double").alias(f"dollar_{name}_purch"),
                 F.coalesce(F.sum(F.when(is_g & camp, F.col("doses"))), F.lit(0)).cast("double").alias(f"doses_{name}_purch")]
    return x.groupBy(*keys).agg(*aggs)
