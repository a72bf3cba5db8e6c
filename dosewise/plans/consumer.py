"""CONSUMER - one wide row per client over the last 24 months.

Spark shape: one scan of the 24-month invoice lines joined to the active
patients; every per-client stage is a conditional aggregate over that
input (TM1). The wide report fuses the product-set and service-category
stages: one scan of the lines makes a row per client and service, from which
every stage of the client is told; it is joined to the cleansed clients (both
sides keyed by ``client_id``), where the reference runs some twenty scans and
left joins.
"""

from __future__ import annotations

from datetime import timedelta
from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..context import RunContext, add_months
from ..functions.semantics import mdy, money_text
from ..operators import contact as cl
from ..operators import trailing as tm
from ..operators.sizing import maybe_broadcast
from ..sources import binding as b
from ..sources.tables import Tables

DOG, CAT = 3, 7
LINE_ID = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


# ------------------------------------------------------------------ CO1
def consumer_patients(t: Tables, ctx: RunContext) -> DataFrame:
    """Active, living dogs and cats seen in the last 23 months, with age flags."""
    end = ctx.end_date
    p = b.patients(t, species=(DOG, CAT)).join(b.patient_activity(t), "patient_id")
    months = F.months_between(F.lit(end), F.col("dob"), False)
    dog = F.col("vi_species_id") == DOG
    return p.where(
        (F.col("last_active") > F.lit(add_months(end, -23)))
        & F.col("is_active") & ~F.col("is_deceased")
        & F.col("vi_species_id").isin(DOG, CAT)
        & (F.col("patient_id") > 0)
    ).select(
        "patient_id", "client_id", "h_id", "vi_species_id", "dob", "first_active", "last_active",
        F.when((months > 72) & dog, 1).otherwise(0).alias("dogs_over_6"),
        F.when((months < 12) & dog, 1).otherwise(0).alias("puppy"),
        F.when((months > 48) & dog, 1).otherwise(0).alias("dogs_over_4"),
    )


def consumer_lines(t: Tables, ctx: RunContext, cp: DataFrame | None = None) -> DataFrame:
    """Unvoided lines of consumer patients in [end-24m, end), with product
    attributes and the two stage flags of the reference:
    ``is_fth`` (flea/tick/heartworm purchase, [end-23m, end), qty <> 0) and
    ``is_trans`` (any line before end-1 day)."""
    cp = cp if cp is not None else consumer_patients(t, ctx)
    end = ctx.end_date
    lo = add_months(end, -24)
    prod = maybe_broadcast(b.products(t).select(
        "service_id", "product", "family_name", "type", "service_kind", "product_info"))
    # the patient's client is floor(patient_id / 3), the same as the line's
    x = (
        b.lines(t, lo, end, cp.select("patient_id", "vi_species_id")).where(~F.col("voided"))
        .select(*LINE_ID, "patient_id", "client_id", "vi_species_id", "invoice_date", "line_seq", "service_id", "quantity_norm", "cost")
        .join(prod, "service_id", "left")
    )
    fth_lo = add_months(end, -23)
    return x.select(
        "*",
        (F.col("type").isNotNull() & (F.col("quantity_norm") != 0)
         & (F.col("invoice_date") >= F.lit(fth_lo))).alias("is_fth"),
        (F.col("invoice_date") < F.lit(end - timedelta(days=1))).alias("is_trans"),
    )


def line_at():
    """A line's place among its client's lines, with the pet's species."""
    return tm.packed(F.col("invoice_date"), F.col("line_seq"), F.col("vi_species_id"))


# ------------------------------------------------------------ CO9-CO17
def product_tags() -> dict:
    p, fam, typ = F.col("product"), F.col("family_name"), F.col("type")
    return {
        "hg": p.startswith("Heartgard"),
        "fl": p.startswith("Frontline") & (fam != "Tritak"),
        "ce": p.startswith("Certifect"),
        "combo": typ.isin("fh", "fth"),
        "comp_hg": (typ == "h") & ~p.startswith("Heartgard"),
        "comp_fl": typ.isin("ft", "f") & ~p.startswith("Frontline") & ~p.startswith("Certifect"),
        "flt": fam == "Tritak",
        "ng": fam == "NexGard",
    }


def other_fth_aggs(ctx: RunContext, within=None) -> list:
    """CO15: Interceptor doses (12 m, 24 m) and three named families' doses."""
    q = F.col("quantity_norm")
    ok = within if within is not None else F.lit(True)
    w12, w24 = ctx.trailing(0), ctx.trailing(1)
    d = F.col("invoice_date")
    fam = F.col("family_name")
    inter = F.col("product").startswith("Interceptor")
    return [
        F.sum(F.when(ok & inter & tm.in_window(d, w12), q).otherwise(0)).alias("int_doses_12"),
        F.sum(F.when(ok & inter & tm.in_window(d, w24), q).otherwise(0)).alias("int_doses_24"),
        F.sum(F.when(ok & (fam == "Trifexis") & tm.in_window(d, w12), q).otherwise(0)).alias("trif_doses"),
        F.sum(F.when(ok & (fam == "Revolution") & tm.in_window(d, w12), q).otherwise(0)).alias("rev_doses"),
        F.sum(F.when(ok & (fam == "Advantage Multi") & tm.in_window(d, w12), q).otherwise(0)).alias("adv_doses"),
    ]


def product_metrics(t: Tables, ctx: RunContext, lines: DataFrame | None = None) -> DataFrame:
    """Per client and product set: last purchase, purchases, revenue and
    doses in the last 12 months and the 12 before, species of the pet at
    the last purchase; plus Interceptor / Trifexis / Revolution /
    Advantage Multi doses. One aggregation pass."""
    x = lines if lines is not None else consumer_lines(t, ctx)
    x = x.where(F.col("is_fth"))
    q = F.col("quantity_norm")
    w12, w24 = ctx.trailing(0), ctx.trailing(1)
    extra = other_fth_aggs(ctx)
    out = tm.tagged_metrics(
        x, ["client_id"], product_tags(), {"12": w12, "24": w24},
        revenue=F.when(q.isNull(), F.lit(0)).otherwise(F.col("cost")),
        doses=F.when(q.isNull(), F.lit(1)).otherwise(q),
        last_at=line_at(), extra=extra,
    )
    return out.select(
        *[F.col(c).cast("double").alias(c) if "_rev_" in c else F.col(c) for c in out.columns]
    )


# ------------------------------------------------------------------ CO8
def patient_counts(t: Tables, ctx: RunContext, lines: DataFrame | None = None,
                   cp: DataFrame | None = None) -> DataFrame:
    """Distinct dog/cat patients with flea/tick or heartworm purchases in
    the last 12 months, per clinic of the patient."""
    cp = cp if cp is not None else consumer_patients(t, ctx)
    x = lines if lines is not None else consumer_lines(t, ctx, cp)
    lo, hi = ctx.trailing(0)
    f = x.where(F.col("is_fth") & F.col("invoice_date").between(F.lit(lo), F.lit(hi))).select(
        "patient_id", "type").distinct()
    j = cp.select("patient_id", "h_id", "vi_species_id").join(f, "patient_id", "left")
    s, typ, pid = F.col("vi_species_id"), F.col("type"), F.col("patient_id")
    return j.groupBy("h_id").agg(
        F.countDistinct(F.when((s == DOG) & typ.isin("ft", "f"), pid)).alias("ft_canine_patients"),
        F.countDistinct(F.when((s == CAT) & typ.isin("ft", "f"), pid)).alias("ft_feline_patients"),
        F.countDistinct(F.when((s == DOG) & (typ == "h"), pid)).alias("hw_canine_patients"),
    )


# ------------------------------------------------------------ CO18-19
def competitor_products(t: Tables, ctx: RunContext, lines: DataFrame | None = None) -> DataFrame:
    """Competitor flea/tick and heartworm products per client in the last
    12 months, ranked by (doses, last date, last line) ascending. One pass:
    the market is a row attribute (the two product sets are disjoint)."""
    x = lines if lines is not None else consumer_lines(t, ctx)
    lo, hi = ctx.trailing(0)
    p, typ = F.col("product"), F.col("type")
    market = (F.when(~p.startswith("Frontline") & ~p.startswith("Certifect") & typ.isin("ft", "f"), F.lit("FL"))
              .when(~p.startswith("Heartgard") & (typ == "h"), F.lit("HG")))
    x = x.where(F.col("is_fth") & F.col("invoice_date").between(F.lit(lo), F.lit(hi))).withColumn("market", market)
    x = x.where(F.col("market").isNotNull())
    q = F.col("quantity_norm")
    doses = F.when(q.isNull() | (q == 0), F.lit(1)).otherwise(q)
    g = x.groupBy("market", "client_id", "product").agg(
        F.sum(doses).alias("doses"), F.max("invoice_date").alias("last_date"),
        F.max(F.struct(*[F.col(c) for c in LINE_ID])).alias("last_id"),
        F.max("family_name").alias("family_name"))  # product -> family is functional
    w = Window.partitionBy("market", "client_id").orderBy("doses", "last_date", "last_id")
    return g.select(
        "market", "client_id", F.col("family_name").alias("product"), F.col("product").alias("product_detail"),
        F.col("doses").cast("long").alias("doses"), "last_date", F.rank().over(w).cast("long").alias("product_order"),
    )


# ------------------------------------------------------------ CO20-CO27
def service_categories() -> dict:
    """The categories of services; ``other`` is what is in none of the named
    ones (general services, NSAIDs, vaccines) and no purchase of a flea, tick
    or heartworm product."""
    info, kind = F.col("product_info"), F.col("service_kind")
    general_named = (
        (kind == "general") & (info.like("Surgery%") | F.lower(info).like("%dental%")
                               | F.lower(info).isin("service - boarding", "service - grooming"))
    )
    return {
        "pain": kind == "nsaid",
        "dental": (kind == "general") & (info == "Surgery - dental"),
        "surg": (kind == "general") & info.like("Surgery%") & (info != "Surgery - dental"),
        "vacc": kind == "vaccine",
        "board": (kind == "general") & (F.lower(info) == "service - boarding"),
        "groom": (kind == "general") & (F.lower(info) == "service - grooming"),
        "other": ~F.coalesce(general_named, F.lit(False)) & ~F.coalesce(kind.isin("nsaid", "vaccine"), F.lit(False)),
    }


def service_tags() -> dict:
    """The categories of paid lines."""
    paid = F.col("cost") != 0
    return {tag: paid & pred & (~F.col("is_fth") if tag == "other" else F.lit(True)) for tag, pred in service_categories().items()}


def service_aggs(ctx: RunContext, within=None) -> list:
    """Aggregates of the service-category stage; ``within`` restricts every
    aggregate to a row subset (used when fused with other stages)."""
    end = ctx.end_date
    d = F.col("invoice_date")
    w14 = (add_months(end, -14), end)
    ok = within if within is not None else F.lit(True)
    aggs = []
    for tag, pred in service_tags().items():
        pred = ok & pred
        hit = pred & tm.in_window(d, w14)
        aggs += [
            F.count(F.when(hit, F.lit(1))).alias(f"num_{tag}_purch"),
            F.max(F.when(pred, d)).alias(f"last_{tag}_purch"),
            F.coalesce(F.sum(F.when(hit, F.col("cost"))), F.lit(0)).cast("double").alias(f"dollar_{tag}_purch"),
        ]
    v_lo = add_months(end, -12)
    aggs += [
        F.countDistinct(F.when(ok & d.between(F.lit(v_lo), F.lit(end - timedelta(days=1))), d)).alias("num_visits"),
        F.max(F.when(ok, d)).alias("last_visit"),
    ]
    return aggs


def service_metrics(t: Tables, ctx: RunContext, lines: DataFrame | None = None) -> DataFrame:
    """Per client: for each service category, purchases and spend in the
    last 14 months and the last purchase in 24; visits in the last 12
    months and the last visit. One aggregation pass."""
    x = lines if lines is not None else consumer_lines(t, ctx)
    return x.where(F.col("is_trans")).groupBy("client_id").agg(*service_aggs(ctx))


# ------------------------------------------------------------ CO2-CO5
def consumer_clients(t: Tables, ctx: RunContext, cp: DataFrame | None = None,
                     split: DataFrame | None = None) -> DataFrame:
    """Clients of the consumer patients: household roll-up (HH1), cleansed
    contact fields (CL1), minus the deny list (DN1) and excluded regions.
    With a split list (CO2), a clinic that has one keeps only its listed
    clients; clinics without a list keep all."""
    cp = cp if cp is not None else consumer_patients(t, ctx)
    s, pid = F.col("vi_species_id"), F.col("patient_id")
    hh = tm.household(cp, ["client_id"], [
        F.max("dogs_over_6").alias("dogs_over_6"),
        F.sum("dogs_over_4").alias("dogs_over_4"),
        F.max("puppy").alias("puppy"),
        F.countDistinct(F.when(s == DOG, pid)).alias("canines"),
        F.countDistinct(F.when(s == CAT, pid)).alias("felines"),
        F.min("first_active").alias("first_visit"),
    ])
    c = b.clients(t).join(hh, "client_id")
    if split is not None:
        c = apply_split(c, split)
    out = c.select(
        "client_id", "h_id",
        cl.clean_name(F.col("first_name")).alias("first_name"),
        cl.clean_name(F.col("last_name")).alias("last_name"),
        cl.clean_title(F.col("title")).alias("prefix"),
        cl.clean_address(F.col("address1"), cl.NONE_GIVEN).alias("address1"),
        cl.clean_address(F.col("address2")).alias("address2"),
        cl.clean_control(F.col("city")).alias("city"),
        cl.clean_control(F.col("state")).alias("state"),
        cl.clean_zip(F.col("postal_code")).alias("postal_code"),
        cl.clean_phone(F.col("phone1")).alias("phone1"),
        "primary_email",
        "dogs_over_6", F.col("dogs_over_4").cast("long").alias("dogs_over_4"), "puppy",
        "canines", "felines", "first_visit",
    )
    return out.where(
        ~cl.denied_client(F.col("first_name"), F.col("last_name"), F.col("address1"), F.col("address2"))
        & ~cl.excluded_region(F.col("state"))
    )


def apply_split(clients: DataFrame, split: DataFrame) -> DataFrame:
    """CO2 / LD3: a clinic with a split list keeps only its listed clients;
    clinics without a list keep all."""
    has_list = maybe_broadcast(split.select("h_id").distinct().withColumn("_split", F.lit(True)))
    listed = split.select("h_id", F.col("pms_client_id").alias("client_id"), F.lit(True).alias("_listed"))
    return (clients.join(has_list, "h_id", "left").join(listed, ["h_id", "client_id"], "left")
            .where(F.col("_split").isNull() | F.col("_listed").isNotNull()).drop("_split", "_listed"))


# ------------------------------------------------------------------ CO30
def client_services(t: Tables, ctx: RunContext, cp: DataFrame, lines: DataFrame | None = None) -> DataFrame:
    """Level 1 of the report: one row per client and service, with what every
    stage needs of its lines. Sets of products and categories of services are
    properties of the service, so they are told apart on these rows (level 2),
    not line by line. Days of visits are kept as bits of ``VISIT_WORDS`` longs."""
    end = ctx.end_date
    if lines is None:
        lines = b.lines(t, add_months(end, -24), end, cp.select("patient_id", "vi_species_id")).where(~F.col("voided"))
    d, q, cost = F.col("invoice_date"), F.col("quantity_norm"), F.col("cost")
    bought = (q != 0) & (d >= F.lit(add_months(end, -23)))  # with a product type: is_fth
    trans = d < F.lit(end - timedelta(days=1))
    paid = trans & (cost != 0)
    w14 = tm.in_window(d, (add_months(end, -14), end))
    aggs = [F.max(F.when(bought, line_at())).alias("at")]
    for w, bounds in (("12", ctx.trailing(0)), ("24", ctx.trailing(1))):
        hit = bought & tm.in_window(d, bounds)
        aggs += [F.count(F.when(hit, d)).alias(f"purch_{w}"), F.sum(F.when(hit, cost)).alias(f"rev_{w}"), F.sum(F.when(hit, q)).alias(f"doses_{w}")]
    in_12 = bought & tm.in_window(d, ctx.trailing(0))
    number = F.col("l_orderkey").cast("decimal(19,0)") * F.lit(Decimal(10**10)) + F.col("l_linenumber").cast("decimal(10,0)")
    aggs += [F.max(F.when(in_12, d)).alias("last_12"), F.max(F.when(in_12, number)).alias("last_line_12")]
    for name, rows in (("any", paid), ("unbought", paid & ~bought)):
        aggs += [F.count(F.when(rows & w14, F.lit(1))).alias(f"{name}_n"), F.max(F.when(rows, d)).alias(f"{name}_last"),
                 F.sum(F.when(rows & w14, cost)).alias(f"{name}_cost")]
    first = add_months(end, -12)
    bit = F.datediff(d, F.lit(first))
    visit = trans & d.between(F.lit(first), F.lit(end - timedelta(days=1)))
    for i in range(VISIT_WORDS):
        word = F.when(visit & (F.floor(bit / 64) == i), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(bit, F.lit(64))))
        aggs.append(F.bit_or(word).alias(f"visits_{i}"))
    aggs.append(F.max(F.when(trans, d)).alias("last_visit"))
    return lines.groupBy("client_id", "service_id").agg(*aggs)


VISIT_WORDS = 6  # 12 months have at most 366 days


def client_metrics(t: Tables, ctx: RunContext, cp: DataFrame, lines: DataFrame | None = None) -> DataFrame:
    """Level 2: one row per client with its product sets (CO9-CO17), rank-1
    competitor products (CO18-CO19) and service categories (CO20-CO27), equal
    to the stages' own queries. One scan of the lines; from level 1 on, a
    client's rows (at most one a service) stay together."""
    prod = b.products(t).select("service_id", "product", "family_name", "type", "service_kind", "product_info")
    x = client_services(t, ctx, cp, lines).join(maybe_broadcast(prod), "service_id", "left").repartition("client_id")
    p, typ, fam = F.col("product"), F.col("type"), F.col("family_name")
    market = (F.when(~p.startswith("Frontline") & ~p.startswith("Certifect") & typ.isin("ft", "f"), F.lit("FL"))
              .when(~p.startswith("Heartgard") & (typ == "h"), F.lit("HG")))
    x = x.withColumn("market", F.when(F.col("purch_12") > 0, market))
    same = Window.partitionBy("client_id", "market", "product", "family_name")
    x = x.select("*", F.sum("doses_12").over(same).alias("_doses"), F.max("last_12").over(same).alias("_last"),
                 F.max(F.struct("last_line_12", "service_id")).over(same).alias("_line"))
    x = x.withColumn("_rank", F.rank().over(Window.partitionBy("client_id", "market").orderBy("_doses", "_last", "_line")))

    aggs = []
    for tag, pred in product_tags().items():
        pred = typ.isNotNull() & pred
        at = F.max(F.when(pred, F.col("at")))
        aggs += [tm.packed_day(at).alias(f"last_{tag}_purch"), tm.packed_value(at).alias(f"{tag}_last_pet_species")]
        for w in ("12", "24"):
            aggs.append(F.coalesce(F.sum(F.when(pred, F.col(f"purch_{w}"))), F.lit(0)).alias(f"{tag}_purch_{w}"))
            aggs += [F.sum(F.when(pred, F.col(f"{m}_{w}"))).alias(f"{tag}_{m}_{w}") for m in ("rev", "doses")]
    for name, pred, w in (("int_doses_12", p.startswith("Interceptor"), "12"), ("int_doses_24", p.startswith("Interceptor"), "24"),
                          ("trif_doses", fam == "Trifexis", "12"), ("rev_doses", fam == "Revolution", "12"), ("adv_doses", fam == "Advantage Multi", "12")):
        aggs.append(F.coalesce(F.sum(F.when(typ.isNotNull() & pred, F.col(f"doses_{w}"))), F.lit(0)).alias(name))
    for tag, pred in service_categories().items():
        # lines of a typed product are "other" unless they are purchases of it
        part = lambda m: F.when(typ.isNotNull(), F.col(f"unbought_{m}")).otherwise(F.col(f"any_{m}")) if tag == "other" else F.col(f"any_{m}")  # noqa: B023, E731
        aggs += [F.coalesce(F.sum(F.when(pred, part("n"))), F.lit(0)).alias(f"num_{tag}_purch"),
                 F.max(F.when(pred, part("last"))).alias(f"last_{tag}_purch"),
                 F.coalesce(F.sum(F.when(pred, part("cost"))), F.lit(0)).cast("double").alias(f"dollar_{tag}_purch")]
    days = [F.bit_count(F.coalesce(F.bit_or(f"visits_{i}"), F.lit(0).cast("long"))) for i in range(VISIT_WORDS)]
    aggs += [sum(days[1:], days[0]).cast("long").alias("num_visits"), F.max("last_visit").alias("last_visit")]
    aggs += [F.max(F.when((F.col("_rank") == 1) & (F.col("market") == m), F.col("service_id"))).alias(f"_{m}") for m in ("FL", "HG")]
    out = x.groupBy("client_id").agg(*aggs)
    for m in ("FL", "HG"):
        name = prod.select(F.col("service_id").alias(f"_{m}"), F.col("family_name").alias(f"comp_{m.lower()}_product"))
        out = out.join(maybe_broadcast(name), f"_{m}", "left").drop(f"_{m}")
    return out


def _report_base(t: Tables, ctx: RunContext, cp: DataFrame | None = None, lines: DataFrame | None = None) -> DataFrame:
    cp = cp if cp is not None else consumer_patients(t, ctx)
    cli = consumer_clients(t, ctx, cp)
    from .nsaid import consumer_nsaid_metrics

    prev = consumer_nsaid_metrics(t, ctx, cp=cp)
    return cli.join(client_metrics(t, ctx, cp, lines), "client_id", "left").join(prev, "client_id", "left")


def consumer_report(t: Tables, ctx: RunContext) -> DataFrame:
    """Detail rows of the consumer file: cleansed client, household counts,
    product-set and service-category metrics; counts default to 0, money
    as text with two decimals, dates as mm/dd/yyyy, email only if valid."""
    return _format_detail(_report_base(t, ctx))


def _format_detail(r: DataFrame) -> DataFrame:
    cols = [
        F.lit("1DT").alias("record_type"), "client_id", "h_id", "prefix", "first_name", "last_name",
        "address1", "address2", "city", "state", "postal_code", "phone1",
        cl.valid_email(F.col("primary_email")).alias("email"),
        "canines", "felines", "dogs_over_6", "dogs_over_4", "puppy", mdy("first_visit").alias("first_visit"),
    ]
    for tag in product_tags():
        cols += [
            mdy(f"last_{tag}_purch").alias(f"last_{tag}_purch"),
            F.coalesce(F.col(f"{tag}_purch_12"), F.lit(0)).alias(f"{tag}_purch_12"),
            F.coalesce(F.col(f"{tag}_purch_24"), F.lit(0)).alias(f"{tag}_purch_24"),
            money_text(F.coalesce(F.col(f"{tag}_rev_12"), F.lit(0.0))).alias(f"{tag}_rev_12"),
            money_text(F.coalesce(F.col(f"{tag}_rev_24"), F.lit(0.0))).alias(f"{tag}_rev_24"),
            F.greatest(F.coalesce(F.col(f"{tag}_doses_12"), F.lit(0)), F.lit(0)).cast("long").alias(f"{tag}_doses_12"),
            F.greatest(F.coalesce(F.col(f"{tag}_doses_24"), F.lit(0)), F.lit(0)).cast("long").alias(f"{tag}_doses_24"),
        ]
        cols.append(F.col(f"{tag}_last_pet_species").alias(f"{tag}_last_pet_species"))
    for tag in service_tags():
        cols += [
            F.coalesce(F.col(f"num_{tag}_purch"), F.lit(0)).alias(f"num_{tag}_purch"),
            mdy(f"last_{tag}_purch").alias(f"last_{tag}_purch"),
            money_text(F.coalesce(F.col(f"dollar_{tag}_purch"), F.lit(0.0))).alias(f"dollar_{tag}_purch"),
        ]
    cols += [F.coalesce(F.col("num_visits"), F.lit(0)).alias("num_visits"), mdy("last_visit").alias("last_visit")]
    cols += [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
             for c in ("int_doses_12", "int_doses_24", "trif_doses", "rev_doses", "adv_doses")]
    cols += ["comp_fl_product", "comp_hg_product", mdy("last_prev_purch").alias("last_prev_purch")]
    cols += [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
             for c in ("prev_purch_12", "prev_purch_24", "prev_doses_12", "prev_doses_24", "prev_pats_12")]
    cols += [money_text(F.coalesce(F.col(c), F.lit(0.0))).alias(c) for c in ("prev_rev_12", "prev_rev_24")]
    cols += [F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in ("prev_pills_12", "prev_pills_24")]
    cols.append("prev_last_pet_species")
    return r.select(*cols)


# ------------------------------------------------------------ CO31-CO33
# fixed values: words of notes in address line 2; shapes of card and phone numbers there
ADDRESS2_NOTE_WORDS = [
    "SEND", "BROTHER", "DON'T", "INVOICE", "SISTER", "CASH", "EMERGENCY", "LAND LINE", "TEMPORARY", "CELL",
    "EMPLOYEE", "MAIL", "UNABLE", "CHANGE", "FATHER", "MESSAGE", "UNDELIVERABLE", "CHECK", "FAX", "MOM",
    "UPDATE", "COLLECTIONS", "FILE", "MOTHER", "VERIFY", "CONFIRM", "FORWARD", "NEED", "WIFE", "HUSBAND",
    "DISCARDED", "!",
]
CARD_IN_TEXT = r"[0-9]{16}|[0-9]{4}\s[0-9]{4}\s[0-9]{4}\s[0-9]{4}|[0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{4}"
PHONE_IN_TEXT = r"[0-9]{10}|[0-9]{3}\s[0-9]{3}\s[0-9]{4}|[0-9]{3}-[0-9]{3}-[0-9]{4}"


def _zero(c: str):
    return F.coalesce(F.col(c), F.lit(0)) == 0


def consumer_file(t: Tables, ctx: RunContext, cp: DataFrame | None = None,
                  lines: DataFrame | None = None, materialize=None) -> DataFrame:
    """The consumer file: detail rows after exclusion A (clients whose only
    activity is boarding or grooming) and exclusion B (placeholder names
    and addresses, do-not-contact notes, phone or card numbers in address
    line 2), plus one '1HD' header per clinic whose record count is
    details + 1 and which carries the clinic's patient counts."""
    cp = cp if cp is not None else consumer_patients(t, ctx)
    lines = lines if lines is not None else consumer_lines(t, ctx, cp)
    r = _report_base(t, ctx, cp, lines)
    only_board_groom = (
        _zero("flt_rev_12") & F.col("last_vacc_purch").isNull() & F.col("last_pain_purch").isNull()
        & F.col("last_dental_purch").isNull() & F.col("last_surg_purch").isNull() & F.col("last_other_purch").isNull()
        & _zero("combo_rev_12") & _zero("combo_rev_24") & _zero("comp_hg_rev_12") & _zero("comp_hg_rev_24")
        & _zero("hg_rev_12") & _zero("hg_rev_24") & _zero("comp_fl_rev_12") & _zero("comp_fl_rev_24")
        & _zero("fl_rev_12") & _zero("fl_rev_24") & _zero("ce_rev_12")
        & (F.col("last_board_purch").isNotNull() | F.col("last_groom_purch").isNotNull())
    )
    a1, a2 = F.col("address1"), F.col("address2")
    a2_digits = F.length(F.regexp_replace(a2, "[^0-9]", ""))
    bad_contact = (
        (F.col("first_name") == cl.NONE_GIVEN) | (F.col("last_name") == cl.NONE_GIVEN)
        | (a1 == " ") | (a1 == cl.NONE_GIVEN) | a1.contains("*") | a2.contains("*")
        | cl._contains_any(a2, ADDRESS2_NOTE_WORDS)
        | a2_digits.isin(10, 16) | a2.rlike(CARD_IN_TEXT) | a2.rlike(PHONE_IN_TEXT)
        | ((F.upper(F.col("first_name")) == "CASH") & F.upper(F.col("last_name")).isin("CLIENT", "CASH"))
    )
    kept = r.where(~F.coalesce(only_board_groom, F.lit(False)) & ~F.coalesce(bad_contact, F.lit(False)))
    detail = _format_detail(kept)
    if materialize is not None:  # report runs: compute the detail once, count from it
        detail = materialize(detail)
    counts = patient_counts(t, ctx, lines, cp)
    clin = maybe_broadcast(b.clinics(t).select("h_id", "account_number", "location_number", "clinic_name", "state"))
    n = detail.groupBy("h_id").agg(F.count(F.lit(1)).alias("_n"))
    heads = clin.join(n, "h_id").join(counts, "h_id", "left").select(
        F.lit("1HD").alias("record_type"),
        F.lit(ctx.as_of.strftime("%Y/%m/%d")).alias("first_name"),
        (F.col("_n") + 1).cast("string").alias("last_name"),
        F.col("account_number").alias("prefix"),
        F.col("location_number").cast("string").alias("address1"),
        F.substring("clinic_name", 1, 40).alias("address2"),
        F.col("state"),
        F.col("ft_canine_patients").cast("string").alias("last_hg_purch"),
        F.col("hw_canine_patients").cast("string").alias("last_ce_purch"),
        F.col("ft_feline_patients").cast("string").alias("last_fl_purch"),
        "h_id",
    )
    return detail.unionByName(heads, allowMissingColumns=True)


def consumer_clients_split(t: Tables, ctx: RunContext) -> DataFrame:
    """CO2: the split-location variant of the consumer client list."""
    return consumer_clients(t, ctx, split=b.split_clients(t))
