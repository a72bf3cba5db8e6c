"""Binding of the supplied star schema to the logical tables of the reports.

The report logic speaks of clinics, patients, clients, products and invoice
lines. The supplied Parquet tables are a TPC-H-like star schema, so this
module maps them onto that vocabulary once; every report reads only these
functions. The same mapping is written in SQL in ``dosewise.checks.oracle``.

Windows of lines prune the months of the line fact; those of orders and events
are applied to the raw columns, so that the bound reaches the Parquet scan
(``PushedFilters``) instead of sitting above a cast.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .facts import LINE_KEY, MONTH, month_of
from .tables import Tables

# --- fixed values of the binding (our own mapping, not reference data) ---
# Recommended yearly doses; clinic n takes REC_LEVELS[(n + k) % 4] for the
# k-th of (ft dog, hw dog, ft cat, hw cat).
REC_LEVELS = [12, 6, 3, 1]
# Two-letter state code of clinic n (= nation key n).
STATE_CODES = [
    "NY", "CA", "ON", "TX", "FL", "BC", "WA", "IL", "QC", "PA", "OH", "PR", "GA",
    "NC", "MI", "AB", "NJ", "VA", "AZ", "MA", "NS", "TN", "IN", "MO", "MB",
]
# Market segment -> species id (3 dog, 7 cat, 5 other).
SPECIES_BY_SEGMENT = {"AUTOMOBILE": 3, "BUILDING": 3, "FURNITURE": 7, "HOUSEHOLD": 7}
# Part type -> flea/tick/heartworm product type.
FTH_TYPE_BY_PTYPE = {"SMALL": "ft", "ECONOMY": "f", "MEDIUM": "fh", "LARGE": "h"}
# STANDARD parts are clinic services; the noun of p_name picks the kind.
SERVICE_BY_NOUN = {
    "widget": ("vaccine", "Vaccine"),
    "bolt": ("vaccine", "Vaccine"),
    "plate": ("general", "Surgery - dental"),
    "rod": ("general", "Surgery - spay"),
    "gear": ("general", "Service - Boarding"),
    "ring": ("general", "Service - Grooming"),
    "gizmo": ("diet", "Diet"),
    "anvil": ("test", "Heartworm test"),
}
# The 35 flea/tick/heartworm product families of the
# purchase extracts, in the order the reference lists them.
FTH_FAMILIES = [
    "Activyl", "Acuguard", "Adams", "Advantage", "Advantage Multi", "Advantix", "Assurity",
    "Capstar", "Certifect", "ComboGuard", "Comfortis", "EasySpot", "Frontline", "Heartgard",
    "Interceptor", "Iverhart Max", "Iverhart Plus", "Paradyne", "Parastar", "Preventic",
    "Program", "Proheart", "ProMeris", "QuadriGuard", "Revolution", "Sentinel", "Seresto",
    "SimpleGuard", "Trifexis", "Tri-Heart", "Tritak", "Vectra", "Vectra 3D", "NexGard", "Bravecto",
]
# Binding rule: brand n of a flea/tick/heartworm part belongs to family
# FTH_FAMILIES[(3n + 5) % 35]; its product name is the family (Tritak is
# sold as 'Frontline Tritak') followed by the part name.
FAMILY_STEP, FAMILY_OFFSET = 3, 5
# PROMO parts are NSAID medications (service type 2).
NSAID_PTYPE = "PROMO"
FIRST_DOB = date(1990, 1, 1)
# Event types standing in for appointments, surgeries, NSAID sales, vitals.
APPOINTMENT_EVENT = "signup"
SURGERY_EVENT = "error"
NSAID_SALE_EVENT = "purchase"
VITALS_EVENT = "view"
WEIGHT_UNITS = ["lbs", "pounds", "Ounces", "kilograms", "grams", "stone"]
# Events are dated January 2024; orders end in 2001. Event days are moved
# back by a fixed number of days so January 2024 lands on June 2001, the
# last full month of the default run, and both streams share one timeline.
EVENT_SHIFT_DAYS = (date(2024, 1, 1) - date(2001, 6, 1)).days
# The NSAID products of the purchase file; sale events cycle
# through them plus one product outside the list.
NSAID_PRODUCTS = [
    "Novox", "Deramaxx", "Previcox", "Etogesic", "Zubrin", "Onsior", "Vetprofen",
    "Rimadyl Caplet", "Rimadyl Chewable Tablet", "Carprofen",
]
NSAID_EXTRA_PRODUCT = "Metacam"
# Binding rule for the last-dose NSAID product list: a product with a
# non-zero minimum dosage volume needs a non-zero quantity; here every
# second product of the list (by position) has min_dvv = 1.
NSAID_MIN_DVV = {p: (i % 2) for i, p in enumerate(NSAID_PRODUCTS)}
# Surgery families (k % 10 of the event) that excuse short NSAID courses.
EXCUSED_SURGERY_FAMILIES = [0, 1, 2, 3, 4, 5, 6]


def _map(col: Column, mapping: dict, default=None) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(col == F.lit(k), F.lit(v)) if expr is None else expr.when(col == F.lit(k), F.lit(v))
    return expr.otherwise(F.lit(default)) if default is not None else expr


def _pick(values: list, idx: Column) -> Column:
    """values[idx] for a non-negative integer column (0-based)."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + F.lit(1)).cast("int"))


def ts_lit(d: date | Column) -> Column:
    """A date bound (a scalar subquery, too) usable against the TIMESTAMP_NTZ
    columns of the source."""
    return (d if isinstance(d, Column) else F.lit(d)).cast("timestamp_ntz")


# ---------------------------------------------------------------- clinics
def clinics(t: Tables) -> DataFrame:
    """One row per clinic (nation): ids, state, dose recommendations.

    Bounded by the number of clinics, so callers may broadcast it."""
    n = F.col("n_nationkey").cast("long")
    nation = t.nation if t.clinics is None else t.nation.where(F.col("n_nationkey").isin(*t.clinics))
    reg = t.region.select("r_regionkey", "r_name")
    return (
        nation.join(reg, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select(
            n.alias("h_id"),
            (F.lit(1000) + n).alias("location_number"),
            F.col("n_name").alias("clinic_name"),
            F.col("r_name").alias("region_name"),
            _pick(STATE_CODES, n % len(STATE_CODES)).alias("state"),
            _pick(REC_LEVELS, n % 4).alias("dose_rec_ft_dog"),
            _pick(REC_LEVELS, (n + 1) % 4).alias("dose_rec_hw_dog"),
            _pick(REC_LEVELS, (n + 2) % 4).alias("dose_rec_ft_cat"),
            _pick(REC_LEVELS, (n + 3) % 4).alias("dose_rec_hw_cat"),
            F.date_add(F.lit(date(2001, 1, 1)), (n * 5).cast("int")).alias("start_date"),
            F.concat(F.lit("ACC"), F.lpad(n.cast("string"), 5, "0")).alias("account_number"),
        )
    )


# --------------------------------------------------------------- patients
def species_of(segment: Column) -> Column:
    return _map(segment, SPECIES_BY_SEGMENT, 5).cast("int")


def _in_scope(t: Tables) -> DataFrame:
    """Customers; in a scoped run the households with a member at its clinics, whole."""
    c = t.customer
    if t.clinics is None:
        return c
    head = F.floor(F.col("c_custkey") / 3).cast("long") * 3
    ours = c.where(F.col("c_nationkey").isin(*t.clinics)).select(head.alias("head")).distinct()
    return c.join(ours.select(F.explode(F.sequence("head", F.col("head") + 2)).alias("c_custkey")), "c_custkey", "left_semi")


def patients(t: Tables, species: tuple | None = None) -> DataFrame:
    """patient_ref: one row per customer. ``species`` restricts to those
    species ids through a filter on the raw segment column, so the
    restriction reaches the Parquet scan."""
    k = F.col("c_custkey")
    c = _in_scope(t)
    if species is not None:
        segs = [s for s, sp in SPECIES_BY_SEGMENT.items() if sp in species]
        c = c.where(F.col("c_mktsegment").isin(*segs)) if 5 not in species else c
    return c.select(
        k.alias("patient_id"),
        F.floor(k / 3).cast("long").alias("client_id"),
        F.col("c_nationkey").cast("long").alias("h_id"),
        species_of(F.col("c_mktsegment")).alias("vi_species_id"),
        F.date_add(F.lit(FIRST_DOB), ((k * 37) % 3650).cast("int")).alias("dob"),
        (F.col("c_acctbal") >= 0).alias("is_active"),
        ((k % 17) == 0).alias("is_deceased"),
        F.col("c_name").alias("pet_name"),
        F.when((k % 7) == 0, F.lit(None).cast("long")).otherwise(k % 6).alias("pms_code"),
    )


def patient_activity(t: Tables) -> DataFrame:
    """First and last invoice day per patient (from all orders)."""
    return t.orders.groupBy(F.col("o_custkey").alias("patient_id")).agg(
        F.min("o_orderdate").cast("date").alias("first_active"),
        F.max("o_orderdate").cast("date").alias("last_active"),
    )


TITLES = ["Mr.", "Mrs", "Dr", "Ms.", "Mr 3rd", ""]
ADDRESS2_NOTES = ["", "Apt 4", "Do not mail", "", "Suite 200", "moved away", "", "c/o dead letter"]


def clients(t: Tables) -> DataFrame:
    """Client master: the customer whose key is 3 * client_id carries the
    contact fields of the household."""
    k = F.col("c_custkey")
    n = F.col("c_nationkey")
    c = _in_scope(t).where((k % 3) == 0)
    return c.select(
        (k / 3).cast("long").alias("client_id"),
        n.cast("long").alias("h_id"),
        F.col("c_name").alias("last_name"),
        F.split(F.col("c_name"), "#").getItem(0).alias("first_name"),
        _pick(TITLES, k % len(TITLES)).alias("title"),
        F.concat((k % 997).cast("string"), F.lit(" Main St")).alias("address1"),
        _pick(ADDRESS2_NOTES, k % len(ADDRESS2_NOTES)).alias("address2"),
        F.concat(F.lit("City "), n.cast("string")).alias("city"),
        _pick(STATE_CODES, n % len(STATE_CODES)).alias("state"),
        F.concat(F.lpad(((k * 7919) % 100000).cast("string"), 5, "0"), F.lit("-"),
                 F.lpad((k % 10000).cast("string"), 4, "0")).alias("postal_code"),
        F.concat(F.lit("(555) "), F.lpad((k % 1000).cast("string"), 3, "0"), F.lit("-"),
                 F.lpad((k % 10000).cast("string"), 4, "0")).alias("phone1"),
        F.when((k % 11) == 0, F.concat(F.lit("client"), k.cast("string"), F.lit(".example.com")))
        .otherwise(F.concat(F.lit("client"), k.cast("string"), F.lit("@example.com"))).alias("primary_email"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
        F.when((k % 13) == 0, F.lit("0")).otherwise(F.lit("1")).alias("enabled"),
        F.when((k % 9) == 0, F.lit(None).cast("long")).otherwise(k % 5).alias("pms_client_code"),
    )


# --------------------------------------------------------------- products
def brand_number(brand: Column) -> Column:
    return F.regexp_extract(brand, r"(\d+)$", 1).cast("int")


def fth_family(brand: Column) -> Column:
    n = brand_number(brand)
    return _pick(FTH_FAMILIES, (n * FAMILY_STEP + FAMILY_OFFSET) % len(FTH_FAMILIES))


def products(t: Tables) -> DataFrame:
    """Product/service dimension from ``part`` (one row per part)."""
    noun = F.try_element_at(F.split(F.col("p_name"), " "), F.lit(2))
    kind = _map(noun, {k: v[0] for k, v in SERVICE_BY_NOUN.items()}, "general")
    info = _map(noun, {k: v[1] for k, v in SERVICE_BY_NOUN.items()}, "Other")
    fth = _map(F.col("p_type"), FTH_TYPE_BY_PTYPE)
    fam = fth_family(F.col("p_brand"))
    label = F.when(fam == "Tritak", F.lit("Frontline Tritak")).otherwise(fam)
    return t.part.select(
        F.col("p_partkey").alias("service_id"),
        F.when(fth.isNotNull(), F.concat(label, F.lit(" "), F.col("p_name"))).otherwise(F.col("p_name")).alias("product"),
        F.when(fth.isNotNull(), fam).otherwise(F.col("p_brand")).alias("family_name"),
        fth.alias("type"),
        F.when(fth.isNotNull(), F.lit("fth"))
        .when(F.col("p_type") == NSAID_PTYPE, F.lit("nsaid"))
        .otherwise(kind)
        .alias("service_kind"),
        F.when(F.col("p_type") == "STANDARD", info).alias("product_info"),
        F.col("p_size").alias("package_size"),
    )


# ----------------------------------------------------------------- lines
def lines(t: Tables, lo: date | Column | None = None, hi: date | None = None,
          patients: DataFrame | None = None) -> DataFrame:
    """Invoice lines of the line fact (see ``facts``).

    ``lo``/``hi`` restrict the invoice day to [lo, hi): as months they prune
    the fact's partitions, as days they are pushed to its files. In a scoped
    run, so is the clinic of the patient or of the client.

    ``patients`` (keyed by ``patient_id``) is joined to the lines and its
    columns are carried along.
    """
    x = t.line_fact().read()
    if lo is not None:
        lo = lo if isinstance(lo, Column) else F.lit(lo)
        x = x.where((F.col(MONTH) >= month_of(lo)) & (F.col("invoice_date") >= lo))
    if hi is not None:
        last = F.lit(hi - timedelta(days=1))
        x = x.where((F.col(MONTH) <= month_of(last)) & (F.col("invoice_date") < F.lit(hi)))
    if t.clinics is not None:
        x = x.where(F.col("h_id").isin(*t.clinics) | F.col("client_h_id").isin(*t.clinics))
    extra: list[str] = []
    x = x.drop("h_id", "client_h_id", MONTH)
    if patients is not None:
        extra = [c for c in patients.columns if c not in ("patient_id", "client_id")]
        x = x.join(patients.select("patient_id", *extra), "patient_id")
    return x.select(
        *extra, *LINE_KEY, "patient_id", "client_id",
        F.col("l_orderkey").alias("invoice_number"),
        "invoice_date",
        F.col("l_partkey").alias("service_id"),
        "quantity", "quantity_norm", "cost", "voided", "line_seq",
    )


# ---------------------------------------------------------------- events
def _event_day(ts: str = "ts") -> Column:
    return F.date_sub(F.col(ts).cast("date"), EVENT_SHIFT_DAYS)


def _event_ts(ts: str = "ts") -> Column:
    return F.col(ts) - F.expr(f"INTERVAL {EVENT_SHIFT_DAYS} DAYS")


def event_k() -> Column:
    return F.get_json_object(F.col("props"), "$.k").cast("int")


def appointments(t: Tables) -> DataFrame:
    e = t.events.where(F.col("event_type") == APPOINTMENT_EVENT)
    return e.select(F.col("user_id").alias("patient_id"), _event_day().alias("appointment_date"))


def surgeries(t: Tables) -> DataFrame:
    e = t.events.where(F.col("event_type") == SURGERY_EVENT)
    return e.select(
        F.col("user_id").alias("patient_id"),
        _event_day().alias("surgery_date"),
        _event_ts().alias("surgery_ts"),
        (event_k() % 10).alias("surgery_family"),
        F.col("value").cast("decimal(18,2)").alias("cost"),
    )


def nsaid_sales(t: Tables, lo: date | Column | None = None, hi: date | None = None) -> DataFrame:
    """NSAID purchase facts from purchase events: value is the cost, the
    JSON ``k`` the quantity, and the dosage volume comes from the user.
    Days from ``lo`` on and before ``hi`` become bounds on the raw ``ts``,
    which the scan can use."""
    e = t.events.where(F.col("event_type") == NSAID_SALE_EVENT)
    for bound, hit in ((lo, F.col("ts").__ge__), (hi, F.col("ts").__lt__)):
        if bound is not None:
            moved = F.date_add(bound, EVENT_SHIFT_DAYS) if isinstance(bound, Column) else bound + timedelta(days=EVENT_SHIFT_DAYS)
            e = e.where(hit(ts_lit(moved)))
    return e.select(
        F.col("event_id").alias("lineitem_id"),
        F.col("user_id").alias("patient_id"),
        F.floor(F.col("user_id") / 3).cast("long").alias("client_id"),
        _event_day().alias("invoice_date"),
        _event_ts().alias("invoice_ts"),
        event_k().alias("quantity"),
        F.col("value").cast("decimal(18,2)").alias("cost"),
        (F.col("user_id") % 3 + 1).cast("int").alias("dosage_volume"),
        _pick(NSAID_PRODUCTS + [NSAID_EXTRA_PRODUCT], F.col("event_id") % (len(NSAID_PRODUCTS) + 1)).alias("product"),
        (F.col("event_id") % 13 == 0).alias("voided"),
    )


def vitals(t: Tables) -> DataFrame:
    e = t.events.where(F.col("event_type") == VITALS_EVENT)
    return e.select(
        F.col("user_id").alias("patient_id"),
        F.get_json_object(F.col("props"), "$.k").alias("weight"),
        _pick(WEIGHT_UNITS, F.col("event_id") % len(WEIGHT_UNITS)).alias("weight_unit"),
        _event_ts().alias("visit_date"),
        F.col("event_id").alias("vital_id"),
    )


# ------------------------------------------------------------ split lists
def split_clients(t: Tables) -> DataFrame:
    """Clinics whose location is split keep only listed clients: clinics
    with key % 5 = 0 list their clients with id % 4 = 0."""
    c = clients(t)
    return c.where(((F.col("h_id") % 5) == 0) & ((F.col("client_id") % 4) == 0)).select(
        (F.lit(1000) + F.col("h_id")).alias("location_number"), "h_id", F.col("client_id").alias("pms_client_id"))
