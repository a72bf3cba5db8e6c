"""Registry of report queries: name -> (Spark builder, DuckDB oracle SQL).

Each Spark builder takes (spark, sf_dir) and returns a lazy DataFrame over
the whole supplied tables; each oracle is the equivalent DuckDB SQL over the
same Parquet files. Output columns are aliased identically on both sides
and money/ratios are emitted as doubles computed from exact decimals.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..checks import oracle as O
from ..context import DEFAULT_CONTEXT as CTX
from ..sources.tables import Tables
from . import psr

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco


_TABLES: dict = {}


def _t(spark, sf_dir) -> Tables:
    """One reader set per (session, folder): Parquet footers and file
    listings are resolved once and shared by all queries."""
    # the application id changes when a stopped context is recreated, so a
    # recycled session object never gets readers bound to a dead context
    key = (spark.sparkContext.applicationId, id(spark), sf_dir)
    if key not in _TABLES:
        _TABLES[key] = Tables(spark, sf_dir)
    return _TABLES[key]


# ------------------------------------------------------------------ PSR
@register("psr_patient_master", O.psr_patient_master(CTX))
def q_psr_patient_master(spark, sf_dir):
    pm = psr.patient_master(_t(spark, sf_dir), CTX)
    return pm.select(
        "h_id", "location_number", "patient_id", "vi_species_id",
        F.col("ft_doses").cast("long").alias("ft_doses"), F.col("hw_doses").cast("long").alias("hw_doses"),
        F.col("ft_rev").cast("double").alias("ft_rev"), F.col("hw_rev").cast("double").alias("hw_rev"),
        "ft_opp_doses", "hw_opp_doses",
        F.col("total_rev").cast("double").alias("total_rev"), F.col("visits").cast("long").alias("visits"),
        F.col("wellness_care").cast("int").alias("wellness_care"), F.col("baby").cast("int").alias("baby"),
        "ft_visits", "hw_visits", F.col("hw_tests").cast("long").alias("hw_tests"),
    )


@register("psr_t14_missed_revenue", O.psr_t14(CTX))
def q_psr_t14(spark, sf_dir):
    return psr.t14_missed_revenue(_t(spark, sf_dir), CTX)


def _psr(fn_name: str, oracle_fn):
    fn = getattr(psr, fn_name)

    def q(spark, sf_dir):
        return fn(_t(spark, sf_dir), CTX)

    return q, oracle_fn(CTX)


for _name, _fn, _oracle in [
    ("psr_t1_coverage", "t1_coverage", O.psr_t1),
    ("psr_t2_dose_histogram", "t2_dose_histogram", O.psr_t2),
    ("psr_t3_baby_coverage", "t3_baby_coverage", O.psr_t3),
    ("psr_t5_dose_share", "t5_dose_share", O.psr_t5),
    ("psr_t6_doses_per_patient", "t6_doses_per_patient", O.psr_t6),
    ("psr_t7_potential_revenue", "t7_potential_revenue", O.psr_t7),
    ("psr_t8_kpis", "t8_kpis", O.psr_t8),
    ("psr_t10_revenue_share", "t10_revenue_share", O.psr_t10),
    ("psr_t11_trend", "t11_trend", O.psr_t11),
    ("psr_t12_dose_histogram", "t12_dose_histogram", O.psr_t12),
    ("psr_t13a_coarse_histogram", "t13a_coarse_histogram", O.psr_t13a),
    ("psr_t13_rec_histogram", "t13_rec_histogram", O.psr_t13),
]:
    _q, _sql = _psr(_fn, _oracle)
    register(_name, _sql)(_q)


@register("psr_product_master", O.psr_product_master(CTX))
def q_psr_product_master(spark, sf_dir):
    pm2 = psr.product_master(_t(spark, sf_dir), CTX)
    return pm2.select("h_id", "vi_species_id", "family_name", "type", "patients", "doses",
                      F.col("hw_rev").cast("double").alias("hw_rev"), F.col("ft_rev").cast("double").alias("ft_rev"))


@register("psr_month_master", O.psr_month_master(CTX))
def q_psr_month_master(spark, sf_dir):
    return psr.month_master(_t(spark, sf_dir), CTX)


# ------------------------------------------------------------- CONSUMER
from . import consumer  # noqa: E402


@register("consumer_product_metrics", O.consumer_product_metrics(CTX))
def q_consumer_product_metrics(spark, sf_dir):
    return consumer.product_metrics(_t(spark, sf_dir), CTX)


@register("consumer_service_metrics", O.consumer_service_metrics(CTX))
def q_consumer_service_metrics(spark, sf_dir):
    return consumer.service_metrics(_t(spark, sf_dir), CTX)


@register("consumer_patient_counts", O.consumer_patient_counts(CTX))
def q_consumer_patient_counts(spark, sf_dir):
    return consumer.patient_counts(_t(spark, sf_dir), CTX)


@register("consumer_competitor_products", O.consumer_competitor_products(CTX))
def q_consumer_competitor_products(spark, sf_dir):
    return consumer.competitor_products(_t(spark, sf_dir), CTX)


@register("consumer_clients", O.consumer_clients(CTX))
def q_consumer_clients(spark, sf_dir):
    return consumer.consumer_clients(_t(spark, sf_dir), CTX)


@register("consumer_report", O.consumer_report(CTX))
def q_consumer_report(spark, sf_dir):
    return consumer.consumer_report(_t(spark, sf_dir), CTX)


# ---------------------------------------------------------------- NSAID
from . import nsaid  # noqa: E402

for _name, _fn, _oracle in [
    ("consumer_nsaid", nsaid.consumer_nsaid, O.consumer_nsaid),
    ("consumer_nsaid_metrics", nsaid.consumer_nsaid_metrics, O.consumer_nsaid_metrics),
    ("nsaid_patients", nsaid.patients_with_weight, O.nsaid_patients),
    ("last_dose_patients", nsaid.last_dose_patients, O.last_dose_patients),
    ("nsaid_clients", nsaid.nsaid_clients, O.nsaid_clients),
    ("nsaid_purchase_file", nsaid.nsaid_purchase_file, O.nsaid_purchase_file),
]:
    register(_name, _oracle(CTX))((lambda f: lambda spark, sf_dir: f(_t(spark, sf_dir), CTX))(_fn))


# ------------------------------------------------------------------ PPR
from . import ppr  # noqa: E402


@register("ppr_patient_master", O.ppr_patient_master(CTX))
def q_ppr_patient_master(spark, sf_dir):
    pm = ppr.patient_master(_t(spark, sf_dir), CTX)
    return pm.select(
        "time_period", "h_id", "patient_id", "vi_species_id", "month",
        F.col("ft_doses").cast("long").alias("ft_doses"), F.col("hw_doses").cast("long").alias("hw_doses"),
        F.col("ft_rev").cast("double").alias("ft_rev"), F.col("hw_rev").cast("double").alias("hw_rev"),
        "visits", "ft_visits", "hw_visits", F.col("wellness_care").cast("long").alias("wellness_care"))


for _name, _fn, _oracle in [
    ("ppr_product_master", ppr.product_master, O.ppr_product_master),
    ("ppr_t1_pre", ppr.t1_pre, O.ppr_t1_pre),
    ("ppr_t1_trend", ppr.t1_trend, O.ppr_t1),
    ("ppr_t2_histogram", ppr.t2_histogram, O.ppr_t2),
    ("ppr_t4_revenue", ppr.t4_revenue, O.ppr_t4),
    ("ppr_t5_dose_share", ppr.t5_dose_share, O.ppr_t5),
]:
    register(_name, _oracle(CTX))((lambda f: lambda spark, sf_dir: f(_t(spark, sf_dir), CTX))(_fn))


# ------------------------------------------------------------ LAST DOSE
from . import last_dose  # noqa: E402

for _name, _fn, _oracle in [
    ("last_dose_start", last_dose.incremental_start, O.last_dose_start),
    ("last_dose_clients", last_dose.last_dose_clients, O.last_dose_clients),
    ("last_dose_file", last_dose.last_dose_file, O.last_dose_file),
    ("last_dose_newly_inactive", last_dose.newly_inactive, O.newly_inactive),
]:
    register(_name, _oracle(CTX))((lambda f: lambda spark, sf_dir: f(_t(spark, sf_dir), CTX))(_fn))


# ---------------------------------------------------------- dims / text
from . import admin, text  # noqa: E402

for _name, _fn, _oracle in [
    ("merge_enrollment", admin.merge_enrollment, O.merge_enrollment),
    ("refresh_enrollment", admin.refresh_enrollment, O.refresh_enrollment),
    ("run_states", admin.run_states, O.run_states),
    ("readiness_profile", admin.readiness, O.readiness),
    ("wellness_by_keywords", text.wellness_by_keywords, O.wellness_by_keywords),
    ("pii_shapes", text.pii_shapes, O.pii_shapes),
    ("recipient_lists", text.recipient_lists, O.recipient_lists),
    ("token_profile", text.token_profile, O.token_profile),
]:
    register(_name, _oracle(CTX))((lambda f: lambda spark, sf_dir: f(_t(spark, sf_dir), CTX))(_fn))


# -------------------------------------------------------------- CONTROL
from . import control  # noqa: E402

for _name, _fn, _oracle in [
    ("control_product_metrics", control.control_product_metrics, O.control_product_metrics),
    ("control_service_metrics", control.control_service_metrics, O.control_service_metrics),
]:
    register(_name, _oracle(CTX))((lambda f: lambda spark, sf_dir: f(_t(spark, sf_dir), CTX))(_fn))


# --------------------------------------------------- call list / dental
from . import calllist  # noqa: E402

for _name, _fn, _oracle in [
    ("dental_purchases", calllist.dental_purchases, O.dental_purchases),
    ("call_list", calllist.call_list, O.call_list),
]:
    register(_name, _oracle(CTX))((lambda f: lambda spark, sf_dir: f(_t(spark, sf_dir), CTX))(_fn))


@register("consumer_file", O.consumer_file(CTX))
def q_consumer_file(spark, sf_dir):
    return consumer.consumer_file(_t(spark, sf_dir), CTX)

register("ppr_t3_rec_histogram", O.ppr_t3(CTX))(lambda spark, sf_dir: ppr.t3_rec_histogram(_t(spark, sf_dir), CTX))
register("last_dose_nic_file", O.newly_inactive_file(CTX))(
    lambda spark, sf_dir: last_dose.newly_inactive_file(_t(spark, sf_dir), CTX))


# ------------------------------------------------------------- accounts
from . import accounts  # noqa: E402

for _name, _fn, _oracle in [
    ("accounts", accounts.accounts, O.accounts),
    ("ppr_accounts", accounts.ppr_accounts, O.ppr_accounts),
    ("psr_meta", accounts.psr_meta, O.psr_meta),
    ("psr_wellness_services", accounts.wellness_services, O.wellness_services),
]:
    register(_name, _oracle(CTX))((lambda f: lambda spark, sf_dir: f(_t(spark, sf_dir), CTX))(_fn))

register("control_file", O.control_file(CTX))(lambda spark, sf_dir: control.control_file(_t(spark, sf_dir), CTX))

register("clinic_xref_check", O.clinic_xref_check(CTX))(lambda spark, sf_dir: accounts.clinic_xref_check(_t(spark, sf_dir), CTX))

register("consumer_clients_split", O.consumer_clients_split(CTX))(
    lambda spark, sf_dir: consumer.consumer_clients_split(_t(spark, sf_dir), CTX))

register("last_dose_clients_split", O.last_dose_clients_split(CTX))(
    lambda spark, sf_dir: last_dose.last_dose_clients_split(_t(spark, sf_dir), CTX))

register("control_nsaid", O.control_nsaid(CTX))(lambda spark, sf_dir: control.control_nsaid(_t(spark, sf_dir), CTX))
register("control_dental_hygiene", O.control_dental_hygiene(CTX))(
    lambda spark, sf_dir: control.control_dental_hygiene(_t(spark, sf_dir), CTX))

register("legacy_wellness_services", O.legacy_wellness_services(CTX))(
    lambda spark, sf_dir: accounts.legacy_wellness_services(_t(spark, sf_dir), CTX))

register("last_dose_nic_merged", O.newly_inactive_merged(CTX))(
    lambda spark, sf_dir: last_dose.newly_inactive_merged(_t(spark, sf_dir), CTX))
