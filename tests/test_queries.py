"""Registered queries against their DuckDB oracles on the smallest data set,
plus report invariants (control totals, shares, uniqueness)."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from dosewise.checks.compare import compare, duck_connect
from dosewise.plans import catalog

from .conftest import SMOKE


@pytest.fixture(scope="module")
def con():
    return duck_connect(SMOKE)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "non_compliant_pats" in df.columns


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
    assert set(catalog.QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(catalog.QUERIES[name](spark, SMOKE), con, catalog.ORACLES[name])
    assert r["match"], r


def test_patient_master_unique_and_opp_bounds(spark):
    pm = catalog.QUERIES["psr_patient_master"](spark, SMOKE)
    assert pm.count() == pm.select("h_id", "patient_id").distinct().count()
    assert pm.where((F.col("ft_opp_doses") < 0) | (F.col("hw_opp_doses") < 0)).count() == 0


def test_rec_histogram_shares_sum_to_one(spark):
    t13 = catalog.QUERIES["psr_t13_rec_histogram"](spark, SMOKE)
    sums = t13.groupBy("h_id", "report_name", "species").agg(F.sum("patients").alias("n"), F.round(F.sum("pct_pats"), 6).alias("s"))
    assert sums.where((F.col("n") > 0) & (F.col("s") != 1.0)).count() == 0


def test_trailer_counts(spark):
    f = catalog.QUERIES["nsaid_purchase_file"](spark, SMOKE)
    det = f.where("record_type = '2DT'").groupBy("h_id").count()
    tr = f.where("record_type = '3TR'").select("h_id", F.col("lineitem_id").try_cast("long").alias("t"))
    bad = tr.join(det, "h_id", "left").where(F.col("t") != F.coalesce(F.col("count"), F.lit(0)) + 2)
    assert bad.count() == 0


_SPARK_T = {"LongType()": "int64", "IntegerType()": "int32", "DoubleType()": "double", "StringType()": "str",
            "DateType()": "date", "BooleanType()": "bool"}
_DUCK_T = {"BIGINT": "int64", "INTEGER": "int32", "DOUBLE": "double", "VARCHAR": "str", "DATE": "date",
           "BOOLEAN": "bool"}


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_output_types_match_oracle(spark, con, name):
    """Same column types on both sides (binding only, no execution)."""
    df = catalog.QUERIES[name](spark, SMOKE)
    s = {f.name: _SPARK_T.get(str(f.dataType), str(f.dataType)) for f in df.schema.fields}
    rel = con.sql(catalog.ORACLES[name])
    o = {c: _DUCK_T.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    assert s == o


@pytest.mark.parametrize("name", ["consumer_report", "consumer_file", "control_file", "consumer_clients",
                                  "last_dose_clients", "nsaid_clients", "consumer_product_metrics",
                                  "consumer_service_metrics", "control_product_metrics", "control_service_metrics"])
def test_client_level_outputs_are_unique_per_client(spark, name):
    """The oracle shares the binding, so grain mistakes (a stage keyed finer
    than the row it joins) must be caught by an invariant instead."""
    df = catalog.QUERIES[name](spark, SMOKE)
    if "record_type" in df.columns:
        df = df.where(F.col("record_type").isin("1DT", "2DT"))
    assert df.count() == df.select("client_id").distinct().count()
