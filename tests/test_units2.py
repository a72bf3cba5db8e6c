"""More unit edge cases: MX1 tiers, IN1, NC1-style anti join, OP1, DQ1, run init."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from dosewise.context import InvalidReportType, MissingEndDate, make_run
from dosewise.operators.matrix import dental_doses
from dosewise.operators.upsert import upsert


def test_mx1_tiers(spark):
    m = spark.createDataFrame([
        ("P", "small", "5 oz", 10), ("P", "large", "5 oz", 11), ("P", "small", "7", 14),
        ("P", "small", "9 oz", 1), ("P", "small", "9 oz", 2),      # ambiguous (9, small)
        ("Q", "xl", "3 oz", 6)], "product string, treat_size string, package_volume string, package_count long")
    rows = [
        (1, "P", "3", None, None, 3),        # tier 1: package quantity equals qty -> its digits
        (2, "P", "4", None, None, 3),        # tier 1: numeric -> 4 * 3
        (3, "P", "4 ct", None, None, 3),     # tier 1: not numeric -> qty
        (4, "P", None, "large", "5oz", 2),   # tier 2: (P, 5, large) -> 11 * 2
        (5, "P", None, "small", "9 oz", 2),  # tier 2: ambiguous -> qty
        (6, "P", None, None, "7 oz", 2),     # tier 3: raw '7' matches digits, unique -> 14 * 2
        (7, "P", None, None, "5 oz", 2),     # tier 3: no raw-digit row for 5 -> qty
        (8, "Q", None, "xl", None, 2),       # tier 4: (Q, xl) unique -> 6 * 2
        (9, "P", None, None, None, 2),       # tier 5: qty
    ]
    df = spark.createDataFrame(rows, "id long, product_info string, package_quantity string, package_size string, "
                                     "package_volume string, quantity long")
    got = {r.id: float(r.doses) for r in dental_doses(df, m).collect()}
    assert got == {1: 3.0, 2: 12.0, 3: 3.0, 4: 22.0, 5: 2.0, 6: 28.0, 7: 2.0, 8: 12.0, 9: 2.0}


def test_in1_full_year_flag(spark):
    from dosewise.plans import last_dose
    from dosewise.plans.catalog import _t
    from dosewise.context import RunContext

    ctx = RunContext()
    t = _t(spark, "/root/testdata/sf0.001")
    full = last_dose.incremental_start(t, ctx, update_flag=11)
    assert {r.start_date for r in full.collect()} == {date(2000, 7, 1)}
    none_before = last_dose.incremental_start(t, ctx, update_flag=0)
    assert {r.start_date for r in none_before.collect()} == {date(2000, 7, 1)}


def test_up1_insert_only(spark):
    t = spark.createDataFrame([(1, "a", date(2000, 1, 1))], "k long, n string, last_update date")
    s = spark.createDataFrame([(1, "b"), (2, "c")], "k long, n string")
    out = {r.k: (r.n, r.action) for r in upsert(t, s, ["k"], ["n"], date(2001, 1, 1), mode="insert_only").collect()}
    assert out == {1: ("a", "keep"), 2: ("c", "insert")}


def test_op1_states(spark):
    from dosewise.plans import admin
    from dosewise.plans.catalog import _t
    from dosewise.context import RunContext

    st = admin.run_states(_t(spark, "/root/testdata/sf0.001"), RunContext())
    states = {r.state for r in st.collect()}
    assert states <= {"unknown", "already_run", "in_progress", "ok"} and "unknown" in states


def test_make_run():
    ctx = make_run("psr", end_date=date(2001, 7, 20))
    assert ctx.end_date == date(2001, 7, 1) and ctx.report_type == "PSR"
    c = make_run("consumer", as_of=date(2001, 8, 15))
    assert c.end_date == date(2001, 8, 1) and c.extra["end_day"] == date(2001, 8, 13)
    with pytest.raises(InvalidReportType):
        make_run("WEEKLY")
    with pytest.raises(MissingEndDate):
        make_run("PPR")


def test_qa_conservation_codes(spark):
    """QA1/QA2: patients included + excluded by the code lookup = all."""
    from dosewise.sources import binding as b
    from dosewise.plans.catalog import _t

    p = b.patients(_t(spark, "/root/testdata/sf0.001"))
    ok = F.coalesce(F.col("pms_code"), F.lit(2)).isin(2, 3, 4)
    assert p.where(ok).count() + p.where(~ok).count() == p.count()


def test_size_checked_broadcast(spark):
    from dosewise.operators.sizing import CAP_CONF, maybe_broadcast

    small = spark.range(10)
    hinted = maybe_broadcast(small)._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in hinted.lower()
    spark.conf.set(CAP_CONF, "1")
    try:
        plain = maybe_broadcast(small)._jdf.queryExecution().analyzed().toString()
        assert "broadcast" not in plain.lower()
    finally:
        spark.conf.unset(CAP_CONF)


def test_a_side_read_from_large_files_is_not_broadcast(spark, tmp_path):
    """The estimate takes the share of the columns kept of compressed files;
    the rows in memory may be twenty times as large."""
    from dosewise.operators.sizing import CAP_CONF, estimated_bytes, maybe_broadcast
    from dosewise.plans import control
    from dosewise.sources.tables import Tables

    spark.range(1000).selectExpr(
        "id AS p_partkey", "concat('part gizmo ', id) AS p_name", "concat('Brand#', id % 50) AS p_brand", "'SMALL' AS p_type",
        "int(id) AS p_size", "double(id) AS p_retailprice").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    t = Tables(spark, str(tmp_path))
    files = estimated_bytes(t.part)
    hint = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    names, brands = t.part.select("p_partkey", "p_name"), t.part.groupBy("p_size").count()
    last = spark.createDataFrame([(1, 4, None), (2, None, 7), (3, 4, 4)], "client_id long, comp_hg_service long, comp_fl_service long")
    try:
        spark.conf.set(CAP_CONF, str(2 * files))  # more than the estimate, less than the files' weight
        assert estimated_bytes(names) < files and not hint(maybe_broadcast(names)) and hint(maybe_broadcast(brands))
        got = control.with_products(t, last)
        assert not hint(got)
        assert sorted((r.client_id, r.comp_hg_prod is None, r.comp_fl_prod is None) for r in got.collect()) == [(1, False, True), (2, True, False), (3, False, False)]
        spark.conf.set(CAP_CONF, str(4 * files))
        assert hint(maybe_broadcast(names)) and hint(control.with_products(t, last))
    finally:
        spark.conf.unset(CAP_CONF)
