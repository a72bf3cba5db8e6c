"""The stored lapsed list, its versioned table and the delivery marks."""

import datetime as dt
import os
import re

import pytest
from dosewise.context import RunContext
from dosewise.operators.versioned import VersionedTable, replace_rows
from dosewise.plans import last_dose
from dosewise.sources import marks as mk
from dosewise.sources.tables import Tables

from .conftest import SMALL, SMOKE


def files(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_a_merge_writes_touched_buckets_only(spark, tmp_path):
    table = VersionedTable(spark, f"{tmp_path}/t", "k long, part string, v long", ["k", "part"], buckets=8)
    assert table.read().count() == 0 and table.versions() == []
    first = [(i, "a", i) for i in range(50)] + [(None, None, 1)]
    assert table.merge(spark.createDataFrame(first, "k long, part string, v long")) == list(range(8))
    before = files(f"{tmp_path}/t/data")
    touched = table.merge(spark.createDataFrame([(3, "a", 33), (None, None, 2)], "k long, part string, v long"))
    assert 1 <= len(touched) <= 2 and table.versions() == [1, 2]
    assert {p: t for p, t in files(f"{tmp_path}/t/data").items() if "/data/1/" in p} == before  # old files as they were
    held = table.manifest()
    assert {b for b, v in held.items() if v == 2} == set(touched)
    want = {(i, "a", 33 if i == 3 else i) for i in range(50)} | {(None, None, 2)}
    rows = table.read().collect()
    assert len(rows) == 51 and {tuple(r) for r in rows} == want
    assert {tuple(r) for r in table.read(version=1).collect()} == set(first)
    assert table.merge(spark.createDataFrame([], "k long, part string, v long")) == [] and table.versions() == [1, 2]


def test_a_merge_that_did_not_finish_is_not_seen_and_can_be_repeated(spark, tmp_path):
    table = VersionedTable(spark, f"{tmp_path}/t", "k long, v long", ["k"], buckets=4)
    table.merge(spark.createDataFrame([(1, 1), (2, 2)], "k long, v long"))
    spark.createDataFrame([(1, 9)], "k long, v long").write.parquet(f"{tmp_path}/t/data/2/bucket=0")  # data without a manifest
    os.makedirs(f"{tmp_path}/t/manifest/2")  # a manifest that was begun
    assert table.versions() == [1] and {tuple(r) for r in table.read().collect()} == {(1, 1), (2, 2)}
    table.merge(spark.createDataFrame([(2, 5)], "k long, v long"))
    assert table.versions() == [1, 2] and {tuple(r) for r in table.read().collect()} == {(1, 1), (2, 5)}


def test_rows_are_replaced_by_key_with_null_parts(spark):
    a = spark.createDataFrame([(1, None, "x"), (1, 2, "y"), (None, None, "z")], "a long, b long, c string")
    s = spark.createDataFrame([(1, None, "new"), (None, None, "two"), (7, 7, "add")], "a long, b long, c string")
    assert {tuple(r) for r in replace_rows(a, s, ["a", "b"]).collect()} == {(1, 2, "y"), (1, None, "new"), (None, None, "two"), (7, 7, "add")}


def test_a_second_run_updates_one_header_and_one_trailer(spark, tmp_path, monkeypatch):
    """Hand-computed: two runs of one year and flag, then one of the next."""
    nic = {}
    monkeypatch.setattr(last_dose, "newly_inactive", lambda t, ctx: spark.createDataFrame(nic["rows"], "h_id long, location_number long, client_id long"))
    kept = last_dose.LapsedList(spark, f"{tmp_path}/list", buckets=16)
    run = RunContext(end_date=dt.date(2001, 7, 1), as_of=dt.date(2001, 8, 1), update_flag=6)
    got = lambda: sorted(tuple(r) for r in kept.file().collect())
    nic["rows"] = []
    kept.run(None, run)
    assert got() == [("1HD", "08/01/2001", "6", 2001, 2001, 6)]  # no trailer before the first row
    nic["rows"] = [(1, 1001, 10), (2, 1002, 20)]
    kept.run(None, run)
    nic["rows"] = [(1, 1001, 10), (1, 1001, 11)]  # 10 is there, 20 is not lapsed now but stays
    before = files(f"{tmp_path}/list/data")
    kept.run(None, run.with_(as_of=dt.date(2001, 9, 2)))
    assert got() == [("1HD", "09/02/2001", "6", 2001, 2001, 6), ("2DT", "1001", "10", None, 2001, 6), ("2DT", "1001", "11", None, 2001, 6),
                     ("2DT", "1002", "20", None, 2001, 6), ("3TR", "5", None, None, 2001, 6)]
    assert before.items() <= files(f"{tmp_path}/list/data").items()
    days = {r["client_id"]: r["last_update"] for r in kept.table.read().where("record_type = '2DT'").collect()}
    assert days == {10: dt.date(2001, 8, 1), 20: dt.date(2001, 8, 1), 11: dt.date(2001, 9, 2)}
    nic["rows"] = [(1, 1001, 10)]  # lapses again in the next run: a row, a header and a trailer more
    kept.run(None, run.with_(end_date=dt.date(2002, 7, 1), as_of=dt.date(2002, 8, 1), update_flag=7))
    assert [r for r in got() if r[4] == 2002] == [("1HD", "08/01/2002", "7", 2002, 2002, 7), ("2DT", "1001", "10", None, 2002, 7), ("3TR", "3", None, None, 2002, 7)]
    assert ("3TR", "5", None, None, 2001, 6) in got()


def test_lapsed_clients_were_delivered_with_dogs(spark):
    t, ctx = Tables(spark, SMALL), RunContext()
    with_dogs = last_dose.run_summary(t, ctx).where("dogs").select("h_id", "client_id").distinct()
    gone = last_dose.newly_inactive(t, ctx)
    assert gone.count() > 0 and gone.join(with_dogs, ["h_id", "client_id"], "left_anti").count() == 0


@pytest.fixture()
def marked(spark, tmp_path):
    t = Tables(spark, SMOKE)
    from dosewise.sources.facts import LineFact

    t._facts["lines"] = LineFact(spark, f"{tmp_path}/fact").build(t.lineitem, t.orders, t.customer)
    return t


def test_marks_follow_the_months_that_changed(spark, marked):
    t = marked
    fact, m = t.line_fact(), mk.DeliveryMarks(t)
    months = m.sync()
    assert months == [x for x in fact.months() if x is not None] and m.sync() == []
    stored = files(m.path)
    one = t.lineitem.join(t.orders.where("year(o_orderdate) = 1997 AND month(o_orderdate) = 3").select("o_orderkey"), t.lineitem["l_orderkey"] == t.orders["o_orderkey"], "left_semi")
    void = one.selectExpr(*("'R' AS l_returnflag" if c == "l_returnflag" else c for c in one.columns))
    assert one.count() > 0 and fact.refresh(void, t.orders, t.customer) == [199703]
    assert m.sync() == [199703]
    assert m.read().where("invoice_month = 199703").count() == 0  # every line of the month is voided now
    assert {p: s for p, s in stored.items() if "=199703/" not in p}.items() <= files(m.path).items()
    assert m.sync() == []


def test_the_file_scans_no_history_before_its_start_month(spark):
    t, ctx = Tables(spark, SMOKE), RunContext()
    plan = last_dose.last_dose_file(t, ctx)._jdf.queryExecution().executedPlan().toString()
    scans = [s for s in plan.splitlines() if "FileScan parquet spark_catalog" in s]
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    assert scans and all(re.search(r"PartitionFilters: \[.*invoice_month#\d+ >= ", s) for s in scans), scans


def test_the_merge_deals_its_rows_by_key_whatever_the_runs_constants(spark):
    plan = last_dose.newly_inactive_merged(Tables(spark, SMOKE), RunContext())._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "FullOuter" in plan


def test_a_merge_on_constant_repeated_and_null_keys(spark):
    from dosewise.operators.upsert import upsert

    kept = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "k int, n string").selectExpr("*", "5 AS flag", "DATE'2000-01-01' AS last_update")
    new = spark.createDataFrame([(1, "x"), (None, "y"), (2, "z")], "k long, n string")
    got = lambda flag, mode: sorted(upsert(kept, new.selectExpr("*", f"{flag} AS flag"), ["k", "flag"], ["n"], dt.date(2001, 1, 1), mode=mode)
                                    .select("k", "flag", "n", "action").collect(), key=str)
    rows = lambda *r: sorted(r, key=str)
    assert [tuple(r) for r in got(6, "insert_only")] == rows((1, 5, "a", "keep"), (1, 5, "b", "keep"), (None, 5, "c", "keep"), (1, 6, "x", "insert"), (None, 6, "y", "insert"), (2, 6, "z", "insert"))
    assert [tuple(r) for r in got(5, "update_always")] == rows((1, 5, "x", "update"), (1, 5, "x", "update"), (None, 5, "c", "keep"), (None, 5, "y", "insert"), (2, 5, "z", "insert"))
