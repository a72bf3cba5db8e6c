"""The invoice-line fact: pruning in every line report, late lines, buckets, reopening."""

import os
import re

import pytest
from pyspark.sql import functions as F

from dosewise.plans import catalog
from dosewise.sources.facts import COLUMNS, LINE_KEY, MONTH, LineFact, fact_rows
from dosewise.sources.tables import Tables

from .conftest import SMOKE

NO_LINES = re.compile(r"FileScan parquet [^\n]*lineitem")
FACT_SCAN = re.compile(r"FileScan parquet spark_catalog\.default\.line_fact_[^\n]*")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def rows(df):
    return sorted(map(str, df.select(*COLUMNS).collect()))


def test_every_line_report_prunes_months_and_joins_no_orders_to_lines(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    seen = 0
    for name, build in catalog.QUERIES.items():
        text = plan(build(spark, SMOKE))
        assert not NO_LINES.search(text), name
        for scan in FACT_SCAN.findall(text):
            seen += 1
            filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", scan)[1]
            assert MONTH in filters, (name, scan)
    assert seen >= 43


def test_late_and_corrected_lines_rewrite_their_months_only(spark, tmp_path):
    t = Tables(spark, SMOKE)
    late = (F.col("l_orderkey") % 3 == 1) & F.col("l_orderkey").isin([r[0] for r in t.orders.where("o_orderdate >= '2001-03-01' and o_orderdate < '2001-05-01'").select("o_orderkey").collect()])
    whole = LineFact(spark, f"{tmp_path}/whole").build(t.lineitem, t.orders, t.customer)
    fact = LineFact(spark, f"{tmp_path}/fact").build(t.lineitem.where(~late), t.orders, t.customer)
    assert whole.read().count() == t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).count() > fact.read().count()
    before = files(fact.path)
    assert fact.refresh(t.lineitem.where(late), t.orders, t.customer) == [200103, 200104]
    assert rows(fact.read()) == rows(whole.read())
    after = files(fact.path)
    assert {os.path.basename(os.path.dirname(f)) for f in before ^ after} == {f"{MONTH}=200103", f"{MONTH}=200104"}
    fact.refresh(t.lineitem.where(late), t.orders, t.customer)  # the same again changes nothing
    assert rows(fact.read()) == rows(whole.read())
    one = t.lineitem.where(late).orderBy(*LINE_KEY).limit(1).withColumn("l_returnflag", F.lit("X")).withColumn("l_quantity", F.lit(49.0))
    fact.refresh(one, t.orders, t.customer)
    diff = fact.read().exceptAll(whole.read()).collect()
    assert len(diff) == 1 and diff[0]["quantity_norm"] == 5 and fact.read().count() == whole.read().count()
    assert fact.refresh(one.limit(0), t.orders, t.customer) == []


def test_buckets_spare_the_shuffle_by_patient(spark, tmp_path):
    t = Tables(spark, SMOKE)
    fact = LineFact(spark, f"{tmp_path}/fact", buckets=4).build(t.lineitem, t.orders, t.customer)
    per_patient = fact.read().where(F.col(MONTH) >= 200001).groupBy("patient_id").agg(F.sum("cost"))
    assert "Exchange" not in plan(per_patient)
    plain = LineFact(spark, f"{tmp_path}/plain").build(t.lineitem, t.orders, t.customer)
    assert rows(fact.read()) == rows(plain.read())
    spark.sql(f"DROP TABLE {fact.name}")  # another session doesn't know the table
    again = LineFact(spark, fact.path, buckets=4)
    assert again.open() and rows(again.read()) == rows(plain.read())
    assert "Exchange" not in plan(again.read().groupBy("patient_id").count())
    again.refresh(t.lineitem.where("l_orderkey = 1"), t.orders, t.customer)
    assert rows(again.read()) == rows(plain.read())
    assert not LineFact(spark, f"{tmp_path}/none").open()


def test_a_named_fact_is_used_as_it_is(spark, tmp_path):
    t = Tables(spark, SMOKE)
    path = f"{tmp_path}/named"
    LineFact(spark, path).build(t.lineitem.where("l_orderkey < 100"), t.orders, t.customer)
    spark.conf.set("spark.dosewise.lineFact", path)
    try:
        assert Tables(spark, SMOKE).line_fact().read().agg(F.max("l_orderkey")).first()[0] < 100
    finally:
        spark.conf.unset("spark.dosewise.lineFact")


def test_line_seq_orders_a_clients_day_by_line_key(spark):
    x = Tables(spark, SMOKE).line_fact().read().select("client_id", "invoice_date", "line_seq", *LINE_KEY).collect()
    by = {}
    for r in x:
        by.setdefault((r[0], r[1]), []).append(r)
    for group in by.values():
        group.sort(key=lambda r: r["line_seq"])
        assert [r["line_seq"] for r in group] == list(range(1, len(group) + 1))
        assert [tuple(r[3:]) for r in group] == sorted(tuple(r[3:]) for r in group)


def test_rows_without_a_day_or_a_patient(spark):
    li = spark.createDataFrame([(1, 1, 5, 6, 20.0, 10.0, 0.5, "N"), (2, 1, 5, 6, None, None, None, None), (9, 1, 5, 6, 1.0, 1.0, 0.0, "N")],
                               "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_discount double, l_returnflag string")
    orders = spark.createDataFrame([(1, None, None), (2, 4, None)], "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz")
    customer = spark.createDataFrame([(4, 7), (3, 2)], "c_custkey long, c_nationkey int")
    got = {r["l_orderkey"]: r for r in fact_rows(li, orders, customer).collect()}
    assert got.keys() == {1, 2} and got[1]["h_id"] is None and (got[2]["h_id"], got[2]["client_h_id"], got[2][MONTH]) == (7, 2, None)


def odd_lines(spark):
    """Lines, orders and patients with repeated and NULL keys, lines without an order, orders without a day or a patient."""
    li = [(k % 23 if k % 11 else None, k % 3, k % 4, k % 2, float(k % 50), 10.0 + k, 0.1, "RN"[k % 2]) for k in range(150)]
    orders = [(k % 20, k % 13 if k % 7 else None, f"1999-0{1 + k % 2}-03 00:00:00" if k % 5 else None) for k in range(32)] + [(None, 3, "1999-01-03 00:00:00")]
    customer = [(k % 11, k % 4) for k in range(14)] + [(None, 2)]
    return (spark.createDataFrame(li, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_discount double, l_returnflag string"),
            spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate string").withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz")),
            spark.createDataFrame(customer, "c_custkey long, c_nationkey int"))


@pytest.mark.parametrize("slice_bytes", [1, 1 << 40])
def test_slices_hold_all_rows_in_their_places(spark, monkeypatch, tmp_path, slice_bytes):
    monkeypatch.setattr("dosewise.sources.facts.SLICE_BYTES", slice_bytes)
    monkeypatch.setattr("dosewise.sources.facts.estimated_bytes", lambda df: 9)
    li, orders, customer = odd_lines(spark)
    got = LineFact(spark, f"{tmp_path}/fact").build(li, orders, customer).read().collect()
    slow, clinics = [], {}
    for c in customer.collect():
        clinics.setdefault(c[0], []).append(c[1])
    for x in li.collect():
        for o in orders.collect():
            if x[0] is not None and x[0] == o[0]:
                client = o[1] // 3 if o[1] is not None else None
                at = lambda k: clinics.get(k) or [None] if k is not None else [None]
                slow += [(*x[:4], o[1], client, a, b, o[2] and o[2].date()) for a in at(o[1]) for b in at(None if client is None else client * 3)]
    names = [*LINE_KEY]
    order = lambda r: tuple(r[c] for c in names)
    key = [li.columns.index(c) for c in names]
    wide = ["patient_id", "client_id", "h_id", "client_h_id", "invoice_date"]
    assert sorted(((*order(r), *(r[c] for c in wide)) for r in got), key=str) == sorted(((*(r[i] for i in key), *r[4:]) for r in slow), key=str)
    days = {}
    for r in got:
        days.setdefault((r["client_id"], r["invoice_date"]), []).append(r)
    for day in days.values():
        day.sort(key=lambda r: r["line_seq"])
        assert [r["line_seq"] for r in day] == [*range(1, len(day) + 1)]
        assert [*map(order, day)] == sorted(map(order, day))


def test_the_fact_shuffles_its_lines_twice_at_size(spark, tmp_path):
    """Once to their orders, once to their months, whatever the size of the patients."""
    t, kept = Tables(spark, SMOKE), {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for c, v in zip(kept, ("-1", "false")):
            spark.conf.set(c, v)
        steps = plan(LineFact(spark, f"{tmp_path}/fact")._sliced(t.lineitem, t.orders, t.customer)).splitlines()
    finally:
        for c, v in kept.items():
            spark.conf.set(c, v)
    above, shuffled = [], 0
    for step in steps:  # the shuffles on the way from the lines' scan to the top
        depth = len(step) - len(step.lstrip(" :+-"))
        above = [a for a in above if a[0] < depth] + [(depth, "Exchange" in step)]
        if "l_orderkey" in step and "FileScan" in step:
            shuffled = sum(x for _, x in above)
    assert shuffled == 2
