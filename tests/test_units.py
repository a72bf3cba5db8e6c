"""Edge cases of the build units on hand-written mini-frames (FIXTURES.md §4)."""

from datetime import date

from pyspark.sql import Window
from pyspark.sql import functions as F

from dosewise.operators import compliance as cp
from dosewise.operators import contact as cl
from dosewise.operators import events as ev
from dosewise.operators import histogram as hb
from dosewise.operators import shares as sh
from dosewise.operators import trailing as tm
from dosewise.operators import upsert as up
from dosewise.operators.keywords import keyword_classify
from dosewise.plans.ppr import pct_change


def test_cp1_compliance(spark):
    rows = [("none", 0, 0.0), ("over", 15, 10.0), ("neg", -2, 5.0), ("free", 3, 0.0), ("part", 4, 9.0)]
    df = spark.createDataFrame(rows, "k string, doses long, rev double")
    d, r, rec = F.col("doses"), F.col("rev"), F.lit(12)
    out = {x.k: (x.doses, x.opp) for x in df.select(
        "k", cp.null_unless_bought(d, d, r).alias("doses"), cp.opportunity(d, r, rec).alias("opp")).collect()}
    assert out == {"none": (None, 12), "over": (15, 0), "neg": (None, 12), "free": (None, 12), "part": (4, 8)}


def test_cs1_combo_split(spark):
    df = spark.createDataFrame([("fh", "10.00"), ("f", "10.00"), ("h", "10.00")], "t string, c string")
    c = F.col("c").cast("decimal(18,4)")
    got = df.select(cp.ft_revenue(F.col("t"), c).cast("double"), cp.hw_revenue(F.col("t"), c).cast("double")).collect()
    assert [tuple(r) for r in got] == [(6.6, 3.3), (10.0, 0.0), (0.0, 10.0)]


def test_hb2_labels(spark):
    cases = [(0, 12, "0 Doses"), (1, 12, "1 Dose"), (2, 12, "2-11 Doses"), (11, 12, "2-11 Doses"),
             (12, 12, "12+ Doses"), (13, 12, "12+ Doses"), (2, 3, "2 Doses"), (3, 3, "3+ Doses"),
             (1, 1, "1+ Doses"), (5, 0, "0+ Doses"), (2, 2, "2+ Doses"), (1, 2, "1 Dose")]
    df = spark.createDataFrame(cases, "d long, r long, e string")
    got = df.select(hb.rec_label(F.col("d"), F.col("r")).alias("l"), "e").collect()
    assert all(r.l == r.e for r in got)
    labels = spark.createDataFrame([(12,), (3,), (1,)], "r long").select(hb.rec_label_list(F.col("r"))).collect()
    assert labels[0][0] == ["0 Doses", "1 Dose", "2-11 Doses", "12+ Doses"]
    assert labels[1][0] == ["0 Doses", "1 Dose", "2 Doses", "3+ Doses"]
    assert labels[2][0] == ["0 Doses", "1+ Doses"]


def test_hb1_buckets(spark):
    df = spark.createDataFrame([(None,), (0,), (1,), (11,), (12,), (13,)], "d long")
    got = [r[0] for r in df.select(hb.capped_bucket(F.col("d"), 12)).collect()]
    assert got == ["0", "0", "1", "11", "12+", "12+"]


def test_rc1_maxima_ties(spark):
    df = spark.createDataFrame([("a", 33), ("b", 33), ("c", 33)], "k string, u long").withColumn("cell", F.lit(1))
    got = sorted(r[0] for r in df.select(sh.reconcile_maxima(["cell"], "u", 2)).collect())
    assert got == [34, 34, 34]  # every row at the maximum receives the residual


def test_rc1_leader(spark):
    df = spark.createDataFrame([("a", 50, True), ("b", 49, False)], "k string, u long, lead boolean").withColumn("cell", F.lit(1))
    got = dict(df.select("k", sh.reconcile_leader(df, ["cell"], "u", F.col("lead"), 2).alias("v")).collect())
    assert got == {"a": 51, "b": 49}


def test_rc1_three(spark):
    df = spark.createDataFrame([(60, 45, -5)], "p long, f long, u long")
    p, f, u = sh.reconcile_three(F.col("p"), F.col("f"), F.col("u"))
    assert tuple(df.select(p, f, u).first()) == (55, 45, 0)


def test_tk1_topn_priority_and_other(spark):
    rows = [(f"Fam{i}", 100 - i) for i in range(8)] + [("Heartgard", 1)]
    df = spark.createDataFrame(rows, "family_name string, qty long").select(
        F.lit(1).alias("cell"), F.lit("Heartworm").alias("report_name"), "family_name", "qty",
        F.lit(sum(q for _, q in rows)).alias("total"))
    out = sh.topn_other(df, ["cell", "report_name"], "family_name", "qty", "total").collect()
    names = {r.family_name: r.row_order for r in out}
    assert names["Heartgard"] == 1  # priority family first despite the smallest quantity
    assert names["Other Heartworm"] == 6
    assert len(out) == 6


def test_pc1_pct_change(spark):
    rows = [(1, 10), (2, 12), (3, None), (4, 0), (5, 7), (6, None), (7, 5), (8, None), (9, None), (10, 4), (11, 2), (12, None)]
    df = spark.createDataFrame(rows, "column_order int, v long").withColumn("g", F.lit(1))
    got = dict(df.select("column_order", pct_change("v", "column_order", ["g"]).alias("x")).collect())
    assert got[3] == 0.2      # growth
    assert got[6] == 0.0      # lag2 = 0
    assert got[9] == -1.0     # lag1 NULL
    assert got[12] == -0.5    # decline
    assert got[1] == 10.0 and got[8] == 0.0


def test_tm1_one_pass_matches_per_set(spark):
    rows = [(1, date(2001, 6, 1), "Heartgard A", 2, 10.0), (1, date(2000, 3, 1), "Frontline B", 1, 5.0),
            (2, date(2001, 6, 1), "Frontline B", None, 7.0), (3, date(1999, 1, 1), "Other", 1, 1.0)]
    df = spark.createDataFrame(rows, "client_id long, invoice_date date, product string, q long, cost double")
    tags = {"hg": F.col("product").startswith("Heartgard"), "fl": F.col("product").startswith("Frontline")}
    w = {"12": (date(2000, 7, 1), date(2001, 7, 1)), "24": (date(1999, 7, 1), date(2000, 6, 30))}
    out = {r.client_id: r for r in tm.tagged_metrics(
        df, ["client_id"], tags, w, revenue=F.col("cost"), doses=F.coalesce(F.col("q"), F.lit(1))).collect()}
    assert out[1].hg_purch_12 == 1 and out[1].fl_purch_24 == 1 and out[1].hg_purch_24 == 0
    assert out[2].fl_doses_12 == 1  # NULL quantity counts as one dose
    assert out[3].last_hg_purch is None and out[3].hg_purch_12 == 0


def test_rk1_ascending_rank(spark):
    rows = [(1, "A", 5, date(2001, 1, 1), 1), (1, "B", 5, date(2001, 2, 1), 2), (1, "C", 1, date(2000, 1, 1), 3)]
    df = spark.createDataFrame(rows, "client_id long, product string, q long, d date, id long")
    got = {r["product"]: r["product_order"] for r in tm.rank_products(df, ["client_id"], "product", F.col("q"), "d", ["id"]).collect()}
    assert got == {"C": 1, "A": 2, "B": 3}


def test_cl1_cleansing(spark):
    rows = [("John*", "Do Not Mail", "12345-6789", "(555) 010-0199", "a@b.com", "Mr."),
            ("123", "\x07Main St", "ab", "555", "bad@", "Dr 3rd")]
    df = spark.createDataFrame(rows, "n string, a string, z string, p string, e string, t string")
    got = df.select(cl.clean_name(F.col("n")), cl.clean_address(F.col("a"), cl.NONE_GIVEN), cl.clean_zip(F.col("z")),
                    cl.clean_phone(F.col("p")), cl.valid_email(F.col("e")), cl.clean_title(F.col("t"))).collect()
    assert tuple(got[0]) == ("John", " Mail", " " * 21 + "123456789", "5550100199", "a@b.com", "Mr.")
    assert tuple(got[1]) == ("None Given", "Main St", None, "555", None, None)


def test_dn1_deny(spark):
    rows = [("OTC", "X", "1 St", None), ("Ann", "Smith Animal Clinic", "1 St", None), ("Ann", "Lee", "1 St", "Do it!"),
            ("Ann", "Lee", "1 St", None), ("CASH", "cash", "1 St", None), (None, None, None, None)]
    df = spark.createDataFrame(rows, "f string, l string, a1 string, a2 string")
    got = [r[0] for r in df.select(cl.denied_client(F.col("f"), F.col("l"), F.col("a1"), F.col("a2"))).collect()]
    assert got == [True, True, True, False, True, False]
    st = spark.createDataFrame([("ON",), ("NY",), (None,), ("PR",)], "s string")
    assert [r[0] for r in st.select(cl.excluded_region(F.col("s"))).collect()] == [True, False, False, True]


def test_pi1_shapes(spark):
    df = spark.createDataFrame([("call 555-123-4567 now",), ("card 4111 1111 1111 1111",), ("no digits",)], "t string")
    got = [tuple(r) for r in df.select(cl.has_phone(F.col("t")), cl.has_card(F.col("t"))).collect()]
    assert got == [(True, False), (False, True), (False, False)]


def test_af1_iv1(spark):
    sales = spark.createDataFrame(
        [(1, 1, date(2001, 6, 10), 9, 1), (2, 1, date(2001, 6, 16), 9, 1), (3, 1, date(2001, 6, 10), 10, 1),
         (4, 2, date(2001, 6, 10), 5, 1)], "id long, patient_id long, d date, q long, dv long")
    appts = spark.createDataFrame([(1, date(2001, 6, 10)), (1, date(2001, 6, 10)), (3, date(2001, 6, 10))],
                                  "patient_id long, appointment_date date")
    surg = spark.createDataFrame([(1, date(2001, 6, 5)), (1, date(2001, 6, 8))], "patient_id long, surgery_date date")
    flagged = dict(ev.same_day_flag(sales, appts, ["patient_id"], "d", "appointment_date")
                   .select("id", "appointment_flag").collect())
    assert flagged == {1: "Y", 2: "N", 3: "Y", 4: "N"}
    kept = ev.exclude_near(sales, surg, ["patient_id"], "d", "surgery_date", 5, when=sales["q"] < sales["dv"] * 10)
    assert sorted(r.id for r in kept.collect()) == [2, 3, 4]  # id 1 within 5 days and < 10 pills


def test_wu1_units(spark):
    rows = [(1, "10", "lbs", 1), (1, "20", "lbs", 2), (2, "32", "Ounces", 1), (3, "10", "kilograms", 1),
            (4, "1000", "grams", 1), (5, "abc", "lbs", 1), (6, "7", "stone", 1)]
    df = spark.createDataFrame(rows, "patient_id long, weight string, weight_unit string, vital_id long").withColumn(
        "visit_date", F.lit(date(2001, 1, 1)))
    got = {r.patient_id: (float(r.weight) if r.weight is not None else None) for r in ev.latest_weight(df).collect()}
    assert got == {1: 20.0, 2: 2.0, 3: 22.0, 4: 2.2, 5: None, 6: 7.0}


def test_ht1_counts(spark):
    heads = spark.createDataFrame([("1HD", 1), ("1HD", 2)], "record_type string, h_id long")
    det = spark.createDataFrame([("2DT", 1, "a"), ("2DT", 1, "b")], "record_type string, h_id long, lineitem_id string")
    out = ev.with_header_trailer(det, heads, "h_id", trailer_offset=2)
    tr = {r.h_id: r.lineitem_id for r in out.where("record_type = '3TR'").collect()}
    assert tr == {1: "4", 2: "2"}
    assert out.count() == 6


def test_up1_upsert_null_blind(spark):
    t = spark.createDataFrame([(1, "a", None, date(2000, 1, 1)), (2, "b", 5, date(2000, 1, 1)), (3, "c", 7, date(2000, 1, 1)),
                               (4, "d", 1, date(2000, 1, 1))], "k long, n string, v long, last_update date")
    s = spark.createDataFrame([(1, "a", 9), (2, "b", None), (3, "C", 7), (5, "e", 1)], "k long, n string, v long")
    out = {r.k: r for r in up.upsert(t, s, ["k"], ["n", "v"], date(2001, 8, 1)).collect()}
    assert out[1].action == "keep" and out[1].v is None    # NULL -> value is not a change
    assert out[2].action == "keep" and out[2].v == 5       # value -> NULL is not a change
    assert out[3].action == "update" and out[3].n == "C" and out[3].last_update == date(2001, 8, 1)
    assert out[4].action == "keep" and out[5].action == "insert"
    safe = {r.k: r.action for r in up.upsert(t, s, ["k"], ["n", "v"], date(2001, 8, 1), null_safe=True).collect()}
    assert safe[1] == "update" and safe[2] == "update"


def test_tk2_tokenise(spark):
    rows = [("a, b,,c,",), ("x|y | z",), ("p  q r",), ("single",), ("",)]
    df = spark.createDataFrame(rows, "t string")
    got = [r[0] for r in df.select(up.tokenise(F.col("t"))).collect()]
    assert got == [["a", "b", None, "c"], ["x", "y", "z"], ["p", "q", "r"], ["single"], []]


def test_la1_list_agg(spark):
    df = spark.createDataFrame([("p", "b@x"), ("p", "a@x"), ("q", "c@x")], "project string, e string")
    got = dict(up.list_agg(df, ["project"], "e").collect())
    assert got == {"p": "a@x,b@x", "q": "c@x"}


def test_tx1_classifier(spark):
    rows = [("Rabies vaccine", None), ("Rabies titer test", None), ("note {rabies}", "plain"), (None, "FVRCP booster")]
    df = spark.createDataFrame(rows, "h string, d string")
    got = [r[0] for r in df.select(keyword_classify(F.col("h"), F.col("d"))).collect()]
    assert got == [True, False, False, True]


def test_pc1_null_two_back(spark):
    # lag2 NULL: lag1 0 -> -1, lag1 non-zero -> (l1 - NULL) / NULL -> NULL -> 0
    rows = [(1, None), (2, 0), (3, None), (4, None), (5, 5), (6, None)]
    df = spark.createDataFrame(rows, "column_order int, v long").withColumn("g", F.lit(1))
    got = dict(df.select("column_order", pct_change("v", "column_order", ["g"]).alias("x")).collect())
    assert got[3] == -1.0 and got[6] == 0.0


def test_tk2_texts_without_tokens(spark, tmp_path):
    import duckdb

    from dosewise.checks import oracle as O
    from dosewise.checks.compare import compare
    from dosewise.context import DEFAULT_CONTEXT as CTX
    from dosewise.plans.text import token_profile
    from dosewise.sources.tables import Tables

    texts = [(1, None), (2, ""), (3, "   "), (4, ","), (5, " , ,"), (6, "|"), (7, "one"), (8, ",a"), (None, None), (None, "a b")]
    con = duckdb.connect()
    for name, key in (("benchmark", "item_id"), ("documents", "doc_id")):
        spark.createDataFrame(texts, f"{key} long, text string").coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    got = token_profile(Tables(spark, str(tmp_path)), CTX)
    assert [r.first_token for r in got.where("src = 'documents' AND id IN (1, 2, 3, 7)").collect()] == [None, None, None, "one"]
    r = compare(got, con, O.token_profile(CTX))
    assert r["match"] and r["rows_spark"] == 2 * len(texts), r
