from datetime import date

import pytest
from pyspark.sql import functions as F

from dosewise.context import RunContext, add_months
from dosewise.functions.semantics import id_remap, money_text, ratio_round, scaled_round


def test_add_months_keeps_month_end():
    assert add_months(date(2019, 2, 28), 1) == date(2019, 3, 31)
    assert add_months(date(2019, 1, 31), 1) == date(2019, 2, 28)
    assert add_months(date(2001, 7, 1), -12) == date(2000, 7, 1)


def test_context_windows():
    ctx = RunContext(end_date=date(2001, 7, 15))
    assert ctx.end_date == date(2001, 7, 1)
    assert ctx.months_window(-11, 0) == (date(2000, 8, 1), date(2001, 8, 1))
    assert ctx.trailing(0) == (date(2000, 7, 1), date(2001, 7, 1))
    assert ctx.trailing(1) == (date(1999, 7, 1), date(2000, 6, 30))


@pytest.mark.parametrize("num,den,digits,expected", [
    (1, 8, 2, 0.13), (5, 2, 0, 3.0), (-5, 2, 0, -3.0), (2, 3, 2, 0.67), (1, 0, 2, 0.0), (None, 3, 2, 0.0),
])
def test_ratio_round_half_away(spark, num, den, digits, expected):
    df = spark.createDataFrame([(num, den)], "n long, d long")
    assert df.select(ratio_round(F.col("n"), F.col("d"), digits)).first()[0] == expected


def test_scaled_round_money(spark):
    df = spark.createDataFrame([("12.3450",)], "v string").select(F.col("v").cast("decimal(18,4)").alias("v"))
    assert df.select(scaled_round(F.col("v"), F.lit(1), 2, scale=4)).first()[0] == 1235


def test_id_remap_and_money(spark):
    df = spark.createDataFrame([(1,), (0,), (-7,)], "i long")
    assert [r[0] for r in df.select(id_remap(F.col("i"))).collect()] == [1, 4294967297, 4294967304]
    m = spark.createDataFrame([("5",), ("-1.005",)], "v string").select(money_text(F.col("v").cast("decimal(18,4)")))
    assert [r[0] for r in m.collect()] == ["5.00", "-1.01"]
