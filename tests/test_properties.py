"""Property checks: exact rounding against rational arithmetic."""

from decimal import Decimal
from fractions import Fraction

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dosewise.functions.semantics import scaled_round


def half_away(fr: Fraction, digits: int) -> int:
    scaled = fr * (10 ** digits)
    sign = -1 if scaled < 0 else 1
    a = abs(scaled)
    q = a.numerator // a.denominator
    if (a - q) * 2 >= 1:
        q += 1
    return sign * q


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.integers(-10**9, 10**9), st.integers(-10**6, 10**6).filter(lambda x: x != 0)),
                min_size=1, max_size=40), st.integers(0, 3))
def test_scaled_round_matches_fractions(spark, pairs, digits):
    df = spark.createDataFrame(pairs, "n long, d long")
    got = [r[0] for r in df.select(scaled_round(F.col("n"), F.col("d"), digits)).collect()]
    assert got == [half_away(Fraction(n, d), digits) for n, d in pairs]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.decimals(min_value=Decimal("-99999"), max_value=Decimal("99999"), places=4,
                            allow_nan=False, allow_infinity=False), min_size=1, max_size=30))
def test_money_scale(spark, values):
    df = spark.createDataFrame([(str(v),) for v in values], "v string").select(F.col("v").cast("decimal(18,4)").alias("v"))
    got = [r[0] for r in df.select(scaled_round(F.col("v"), F.lit(3), 2, scale=4)).collect()]
    exp = [half_away(Fraction(str(v)) / 3, 2) for v in values]
    assert got == exp


@settings(max_examples=40, deadline=None)
@given(st.lists(st.sampled_from(["rabies", "fiv", "fip ", "felv", "fel-o-vax", "lab", "r/o", "the", "vet", " ", "fe", "ra"]),
                min_size=0, max_size=12))
def test_trie_regex_equals_alternation(words):
    import re

    from dosewise.operators.keywords import EXCLUDE_TERMS, INCLUDE_TERMS, alternation, trie_regex

    text = "".join(words)
    for terms in (INCLUDE_TERMS, EXCLUDE_TERMS):
        assert bool(re.search(alternation(terms), text)) == bool(re.search(trie_regex(terms), text))


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(st.dates(min_value=__import__("datetime").date(1980, 1, 1), max_value=__import__("datetime").date(2030, 12, 31)),
                          st.dates(min_value=__import__("datetime").date(1980, 1, 1), max_value=__import__("datetime").date(2030, 12, 31))),
                min_size=1, max_size=30))
def test_months_between_31_is_exact(spark, pairs):
    from dosewise.functions.semantics import months_between_31

    df = spark.createDataFrame(pairs, "e date, b date")
    got = df.select(months_between_31(F.col("e"), F.col("b")).alias("u"),
                    (F.months_between("e", "b", False) * 31).alias("m")).collect()
    assert all(abs(r.u - r.m) < 1e-6 for r in got)
