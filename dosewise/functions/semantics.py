"""Scalar column helpers that pin down semantics the reports depend on.

All are built-in column expressions (JVM side, inside whole-stage codegen);
none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_32_PLUS_1 = 4294967297


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def empty_to_null(c) -> Column:
    """The reference database treats '' as NULL; Spark does not."""
    c = col(c)
    return F.when(F.trim(c) == "", F.lit(None).cast("string")).otherwise(c)


def idiv(a: Column, b: Column) -> Column:
    """Exact integer division of two integral columns (truncates toward
    zero). Operands are widened to decimal(38,0) so products of money and
    counts cannot overflow a long before the division."""
    return F.call_function("div", a.cast("decimal(38,0)"), b.cast("decimal(38,0)"))


def scaled_round(num, den, digits: int = 2, scale: int = 0) -> Column:
    """round(num / den * 10**digits) as an exact integer (half away from zero).

    ``num`` and ``den`` must become integers when multiplied by 10**scale
    (counts: scale 0; money with 4 or 6 decimals: scale 4 or 6). NULL when
    either side is NULL or ``den`` is 0.
    """
    f = 10 ** scale
    p = 10 ** digits
    a = (col(num) * F.lit(f)).cast("decimal(38,0)")
    b = (col(den) * F.lit(f)).cast("decimal(38,0)")
    q = idiv(F.abs(a) * F.lit(2 * p) + F.abs(b), F.abs(b) * F.lit(2))
    signed = F.when((a < 0) != (b < 0), -q).otherwise(q)
    return F.when(b.isNull() | (b == 0) | a.isNull(), F.lit(None)).otherwise(signed).cast("long")


_SAME = object()


def ratio_round(num, den, digits: int = 2, scale: int = 0, when_zero=0.0, when_null=_SAME) -> Column:
    """round(num / den, digits), half away from zero, computed exactly.

    The quotient is formed with integer division, so Spark and the SQL
    oracle agree to the last bit. ``den`` = 0 or NULL yields ``when_zero``;
    a NULL ``num`` yields ``when_null`` (default: same as ``when_zero``;
    pass None for NULL).
    """
    q = scaled_round(num, den, digits, scale)
    p = 10 ** digits
    b = col(den)
    out = q.cast("double") / F.lit(float(p))
    zero = F.lit(when_zero).cast("double")
    nul = zero if when_null is _SAME else F.lit(when_null).cast("double")
    return F.when(b.isNull() | (b == 0), zero).when(col(num).isNull(), nul).otherwise(out)


def ceil_long(c) -> Column:
    return F.ceil(col(c)).cast("long")


def dec(x: str) -> Column:
    """Exact decimal literal (a Python float literal would be binary)."""
    from decimal import Decimal

    return F.lit(Decimal(x))


def species_name(species_id, dog: str = "Dog", cat: str = "Cat") -> Column:
    """decode(vi_species_id, 3, 'Dog', 'Cat')."""
    return F.when(col(species_id) == 3, F.lit(dog)).otherwise(F.lit(cat))


def id_remap(c) -> Column:
    """Ids below 1 are moved above the 32-bit range: 2^32 + 1 - id."""
    c = col(c)
    return F.when(c < 1, F.lit(TWO_POW_32_PLUS_1) - c).otherwise(c).cast("long")


def money_text(c) -> Column:
    """Amount as text with exactly two decimals (to_char '999990.00')."""
    return F.round(col(c).cast("decimal(38,4)"), 2).cast("decimal(38,2)").cast("string")


def mdy(c) -> Column:
    """Date as mm/dd/yyyy text."""
    return F.date_format(col(c), "MM/dd/yyyy")




def months_between_31(end, dob) -> Column:
    """31 x months_between(end, dob) as an exact integer: whole months, plus
    the day difference unless the days match or both dates are month ends
    (the reference database's rule, also Spark's for dates)."""
    e, b = col(end), col(dob)
    whole = (F.year(e) - F.year(b)) * 12 + (F.month(e) - F.month(b))
    same = (F.dayofmonth(e) == F.dayofmonth(b)) | ((F.last_day(e) == e) & (F.last_day(b) == b))
    return (whole * 31 + F.when(same, F.lit(0)).otherwise(F.dayofmonth(e) - F.dayofmonth(b))).cast("long")


def age_years(end, dob, digits: int = 3) -> Column:
    """months_between(end, dob) / 12 rounded to ``digits``, exactly."""
    return ratio_round(months_between_31(end, dob), F.lit(31 * 12), digits, when_zero=None)
