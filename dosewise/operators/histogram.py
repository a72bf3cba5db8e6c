"""HB1 fixed-cap dose histograms and HB2 recommendation-dependent labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def capped_bucket(doses: Column, cap: int) -> Column:
    """'0' for no/negative doses, 'n' for 1..cap-1, 'cap+' above."""
    return (
        F.when(doses >= cap, F.lit(f"{cap}+"))
        .when(doses.isNull() | (doses <= 0), F.lit("0"))
        .otherwise(doses.cast("long").cast("string"))
    )


def bucket_labels(cap: int, with_zero: bool = True) -> list[str]:
    start = 0 if with_zero else 1
    return [str(i) for i in range(start, cap)] + [f"{cap}+"]


def bucket_value(label: Column) -> Column:
    """Numeric value of a bucket label ('12+' -> 12); NULL for '0'-free
    decode semantics is handled by the caller."""
    return F.regexp_replace(label, r"\+", "").cast("long")


def coarse_bucket(doses: Column) -> Column:
    """Four buckets: 0, 1, 2-11, 12+."""
    return (
        F.when(doses >= 12, F.lit("12+"))
        .when(doses.isNull() | (doses <= 0), F.lit("0"))
        .when(doses == 1, F.lit("1"))
        .otherwise(F.lit("2-11"))
    )


COARSE_LABELS = ["0", "1", "2-11", "12+"]


def rec_label(doses: Column, rec: Column) -> Column:
    """HB2: label of a dose count relative to the recommended count."""
    return (
        F.when(doses == 0, F.lit("0 Doses"))
        .when((rec == 0) & (doses >= 1), F.lit("0+ Doses"))
        .when((rec == 1) & (doses >= 1), F.lit("1+ Doses"))
        .when((rec > 1) & (doses == 1), F.lit("1 Dose"))
        .when((rec == 3) & (doses == 2), F.lit("2 Doses"))
        .when((rec > 3) & doses.between(F.lit(2), rec - 1),
              F.concat(F.lit("2-"), (rec - 1).cast("string"), F.lit(" Doses")))
        .otherwise(F.concat(rec.cast("string"), F.lit("+ Doses")))
    )


def rec_label_list(rec: Column) -> Column:
    """All labels a recommendation can produce, in report order."""
    return (
        F.when(rec == 0, F.array(F.lit("0 Doses"), F.lit("0+ Doses")))
        .when(rec == 1, F.array(F.lit("0 Doses"), F.lit("1+ Doses")))
        .when(rec == 2, F.array(F.lit("0 Doses"), F.lit("1 Dose"), F.lit("2+ Doses")))
        .when(rec == 3, F.array(F.lit("0 Doses"), F.lit("1 Dose"), F.lit("2 Doses"), F.lit("3+ Doses")))
        .otherwise(F.array(
            F.lit("0 Doses"), F.lit("1 Dose"),
            F.concat(F.lit("2-"), (rec - 1).cast("string"), F.lit(" Doses")),
            F.concat(rec.cast("string"), F.lit("+ Doses")),
        ))
    )
