"""CS1 combo split and CP1 compliance clamp.

A combination product counts as a dose for both markets, and its revenue is
split .66 flea/tick, .33 heartworm (the remaining 1 % belongs to neither).
After aggregation, a market with no positive doses or no positive revenue is
set to NULL (so it drops out of averages) and its opportunity is the full
recommendation; otherwise opportunity = rec - doses clamped to [0, rec].
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FT_TYPES = ("f", "ft", "fh")
HW_TYPES = ("h", "fh")
# fixed values: revenue share of a combination product per market
COMBO_FT_SHARE = "0.66"
COMBO_HW_SHARE = "0.33"
MARKETS = ("Flea/Tick", "Heartworm")


def ft_doses(type_col: Column, qty: Column) -> Column:
    return F.when(type_col.isin(*FT_TYPES), qty).otherwise(F.lit(0))


def hw_doses(type_col: Column, qty: Column) -> Column:
    return F.when(type_col.isin(*HW_TYPES), qty).otherwise(F.lit(0))


def ft_revenue(type_col: Column, cost: Column) -> Column:
    return (
        F.when(type_col == "fh", cost * F.lit(COMBO_FT_SHARE).cast("decimal(3,2)"))
        .when(type_col.isin("f", "ft"), cost)
        .otherwise(F.lit(0))
    )


def hw_revenue(type_col: Column, cost: Column) -> Column:
    return (
        F.when(type_col == "fh", cost * F.lit(COMBO_HW_SHARE).cast("decimal(3,2)"))
        .when(type_col == "h", cost)
        .otherwise(F.lit(0))
    )


def not_bought(doses: Column, rev: Column) -> Column:
    return (doses <= 0) | (rev <= 0)


def null_unless_bought(value: Column, doses: Column, rev: Column) -> Column:
    return F.when(not_bought(doses, rev), F.lit(None)).otherwise(value)


def opportunity(doses: Column, rev: Column, rec: Column) -> Column:
    """Doses still missing to the recommendation, clamped to [0, rec]."""
    opp = rec - doses
    return (
        F.when(not_bought(doses, rev), rec)
        .when(opp < 0, F.lit(0))
        .when(opp > rec, rec)
        .otherwise(opp)
    ).cast("long")


def rec_for(species: Column, dog: Column, cat: Column) -> Column:
    return F.when(species == 3, dog).when(species == 7, cat).otherwise(F.lit(0))
