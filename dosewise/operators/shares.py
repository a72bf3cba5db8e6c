"""TK1 top-N + "Other", and RC1 reconciliation of rounded shares to 100 %.

Shares are carried as integer hundredths (or thousandths) so that the
residual arithmetic is exact; callers divide by 10**digits at the end.
All windows are partitioned by the report cell (clinic, market, species),
which holds at most one row per product family: small partitions, no skew.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.semantics import scaled_round

# fixed values: families listed first in the share charts, whatever their size
PRIORITY_FAMILIES = ("Frontline", "Certifect", "Heartgard", "Tritak", "NexGard")


def priority(family: Column, families: Sequence[str] = PRIORITY_FAMILIES) -> Column:
    return F.when(family.isin(*families), F.lit(1)).otherwise(F.lit(2))


def topn_other(df: DataFrame, cell: Sequence[str], name: str, measure: str, total: str,
               digits: int = 2, top: int = 5, other_prefix: str = "Other ",
               market_col: str = "report_name", families: Sequence[str] = PRIORITY_FAMILIES,
               name_transform=None) -> DataFrame:
    """Rank names in each cell (priority names first, then measure desc,
    then name); ranks above ``top`` collapse into 'Other <market>'.

    Input: one row per (cell, name) with ``measure`` > 0 share and the cell
    ``total``. Output: one row per (cell, collapsed name) with ``row_order``
    (1..top+1), ``share_units`` = round(measure / total, digits) scaled to
    an integer, and ``measure_rank`` (rank by measure alone, capped)."""
    w = Window.partitionBy(*cell)
    r1 = F.dense_rank().over(w.orderBy(priority(F.col(name), families), F.col(measure).desc(), F.col(name)))
    r2 = F.dense_rank().over(w.orderBy(F.col(measure).desc(), F.col(name)))
    cap = top + 1
    ranked = df.select(
        *cell, total, measure,
        F.when(r1 >= cap, F.concat(F.lit(other_prefix), F.col(market_col))).otherwise(F.col(name)).alias(name),
        F.least(r1, F.lit(cap)).cast("long").alias("row_order"),
        F.least(r2, F.lit(cap)).cast("long").alias("measure_rank"),
    )
    g = ranked.groupBy(*cell, name).agg(
        F.sum(measure).alias(measure),
        F.first(total).alias(total),
        F.min("row_order").alias("row_order"),
        F.min("measure_rank").alias("measure_rank"),
    )
    units = F.when(F.col(total) == 0, F.lit(0)).otherwise(scaled_round(F.col(measure), F.col(total), digits))
    out = g.withColumn("share_units", units)
    if name_transform is not None:
        out = out.withColumn(name, name_transform(F.col(name)))
    return out


def reconcile_leader(df: DataFrame, cell: Sequence[str], units: str, leader: Column,
                     digits: int = 2) -> Column:
    """RC1 'rank 1' mode: the leader row takes the residual to 100 %."""
    one = 10 ** digits
    s = F.sum(units).over(Window.partitionBy(*cell))
    return F.when(leader & (s != one), F.col(units) + (F.lit(one) - s)).otherwise(F.col(units))


def reconcile_maxima(cell: Sequence[str], units: str, digits: int = 2) -> Column:
    """RC1 'all maxima' mode: if the shares do not sum to 100 %, every row
    equal to the cell maximum takes the residual."""
    one = 10 ** digits
    w = Window.partitionBy(*cell)
    s = F.sum(units).over(w)
    mx = F.max(units).over(w)
    return F.when((s != one) & (F.col(units) == mx), F.col(units) + (F.lit(one) - s)).otherwise(F.col(units))


def reconcile_three(partial: Column, full: Column, unprotected: Column, one: int = 100):
    """RC1 'largest of three' mode (coverage tables): when partial + full
    exceed 100 %, the larger of the two (if larger than all) absorbs the
    excess and the unprotected share becomes 0. Inputs are integer units."""
    over = (full + partial) > one
    excess = F.lit(one) - (F.abs(partial) + F.abs(full))
    p = F.when((partial > full) & (partial > unprotected) & over, partial + excess).otherwise(partial)
    f = F.when((full > partial) & (full > unprotected) & over, full + excess).otherwise(full)
    u = F.when(over, unprotected - excess).otherwise(unprotected)
    return p, f, u
