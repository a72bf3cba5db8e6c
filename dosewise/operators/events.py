"""AF1 same-day flag, IV1 interval exclusion, WU1 weight units, HT1
header/detail/trailer files.

Range joins are turned into equi-joins on (patient, day): an event is
expanded into the days it covers (at most 2k+1 rows per event, a constant),
deduplicated, and joined on equality. No pair of rows within a hot patient
is ever enumerated, and the probe side keeps its partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def same_day_flag(df: DataFrame, events: DataFrame, keys: Sequence[str], day_col: str,
                  event_day_col: str, flag: str = "appointment_flag") -> DataFrame:
    """AF1: 'Y' when the key has an event on the row's day, else 'N'."""
    ev = events.select(*keys, F.col(event_day_col).alias("_ev_day"), F.lit(True).alias("_hit")).distinct()
    cond = [df[k] == ev[k] for k in keys] + [df[day_col] == ev["_ev_day"]]
    return df.join(ev, cond, "left").select(
        df["*"], F.when(F.col("_hit"), F.lit("Y")).otherwise(F.lit("N")).alias(flag))


def event_days(events: DataFrame, keys: Sequence[str], day_col: str, before: int, after: int) -> DataFrame:
    """Distinct (keys, day) covered by [event day - before, event day + after]."""
    days = F.explode(F.sequence(F.date_sub(F.col(day_col), before), F.date_add(F.col(day_col), after)))
    return events.select(*keys, days.alias("_day")).distinct()


def exclude_near(df: DataFrame, events: DataFrame, keys: Sequence[str], day_col: str,
                 event_day_col: str, days: int, when: Column | None = None) -> DataFrame:
    """IV1: drop rows of ``df`` (meeting ``when``) that fall within
    +-``days`` of an event of the same key. Implemented as a left anti join
    on (keys, day) against the expanded event days."""
    cover = event_days(events, keys, event_day_col, days, days)
    cond = [df[k] == cover[k] for k in keys] + [df[day_col] == cover["_day"]]
    if when is not None:
        cond.append(when)
    return df.join(cover, cond, "left_anti")


def exclude_near_instant(df: DataFrame, events: DataFrame, keys: Sequence[str], at: str, event_at: str,
                         days: int, when: Column | None = None) -> DataFrame:
    """IV1 by instants: drop rows of ``df`` (meeting ``when``) whose instant
    ``at`` is at most ``days`` x 24 hours from an event of the same key.

    Still an equi-join on (keys, day), against one row a key and day however
    many events it has: an event that is less than ``days`` days away is near
    whatever its time, so only the days at the two ends compare instants, with
    the latest event of the one and the earliest of the other."""
    off = F.col("_off")
    spread = events.where(F.col(event_at).isNotNull()).select(
        *keys, F.col(event_at).alias("_at"), F.explode(F.sequence(F.lit(-days), F.lit(days))).alias("_off"))
    cover = spread.groupBy(*keys, F.date_add(F.col("_at").cast("date"), off).alias("_day")).agg(
        F.max(F.abs(off) < days).alias("_inside"),
        F.max(F.when(off == days, F.col("_at"))).alias("_earlier"),
        F.min(F.when(off == -days, F.col("_at"))).alias("_later"))
    span = F.make_dt_interval(F.lit(days))
    near = F.col("_inside") | (df[at] <= F.col("_earlier") + span) | (df[at] >= F.col("_later") - span)
    cond = [df[k] == cover[k] for k in keys] + [df[at].cast("date") == cover["_day"], near]
    if when is not None:
        cond.append(when)
    return df.join(cover, cond, "left_anti")


# --- WU1 -------------------------------------------------------------------
def weight_in_pounds(weight: Column, unit: Column) -> Column:
    """Text weight + unit -> pounds (exact decimal factors); unknown units
    keep the number; non-numeric text gives NULL."""
    num = weight.try_cast("decimal(18,4)")
    u = F.upper(unit)
    return (
        F.when(unit == "lbs", num)
        .when(u == "POUNDS", num)
        .when(u == "OUNCES", num * F.lit(Decimal("0.0625")))
        .when(u == "KILOGRAMS", num * F.lit(Decimal("2.2")))
        .when(u == "GRAMS", num * F.lit(Decimal("0.0022")))
        .otherwise(num)
    )


def latest_weight(vitals: DataFrame, keys: Sequence[str] = ("patient_id",)) -> DataFrame:
    """LB1 over vitals: converted weight of the latest visit per key
    (ties on the visit time broken by the vitals row id)."""
    from .trailing import latest_by

    conv = weight_in_pounds(F.col("weight"), F.col("weight_unit"))
    return vitals.groupBy(*keys).agg(latest_by(conv, F.col("visit_date"), F.col("vital_id")).alias("weight"))


# --- HT1 -------------------------------------------------------------------
def with_header_trailer(detail: DataFrame, heads: DataFrame, key: str, trailer_offset: int,
                        count_col: str = "lineitem_id") -> DataFrame:
    """Header, detail and trailer rows in one DataFrame.

    ``heads`` has one header row per ``key`` (record_type '1HD'). The
    trailer carries, in ``count_col``, the number of detail rows of the key
    plus ``trailer_offset``. Counting is a per-key aggregate; nothing is
    collected to the driver.
    """
    counts = detail.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    trailer = heads.select(key).join(counts, key, "left").select(
        F.lit("3TR").alias("record_type"), key,
        (F.coalesce(F.col("_n"), F.lit(0)) + F.lit(trailer_offset)).cast("string").alias(count_col),
    )
    return heads.unionByName(detail, allowMissingColumns=True).unionByName(trailer, allowMissingColumns=True)
