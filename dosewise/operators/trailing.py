"""TM1 trailing metrics, LB1 latest-by, RK1 product ranking, HH1 household.

TM1 replaces one scan-and-group per product set (nine in the consumer
extract, eight in the control extract) with a single ``groupBy`` whose
aggregates are conditional on a tag predicate and a date window. Partial
aggregation runs before the shuffle, so the shuffle carries one row per
(key, map partition) regardless of how many tags or windows are asked for.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_by(value: Column, *order: Column) -> Column:
    """LB1: value at the greatest (order...) - last_value over an unbounded
    frame / first_value over a descending order, as one aggregate."""
    return F.max_by(value, F.struct(*order))


# A line's place among its client's lines in one long: day, line_seq (below
# 2^32) and a small value of the line (below 256), so that "the value of the
# latest line" is the maximum of a fixed-width number, which hash aggregates keep.
_SEQ, _DAY = 1 << 8, 1 << 40


def packed(day: Column, seq: Column, value: Column) -> Column:
    """Orders as (day, seq, value) does; NULL if one of them is."""
    return F.unix_date(day).cast("long") * _DAY + seq.cast("long") * _SEQ + value.cast("long")


def packed_day(p: Column) -> Column:
    return F.date_from_unix_date(F.shiftright(p, 40).cast("int"))


def packed_value(p: Column) -> Column:
    return F.pmod(p, F.lit(_SEQ)).cast("int")


def latest_id(day: Column, seq: Column, flag: Column, ident: Column) -> Column:
    """As ``packed`` for a value as wide as an id and a yes/no, in a decimal."""
    place = (F.unix_date(day).cast("long") * (1 << 32) + seq.cast("long")).cast("decimal(17,0)")
    return (place * F.lit(Decimal(10**20)) + F.when(flag, F.lit(Decimal(10**19))).otherwise(F.lit(Decimal(0))) + ident.cast("decimal(19,0)")).cast("decimal(38,0)")


def flagged_id(p: Column) -> Column:
    """The id of a ``latest_id``, NULL where the flag isn't set."""
    tail = F.pmod(p, F.lit(Decimal(10**20)))
    return F.when(tail >= F.lit(Decimal(10**19)), F.pmod(tail, F.lit(Decimal(10**19))).cast("long"))


def in_window(d: Column, bounds) -> Column:
    """Inclusive window; bounds are dates or per-row columns (e.g. each
    clinic's campaign start)."""
    lo, hi = bounds
    lo = lo if isinstance(lo, Column) else F.lit(lo)
    hi = hi if isinstance(hi, Column) else F.lit(hi)
    return d.between(lo, hi)


def tagged_metrics(
    df: DataFrame,
    keys: Sequence[str],
    tags: Mapping[str, Column],
    windows: Mapping[str, tuple[date, date]],
    date_col: str = "invoice_date",
    count_of: Column | None = None,
    revenue: Column | None = None,
    doses: Column | None = None,
    last_value: Column | None = None,
    order_key: Sequence[Column] = (),
    last_name: str = "last_pet_species",
    extra: Sequence[Column] = (),
    last_at: Column | None = None,
) -> DataFrame:
    """One row per key with, for every tag: last date, and per window the
    count, revenue and doses of the tagged rows; optionally the value of
    ``last_value`` at the tag's latest row, by (day, ``order_key``) or, in a
    hash aggregate, by ``last_at``, a ``packed`` place.

    Column names: ``last_{tag}_purch``, ``{tag}_purch_{w}``, ``{tag}_rev_{w}``,
    ``{tag}_doses_{w}``, ``{tag}_{last_name}``.
    """
    aggs = tagged_aggs(tags, windows, date_col, count_of, revenue, doses, last_value, order_key, last_name, last_at)
    return df.groupBy(*keys).agg(*aggs, *extra)


def tagged_aggs(tags, windows, date_col="invoice_date", count_of=None, revenue=None, doses=None,
                last_value=None, order_key=(), last_name="last_pet_species", last_at=None) -> list:
    """The aggregate expressions of ``tagged_metrics`` (to combine several
    stages into one ``groupBy``)."""
    d = F.col(date_col)
    cnt = count_of if count_of is not None else d
    aggs = []
    for tag, pred in tags.items():
        aggs.append(F.max(F.when(pred, d)).alias(f"last_{tag}_purch"))
        for w, bounds in windows.items():
            hit = pred & in_window(d, bounds)
            aggs.append(F.count(F.when(hit, cnt)).alias(f"{tag}_purch_{w}"))
            if revenue is not None:
                aggs.append(F.sum(F.when(hit, revenue)).alias(f"{tag}_rev_{w}"))
            if doses is not None:
                aggs.append(F.sum(F.when(hit, doses)).alias(f"{tag}_doses_{w}"))
        if last_at is not None:
            aggs.append(packed_value(F.max(F.when(pred, last_at))).alias(f"{tag}_{last_name}"))
        elif last_value is not None:
            aggs.append(F.max_by(F.when(pred, last_value), F.when(pred, F.struct(d, *order_key)))
                        .alias(f"{tag}_{last_name}"))
    return aggs


def rank_products(df: DataFrame, keys: Sequence[str], product: str, doses: Column,
                  date_col: str, id_cols: Sequence[str], descending: bool = False) -> DataFrame:
    """RK1: per key and product, total doses, last date and last line id,
    ranked within the key by (doses, last date, last id).

    The reference ranks ascending, so order 1 is the product with the
    *fewest* doses; ``descending=True`` gives the intuitive order."""
    g = df.groupBy(*keys, product).agg(
        F.sum(doses).alias("doses"),
        F.max(date_col).alias("last_date"),
        F.max(F.struct(*[F.col(c) for c in id_cols])).alias("last_id"),
    )
    order = [F.col("doses"), F.col("last_date"), F.col("last_id")]
    if descending:
        order = [o.desc() for o in order]
    return g.withColumn("product_order", F.rank().over(Window.partitionBy(*keys).orderBy(*order)))


def household(patients: DataFrame, keys: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """HH1: roll patients up to their household (client)."""
    return patients.groupBy(*keys).agg(*aggs)
