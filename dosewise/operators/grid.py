"""SP1 dense report grid.

Every report row exists even when no patient contributes to it. The grid is
clinics x markets x species (x a fixed spine such as dose buckets or month
offsets). It is generated per clinic with ``explode`` over a literal array,
so no cross join is planned, and it grows only with the number of clinics.
Aggregates are computed first (one row per grid cell at most) and then
left-joined onto the grid, so no patient row is ever duplicated per cell.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sizing import maybe_broadcast

MARKETS = ("Flea/Tick", "Heartworm")
SPECIES = ("Dog", "Cat")


def spine(df: DataFrame, name: str, values: Sequence, *more: tuple[str, Sequence]) -> DataFrame:
    """Attach a fixed spine (cartesian over the given value lists) to each
    row of ``df`` by exploding a literal array of structs."""
    axes = [(name, list(values))] + [(n, list(v)) for n, v in more]
    combos = [[]]
    for _, vals in axes:
        combos = [c + [v] for c in combos for v in vals]
    names = [n for n, _ in axes]
    arr = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, c)]) for c in combos])
    return df.withColumn("_cell", F.explode(arr)).select("*", *[F.col(f"_cell.{n}").alias(n) for n in names]).drop("_cell")


def report_grid(clinics: DataFrame, markets: Sequence[str] = MARKETS,
                species: Sequence[str] = SPECIES) -> DataFrame:
    """clinic x report_name x species."""
    base = clinics.select("h_id", "location_number", "dose_rec_ft_dog", "dose_rec_hw_dog",
                          "dose_rec_ft_cat", "dose_rec_hw_cat")
    g = spine(base, "report_name", markets, ("species", species))
    return g.withColumn(
        "dose_rec",
        F.when((F.col("report_name") == "Flea/Tick") & (F.col("species") == "Dog"), F.col("dose_rec_ft_dog"))
        .when((F.col("report_name") == "Heartworm") & (F.col("species") == "Dog"), F.col("dose_rec_hw_dog"))
        .when((F.col("report_name") == "Flea/Tick") & (F.col("species") == "Cat"), F.col("dose_rec_ft_cat"))
        .otherwise(F.col("dose_rec_hw_cat")),
    ).drop("dose_rec_ft_dog", "dose_rec_hw_dog", "dose_rec_ft_cat", "dose_rec_hw_cat")


def dense_fill(grid: DataFrame, agg: DataFrame, keys: Sequence[str], fills: dict) -> DataFrame:
    """Left-join per-cell aggregates onto the grid and zero-fill."""
    joined = grid.join(maybe_broadcast(agg), list(keys), "left")
    for c, v in fills.items():
        joined = joined.withColumn(c, F.coalesce(F.col(c), F.lit(v)))
    return joined
