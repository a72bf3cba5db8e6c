"""Physical inputs: one Parquet dataset per table, read lazily.

Only ``spark.read.parquet`` is used, so column pruning and predicate
pushdown happen in the scan. Each table is read at most once per
``Tables`` object; the DataFrame itself stays lazy.
"""

from __future__ import annotations

import copy
import os

from pyspark.sql import DataFrame, SparkSession

from .facts import LineFact, line_fact

TABLE_NAMES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


class Tables:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.clinics: tuple[int, ...] | None = None  # the clinics of a scoped run; None for all
        self._cache: dict[str, DataFrame] = {}
        self._facts: dict = {}

    def scoped(self, clinics) -> Tables:
        """The same tables for a run over some clinics: clinics, patients,
        clients and lines (``binding``) are cut to them at their scans."""
        out = copy.copy(self)  # readers and the line fact are shared
        out.clinics = tuple(sorted(clinics))
        return out

    def whole(self) -> Tables:
        """The same tables for all clinics."""
        out = copy.copy(self)
        out.clinics = None
        return out

    def line_fact(self) -> LineFact:
        """The invoice-line fact, built at its first use (see ``facts``)."""
        if "lines" not in self._facts:
            self._facts["lines"] = line_fact(self)
        return self._facts["lines"]

    def path(self, name: str) -> str:
        p = f"{self.root}/{name}.parquet"
        return p if os.path.exists(p) or "://" in p else f"{self.root}/{name}"

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in TABLE_NAMES:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(self.path(name))
        return self._cache[name]

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self, name)
