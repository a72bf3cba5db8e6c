"""A keyed Parquet table that is merged copy-on-write (DM1-DM3).

Rows lie in hash buckets of their key. A merge writes the buckets that it
touches as a new version and then the version's manifest (bucket -> version
that holds it), whose success marker is the switch: readers take the newest
finished manifest, so a merge that fails half-way leaves the table as it was
and can be repeated. Buckets that a merge does not touch keep their files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def replace_rows(stored: DataFrame, staged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``stored`` with the rows of ``staged`` added, or put in the place of
    the rows of equal key; NULL key parts equal each other."""
    s = staged.select(*(F.col(k).alias(f"_{k}") for k in keys)).distinct()
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return stored.join(s, same, "left_anti").unionByName(staged.select(*stored.columns))


class VersionedTable:
    """Rows of ``schema`` (a DDL string), one for each value of ``keys``, in a
    folder that all executors share. The number of buckets is fixed by the
    first merge's caller; merges add and replace rows, they delete none."""

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: Sequence[str], buckets: int = 64):
        self.spark, self.path, self.schema, self.keys, self.buckets = spark, path.rstrip("/"), schema, list(keys), buckets

    def versions(self) -> list[int]:
        """Finished versions, oldest first."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        folder = hadoop.Path(f"{self.path}/manifest")
        fs = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(folder):
            return []
        names = (s.getPath().getName() for s in fs.listStatus(folder))
        return sorted(int(n) for n in names if fs.exists(hadoop.Path(f"{self.path}/manifest/{n}/_SUCCESS")))

    def manifest(self, version: int | None = None) -> dict[int, int]:
        """bucket -> version that holds its rows, as of ``version`` (the newest)."""
        done = self.versions()
        if not done:
            return {}
        at = done[-1] if version is None else version
        rows = self.spark.read.schema("bucket int, version int").parquet(f"{self.path}/manifest/{at}").collect()  # a row a bucket
        return {r["bucket"]: r["version"] for r in rows}

    def read(self, version: int | None = None, only: Sequence[int] | None = None) -> DataFrame:
        """The rows as of a version (the newest), of some buckets if named."""
        held = self.manifest(version)
        paths = [f"{self.path}/data/{v}/bucket={b}" for b, v in sorted(held.items()) if only is None or b in only]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def merge(self, staged: DataFrame) -> list[int]:
        """Adds or replaces rows (one a key in ``staged``); returns the buckets
        that were rewritten. Without rows there is no new version."""
        ensure_checkpoint_dir(self.spark)
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        columns = self.spark.createDataFrame([], self.schema).columns
        new = staged.select(*columns).checkpoint()
        touched = sorted(r[0] for r in new.select(bucket.alias("b")).distinct().collect())
        if not touched:
            return []
        done, held = self.versions(), self.manifest()
        version = done[-1] + 1 if done else 1
        merged = replace_rows(self.read(only=touched), new, self.keys)
        (merged.withColumn("bucket", bucket).hint("rebalance", "bucket")
         .write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/data/{version}"))
        held.update(dict.fromkeys(touched, version))
        self.spark.createDataFrame(sorted(held.items()), "bucket int, version int").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/{version}")
        return touched
