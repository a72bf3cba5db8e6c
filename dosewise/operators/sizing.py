"""Size-checked broadcast.

A side is broadcast only when the optimizer's size estimate for it is under
a cap; otherwise the join is left to sort-merge (and to AQE, which can still
switch to a broadcast at run time once real sizes are known).

The estimate counts bytes of compressed files, in the share of the columns
kept. A row in memory takes far more (names of 7.2 million parts: 26 MB by the
estimate, 594 MB as a broadcast, all of it in the driver's heap), so the files
that a side is read from have a cap of their own, a quarter of the other: of
the supplied parts, 16 MB are 1.8 million rows, up to 220 MB in memory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Dimension sides (clinics, products, control spines) above this estimated
# size are joined by shuffle instead.
DEFAULT_BROADCAST_CAP = 64 * 1024 * 1024
FILE_WEIGHT = 4  # of a byte in a file against one of the cap


def estimated_bytes(df: DataFrame) -> int | None:
    try:
        stats = df._jdf.queryExecution().optimizedPlan().stats()
        return int(str(stats.sizeInBytes()))
    except Exception:  # pragma: no cover - e.g. Spark Connect sessions
        return None


def file_bytes(df: DataFrame) -> int | None:
    """Bytes of the files whose rows a frame holds, whatever its columns and
    filters; files that it only aggregates don't count."""
    try:
        found, plans = 0, [df._jdf.queryExecution().optimizedPlan()]
        while plans:
            plan = plans.pop()
            name, below = plan.nodeName(), plan.children()
            if name.startswith("LogicalRelation"):
                found += int(str(plan.stats().sizeInBytes()))
            elif name != "Aggregate":
                plans += [below.apply(i) for i in range(below.size())]
        return found
    except Exception:  # pragma: no cover - e.g. Spark Connect sessions
        return None


CAP_CONF = "spark.dosewise.broadcastCapBytes"


def broadcast_cap(df: DataFrame) -> int:
    """The cap from the session (``spark.dosewise.broadcastCapBytes``),
    else the default."""
    try:
        v = df.sparkSession.conf.get(CAP_CONF, None)
        return int(v) if v else DEFAULT_BROADCAST_CAP
    except Exception:  # pragma: no cover
        return DEFAULT_BROADCAST_CAP


def maybe_broadcast(df: DataFrame, cap: int | None = None) -> DataFrame:
    """Broadcast hint only if the estimated size is known and below ``cap``,
    and so is four times the size of its files."""
    cap = broadcast_cap(df) if cap is None else cap
    size, files = estimated_bytes(df), file_bytes(df)
    if size is not None and files is not None and max(size, FILE_WEIGHT * files) <= cap:
        return F.broadcast(df)
    return df


