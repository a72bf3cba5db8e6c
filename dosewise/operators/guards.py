"""Run-time guards with typed errors (LD12, CT0, CO1, AP1).

A guard costs one tiny job (``isEmpty`` reads at most one row) and is only
used for single-clinic runs, where an empty stage means the run cannot
produce a file; all-clinic runs report per clinic instead of failing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


class GuardError(RuntimeError):
    code = -20000


class NoPatients(GuardError):
    code = -20001


class NoSales(GuardError):
    code = -20002


class NoDetails(GuardError):
    code = -20003


class NotInXref(GuardError):
    code = -20004


class NotInControlFile(GuardError):
    code = -20006


def require_rows(df: DataFrame, error: type[GuardError], what: str = "") -> DataFrame:
    if df.isEmpty():
        raise error(what or error.__name__)
    return df
