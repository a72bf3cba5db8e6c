"""Run parameters.

The reference keeps run parameters in package globals and a log table; here
they are an immutable value passed to every report function. Dates are
computed on the driver, so filters reach the Parquet scan as literals.
"""

from __future__ import annotations

import calendar
from dataclasses import dataclass, field, replace
from datetime import date, timedelta


def add_months(d: date, k: int) -> date:
    """Month arithmetic with the month-end rule of the reference database:
    the last day of a month maps to the last day of the target month."""
    y, m = divmod(d.month - 1 + k, 12)
    y += d.year
    m += 1
    last_src = calendar.monthrange(d.year, d.month)[1]
    last_dst = calendar.monthrange(y, m)[1]
    day = last_dst if d.day == last_src else min(d.day, last_dst)
    return date(y, m, day)


def month_start(d: date) -> date:
    return d.replace(day=1)


@dataclass(frozen=True)
class RunContext:
    """One report run: the last report month and the as-of day.

    ``end_date`` is truncated to the first of its month (the reference does
    the same in ``init``). ``as_of`` replaces the database clock in
    campaign-to-date windows.
    """

    end_date: date = date(2001, 7, 1)
    as_of: date = date(2001, 8, 1)
    run_id: int = 1
    update_flag: int | None = None  # None: that of the run's year
    location_number: int | None = None
    start_date: date | None = None
    report_type: str = "PSR"
    extra: dict = field(default_factory=dict, compare=False, hash=False)

    def __post_init__(self):
        object.__setattr__(self, "end_date", month_start(self.end_date))

    # -- calendar-month windows (PF2) -----------------------------------
    def month(self, k: int) -> date:
        """First day of the month ``k`` months from the end month."""
        return add_months(self.end_date, k)

    def months_window(self, first: int, last: int = 0) -> tuple[date, date]:
        """[first day of month end+first, first day of month end+last+1).

        Equivalent to ``trunc(d,'mm') between add_months(end, first) and
        add_months(end, last)`` but usable as a plain range on the raw column.
        """
        return self.month(first), self.month(last + 1)

    # -- exact-day trailing windows (PF3) -------------------------------
    def trailing(self, years_back: int) -> tuple[date, date]:
        """Inclusive day range: 0 -> [end-12m, end], 1 -> [end-24m, end-12m-1d]."""
        hi = add_months(self.end_date, -12 * years_back)
        lo = add_months(self.end_date, -12 * (years_back + 1))
        if years_back == 0:
            return lo, hi
        return lo, hi - timedelta(days=1)

    def with_(self, **kw) -> "RunContext":
        return replace(self, **kw)


DEFAULT_CONTEXT = RunContext()


# fixed values: report types the run initialiser accepts
REPORT_TYPES = ("PSR", "PSR-B", "CONSUMER", "CONTROL", "LAST DOSE", "NSAID", "PPR", "UPL")


class InvalidReportType(ValueError):
    pass


class MissingEndDate(ValueError):
    pass


def make_run(report_type: str, end_date: date | None = None, as_of: date | None = None,
             run_id: int = 1, update_flag: int | None = None, location_number: int | None = None) -> RunContext:
    """AP2: validate the report type and settle the end date.

    Without an end date, CONSUMER and LAST DOSE default to two days before
    ``as_of``; every other type is refused. The reports' windows are
    calendar months, so the context keeps the end month; the exact end day
    (kept untruncated for LAST DOSE by the reference) is in
    ``extra['end_day']``."""
    rt = report_type.upper()
    if rt not in REPORT_TYPES:
        raise InvalidReportType(report_type)
    as_of = as_of or DEFAULT_CONTEXT.as_of
    if end_date is None:
        if rt not in ("CONSUMER", "LAST DOSE"):
            raise MissingEndDate(report_type)
        end_date = as_of - timedelta(days=2)
    return RunContext(end_date=end_date, as_of=as_of, run_id=run_id, update_flag=update_flag,
                      location_number=location_number, report_type=rt, extra={"end_day": end_date})
