"""Reporting-period expressions.

The dashboard's period is derived from an as-of date (never the clock):
the month that contains ``as_of - 2 days`` is the report month, the window
for the three-month extract starts at the first of the month containing
``as_of - 87 days``, and the report month ends on its last day.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Day offsets that define the report month and the 3-month window.
REPORT_LAG_DAYS = 2
WINDOW_LAG_DAYS = 87


def _d(as_of) -> Column:
    return as_of if isinstance(as_of, Column) else F.to_date(F.lit(str(as_of)))


def period_start(as_of) -> Column:
    return F.trunc(F.date_sub(_d(as_of), REPORT_LAG_DAYS), "MM")


def window_start(as_of) -> Column:
    return F.trunc(F.date_sub(_d(as_of), WINDOW_LAG_DAYS), "MM")


def period_end(as_of) -> Column:
    return F.last_day(period_start(as_of))


def month_label(d: Column) -> Column:
    """``yyyy_MM`` with a zero-padded month (file suffix)."""
    return F.date_format(d, "yyyy_MM")


def month_name_label(d: Column) -> Column:
    """Abbreviated month name and year, e.g. ``Jun_1998``."""
    return F.date_format(d, "MMM_yyyy")


def compact_date(d: Column) -> Column:
    return F.date_format(d, "yyyyMMdd")
