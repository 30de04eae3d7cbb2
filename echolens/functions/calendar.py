"""Calendar keys: day, Sunday-ending week, month, month label (all on UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day(ts: str | Column) -> Column:
    """Calendar day of a timestamp."""
    return F.to_date(ts)


def week_ending_sunday(ts: str | Column) -> Column:
    """Week label: the first Sunday strictly after the day (a Sunday maps 7 days ahead)."""
    return F.next_day(F.to_date(ts), "SUN")


def month_start(ts: str | Column) -> Column:
    """First day of the month, as a date."""
    return F.trunc(F.to_date(ts), "MM")


def month_label(ts: str | Column) -> Column:
    """'yyyy-MM' label used to split exports."""
    return F.date_format(F.to_date(ts), "yyyy-MM")


def with_calendar(df, ts: str, prefix: str = "") -> "DataFrame":  # noqa: F821
    """Add ds, dsw, dsm columns computed from ``ts``."""
    return (df.withColumn(prefix + "ds", day(ts))
              .withColumn(prefix + "dsw", week_ending_sunday(ts))
              .withColumn(prefix + "dsm", month_start(ts)))


def age_in_days(created: str | Column, as_of: str | Column) -> Column:
    """Whole days between ``created`` and an explicit as-of time (never now())."""
    c = F.col(created) if isinstance(created, str) else created
    a = F.to_timestamp(F.lit(as_of)) if isinstance(as_of, str) else as_of
    return F.floor((F.unix_micros(a.cast("timestamp")) - F.unix_micros(c.cast("timestamp")))
                   / F.lit(86_400_000_000)).cast("long")
