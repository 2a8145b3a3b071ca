"""Date parsing, month arithmetic and report periods."""

from datetime import date, datetime, time, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def day(c: str) -> Column:
    return F.col(c).cast("date")


def within(c: str, start: Column, end: Column) -> Column:
    """Days from start to end, both in, as a half-open test on the bare column.

    Without a cast around the column the test reaches the Parquet scan.
    """
    midnight = lambda day: day.cast("timestamp_ntz")
    return (F.col(c) >= midnight(start)) & (F.col(c) < midnight(F.date_add(end, 1)))


def after_day(c: str, limit: date) -> Column:
    """Later than the whole of a day, also without a cast around the column."""
    return F.col(c) >= F.lit(datetime.combine(limit + timedelta(days=1), time.min))


def month_of(c: str) -> Column:
    """First day of the month. Cheaper to group by than its text form."""
    return F.trunc(day(c), "MM")


def month_label(month: Column) -> Column:
    return F.date_format(month, "yyyy-MM")


def months_between(first: Column, later: Column) -> Column:
    """Whole calendar months from one date to another, ignoring the day of month."""
    return (F.year(later) - F.year(first)) * 12 + F.month(later) - F.month(first)


def parse_timestamp(text: Column, formats: list[str]) -> Column:
    """The first format that fits, then any text Spark itself can cast; else null."""
    squeezed = F.trim(text)
    attempts = [F.try_to_timestamp(squeezed, F.lit(f)) for f in formats]
    return F.coalesce(*attempts, squeezed.try_cast("timestamp")).cast("timestamp_ntz")


def elapsed_days(start: Column, end: Column) -> Column:
    """Days from start to end; null when either is missing or the interval is negative."""
    days = F.datediff(end, start)
    return F.when(days >= 0, days)


def period(kind: str, day: Column) -> tuple[Column, Column]:
    """The first and last day of the day, Monday-to-Sunday week or calendar month around ``day``.

    Of a literal day Spark folds both into literals, which reach the scan.
    """
    if kind == "daily":
        return day, day
    if kind not in ("weekly", "monthly"):
        raise ValueError(f"no such period: {kind}")
    start = F.trunc(day, "WEEK" if kind == "weekly" else "MM")
    return start, F.date_add(start, 6) if kind == "weekly" else F.last_day(day)


def preceding(start: Column, end: Column) -> tuple[Column, Column]:
    """The period of the same length that ends the day before ``start``."""
    last = F.date_sub(start, 1)
    return F.date_sub(last, F.datediff(end, start)), last
