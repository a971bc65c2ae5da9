"""Date rules. Timestamps are wall-clock values without a zone."""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import as_column

# Earliest date kept, placeholder dates, open end, and the first day of the newer
# diagnosis code set.
FLOOR = "1900-01-01"
PLACEHOLDERS = ("1753-01-01", "1111-01-08", "8888-12-31")
OPEN_END = "9999-12-31"
CODE_SET_CHANGE = "2015-10-01"
# Fixed value: months looked back when no start is known.
DEFAULT_LOOKBACK = 39


def timestamp(value: str | datetime) -> Column:
    """A wall-clock constant, independent of the session time zone."""
    return F.lit(str(value)).cast("timestamp_ntz")


def day(value: Column | date | str) -> Column:
    if isinstance(value, Column):
        return value
    return F.lit(value).cast("date")


def floor_date(value: Column | str, mode: str = "clamp") -> Column:
    """Dates before 1900 become 1900-01-01 (``clamp``) or NULL (``null``)."""
    if mode not in ("clamp", "null"):
        raise ValueError(f"unknown mode {mode!r}")
    value = as_column(value)
    early = value < timestamp(FLOOR)
    return F.when(early, timestamp(FLOOR) if mode == "clamp" else None).otherwise(value)


def null_dates(value: Column | str, placeholders: tuple[str, ...] = PLACEHOLDERS) -> Column:
    value = as_column(value)
    return F.when(value.isin(*[timestamp(p) for p in placeholders]), None).otherwise(value)


def statement_from(service_from: Column | str, service: Column | str) -> Column:
    return F.coalesce(as_column(service_from), as_column(service))


def statement_to(
    service_thru: Column | str, service_from: Column | str, service: Column | str
) -> Column:
    """End of service if known (NULL when before 1900), else its start, else the service date."""
    thru = as_column(service_thru)
    start = statement_from(service_from, service)
    return F.when(thru.isNull(), start).otherwise(floor_date(thru, "null"))


def lookback_start(as_of: Column | date | str, months: int) -> Column:
    """First day of the month ``months`` before the month of ``as_of``."""
    return F.add_months(F.trunc(day(as_of), "MM"), -months)


def default_start(today: date, months: int = DEFAULT_LOOKBACK) -> datetime:
    """Last extract time assumed when none is recorded: a month start, as in lookbacks."""
    month = today.year * 12 + today.month - 1 - months
    return datetime(month // 12, month % 12 + 1, 1)


def within_lookback(
    value: Column | str, months: int, as_of: Column | date | str, open_ended: bool = False
) -> Column:
    """On or after the lookback start; ``open_ended`` reads NULL as never ending."""
    value = as_column(value)
    recent = value >= lookback_start(as_of, months).cast("timestamp_ntz")
    # NULL counts as 9999-12-31, which no lookback start can pass.
    return recent | value.isNull() if open_ended else recent


def any_within_lookback(
    values: list[Column | str], months: int, as_of: Column | date | str
) -> Column:
    return reduce(lambda a, b: a | b, [within_lookback(v, months, as_of) for v in values])


def lookback_as_of(snapshot: date | None, today: date) -> date:
    """Look back from the snapshot when it lies in another calendar month, else from today."""
    if snapshot is None or (snapshot.year, snapshot.month) == (today.year, today.month):
        return today
    return snapshot


def time_of_day(value: Column | str) -> Column:
    return F.date_format(as_column(value), "HH:mm:ss.SSS")


def timestamp_text(value: Column | str) -> Column:
    return F.date_format(as_column(value), "yyyy-MM-dd HH:mm:ss.SSS")


def code_era(value: Column | str) -> Column:
    return F.when(as_column(value) < timestamp(CODE_SET_CHANGE), 9).otherwise(0)


def file_token(value: Column | str) -> Column:
    return F.date_format(as_column(value), "yyMMdd")


def load_date(value: Column | str) -> Column:
    return F.date_format(as_column(value), "yyyyMMdd")


def valid_date(value: Column | str) -> Column:
    """True for a real calendar day written year-month-day; NULL and anything else is False."""
    return F.try_to_timestamp(as_column(value), F.lit("yyyy-M-d")).isNotNull()


def report_name(
    prefix: Column | str,
    run_type: Column | str,
    label: Column | str,
    last: Column | str,
    current: Column | str,
) -> Column:
    """``prefix_runtype_label_yyMMdd_yyMMdd`` from the last and the current extract time."""
    parts = [as_column(prefix), as_column(run_type), as_column(label)]
    return F.concat_ws("_", *parts, file_token(last), file_token(current))
