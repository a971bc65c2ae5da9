"""The control table of extract times: file_name, last_extract_dt, previous_last_extract_dt."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates

# Fixed value: the domain whose time the other domains take over.
INSCOPE = "inscope_patient"


def watermark(control: DataFrame, domain: str = INSCOPE) -> Column:
    """Last extract time of ``domain`` as a scalar subquery."""
    row = control.filter(F.col("file_name") == domain)
    return row.agg(F.max("last_extract_dt")).scalar()


def read_watermark(control: DataFrame, domain: str = INSCOPE) -> datetime | None:
    row = control.filter(F.col("file_name") == domain).select("last_extract_dt").first()
    return None if row is None else row[0]


def advance_watermark(
    control: DataFrame,
    domain: str,
    to: datetime | Column | None = None,
    previous: datetime | Column | None = None,
    keep_previous: bool = False,
) -> DataFrame:
    """Set the last time of ``domain``, and the previous one to its old last time.

    Without ``to``, the time of the in-scope domain is taken over. ``previous`` sets another
    previous time; ``keep_previous`` leaves it as it is.
    """
    own = F.col("file_name") == domain
    dtype = control.schema["last_extract_dt"].dataType
    time = _time(watermark(control) if to is None else to).cast(dtype)
    last = F.when(own, time).otherwise(F.col("last_extract_dt"))
    before = F.col("previous_last_extract_dt")
    if not keep_previous:
        old = F.col("last_extract_dt") if previous is None else _time(previous).cast(dtype)
        before = F.when(own, old).otherwise(before)
    return control.select(
        "file_name",
        last.alias("last_extract_dt"),
        before.alias("previous_last_extract_dt"),
        *[
            c
            for c in control.columns
            if c not in ("file_name", "last_extract_dt", "previous_last_extract_dt")
        ],
    )


def _time(value: datetime | Column) -> Column:
    return value if isinstance(value, Column) else dates.timestamp(value)
