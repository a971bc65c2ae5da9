"""Delivered rows kept in a history, aged into an archive, then dropped."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import HISTORY, clean_strings

# Days a row stays in the history, and days until the archive drops it.
HISTORY_DAYS = 365
ARCHIVE_DAYS = 730


def history_rows(df: DataFrame, filename: str, loaded_at: datetime) -> DataFrame:
    """Rows as recorded: cleaned strings plus Filename, LoadTime and LoadDate (yyyyMMdd)."""
    stamped = df.withColumns(
        {
            "Filename": F.lit(filename),
            "LoadTime": F.lit(loaded_at.strftime("%Y-%m-%d %H:%M:%S.%f")[:-3]),
            "LoadDate": F.lit(loaded_at.strftime("%Y%m%d")),
        }
    )
    return clean_strings(stamped, HISTORY)


def append_history(history: DataFrame, rows: DataFrame) -> DataFrame:
    return history.unionByName(rows, allowMissingColumns=True)


def cutoff(today: date, days: int) -> str:
    return (today - timedelta(days=days)).strftime("%Y%m%d")


def apply_retention(
    history: DataFrame,
    archive: DataFrame,
    today: date,
    history_days: int = HISTORY_DAYS,
    archive_days: int = ARCHIVE_DAYS,
    column: str = "LoadDate",
) -> tuple[DataFrame, DataFrame]:
    """History and archive after ageing; rows exactly at a limit are kept.

    All conditions compare the load date with a constant, so on tables partitioned by it each
    side reads only its own partitions.
    """
    move = cutoff(today, history_days)
    drop = cutoff(today, archive_days)
    age = F.col(column)
    kept = history.filter((age >= move) | age.isNull())
    aged = history.filter((age < move) & (age >= drop))
    archived = archive.filter((age >= drop) | age.isNull())
    return kept, archived.unionByName(aged, allowMissingColumns=True)


def delete_where(df: DataFrame, equals: Mapping[str, object]) -> DataFrame:
    """All rows but those where every given column equals its value."""
    hit = F.lit(True)
    for name, value in equals.items():
        hit = hit & F.col(name).eqNullSafe(F.lit(value))
    return df.filter(~hit)


def rotate_extracts(
    current: DataFrame, archive: DataFrame, prefixes: Sequence[str], column: str = "Filename"
) -> tuple[DataFrame, DataFrame]:
    """Move the rows of earlier extracts, recognised by file name prefix, to the archive."""
    old = F.lit(False)
    for prefix in prefixes:
        old = old | F.coalesce(F.col(column).startswith(prefix), F.lit(False))
    return current.filter(~old), archive.unionByName(current.filter(old))
