"""Tables kept as one directory per version, with a small log of committed versions.

A run writes a complete new version next to the one it reads and then appends one row to the log.
Readers go through the log, so a version whose write was cut off is never seen, and no input is
overwritten while it is read.
"""

from __future__ import annotations

from datetime import datetime
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..functions import dates

# Hours a past version may be read back, outside and inside production.
MAX_AGE_HOURS = 23
MAX_AGE_HOURS_PRODUCTION = 2159

REBUILD, MERGE, RELEASED = "REBUILD", "MERGE", "RELEASED"
LOG_SCHEMA = "version long, committed_at timestamp_ntz, operation string, folder string"


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of a log, none before its first one."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        # Any other cause must not read as an empty log.
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def append_log(spark: SparkSession, path: str, rows: list[tuple], schema: str) -> None:
    """Add rows in one file, so that all of them count or none."""
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def version_log(spark: SparkSession, root: str) -> DataFrame:
    return read_log(spark, f"{root}/log", LOG_SCHEMA)


def latest_version(log: DataFrame, operation: str | None = None) -> DataFrame:
    """The log row of the highest version, of one operation if named."""
    rows = log if operation is None else log.filter(F.col("operation") == operation)
    if "folder" in log.columns:
        # Of two writers of one version the first folder by name counts, for every reader.
        rows = rows.filter(F.col("folder").isNotNull())
        return rows.orderBy(F.col("version").desc(), "folder").limit(1)
    return rows.orderBy(F.col("version").desc()).limit(1)


def readable(log: DataFrame) -> DataFrame:
    """The versions that can be read: one row each, none of those released."""
    gone = log.filter(F.col("operation") == RELEASED).select("version")
    rows = log.filter(F.col("folder").isNotNull()).join(gone, "version", "left_anti")
    first = F.min(F.struct("folder", "committed_at", "operation")).alias("row")
    rows = rows.groupBy("version").agg(first)
    return rows.select("version", "row.committed_at", "row.operation", "row.folder")


def latest_times(log: DataFrame) -> DataFrame:
    """Last commit time per operation."""
    return log.groupBy("operation").agg(F.max("committed_at").alias("committed_at"))


def rebuild_time(
    log: DataFrame, now: Column, max_age_hours: int = MAX_AGE_HOURS
) -> DataFrame:
    """Time of the last full rebuild if it is recent enough to be read back, else no row."""
    age = F.make_dt_interval(hours=F.lit(max_age_hours))
    last = latest_times(log).filter(F.col("operation") == REBUILD)
    return last.filter(F.col("committed_at") + age > now).select("committed_at")


def row_as_of(log: DataFrame, as_of: datetime | None) -> Row | None:
    rows = readable(log)
    if as_of is not None:
        rows = rows.filter(F.col("committed_at") <= dates.timestamp(as_of))
    return latest_version(rows).first()


def write_snapshot(
    df: DataFrame, root: str, committed_at: datetime, operation: str = MERGE
) -> int:
    """Write the next version and commit it; returns its number.

    Every write has a folder of its own, so nothing that another version or an interrupted write
    left is written over. Of two writers that commit one number one counts; the other gets an error.
    """
    spark = df.sparkSession
    version = next_version(latest_version(version_log(spark, root)).first())
    folder = f"version={version}-{uuid4().hex}"
    df.write.mode("errorifexists").parquet(f"{root}/{folder}")
    commit_version(spark, root, version, committed_at, operation, folder)
    return version


def next_version(last: Row | None) -> int:
    return 1 if last is None else last.version + 1


def commit_version(
    spark: SparkSession, root: str, version: int, committed_at: datetime, operation: str, folder: str
) -> None:
    """Add a written version to the log; an error if another writer's folder counts for it."""
    append_log(spark, f"{root}/log", [(version, committed_at, operation, folder)], LOG_SCHEMA)
    same = version_log(spark, root).filter(F.col("version") == version)
    if latest_version(same).first().folder != folder:
        raise RuntimeError(f"version {version} of {root} was written twice")


def read_snapshot(spark: SparkSession, root: str, as_of: datetime | None = None) -> DataFrame:
    """The last version committed by ``as_of``, or the current one.

    A time before the first commit is an error rather than an empty table.
    """
    row = row_as_of(version_log(spark, root), as_of)
    if row is None:
        raise LookupError(f"no version of {root} committed by {as_of}")
    return read_version(spark, root, row)


def read_before(spark: SparkSession, root: str, operation: str) -> DataFrame | None:
    """The version before the one that ``operation`` wrote, None if it wrote none."""
    log = version_log(spark, root)
    written = latest_version(log, operation).first()
    if written is None:
        return None
    earlier = log.filter((F.col("version") < written.version) & F.col("folder").isNotNull())
    return read_version(spark, root, latest_version(earlier).first())


def read_version(spark: SparkSession, root: str, row: Row) -> DataFrame:
    if row.folder.startswith("buckets-"):
        from .buckets import read_buckets

        return read_buckets(spark, root, row.folder)
    return spark.read.parquet(f"{root}/{row.folder}")


def has_snapshot(spark: SparkSession, root: str) -> bool:
    return latest_version(version_log(spark, root)).first() is not None


def read_rebuilt(
    spark: SparkSession,
    root: str,
    rebuilds: DataFrame,
    now: datetime,
    production: bool = False,
) -> DataFrame:
    """Read ``root`` as of the last rebuild logged in ``rebuilds`` when that is recent enough.

    Otherwise the current version is read.
    """
    hours = MAX_AGE_HOURS_PRODUCTION if production else MAX_AGE_HOURS
    found = rebuild_time(rebuilds, dates.timestamp(now), hours).first()
    return read_snapshot(spark, root, None if found is None else found.committed_at)


def read_as_of(df: DataFrame, column: str, as_of: Column | datetime) -> DataFrame:
    """The snapshot of ``as_of`` from a table that keeps all snapshots, told apart by ``column``.

    The snapshot is found by a scalar subquery, which prunes partitions when ``column`` is one.
    """
    time = as_of if isinstance(as_of, Column) else dates.timestamp(as_of)
    chosen = df.filter(F.col(column) <= time).agg(F.max(column)).scalar()
    return df.filter(F.col(column) == chosen)
