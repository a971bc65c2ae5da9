"""Deleting what one consumer and market was sent from stored tables, as one repeatable unit."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .snapshots import append_log, read_log
from .tables import drop_matching, table_exists, write_table

# The partition columns of the stored tables, and the tables of a consumer.
MARKET, CONSUMER = "_MARKET", "_CONSUMER"
DOMAINS = (
    "LAB",
    "LOCATION",
    "MEMBER",
    "ELIGIBILITY",
    "EMPI_LPI_CROSSWALK",
    "MEMBER_HICN",
    "CLAIM_DETAIL",
    "CLAIM_HEADER",
    "PHARMACY",
    "POD",
    "PROVIDER",
    "PROVIDER_GROUP",
)
LOG_SCHEMA = "market string, consumer string, at timestamp_ntz, done boolean"
# How a missing consumer is written in a partition.
NONE = "__none"


def store_sent(df: DataFrame, name: str, market: str, consumer: str = "", path: str | None = None) -> None:
    """Append rows to a stored table, partitioned by market and consumer."""
    rows = df.withColumn(MARKET, F.lit(market.lower())).withColumn(CONSUMER, F.lit(consumer or NONE))
    write_table(rows, name, partition_by=[MARKET, CONSUMER], path=path)


def delete_consumer(
    spark: SparkSession,
    names: Sequence[str],
    market: str,
    consumer: str,
    log: str,
    now: datetime,
) -> None:
    """Drop the partitions of one market and consumer from all tables that exist.

    The log names the deletion before the first table and again after the last. Dropping twice does
    no harm, so one that was interrupted is done again, by the same call or by ``finish_deletes``.
    No rows are read or moved.
    """
    append_log(spark, log, [(market, consumer, now, False)], LOG_SCHEMA)
    values = {MARKET: market.lower(), CONSUMER: consumer or NONE}
    for name in names:
        if table_exists(spark, name):
            drop_matching(spark, name, values)
    append_log(spark, log, [(market, consumer, now, True)], LOG_SCHEMA)


def unfinished(spark: SparkSession, log: str) -> DataFrame:
    """Market and consumer of deletions that began and did not end."""
    ended = F.max("done").alias("done")
    rows = read_log(spark, log, LOG_SCHEMA).groupBy("market", "consumer", "at").agg(ended)
    return rows.filter(~F.col("done")).select("market", "consumer", "at")


def finish_deletes(spark: SparkSession, names: Sequence[str], log: str) -> int:
    """Repeat the deletions that were interrupted; returns their number."""
    rows = unfinished(spark, log).collect()
    for row in rows:
        delete_consumer(spark, names, row.market, row.consumer, log, row["at"])
    return len(rows)
