"""Named tables and delimited configuration files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_query(spark: SparkSession, query: str, **parameters: object) -> DataFrame:
    """Run SQL text; values go in as named parameters (``:name``), never by concatenation."""
    return spark.sql(query, args=parameters or None)


def read_delimited(
    spark: SparkSession, path: str, columns: Sequence[str], sep: str = "|"
) -> DataFrame:
    """A delimited file with header, all columns text; blank fields are NULL."""
    schema = StructType([StructField(c, StringType()) for c in columns])
    return spark.read.csv(path, schema=schema, sep=sep, header=True, enforceSchema=False)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def write_table(
    df: DataFrame,
    name: str,
    mode: str = "append",
    partition_by: Sequence[str] = (),
    bucket_by: Sequence[str] = (),
    buckets: int = 0,
    path: str | None = None,
) -> None:
    """``overwrite`` (any case) replaces the table, every other mode appends.

    A state table bucketed by its merge key is not shuffled again by the next merge.
    """
    writer = df.write.mode("overwrite" if mode.lower() == "overwrite" else "append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def ensure_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Create an empty table with the schema of ``df`` unless it exists."""
    if not table_exists(df.sparkSession, name):
        write_table(df.limit(0), name, path=path)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:name)", args={"name": name})


def _drop(spark: SparkSession, name: str, partitions: DataFrame) -> None:
    """Drop the listed partitions, each by its values of all partition columns."""
    for row in partitions.collect():
        pairs = [part.split("=", 1) for part in row.partition.split("/")]
        spec = ", ".join(f"`{key}` = '{text}'" for key, text in pairs)
        spark.sql(
            f"ALTER TABLE IDENTIFIER(:name) DROP IF EXISTS PARTITION ({spec})", args={"name": name}
        )


def drop_where(spark: SparkSession, name: str, column: str, value: object) -> None:
    """Drop the partitions of a table whose ``column`` has that value; no data is read."""
    partitions = spark.sql("SHOW PARTITIONS IDENTIFIER(:name)", args={"name": name})
    hit = F.array_contains(F.split("partition", "/"), f"{column}={value}")
    _drop(spark, name, partitions.filter(hit))


def drop_matching(spark: SparkSession, name: str, values: Mapping[str, object]) -> None:
    """Drop the partitions of a table that have all these values; no data is read."""
    partitions = spark.sql("SHOW PARTITIONS IDENTIFIER(:name)", args={"name": name})
    parts = F.split("partition", "/")
    for column, value in values.items():
        partitions = partitions.filter(F.array_contains(parts, f"{column}={value}"))
    _drop(spark, name, partitions)


def overwrite_partitions(df: DataFrame, name: str) -> None:
    """Replace just the partitions of a table that ``df`` has rows for.

    ``insertInto`` takes the mode from the session only; without it the whole table would go.
    """
    spark = df.sparkSession
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:
        columns = spark.table(name).columns
        df.select(*columns).write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set(setting, before)


def drop_partitions(spark: SparkSession, name: str, column: str, before: str) -> None:
    """Drop the partitions of a table whose (text) value lies before the limit.

    Works on the partition list of the catalog; no data is read.
    """
    partitions = spark.sql("SHOW PARTITIONS IDENTIFIER(:name)", args={"name": name})
    value = F.regexp_extract("partition", f"{column}=([^/]*)", 1)
    _drop(spark, name, partitions.filter(value < before))
