"""Projection, filtering and de-duplication."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import as_column


def project(df: DataFrame, spec: Mapping[str, Column | str]) -> DataFrame:
    """Exactly the columns of ``spec`` (output name -> column name or expression), in order."""
    return df.select(*[as_column(value).alias(name) for name, value in spec.items()])


def scope_filter(
    df: DataFrame,
    tenants: Sequence[int],
    sources: Sequence[str] | str = "All",
    tenant: str = "tenant_sk",
    source: str = "source_system_sk",
) -> DataFrame:
    """Rows of the given tenants; ``All`` disables the source filter."""
    df = df.filter(F.col(tenant).isin(*tenants))
    return df if sources == "All" else df.filter(F.col(source).isin(*sources))


def live_rows(df: DataFrame, del_ind: str = "del_ind") -> DataFrame:
    return df.filter(F.col(del_ind) == 0)


def final_rows(df: DataFrame, flag: str = "final_status_flg") -> DataFrame:
    """Rows in final state; NULL counts as final."""
    return df.filter(F.coalesce(F.col(flag), F.lit("Y")) == "Y")


def split_by_flag(df: DataFrame, flag: str, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``columns`` of the rows with flag 0 and of those with flag 1."""
    return tuple(df.filter(F.col(flag) == value).select(*columns) for value in (0, 1))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key in the given order, which must be total.

    Spark keeps only the best row per key and input task before the shuffle, so a key that holds
    a large share of the rows reaches its reducer as one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn("__rank", F.row_number().over(window))
    return ranked.filter(F.col("__rank") == 1).drop("__rank")


def collapse_tenants(
    df: DataFrame,
    tenants: Sequence[int],
    columns: Sequence[str] = ("TENANT_SK", "SOURCE_SYSTEM_SK"),
) -> DataFrame:
    """With several tenants, set their keys to 0 and drop the duplicates this creates."""
    if len(tenants) < 2:
        return df
    zeroed = {c.upper() for c in columns}
    return df.select(
        *[
            F.lit(0).cast(f.dataType).alias(f.name) if f.name.upper() in zeroed else F.col(f.name)
            for f in df.schema.fields
        ]
    ).distinct()
