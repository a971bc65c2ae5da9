"""Registry of queries, and the frames they derive from the benchmark tables.

The benchmark tables hold no missing values, padding or earlier states. ``derived`` adds such
columns with SQL expressions that Spark and the checking engine both read; only this preparation
is shared, the operator under test is written separately on each side.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from ..session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# The last order date; runs count their lookback from here.
AS_OF = "2001-08-01"


class Tables:
    """The tables of one data folder by attribute; each schema is read once."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = tune(spark)
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        frame = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        setattr(self, name, frame)
        return frame

    def sql(self, text: str, **frames: DataFrame) -> DataFrame:
        """A derivation over ``{table}`` placeholders; ``frames`` stand in for tables."""
        text = text.replace("AS TIMESTAMP)", "AS TIMESTAMP_NTZ)")
        used = [name for name in NAMES if f"{{{name}}}" in text]
        return self.spark.sql(text, **{n: frames[n] if n in frames else getattr(self, n) for n in used})


def query(sql: str | None = None) -> Callable:
    def register(function: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        name = function.__name__
        QUERIES[name] = lambda spark, folder: function(Tables(spark, folder))
        if sql is not None:
            SQL[name] = sql
        return function

    return register


def derived(df: DataFrame, spec: Mapping[str, str]) -> DataFrame:
    zoneless = {k: v.replace("AS TIMESTAMP)", "AS TIMESTAMP_NTZ)") for k, v in spec.items()}
    return df.selectExpr(*[f"{expr} AS {name}" for name, expr in zoneless.items()])


def derived_sql(table: str, spec: Mapping[str, str]) -> str:
    columns = ", ".join(f"{expr} AS {name}" for name, expr in spec.items())
    return f"SELECT {columns} FROM {table}"


def inputs_sql(inputs: Mapping[str, str]) -> str:
    """The same derivations as a list of common table expressions."""
    plain = {name: name for name in NAMES}
    return ", ".join(f"{name} AS ({text.format(**plain)})" for name, text in inputs.items())
