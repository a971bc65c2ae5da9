"""Replacing protected values by their clear text from a vault table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import lookup


def detokenize(
    df: DataFrame,
    columns: Sequence[str],
    vault: DataFrame,
    token: str = "token",
    value: str = "value",
    spread_by: Sequence[str] = (),
) -> DataFrame:
    """Swap the tokens in ``columns`` for vault values; tokens not in the vault become NULL.

    The tokens of all columns are looked up in one join, one row each, and put back by the tokens
    that stood together; only these narrow rows meet the vault, which is read once. A token that
    the vault holds several times gets its greatest value.

    ``spread_by`` keeps rows without a token from meeting in one task.
    """
    order = df.columns
    names = [f"t{i}" for i in range(len(columns))]
    tokens = F.struct(*[F.col(c).cast("string").alias(n) for c, n in zip(columns, names)])
    some = F.coalesce(*[F.col(c).cast("string") for c in columns]).isNotNull()
    df = df.withColumn("__tokens", F.when(some, tokens))
    together = df.select("__tokens").filter(F.col("__tokens").isNotNull()).distinct()
    each = together.select(
        "__tokens", F.posexplode(F.array(*[F.col(f"__tokens.{n}") for n in names]))
    )
    each = each.filter(F.col("col").isNotNull())
    known = vault.select(F.col(token).alias("__token"), F.col(value).alias("__clear"))
    found = each.join(known, F.col("col") == F.col("__token"))
    clear = found.groupBy("__tokens").agg(
        *[F.max(F.when(F.col("pos") == i, F.col("__clear"))).alias(f"__{n}") for i, n in enumerate(names)]
    )
    df = lookup(
        df, clear, [("__tokens", "__tokens")], {f"__{n}": f"__{n}" for n in names}, spread_by=spread_by
    )
    return df.withColumns({c: F.col(f"__{n}") for c, n in zip(columns, names)}).select(*order)
