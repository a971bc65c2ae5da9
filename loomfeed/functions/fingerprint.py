"""Row fingerprints for change detection."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fingerprint(columns: Iterable[str]) -> Column:
    """md5 over length-prefixed texts, NULL as ``~``.

    The prefix makes the encoding unambiguous: neither a value that moves to the next column nor
    one that contains the separator can collide, which ``hash``/``xxhash64`` (they skip NULL)
    do not guarantee.
    """
    parts = []
    for name in columns:
        text = f"CAST(`{name}` AS STRING)"
        parts.append(f"coalesce(concat(octet_length({text}), ':', {text}), '~')")
    return F.expr(f"md5(concat_ws('|', {', '.join(parts)}))")


def row_fingerprint(df: DataFrame, exclude: Iterable[str] = (), alias: str = "HASH") -> DataFrame:
    """Add (or recompute) ``alias`` over all other columns except the named exclusions."""
    skipped = {name.upper() for name in exclude} | {alias.upper()}
    kept = [c for c in df.columns if c.upper() not in skipped]
    return df.withColumn(alias, fingerprint(kept))
