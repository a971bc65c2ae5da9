"""Current-state upsert, change sets and change classification."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.codes import ADJUSTMENT, BACKOUT, DELETE, ORIGINAL, UPDATE_TYPES

CHANGE = "_change_type"
INSERT, UPDATE, BEFORE, GONE = "insert", "update_postimage", "update_preimage", "delete"


def one_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None
) -> DataFrame:
    """One row per key: the first in ``order``, or an error when there are several."""
    window = Window.partitionBy(*keys).orderBy(*(order or [F.lit(1)]))
    ranked = df.withColumn("__rank", F.row_number().over(window))
    if order:
        return ranked.filter(F.col("__rank") == 1).drop("__rank")
    key = F.to_json(F.struct(*[F.col(k) for k in keys]))
    several = F.raise_error(F.concat(F.lit("several source rows for one key: "), key))
    checked = F.when(F.col("__rank") > 1, several.cast("boolean")).otherwise(F.lit(True))
    return ranked.filter((F.col("__rank") <= 2) & checked).drop("__rank")


def _complete(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def _paired(
    old: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column] | None,
    null_safe: bool,
) -> DataFrame:
    """Full outer join of two states with one row per key; sides are ``old.*`` and ``new.*``."""
    on = list(keys)
    if null_safe:
        # Struct equality treats NULL fields as equal, and the one key column serves the
        # uniqueness check and the join with a single shuffle.
        key, on = F.struct(*[F.col(k) for k in keys]), ["__key"]
        old, new = old.withColumn("__key", key), new.withColumn("__key", key)
    else:
        new = new.filter(_complete(keys))
    left = old.withColumn("__in", F.lit(True)).alias("old")
    right = one_per_key(new, on, order).withColumn("__in", F.lit(True)).alias("new")
    matches = [F.col(f"old.{k}") == F.col(f"new.{k}") for k in on]
    return left.join(right, reduce(lambda a, b: a & b, matches), "full_outer")


def upsert_by_fingerprint(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    fingerprint: str = "HASH",
    order: Sequence[Column] | None = None,
    null_safe: bool = True,
    pending: bool = False,
) -> DataFrame:
    """New state of ``target`` after merging ``source``, with the change of each row.

    A source row replaces the target row of its key when the fingerprints differ, and is added
    when the key is new; target rows that are gone from the source stay. ``_change_type`` is
    ``insert``, ``update_postimage`` or NULL (unchanged). One shuffle per side and one join give
    both merge arms and the change set.

    Several source rows for a key raise an error unless ``order`` says which one counts. NULL
    key parts match each other; with ``null_safe=False`` a source row with a NULL key part never
    matches and is added on every run, and a target bucketed by its keys is not shuffled.

    With ``pending`` the changes named in the target were not published yet and stay: a row that
    was inserted remains an insert, and an updated one an update.
    """
    pending = pending and CHANGE in target.columns
    before = target if pending else target.drop(CHANGE)
    paired = _paired(before, source, keys, order, null_safe)
    is_new = F.col("old.__in").isNull()
    differs = F.col("old.__in") & F.col("new.__in") & (
        F.col(f"old.{fingerprint}") != F.col(f"new.{fingerprint}")
    )
    fresh = F.when(is_new, INSERT).when(differs, UPDATE)
    waiting = F.col(f"old.{CHANGE}") if pending else F.lit(None)
    change = F.when(waiting == INSERT, waiting).otherwise(F.coalesce(fresh, waiting))
    state = paired.withColumn("__fresh", fresh).withColumn("__change", change).selectExpr(
        *[
            f"IF(__fresh IS NOT NULL, new.`{c}`, old.`{c}`) AS `{c}`"
            for c in target.drop(CHANGE).columns
        ],
        f"__change AS {CHANGE}",
    )
    if null_safe:
        return state
    unmatched = source.filter(~_complete(keys)).withColumn(CHANGE, F.lit(INSERT))
    return state.unionByName(unmatched)


def changed_rows(state: DataFrame, inserts_only: bool = False) -> DataFrame:
    """Inserted and updated rows of an upsert result."""
    wanted = (INSERT,) if inserts_only else (INSERT, UPDATE)
    return state.filter(F.col(CHANGE).isin(*wanted))


def snapshot_changes(
    old: DataFrame, new: DataFrame, keys: Sequence[str], fingerprint: str = "HASH"
) -> DataFrame:
    """Row changes between two states: inserts, deletes, and both images of updates."""
    paired = _paired(old.drop(CHANGE), new.drop(CHANGE), keys, None, True)
    columns = old.drop(CHANGE).columns

    def image(side: str, change: str) -> Column:
        values = [F.col(f"{side}.{c}").alias(c) for c in columns]
        return F.struct(F.lit(change).alias(CHANGE), *values)

    was, now = F.col("old.__in").isNotNull(), F.col("new.__in").isNotNull()
    differs = F.col(f"old.{fingerprint}") != F.col(f"new.{fingerprint}")
    images = (
        F.when(~was, F.array(image("new", INSERT)))
        .when(~now, F.array(image("old", GONE)))
        .when(differs, F.array(image("old", BEFORE), image("new", UPDATE)))
    )
    return paired.select(F.inline(images)).select(*columns, CHANGE)


def classify_changes(
    headers: DataFrame,
    line_changes: DataFrame,
    keys: Sequence[str] = ("SOURCE_SYSTEM_SK", "TENANT_SK", "CLAIM_NUMBER"),
    adjust: str = "CLAIM_ADJUST_TYPE",
    update_type: str = "UPDATE_TYPE",
) -> DataFrame:
    """Set ``UPDATE_TYPE`` of unclassified headers from their own and their lines' changes.

    ``headers`` is an upsert result; ``line_changes`` has the keys and ``_change_type`` of the
    changed lines, which are reduced to one row per claim before the join. Inserts win over
    updates; headers without an adjust type stay unclassified.
    """
    per_claim = line_changes.groupBy(*keys).agg(
        F.max(F.col(CHANGE) == INSERT).alias("__line_insert"),
        F.max(F.col(CHANGE) == UPDATE).alias("__line_update"),
    )
    on = [F.col(f"h.{k}") == F.col(f"l.{k}") for k in keys]
    joined = headers.alias("h").join(per_claim.alias("l"), on, "left")
    inserted = (F.col(CHANGE) == INSERT) | F.col("__line_insert")
    updated = (F.col(CHANGE) == UPDATE) | F.col("__line_update")
    own = F.col(CHANGE).isin(INSERT, UPDATE)
    kind = F.col(f"h.{adjust}")
    decided = (
        F.when((kind != DELETE) & inserted, ORIGINAL)
        .when(~kind.isin(DELETE, BACKOUT) & updated, ADJUSTMENT)
        .when((kind == DELETE) & own, DELETE)
        .when((kind == BACKOUT) & updated, BACKOUT)
    )
    current = F.col(f"h.{update_type}")
    value = F.when(current == "", F.coalesce(decided, current)).otherwise(current)
    return joined.select(
        *[value.alias(c) if c == update_type else F.col(f"h.{c}") for c in headers.columns]
    )


def reset_published(df: DataFrame, update_type: str = "UPDATE_TYPE") -> DataFrame:
    """Clear the classification after it was published."""
    value = F.col(update_type)
    return df.withColumn(
        update_type, F.when(F.trim(value).isin(*UPDATE_TYPES), F.lit("")).otherwise(value)
    )


def affected_keys(key: str, *changes: DataFrame) -> DataFrame:
    """Distinct keys of several change sets."""
    keys = changes[0].select(key)
    for change in changes[1:]:
        keys = keys.unionByName(change.select(key))
    return keys.distinct()


def select_published(
    headers: DataFrame, claim_keys: DataFrame, run_type: str, key: str = "CLAIM_NUMBER"
) -> tuple[DataFrame, DataFrame]:
    """Classified headers to send, and to record in history.

    Originals, adjustments and backouts count when their claim is in ``claim_keys``. Deletes are
    recorded always, and sent unless the run type is ``Hist``.
    """
    present = claim_keys.select(F.col(key).alias("__claim")).distinct()
    flagged = headers.filter(F.col("UPDATE_TYPE").isin(*UPDATE_TYPES)).join(
        present, F.col(key) == F.col("__claim"), "left"
    )
    deleted = F.col("UPDATE_TYPE") == DELETE
    recorded = flagged.filter(deleted | F.col("__claim").isNotNull()).drop("__claim")
    sent = recorded.filter(~deleted) if run_type == "Hist" else recorded
    return sent, recorded
