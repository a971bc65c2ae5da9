"""Lookups, cohort joins and key filters.

No join here hints a broadcast: Spark broadcasts a side when its size statistic (or its measured
size at run time) is below the threshold and shuffles it otherwise. Shuffled lookups can carry a
salt, so that neither rows without a match nor one frequent key pile up in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import as_column

Key = Column | str
SPREAD = 1 << 20


def join_condition(
    facts: DataFrame, dim: DataFrame, text: str, left: str = "e", right: str = "d"
) -> Column:
    """A condition given as text over both sides of a join, named by the aliases.

    It is resolved against the two frames before it is used: an unknown or ambiguous column is an
    error, and so is anything that is not true or false for one pair of rows.
    """
    condition = F.expr(text)
    pair = facts.alias(left).limit(0).join(dim.alias(right).limit(0), F.lit(True), "inner")
    field = pair.select(condition.alias("condition")).schema["condition"]
    if field.dataType.simpleString() != "boolean":
        raise ValueError(f"not a condition: {text}")
    return condition


def join_where(
    facts: DataFrame,
    dim: DataFrame,
    on: Sequence[tuple[str, str]],
    condition: str,
    where: Column | None = None,
    left: str = "e",
    right: str = "d",
) -> DataFrame:
    """Facts with a row of ``dim`` that has their keys and meets ``condition``, once for each.

    ``condition`` is text as in ``join_condition``; it is part of the join, as are the keys.
    """
    dim = dim if where is None else dim.filter(where)
    checked = join_condition(facts, dim, condition, left, right)
    keys = [F.col(f"{left}.{a}") == F.col(f"{right}.{b}") for a, b in on]
    joined = facts.alias(left).join(dim.alias(right), _all([*keys, checked]))
    return joined.select(f"{left}.*")


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def lookup(
    facts: DataFrame,
    dim: DataFrame,
    on: Sequence[tuple[Key, Key]],
    take: Mapping[str, Key],
    how: str = "left",
    where: Column | None = None,
    left_where: Column | None = None,
    spread_by: Sequence[str] = (),
    salts: int = 1,
) -> DataFrame:
    """Add the columns ``take`` (output name -> dimension column) to ``facts``.

    ``on`` pairs fact and dimension keys, which may be expressions. ``where`` filters the
    dimension before the join. ``left_where`` limits which fact rows look for a match; in a left
    join the others keep NULLs.

    ``spread_by`` names fact columns that tell rows apart, such as a surrogate key. It is for
    foreign keys that are often NULL or excluded by ``left_where``: rows that cannot match get a
    key part of their own and spread over all partitions instead of meeting in one. ``salts`` > 1
    also splits every key over that many partitions by copying the dimension, for a key known to
    hold a large share of the facts. Leave both off when several joins use one key, so that they
    share one shuffle.
    """
    dim = dim if where is None else dim.filter(where)
    names = [f"__key{i}" for i in range(len(on))]
    right = dim.select(
        *[as_column(key).alias(name) for (_, key), name in zip(on, names)],
        *[as_column(column).alias(out) for out, column in take.items()],
    ).filter(_all([F.col(name).isNotNull() for name in names]))
    left_keys = [as_column(key) for key, _ in on]
    condition = [key == F.col(name) for key, name in zip(left_keys, names)]
    left = facts
    if left_where is not None:
        condition.append(left_where)
    if salts > 1 and not spread_by:
        raise ValueError("salts need spread_by")
    if salts > 1 or (spread_by and how == "left"):
        row = F.xxhash64(*spread_by)
        match = _all([key.isNotNull() for key in left_keys])
        match = match if left_where is None else match & F.coalesce(left_where, F.lit(False))
        own = F.pmod(row, F.lit(salts)).cast("int") if salts > 1 else F.lit(0)
        apart = F.pmod(row, F.lit(SPREAD)).cast("int") + F.lit(salts)
        left = facts.withColumn("__salt", F.when(match, own).otherwise(apart))
        copies = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
        right = right.select("*", copies.alias("__copy"))
        condition.append(F.col("__salt") == F.col("__copy"))
    joined = left.join(right, _all(condition), how)
    return joined.drop(*names, "__salt", "__copy")


def crosswalk(
    facts: DataFrame,
    code_map: DataFrame,
    code: Key,
    out: str,
    system: str,
    code_set: str,
    spread_by: Sequence[str] = (),
) -> DataFrame:
    """Target value of a standard code for one receiving system and code set."""
    wanted = (F.col("sys_of_ctrl_name") == system) & (F.col("target_cd_set_name") == code_set)
    return lookup(
        facts,
        code_map,
        [(code, "std_cd_val")],
        {out: "target_cd_val"},
        where=wanted,
        spread_by=spread_by,
    )


def role_lookup(
    facts: DataFrame,
    dim: DataFrame,
    key: Key,
    roles: Mapping[str, Key],
    value: Key,
    spread_by: Sequence[str] = (),
) -> DataFrame:
    """Look one dimension up once per role: ``roles`` maps output column -> fact key."""
    for out, fact_key in roles.items():
        facts = lookup(facts, dim, [(fact_key, key)], {out: value}, spread_by=spread_by)
    return facts


def rollup_amount(
    lines: DataFrame, keys: Sequence[str], amount: Key, out: str, where: Column | None = None
) -> DataFrame:
    """Sum per key; rows are summed inside each input task before the shuffle."""
    lines = lines if where is None else lines.filter(where)
    return lines.groupBy(*keys).agg(F.sum(as_column(amount)).alias(out))


def attach_rollup(
    headers: DataFrame,
    lines: DataFrame,
    keys: Sequence[tuple[str, str]],
    amount: Key,
    out: str,
    where: Column | None = None,
) -> DataFrame:
    """Sum the lines first, then left-join one row per key."""
    totals = rollup_amount(lines, [right for _, right in keys], amount, out, where)
    return lookup(headers, totals, keys, {out: out})


def in_scope(
    facts: DataFrame,
    cohort: DataFrame,
    on: Sequence[tuple[Key, Key]],
    where: Column | None = None,
    until: tuple[Key, Key] | None = None,
    take: Mapping[str, Key] | None = None,
    spread_by: Sequence[str] = (),
    salts: int = 1,
) -> DataFrame:
    """Keep the facts of cohort members, with ``until`` only up to the member's last day.

    ``until`` is (fact date, cohort date); it stays a residual condition of the equi join.
    """
    taken = {**(take or {}), **({} if until is None else {"__until": until[1]})}
    joined = lookup(
        facts, cohort, on, taken, how="inner", where=where, spread_by=spread_by, salts=salts
    )
    if until is None:
        return joined
    return joined.filter(as_column(until[0]) <= F.col("__until")).drop("__until")


def last_eligible(
    cohort: DataFrame, keys: Sequence[str], last_day: str, where: Column | None = None
) -> DataFrame:
    """One row per cohort member with the latest of its last eligible days."""
    cohort = cohort if where is None else cohort.filter(where)
    return cohort.groupBy(*keys).agg(F.max(last_day).alias(last_day))


def expand_identities(
    facts: DataFrame,
    patients: DataFrame,
    links: DataFrame,
    fact_key: str,
    patient_key: str,
    source: str,
    fact_where: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Patients with facts, and the ids they share an enterprise id with, in factored form.

    Returns ``(ids, partners)``: ``ids`` has one row per patient with facts and the enterprise
    id it belongs to (NULL without one, or where ``fact_where`` excludes all its facts);
    ``partners`` lists the ids of ``source`` under each of those enterprise ids. The pairs are
    ``ids`` joined with ``partners``; they are not formed here, as an enterprise id with many
    members would produce their product.
    """
    live = facts.select(
        F.col(fact_key).alias("__fact"),
        (F.lit(True) if fact_where is None else fact_where).alias("__linked"),
    )
    seen = live.groupBy("__fact").agg(F.max("__linked").alias("__linked"))
    members = lookup(
        patients, seen, [(patient_key, "__fact")], {"__linked": "__linked"}, how="inner"
    )
    own = links.select("source_patient_id", "enterprise_id").distinct()
    ids = lookup(
        members.select("source_patient_id", "__linked"),
        own,
        [("source_patient_id", "source_patient_id")],
        {"enterprise_id": "enterprise_id"},
        left_where=F.col("__linked"),
        spread_by=["source_patient_id"],
    ).select(F.col("source_patient_id").alias("hum_id"), "enterprise_id").distinct()
    partners = keep_keys(
        links.filter(F.col("source") == source).select("enterprise_id", "source_patient_id"),
        ids,
        ["enterprise_id"],
    ).distinct()
    return ids, partners


def keep_keys(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key occurs in ``keys`` (NULL keys never do)."""
    return df.join(keys.select(*on).distinct(), list(on), "left_semi")


def near_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` that a join with ``keys`` on one column could match.

    For wide or derived rows ahead of their join with few keys: as ``keep_keys``, but repeated keys
    are not gathered first. Spark moves the test ahead of the joins that ``df`` is made of, so few
    rows reach them; sums are to be made from its result.
    """
    wanted = keys.select(F.col(key).alias("__near"))
    return df.join(wanted, F.col(key) == F.col("__near"), "left_semi")


def drop_keys(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key does not occur in ``keys``."""
    return df.join(keys.select(*on).distinct(), list(on), "left_anti")


def exists_flag(df: DataFrame, keys: DataFrame, on: Sequence[str], out: str) -> DataFrame:
    """Add a boolean: the key occurs in ``keys``. Usable where a condition mixes OR and EXISTS."""
    present = keys.select(*on).distinct()
    flagged = lookup(df, present, [(c, c) for c in on], {out: F.lit(True)})
    return flagged.withColumn(out, F.col(out).isNotNull())


def latest_batch(df: DataFrame, column: str) -> DataFrame:
    """Rows of the last load: ``column`` equals its maximum (a scalar subquery)."""
    newest = df.agg(F.max(column)).scalar()
    return df.filter(F.col(column) == newest)
