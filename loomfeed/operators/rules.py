"""Operators driven by small configuration tables."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ..functions.text import lookup_key


def rules_for(
    rules: DataFrame, market: str, domain: str, consumer: str | None = None
) -> DataFrame:
    """Active rules of one market, domain and (where the table has one) consumer."""
    kept = rules.filter(
        (F.upper("active_value") == "Y")
        & (F.lower("domain") == domain.lower())
        & (F.upper("target_market") == market.upper())
    )
    if "consumer" in rules.columns:
        kept = kept.filter(F.upper(F.coalesce("consumer", F.lit(""))) == (consumer or "").upper())
    return kept


def _rule_condition(rule: Row) -> Column:
    tested = F.col(rule.attribute.strip())
    match = (rule.match_value or "").strip()
    operator = (rule.operator or "=").strip()
    if match.lower() in ("", "null"):
        blank = tested.cast("string")
        condition = blank.isNull() | (F.length(F.trim(blank)) == 0) | (blank == "\n")
    elif operator == "<":
        condition = tested < F.expr(match)
    elif operator == ">":
        condition = tested > F.expr(match)
    else:
        condition = tested == F.expr(match)
    systems = (rule.source_systems or "all").strip()
    if systems.lower() == "all":
        return condition
    wanted = [s.strip().strip("'") for s in systems.split(",")]
    return F.col("source_system_sk").cast("string").isin(*wanted) & condition


def apply_default_rules(df: DataFrame, rules: DataFrame) -> DataFrame:
    """Replace columns by data-driven defaults, keeping column order and types.

    ``rules`` has source_attribute, source_systems (comma list or ``all``), attribute,
    operator (``=``, ``<``, ``>``), match_value (SQL literal; NULL, blank or ``null`` tests for a
    missing value), default_value (SQL expression) and priority. The first matching rule of a
    column wins, in priority order. Rules become one CASE per column in a single projection that
    reads the incoming values of all columns. Only the distinct rules for columns of ``df`` reach
    the driver, as they become part of its plan.
    """
    by_column: dict[str, list[Row]] = defaultdict(list)
    named = rules.withColumn("__name", lookup_key("source_attribute"))
    named = named.filter(F.col("__name").isin([c.upper() for c in df.columns])).distinct()
    for rule in named.orderBy("priority").collect():
        by_column[rule["__name"]].append(rule)
    if not by_column:
        return df
    columns = []
    for field in df.schema.fields:
        value = F.col(field.name)
        chain = None
        for rule in by_column.get(field.name.upper(), []):
            default = F.expr(rule.default_value).cast(field.dataType)
            condition = _rule_condition(rule)
            chain = F.when(condition, default) if chain is None else chain.when(condition, default)
        columns.append(value if chain is None else chain.otherwise(value).alias(field.name))
    return df.select(*columns)


def reference_list(
    table: DataFrame, market: str, domain: str, reference: str, consumer: str, kind: str
) -> DataFrame:
    """Values of one include or exclude list, one per row in column ``value``.

    ``kind`` is ``inclusion`` or ``exclusion``. Rows of the market and of ``ALL`` markets both
    count. A list without rows holds the single blank value, so that an empty include list keeps
    only blank values and an empty exclude list drops only those.
    """
    column = {"inclusion": "value_inclusion", "exclusion": "value_exclusion"}[kind]
    rows = table.filter(
        (F.col("active_flg") == "Y")
        & (F.col("reference") == reference.upper())
        & (F.col("domain") == domain.lower().capitalize())
        & F.col("consumer").isin(consumer.upper(), "ALL")
        & F.col("market").isin(market.upper(), "ALL")
    )
    if kind == "inclusion":
        rows = rows.filter(F.col(column) != "")
    values = rows.select(
        F.explode(F.split(F.coalesce(F.col(column), F.lit("")), ",")).alias("value")
    ).distinct()
    blank = table.sparkSession.range(1).select(F.lit("").alias("value"))
    return values.unionByName(blank.filter(~values.exists()))


# A list of up to this many values becomes part of the plan; a longer one is joined.
LITERAL_VALUES = 10_000


def _listed(values: DataFrame, most: int) -> list[str] | None:
    """The values of a list of bounded size, None for a longer one."""
    found = values.select("value").filter(F.col("value").isNotNull()).limit(most + 1).collect()
    return None if len(found) > most else [r.value for r in found]


def apply_reference_lists(
    df: DataFrame,
    column: str,
    include: DataFrame | None = None,
    exclude: DataFrame | None = None,
    literal_values: int = LITERAL_VALUES,
) -> DataFrame:
    """Keep rows whose upper-cased value is in ``include`` and not in ``exclude``.

    As with SQL ``IN``/``NOT IN``, a row whose value is NULL passes neither list. A list of up to
    ``literal_values`` values is written into the filter, so the facts are not shuffled by a value
    that a third of them may share; a longer one is joined.
    """
    df = df.withColumn("__value", F.upper(F.col(column)))
    for values, wanted in ((include, True), (exclude, False)):
        if values is None:
            continue
        listed = _listed(values, literal_values)
        if listed is not None:
            hit = F.col("__value").isin(listed) if listed else F.lit(False)
            df = df.filter(F.col("__value").isNotNull() & (hit if wanted else ~hit))
            continue
        known = values.select(F.col("value").alias("__value"))
        df = df.filter(F.col("__value").isNotNull())
        df = df.join(known, "__value", "left_semi" if wanted else "left_anti")
    return df.drop("__value")


def market_config(
    config: DataFrame, domain: str, market: str, consumer: str = ""
) -> DataFrame:
    """Configuration rows whose market list holds ``market`` exactly.

    ``markets`` is one market or a list such as ``("UT","AZ")``. A consumer's own rows win;
    without any, the rows for no consumer apply.
    """
    listed = F.split(F.regexp_replace(F.upper("markets"), r'[()"\s]', ""), ",")
    rows = config.filter(
        (F.upper("domain") == domain.upper()) & F.array_contains(listed, market.upper())
    )
    named = F.upper(F.coalesce("consumer", F.lit("")))
    general = rows.filter(named == "")
    if not consumer:
        return general
    own = rows.filter(named == consumer.upper())
    return own.unionByName(general.filter(~own.exists()))


def config_value(rows: DataFrame, column: str, default: str = "") -> str:
    """The value of ``column``, or ``default`` when there is none; several are an error."""
    found = rows.filter(F.col(column).isNotNull()).select(column).distinct().limit(2).collect()
    if len(found) > 1:
        raise ValueError(f"several values of {column}: {found[0][0]!r}, {found[1][0]!r}, ...")
    return str(found[0][0]) if found else default


def file_prefix(names: DataFrame, tenant: str, market: str) -> str:
    rows = names.filter((F.col("tenant") == tenant) & (F.col("target_market") == market.upper()))
    return config_value(rows, "filename")


def model_type(names: DataFrame, market: str) -> str:
    return config_value(names.filter(F.col("target_market") == market.upper()), "sdm_type")


def enterprise_id_applied(names: DataFrame, market: str) -> str:
    return config_value(names.filter(F.col("target_market") == market.upper()), "eid_applied")


def markets_of(names: DataFrame, sdm_type: str) -> Sequence[str]:
    rows = names.filter(F.col("sdm_type") == sdm_type).select("target_market").distinct()
    return sorted(r.target_market for r in rows.collect())
