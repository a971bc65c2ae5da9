"""Operators driven by configuration tables."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import rules as op
from ..operators.joins import lookup
from ..plans import settings
from .base import Tables, derived, derived_sql, inputs_sql, query

RULE_COLUMNS = (
    "source_attribute string, source_systems string, attribute string, operator string, "
    "match_value string, default_value string, priority int, active_value string, "
    "domain string, target_market string"
)
RULES = [
    ("P_NAME", "all", "p_name", "=", "null", "'NO NAME'", 1, "Y", "part", "NY"),
    ("P_SIZE", "all", "p_size", ">", "45", "45", 1, "y", "Part", "ny"),
    ("p_size", "all", "p_size", "<", "5", "5", 2, "Y", "part", "NY"),
    ("P_BRAND", "'PROMO','SMALL'", "p_brand", "=", "'Brand#3'", "'Brand#0'", 2, "Y", "part", "NY"),
    ("P_ BRAND", "all", "p_size", ">", "40", "'BIG'", 1, "Y", "part", "NY"),
    ("P_PRICE", "all", "p_price", "=", None, "0.00", 1, "Y", "part", "NY"),
    ("P_NAME", "all", "p_name", "=", "'red widget'", "'OFF'", 0, "N", "part", "NY"),
    ("P_NAME", "all", "p_name", "=", "'blue bolt'", "'CT ONLY'", 0, "Y", "part", "CT"),
    ("P_NAME", "all", "p_name", "=", "'blue bolt'", "'OTHER'", 0, "Y", "labs", "NY"),
]
PARTS = {
    "p_partkey": "p_partkey",
    "p_name": "CASE WHEN p_type = 'PROMO' THEN NULL WHEN p_type = 'SMALL' THEN '  ' "
    "WHEN p_type = 'LARGE' THEN '\n' ELSE p_name END",
    "source_system_sk": "p_type",
    "p_size": "p_size",
    "p_brand": "p_brand",
    "p_price": "CASE WHEN p_size > 10 THEN CAST(p_retailprice AS DECIMAL(18, 2)) END",
}


@query(
    f"""
    WITH p AS ({derived_sql('part', PARTS)})
    SELECT p_partkey,
        CASE WHEN p_name IS NULL OR length(trim(p_name)) = 0 OR p_name = chr(10) THEN 'NO NAME'
             ELSE p_name END AS p_name,
        source_system_sk,
        CAST(CASE WHEN p_size > 45 THEN 45 WHEN p_size < 5 THEN 5 ELSE p_size END AS BIGINT)
            AS p_size,
        CASE WHEN p_size > 40 THEN 'BIG'
             WHEN source_system_sk IN ('PROMO', 'SMALL') AND p_brand = 'Brand#3' THEN 'Brand#0'
             ELSE p_brand END AS p_brand,
        CAST(coalesce(p_price, 0) AS DOUBLE) AS p_price
    FROM p"""
)
def default_rules(t: Tables) -> DataFrame:
    table = t.spark.createDataFrame(RULES, RULE_COLUMNS)
    wanted = op.rules_for(table, "NY", "part")
    ruled = op.apply_default_rules(derived(t.part, PARTS), wanted)
    return ruled.withColumns(
        {"p_size": F.col("p_size").cast("long"), "p_price": F.col("p_price").cast("double")}
    )


# A list table built from the segments customers belong to.
LISTS = {
    "active_flg": "CASE WHEN c_mktsegment = 'FURNITURE' THEN 'N' ELSE 'Y' END",
    "reference": "'LINE_OF_BUSINESS'",
    "domain": "'Eligibility'",
    "consumer": "CASE WHEN c_mktsegment = 'MACHINERY' THEN 'SHOP' ELSE 'ALL' END",
    "market": "CASE WHEN c_mktsegment = 'BUILDING' THEN 'ALL' "
    "WHEN c_mktsegment = 'AUTOMOBILE' THEN 'CT' ELSE 'NY' END",
    "value_inclusion": "CASE WHEN c_nationkey < 20 THEN c_mktsegment || ',HOUSEHOLD' END",
    "value_exclusion": "CASE WHEN c_nationkey = 24 THEN 'BUILDING' END",
}


@query(
    f"""
    WITH l AS (SELECT DISTINCT * FROM ({derived_sql('customer', LISTS)})),
    rows AS (SELECT * FROM l WHERE active_flg = 'Y' AND consumer IN ('SHOP', 'ALL')
        AND market IN ('NY', 'ALL')),
    inc AS (SELECT DISTINCT unnest(string_split(value_inclusion, ',')) AS value FROM rows
        WHERE value_inclusion <> ''),
    exc AS (SELECT DISTINCT unnest(string_split(coalesce(value_exclusion, ''), ',')) AS value
        FROM rows),
    lob AS (SELECT c_custkey, CASE WHEN c_acctbal > 9500 THEN NULL
        ELSE lower(c_mktsegment) END AS lob FROM customer)
    SELECT c_custkey, lob, 'both' AS lists FROM lob
    WHERE upper(lob) IN (SELECT value FROM inc) AND upper(lob) NOT IN (SELECT value FROM exc)
    UNION ALL
    SELECT c_custkey, lob, 'none' AS lists FROM lob WHERE upper(lob) NOT IN ('')"""
)
def include_exclude_lists(t: Tables) -> DataFrame:
    table = derived(t.customer, LISTS).distinct()
    lob = F.when(~(F.col("c_acctbal") > 9500), F.lower("c_mktsegment"))
    rows = t.customer.select("c_custkey", lob.alias("lob"))

    def values(market: str, kind: str) -> DataFrame:
        return op.reference_list(
            table, market, "eligibility", "line_of_business", "shop", kind
        )

    both = op.apply_reference_lists(
        rows, "lob", values("NY", "inclusion"), values("NY", "exclusion")
    )
    unlisted = op.reference_list(
        table, "NY", "eligibility", "provider_group_tin", "shop", "exclusion"
    )
    none = op.apply_reference_lists(rows, "lob", exclude=unlisted)
    return both.withColumn("lists", F.lit("both")).unionByName(
        none.withColumn("lists", F.lit("none"))
    )


@query(
    """
    WITH c AS (SELECT r_regionkey, r_name, CASE WHEN r_regionkey < 3 THEN 'standard'
            ELSE 'extended' END AS sdm,
            list_contains(list(n_name), 'NATION_1') AS has_1,
            list_contains(list(n_name), 'NATION_13') AS has_13
        FROM region JOIN nation ON r_regionkey = n_regionkey GROUP BY ALL)
    SELECT u.c_custkey, CASE WHEN c.has_1 THEN c.sdm END AS sdm_1,
        CASE WHEN c.has_13 THEN c.sdm END AS sdm_13
    FROM customer u JOIN nation n ON u.c_nationkey = n.n_nationkey
    JOIN c ON n.n_regionkey = c.r_regionkey"""
)
def market_config(t: Tables) -> DataFrame:
    """Customers with the configuration of their region, if it serves a market.

    NATION_1 is also the beginning of NATION_13; only whole names count.
    """
    markets = F.array_join(F.collect_list("n_name"), '","')
    regions = lookup(
        t.nation, t.region, [("n_regionkey", "r_regionkey")], {"r_name": "r_name"}, how="inner"
    )
    config = regions.groupBy("n_regionkey", "r_name").agg(
        F.concat(F.lit('("'), markets, F.lit('")')).alias("markets"),
        F.lit("CLAIMS").alias("domain"),
        F.when(F.col("n_regionkey") < 3, "standard").otherwise("extended").alias("sdm"),
        F.lit("").alias("consumer"),
    )
    people = lookup(
        t.customer,
        t.nation,
        [("c_nationkey", "n_nationkey")],
        {"region": "n_regionkey"},
        how="inner",
    )
    for market in ("1", "13"):
        served = op.market_config(config, "claims", f"nation_{market}")
        people = lookup(people, served, [("region", "n_regionkey")], {f"sdm_{market}": "sdm"})
    return people.select("c_custkey", "sdm_1", "sdm_13")


SETTINGS = {
    "names": """
        SELECT '1,2' AS tenant, upper(n_name) AS target_market, 'FILE_' || n_name AS filename,
            CASE WHEN n_regionkey < 3 THEN 'SDM2' ELSE 'SDM3' END AS sdm_type,
            CASE WHEN n_nationkey % 2 = 0 THEN 'Y' ELSE 'N' END AS eid_applied
        FROM {nation} WHERE n_nationkey < 20""",
    "configs": """
        SELECT 'CLAIMS' AS domain, n_name AS markets, consumer, 'P' || consumer AS project,
            CAST(n_regionkey AS STRING) AS system, CAST(NULL AS STRING) AS status_set,
            CAST(n_nationkey + 1 AS STRING) AS lookback_months
        FROM (SELECT *, '' AS consumer FROM {nation}
            UNION ALL SELECT *, 'SHOP' AS consumer FROM {nation}) c
        WHERE consumer = '' OR n_nationkey % 3 = 0""",
    "rules": """
        SELECT 'label' AS source_attribute, 'all' AS source_systems, 'label' AS attribute,
            CAST(NULL AS STRING) AS operator, CAST(NULL AS STRING) AS match_value,
            '''' || n_name || consumer || '''' AS default_value, n_nationkey AS priority,
            CASE WHEN n_nationkey = 4 THEN 'N' ELSE 'Y' END AS active_value, 'Lab' AS domain,
            upper(n_name) AS target_market, consumer
        FROM (SELECT *, '' AS consumer FROM {nation}
            UNION ALL SELECT *, 'SHOP' AS consumer FROM {nation}) c""",
}
RUNS = ((3, ""), (3, "SHOP"), (4, ""), (13, "SHOP"))


def _settings(t: Tables) -> list[tuple[int, settings.RunSettings]]:
    tables = settings.SettingTables(**{name: t.sql(text) for name, text in SETTINGS.items()})
    names = {r.n_nationkey: r.n_name for r in t.nation.filter("n_nationkey < 20").collect()}
    day = date(2001, 8, 1)
    return [(n, settings.resolve(tables, names[n], (1, 2), day, consumer=who)) for n, who in RUNS]


def _runs_sql() -> str:
    rows = ", ".join(f"({n}, '{who}')" for n, who in RUNS)
    return f"""
    WITH {inputs_sql(SETTINGS)}, runs(nation, who) AS (VALUES {rows})"""


@query(
    _runs_sql()
    + """
    SELECT c_custkey, r.who, nm.filename AS prefix, nm.eid_applied = 'Y' AS enterprise,
        CASE nm.sdm_type WHEN 'SDM2' THEN 'standard' ELSE 'extended' END AS model,
        cf.project, CAST(cf.lookback_months AS INTEGER) AS months, '' AS status_set
    FROM customer JOIN runs r ON c_nationkey = r.nation JOIN nation n ON n.n_nationkey = r.nation
    JOIN names nm ON nm.target_market = upper(n.n_name)
    JOIN configs cf ON cf.markets = n.n_name AND cf.consumer = CASE WHEN EXISTS (
        SELECT 1 FROM configs o WHERE o.markets = n.n_name AND o.consumer = r.who) THEN r.who ELSE '' END"""
)
def config_lookups(t: Tables) -> DataFrame:
    """Customers of some markets with the settings of a run there, for a consumer or none; a
    consumer without a configuration gets that of the market."""
    frames = [
        t.customer.filter(F.col("c_nationkey") == nation).select(
            "c_custkey",
            F.lit(found.config.consumer).alias("who"),
            F.lit(found.config.file_prefix).alias("prefix"),
            F.lit(found.enterprise_ids).alias("enterprise"),
            F.lit(found.config.model).alias("model"),
            F.lit(found.config.project).alias("project"),
            F.lit(found.config.lookback_months).alias("months"),
            F.lit(found.config.status_set).alias("status_set"),
        )
        for nation, found in _settings(t)
    ]
    return reduce(DataFrame.unionByName, frames)


@query(
    _runs_sql()
    + """
    SELECT c_custkey, r.who, CASE WHEN c_acctbal >= 0 THEN c_name
        WHEN r.nation = 4 THEN NULL ELSE n_name || r.who END AS label
    FROM customer JOIN runs r ON c_nationkey = r.nation JOIN nation ON n_nationkey = c_nationkey"""
)
def settings_rules(t: Tables) -> DataFrame:
    """Defaults of a run's own market and consumer only; those of one market are not active."""
    label = F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("label")
    frames = []
    for nation, found in _settings(t):
        rows = t.customer.filter(F.col("c_nationkey") == nation)
        rows = rows.select("c_custkey", F.lit(found.config.consumer).alias("who"), label)
        frames.append(op.apply_default_rules(rows, found.rules("lab")))
    return reduce(DataFrame.unionByName, frames)
