"""Lookups, semi joins, unions and grouped sums."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.changes import affected_keys as affected
from ..operators.detokenize import detokenize as reveal
from ..operators.joins import (
    attach_rollup,
    drop_keys,
    exists_flag,
    keep_keys,
    latest_batch,
    lookup,
)
from ..operators.joins import crosswalk as map_codes
from ..operators.joins import expand_identities as expand
from ..operators.joins import role_lookup as by_role
from .base import Tables, derived, derived_sql, query


@query(
    """
    SELECT c.c_custkey, n.n_name FROM customer c
    LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey AND n.n_regionkey <> 3
        AND c.c_mktsegment NOT IN ('BUILDING', 'MACHINERY')"""
)
def left_lookup_predicates(t: Tables) -> DataFrame:
    """Both predicates belong to the join: customers they exclude keep a NULL name."""
    named = lookup(
        t.customer,
        t.nation,
        [("c_nationkey", "n_nationkey")],
        {"n_name": "n_name"},
        where=F.col("n_regionkey") != 3,
        left_where=~F.col("c_mktsegment").isin("BUILDING", "MACHINERY"),
        spread_by=["c_custkey"],
    )
    return named.select("c_custkey", "n_name")


@query(
    """
    SELECT c.c_custkey, n.n_name FROM customer c
    LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey WHERE n.n_regionkey = 2"""
)
def effective_inner(t: Tables) -> DataFrame:
    """A left join whose WHERE drops the unmatched rows is written as the inner join it is."""
    asia = F.col("n_regionkey") == 2
    named = lookup(
        t.customer,
        t.nation,
        [("c_nationkey", "n_nationkey")],
        {"n_name": "n_name"},
        how="inner",
        where=asia,
    )
    return named.select("c_custkey", "n_name")


CODE_MAP = {
    "std_cd_val": "CAST(n_nationkey AS STRING)",
    "target_cd_val": "n_name",
    "sys_of_ctrl_name": "CASE WHEN n_regionkey = 0 THEN 'OTHER' ELSE 'FEED' END",
    "target_cd_set_name": "CASE WHEN n_regionkey = 1 THEN 'PLACES' ELSE 'NATIONS' END",
}


@query(
    f"""
    WITH m AS ({derived_sql('nation', CODE_MAP)})
    SELECT c.c_custkey, m.target_cd_val AS place FROM customer c
    LEFT JOIN m ON CAST(c.c_nationkey AS VARCHAR) = m.std_cd_val
        AND m.sys_of_ctrl_name = 'FEED' AND m.target_cd_set_name = 'NATIONS'"""
)
def crosswalk(t: Tables) -> DataFrame:
    code = F.col("c_nationkey").cast("string")
    mapped = map_codes(
        t.customer, derived(t.nation, CODE_MAP), code, "place", "FEED", "NATIONS", ["c_custkey"]
    )
    return mapped.select("c_custkey", "place")


@query(
    """
    SELECT s.s_suppkey, n.n_nationkey FROM supplier s
    LEFT JOIN nation n ON upper('nation_' || CAST(s.s_nationkey AS VARCHAR)) = upper(n.n_name)
        AND n.n_regionkey IN (1, 2)"""
)
def computed_key_join(t: Tables) -> DataFrame:
    written = F.concat(F.lit("nation_"), F.col("s_nationkey").cast("string"))
    joined = lookup(
        t.supplier,
        t.nation,
        [(F.upper(written), F.upper("n_name"))],
        {"n_nationkey": "n_nationkey"},
        where=F.col("n_regionkey").isin(1, 2),
    )
    return joined.select("s_suppkey", "n_nationkey")


@query(
    """
    SELECT l.l_orderkey, CAST(l.l_linenumber AS BIGINT) AS l_linenumber, l.l_partkey,
        l.l_suppkey, a.s_name AS rendering, b.s_name AS referring
    FROM lineitem l LEFT JOIN supplier a ON l.l_suppkey = a.s_suppkey
    LEFT JOIN supplier b
        ON CASE WHEN l.l_returnflag <> 'N' THEN l.l_partkey END = b.s_suppkey"""
)
def role_lookup(t: Tables) -> DataFrame:
    refers = F.when(F.col("l_returnflag") != "N", F.col("l_partkey"))
    lines = t.lineitem.select(
        "l_orderkey",
        F.col("l_linenumber").cast("long"),
        "l_partkey",
        "l_suppkey",
        refers.alias("referrer"),
    )
    roles = {"rendering": "l_suppkey", "referring": "referrer"}
    return by_role(
        lines, t.supplier, "s_suppkey", roles, "s_name", ["l_orderkey", "l_linenumber"]
    ).drop("referrer")


@query(
    """
    WITH s AS (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS amount
        FROM lineitem WHERE l_returnflag <> 'R' GROUP BY l_orderkey)
    SELECT o.o_orderkey, CAST(s.amount AS DOUBLE) AS amount
    FROM orders o LEFT JOIN s ON o.o_orderkey = s.l_orderkey"""
)
def line_amount_rollup(t: Tables) -> DataFrame:
    totals = attach_rollup(
        t.orders,
        t.lineitem,
        [("o_orderkey", "l_orderkey")],
        F.col("l_extendedprice").cast("decimal(18,2)"),
        "amount",
        where=F.col("l_returnflag") != "R",
    )
    return totals.select("o_orderkey", F.col("amount").cast("double"))


LINKS = {
    "source_patient_id": "c_custkey",
    "enterprise_id": "CAST(c_nationkey AS STRING) || c_mktsegment",
    "source": "CASE WHEN c_acctbal < 0 THEN 'FEED' ELSE 'MAIN' END",
}

_IDS = f"""
    WITH k AS ({derived_sql('customer', LINKS)}),
    p AS (SELECT DISTINCT c.c_custkey AS hum_id FROM orders o
        JOIN customer c ON o.o_custkey = c.c_custkey),
    q AS (SELECT DISTINCT c.c_custkey AS hum_id FROM orders o
        JOIN customer c ON o.o_custkey = c.c_custkey WHERE o.o_orderstatus = 'P')"""


@query(
    _IDS
    + """
    SELECT p.hum_id, k.enterprise_id FROM p LEFT JOIN k
        ON p.hum_id = k.source_patient_id AND p.hum_id IN (SELECT hum_id FROM q)"""
)
def expand_identities(t: Tables) -> DataFrame:
    return _expanded(t)[0]


@query(
    _IDS
    + """
    SELECT DISTINCT kk.enterprise_id, kk.source_patient_id FROM q
    JOIN k ON q.hum_id = k.source_patient_id
    JOIN k kk ON k.enterprise_id = kk.enterprise_id AND kk.source = 'FEED'"""
)
def identity_partners(t: Tables) -> DataFrame:
    return _expanded(t)[1]


def _expanded(t: Tables) -> tuple[DataFrame, DataFrame]:
    patients = t.customer.select(
        F.col("c_custkey").alias("patient_sk"), F.col("c_custkey").alias("source_patient_id")
    )
    return expand(
        t.orders,
        patients,
        derived(t.customer, LINKS),
        "o_custkey",
        "patient_sk",
        "FEED",
        fact_where=F.col("o_orderstatus") == "P",
    )


@query(
    """
    SELECT o_orderkey, o_custkey FROM orders
    WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)
        AND o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
        AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)"""
)
def key_filters(t: Tables) -> DataFrame:
    lines = t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey")
    kept = keep_keys(t.orders, lines.filter("l_quantity > 45"), ["o_orderkey"])
    kept = keep_keys(kept, lines.filter("l_returnflag = 'R'"), ["o_orderkey"])
    blocked = t.customer.filter("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return drop_keys(kept, blocked, ["o_custkey"]).select("o_orderkey", "o_custkey")


@query(
    """
    SELECT o_orderkey, EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey
        AND l.l_linestatus = 'F') AS has_final
    FROM orders o"""
)
def key_exists(t: Tables) -> DataFrame:
    final = t.lineitem.filter("l_linestatus = 'F'").select(F.col("l_orderkey").alias("o_orderkey"))
    return exists_flag(t.orders, final, ["o_orderkey"], "has_final").select(
        "o_orderkey", "has_final"
    )


@query(
    """
    SELECT event_id, event_type, ts FROM events
    WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)"""
)
def last_batch(t: Tables) -> DataFrame:
    dated = t.events.withColumn("day", F.to_date("ts"))
    return latest_batch(dated, "day").select("event_id", "event_type", "ts")


@query(
    """
    SELECT event_type, max(ts) AS last_ts, count(*) AS n_events FROM events GROUP BY event_type"""
)
def grouped_max(t: Tables) -> DataFrame:
    return t.events.groupBy("event_type").agg(
        F.max("ts").alias("last_ts"), F.count("*").alias("n_events")
    )


@query(
    """
    SELECT l_orderkey AS claim FROM lineitem WHERE l_shipdate >= TIMESTAMP '2001-01-01'
    UNION SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01'
    UNION SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P'"""
)
def affected_keys(t: Tables) -> DataFrame:
    orders = t.orders.withColumnRenamed("o_orderkey", "claim")
    lines = t.lineitem.withColumnRenamed("l_orderkey", "claim")
    return affected(
        "claim",
        lines.filter("l_shipdate >= timestamp_ntz'2001-01-01'"),
        orders.filter("o_orderdate >= timestamp_ntz'2001-01-01'"),
        orders.filter("o_orderstatus = 'P'"),
    )


TOKENS = {
    "c_custkey": "c_custkey",
    "name": "CASE WHEN c_acctbal < 0 THEN NULL ELSE md5(c_name) END",
    "segment": "md5(c_mktsegment)",
}


@query(
    """
    SELECT c_custkey, CASE WHEN c_acctbal >= 0 AND c_nationkey <> 4 THEN c_name END AS name,
        c_mktsegment AS segment FROM customer"""
)
def detokenize(t: Tables) -> DataFrame:
    """Tokens are hashes of the clear values; the vault lacks the names of one nation."""
    names = t.customer.filter("c_nationkey <> 4").select(F.col("c_name").alias("value"))
    segments = t.customer.select(F.col("c_mktsegment").alias("value")).distinct()
    vault = names.unionByName(segments).withColumn("token", F.md5("value"))
    return reveal(
        derived(t.customer, TOKENS), ["name", "segment"], vault, spread_by=["c_custkey"]
    )
