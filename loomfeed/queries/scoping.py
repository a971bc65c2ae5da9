"""Projection, filters, latest row per key."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates
from ..operators.joins import in_scope, lookup
from ..operators.shape import (
    collapse_tenants,
    final_rows,
    latest_per_key,
    live_rows,
    project,
    scope_filter,
    split_by_flag,
)
from ..sources.tables import read_query
from .base import AS_OF, Tables, derived, derived_sql, query

TODAY = date.fromisoformat(AS_OF)


@query(
    """
    SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey,
        l_shipdate, l_returnflag
    FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
            CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END DESC, l_shipdate DESC NULLS FIRST,
            l_partkey DESC NULLS FIRST, l_suppkey DESC NULLS FIRST,
            l_extendedprice DESC, l_quantity DESC) AS rn FROM lineitem)
    WHERE rn = 1"""
)
def latest_line_per_key(t: Tables) -> DataFrame:
    latest = latest_per_key(
        t.lineitem,
        ["l_orderkey", "l_linenumber"],
        [
            F.when(F.col("l_returnflag") == "R", 1).otherwise(0).desc(),
            *[F.col(c).desc_nulls_first() for c in ("l_shipdate", "l_partkey", "l_suppkey")],
            F.col("l_extendedprice").desc(),
            F.col("l_quantity").desc(),
        ],
    )
    return latest.select(
        "l_orderkey",
        F.col("l_linenumber").cast("long"),
        "l_partkey",
        "l_suppkey",
        "l_shipdate",
        "l_returnflag",
    )


COHORT = {
    "patient": "c_custkey",
    "nation": "c_nationkey",
    "project": "CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'OTHER' ELSE 'MAIN' END",
    "last_day": "CASE WHEN c_mktsegment = 'BUILDING' THEN CAST('2000-06-30' AS TIMESTAMP) "
    "WHEN c_acctbal < 0 THEN NULL ELSE CAST('2001-06-30' AS TIMESTAMP) END",
}


@query(
    f"""
    WITH c AS ({derived_sql('customer', COHORT)}),
    s AS (SELECT o.*, n.n_name FROM orders o JOIN c ON o.o_custkey = c.patient
            AND c.project = 'MAIN' AND o.o_orderdate <= c.last_day
        LEFT JOIN nation n ON c.nation = n.n_nationkey
        WHERE o.o_orderdate >= date_trunc('month', DATE '{AS_OF}') - INTERVAL 24 MONTH)
    SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice, n_name FROM (SELECT *, row_number()
        OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS FIRST,
              o_orderkey DESC NULLS FIRST) AS rn FROM s) WHERE rn = 1"""
)
def inscope_latest_orders(t: Tables) -> DataFrame:
    """Latest order in the lookback of each cohort member, with the member's nation."""
    orders = t.orders.filter(dates.within_lookback("o_orderdate", 24, TODAY))
    members = lookup(
        derived(t.customer, COHORT),
        t.nation,
        [("nation", "n_nationkey")],
        {"n_name": "n_name"},
    ).filter(F.col("project") == "MAIN")
    scoped = lookup(
        orders,
        members,
        [("o_custkey", "patient")],
        {"n_name": "n_name", "last_day": "last_day"},
        how="inner",
    ).filter(F.col("o_orderdate") <= F.col("last_day"))
    latest = latest_per_key(
        scoped,
        ["o_custkey"],
        [F.col("o_orderdate").desc_nulls_first(), F.col("o_orderkey").desc_nulls_first()],
    )
    return latest.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice", "n_name")


@query(
    f"""
    WITH c AS ({derived_sql('customer', COHORT)})
    SELECT o.o_orderkey, o.o_custkey, o.o_orderdate FROM orders o JOIN c
        ON o.o_custkey = c.patient AND c.project = 'MAIN' AND o.o_orderdate <= c.last_day"""
)
def cohort_range(t: Tables) -> DataFrame:
    return in_scope(
        t.orders.select("o_orderkey", "o_custkey", "o_orderdate"),
        derived(t.customer, COHORT),
        [("o_custkey", "patient")],
        where=F.col("project") == "MAIN",
        until=("o_orderdate", "last_day"),
    )


@query(
    f"""
    WITH c AS ({derived_sql('customer', COHORT)})
    SELECT o.o_orderkey, o.o_custkey, o.o_orderdate FROM orders o JOIN c
        ON o.o_custkey = c.patient AND c.project = 'MAIN' AND o.o_orderdate <= c.last_day"""
)
def cohort_range_salted(t: Tables) -> DataFrame:
    """The same join with each member's orders split over several partitions."""
    return in_scope(
        t.orders.select("o_orderkey", "o_custkey", "o_orderdate"),
        derived(t.customer, COHORT),
        [("o_custkey", "patient")],
        where=F.col("project") == "MAIN",
        until=("o_orderdate", "last_day"),
        spread_by=["o_orderkey"],
        salts=4,
    )


@query(
    """
    SELECT e.event_id, e.user_id FROM events e JOIN customer c ON e.user_id = c.c_custkey
        AND c.c_mktsegment <> 'HOUSEHOLD'
    WHERE CAST(e.ts AS DATE) <= CAST(substring(CASE WHEN c.c_acctbal < 0
        THEN '2024-01-15 12:00:00' ELSE '2024-01-25 12:00:00' END, 1, 10) AS DATE)"""
)
def cohort_no_range(t: Tables) -> DataFrame:
    """Cohort join on the key alone, then a comparison by day."""
    last = F.when(F.col("c_acctbal") < 0, "2024-01-15 12:00:00").otherwise("2024-01-25 12:00:00")
    return in_scope(
        t.events,
        t.customer.withColumn("last", last),
        [("user_id", "c_custkey")],
        where=F.col("c_mktsegment") != "HOUSEHOLD",
        until=(F.to_date("ts"), F.to_date("last")),
    ).select("event_id", "user_id")


ENDS = {
    "o_orderkey": "o_orderkey",
    "ended": "CASE WHEN o_orderstatus = 'F' THEN o_orderdate END",
    "final": "CASE o_orderpriority WHEN '5-LOW' THEN 'N' WHEN '4-NOT SPECIFIED' THEN NULL "
    "ELSE 'Y' END",
}


@query(
    f"""
    WITH e AS ({derived_sql('orders', ENDS)})
    SELECT o_orderkey, ended FROM e WHERE coalesce(final, 'Y') = 'Y'
        AND coalesce(ended, TIMESTAMP '9999-12-31')
            >= date_trunc('month', DATE '{AS_OF}') - INTERVAL 39 MONTH"""
)
def lookback_open_ended(t: Tables) -> DataFrame:
    kept = final_rows(derived(t.orders, ENDS), "final").filter(
        dates.within_lookback("ended", dates.DEFAULT_LOOKBACK, TODAY, open_ended=True)
    )
    return kept.select("o_orderkey", "ended")


@query(
    f"""
    SELECT l.l_orderkey, CAST(l.l_linenumber AS BIGINT) AS l_linenumber, l.l_partkey,
        l.l_suppkey, l.l_shipdate, o.o_orderdate
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
    WHERE CASE WHEN l.l_linestatus = 'F' THEN l.l_shipdate END
            >= date_trunc('month', DATE '{AS_OF}') - INTERVAL 12 MONTH
        OR o.o_orderdate >= date_trunc('month', DATE '{AS_OF}') - INTERVAL 12 MONTH"""
)
def any_lookback(t: Tables) -> DataFrame:
    lines = lookup(
        t.lineitem,
        t.orders,
        [("l_orderkey", "o_orderkey")],
        {"o_orderdate": "o_orderdate"},
        how="inner",
    )
    shipped = F.when(F.col("l_linestatus") == "F", F.col("l_shipdate"))
    return lines.filter(dates.any_within_lookback([shipped, "o_orderdate"], 12, TODAY)).select(
        "l_orderkey",
        F.col("l_linenumber").cast("long"),
        "l_partkey",
        "l_suppkey",
        "l_shipdate",
        "o_orderdate",
    )


ACCOUNTS = {
    "c_custkey": "c_custkey",
    "c_name": "c_name",
    "tenant_sk": "c_nationkey",
    "source_system_sk": "c_mktsegment",
    "del_ind": "CASE WHEN c_acctbal < 0 THEN 1 WHEN c_nationkey = 7 THEN NULL ELSE 0 END",
    "code": "CASE WHEN c_acctbal > 9000 THEN NULL WHEN c_acctbal > 8000 THEN 'none' ELSE "
    "CAST(c_custkey AS STRING) || '-' || c_mktsegment END",
}


@query(
    f"""
    WITH a AS ({derived_sql('customer', ACCOUNTS)})
    SELECT c_custkey, 'some' AS scope FROM a WHERE tenant_sk IN (1, 2, 3, 7, 8, 13)
        AND source_system_sk IN ('BUILDING', 'MACHINERY') AND del_ind = 0 AND code LIKE '%-%'
    UNION ALL
    SELECT c_custkey, 'all' AS scope FROM a WHERE tenant_sk IN (1, 2, 3, 7, 8, 13)
        AND del_ind = 0 AND code IS NOT NULL"""
)
def scope_and_live_rows(t: Tables) -> DataFrame:
    accounts, tenants = derived(t.customer, ACCOUNTS), (1, 2, 3, 7, 8, 13)
    some = live_rows(scope_filter(accounts, tenants, ("BUILDING", "MACHINERY")))
    every = live_rows(scope_filter(accounts, tenants))
    return (
        some.filter(F.col("code").contains("-"))
        .select("c_custkey", F.lit("some").alias("scope"))
        .unionByName(
            every.filter(F.col("code").isNotNull()).select("c_custkey", F.lit("all").alias("scope"))
        )
    )


@query(
    """
    SELECT o_orderkey, o_orderdate, 'live' AS part FROM orders WHERE o_orderstatus <> 'P'
    UNION ALL
    SELECT o_orderkey, o_orderdate, 'deleted' AS part FROM orders WHERE o_orderstatus = 'P'"""
)
def flag_split(t: Tables) -> DataFrame:
    flagged = t.orders.withColumn("del_ind", F.when(F.col("o_orderstatus") == "P", 1).otherwise(0))
    live, deleted = split_by_flag(flagged, "del_ind", ["o_orderkey", "o_orderdate"])
    return live.withColumn("part", F.lit("live")).unionByName(
        deleted.withColumn("part", F.lit("deleted"))
    )


@query(
    """
    WITH big AS (SELECT o.*, c.c_mktsegment FROM orders o JOIN customer c
        ON o.o_custkey = c.c_custkey WHERE o.o_totalprice > 100000)
    SELECT o_orderkey AS "Order_Key", c_mktsegment AS "Segment", '0' AS "Contract",
        'F' AS "Status", o_totalprice AS "Price" FROM big"""
)
def projection_basics(t: Tables) -> DataFrame:
    """Renaming, dropping, constants, an intermediate frame and SQL text with parameters."""
    t.orders.createOrReplaceTempView("projection_orders")
    big = read_query(
        t.spark, "SELECT * FROM projection_orders WHERE o_totalprice > :least", least=100000
    )
    named = lookup(
        big, t.customer, [("o_custkey", "c_custkey")], {"segment": "c_mktsegment"}, how="inner"
    )
    spec = {
        "Order_Key": "o_orderkey",
        "Segment": "segment",
        "Contract": F.lit("0"),
        "Status": F.lit("F"),
        "Price": "o_totalprice",
    }
    wide = project(named, {"unused": "o_custkey", **spec})
    return wide.drop("unused").select(*spec)


@query(
    """
    SELECT DISTINCT CAST(0 AS BIGINT) AS tenant, '0' AS source, o_orderstatus, o_orderdate
    FROM orders"""
)
def tenant_collapse(t: Tables) -> DataFrame:
    rows = t.orders.select(
        F.col("o_custkey").alias("tenant"),
        F.col("o_orderpriority").alias("source"),
        "o_orderstatus",
        "o_orderdate",
    )
    return collapse_tenants(rows, (1, 2), ("tenant", "source"))
