"""Physical plans: what is shuffled, what is pushed down, what is broadcast."""

import re
from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import functions as F

import fixtures
from conftest import rows
from loomfeed.functions import dates
from loomfeed.operators import changes, joins, shape
from loomfeed.plans import claim_headers, claim_lines
from loomfeed.queries import extracts
from loomfeed.queries.base import Tables
from loomfeed.sources import tables

FOLDER = "/root/testdata/sf0.01"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


@pytest.fixture
def orders(spark):
    return spark.read.parquet(f"{FOLDER}/orders.parquet")


def test_latest_keeps_one_row_per_key_and_task_before_the_shuffle(orders):
    latest = shape.latest_per_key(orders, ["o_custkey"], [F.col("o_orderkey").desc()])
    text = plan(latest)
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_upsert_shuffles_each_side_once(orders, no_broadcast):
    keyed = orders.withColumn("HASH", F.md5("o_orderstatus"))
    merged = changes.upsert_by_fingerprint(
        keyed, keyed, ["o_orderkey", "o_custkey"], order=[F.col("o_orderdate").desc()]
    )
    text = plan(merged)
    assert text.count("FullOuter") == 1
    assert text.count("Exchange hashpartitioning") == 2


def test_a_state_bucketed_by_its_keys_stays_where_it_is(spark, orders, no_broadcast):
    keyed = orders.withColumn("HASH", F.md5("o_orderstatus"))
    tables.write_table(keyed, "orders_state", "overwrite", bucket_by=["o_orderkey"], buckets=4)
    merged = changes.upsert_by_fingerprint(
        spark.table("orders_state"), keyed, ["o_orderkey"], null_safe=False
    )
    text = plan(merged.filter("o_orderkey IS NOT NULL"))
    tables.drop_table(spark, "orders_state")
    assert text.count("FullOuter") == 1
    assert text.count("Exchange hashpartitioning") == 1


def test_classification_is_one_join_over_grouped_lines(orders, spark, no_broadcast):
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet").select(
        F.col("l_orderkey").alias("CLAIM_NUMBER"), F.lit("insert").alias("_change_type")
    )
    headers = orders.select(
        F.col("o_orderkey").alias("CLAIM_NUMBER"),
        F.col("o_orderstatus").alias("CLAIM_ADJUST_TYPE"),
        F.lit("").alias("UPDATE_TYPE"),
        F.lit("insert").alias("_change_type"),
    )
    text = plan(changes.classify_changes(headers, lines, keys=("CLAIM_NUMBER",)))
    assert text.count("Join") == 1
    assert "partial_max" in text


def test_lookback_reaches_the_scan(orders):
    recent = orders.filter(dates.within_lookback("o_orderdate", 3, date(2001, 8, 1)))
    assert "GreaterThanOrEqual(o_orderdate,2001-05-01T00:00)" in plan(recent.select("o_orderkey"))
    columns = re.search(r"ReadSchema: struct<(.*?)>", plan(recent.select("o_orderkey"))).group(1)
    assert columns == "o_orderkey:bigint,o_orderdate:timestamp_ntz"


def dimension(spark):
    return spark.read.parquet(f"{FOLDER}/customer.parquet")


def test_dimension_is_broadcast_only_below_the_threshold(spark, orders):
    def looked_up():
        return plan(
            joins.lookup(orders, dimension(spark), [("o_custkey", "c_custkey")], {"n": "c_name"})
        )

    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    assert "BroadcastHashJoin" in looked_up()
    spark.conf.set(key, "1000")
    try:
        assert "SortMergeJoin" in looked_up()
    finally:
        spark.conf.set(key, before)


def partition_sizes(df):
    sizes = df.groupBy(F.spark_partition_id().alias("p")).count().collect()
    return sorted((r["count"] for r in sizes), reverse=True)


@pytest.fixture
def plain_shuffle(spark, no_broadcast):
    # Fixed partitions, so that the test sees where rows meet rather than what is merged later.
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_rows_without_a_match_are_spread(spark, orders, plain_shuffle):
    mostly_null = orders.withColumn(
        "sk", F.when(F.col("o_orderstatus") == "F", F.col("o_custkey"))
    ).select("o_orderkey", "sk")
    on, take = [("sk", "c_custkey")], {"n": "c_name"}
    piled = partition_sizes(joins.lookup(mostly_null, dimension(spark), on, take))
    spread = partition_sizes(
        joins.lookup(mostly_null, dimension(spark), on, take, spread_by=["o_orderkey"])
    )
    assert piled[0] > 0.6 * sum(piled)
    assert spread[0] < 0.35 * sum(spread)
    assert sum(spread) == sum(piled) == orders.count()


def test_a_hot_key_is_split_by_salts(spark, orders, plain_shuffle):
    hot = orders.withColumn("sk", F.when(F.col("o_orderstatus") == "F", F.col("o_custkey")).otherwise(7))
    on, take = [("sk", "c_custkey")], {"n": "c_name"}
    piled = partition_sizes(joins.lookup(hot, dimension(spark), on, take, how="inner"))
    split = partition_sizes(
        joins.lookup(hot, dimension(spark), on, take, how="inner", spread_by=["o_orderkey"], salts=16)
    )
    assert piled[0] > 0.6 * sum(piled)
    assert split[0] < 0.5 * sum(split)
    assert sum(split) == sum(piled)


def test_sums_are_partial_before_the_shuffle(spark):
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet")
    text = plan(joins.rollup_amount(lines, ["l_orderkey"], "l_quantity", "q"))
    assert text.index("Exchange") < text.index("partial_sum")


def test_rows_out_of_scope_are_not_joined(spark, no_broadcast):
    """The test by key stands below the join that the rows are made from."""
    lines = spark.createDataFrame([(1, 5), (1, 7), (2, 9), (None, 4)], "k long, v int")
    heads = spark.createDataFrame([(1, "a"), (2, "b")], "h long, t string")
    keys = spark.createDataFrame([(1,), (1,), (None,)], "k long")
    wide = lines.join(heads, F.col("k") == F.col("h")).select("k", "v", "t")
    near = joins.near_keys(wide, keys, "k")
    text = near._jdf.queryExecution().optimizedPlan().toString()
    assert 0 <= text.index("Join Inner") < text.index("Join LeftSemi")
    assert sorted(tuple(r) for r in near.collect()) == [(1, 5, "a"), (1, 7, "a")]


def test_claim_steps_start_from_the_claims_in_scope(spark):
    """Lines meet few claims first, and pivots are made for the claims of the run."""
    heads = [fixtures.header(1), fixtures.header(2, final_status_flg="N")]
    details = [fixtures.detail(10, 1, 1), fixtures.detail(20, 2, 1)]
    config = fixtures.CONFIG
    source = claim_lines.claim_line_source(config, fixtures.line_inputs(spark, heads, details))
    assert "LeftSemi" in source._jdf.queryExecution().optimizedPlan().toString()
    inputs = fixtures.header_inputs(spark, heads, details)
    asked = []

    def pivot(claims):
        asked.append([r.claim_header_sk for r in claims.collect()])
        return inputs.diagnosis_pivot

    given = replace(inputs, diagnosis_pivot=pivot)
    found = claim_headers.claim_header_source(config, given).collect()
    assert asked == [[1]]
    assert found == claim_headers.claim_header_source(config, inputs).collect()


def test_steps_of_claims_share_the_lines_of_recent_claims(spark):
    """No step of a claim run reads all lines again; those of claims in the lookback are kept once."""
    t = Tables(spark, FOLDER)
    kept = extracts._of_recent_claims(t, extracts.CONFIG)
    recent = claim_lines.recent_headers(extracts.CONFIG, t.sql(extracts.CLAIMS["claim_header"]))
    keys = {r[0] for r in recent.select("claim_header_sk").collect()}
    lines = t.lineitem.filter(F.col("l_orderkey").isin(keys))
    assert rows(kept["lineitem"]) == rows(lines) and 0 < lines.count() < t.lineitem.count()
    for earlier in (True, False):
        inputs = extracts._header_inputs(t, extracts.CONFIG, earlier)
        current = claim_headers.claim_header_current(extracts.CONFIG, inputs)
        assert not [f for f in current.inputFiles() if "/lineitem.parquet" in f]
        assert extracts._of_recent_claims(t, extracts.CONFIG) is kept
