"""Writing and reading back tables, snapshots and extract files."""

from __future__ import annotations

from datetime import datetime
from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import work_dir
from ..sources import consumers, extract, points, snapshots, tables
from .base import Tables, query


def _folder(t: Tables) -> str:
    return f"{work_dir(t.spark)}/loomfeed-{uuid4().hex}"


@query(
    """
    SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name || '|"' || p_brand AS p_name,
        nullif(CASE WHEN p_size < 10 THEN '' ELSE p_type END, '') AS p_type,
        CAST(p_size AS VARCHAR) AS p_size
    FROM part"""
)
def extract_roundtrip(t: Tables) -> DataFrame:
    """Values with the separator and quotes survive; blank and NULL both come back as NULL."""
    rows = t.part.select(
        "p_partkey",
        F.concat(F.lit("  "), "p_name", F.lit('|"'), "p_brand", F.lit(" ")).alias("p_name"),
        F.when(F.col("p_size") < 10, "").otherwise(F.col("p_type")).alias("p_type"),
        "p_size",
    )
    folder = _folder(t)
    extract.write_extract(rows, folder)
    back = extract.read_extract(t.spark, folder, [c.upper() for c in rows.columns])
    return back.select(*[F.col(c.upper()).alias(c) for c in rows.columns])


@query(
    """
    SELECT upper(column_name) AS header FROM (DESCRIBE SELECT s_suppkey, s_name, s_nationkey
        FROM supplier)"""
)
def empty_extract(t: Tables) -> DataFrame:
    """An extract without rows still carries its header."""
    folder = _folder(t)
    nobody = t.supplier.filter("s_acctbal > 1e9").select("s_suppkey", "s_name", "s_nationkey")
    extract.write_extract(nobody, folder)
    return t.spark.read.text(folder).select(F.explode(F.split("value", "\\|")).alias("header"))


@query(
    """
    SELECT c_custkey, c_name, 'first' AS written FROM customer WHERE c_nationkey < 12
    UNION ALL SELECT c_custkey, c_name, 'second' FROM customer"""
)
def table_roundtrip(t: Tables) -> DataFrame:
    """A table created empty and appended to, and one that replaces what it held."""
    folder, tag = _folder(t), uuid4().hex
    people = t.customer.select("c_custkey", "c_name", "c_nationkey")
    some = people.filter("c_nationkey < 12")
    first, second = f"loomfeed_first_{tag}", f"loomfeed_second_{tag}"
    tables.drop_table(t.spark, first)
    tables.ensure_table(people, first, path=f"{folder}/first")
    tables.ensure_table(people, first)
    tables.write_table(some, first, "append", path=f"{folder}/first")
    tables.write_table(some, second, "append", path=f"{folder}/second")
    tables.write_table(people, second, "overWrite", path=f"{folder}/second")
    frames = [
        tables.read_table(t.spark, name).select("c_custkey", "c_name", F.lit(part).alias("written"))
        for name, part in ((first, "first"), (second, "second"))
    ]
    return frames[0].unionByName(frames[1])


@query(
    """
    SELECT o_orderkey, 1 AS version FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01'
    UNION ALL SELECT o_orderkey, 2 FROM orders"""
)
def snapshot_roundtrip(t: Tables) -> DataFrame:
    """Two committed versions, read as of a time between them and as of now."""
    folder = _folder(t)
    orders = t.orders.select("o_orderkey", "o_orderdate")
    earlier = orders.filter("o_orderdate < timestamp_ntz'2001-01-01'")
    snapshots.write_snapshot(earlier, folder, datetime(2001, 1, 1), snapshots.REBUILD)
    snapshots.write_snapshot(orders, folder, datetime(2001, 8, 1), snapshots.MERGE)
    first = snapshots.read_snapshot(t.spark, folder, datetime(2001, 3, 1))
    last = snapshots.read_snapshot(t.spark, folder)
    return first.select("o_orderkey", F.lit(1).alias("version")).unionByName(
        last.select("o_orderkey", F.lit(2).alias("version"))
    )


@query(
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderpriority || '|' || o_orderstatus AS o_label,
        (SELECT count(*) FROM orders) AS listed, 1 AS headers FROM orders"""
)
def extract_parts(t: Tables) -> DataFrame:
    """Many parts under one header: each row once, the rows the manifest lists, one header line."""
    folder = _folder(t)
    label = F.concat_ws("|", "o_orderpriority", "o_orderstatus").alias("o_label")
    rows = t.orders.repartition(4).select("o_orderkey", label)
    extract.write_extract_parts(rows, folder, max_records_per_file=1000)
    back = extract.read_extract_parts(t.spark, folder, ["O_ORDERKEY", "O_LABEL"])
    lines = t.spark.read.text(folder).filter(F.col("value") == "O_ORDERKEY|O_LABEL")
    counts = extract.read_manifest(t.spark, folder).agg(F.sum("n").alias("listed"))
    return back.select(
        F.col("O_ORDERKEY").alias("o_orderkey"),
        F.col("O_LABEL").alias("o_label"),
        counts.scalar().alias("listed"),
        lines.agg(F.count("*").cast("int")).scalar().alias("headers"),
    )


@query(
    """
    SELECT 'customer' AS domain, c_custkey AS id, lower(n_name) AS market,
        CASE WHEN c_custkey % 3 = 0 THEN '__none' ELSE 'C' || (c_custkey % 3) END AS consumer
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    WHERE n_nationkey < 6 AND NOT (n_nationkey = 2 AND c_custkey % 3 IN (0, 1))
    UNION ALL SELECT 'supplier', s_suppkey, lower(n_name),
        CASE WHEN s_suppkey % 3 = 0 THEN '__none' ELSE 'C' || (s_suppkey % 3) END
    FROM supplier JOIN nation ON s_nationkey = n_nationkey
    WHERE n_nationkey < 6 AND NOT (n_nationkey = 2 AND s_suppkey % 3 IN (0, 1))"""
)
def delete_consumer(t: Tables) -> DataFrame:
    """Stored tables of two domains lose what one market got for one consumer and for none; a table
    that does not exist is passed over, and a deletion that was cut off is finished."""
    folder, tag = _folder(t), uuid4().hex
    names = [f"loomfeed_sent_{domain}_{tag}" for domain in ("customer", "supplier", "lab")]
    frames = []
    for domain, key, nation in (("customer", "c_custkey", "c_nationkey"), ("supplier", "s_suppkey", "s_nationkey")):
        market = t.nation.select(F.col("n_nationkey").alias(nation), F.lower("n_name").alias(consumers.MARKET))
        rest = F.col(key) % 3
        who = F.when(rest == 0, consumers.NONE).otherwise(F.concat(F.lit("C"), rest.cast("string")))
        rows = getattr(t, domain).filter(F.col(nation) < 6).join(market, nation)
        rows = rows.select(F.col(key).alias("id"), consumers.MARKET, who.alias(consumers.CONSUMER))
        name = f"loomfeed_sent_{domain}_{tag}"
        parts = [consumers.MARKET, consumers.CONSUMER]
        tables.write_table(rows, name, partition_by=parts, path=f"{folder}/{domain}")
        frames.append((domain, name))
    market = t.nation.filter("n_nationkey = 2").select("n_name").first()[0]
    log, now = f"{folder}/deletes", datetime(2001, 8, 1)
    consumers.delete_consumer(t.spark, names, market, "C1", log, now)
    snapshots.append_log(t.spark, log, [(market, "", now, False)], consumers.LOG_SCHEMA)
    consumers.finish_deletes(t.spark, names, log)
    left = [
        tables.read_table(t.spark, name).select(
            F.lit(domain).alias("domain"),
            "id",
            F.col(consumers.MARKET).alias("market"),
            F.col(consumers.CONSUMER).alias("consumer"),
        )
        for domain, name in frames
    ]
    return left[0].unionByName(left[1])


@query(
    """
    SELECT o_orderkey, c_name, DATE '2001-07-09' AS lookback FROM orders JOIN customer
        ON o_custkey = c_custkey
    WHERE o_orderdate < TIMESTAMP '2001-01-01' AND c_nationkey < 12"""
)
def sources_as_of(t: Tables) -> DataFrame:
    """Two sources as of the last rebuild, which is in an earlier month than the run; versions
    committed later, also after the point was chosen, are not seen."""
    folder = _folder(t)
    roots = {"orders": f"{folder}/orders", "customer": f"{folder}/customer"}
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    people = t.customer.select("c_custkey", "c_name", "c_nationkey")
    early = datetime(2001, 7, 8)
    snapshots.write_snapshot(orders.filter("o_orderdate < timestamp_ntz'2001-01-01'"), roots["orders"], early)
    snapshots.write_snapshot(people.filter("c_nationkey < 12"), roots["customer"], early)
    rebuilds = t.spark.createDataFrame(
        [(1, datetime(2001, 7, 9), snapshots.REBUILD, "r")], snapshots.LOG_SCHEMA
    )
    snapshots.write_snapshot(orders, roots["orders"], datetime(2001, 7, 30))
    point = points.fix_point(t.spark, roots, rebuilds, datetime(2001, 8, 1), production=True)
    snapshots.write_snapshot(people, roots["customer"], datetime(2001, 8, 1))
    joined = point.read("orders").join(point.read("customer"), F.col("o_custkey") == F.col("c_custkey"))
    return joined.select("o_orderkey", "c_name", F.lit(point.lookback).alias("lookback"))


@query(
    """
    SELECT n_nationkey, CASE WHEN n_nationkey = 0 THEN DATE '2001-08-01'
        WHEN n_nationkey < 3 THEN DATE '2001-07-01' + CAST(n_nationkey AS INTEGER)
        ELSE DATE '2001-08-01' END AS lookback FROM nation WHERE n_nationkey < 5"""
)
def lookback_snapshot_date(t: Tables) -> DataFrame:
    """The day a run looks back from: the rebuild's if it is of another month and can be read."""
    folder = _folder(t)
    snapshots.write_snapshot(t.nation, folder, datetime(2001, 1, 1))
    rebuilt = {1: datetime(2001, 7, 2), 2: datetime(2001, 7, 3), 3: datetime(2001, 8, 1), 4: datetime(2001, 4, 2)}
    days = []
    for nation in range(5):
        log = [(1, rebuilt[nation], snapshots.REBUILD, "r")] if nation in rebuilt else []
        rebuilds = t.spark.createDataFrame(log, snapshots.LOG_SCHEMA)
        point = points.fix_point(t.spark, {"n": folder}, rebuilds, datetime(2001, 8, 1, 5), production=True)
        days.append((nation, point.lookback))
    days = t.spark.createDataFrame(days, "n_nationkey long, lookback date")
    return t.nation.select("n_nationkey").join(days, "n_nationkey")
