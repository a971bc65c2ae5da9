"""Current state, change sets, history, control times, versions.

The earlier state of the orders is what was known before 2001: later orders are missing, pending
ones were still open, and orders of one priority that have since left the feed are present.
"""

from __future__ import annotations

from datetime import date, datetime
from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fingerprint import row_fingerprint
from ..operators import changes as op
from ..operators import history as hist
from ..operators.control import advance_watermark
from ..session import work_dir
from ..sources import buckets as buckets_of
from ..sources import snapshots
from .base import Tables, derived, derived_sql, query
from .cleaning import md5_sql

OLD = {
    "claim": "o_orderkey",
    "patient": "CASE WHEN o_custkey < 10 THEN NULL ELSE o_custkey END",
    "status": "CASE WHEN o_orderstatus = 'P' THEN 'O' ELSE o_orderstatus END",
    "price": "CAST(o_totalprice AS DECIMAL(18, 2))",
}
NEW = {**OLD, "status": "o_orderstatus"}
BEFORE = "o_orderdate < TIMESTAMP '2001-01-01'"
STILL_FED = "NOT (o_orderpriority = '5-LOW' AND o_orderdate < TIMESTAMP '1996-01-01')"
KEY = ["claim", "patient"]
VALUES = ["status", "price"]


def _states(t: Tables) -> tuple[DataFrame, DataFrame]:
    def prints(df: DataFrame, spec: dict[str, str]) -> DataFrame:
        return row_fingerprint(derived(df, spec), exclude=KEY)

    zoneless = {"TIMESTAMP '": "TIMESTAMP_NTZ '"}
    before, fed = BEFORE, STILL_FED
    for a, b in zoneless.items():
        before, fed = before.replace(a, b), fed.replace(a, b)
    return prints(t.orders.filter(before), OLD), prints(t.orders.filter(fed), NEW)


_STATES = f"""
    WITH old AS (SELECT *, {md5_sql(VALUES)} AS hash
        FROM ({derived_sql('orders', OLD)} WHERE {BEFORE})),
    new AS (SELECT *, {md5_sql(VALUES)} AS hash
        FROM ({derived_sql('orders', NEW)} WHERE {STILL_FED})),
    both_states AS (SELECT o.claim AS o_claim, o.patient AS o_patient, o.status AS o_status,
            o.price AS o_price, o.hash AS o_hash, n.claim AS n_claim, n.patient AS n_patient,
            n.status AS n_status, n.price AS n_price, n.hash AS n_hash
        FROM old o FULL JOIN new n ON o.claim = n.claim
            AND o.patient IS NOT DISTINCT FROM n.patient)"""


@query(
    _STATES
    + """
    SELECT coalesce(n_claim, o_claim) AS claim, coalesce(n_patient, o_patient) AS patient,
        CASE WHEN n_claim IS NULL THEN o_status ELSE n_status END AS status,
        CAST(coalesce(n_price, o_price) AS DOUBLE) AS price, coalesce(n_hash, o_hash) AS print
    FROM both_states"""
)
def upsert_state(t: Tables) -> DataFrame:
    """New current state; claims that left the feed stay."""
    old, new = _states(t)
    state = op.upsert_by_fingerprint(old, new, KEY)
    return state.select(
        "claim",
        "patient",
        "status",
        F.col("price").cast("double").alias("price"),
        F.col("HASH").alias("print"),
    )


@query(
    _STATES
    + """
    SELECT n_claim AS claim, n_patient AS patient, n_status AS status,
        CASE WHEN o_claim IS NULL THEN 'insert' ELSE 'update_postimage' END AS change
    FROM both_states WHERE n_claim IS NOT NULL AND o_hash IS DISTINCT FROM n_hash"""
)
def upsert_changes(t: Tables) -> DataFrame:
    old, new = _states(t)
    changed = op.changed_rows(op.upsert_by_fingerprint(old, new, KEY))
    return changed.select("claim", "patient", "status", F.col(op.CHANGE).alias("change"))


@query(
    _STATES
    + """
    SELECT claim, patient, status, CAST(price AS DOUBLE) AS price FROM old
    UNION ALL SELECT n_claim, n_patient, n_status, CAST(n_price AS DOUBLE) FROM (
        SELECT n.claim AS n_claim, n.patient AS n_patient, n.status AS n_status,
            n.price AS n_price FROM new n WHERE n.patient IS NULL OR NOT EXISTS (
            SELECT 1 FROM old o WHERE o.claim = n.claim AND o.patient = n.patient))
    EXCEPT ALL SELECT o.claim, o.patient, o.status, CAST(o.price AS DOUBLE) FROM old o
        JOIN new n ON o.claim = n.claim AND o.patient = n.patient AND o.hash <> n.hash
    UNION ALL SELECT n.claim, n.patient, n.status, CAST(n.price AS DOUBLE) FROM old o
        JOIN new n ON o.claim = n.claim AND o.patient = n.patient AND o.hash <> n.hash"""
)
def upsert_plain_keys(t: Tables) -> DataFrame:
    """Merge with plain key equality: rows with a missing key part are added on every run."""
    old, new = _states(t)
    state = op.upsert_by_fingerprint(old, new, KEY, null_safe=False)
    return state.select("claim", "patient", "status", F.col("price").cast("double").alias("price"))


@query(
    _STATES
    + """
    SELECT n_claim AS claim, n_status AS status, 'insert' AS change FROM both_states
        WHERE o_claim IS NULL
    UNION ALL SELECT o_claim, o_status, 'delete' FROM both_states WHERE n_claim IS NULL
    UNION ALL SELECT o_claim, o_status, 'update_preimage' FROM both_states
        WHERE o_hash <> n_hash
    UNION ALL SELECT n_claim, n_status, 'update_postimage' FROM both_states
        WHERE o_hash <> n_hash"""
)
def snapshot_changes(t: Tables) -> DataFrame:
    old, new = _states(t)
    return op.snapshot_changes(old, new, KEY).select(
        "claim", "status", F.col(op.CHANGE).alias("change")
    )


def _merged(t: Tables, folder: str, buckets: int = 16) -> None:
    """Three versions: the old orders; half of the new ones, each dearer; all of the new ones."""
    old, new = _states(t)
    dearer = derived(t.orders.filter(STILL_FED.replace("TIMESTAMP", "TIMESTAMP_NTZ")), NEW)
    dearer = dearer.filter("claim % 2 = 1").withColumn("price", F.expr("CAST(price + 1 AS DECIMAL(18, 2))"))
    between = row_fingerprint(dearer, exclude=KEY)
    for day, rows in enumerate((old, between, new), 1):
        buckets_of.merge_state(rows, folder, KEY, datetime(2001, 8, day), buckets=buckets, published=1)


@query(
    _STATES
    + """
    SELECT coalesce(n_claim, o_claim) AS claim, coalesce(n_patient, o_patient) AS patient,
        CASE WHEN n_claim IS NULL THEN o_status ELSE n_status END AS status,
        CAST(coalesce(n_price, o_price) AS DOUBLE) AS price, coalesce(n_hash, o_hash) AS print,
        CASE WHEN n_claim IS NULL THEN NULL WHEN o_claim IS NULL THEN 'insert'
            WHEN o_hash <> n_hash OR o_claim % 2 = 1 THEN 'update_postimage' END AS change
    FROM both_states"""
)
def bucketed_state(t: Tables) -> DataFrame:
    """The state after three merges into buckets, with all changes since the first version: a row
    that changed and changed back was written twice and still waits to be sent."""
    folder = f"{work_dir(t.spark)}/loomfeed-{uuid4().hex}"
    _merged(t, folder)
    return snapshots.read_snapshot(t.spark, folder).select(
        "claim",
        "patient",
        "status",
        F.col("price").cast("double").alias("price"),
        F.col("HASH").alias("print"),
        F.col(op.CHANGE).alias("change"),
    )


@query(
    _STATES
    + """
    SELECT n_claim AS claim, n_status AS status, 'insert' AS change FROM both_states
        WHERE o_claim IS NULL
    UNION ALL SELECT o_claim, o_status, 'update_preimage' FROM both_states
        WHERE o_hash <> n_hash
    UNION ALL SELECT n_claim, n_status, 'update_postimage' FROM both_states
        WHERE o_hash <> n_hash"""
)
def changes_between_versions(t: Tables) -> DataFrame:
    """Inserts and updates from the first version to the third, read from the stored change sets.

    A merge keeps rows that left the feed, so there are no deletes."""
    folder = f"{work_dir(t.spark)}/loomfeed-{uuid4().hex}"
    _merged(t, folder)
    changes = buckets_of.changes_between(t.spark, folder, KEY, 1, 3)
    return changes.select("claim", "status", F.col(op.CHANGE).alias("change"))


@query(
    _STATES
    + """
    SELECT coalesce(n_claim, o_claim) AS claim,
        CASE WHEN n_claim IS NULL THEN o_status ELSE n_status END AS status FROM both_states"""
)
def released_versions(t: Tables) -> DataFrame:
    """The state stays whole when the versions that its untouched buckets come from are released."""
    folder = f"{work_dir(t.spark)}/loomfeed-{uuid4().hex}"
    _merged(t, folder, 64)
    buckets_of.release_versions(t.spark, folder, datetime(2001, 8, 9))
    return snapshots.read_snapshot(t.spark, folder).select("claim", "status")


HEADERS = {
    "SOURCE_SYSTEM_SK": "o_orderstatus",
    "TENANT_SK": "o_orderpriority",
    "CLAIM_NUMBER": "o_orderkey",
    "CLAIM_ADJUST_TYPE": "CASE WHEN o_totalprice < 20000 THEN 'DELETE' "
    "WHEN o_totalprice < 150000 THEN 'ORIGINAL' WHEN o_totalprice < 250000 THEN 'BACKOUT' "
    "WHEN o_totalprice < 300000 THEN NULL ELSE 'ADJUSTMENT' END",
    "UPDATE_TYPE": "CASE WHEN o_totalprice > 440000 THEN 'DELETE' ELSE '' END",
    "_change_type": "CASE WHEN o_orderdate >= CAST('2001-06-01' AS TIMESTAMP) THEN 'insert' "
    "WHEN o_orderdate >= CAST('2000-06-01' AS TIMESTAMP) THEN 'update_postimage' END",
}
LINE_CHANGE = (
    "CASE WHEN l_shipdate >= CAST('2001-08-01' AS TIMESTAMP) THEN 'insert' "
    "WHEN l_shipdate >= CAST('2000-12-01' AS TIMESTAMP) THEN 'update_postimage' END"
)

_CLASSIFIED = f"""
    WITH h AS ({derived_sql('orders', HEADERS)}),
    x AS (SELECT l_orderkey AS claim, {LINE_CHANGE} AS change FROM lineitem),
    ins AS (SELECT DISTINCT claim FROM x WHERE change = 'insert'),
    upd AS (SELECT DISTINCT claim FROM x WHERE change = 'update_postimage'),
    f AS (SELECT h.*, coalesce(_change_type = 'insert', false) AS hi,
            coalesce(_change_type = 'update_postimage', false) AS hu,
            CLAIM_NUMBER IN (SELECT claim FROM ins) AS li,
            CLAIM_NUMBER IN (SELECT claim FROM upd) AS lu FROM h),
    c AS (SELECT CLAIM_NUMBER, CLAIM_ADJUST_TYPE, CASE WHEN UPDATE_TYPE <> '' THEN UPDATE_TYPE
            WHEN CLAIM_ADJUST_TYPE <> 'DELETE' AND (hi OR li) THEN 'ORIGINAL'
            WHEN CLAIM_ADJUST_TYPE NOT IN ('DELETE', 'BACKOUT') AND (hu OR lu) THEN 'ADJUSTMENT'
            WHEN CLAIM_ADJUST_TYPE = 'DELETE' AND (hi OR hu) THEN 'DELETE'
            WHEN CLAIM_ADJUST_TYPE = 'BACKOUT' AND (hi OR hu OR lu OR li) THEN 'BACKOUT'
            ELSE UPDATE_TYPE END AS UPDATE_TYPE FROM f)"""


def _classified(t: Tables) -> DataFrame:
    change = F.expr(LINE_CHANGE.replace("AS TIMESTAMP)", "AS TIMESTAMP_NTZ)"))
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("CLAIM_NUMBER"), change.alias(op.CHANGE)
    ).filter(F.col(op.CHANGE).isNotNull())
    return op.classify_changes(derived(t.orders, HEADERS), lines, keys=("CLAIM_NUMBER",))


@query(_CLASSIFIED + ' SELECT CLAIM_NUMBER AS claim, UPDATE_TYPE AS kind FROM c')
def classify_changes(t: Tables) -> DataFrame:
    classified = _classified(t)
    return classified.select(
        F.col("CLAIM_NUMBER").alias("claim"), F.col("UPDATE_TYPE").alias("kind")
    )


@query(
    _CLASSIFIED
    + """, n AS (SELECT DISTINCT l_orderkey AS claim FROM lineitem WHERE l_returnflag = 'R')
    SELECT CLAIM_NUMBER AS claim, UPDATE_TYPE AS kind, 'Hist' AS run FROM c
    WHERE (UPDATE_TYPE IN ('ORIGINAL', 'ADJUSTMENT', 'BACKOUT')
        AND CLAIM_NUMBER IN (SELECT claim FROM n)) AND UPDATE_TYPE <> 'DELETE'
    UNION ALL
    SELECT CLAIM_NUMBER, UPDATE_TYPE, 'Delta' FROM c
    WHERE (UPDATE_TYPE IN ('ORIGINAL', 'ADJUSTMENT', 'BACKOUT')
        AND CLAIM_NUMBER IN (SELECT claim FROM n)) OR UPDATE_TYPE = 'DELETE'"""
)
def run_type_select(t: Tables) -> DataFrame:
    claims = t.lineitem.filter("l_returnflag = 'R'").select(
        F.col("l_orderkey").alias("CLAIM_NUMBER")
    )
    headers = _classified(t)
    frames = [
        op.select_published(headers, claims, run)[0].select(
            F.col("CLAIM_NUMBER").alias("claim"),
            F.col("UPDATE_TYPE").alias("kind"),
            F.lit(run).alias("run"),
        )
        for run in ("Hist", "Delta")
    ]
    return frames[0].unionByName(frames[1])


@query(
    """
    SELECT o_orderkey, CASE WHEN trim(kind) IN ('ORIGINAL', 'ADJUSTMENT', 'DELETE', 'BACKOUT')
        THEN '' ELSE kind END AS kind
    FROM (SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN ' ORIGINAL'
        WHEN '2-HIGH' THEN 'DELETE ' WHEN '3-MEDIUM' THEN 'HELD' WHEN '5-LOW' THEN 'BACKOUT' END
        AS kind FROM orders)"""
)
def publish_reset(t: Tables) -> DataFrame:
    given = {
        "o_orderkey": "o_orderkey",
        "kind": "CASE o_orderpriority WHEN '1-URGENT' THEN ' ORIGINAL' WHEN '2-HIGH' "
        "THEN 'DELETE ' WHEN '3-MEDIUM' THEN 'HELD' WHEN '5-LOW' THEN 'BACKOUT' END",
    }
    return op.reset_published(derived(t.orders, given), "kind")


LOADS = {
    "claim": "o_orderkey",
    "Filename": "CASE o_orderstatus WHEN 'F' THEN 'A_Hist_Lab_1.txt' WHEN 'O' "
    "THEN 'A_Delta_Lab_2.txt' ELSE 'A_Delta_Pod_3.txt' END",
    "LoadDate": "CAST(EXTRACT(YEAR FROM o_orderdate) * 10000 + EXTRACT(MONTH FROM o_orderdate) "
    "* 100 + EXTRACT(DAY FROM o_orderdate) AS STRING)",
}
RUN_DAY = date(2001, 8, 1)


@query(
    f"""
    WITH l AS ({derived_sql('orders', LOADS)}),
    h AS (SELECT * FROM l WHERE Filename <> 'A_Delta_Pod_3.txt'),
    a AS (SELECT * FROM l WHERE Filename = 'A_Delta_Pod_3.txt')
    SELECT claim, LoadDate AS load_date, 'hist' AS tier FROM h WHERE LoadDate >= '20000801'
    UNION ALL SELECT claim, LoadDate, 'archive' FROM a WHERE LoadDate >= '19990802'
    UNION ALL SELECT claim, LoadDate, 'archive' FROM h
        WHERE LoadDate < '20000801' AND LoadDate >= '19990802'"""
)
def retention_tiers(t: Tables) -> DataFrame:
    loads = derived(t.orders, LOADS)
    pods = F.col("Filename") == "A_Delta_Pod_3.txt"
    kept, archived = hist.apply_retention(loads.filter(~pods), loads.filter(pods), RUN_DAY)
    return (
        kept.withColumn("tier", F.lit("hist"))
        .unionByName(archived.withColumn("tier", F.lit("archive")))
        .select("claim", F.col("LoadDate").alias("load_date"), "tier")
    )


@query(
    """
    SELECT doc_id, regexp_replace(lang, '^\\s+|\\s+$|\\t+', '', 'g') AS lang,
        'r.txt' AS filename, '20010801' AS load_date FROM
        (SELECT doc_id, '\t' || lang || '\t' || source || ' ' AS lang FROM documents)
    UNION ALL SELECT o_orderkey, o_orderstatus, 'old.txt', '20000101' FROM orders"""
)
def history_append(t: Tables) -> DataFrame:
    padded = F.concat(F.lit("\t"), "lang", F.lit("\t"), "source", F.lit(" "))
    rows = t.documents.select("doc_id", padded.alias("lang"))
    stamped = hist.history_rows(rows, "r.txt", datetime(2001, 8, 1, 6, 30))
    earlier = t.orders.select(
        F.col("o_orderkey").alias("doc_id"),
        F.col("o_orderstatus").alias("lang"),
        F.lit("old.txt").alias("Filename"),
        F.lit("2000-01-01 00:00:00.000").alias("LoadTime"),
        F.lit("20000101").alias("LoadDate"),
    )
    return hist.append_history(earlier, stamped).select(
        "doc_id",
        "lang",
        F.col("Filename").alias("filename"),
        F.col("LoadDate").alias("load_date"),
    )


@query(
    """
    SELECT o_orderkey, o_orderstatus FROM orders
    WHERE NOT (o_orderstatus = 'F' AND o_orderpriority = '5-LOW')"""
)
def delete_where(t: Tables) -> DataFrame:
    kept = hist.delete_where(t.orders, {"o_orderstatus": "F", "o_orderpriority": "5-LOW"})
    return kept.select("o_orderkey", "o_orderstatus")


@query(
    f"""
    WITH l AS ({derived_sql('orders', LOADS)})
    SELECT claim, Filename AS filename, CASE WHEN starts_with(Filename, 'A_Hist_Lab_')
        OR starts_with(Filename, 'A_Delta_Lab_') THEN 'archive' ELSE 'base' END AS place FROM l"""
)
def rotate_extracts(t: Tables) -> DataFrame:
    loads = derived(t.orders, LOADS)
    kept, archived = hist.rotate_extracts(
        loads, loads.filter("false"), ["A_Hist_Lab_", "A_Delta_Lab_"]
    )
    return (
        kept.withColumn("place", F.lit("base"))
        .unionByName(archived.withColumn("place", F.lit("archive")))
        .select("claim", F.col("Filename").alias("filename"), "place")
    )


@query(
    """
    WITH k AS (SELECT CASE WHEN event_type = 'signup' THEN 'inscope_patient' ELSE event_type END
            AS file_name, max(ts) AS last_dt, min(ts) AS prev_dt FROM events GROUP BY event_type)
    SELECT file_name, strftime(CASE WHEN file_name IN ('click', 'view')
            THEN (SELECT last_dt FROM k WHERE file_name = 'inscope_patient')
            WHEN file_name = 'error' THEN TIMESTAMP '2024-02-01 06:00:00'
            ELSE last_dt END, '%Y-%m-%d %H:%M:%S.%f') AS last_dt,
        strftime(CASE WHEN file_name IN ('click', 'error') THEN last_dt ELSE prev_dt END,
            '%Y-%m-%d %H:%M:%S.%f') AS prev_dt
    FROM k"""
)
def watermark_cycle(t: Tables) -> DataFrame:
    """Control times taken from the events, advanced in three ways."""
    domain = F.when(F.col("event_type") == "signup", "inscope_patient").otherwise(
        F.col("event_type")
    )
    control = t.events.groupBy(domain.alias("file_name")).agg(
        F.max("ts").alias("last_extract_dt"), F.min("ts").alias("previous_last_extract_dt")
    )
    control = advance_watermark(control, "click")
    control = advance_watermark(control, "view", keep_previous=True)
    control = advance_watermark(control, "error", to=datetime(2024, 2, 1, 6))
    pattern = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    return control.select(
        "file_name",
        F.date_format("last_extract_dt", pattern).alias("last_dt"),
        F.date_format("previous_last_extract_dt", pattern).alias("prev_dt"),
    )


@query(
    """
    SELECT event_id, event_type, value FROM events WHERE CAST(ts AS DATE) =
        (SELECT max(CAST(ts AS DATE)) FROM events WHERE CAST(ts AS DATE) <= DATE '2024-01-17')"""
)
def as_of_read(t: Tables) -> DataFrame:
    dated = t.events.withColumn("snapshot", F.to_date("ts"))
    chosen = snapshots.read_as_of(dated, "snapshot", F.lit("2024-01-17").cast("date"))
    return chosen.select("event_id", "event_type", "value")


LOG = {
    "version": "event_id",
    "committed_at": "ts",
    "operation": "CASE WHEN event_type = 'signup' THEN 'REBUILD' ELSE 'MERGE' END",
}


@query(
    f"""
    WITH l AS ({derived_sql('events', LOG)})
    SELECT version, committed_at, operation FROM l WHERE operation = 'MERGE'
    ORDER BY version DESC LIMIT 1"""
)
def latest_version(t: Tables) -> DataFrame:
    return snapshots.latest_version(derived(t.events, LOG), snapshots.MERGE)


@query(
    f"""
    WITH l AS ({derived_sql('events', LOG)}),
    r AS (SELECT max(committed_at) AS committed_at FROM l WHERE operation = 'REBUILD')
    SELECT 23 AS hours, committed_at FROM r
        WHERE committed_at + INTERVAL 23 HOUR > TIMESTAMP '2024-02-05'
    UNION ALL SELECT 2159, committed_at FROM r
        WHERE committed_at + INTERVAL 2159 HOUR > TIMESTAMP '2024-02-05'"""
)
def rebuild_guard(t: Tables) -> DataFrame:
    """Time of the last rebuild where it is still within the read-back window."""
    log, now = derived(t.events, LOG), F.expr("timestamp_ntz'2024-02-05'")
    frames = [
        snapshots.rebuild_time(log, now, hours).select(F.lit(hours).alias("hours"), "committed_at")
        for hours in (snapshots.MAX_AGE_HOURS, snapshots.MAX_AGE_HOURS_PRODUCTION)
    ]
    return frames[0].unionByName(frames[1])
