"""Value rules: text, codes, dates, fingerprints."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import codes, dates, text
from ..functions.fingerprint import fingerprint
from ..operators.shape import project
from .base import Tables, derived, derived_sql, query

PADDED_TEXT = {
    "doc_id": "doc_id",
    "body": "'  \t' || text || '\t \t '",
    "note": "lang || '\t ' || source || '\tend'",
}


def _padded(t: Tables, pattern: str) -> DataFrame:
    cleaned = text.clean_strings(derived(t.documents, PADDED_TEXT), pattern)
    size = F.length("body").cast("long").alias("size")
    return cleaned.select("doc_id", F.md5("body").alias("body"), size, "note")


def _padded_sql(pattern: str) -> str:
    return f"""
        WITH d AS ({derived_sql('documents', PADDED_TEXT)}),
        c AS (SELECT doc_id, regexp_replace(body, '{pattern}', '', 'g') AS body,
                     regexp_replace(note, '{pattern}', '', 'g') AS note FROM d)
        SELECT doc_id, md5(body) AS body, CAST(length(body) AS BIGINT) AS size, note FROM c"""


@query(_padded_sql(r"^\s+|\s+$|\t+ "))
def string_cleanup_extract(t: Tables) -> DataFrame:
    return _padded(t, text.FILE)


@query(_padded_sql(r"^\s+|\s+$|\t+"))
def string_cleanup_history(t: Tables) -> DataFrame:
    return _padded(t, text.HISTORY)


@query(
    r"""
    SELECT doc_id, md5(regexp_replace(text,
        '[\x{0000}-\x{001F}|\x{00A0}-\x{00FF}\x{FFF0}-\x{FFFF}]', '', 'g')) AS body,
        regexp_replace(nullif(lang, 'en') || '|é' || chr(7) || source,
        '[\x{0000}-\x{001F}|\x{00A0}-\x{00FF}\x{FFF0}-\x{FFFF}]', '', 'g') AS note
    FROM documents"""
)
def strip_nonprintable(t: Tables) -> DataFrame:
    note = F.concat(F.nullif("lang", F.lit("en")), F.lit("|é\u0007"), "source")
    return t.documents.select(
        "doc_id",
        F.md5(text.strip_nonprintable("text")).alias("body"),
        text.strip_nonprintable(note).alias("note"),
    )


@query(
    r"""
    WITH d AS (SELECT doc_id, text, CASE WHEN lang = 'fr' THEN lang || '"' || source
                      WHEN lang = 'en' THEN lang || source END AS note FROM documents)
    SELECT doc_id,
        md5(CASE WHEN contains(text, '"') THEN '"' || replace(text, '"', '\"') || '"'
                 ELSE text END) AS body,
        CASE WHEN contains(note, '"') THEN '"' || replace(note, '"', '\"') || '"'
             ELSE note END AS note
    FROM d"""
)
def quote_if_needed(t: Tables) -> DataFrame:
    note = F.when(F.col("lang") == "fr", F.concat("lang", F.lit('"'), "source")).when(
        F.col("lang") == "en", F.concat("lang", "source")
    )
    return t.documents.select(
        "doc_id",
        F.md5(text.quote_if_needed("text")).alias("body"),
        text.quote_if_needed(note).alias("note"),
    )


PROVIDERS = {
    "s_suppkey": "s_suppkey",
    "provider_id": "CASE WHEN s_acctbal < 0 THEN '-1' WHEN s_nationkey = 0 THEN 'NS' "
    "WHEN s_nationkey = 1 THEN 'NF' WHEN s_nationkey = 2 THEN NULL "
    "ELSE '  ' || s_name || ' of the longest names ' END",
    "group_id": "CASE WHEN s_nationkey = 3 THEN '-1' WHEN s_nationkey = 4 THEN NULL "
    "ELSE CAST(s_nationkey AS STRING) END",
    "revised": "CASE WHEN s_acctbal > 5000 THEN 'R' || CAST(s_nationkey AS STRING) END",
    "contract": "CASE WHEN s_nationkey < 5 THEN ' -1 ' WHEN s_nationkey < 9 THEN 'OCN ' "
    "WHEN s_nationkey < 12 THEN NULL ELSE ' H' || CAST(s_nationkey AS STRING) END",
    "plan": "CASE WHEN s_nationkey < 5 THEN ' CT' WHEN s_nationkey < 12 THEN NULL "
    "ELSE ' 00' || CAST(s_nationkey AS STRING) || ' ' END",
}


@query(
    f"""
    WITH p AS ({derived_sql('supplier', PROVIDERS)})
    SELECT s_suppkey,
        CASE WHEN provider_id IS NULL OR provider_id IN ('-1', 'NS', 'NF') THEN '0'
             ELSE substring(trim(provider_id), 1, 24) END AS provider_id,
        CASE WHEN coalesce(provider_id, '0') = '-1' THEN '0'
             ELSE coalesce(provider_id, '0') END AS pcp_id,
        CASE WHEN group_id IS NULL OR group_id IN ('-1', 'NS', 'NF') THEN '0'
             ELSE coalesce(revised, '0') END AS group_id,
        CASE WHEN contract IS NULL OR trim(contract) IN ('-1', 'OCN') THEN '0'
             ELSE trim(contract) END AS contract,
        CASE WHEN plan IS NULL OR trim(plan) IN ('-1', 'CT') THEN '0'
             ELSE trim(plan) END AS plan
    FROM p"""
)
def sentinel_defaults(t: Tables) -> DataFrame:
    return project(
        derived(t.supplier, PROVIDERS),
        {
            "s_suppkey": "s_suppkey",
            "provider_id": codes.sentinel_default("provider_id", max_length=24),
            "pcp_id": codes.sentinel_default("provider_id", ("-1",), trim=False),
            "group_id": codes.sentinel_crosswalk("group_id", "revised"),
            "contract": codes.sentinel_default(
                "contract", codes.CONTRACT_SENTINELS, compare_trimmed=True
            ),
            "plan": codes.sentinel_default("plan", codes.PLAN_SENTINELS, compare_trimmed=True),
        },
    )


EARLY = {
    "o_orderkey": "o_orderkey",
    "d": "CASE WHEN o_orderstatus = 'F' THEN o_orderdate - INTERVAL '98' YEAR "
    "WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderdate END",
}


@query(
    f"""
    WITH e AS ({derived_sql('orders', EARLY)})
    SELECT o_orderkey,
        strftime(CASE WHEN d < TIMESTAMP '1900-01-01' THEN TIMESTAMP '1900-01-01' ELSE d END,
                 '%Y-%m-%d') AS clamped,
        strftime(CASE WHEN d >= TIMESTAMP '1900-01-01' THEN d END, '%Y-%m-%d') AS nulled
    FROM e"""
)
def date_floor(t: Tables) -> DataFrame:
    return derived(t.orders, EARLY).select(
        "o_orderkey",
        F.date_format(dates.floor_date("d"), "yyyy-MM-dd").alias("clamped"),
        F.date_format(dates.floor_date("d", "null"), "yyyy-MM-dd").alias("nulled"),
    )


PLACEHOLDERS = {
    "o_orderkey": "o_orderkey",
    "d": "CASE WHEN o_orderpriority = '1-URGENT' THEN CAST('1753-01-01' AS TIMESTAMP) "
    "WHEN o_orderpriority = '2-HIGH' THEN CAST('1111-01-08' AS TIMESTAMP) "
    "WHEN o_orderpriority = '3-MEDIUM' THEN CAST('8888-12-31' AS TIMESTAMP) "
    "WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderdate END",
}


@query(
    f"""
    WITH e AS ({derived_sql('orders', PLACEHOLDERS)})
    SELECT o_orderkey, strftime(CASE WHEN d IN (TIMESTAMP '1753-01-01', TIMESTAMP '1111-01-08',
        TIMESTAMP '8888-12-31') THEN NULL ELSE d END, '%Y-%m-%d') AS d FROM e"""
)
def null_dates(t: Tables) -> DataFrame:
    shown = F.date_format(dates.null_dates("d"), "yyyy-MM-dd").alias("d")
    return derived(t.orders, PLACEHOLDERS).select("o_orderkey", shown)


STATEMENTS = {
    "o_orderkey": "o_orderkey",
    "serv_from": "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN NULL "
    "WHEN o_orderpriority = '3-MEDIUM' THEN o_orderdate - INTERVAL '120' YEAR "
    "ELSE o_orderdate END",
    "serv_thru": "CASE WHEN o_orderstatus = 'F' THEN NULL "
    "WHEN o_orderstatus = 'O' THEN o_orderdate - INTERVAL '130' YEAR "
    "ELSE o_orderdate + INTERVAL '2' DAY END",
    "service": "CASE WHEN o_orderpriority = '1-URGENT' THEN NULL "
    "ELSE o_orderdate - INTERVAL '1' DAY END",
}


@query(
    f"""
    WITH e AS ({derived_sql('orders', STATEMENTS)})
    SELECT o_orderkey,
        strftime(CASE WHEN serv_from IS NULL THEN service ELSE serv_from END, '%Y-%m-%d')
            AS statement_from,
        strftime(CASE WHEN serv_thru IS NULL AND serv_from IS NOT NULL THEN serv_from
                      WHEN serv_thru IS NULL THEN service
                      WHEN serv_thru < TIMESTAMP '1900-01-01' THEN NULL
                      ELSE serv_thru END, '%Y-%m-%d') AS statement_to
    FROM e"""
)
def statement_dates(t: Tables) -> DataFrame:
    start = dates.statement_from("serv_from", "service")
    end = dates.statement_to("serv_thru", "serv_from", "service")
    return derived(t.orders, STATEMENTS).select(
        "o_orderkey",
        F.date_format(start, "yyyy-MM-dd").alias("statement_from"),
        F.date_format(end, "yyyy-MM-dd").alias("statement_to"),
    )


CLAIM_IDS = {
    "o_orderkey": "o_orderkey",
    "source": "CASE o_orderstatus WHEN 'F' THEN '610' WHEN 'O' THEN '620' END",
    "number": "CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL "
    "ELSE ' ' || CAST(o_custkey AS STRING) || ' ' END",
    "adjust": "CASE o_orderpriority WHEN '1-URGENT' THEN 'ORIGINAL' WHEN '2-HIGH' "
    "THEN 'ADJUSTMENT' WHEN '3-MEDIUM' THEN 'BACKOUT' WHEN '4-NOT SPECIFIED' THEN 'VOID' END",
    "del_ind": "CASE WHEN o_totalprice < 20000 THEN 1 ELSE 0 END",
}


@query(
    f"""
    WITH c AS ({derived_sql('orders', CLAIM_IDS)})
    SELECT o_orderkey,
        CASE WHEN source = '610' THEN number ELSE trim(source || '-' || number) END
            AS claim_number,
        CASE WHEN source = '610' AND adjust NOT IN ('ORIGINAL', 'ADJUSTMENT') THEN trim(number)
             WHEN source <> '610' AND adjust NOT IN ('ORIGINAL', 'ADJUSTMENT')
                  THEN trim(source || '-' || number)
             ELSE '' END AS orig_claim_number,
        CAST(o_orderkey AS VARCHAR) AS order_text
    FROM c"""
)
def composite_keys(t: Tables) -> DataFrame:
    claims = derived(t.orders, CLAIM_IDS)
    return claims.select(
        "o_orderkey",
        codes.composite_key("source", "number").alias("claim_number"),
        codes.original_claim_number("source", "number", "adjust").alias("orig_claim_number"),
        F.col("o_orderkey").cast("string").alias("order_text"),
    )


CODES = {
    "l_orderkey": "l_orderkey",
    "l_linenumber": "l_linenumber",
    "status": "CASE l_linenumber WHEN 1 THEN ' Paid' WHEN 2 THEN 'DENIED ' WHEN 3 THEN 'other' "
    "WHEN 4 THEN 'Pended' WHEN 5 THEN 'lost' END",
    "adjust": "CASE l_returnflag WHEN 'A' THEN 'ORIGINAL' WHEN 'R' THEN 'BACKOUT' END",
    "del_ind": "CASE WHEN l_quantity < 5 THEN 1 WHEN l_quantity < 10 THEN NULL ELSE 0 END",
    "flag": "CASE l_returnflag WHEN 'A' THEN 'Y' WHEN 'N' THEN 'N' ELSE 'U' END",
    "ind": "CASE WHEN l_linestatus = 'F' THEN ' 1 ' WHEN l_quantity < 20 THEN '0' "
    "WHEN l_quantity < 30 THEN 'abc' END",
}


@query(
    f"""
    WITH c AS ({derived_sql('lineitem', CODES)})
    SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
        CASE trim(upper(status)) WHEN 'PAID' THEN 'P' WHEN 'DENIED' THEN 'D' WHEN 'OTHER'
             THEN 'O' WHEN 'PENDED' THEN '' END AS status,
        CASE trim(upper(status)) WHEN 'PAID' THEN 'P' WHEN 'DENIED' THEN 'D' WHEN 'OTHER'
             THEN 'O' WHEN 'PENDED' THEN '' ELSE 'U' END AS status_or_u,
        CASE WHEN del_ind = 1 THEN 'DELETE' ELSE adjust END AS adjust,
        CASE WHEN del_ind = 1 THEN 'DELETE' WHEN adjust IS NULL THEN 'UNK' ELSE adjust END
            AS adjust_or_unk,
        CASE WHEN flag = 'Y' OR flag = 'N' THEN flag END AS flag,
        CASE WHEN TRY_CAST(trim(ind) AS DOUBLE) = 1 THEN 'Y' ELSE 'N' END AS capped
    FROM c"""
)
def code_maps(t: Tables) -> DataFrame:
    return project(
        derived(t.lineitem, CODES),
        {
            "l_orderkey": "l_orderkey",
            "l_linenumber": F.col("l_linenumber").cast("long"),
            "status": codes.map_codes("status"),
            "status_or_u": codes.map_codes("status", default="U"),
            "adjust": codes.adjust_type("adjust", "del_ind"),
            "adjust_or_unk": codes.adjust_type("adjust", "del_ind", codes.UNKNOWN),
            "flag": codes.yn_flag("flag"),
            "capped": codes.one_flag("ind"),
        },
    )


SLOTS = 7


def _wide(n: int, value: str) -> str:
    return f"max(CASE WHEN l_linenumber = {n} THEN {value} END)"


@query(
    "WITH w AS (SELECT l_orderkey, "
    + ", ".join(
        _wide(n, "' ' || CAST(l_partkey AS VARCHAR) || ' '")
        + f" AS code_{n}, "
        + _wide(n, "CASE WHEN l_returnflag = 'A' THEN 'Y' WHEN l_returnflag = 'R' THEN 'X' END")
        + f" AS poa_{n}"
        for n in range(1, SLOTS + 1)
    )
    + " FROM lineitem GROUP BY l_orderkey) SELECT l_orderkey, "
    + ", ".join(
        (f"coalesce(trim(code_{n}), 'UNK')" if n == 1 else f"trim(code_{n})")
        + f" AS icd_diag_{n}, CASE WHEN code_{n} IS NOT NULL THEN "
        + f"CASE WHEN poa_{n} = 'Y' THEN 'Y' ELSE 'N' END END AS diag_code_{n}_poa"
        for n in range(1, SLOTS + 1)
    )
    + " FROM w"
)
def diagnosis_slots(t: Tables) -> DataFrame:
    code = F.concat(F.lit(" "), F.col("l_partkey").cast("string"), F.lit(" "))
    present = F.when(F.col("l_returnflag") == "A", "Y").when(F.col("l_returnflag") == "R", "X")
    pivot = []
    for n in range(1, SLOTS + 1):
        here = F.col("l_linenumber") == n
        pivot.append(F.max(F.when(here, code)).alias(f"code_{n}"))
        pivot.append(F.max(F.when(here, present)).alias(f"poa_{n}"))
    wide = t.lineitem.groupBy("l_orderkey").agg(*pivot)
    slots = codes.diagnosis_slots(
        SLOTS, "code_{n}", "poa_{n}", "icd_diag_{n}", "diag_code_{n}_poa", codes.UNKNOWN
    )
    return wide.select("l_orderkey", *slots)


LIMITS = {
    "p_partkey": "p_partkey",
    "code": "CASE WHEN p_type = 'PROMO' THEN NULL WHEN p_type = 'SMALL' THEN 'UNK ' "
    "WHEN p_type = 'LARGE' THEN '' WHEN p_type = 'MEDIUM' THEN '12345' || p_type "
    "ELSE CAST(p_size AS STRING) END",
    "name": "CASE WHEN p_size < 5 THEN NULL WHEN p_size < 10 THEN '   ' "
    "ELSE '  ' || p_name || ' ' || p_brand || '  ' END",
    "amount": "CASE WHEN p_size > 10 THEN CAST(p_retailprice AS DECIMAL(18, 2)) END",
}


@query(
    f"""
    WITH l AS ({derived_sql('part', LIMITS)})
    SELECT p_partkey,
        CASE WHEN code IS NULL THEN NULL WHEN trim(code) = 'UNK' THEN code
             ELSE right('000' || code, 4) END AS padded,
        CASE WHEN length(trim(name)) > 16 THEN NULL ELSE trim(name) END AS short_name,
        CASE WHEN length(name) > 20 THEN NULL ELSE name END AS short_raw,
        CAST(coalesce(amount, CAST(0 AS DECIMAL(18, 2))) AS DOUBLE) AS amount,
        substring(trim(name), 1, 15) AS cut,
        CASE WHEN name IS NULL OR trim(name) = '' THEN '0-0' ELSE name END AS with_range,
        nullif(trim(name), '') AS nonblank
    FROM l"""
)
def pad_and_limit(t: Tables) -> DataFrame:
    return project(
        derived(t.part, LIMITS),
        {
            "p_partkey": "p_partkey",
            "padded": codes.pad_code("code"),
            "short_name": text.null_if_longer("name", 16),
            "short_raw": text.null_if_longer("name", 20, trim=False),
            "amount": codes.typed_default("amount", "0.00", "decimal(18,2)").cast("double"),
            "cut": text.truncate("name", 15),
            "with_range": text.default_if_blank("name", "0-0"),
            "nonblank": text.blank_to_null("name"),
        },
    )


@query(
    """
    SELECT event_id, strftime(ts, '%H:%M:%S.%g') AS at_time,
        strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS at_text,
        CAST(CASE WHEN ts - to_years(CAST(floor(value) AS INTEGER)) < TIMESTAMP '2015-10-01'
             THEN 9 ELSE 0 END AS BIGINT) AS era,
        CAST(TRY_CAST(CASE WHEN event_type = 'error' THEN 'n/a' ELSE CAST(CAST(value AS
             DECIMAL(32, 2)) AS VARCHAR) END AS DECIMAL(32, 2)) AS DOUBLE) AS amount,
        CAST(CAST(value AS DECIMAL(32, 2)) AS VARCHAR) AS amount_text
    FROM events"""
)
def time_and_text(t: Tables) -> DataFrame:
    years = F.make_ym_interval(years=F.floor("value").cast("int"))
    exact = F.col("value").cast("decimal(32,2)")
    typed = F.when(F.col("event_type") == "error", "n/a").otherwise(exact.cast("string"))
    return project(
        t.events,
        {
            "event_id": "event_id",
            "at_time": dates.time_of_day("ts"),
            "at_text": dates.timestamp_text("ts"),
            "era": dates.code_era(F.col("ts") - years).cast("long"),
            "amount": codes.amount(typed, as_text=False).cast("double"),
            "amount_text": codes.amount(exact, as_text=True),
        },
    )


@query(
    """
    WITH e AS (SELECT event_id, event_type, ts, CASE event_type
            WHEN 'click' THEN strftime(ts, '%Y-%m-%d') WHEN 'view' THEN '2024-02-30'
            WHEN 'error' THEN strftime(ts, '%d.%m.%Y') WHEN 'signup' THEN '2024-13-01' END AS d
        FROM events)
    SELECT event_id, strftime(ts, '%y%m%d') AS token, strftime(ts, '%Y%m%d') AS load_date,
        try_strptime(d, '%Y-%m-%d') IS NOT NULL AS is_date,
        strftime(date_trunc('month', ts) - INTERVAL 39 MONTH, '%Y-%m-%d') AS first_day,
        'P_Delta_' || event_type || '_' || strftime(ts - INTERVAL 1 MONTH, '%y%m%d') || '_'
            || strftime(ts, '%y%m%d') AS report
    FROM e"""
)
def date_tokens(t: Tables) -> DataFrame:
    kind, day = F.col("event_type"), F.date_format("ts", "yyyy-MM-dd")
    written = (
        F.when(kind == "click", day)
        .when(kind == "view", "2024-02-30")
        .when(kind == "error", F.date_format("ts", "dd.MM.yyyy"))
        .when(kind == "signup", "2024-13-01")
    )
    start = dates.lookback_start(F.to_date("ts"), dates.DEFAULT_LOOKBACK)
    last = F.col("ts") - F.make_ym_interval(months=F.lit(1))
    report = dates.report_name(F.lit("P"), F.lit("Delta"), kind, last, "ts")
    return t.events.select(
        "event_id",
        dates.file_token("ts").alias("token"),
        dates.load_date("ts").alias("load_date"),
        dates.valid_date(written).alias("is_date"),
        F.date_format(start, "yyyy-MM-dd").alias("first_day"),
        report.alias("report"),
    )


PEOPLE = {
    "c_custkey": "c_custkey",
    "last": "c_name",
    "first": "CASE WHEN c_nationkey = 0 THEN NULL ELSE c_mktsegment END",
    "middle": "CASE WHEN c_acctbal < 0 THEN NULL ELSE 'N' || CAST(c_nationkey AS STRING) END",
}


@query(
    f"""
    WITH p AS ({derived_sql('customer', PEOPLE)})
    SELECT c_custkey,
        CASE WHEN middle IS NULL THEN last || ',' || first || ' '
             ELSE last || ',' || first || ' ' || middle END AS with_space,
        CASE WHEN middle IS NULL THEN last || ',' || first
             ELSE last || ',' || first || ' ' || middle END AS without_space,
        upper(replace(last || ' ' || first, ' ', '')) AS lookup_name
    FROM p"""
)
def full_names(t: Tables) -> DataFrame:
    people = derived(t.customer, PEOPLE)
    return people.select(
        "c_custkey",
        text.full_name("last", "first", "middle", trailing_space=True).alias("with_space"),
        text.full_name("last", "first", "middle", trailing_space=False).alias("without_space"),
        text.lookup_key(F.concat("last", F.lit(" "), "first")).alias("lookup_name"),
    )


FINGERPRINTED = {
    "o_orderkey": "o_orderkey",
    "a": "CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderpriority END",
    "b": "CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END",
    "placed": "o_orderdate",
    "price": "CAST(o_totalprice AS DECIMAL(18, 2))",
}


def md5_sql(columns: list[str]) -> str:
    """The fingerprint in SQL."""
    parts = [
        f"coalesce(CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || "
        f"CAST({c} AS VARCHAR), '~')"
        for c in columns
    ]
    return "md5(concat_ws('|', " + ", ".join(parts) + "))"


@query(
    f"WITH f AS ({derived_sql('orders', FINGERPRINTED)}) "
    f"SELECT o_orderkey, {md5_sql(['a', 'b', 'placed', 'price'])} AS print FROM f"
)
def row_fingerprint(t: Tables) -> DataFrame:
    rows = derived(t.orders, FINGERPRINTED)
    return rows.select("o_orderkey", fingerprint(["a", "b", "placed", "price"]).alias("print"))


PUBLISHED = {
    "o_orderkey": "o_orderkey",
    "kind": "CASE o_orderpriority WHEN '1-URGENT' THEN 'DELETE' WHEN '2-HIGH' THEN 'BACKOUT' "
    "WHEN '3-MEDIUM' THEN 'ORIGINAL' WHEN '4-NOT SPECIFIED' THEN 'VOID' END",
    "change": "CASE o_orderstatus WHEN 'F' THEN 'ADJUSTMENT' WHEN 'O' THEN 'ORIGINAL' END",
}


@query(
    f"""
    WITH p AS ({derived_sql('orders', PUBLISHED)})
    SELECT o_orderkey, CASE WHEN kind = 'DELETE' THEN kind
        WHEN change = 'ADJUSTMENT' AND (kind <> 'BACKOUT' OR change <> 'BACKOUT')
        THEN 'ADJUSTMENT' ELSE kind END AS kind
    FROM p"""
)
def published_adjust_type(t: Tables) -> DataFrame:
    kind = codes.published_adjust_type("kind", "change").alias("kind")
    return derived(t.orders, PUBLISHED).select("o_orderkey", kind)
