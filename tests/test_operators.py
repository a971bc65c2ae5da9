from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from loomfeed.operators import control, history, joins, rules, shape
from loomfeed.operators.detokenize import detokenize


def test_latest_row_surrogate_decides_and_null_comes_first(spark):
    data = [(1, 5, 10), (1, None, 1), (2, 7, 1), (2, 7, 2)]
    df = spark.createDataFrame(data, "k int, seq int, sk int")
    order = [F.col("seq").desc_nulls_first(), F.col("sk").desc_nulls_first()]
    assert rows(shape.latest_per_key(df, ["k"], order)) == [(1, None, 1), (2, 7, 2)]


def test_collapse_needs_several_tenants(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, "b", "x")], "TENANT_SK int, SOURCE_SYSTEM_SK string, v string")
    assert shape.collapse_tenants(df, (1,)) is df
    assert rows(shape.collapse_tenants(df, (1, 2))) == [(0, "0", "x")]


FACTS = [(1, "a"), (2, "b"), (3, None), (4, "-1"), (5, "z"), (6, "a")]


@pytest.mark.parametrize("spread", [(), ("id",)])
@pytest.mark.parametrize("salts", [1, 3])
def test_lookup_is_the_same_however_it_is_spread(spark, spread, salts):
    if salts > 1 and not spread:
        pytest.skip("salts need spread_by")
    facts = spark.createDataFrame(FACTS, "id int, sk string")
    dim = spark.createDataFrame(
        [("a", "A", 0), ("b", "B", 1), ("-1", "N", 0), (None, "X", 0)], "sk string, name string, gone int"
    )
    got = joins.lookup(
        facts,
        dim,
        [("sk", "sk")],
        {"name": "name"},
        where=F.col("gone") == 0,
        left_where=~F.col("sk").isin("-1"),
        spread_by=spread,
        salts=salts,
    )
    assert got.columns == ["id", "sk", "name"]
    assert rows(got, "id", "name") == [(1, "A"), (2, None), (3, None), (4, None), (5, None), (6, "A")]
    inner = joins.lookup(
        facts, dim, [("sk", "sk")], {"name": "name"}, how="inner", spread_by=spread, salts=salts
    )
    assert rows(inner, "id", "name") == [(1, "A"), (2, "B"), (4, "N"), (6, "A")]


def test_lookup_salts_need_columns(spark):
    facts = spark.createDataFrame(FACTS, "id int, sk string")
    with pytest.raises(ValueError):
        joins.lookup(facts, facts, [("sk", "sk")], {}, salts=2)


def test_identities_in_factored_form_give_the_pairs(spark):
    facts = spark.createDataFrame([(1, "late"), (1, "new"), (2, "new"), (9, "late")], "p int, kind string")
    patients = spark.createDataFrame([(1, "P1"), (2, "P2"), (3, "P3")], "patient_sk int, source_patient_id string")
    links = spark.createDataFrame(
        [("P1", "E", "X"), ("Q1", "E", "FEED"), ("Q2", "E", "FEED"), ("P2", "G", "FEED"), ("Q9", "H", "FEED")],
        "source_patient_id string, enterprise_id string, source string",
    )
    ids, partners = joins.expand_identities(
        facts, patients, links, "p", "patient_sk", "FEED", fact_where=F.col("kind") == "late"
    )
    assert rows(ids) == [("P1", "E"), ("P2", None)]
    assert rows(partners, "enterprise_id", "source_patient_id") == [("E", "Q1"), ("E", "Q2")]


RULE_SCHEMA = (
    "source_attribute string, source_systems string, attribute string, operator string, "
    "match_value string, default_value string, priority int"
)


def test_default_rules_order_types_and_columns(spark):
    df = spark.createDataFrame(
        [("610", None, 5, "keep"), ("620", " ", 50, "keep"), ("610", "\n", 7, "swap"), ("620", "x", None, "x")],
        "SOURCE_SYSTEM_SK string, Name string, Amount int, Other string",
    )
    table = [
        ("NAME", "'610','630'", "Name", "=", "null", "'SIX'", 1),
        ("NA ME", "all", "name", "=", "", "concat('NO', 'NE')", 2),
        ("AMOUNT", "All", "AMOUNT", ">", "10", "'10'", 1),
        ("AMOUNT", "all", "Amount", "=", None, "0", 2),
        ("OTHER", "all", "Name", "=", "'x'", "'from name'", 1),
        ("MISSING", "all", "Name", "=", "'x'", "'y'", 1),
    ]
    ruled = rules.apply_default_rules(df, spark.createDataFrame(table, RULE_SCHEMA))
    assert ruled.dtypes == df.dtypes
    assert rows(ruled) == sorted(
        [("610", "SIX", 5, "keep"), ("620", "NONE", 10, "keep"), ("610", "SIX", 7, "swap"), ("620", "x", 0, "from name")],
        key=str,
    )
    none = spark.createDataFrame([], RULE_SCHEMA)
    assert rules.apply_default_rules(df, none) is df


def test_rules_for_other_columns_stay_where_they_are(spark):
    """Rules of any number; only those for columns of the frame become part of its plan."""
    columns = (
        "source_attribute string, source_systems string, attribute string, operator string, "
        "match_value string, default_value string, priority int"
    )
    own = spark.createDataFrame([("a", "all", "a", "=", None, "'x'", 1)], columns)
    others = spark.range(20_000).selectExpr(
        "concat('c', id) AS source_attribute", "'all' AS source_systems", "'c' AS attribute",
        "'=' AS operator", "'1' AS match_value", "'2' AS default_value", "2 AS priority",
    )
    frame = spark.createDataFrame([(None,), ("b",)], "a string")
    changed = rules.apply_default_rules(frame, own.unionByName(others).unionByName(own))
    assert sorted(r.a for r in changed.collect()) == ["b", "x"]


def test_several_config_values_are_an_error(spark):
    names = spark.createDataFrame([("NY", "standard"), ("NY", "extended")], "target_market string, sdm_type string")
    with pytest.raises(ValueError):
        rules.model_type(names, "ny")
    assert rules.model_type(names.limit(0), "ny") == ""
    assert rules.model_type(names.filter("sdm_type = 'standard'"), "ny") == "standard"


LIST_SCHEMA = (
    "active_flg string, reference string, domain string, consumer string, market string, "
    "value_exclusion string, value_inclusion string"
)


def lists(spark):
    def row(market, exclusion, inclusion, active="Y", consumer="ALL"):
        return (active, "LINE_OF_BUSINESS", "Eligibility", consumer, market, exclusion, inclusion)

    return spark.createDataFrame(
        [row("NY", "B", "A,C"), row("ALL", None, "D"), row("CT", "Z", "Y"), row("NY", "Q", "Q", "N"), row("NY", "W", "W", consumer="SHOP")],
        LIST_SCHEMA,
    )


@pytest.mark.parametrize(
    ("market", "consumer", "include", "exclude"),
    [
        ("ny", "", ["A", "C", "D"], ["", "B"]),
        ("ny", "shop", ["A", "C", "D", "W"], ["", "B", "W"]),
        ("tx", "", ["D"], [""]),
    ],
)
def test_reference_list(spark, market, consumer, include, exclude):
    for kind, expected in (("inclusion", include), ("exclusion", exclude)):
        got = rules.reference_list(lists(spark), market, "eligibility", "line_of_business", consumer, kind)
        assert rows(got) == [(v,) for v in expected]


def test_empty_lists_and_null_values(spark):
    empty = rules.reference_list(lists(spark), "ny", "pod", "line_of_business", "", "inclusion")
    assert rows(empty) == [("",)]
    df = spark.createDataFrame([("a",), ("",), (None,)], "v string")
    assert rows(rules.apply_reference_lists(df, "v", include=empty)) == [("",)]
    assert rows(rules.apply_reference_lists(df, "v", exclude=empty)) == [("a",)]


def test_market_config(spark):
    config = spark.createDataFrame(
        [("CLAIMS", "a", "NY", ""), ("CLAIMS", "b", '("UT","ACT")', ""), ("CLAIMS", "c", "CT", "SHOP"), ("CLAIMS", "d", "CT", "")],
        "domain string, sdm string, markets string, consumer string",
    )

    def value(market, consumer=""):
        return rules.config_value(rules.market_config(config, "claims", market, consumer), "sdm")

    assert value("ct") == "d"
    assert value("ct", "shop") == "c"
    assert value("ct", "other") == "d"
    assert value("act") == "b"
    assert value("nj") == ""


def test_file_names(spark):
    names = spark.createDataFrame(
        [("1,2", "NY", "NYFILE", "standard", "Y"), ("3", "CT", "CTFILE", "extended", "N"), ("4", "NJ", "NJ", "extended", "N")],
        "tenant string, target_market string, filename string, sdm_type string, eid_applied string",
    )
    assert rules.file_prefix(names, "1,2", "ny") == "NYFILE"
    assert rules.file_prefix(names, "9", "ny") == ""
    assert rules.model_type(names, "ct") == "extended"
    assert rules.enterprise_id_applied(names, "ny") == "Y"
    assert rules.markets_of(names, "extended") == ["CT", "NJ"]


def test_retention_limits(spark):
    today = date(2024, 6, 30)
    ages = [364, 365, 366, 729, 730, 731]
    data = [(a, history.cutoff(today, a)) for a in ages]
    df = spark.createDataFrame(data, "age int, LoadDate string")
    none = df.filter("false")
    kept, archived = history.apply_retention(df, none, today)
    assert rows(kept, "age") == [(364,), (365,)]
    assert rows(archived, "age") == [(366,), (729,), (730,)]
    kept, archived = history.apply_retention(none, df, today)
    assert rows(kept, "age") == []
    assert rows(archived, "age") == [(364,), (365,), (366,), (729,), (730,)]


def test_delete_where_keeps_null(spark):
    df = spark.createDataFrame([("a", "ny"), ("a", None), ("b", "ny")], "c string, m string")
    assert rows(history.delete_where(df, {"c": "a", "m": "ny"})) == [("a", None), ("b", "ny")]


def test_watermark_cycle(spark):
    schema = "file_name string, last_extract_dt timestamp_ntz, previous_last_extract_dt timestamp_ntz"
    first, second = datetime(2024, 1, 1), datetime(2024, 2, 1)
    table = spark.createDataFrame([("inscope_patient", second, None), ("lab_result", first, None)], schema)
    assert control.read_watermark(table) == second
    assert control.read_watermark(table, "nothing") is None
    moved = control.advance_watermark(table, "lab_result")
    assert rows(moved) == [("inscope_patient", second, None), ("lab_result", second, first)]
    set_to = control.advance_watermark(table, "lab_result", to=datetime(2024, 3, 1, 5), keep_previous=True)
    assert control.read_watermark(set_to, "lab_result") == datetime(2024, 3, 1, 5)


def test_detokenize(spark):
    df = spark.createDataFrame([(1, "t1", None), (2, "t2", "t1"), (3, "none", "t2")], "id int, a string, b string")
    vault = spark.createDataFrame([("t1", "one"), ("t2", "two")], "token string, value string")
    clear = detokenize(df, ["a", "b"], vault, spread_by=["id"])
    assert rows(clear) == [(1, "one", None), (2, "two", "one"), (3, None, "two")]
