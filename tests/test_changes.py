import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from loomfeed.functions.fingerprint import row_fingerprint
from loomfeed.operators import changes

SCHEMA = "k int, j string, v string"
KEY = ["k", "j"]


def state(spark, data):
    return row_fingerprint(spark.createDataFrame(data, SCHEMA))


OLD = [(1, "a", "same"), (2, "a", "old"), (3, "a", "gone"), (None, "n", "old"), (5, None, "same")]
NEW = [(1, "a", "same"), (2, "a", "new"), (4, "a", "added"), (None, "n", "new"), (5, None, "same")]


def test_upsert_changes_and_state(spark):
    result = changes.upsert_by_fingerprint(state(spark, OLD), state(spark, NEW), KEY)
    assert rows(result, *KEY, "v", changes.CHANGE) == sorted(
        [
            (1, "a", "same", None),
            (2, "a", "new", "update_postimage"),
            (3, "a", "gone", None),
            (4, "a", "added", "insert"),
            (None, "n", "new", "update_postimage"),
            (5, None, "same", None),
        ],
        key=str,
    )
    assert rows(changes.changed_rows(result, inserts_only=True), "k") == [(4,)]


def test_plain_keys_add_rows_with_missing_keys_every_run(spark):
    result = changes.upsert_by_fingerprint(
        state(spark, OLD), state(spark, NEW), KEY, null_safe=False
    )
    added = rows(result.filter("_change_type = 'insert'"), *KEY, "v")
    assert added == sorted([(4, "a", "added"), (None, "n", "new"), (5, None, "same")], key=str)
    assert result.count() == 8


def test_several_source_rows_for_a_key_raise(spark):
    twice = state(spark, [(1, "a", "x"), (1, "a", "y")])
    with pytest.raises(PySparkException, match="several source rows"):
        changes.upsert_by_fingerprint(state(spark, OLD), twice, KEY).collect()


def test_order_decides_between_source_rows(spark):
    twice = state(spark, [(1, "a", "x"), (1, "a", "y")])
    result = changes.upsert_by_fingerprint(
        state(spark, OLD), twice, KEY, order=[F.col("v").desc()]
    )
    assert rows(result.filter("k = 1"), "v") == [("y",)]


def test_snapshot_changes(spark):
    result = changes.snapshot_changes(state(spark, OLD), state(spark, NEW), KEY)
    assert rows(result, "k", "v", changes.CHANGE) == sorted(
        [
            (2, "old", "update_preimage"),
            (2, "new", "update_postimage"),
            (3, "gone", "delete"),
            (4, "added", "insert"),
            (None, "old", "update_preimage"),
            (None, "new", "update_postimage"),
        ],
        key=str,
    )


keyed = st.dictionaries(
    st.tuples(st.one_of(st.none(), st.integers(0, 5)), st.one_of(st.none(), st.sampled_from("ab"))),
    st.one_of(st.none(), st.sampled_from(["x", "y", ""])),
    max_size=12,
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(old=keyed, new=keyed)
def test_upsert_properties(spark, old, new):
    before = state(spark, [(*k, v) for k, v in old.items()])
    after = state(spark, [(*k, v) for k, v in new.items()])
    once = changes.upsert_by_fingerprint(before, after, KEY)
    got = {(r.k, r.j): (r.v, r[changes.CHANGE]) for r in once.collect()}
    expected = {k: (v, None) for k, v in old.items()}
    for key, value in new.items():
        if key not in old:
            expected[key] = (value, "insert")
        elif old[key] != value:
            expected[key] = (value, "update_postimage")
    assert got == expected
    again = changes.upsert_by_fingerprint(once, after, KEY)
    assert changes.changed_rows(again).count() == 0


CASES = [
    # adjust type, own change, line change, expected
    ("ORIGINAL", "insert", None, "ORIGINAL"),
    ("BACKOUT", "insert", None, "ORIGINAL"),
    ("ORIGINAL", None, "insert", "ORIGINAL"),
    ("ORIGINAL", "update_postimage", "insert", "ORIGINAL"),
    ("VOID", "update_postimage", None, "ADJUSTMENT"),
    ("VOID", None, "update_postimage", "ADJUSTMENT"),
    ("DELETE", "insert", None, "DELETE"),
    ("DELETE", "update_postimage", None, "DELETE"),
    ("DELETE", None, "insert", ""),
    ("BACKOUT", "update_postimage", None, "BACKOUT"),
    ("BACKOUT", None, "update_postimage", "BACKOUT"),
    ("VOID", None, None, ""),
    (None, "insert", "insert", ""),
]


def classified(spark):
    headers = spark.createDataFrame(
        [("s", 1, str(i), a, "", own) for i, (a, own, _, _) in enumerate(CASES)]
        + [("s", 1, "held", "VOID", "DELETE", "insert")],
        "SOURCE_SYSTEM_SK string, TENANT_SK int, CLAIM_NUMBER string, CLAIM_ADJUST_TYPE string, "
        "UPDATE_TYPE string, _change_type string",
    )
    lines = spark.createDataFrame(
        [("s", 1, str(i), line) for i, (_, _, line, _) in enumerate(CASES) if line]
        + [("s", 1, "0", "update_postimage"), ("other", 1, "11", "insert")],
        "SOURCE_SYSTEM_SK string, TENANT_SK int, CLAIM_NUMBER string, _change_type string",
    )
    return changes.classify_changes(headers, lines)


def test_classification(spark):
    got = dict(rows(classified(spark), "CLAIM_NUMBER", "UPDATE_TYPE"))
    assert got.pop("held") == "DELETE"
    assert got == {str(i): case[3] for i, case in enumerate(CASES)}


def test_published_and_reset(spark):
    headers = classified(spark)
    claims = spark.createDataFrame([("0",), ("4",), ("4",), ("6",)], "CLAIM_NUMBER string")
    sent, recorded = changes.select_published(headers, claims, "Hist")
    assert rows(sent, "CLAIM_NUMBER") == [("0",), ("4",)]
    assert rows(recorded, "CLAIM_NUMBER") == [("0",), ("4",), ("6",), ("7",), ("held",)]
    sent, recorded = changes.select_published(headers, claims, "Delta")
    assert rows(sent, "CLAIM_NUMBER") == rows(recorded, "CLAIM_NUMBER")
    assert {r[0] for r in rows(changes.reset_published(headers), "UPDATE_TYPE")} == {""}
