from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from loomfeed.functions import codes, dates, text
from loomfeed.functions.fingerprint import row_fingerprint


def one(spark, value, dtype, rule):
    df = spark.createDataFrame([(value,)], f"v {dtype}")
    return df.select(rule(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize(
    ("value", "expected"),
    [("-1", "0"), ("NS", "0"), ("NF", "0"), (None, "0"), ("", ""), (" ab ", "ab"), ("x" * 30, "x" * 24)],
)
def test_provider_sentinels(spark, value, expected):
    assert one(spark, value, "string", lambda c: codes.sentinel_default(c, max_length=24)) == expected


@pytest.mark.parametrize(
    ("value", "expected"),
    [(None, None), ("UNK", "UNK"), ("7", "0007"), ("", "000"), ("12345", "2345"), ("0450", "0450")],
)
def test_pad_code(spark, value, expected):
    assert one(spark, value, "string", codes.pad_code) == expected


@pytest.mark.parametrize(
    ("value", "expected"), [("1", "Y"), (" 1 ", "Y"), ("1.0", "Y"), ("abc", "N"), (None, "N"), ("2", "N")]
)
def test_one_flag(spark, value, expected):
    assert one(spark, value, "string", codes.one_flag) == expected


EARLY = [
    (datetime(1111, 1, 8), datetime(1900, 1, 1), None),
    (datetime(1899, 12, 31), datetime(1900, 1, 1), None),
    (datetime(1900, 1, 1), datetime(1900, 1, 1), datetime(1900, 1, 1)),
    (datetime(8888, 12, 31), datetime(8888, 12, 31), datetime(8888, 12, 31)),
    (None, None, None),
]


@pytest.mark.parametrize(("value", "clamped", "nulled"), EARLY)
def test_floor_date(spark, value, clamped, nulled):
    assert one(spark, value, "timestamp_ntz", dates.floor_date) == clamped
    assert one(spark, value, "timestamp_ntz", lambda c: dates.floor_date(c, "null")) == nulled


def test_floor_date_mode():
    with pytest.raises(ValueError):
        dates.floor_date("d", "other")


@pytest.mark.parametrize(
    ("value", "open_ended", "kept"),
    [
        (datetime(2023, 5, 1), False, True),
        (datetime(2023, 4, 30, 23, 59), False, False),
        (None, True, True),
        (None, False, False),
    ],
)
def test_lookback_counts_from_the_month_start(spark, value, open_ended, kept):
    df = spark.createDataFrame([(value,)], "v timestamp_ntz")
    condition = dates.within_lookback("v", 3, date(2023, 8, 17), open_ended)
    assert (df.filter(condition).count() == 1) is kept


def test_default_start():
    assert dates.default_start(date(2024, 6, 10)) == datetime(2021, 3, 1)
    assert dates.default_start(date(2024, 3, 31)) == datetime(2020, 12, 1)


def test_lookback_as_of():
    today = date(2024, 3, 5)
    assert dates.lookback_as_of(None, today) == today
    assert dates.lookback_as_of(date(2024, 3, 1), today) == today
    assert dates.lookback_as_of(date(2024, 2, 28), today) == date(2024, 2, 28)
    assert dates.lookback_as_of(date(2023, 3, 5), today) == date(2023, 3, 5)


@pytest.mark.parametrize(
    ("value", "valid"),
    [("2024-02-29", True), ("2023-02-29", False), ("2024-1-5", True), ("05/01/2024", False), (None, False)],
)
def test_valid_date(spark, value, valid):
    assert one(spark, value, "string", dates.valid_date) is valid


@pytest.mark.parametrize(
    ("value", "file", "history"),
    [
        ("  a b  ", "a b", "a b"),
        ("a\tb", "a\tb", "ab"),
        ("a\t b", "ab", "a b"),
        ("\ta", "a", "a"),
        ("a\n", "a", "a"),
        ("a \t \t b", "a b", "a   b"),
        ("a\t\t\tb\t\t c", "a\t\t\tb" + "c", "ab c"),
        (None, None, None),
    ],
)
def test_both_strip_patterns(spark, value, file, history):
    df = spark.createDataFrame([(1, value)], "k int, v string")
    assert text.clean_strings(df).first() == (1, file)
    assert text.clean_strings(df, text.HISTORY).first() == (1, history)


def test_strip_nonprintable(spark):
    assert one(spark, "a|b\u0007cé퟿￿z", "string", text.strip_nonprintable) == "abc퟿z"


@pytest.mark.parametrize(("value", "expected"), [('a"b', '"a\\"b"'), ("a|b", "a|b"), (None, None)])
def test_quote_if_needed(spark, value, expected):
    assert one(spark, value, "string", text.quote_if_needed) == expected


def test_fingerprint_separates_columns_and_nulls(spark):
    values = [(None, "a"), ("a", None), ("a|1:b", "c"), ("a", "1:b|c"), ("", None), (None, "")]
    df = spark.createDataFrame(values, "x string, y string")
    assert row_fingerprint(df).select("HASH").distinct().count() == len(values)


def test_fingerprint_excludes_by_name(spark):
    df = spark.createDataFrame([(1, "a", "old"), (2, "a", "new")], "sk int, v string, HASH string")
    assert row_fingerprint(df, exclude=["SK"]).select("HASH").distinct().count() == 1


def test_original_number_uses_raw_adjust_type(spark):
    data = [("610", "1", "VOID"), ("5", "1", "VOID"), ("5", "1", "ORIGINAL"), ("5", "1", None), (None, "1", "VOID")]
    df = spark.createDataFrame(data, "s string, n string, a string")
    got = [r[0] for r in df.select(codes.original_claim_number("s", "n", "a")).collect()]
    assert got == ["1", "5-1", "", "", ""]


def test_diagnosis_slots(spark):
    df = spark.createDataFrame(
        [(None, "Y", " b ", None)],
        "icd_diag_cd_1 string, diag_code_1_poa string, icd_diag_cd_2 string, diag_code_2_poa string",
    )
    assert rows(df.select(*codes.diagnosis_slots(2))) == [(None, None, "b", "N")]
    assert rows(df.select(*codes.diagnosis_slots(2, first_default="UNK"))) == [("UNK", None, "b", "N")]
