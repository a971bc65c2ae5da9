import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", ".."))

from loomfeed.llm.ship import ship  # noqa: E402

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def llm(spark):
    return ship(spark)


# Rows that every operator must take: nulls in any column, empty and blank texts, repeated rows,
# one id with two texts, a very long text, symbols of several scripts.
HARD = [
    (1, "the cat sat on the mat and the dog ate the hat", "en", "a"),
    (2, None, "en", None),
    (3, "", None, "b"),
    (4, " \t\n ", "de", "b"),
    (5, "the cat sat on the mat and the dog ate the hat", "en", "a"),
    (5, "the cat sat on the mat and the dog ate the hat", "en", "a"),
    (6, "eins", "de", "c"),
    (6, "zwei worte", "de", "c"),
    (7, "12 34 --- !!", "en", "c"),
    (8, "über straße éclair мир 日本語 \x00 ́ <|endoftext|> ▁", "fr", "c"),
    (9, " ".join(f"w{i % 97}x{i % 89}" for i in range(30000)), "en", "a"),
    (None, "no id at all", None, None),
    (None, None, None, None),
    (10, "same same same same same same same same " * 12, "en", "a"),
]
EXTRA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="session")
def hard(llm):
    """The rows above, with extra columns whose names operators use themselves."""
    df = llm.createDataFrame(HARD, EXTRA).repartition(3)
    names = ("score", "ids", "digest", "fp", "spans", "kept", "unit", "bucket", "okey", "th", "row", "body")
    from pyspark.sql import functions as F

    return df.withColumns({n: F.lit(1) for n in names})


@pytest.fixture(scope="session")
def empty(hard):
    return hard.where("1 = 0")


@pytest.fixture(scope="session")
def documents(llm):
    return llm.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "lang")
