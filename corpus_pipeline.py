"""Cleaning and packing of a text corpus in stages; each works on all that the one before kept.

``documents`` go in. Texts without a language go, then copies, then all but one of each group of
near copies, then passages that also stand earlier; what is left is packed into training windows.
Clean documents pass all stages. The stages' results are written and read again between them.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from loomfeed.llm.exact_dedup import without_copies
from loomfeed.llm.language import learn_languages, with_known_language
from loomfeed.llm.packing import pack_documents
from loomfeed.llm.ship import ship
from loomfeed.llm.simhash import without_near_copies
from loomfeed.llm.substring import without_repeats
from loomfeed.session import tune
from loomfeed.sources.staging import stage


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; the model is learned from those that name theirs."""
    ship(tune(spark))
    return with_known_language(docs, learn_languages(docs.select("text", "lang")))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal apart from white space the longest row."""
    ship(tune(spark))
    return without_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints of three-word shingles are linked within three bits the smallest id."""
    ship(tune(spark))
    return without_near_copies(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that also stand earlier, and their new length."""
    ship(tune(spark))
    left = without_repeats(docs)
    return left.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in left.columns else left


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, in training windows."""
    ship(tune(spark))
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end=1)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("exact", exact),
    ("near", near),
    ("passages", passages),
    ("pack", pack),
]

# Fingerprints, token ids and the language model are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
