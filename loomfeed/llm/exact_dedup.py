"""Exact deduplication with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..sources.staging import stage

# ASCII white space, deleted before texts are compared.
SPACE = " \t\n\x0b\x0c\r"
SALTS = 16


def _keyed(docs: DataFrame, *columns) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    body = F.translate(text, SPACE, "")
    keyed = docs.select(*columns, body.alias("body"), F.length(text).alias("points"))
    return keyed.withColumn("digest", F.sha2("body", 256))


def _grouped(docs: DataFrame, salts: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Keyed rows, a written table of digests with their best row, and the groups by text."""
    keyed = _keyed(docs, "doc_id")
    # Largest first: more code points, then the smaller id, null ids last.
    best = F.struct("points", (-F.col("doc_id")).alias("order"))
    local = keyed.withColumn("salt", F.spark_partition_id() % salts)
    salted = local.groupBy("digest", "body", "salt").agg(
        F.max(best).alias("best"), F.count("*").alias("size")
    )
    whole = salted.groupBy("digest", "body").agg(
        F.max("best").alias("best"), F.sum("size").alias("size")
    )
    # The text itself is kept only where one digest stands for several texts.
    groups = stage(
        whole.groupBy("digest").agg(
            F.count("*").alias("texts"),
            F.max("best").alias("best"),
            F.max("size").alias("size"),
        ),
        "exact-groups",
    )
    return keyed, groups, whole


def exact_groups(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """For each row its group of texts that are equal apart from ASCII white space.

    Rows of one input task that hold the same text are combined first, then what the tasks
    found is combined within salted groups, and the winners of the salts are combined last. Each
    stage groups by the whole text beside its digest, so that two texts with one digest stay
    apart. The row with most code points stays, among those the one with the smallest id.

    A null text counts as empty. A null id loses against any other; among rows with the same id
    and length each is marked kept. Columns other than ``doc_id`` and ``text`` are not read.
    An empty table gives an empty result.
    """
    keyed, groups, whole = _grouped(docs, salts)
    rows = keyed.select("doc_id", "points", "digest")
    single = rows.join(groups.where("texts = 1").drop("texts"), "digest")
    shared = groups.where("texts > 1").select("digest")
    apart = (
        keyed.join(shared, "digest", "left_semi")
        .join(whole.join(shared, "digest", "left_semi"), ["digest", "body"])
        .select(*single.columns)
    )
    # No second pass over the texts when no digest is shared, which is the rule.
    result = single if shared.isEmpty() else single.unionByName(apart)
    keep = -F.col("best.order")
    return result.select(
        "doc_id",
        keep.alias("keep_id"),
        F.col("size").cast("long").alias("group_size"),
        (F.col("doc_id").eqNullSafe(keep) & (F.col("points") == F.col("best.points"))).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def without_copies(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """The rows of ``docs``, all columns, that ``exact_groups`` keeps; of repeated rows one."""
    keyed, groups, whole = _grouped(docs, salts)
    best = (F.col("doc_id").eqNullSafe(-F.col("best.order"))) & (F.col("points") == F.col("best.points"))
    row = F.struct(*docs.columns).alias("row")
    rows = _keyed(docs, row, F.col("doc_id").alias("doc_id"))
    single = rows.drop("body").join(groups.where("texts = 1"), "digest").where(best)
    kept = single.dropDuplicates(["digest"]).select("row.*")
    shared = groups.where("texts > 1").select("digest")
    if shared.isEmpty():
        return kept
    apart = rows.join(shared, "digest", "left_semi")
    apart = apart.join(whole.join(shared, "digest", "left_semi"), ["digest", "body"]).where(best)
    return kept.unionByName(apart.dropDuplicates(["digest", "body"]).select("row.*"))
