"""The operators on the benchmark tables, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import tune
from .exact_dedup import exact_groups
from .language import identify, learn_languages
from .mixing import learn_mixing, score_mixing
from .packing import pack_documents
from .periodic import find_runs
from .phrases import phrase_collocations
from .sentencepiece import decode_pieces, encode_pieces
from .ship import ship
from .simhash import simhash_groups
from .spherical import vector_groups
from .substring import remove_repeats
from .suffixes import remove_repeated_strings
from .token_planes import read_documents, write_tokens
from .toxicity import learn_toxicity, score_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable:
    QUERIES[function.__name__] = lambda spark, folder: function(ship(tune(spark)), folder)
    return function


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def remainder(n: int):
    """The checksum of the id as text, modulo ``n``; an id that is null counts as empty."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % n


@query
def op1_language_id(spark, folder):
    docs = _table(spark, folder, "documents")
    model = learn_languages(docs.where(remainder(4) != 2).select("text", "lang"))
    found = identify(docs, model)
    return found.select("doc_id", (remainder(4) == 2).alias("held_out"), "lang_pred", "score")


@query
def op6_exact_dedup(spark, folder):
    return exact_groups(_table(spark, folder, "documents"))


SQL["op6_exact_dedup"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body
  FROM documents
), w AS (
  SELECT doc_id, body,
         first_value(doc_id) OVER (PARTITION BY body ORDER BY length(t) DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY body) AS group_size
  FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM w
"""


@query
def op2_simhash(spark, folder):
    groups = simhash_groups(_table(spark, folder, "documents"))
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return groups.select("doc_id", hexed.alias("fingerprint"), "component_id")


@query
def op7_token_planes(spark, folder):
    path = public_tokenizers.path("byte_bpe_50k.json")
    return read_documents(spark, write_tokens(_table(spark, folder, "documents"), path, end=2))


@query
def op8_packing(spark, folder):
    path = public_tokenizers.path("word_bpe_49k.json")
    pieces = pack_documents(_table(spark, folder, "documents"), path, end=1)
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
        "window",
        "step_group",
    )


@query
def op9_substring(spark, folder):
    return remove_repeats(_table(spark, folder, "documents"), digest=True)


@query
def op10_spherical_caps(spark, folder):
    return vector_groups(_table(spark, folder, "embeddings"))


@query
def op4_toxicity(spark, folder):
    docs = _table(spark, folder, "documents")
    labels = _table(spark, folder, "labels").where(remainder(3) != 1)
    model = learn_toxicity(docs.where(remainder(3) != 1), labels)
    scored = score_toxicity(docs, model)
    return scored.select(
        "doc_id",
        (remainder(3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


@query
def op5_sentencepiece(spark, folder):
    path = public_tokenizers.path("piece_bpe_32k.model")
    encoded = encode_pieces(_table(spark, folder, "documents"), path)
    return decode_pieces(encoded, path).select(
        "doc_id",
        "n_ids",
        F.crc32("ids").alias("ids_crc32"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


@query
def op3_context_mixing(spark, folder):
    docs = _table(spark, folder, "documents")
    model, vocabulary = learn_mixing(docs.where(remainder(5) != 1), kind="lang")
    scored = score_mixing(docs, model, vocabulary)
    return scored.withColumn("held_out", remainder(5) == 1)


@query
def op11_induced_suffixes(spark, folder):
    found = remove_repeated_strings(_table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        (F.size("spans") / 2).cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op12_stripes(spark, folder):
    return phrase_collocations(_table(spark, folder, "documents"))


# Phrases of up to four words as joined text; sums and products in 128 bits.
SQL["op12_stripes"] = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') AS w FROM p
), total AS (
  SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang
), k AS (SELECT unnest([1, 2, 3, 4]) AS k
), o AS (
  SELECT lang, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM w, k WHERE len(w) >= k
), f AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
  FROM o GROUP BY ALL HAVING count(*) >= 30
), c AS (
  SELECT lang, k, phrase, string_split(phrase, ' ') AS w, f AS a FROM f WHERE k > 1
), inner_part AS (
  SELECT lang, a, unnest(list_distinct(flatten(list_transform(range(2, k), lambda m:
           list_transform(range(1, k - m + 2), lambda s: array_to_string(w[s:s + m - 1], ' ')))))) AS phrase
  FROM c WHERE k > 2
), longer AS (
  SELECT lang, phrase, max(a) AS most FROM inner_part GROUP BY ALL
), kept AS (
  SELECT c.* FROM c LEFT JOIN longer USING (lang, phrase)
  WHERE most IS NULL OR 100::HUGEINT * most < 80::HUGEINT * a
), cut AS (
  SELECT lang, phrase, a, j, array_to_string(w[1:j], ' ') AS x, array_to_string(w[j + 1:], ' ') AS y
  FROM (SELECT *, unnest(range(1, k)) AS j FROM kept)
), s AS (
  SELECT c.lang, c.phrase, a, j, x.f AS l, y.f AS r,
         (2000000::HUGEINT * a // (x.f::HUGEINT + y.f))::BIGINT AS score
  FROM cut c JOIN f x ON x.lang = c.lang AND x.phrase = c.x JOIN f y ON y.lang = c.lang AND y.phrase = c.y
), low AS (
  SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score
FROM low JOIN total USING (lang) QUALIFY rank <= 2000
"""


@query
def op13_difference_cover(spark, folder):
    docs = _table(spark, folder, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = find_runs(docs.withColumn("text", _periodic_text()))
    best = F.expr(
        "aggregate(runs, cast(null as struct<start:long,length:long,period:long>), (b, r) -> "
        "if(b is null or r.length * b.period > b.length * r.period, r, b))"
    )
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    found = found.withColumn("best", best)
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("kept_text", 256).alias("collapsed_sha256"),
    )


def _periodic_text():
    """The text; of ids whose checksum ends in 0 the words from one place on repeat with a period."""
    checksum = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return F.when(checksum % 10 == 0, F.expr(r"""
        transform(array(named_struct(
            'w', regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+', 0),
            'g', crc32(cast(cast(doc_id as string) as binary)) div 10)), x ->
          if(size(x.w) = 0, '', transform(array(cast(x.g % size(x.w) as int)), a ->
            transform(array(cast(1 + (size(x.w) - a) div (3 + x.g % 8) as int)), p ->
              array_join(transform(x.w, (v, i) -> if(i < a, v, x.w[a + (i - a) % p])), ' '))[0])[0]))[0]
    """)).otherwise(F.col("text"))
