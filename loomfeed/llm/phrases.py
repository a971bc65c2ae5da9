"""Phrase collocations by stripes: each prefix keys a counter of the words that follow it.

The stripe of the empty prefix counts words, that of a word the words after it, and so on up to
prefixes of one word less than the longest phrase. A slice of texts fills its stripes and sends
every bucket the part it has to merge, element by element. Phrases, the totals that score them and
the largest extensions that may subsume them are all read off the merged stripes.

A phrase is no more frequent than any phrase inside it, so words and phrases that occur too rarely
are left out of longer stripes. A bitmap of bounded size tells them, which may let some pass and
loses none; the counts themselves are by text.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from ..sources.staging import stage
from .cells import runs
from .substring import packed, unpacked
from .text import BASES, STEP, distinct, gather, mixed, record, slices, starts, window_hashes, word_hashes

# What ends a piece, and what stands between words.
BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
BLANKS = b" \t"
LONGEST = 4
LEAST = 30
TOP = 2000
# A longer phrase with this share (in percent) of a phrase's occurrences subsumes it.
SUBSUMES = 80
# The scale of scores.
SCALE = 2_000_000
# Bits of the bitmap for each frequent phrase, and its least and greatest size as powers of two.
BITS_EACH = 16
BITMAP = (16, 27)
SLICE = 4 << 20
# Buckets for each shuffle partition, at least.
BUCKETS = 2

_BREAK = np.isin(np.arange(256), list(BREAKS))
_INSIDE = ~_BREAK & ~np.isin(np.arange(256), list(BLANKS))


def pieces(texts: pa.Array) -> tuple[pa.StringArray, np.ndarray, np.ndarray]:
    """All words in lower case (A-Z), the text of each, and its piece, numbered through all texts."""
    texts = pc.ascii_lower(texts)
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    ends = ends.astype(np.int64) - ends[0]
    if not ends[-1]:
        return pa.array([], pa.string()), np.empty(0, np.int64), np.empty(0, np.int64)
    begin = int(np.frombuffer(texts.buffers()[1], np.int32)[texts.offset])
    data = np.frombuffer(texts.buffers()[2], np.uint8)[begin : begin + int(ends[-1])]
    inside = _INSIDE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = ends[:-1][ends[:-1] < len(data)]
    first[edges] = inside[edges]
    places = np.flatnonzero(first)
    text = np.searchsorted(ends, places, "right") - 1
    piece = np.cumsum(_BREAK[data])[places] + text
    # Bytes of words, without all that stands between them.
    sizes = np.add.reduceat(inside, places, dtype=np.int64) if len(places) else np.empty(0, np.int64)
    offsets = pa.py_buffer(starts(sizes).astype(np.int32))
    flat = pa.StringArray.from_buffers(len(places), offsets, pa.py_buffer(data[inside]))
    return flat, text, piece


def _coded(rows: pa.RecordBatch):
    """Distinct words and languages; for each word their codes and its piece."""
    flat, text, piece = pieces(rows["text"])
    word, vocabulary = distinct(flat)
    lang, languages = distinct(rows["lang"])
    return word.astype(np.int64), vocabulary, lang.astype(np.int64)[text], languages, piece


def _hashes(lang: np.ndarray, words: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` words from each place on, and their language."""
    joined = window_hashes(words, size)
    return mixed(lang[: len(joined)] * STEP + joined)


def _passes(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    one, two = _bits(hashes, len(bitmap) * 64)
    test = lambda b: (bitmap[b >> np.uint64(6)] >> (b & np.uint64(63))) & np.uint64(1)
    return (test(one) & test(two)).astype(bool)


def _bits(hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    low = np.uint64(size - 1)
    return hashes & low, (hashes >> np.uint64(32)) & low


# What a slice of texts sends to a bucket: its stripes as lines, in each the number of a language, a
# prefix and the words after it, and a count for each such word.
SENT = pa.schema(
    [("bucket", pa.int32()), ("langs", pa.list_(pa.string())), ("stripes", pa.string()), ("counts", pa.binary())]
)
SENT_DDL = "bucket int, langs array<string>, stripes string, counts binary"


def _stripes(known, size: int, bits: int):
    """Stripes of the prefixes of ``size`` words that pass a bitmap with their last words and the next.

    An element goes to a bucket by a hash of its prefix and its word, so that a frequent prefix is
    spread over all buckets; each gets a part of the stripe.
    """

    def run(batches):
        for rows in slices(batches, limit=SLICE):
            word, vocabulary, lang, languages, piece = _coded(rows)
            if len(word) <= size:
                continue
            spoken, values = word_hashes(languages, BASES[0])[lang], word_hashes(vocabulary, BASES[0])[word]
            place = np.arange(len(word))
            if size:
                passing = _passes(known.value, _hashes(spoken, values, size))
                place = np.flatnonzero(passing[:-1] & passing[1:] & (piece[:-size] == piece[size:]))
            if len(place):
                hashes = _hashes(spoken, values, size + 1)
                yield _filled(place, hashes, size, bits, word, vocabulary, lang, languages)

    return run


def _filled(place, hashes, size, bits, word, vocabulary, lang, languages) -> pa.RecordBatch:
    # Prefixes as numbers, one word after the other; then their elements.
    prefix, heads = np.unique(lang[place], return_inverse=True)[1], None
    for shift in range(size):
        prefix = np.unique(prefix * len(vocabulary) + word[place + shift], return_inverse=True)[1]
    key, heads, n = np.unique(prefix * len(vocabulary) + word[place + size], return_index=True, return_counts=True)
    first = place[heads]
    bucket = (hashes[first] >> np.uint64(64 - bits)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    first, n, bucket, prefix = first[order], n[order], bucket[order], key[order] // len(vocabulary)
    send = np.concatenate([[True], bucket[1:] != bucket[:-1]])
    stripe = send | np.concatenate([[True], prefix[1:] != prefix[:-1]])
    # Each stripe as its prefix and its words, all taken from one array.
    lead = np.flatnonzero(stripe)
    parts = [vocabulary.take(pa.array(word[first[lead] + shift])) for shift in range(size)]
    named = pc.binary_join_element_wise(*parts, " ") if size else pa.array([""] * len(lead), pa.string())
    spoken = pa.array(lang[first[lead]]).cast(pa.string())
    named = pc.binary_join_element_wise(spoken, named, "\t")
    pool = pa.concat_arrays([vocabulary, named])
    at = np.insert(word[first + size], lead, len(vocabulary) + np.arange(len(lead)))
    cuts = pa.array(np.append(lead + np.arange(len(lead)), len(at)), pa.int32())
    lines = pc.binary_join(pa.ListArray.from_arrays(cuts, pool.take(pa.array(at))), "\t")
    begin = np.flatnonzero(send)
    ends = np.append(begin, len(first))
    cuts = pa.array(np.append(np.searchsorted(lead, begin), len(lead)), pa.int32())
    out = {
        "bucket": bucket[begin],
        "langs": [languages.to_pylist()] * len(begin),
        "stripes": pc.binary_join(pa.ListArray.from_arrays(cuts, lines), "\n"),
        "counts": [packed(n[i:j].astype(np.uint32)) for i, j in zip(ends[:-1], ends[1:], strict=True)],
    }
    return record(out, SENT)


# An element of the merged stripes. Under the empty prefix and word: all words of a bucket.
ELEMENT = pa.schema(
    [("lang", pa.string()), ("size", pa.int32()), ("phrase", pa.string()), ("f", pa.int64())]
)
ELEMENT_DDL = "lang string, size int, phrase string, f long"


def _merge(size: int, least: int):
    """Sums of the elements of each bucket; those of ``least`` and more."""

    def run(batches):
        for table, begins in runs(batches, ["bucket"]):
            for begin, end in zip(begins[:-1], begins[1:], strict=True):
                part = table.slice(begin, end - begin)
                lines = pc.split_pattern(part["stripes"], "\n")
                lang, languages = distinct(part["langs"].flatten())
                known = starts(pc.list_value_length(part["langs"]).to_numpy(zero_copy_only=False))[:-1]
                known = np.repeat(known, pc.list_value_length(lines).to_numpy(zero_copy_only=False))
                lists = pc.split_pattern(lines.flatten(), "\t")
                sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64) - 2
                flat, at = lists.flatten(), starts(sizes + 2)[:-1]
                lang = lang[known + flat.take(pa.array(at)).cast(pa.int64()).to_numpy()]
                prefix = np.repeat(at + 1, sizes)
                words = gather(at + 2, sizes)
                phrases = flat.take(pa.array(words))
                if size:
                    phrases = pc.binary_join_element_wise(flat.take(pa.array(prefix)), phrases, " ")
                code, named = distinct(phrases)
                n = np.concatenate([unpacked(c, np.uint32)[0] for c in part["counts"].to_pylist()])
                key = np.repeat(lang, sizes).astype(np.int64) * len(named) + code
                order = np.argsort(key, kind="stable")
                heads = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1]]))
                sums, key = np.add.reduceat(n[order], heads, dtype=np.int64), key[order][heads]
                full = sums >= least
                out = [key[full] // len(named), named.take(pa.array(key[full] % len(named))), sums[full]]
                if not size:
                    whole = np.bincount(key // len(named), sums, minlength=len(languages)).astype(np.int64)
                    out[0] = np.append(out[0], np.arange(len(whole)))
                    out[1] = pa.concat_arrays([out[1], pa.array([""] * len(whole))])
                    out[2] = np.append(out[2], whole)
                rows = {"lang": languages.take(pa.array(out[0])), "size": np.full(len(out[0]), size + 1)}
                yield record(rows | {"phrase": out[1], "f": out[2]}, ELEMENT)

    return run


def _slots(size: int, bits: int):
    def run(batches):
        for rows in batches:
            if rows.num_rows:
                flat, counts = _split(rows["phrase"])
                spoken = word_hashes(rows["lang"], BASES[0])
                hashes = word_hashes(flat, BASES[0])
                lang = np.repeat(spoken, counts)
                found = _hashes(lang, hashes, size)[starts(counts)[:-1]]
                slots = np.unique(np.concatenate(_bits(found, bits)))
                yield pa.record_batch({"slot": pa.array(slots.astype(np.int64))})

    return run


def _split(phrases: pa.Array) -> tuple[pa.Array, np.ndarray]:
    lists = pc.split_pattern(phrases, " ")
    return lists.flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)


def bitmap(phrases: DataFrame, size: int) -> np.ndarray:
    """A bitmap that every row (``lang``, ``phrase`` of ``size`` words) passes; 2**27 bits at most.

    Beyond some eight million phrases it grows no more and lets more others pass, which costs work
    and changes no count.
    """
    n = phrases.count()
    bits = 1 << min(max((BITS_EACH * n - 1).bit_length(), BITMAP[0]), BITMAP[1])
    slots = phrases.select("lang", "phrase").mapInArrow(_slots(size, bits), "slot long")
    place = F.shiftright("slot", 6)
    value = F.expr("shiftleft(1L, cast(slot & 63 as int))")
    words = slots.groupBy(place.alias("place")).agg(F.bit_or(value).alias("word")).toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[words["place"].to_numpy()] = words["word"].to_numpy().view(np.uint64)
    return out


def phrase_collocations(
    docs: DataFrame,
    least: int = LEAST,
    top: int = TOP,
    subsumes: int = SUBSUMES,
    scale: int = SCALE,
    longest: int = LONGEST,
) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``: each language's best phrases.

    Texts in lower case (A-Z) are cut into pieces at ``.,;:!?`` and line ends, pieces into words at
    blanks and tabs. A candidate is a phrase of two to ``longest`` words that occurs ``least`` times
    (``a``, overlaps included) in the texts of one ``lang``. Cut after some words, its parts occur
    ``l`` and ``r`` times and score ``scale * a // (l + r)``; its lowest score counts, the earliest
    cut among equal ones. It goes if a longer candidate that contains it occurs ``subsumes``
    percent as often or more. ``n`` counts the words of the language; the ``top`` phrases by score,
    then ``a``, both descending, then phrase (by bytes) stay. Numbers are exact.

    A null ``lang`` counts as ``und``, a null text as empty; repeated rows count each. Ids and other
    columns are not read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bits = max(1, (BUCKETS * parts - 1).bit_length())
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")

    def merged(size, known):
        sent = texts.mapInArrow(_stripes(known, size, bits), SENT_DDL)
        met = sent.repartition(parts, "bucket").sortWithinPartitions("bucket")
        return stage(met.mapInArrow(_merge(size, least), ELEMENT_DDL), f"stripes-{size}")

    first = merged(0, None)
    n = first.where("phrase = ''").groupBy("lang").agg(F.sum("f").alias("n"))
    found = [first.where("phrase != ''")]
    for size in range(1, longest):
        known = spark.sparkContext.broadcast(bitmap(found[-1], size))
        found.append(merged(size, known))
    return _best(functools.reduce(DataFrame.unionByName, found), n, top, subsumes, scale)


def _best(elements: DataFrame, n: DataFrame, top: int, subsumes: int, scale: int) -> DataFrame:
    """The best phrases, from the elements of all stripes: ``lang``, ``size``, ``phrase``, ``f``.

    An element is at once an extension of its prefix and, as a prefix, the total of its own stripe.
    """
    total = F.max(F.when(F.col("own"), F.col("f"))).alias("total")
    longer = F.max(F.when(~F.col("own"), F.col("f"))).alias("longer")
    # A phrase of several words is the best extension, to the right or to the left, of its parts. A
    # phrase of two words more than another holds one of one word more that is no rarer.
    rows = F.array(
        F.struct(F.col("phrase"), F.lit(True).alias("own")),
        F.struct(F.expr("substring_index(phrase, ' ', size - 1)").alias("phrase"), F.lit(False).alias("own")),
        F.struct(F.expr("substring_index(phrase, ' ', 1 - size)").alias("phrase"), F.lit(False).alias("own")),
    )
    each = elements.select("lang", "f", F.inline(F.when(F.col("size") > 1, rows).otherwise(F.slice(rows, 1, 1))))
    totals = stage(each.groupBy("lang", "phrase").agg(total, longer), "stripe-totals")
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    phrases = totals.withColumn("size", F.expr("size(split(phrase, ' '))"))
    subsumed = wide("longer") * 100 >= wide("total") * subsumes
    kept = phrases.where((F.col("size") > 1) & ~F.coalesce(subsumed, F.lit(False)))
    kept = kept.select("lang", "phrase", "size", F.col("total").alias("a"))
    cut = kept.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cut = cut.withColumn("left", F.expr("substring_index(phrase, ' ', k)"))
    cut = cut.withColumn("right", F.expr("substring_index(phrase, ' ', k - size)"))
    part = lambda side, name: totals.select("lang", F.col("phrase").alias(side), F.col("total").alias(name))
    cut = cut.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"])
    cut = cut.withColumn("whole", wide("a") * F.lit(scale).cast("decimal(10,0)"))
    cut = cut.withColumn("parts", wide("l") + wide("r"))
    scored = cut.withColumn("score", F.expr("whole div parts"))
    lowest = F.min(F.struct("score", "k", "l", "r")).alias("low")
    scored = scored.groupBy("lang", "phrase").agg(F.max("a").alias("a"), lowest)
    scored = scored.select("lang", "phrase", "a", "low.l", "low.r", "low.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    ranked = ranked.withColumn("rank", F.col("rank").cast("long")).join(n, "lang")
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
