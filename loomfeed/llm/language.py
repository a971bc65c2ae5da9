"""Language identification of mixed text: word scores, and Viterbi over them."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .text import distinct, gather, record, slices, starts, within, words

# Slots of the hashed counts of one, two and three characters.
SLOTS = (1 << 14, 1 << 17, 1 << 19)
# Weight of the shorter context, in observations.
BACKOFF = 4.0
# Cost in nats of going from one language to another between two words.
SWITCH = 8.0
# A language uses a script if at least this share of its letters is written in it.
SCRIPT_SHARE = 0.01
UNDETERMINED = "und"
# Bytes of text handled at once.
TEXT_AT_ONCE = 2 << 20
# Labelled rows, at most, that the choice of a mixed text's main language is learned from.
CALIBRATION_ROWS = 20_000
SHARES = 20
# What a letter costs in a language that does not use its script.
FOREIGN = 20.0

# Nats for each letter by which a span must be likelier in its language than by its letters alone.
LEAST_GAIN = 0.0

# First and last code point of ranges, and a number for each script.
SCRIPTS = (
    (0x0041, 0x024F, 1),  # Latin
    (0x0370, 0x03FF, 2),  # Greek
    (0x0400, 0x052F, 3),  # Cyrillic
    (0x0530, 0x058F, 4),  # Armenian
    (0x0590, 0x05FF, 5),  # Hebrew
    (0x0600, 0x06FF, 6),  # Arabic
    (0x0750, 0x077F, 6),
    (0x0900, 0x097F, 7),  # Devanagari
    (0x0980, 0x09FF, 8),  # Bengali
    (0x0B80, 0x0BFF, 9),  # Tamil
    (0x0E00, 0x0E7F, 10),  # Thai
    (0x10A0, 0x10FF, 11),  # Georgian
    (0x1100, 0x11FF, 12),  # Hangul
    (0x1E00, 0x1EFF, 1),
    (0x1F00, 0x1FFF, 2),
    (0x3040, 0x30FF, 13),  # Kana
    (0x3400, 0x4DBF, 14),  # Han
    (0x4E00, 0x9FFF, 14),
    (0xAC00, 0xD7AF, 12),
)
N_SCRIPTS = 15  # 0: any other
_FIRST = np.array([s[0] for s in SCRIPTS])
_LAST = np.array([s[1] for s in SCRIPTS])
_SCRIPT = np.array([s[2] for s in SCRIPTS])


def script_of(points: np.ndarray) -> np.ndarray:
    place = np.searchsorted(_FIRST, points, "right") - 1
    known = (place >= 0) & (points <= _LAST[place])
    return np.where(known, _SCRIPT[place], 0)


class Grams:
    """Hashed 1-, 2- and 3-grams of words, each with one mark before and after it."""

    def __init__(self, values: pa.Array) -> None:
        self.size = pc.utf8_length(values).to_numpy(zero_copy_only=False).astype(np.int64)
        text = pc.binary_join(
            pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values), ""
        )
        raw = np.frombuffer((text[0].as_py() if len(values) else "").encode("utf-32-le"), "<u4")
        self.points = raw.astype(np.int64)
        # Letters of every word between marks; a gram ends at each letter and at the last mark.
        self.count = np.where(self.size, self.size + 1, 0)
        marked = np.zeros(int(self.size.sum()) + len(values) * 2, np.int64)
        marked[gather(starts(self.size + 2)[:-1] + 1, self.size)] = self.points
        end = gather(starts(self.size + 2)[:-1] + 1, self.count)
        place = within(self.count)
        c, b = marked[end], marked[end - 1]
        a = np.where(place > 0, marked[np.maximum(end - 2, 0)], 1)
        self.grams, self.contexts = slots_of(a, b, c)


def slots_of(a: np.ndarray, b: np.ndarray, c: np.ndarray):
    """Slots of the grams that end with ``c``, and of what stands before it: b, and a b."""
    one = (c * 0x9E3779B1) & 0xFFFFFFFF
    two = (one ^ (b * 0x85EBCA77 & 0xFFFFFFFF)) * 0xC2B2AE3D & 0xFFFFFFFF
    three = (two ^ (a * 0x27D4EB2F & 0xFFFFFFFF)) * 0x165667B1 & 0xFFFFFFFF
    own = (b * 0x9E3779B1) & 0xFFFFFFFF
    pair = (own ^ (a * 0x85EBCA77 & 0xFFFFFFFF)) * 0xC2B2AE3D & 0xFFFFFFFF
    fold = lambda x, n: (x >> 7) % SLOTS[n]
    return [fold(one, 0), fold(two, 1), fold(three, 2)], [fold(own, 0), fold(pair, 1)]


def letters(values: pa.Array) -> pa.Array:
    """Lower-cased words without anything but letters and marks on them."""
    return pc.replace_substring_regex(pc.utf8_lower(values), r"[^\p{L}\p{M}]+", "")


COUNTS_DDL = "lang string, kind int, slot int, n long"
COUNTS = pa.schema(
    [("lang", pa.string()), ("kind", pa.int32()), ("slot", pa.int32()), ("n", pa.int64())]
)
# Kinds of counts: grams by length less one, the same as contexts, letters by script.
CONTEXT, SCRIPT = 3, 5


def count_grams(batches):
    sizes = [*SLOTS, *SLOTS[:2], N_SCRIPTS]
    totals: dict[str, list[np.ndarray]] = {}
    for rows in slices(batches, limit=TEXT_AT_ONCE):
        flat, counts = words(rows["text"])
        if not len(flat):
            continue
        code, values = distinct(flat)
        grams = Grams(letters(values))
        spread = np.repeat(np.arange(len(values)), grams.count)
        letter = np.repeat(np.arange(len(values)), grams.size)
        script = script_of(grams.points)
        lang_code, langs = distinct(rows["lang"])
        lang = np.repeat(lang_code, counts)
        for i, name in enumerate(langs.to_pylist()):
            seen = np.bincount(code[lang == i], minlength=len(values))
            total = totals.setdefault(name, [np.zeros(n, np.int64) for n in sizes])
            slots = [*grams.grams, *grams.contexts]
            for kind, slot in enumerate(slots):
                total[kind] += np.bincount(slot, seen[spread], sizes[kind]).astype(np.int64)
            total[SCRIPT] += np.bincount(script, seen[letter], N_SCRIPTS).astype(np.int64)
    for name, arrays in totals.items():
        for kind, array in enumerate(arrays):
            slot = np.flatnonzero(array)
            out = {"lang": [name] * len(slot), "kind": [kind] * len(slot)}
            yield record(out | {"slot": slot, "n": array[slot]}, COUNTS)


@dataclass
class LanguageModel:
    langs: list[str]
    grams: list[np.ndarray]  # by length: languages x slots
    contexts: list[np.ndarray]
    scripts: np.ndarray  # languages x scripts: whether the language uses it
    # Chance that a language is the text's, by its share of the letters (in ``SHARES`` steps),
    # whether the text begins with it, and whether it ends with it.
    chance: np.ndarray | None = None

    def chance_of(self, a: int, b: int, c: int) -> float:
        """Probability of character ``c`` after ``a`` and ``b`` in the first language."""
        grams, contexts = slots_of(*(np.array([x], np.int64) for x in (a, b, c)))
        one, two, three = (float(t[0][g[0]]) for t, g in zip(self.grams, grams, strict=True))
        single, pair = (float(t[0][g[0]]) for t, g in zip(self.contexts, contexts, strict=True))
        p = (one + 0.1) / (self.total + 0.1 * 4096)
        p = (two + BACKOFF * p) / (single + BACKOFF)
        return (three + BACKOFF * p) / (pair + BACKOFF)

    @property
    def total(self) -> float:
        if not hasattr(self, "_total"):
            self._total = float(self.grams[0][0].sum()) if self.langs else 0.0
        return self._total

    def labelled(self, texts: pa.Array, switch: float):
        """Words' languages, texts' word counts, letters of each text in each language, the chance
        of each language to be the text's, and the share of the letters in spans that fit theirs."""
        flat, counts = words(texts)
        code, values = distinct(flat)
        docs, width = len(counts), len(self.langs)
        doc = np.repeat(np.arange(docs), counts)
        if not width or not len(values):
            none = np.zeros((docs, width))
            return np.full(len(code), width, np.int16), counts, none, none, np.zeros(docs)
        emission, size, plain = self.scores(values)
        path = label_words(emission, code, counts, switch)
        weight = np.bincount(doc * width + path, size[code], docs * width).reshape(docs, width)
        share = weight / np.maximum(weight.sum(axis=1, keepdims=True), 1)
        heads = np.flatnonzero(span_heads(path, doc))
        gain = np.add.reduceat(emission[code, path] - plain[code], heads)
        letters_ = np.add.reduceat(size[code], heads)
        fitting = np.bincount(doc[heads], letters_ * (gain > LEAST_GAIN * letters_), docs)
        fitting /= np.maximum(weight.sum(axis=1), 1)
        if self.chance is None:
            return path, counts, weight, share, fitting
        chance = self.chance[self.features(path, counts, share)] * (weight > 0)
        return path, counts, weight, chance, fitting

    def features(self, path, counts, share):
        at, lang = starts(counts), np.arange(len(self.langs))
        full = counts > 0
        first, last = np.full((2, len(counts)), -1)
        first[full], last[full] = path[at[:-1][full]], path[at[1:][full] - 1]
        step = np.minimum((share * SHARES).astype(int), SHARES - 1)
        return step, (first[:, None] == lang).astype(int), (last[:, None] == lang).astype(int)

    def scores(self, values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Natural logarithm of each word's probability in each language, its letters, and the
        logarithm of its probability by the letters' frequency alone, whatever their order.

        Only languages that use the word's script are scored; without such, all are.
        """
        grams = Grams(letters(values))
        word = np.repeat(np.arange(len(values)), grams.count)
        out = np.zeros((len(values), len(self.langs)))
        letter = np.repeat(np.arange(len(values)), grams.size)
        by = np.bincount(letter * N_SCRIPTS + script_of(grams.points), minlength=len(values) * N_SCRIPTS)
        main = by.reshape(-1, N_SCRIPTS).argmax(axis=1)
        allowed = self.scripts.T[main]
        allowed |= ~allowed.any(axis=1, keepdims=True)
        for lang in range(len(self.langs)):
            one, two, three = (g[lang] for g in self.grams)
            single, pair = (c[lang] for c in self.contexts)
            p = (one[grams.grams[0]] + 0.1) / (one.sum() + 0.1 * 4096)
            p = (two[grams.grams[1]] + BACKOFF * p) / (single[grams.contexts[0]] + BACKOFF)
            p = (three[grams.grams[2]] + BACKOFF * p) / (pair[grams.contexts[1]] + BACKOFF)
            out[:, lang] = np.bincount(word, np.log(p), len(values))
        out -= FOREIGN * grams.size[:, None] * ~allowed
        out[grams.size == 0] = 0.0
        every = self.grams[0].sum(axis=0)
        p = (every[grams.grams[0]] + 0.1) / (every.sum() + 0.1 * 4096)
        plain = np.bincount(word, np.log(p), len(values))
        return out, grams.size, plain


def tables_of(counts) -> LanguageModel:
    """A model from a pandas table of summed counts."""
    langs = sorted(counts["lang"].unique())
    tables = [np.zeros((len(langs), n)) for n in (*SLOTS, *SLOTS[:2], N_SCRIPTS)]
    for (lang, kind), part in counts.groupby(["lang", "kind"]):
        tables[kind][langs.index(lang), part["slot"]] = part["n"]
    scripts = tables[SCRIPT] >= SCRIPT_SHARE * np.maximum(tables[SCRIPT].sum(axis=1, keepdims=True), 1)
    scripts &= tables[SCRIPT] > 0
    return LanguageModel(langs, tables[:CONTEXT], tables[CONTEXT:SCRIPT], scripts)


def learn_languages(rows: DataFrame) -> LanguageModel:
    """A model of (text, lang) from every row with a language.

    The counts are summed on the executors. What reaches the driver is bounded by the number of
    languages and ``SLOTS``, whatever the number of rows.
    """
    known = rows.where("lang IS NOT NULL").select("text", "lang")
    counts = known.mapInArrow(count_grams, COUNTS_DDL)
    counts = counts.groupBy("lang", "kind", "slot").agg(F.sum("n").alias("n")).toPandas()
    model = tables_of(counts)
    if model.langs:
        model.chance = _calibrated(known, model)
    return model


CHANCES_DDL = "share int, first int, last int, own long, n long"
CHANCES = pa.schema(
    [("share", pa.int32()), ("first", pa.int32()), ("last", pa.int32()), ("own", pa.int64()), ("n", pa.int64())]
)


def _calibrated(known: DataFrame, model: LanguageModel) -> np.ndarray:
    """Chances from at most about ``CALIBRATION_ROWS`` rows, drawn evenly."""
    part = min(1.0, CALIBRATION_ROWS / max(1, known.count()))
    shared = known.sparkSession.sparkContext.broadcast(model)

    def count(batches):
        model = shared.value
        place = {name: i for i, name in enumerate(model.langs)}
        for rows in slices(batches, limit=TEXT_AT_ONCE):
            path, counts, weight, share, _ = model.labelled(rows["text"], SWITCH)
            cells = model.features(path, counts, share)
            lang = np.array([place[x] for x in rows["lang"].to_pylist()])
            own = lang[:, None] == np.arange(len(model.langs))
            key = np.stack([c[weight > 0] for c in cells])
            cell, inverse = np.unique(key, axis=1, return_inverse=True)
            n = np.bincount(inverse.ravel(), minlength=cell.shape[1])
            hits = np.bincount(inverse.ravel(), own[weight > 0], cell.shape[1]).astype(np.int64)
            out = {"share": cell[0], "first": cell[1], "last": cell[2], "own": hits, "n": n}
            yield record(out, CHANCES)

    found = known.sample(part, seed=1).mapInArrow(count, CHANCES_DDL)
    sums = found.groupBy("share", "first", "last").agg(F.sum("own").alias("own"), F.sum("n").alias("n"))
    # A cell that was hardly seen keeps the share itself as its chance.
    prior = ((np.arange(SHARES) + 0.5) / SHARES)[:, None, None]
    own, n = np.zeros((2, SHARES, 2, 2))
    for row in sums.collect():
        own[row["share"], row["first"], row["last"]] = row["own"]
        n[row["share"], row["first"], row["last"]] = row["n"]
    return (own + 4 * prior) / (n + 4)


def span_heads(path: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Whether a span of one language begins at each word."""
    change = np.ones(len(path), bool)
    change[1:] = (path[1:] != path[:-1]) | (doc[1:] != doc[:-1])
    return change


def label_words(emission: np.ndarray, code: np.ndarray, counts: np.ndarray, switch: float):
    """The best language of every word of several texts, by Viterbi side by side.

    ``emission`` has a row for each distinct word. Changing the language costs ``switch``.
    """
    order = np.argsort(-counts, kind="stable")
    counts, at = counts[order], starts(counts)[:-1][order]
    n, langs = len(code), emission.shape[1]
    stays = np.ones((n, langs), bool)
    source = np.zeros(n, np.int16)
    # Texts still running at each step are the first ones, as they are sorted by length.
    longest = int(counts[0]) if len(counts) else 0
    running = len(counts) - np.cumsum(np.bincount(counts, minlength=longest + 1))
    value = np.zeros((len(counts), langs))
    for step in range(longest):
        k = running[step]
        here = at[:k] + step
        now = value[:k]
        if step:
            best = now.argmax(axis=1)
            moved = now[np.arange(k), best] - switch
            stay = now >= moved[:, None]
            stays[here] = stay
            source[here] = best
            now = np.where(stay, now, moved[:, None])
        now = now + emission[code[here]]
        # Only differences matter; they stay small in texts of any length.
        value[:k] = now - now.max(axis=1, keepdims=True)
    label = np.zeros(n, np.int16)
    state = value.argmax(axis=1).astype(np.int16)
    for step in range(longest - 1, -1, -1):
        k = running[step]
        here = at[:k] + step
        label[here] = state[:k]
        stay = stays[here, state[:k]]
        state[:k] = np.where(stay, state[:k], source[here])
    return label


LABELLED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("lang_pred", pa.string()),
        ("score", pa.float64()),
        ("span_words", pa.list_(pa.int64())),
        ("span_langs", pa.list_(pa.string())),
        ("fitting", pa.float64()),
    ]
)
LABELLED_DDL = (
    "doc_id long, lang_pred string, score double, span_words array<long>, span_langs array<string>, "
    "fitting double"
)


def _labeller(model, switch: float):
    def label(batches):
        known = model.value
        names = np.array([*known.langs, UNDETERMINED], object)
        for rows in slices(batches, limit=TEXT_AT_ONCE):
            path, counts, weight, chance, fitting = known.labelled(rows["text"], switch)
            docs = len(counts)
            doc = np.repeat(np.arange(docs), counts)
            some = weight.sum(axis=1) > 0
            # Among languages of one chance the one with more letters.
            rank = chance + 1e-9 * weight / np.maximum(weight.sum(axis=1, keepdims=True), 1)
            best, score = np.full(docs, len(known.langs)), np.zeros(docs)
            if some.any():
                best[some], score[some] = rank[some].argmax(axis=1), chance[some].max(axis=1)
            heads = np.flatnonzero(span_heads(path, doc))
            sizes = np.diff(np.append(heads, len(path)))
            cuts = pa.array(starts(np.bincount(doc[heads], minlength=docs)), pa.int32())
            yield record(
                {
                    "doc_id": rows["doc_id"],
                    "lang_pred": names[best],
                    "score": score,
                    "span_words": pa.ListArray.from_arrays(cuts, pa.array(sizes, pa.int64())),
                    "span_langs": pa.ListArray.from_arrays(cuts, pa.array(names[path[heads]])),
                    "fitting": fitting,
                },
                LABELLED,
            )

    return label


def identify(docs: DataFrame, model: LanguageModel, switch: float = SWITCH) -> DataFrame:
    """For every row its main language, the chance that it is that, and labelled spans.

    The chance depends on the language's share of the letters and on whether the text begins and
    ends with it, as learned from labelled rows.

    ``span_words`` are the numbers of words of consecutive spans, ``span_langs`` their languages.
    A text that is null or has no letter is ``und`` with score 0, and so is every text under a
    model learned from no row. Ties go to the language first in order. Rows are taken as they
    come, repeated and null ids included; columns other than ``doc_id`` and ``text`` are not read.
    An empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(_labeller(shared, switch), LABELLED_DDL).drop("fitting")


def with_known_language(
    docs: DataFrame, model: LanguageModel, least: float = 0.5, switch: float = SWITCH
) -> DataFrame:
    """The rows of ``docs``, all columns, that a learned language or several explain.

    At least ``least`` of a text's letters must stand in spans that fit the language they are
    labelled with, that is, are likelier in it than by the frequency of their letters alone. Which
    language has how large a share does not count. Texts that are null or have no letter go. A
    missing ``lang`` is filled with the main language found.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    label = _labeller(shared, switch)

    def keep(batches):
        for batch in batches:
            keyed = batch.select(["text"]).append_column("doc_id", pa.nulls(batch.num_rows, pa.int64()))
            found = pa.Table.from_batches(label([keyed]), LABELLED)
            found = found.select(["lang_pred", "fitting"]).combine_chunks()
            names, fitting = (found[c].combine_chunks() for c in ("lang_pred", "fitting"))
            known = pc.and_(pc.not_equal(names, UNDETERMINED), pc.greater_equal(fitting, least))
            place = batch.schema.get_field_index("lang")
            if place >= 0:
                lang = pc.coalesce(batch["lang"], names.cast(batch["lang"].type))
                batch = batch.set_column(place, "lang", lang)
            yield batch.filter(known)

    return docs.mapInArrow(keep, docs.schema)
