"""Toxicity of text that may be disguised: restored by a noisy-channel decoder, then scored."""

from __future__ import annotations

import math
import re
import unicodedata
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ..sources.staging import stage
from .language import COUNTS_DDL, LanguageModel, count_grams, tables_of
from .text import distinct, gather, record, slices, starts, words

# Labelled rows of each class, at most, that the classifier is fitted on.
SAMPLE_PER_CLASS = 25_000
# Words and word beginnings, at most, that count as signs, and the documents that must hold one.
SIGNS = 20_000
SUPPORT = 3
PREFIXES = (4, 5)
# Different pairs of neighbours that a sign must have, and different ones on either side, whatever
# the number of its documents.
VARIED, VARIED_SIDE = 3, 3
# Cost in nats of reading a symbol as a letter, of dropping one, of a double letter read as one, and
# of a separator read as the end of a word.
LEET, DROP, SINGLE, SPLIT = 0.5, 12.0, 2.0, 3.0

# Letters that a symbol may stand for.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b",
    "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
    "*": "aeiou", "#": "aeiou",
}
SEPARATORS = ".-_~'`,:/\\*"
# Symbols that ordinary text has before and after words, so that they may go there.
BEFORE, AFTER = "(*#|", "!*#|"
# What may stand between single characters in a row: nothing, or the end of a word.
GAP = "\x1f"
_KEPT = r"\p{L}\p{M}\p{N}" + re.escape("".join(LOOKALIKES))
_ENDS = f"^[^{_KEPT}]+|[^{_KEPT}]+$"
_NUMBER_ENDS = r"^[^\p{N}]+|[^\p{N}]+$"
_LETTER, _SYMBOL = r"\p{L}", r"[^\p{L}\p{M}]"
# Single characters in a row that count as one spaced-out word.
SPACED = 3


class Decoder:
    """The likeliest word behind a disguised one, under a model of character trigrams.

    The lattice has a column for each run of one character: its readings are the letters it may
    stand for, once or twice, nothing if it is a symbol or separator, or the end of a word if it
    is a separator. States are the last two letters read. What is restored may be several words,
    joined by spaces.
    """

    def __init__(self, model: LanguageModel) -> None:
        self.model = model
        self.log = lru_cache(maxsize=1 << 16)(self._log)
        self.options = lru_cache(maxsize=1 << 14)(self.readings)
        self.restore = lru_cache(maxsize=1 << 17)(self._restore)

    def _log(self, a: str, b: str, c: str) -> float:
        p = self.model.chance_of(ord(a), ord(b), ord(c))
        return math.log(p)

    @staticmethod
    def readings(char: str, run: int, first: bool = False, last: bool = False) -> list[tuple[str, float]]:
        """What a run of a character may stand for, and the cost; a space is the end of a word."""
        if char == GAP:
            return [("", 0.0), (" ", SPLIT)]
        if unicodedata.category(char)[0] in "LM":
            if run == 1:
                return [(char, 0.0)]
            return [(char, SINGLE if run == 2 else 0.0), (char * 2, 0.0)]
        found = [(c, LEET + (SINGLE if run == 2 else 0.0)) for c in LOOKALIKES.get(char, "")]
        if run > 1:
            found += [(c * 2, LEET) for c in LOOKALIKES.get(char, "")]
        if (first and char in BEFORE) or (last and char in AFTER):
            return [*found, ("", 0.0)]
        if char in SEPARATORS and char != "*":
            return [*found, ("", 0.0), (" ", SPLIT)]
        return [*found, ("", DROP * min(run, 2))]

    def _restore(self, word: str) -> str:
        # (before last, last) -> (cost, letters and those before them); \0 and \1 mark the start as
        # in the model.
        log, start = self.log, ("\1", "\0")
        states: dict[tuple[str, str], tuple[float, tuple | None]] = {start: (0.0, None)}
        for match in re.finditer(r"(.)\1*", word, re.S):
            options = self.options(match[1], len(match[0]), match.start() == 0, match.end() == len(word))
            following: dict[tuple[str, str], tuple[float, tuple | None]] = {}
            for state, (cost, path) in states.items():
                for letters, own in options:
                    total, (x, y) = cost + own, state
                    if letters == " ":
                        if state == start:
                            continue
                        total -= log(x, y, "\0")
                        x, y = start
                    else:
                        for c in letters:
                            total -= log(x, y, c)
                            x, y = y, c
                    best = following.get((x, y))
                    if best is None or total < best[0]:
                        following[x, y] = (total, (letters, path) if letters else path)
            states = following
        ends = [(cost - log(a, b, "\0"), path) for (a, b), (cost, path) in states.items()]
        least = min(cost for cost, _ in ends)
        return min(_spelled(path) for cost, path in ends if cost == least)


def _spelled(path: tuple | None) -> str:
    out = []
    while path:
        letters, path = path
        out.append(letters)
    return "".join(reversed(out)).strip()


def _doubled(values: pa.Array) -> np.ndarray:
    """Whether a word holds the same character twice in a row."""
    char = np.frombuffer("".join(values.to_pylist()).encode("utf-32-le"), np.uint32)
    begin = starts(pc.utf8_length(values).to_numpy(zero_copy_only=False).astype(np.int64))
    before = starts(np.append(char[1:] == char[:-1], False))
    return before[np.maximum(begin[1:] - 1, begin[:-1])] > before[begin[:-1]]


def restored(texts: pa.Array, decoder: Decoder):
    """Distinct words after restoring, each word's place among them, and words in each text.

    Words are lower-cased and lose what stands for no letter at their ends. All that could be read
    in more than one way are decoded: those with a symbol, or a character twice in a row, beside a
    letter. Words without a letter are numbers or marks, not disguised words. Single characters in
    a row are replaced by the words they spell, the first of which takes the place of the first
    character; the others become empty. A restored word may become several.
    """
    flat, counts = words(texts)
    code, values = distinct(flat)
    core = pc.replace_substring_regex(pc.utf8_lower(values), _ENDS, "")
    has = pc.match_substring_regex(core, _LETTER)
    core = pc.if_else(has, core, pc.replace_substring_regex(core, _NUMBER_ENDS, ""))
    odd = pc.match_substring_regex(core, _SYMBOL).to_numpy(zero_copy_only=False) | _doubled(core)
    odd &= has.to_numpy(zero_copy_only=False)
    names = core
    if odd.any():
        fixed = [decoder.restore(w) for w in core.filter(pa.array(odd)).to_pylist()]
        names = pc.replace_with_mask(core, pa.array(odd), pa.array(fixed, pa.string()))
    single = (pc.utf8_length(core).to_numpy(zero_copy_only=False) == 1)[code]
    extra: list[str] = []
    if single.any():
        # Runs of single characters within one text.
        edge = np.diff(np.concatenate([[0], single, [0]]).astype(np.int8))
        begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        text_of = np.searchsorted(starts(counts), np.arange(len(code)), "right")
        code = code.astype(np.int64)
        for i, j in zip(begin.tolist(), end.tolist(), strict=True):
            for k in np.split(np.arange(i, j), np.flatnonzero(np.diff(text_of[i:j])) + 1):
                if len(k) >= SPACED:
                    chars = core.take(pa.array(code[k])).to_pylist()
                    code[k] = -1
                    code[k[0]] = len(values) + len(extra)
                    spelled = any(c.isalpha() for c in chars)
                    extra.append(decoder.restore(GAP.join(chars)) if spelled else "".join(chars))
    names = pa.concat_arrays([names, pa.array([*extra, ""], pa.string())])
    code = np.where(code < 0, len(names) - 1, code)
    parts = pc.split_pattern(names, " ")
    size = parts.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    inverse, names = distinct(parts.flatten())
    token = inverse[gather(starts(size)[:-1][code], size[code])]
    return names, token, np.diff(starts(size[code])[starts(counts)])


def features(names: pa.Array) -> list[tuple[str, np.ndarray, pa.Array]]:
    """For each kind of sign the sign of every word (empty where it has none)."""
    out = [("w", *distinct(names))]
    length = pc.utf8_length(names).to_numpy(zero_copy_only=False)
    for n in PREFIXES:
        begin = pc.if_else(pa.array(length > n), pc.utf8_slice_codeunits(names, 0, n), "")
        out.append((f"p{n}", *distinct(begin)))
    return out


@dataclass
class ToxicityModel:
    letters: LanguageModel
    signs: dict[str, dict[str, float]]  # by kind: sign and its log-odds
    slope: float = 1.0
    bias: float = 0.0

    def decoder(self) -> Decoder:
        if "_decoder" not in self.__dict__:
            self._decoder = Decoder(self.letters)
        return self._decoder

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_decoder"}

    def evidence(self, texts: pa.Array):
        """Per text the summed log-odds of its distinct signs, and the words that count."""
        names, code, counts = restored(texts, self.decoder())
        weight = np.zeros(len(names))
        for kind, place, values in features(names):
            signs = self.signs.get(kind, {})
            at = pc.index_in(values, value_set=pa.array(list(signs), pa.string()))
            at = pc.fill_null(at, -1).to_numpy(zero_copy_only=False)
            odds = np.array([*signs.values(), 0.0])
            # A word counts by its strongest sign.
            weight = np.maximum(weight, odds[at][place])
        token = np.flatnonzero(weight[code])
        doc = np.repeat(np.arange(len(counts)), counts)[token]
        pairs = np.unique(np.stack([doc, code[token]]), axis=1)
        total = np.bincount(pairs[0], weight[pairs[1]], len(counts))
        return total, pairs, names

    def score(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * evidence + self.bias, -50, 50)))


SIGN_DDL = "kind string, sign string, bad long, good long"
SIGN = pa.schema(
    [("kind", pa.string()), ("sign", pa.string()), ("bad", pa.int64()), ("good", pa.int64())]
)
CONTEXT_DDL = "kind string, sign string, before long, after long"
CONTEXT = pa.schema(
    [("kind", pa.string()), ("sign", pa.string()), ("before", pa.int64()), ("after", pa.int64())]
)


def _document_counts(shared):
    def count(batches):
        decoder = shared.value.decoder()
        for rows in slices(batches):
            names, code, counts = restored(rows["text"], decoder)
            doc = np.repeat(np.arange(len(counts)), counts)
            bad = rows["toxic"].to_numpy(zero_copy_only=False).astype(bool)
            for kind, place, values in features(names):
                pair = np.unique(doc * len(values) + place[code])
                of, sign = pair // max(1, len(values)), pair % max(1, len(values))
                n_bad = np.bincount(sign[bad[of]], minlength=len(values))
                n_good = np.bincount(sign[~bad[of]], minlength=len(values))
                # Signs of acceptable texts only would get no weight.
                some = np.flatnonzero(n_bad + n_good)
                out = {"kind": [kind] * len(some), "sign": values.take(pa.array(some))}
                yield record(out | {"bad": n_bad[some], "good": n_good[some]}, SIGN)

    return count


def _contexts(shared):
    """The neighbours of every sign in the text of toxic documents, hashed."""

    def find(batches):
        model = shared.value
        for rows in slices(batches):
            names, code, _ = restored(rows["text"], model.decoder())
            around = np.zeros(len(code) + 2, np.int64)
            hashed = pd.util.hash_array(names.to_numpy(zero_copy_only=False)).view(np.int64)
            around[1:-1] = hashed[code]
            for kind, place, values in features(names):
                known = pa.array(list(model.signs.get(kind, {})), pa.string())
                hit = pc.is_in(values, value_set=known).to_numpy(zero_copy_only=False)
                token = np.flatnonzero(hit[place][code])
                sign = values.take(pa.array(place[code[token]]))
                out = {"kind": [kind] * len(token), "sign": sign}
                out |= {"before": around[token], "after": around[token + 2]}
                yield record(out, CONTEXT)

    return find


def _evidence(shared, names: list[str]):
    schema = pa.schema([(n, pa.int64()) for n in names] + [("evidence", pa.float64())])

    def find(batches):
        for rows in slices(batches):
            total, _, _ = shared.value.evidence(rows["text"])
            yield record({n: rows[n] for n in names} | {"evidence": total}, schema)

    return find


def learn_toxicity(
    texts: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS
) -> ToxicityModel:
    """A model from all (doc_id, text) rows and the (doc_id, toxic) rows that have a label.

    The character model counts every text. Signs and the final logistic curve are fitted on
    labelled documents, at most about ``per_class`` of each class, drawn evenly from the distinct
    texts of the class; their ids and labels are what is broadcast. A sign is a word or word beginning whose log-odds between the
    classes are positive beyond chance and that stands in varied contexts, so that passages copied
    from one toxic document to others do not become signs; copies of it take none away either.
    """
    spark = texts.sparkSession
    share = spark.sparkContext.broadcast
    letters = texts.select("text", F.lit("any").alias("lang")).mapInArrow(count_grams, COUNTS_DDL)
    letters = letters.groupBy("lang", "kind", "slot").agg(F.sum("n").alias("n"))
    model = ToxicityModel(tables_of(letters.toPandas()), {})
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
    known = known.groupBy("doc_id").agg((F.max("toxic") > 0).cast("long").alias("toxic"))
    body = F.xxhash64(F.coalesce("text", F.lit(""))).alias("body")
    bodies = texts.select(F.col("doc_id").cast("long"), body)
    # Copies of a text count once in each class.
    known = bodies.join(known, "doc_id").groupBy("body", "toxic").agg(F.min("doc_id").alias("doc_id"))
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not (sizes.get(0) and sizes.get(1)):
        model.bias = math.log((sizes.get(1, 0) + 0.5) / (sizes.get(0, 0) + 0.5))
        return model
    parts = {k: min(1.0, per_class / n) for k, n in sizes.items()}
    # By the text, so that the draw is the same each time it is computed.
    draw = F.pmod(F.xxhash64("body", F.lit(1)), F.lit(1 << 30)) / (1 << 30)
    drawn = stage(known.where(draw < F.when(F.col("toxic") == 1, parts[1]).otherwise(parts[0])), "labelled")
    rows = texts.select(F.col("doc_id").cast("long"), "text", body)
    rows = rows.join(F.broadcast(drawn), ["doc_id", "body"]).dropDuplicates(["body", "toxic"])
    rows = stage(rows.select("text", "toxic"), "labelled-texts")
    shared = share(model)
    signs = rows.select("text", "toxic").mapInArrow(_document_counts(shared), SIGN_DDL)
    signs = signs.where("sign <> ''").groupBy("kind", "sign").agg(
        F.sum("bad").alias("bad"), F.sum("good").alias("good")
    )
    n = {k: sizes[k] * parts[k] for k in sizes}
    odds = F.log((F.col("bad") + 0.1) / n[1]) - F.log((F.col("good") + 0.1) / n[0])
    # The standard error of log-odds; three of them is beyond chance.
    error = F.sqrt(1 / (F.col("bad") + 0.1) + 1 / (F.col("good") + 0.1))
    signs = signs.where(F.col("bad") >= SUPPORT).withColumn("odds", odds)
    signs = signs.where((F.col("odds") > 2) & ((F.col("odds") > 3 * error) | (F.col("good") == 0)))
    found = signs.orderBy(F.desc("bad"), "kind", "sign").limit(SIGNS).toPandas()
    by_kind = lambda t: {k: dict(zip(g["sign"], g["odds"])) for k, g in t.groupby("kind")}
    model.signs = by_kind(found)
    shared = share(model)
    around = rows.where("toxic = 1").select("text").mapInArrow(_contexts(shared), CONTEXT_DDL)
    around = around.groupBy("kind", "sign").agg(
        F.countDistinct("before", "after").alias("pairs"),
        F.least(F.countDistinct("before"), F.countDistinct("after")).alias("side"),
    )
    found = found.merge(around.toPandas(), "left", ["kind", "sign"]).fillna({"pairs": 0, "side": 0})
    varied = (found["pairs"] >= VARIED) & (found["side"] >= VARIED_SIDE)
    model.signs = by_kind(found[varied])
    shared = share(model)
    points = rows.select("text", "toxic").mapInArrow(_evidence(shared, ["toxic"]), "toxic long, evidence double")
    points = points.groupBy("toxic", F.round("evidence", 1).alias("x")).agg(F.count("*").alias("n"))
    points = points.toPandas()
    weight = points["n"] / points["toxic"].map(parts)
    model.slope, model.bias = logistic(points["x"].to_numpy(), points["toxic"].to_numpy(), weight.to_numpy())
    return model


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and bias of a logistic curve, slightly drawn towards a slope of 1."""
    slope, bias = 1.0, -2.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * x + bias, -30, 30)))
        error, spread = weight * (y - p), weight * p * (1 - p) + 1e-9
        gradient = np.array([(error * x).sum() - (slope - 1), error.sum() - 0.01 * (bias + 2)])
        second = np.array([[(spread * x * x).sum() + 1, (spread * x).sum()], [(spread * x).sum(), spread.sum() + 0.01]])
        step = np.linalg.solve(second, gradient)
        step = step * min(1.0, 2.0 / max(1e-9, float(np.abs(step).max())))
        slope, bias = max(0.0, slope + step[0]), bias + step[1]
    return float(slope), float(bias)


SCORED = pa.schema(
    [("doc_id", pa.int64()), ("score", pa.float64()), ("signs", pa.list_(pa.string()))]
)
SCORED_DDL = "doc_id long, score double, signs array<string>"


def _scorer(shared):
    def score(batches):
        model = shared.value
        for rows in slices(batches):
            total, pairs, names = model.evidence(rows["text"])
            cuts = starts(np.bincount(pairs[0], minlength=len(total)))
            signs = pa.ListArray.from_arrays(
                pa.array(cuts, pa.int32()), names.take(pa.array(pairs[1]))
            )
            out = {"doc_id": rows["doc_id"], "score": model.score(total), "signs": signs}
            yield record(out, SCORED)

    return score


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """For every row the chance of a toxic label, and the restored words that speak for it.

    A null or empty text has the score of a text without signs, as has every text under a model
    learned without labels of both classes. Rows are taken as they come, repeated and null ids
    included; columns other than ``doc_id`` and ``text`` are not read. An empty table gives no
    rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_scorer(shared), SCORED_DDL)
