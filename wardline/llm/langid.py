"""Language identification with interpolated Kneser-Ney character models.

One model per language over the letters of words: a word is ``^word$`` in lower case without
surrounding marks, contexts do not cross words, so a word's log-probability is computed once per task
and a text's is the sum over its words. Each order's n-grams are kept in one sorted array of hashes
with a column per language. A text goes to the language of the lowest cross-entropy per character.

Rejection is calibrated on training rows that the models did not see: the cross-entropy of a text
of the right language scatters with variance a + b / length; a text whose lowest cross-entropy lies
``tolerance`` such deviations above the language's mean is rejected, and so is a text without letters.

Training reads a bounded sample: at most ``rows_per_language`` labelled rows per language, whole
texts, and of these as many (in seeded order) as fit ``chars_per_language``, at least one.

Defined results: null text and text without any letter give ``und``, score 0, rejected; without any
training rows all texts do; rows that repeat are predicted each; ties go to the language that is
first by code point; further columns are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from dataclasses import dataclass
from itertools import islice

import numpy as np
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.common import few_rows, per_text, sole_cache

LETTER = regex.compile(r"\p{L}")
SIDE = regex.compile(r"^[^\p{L}\p{M}]+|[^\p{L}\p{M}]+$")
CACHE_WORDS = 300_000  # words whose log-probabilities a task keeps at a time
PART_WORDS = 5_000  # words that are looked up together
LONG_WORD = 64  # longer runs are scored piece by piece and not kept
MIXTURE = 0.01  # least variance of a language: texts quote other languages, names and markup


def _layout(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Characters of all words with their end marks, place in the word, and number of the word."""
    codes = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le", "surrogatepass"), "<u4")
    lengths = np.fromiter((len(w) + 2 for w in words), "i8", len(words))
    owner = np.repeat(np.arange(len(words)), lengths)
    return codes.astype("u8"), np.arange(len(codes)) - (lengths.cumsum() - lengths)[owner], owner


def _grams(codes: np.ndarray, place: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-grams that end at each character (shorter at the beginning of a word)."""
    out = np.zeros(len(codes), "u8")
    with np.errstate(over="ignore"):
        for back in range(n - 1, -1, -1):
            shifted = np.zeros(len(codes), "u8")
            shifted[back:] = codes[: len(codes) - back]
            out = (out ^ (np.where(place >= back, shifted, 0) + np.uint64(1))) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
    return out


def _orders(codes: np.ndarray, place: np.ndarray, order: int) -> list[np.ndarray]:
    return [np.zeros(len(codes), "u8")] + [_grams(codes, place, n) for n in range(1, order + 1)]


def _before(keys: np.ndarray) -> np.ndarray:
    """The hash at the previous character: a gram's context."""
    return np.r_[np.uint64(0), keys[:-1]]


@dataclass
class Model:
    """Interpolated Kneser-Ney models of all languages, as sorted hash arrays.

    ``grams[n]``: hashes; ``value[n]``: discounted probability per language; ``contexts[n]``: hashes
    of the contexts of order n; ``weight[n]``: their interpolation weight per language (1 if unseen).
    """

    languages: list[str]
    order: int
    grams: list[np.ndarray]
    value: list[np.ndarray]
    contexts: list[np.ndarray]
    weight: list[np.ndarray]
    floor: float = 1e-6
    mean: np.ndarray | None = None
    spread: np.ndarray | None = None  # a and b per language

    def log_probabilities(self, words: list[str]) -> np.ndarray:
        """Natural log-probability of each word under each language."""
        codes, place, owner = _layout(words)
        keys = _orders(codes, place, self.order)
        p = np.full((len(codes), len(self.languages)), self.floor)
        for n in range(1, self.order + 1):
            own = _lookup(self.grams[n], self.value[n], keys[n], 0.0)
            p = own + _lookup(self.contexts[n], self.weight[n], _before(keys[n - 1]), 1.0) * p
        log = np.log(p)
        log[place == 0] = 0.0
        return np.add.reduceat(log, np.flatnonzero(place == 0), axis=0)


def _lookup(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, default: float) -> np.ndarray:
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where((keys[at] == wanted)[:, None], values[at], default)


def tokens(text: str) -> list[str]:
    return text.lower().split()


def fit(texts: dict[str, list[str]], order: int = 4) -> Model:
    """Models from a few texts per language."""
    languages = sorted(texts)
    counts: dict[str, np.ndarray] = {}
    for column, language in enumerate(languages):
        met: Counter[str] = Counter()
        for text in texts[language]:
            met.update(tokens(text))
        for token, count in met.items():
            word = SIDE.sub("", token)
            if word and len(word) <= LONG_WORD:
                counts.setdefault(word, np.zeros(len(languages)))[column] += count
    words = list(counts) or ["?"]
    codes, place, owner = _layout(words)
    weights = np.stack([counts.get(w, np.zeros(len(languages))) for w in words])[owner]
    keys, live = _orders(codes, place, order), place > 0
    found = [None]  # per order: distinct grams, counts, their contexts, their suffixes
    for n in range(1, order + 1):
        grams, first, inverse = np.unique(keys[n][live], return_index=True, return_inverse=True)
        table = np.stack([np.bincount(inverse, w, len(grams)) for w in weights[live].T], 1)
        found.append((grams, table, _before(keys[n - 1])[live][first], keys[n - 1][live][first]))
    grams, value, contexts, weight = [None], [None], [None], [None]
    for n in range(1, order + 1):
        own, table, context, _ = found[n]
        if n < order:
            # Below the highest order a gram counts the different grams that it continues.
            _, longer, _, suffix = found[n + 1]
            at = np.searchsorted(own, suffix)
            table = np.stack([np.bincount(at, x, len(own)) for x in (longer > 0).astype("f8").T], 1)
        ones, twos = (table == 1).sum(0), (table == 2).sum(0)
        discount = np.clip(ones / np.maximum(1, ones + 2 * twos), 0.1, 0.9)
        parents, inverse = np.unique(context, return_inverse=True)
        total = np.stack([np.bincount(inverse, x, len(parents)) for x in table.T], 1)
        kinds = np.stack([np.bincount(inverse, x, len(parents)) for x in (table > 0).astype("f8").T], 1)
        grams.append(own)
        value.append(np.maximum(table - discount, 0) / np.maximum(total, 1)[inverse])
        contexts.append(parents)
        weight.append(np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0))
    return Model(languages, order, grams, value, contexts, weight)


class Scorer:
    """Cross-entropies of whole texts; keeps the log-probabilities of recent words."""

    def __init__(self, model: Model):
        self.model = model
        self._forget()

    def _forget(self):
        self.numbers = defaultdict()
        self.numbers.default_factory = self.numbers.__len__
        self.rows = np.zeros((0, len(self.model.languages) + 2))  # log-probabilities, characters, letters

    def _learn(self, new: list[str]) -> None:
        words = [SIDE.sub("", t) for t in new]
        # Very long words are scored in pieces; each piece counts its end mark.
        pieces = [[w[i : i + LONG_WORD] for i in range(0, len(w), LONG_WORD)] for w in words]
        flat = [p for ps in pieces for p in ps]
        rows = np.zeros((len(new), self.rows.shape[1]))
        rows[:, -1] = [LETTER.search(w) is not None for w in words]
        if flat:
            owner = np.repeat(np.arange(len(new)), [len(ps) for ps in pieces])
            for at in range(0, len(flat), PART_WORDS):
                part, own = flat[at : at + PART_WORDS], owner[at : at + PART_WORDS]
                np.add.at(rows[:, :-2], own, self.model.log_probabilities(part))
                np.add.at(rows[:, -2], own, np.fromiter((len(p) + 1 for p in part), "f8", len(part)))
        self.rows = np.concatenate([self.rows, rows])

    def entropies(self, texts: list) -> list[tuple[np.ndarray | None, int]]:
        """Per text: nats per character under each language, and the characters scored; None for
        texts without letters."""
        if len(self.rows) > CACHE_WORDS:
            self._forget()
        numbers, had = self.numbers, len(self.rows)
        ids = [list(map(numbers.__getitem__, tokens(t))) if t else [] for t in texts]
        if len(numbers) > had:
            self._learn(list(islice(numbers, had, None)))
        out = []
        for own in ids:
            total = self.rows[own].sum(0) if own else None
            none = total is None or total[-1] == 0
            out.append((None, 0) if none else (-total[:-2] / total[-2], int(total[-2])))
        return out


def _calibrate(model: Model, held: dict[str, list[str]]) -> None:
    """Mean and spread (a + b / length) of the right language's cross-entropy."""
    scorer, k = Scorer(model), len(model.languages)
    model.mean, model.spread = np.full(k, 3.0), np.tile([1.0, 1.0], (k, 1))
    for column, language in enumerate(model.languages):
        seen = [(e[column], n) for e, n in scorer.entropies(held.get(language, [])) if e is not None]
        if len(seen) < 5:
            continue
        e, n = np.array(seen).T
        model.mean[column] = np.average(e, weights=np.minimum(n, 1000))
        off = (e - model.mean[column]) ** 2
        long = n >= np.median(n)
        a = max(MIXTURE, off[long].mean())
        model.spread[column] = a, max(1.0, np.average(off * n, weights=np.ones_like(n)))


def sampled(training: DataFrame, rows_per_language: int, chars_per_language: int, seed: int) -> dict[str, list[str]]:
    """The bounded sample: lang -> texts in seeded order.

    The order is settled on ids, hashes and lengths, a short list per language and partition; the chosen
    ones, ``rows_per_language`` at most, are then sent to the rows, and only their texts are read out.
    """
    texts = training.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        "lang", "doc_id", "text", F.length("text").alias("n"), F.xxhash64(F.lit(seed), "doc_id", "text").alias("_h")
    )
    by = Window.partitionBy("lang").orderBy("_h", "doc_id", "n")
    few = (
        texts.select("lang", "doc_id", "n", "_h")
        .withColumn("_r", F.row_number().over(by)).filter(F.col("_r") <= rows_per_language)
        .withColumn("_c", F.sum("n").over(by))
        .filter((F.col("_c") <= chars_per_language) | (F.col("_r") == 1))
    )
    chosen = few.select("lang", "doc_id", "_h", "_r").collect()
    if not chosen:
        return {}
    kind = texts.schema["doc_id"].dataType.simpleString()
    ids = [(r["lang"], r["doc_id"], r["_h"]) for r in chosen]
    wanted = few_rows(training.sparkSession, ids, f"_l string, _d {kind}, _k long").distinct()
    same = (F.col("_h") == F.col("_k")) & F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("lang") == F.col("_l"))
    found = texts.join(F.broadcast(wanted), same).select("lang", "doc_id", "_h", "text").collect()
    text_of = {(r["lang"], r["doc_id"], r["_h"]): r["text"] for r in found}
    out = defaultdict(list)
    for r in sorted(chosen, key=lambda r: r["_r"]):
        if (key := (r["lang"], r["doc_id"], r["_h"])) in text_of:
            out[r["lang"]].append(text_of[key])
    return dict(out)


def train(
    training: DataFrame, order: int = 4, rows_per_language: int = 400, chars_per_language: int = 1_000_000, seed: int = 5
) -> Model | None:
    """A calibrated model from labelled rows (doc_id, text, lang); None without any."""
    texts = sampled(training, rows_per_language, chars_per_language, seed)
    if not texts:
        return None
    # Every fifth text is kept for calibration if there are enough of them.
    learn = {k: [t for i, t in enumerate(v) if i % 5 or len(v) < 25] for k, v in texts.items()}
    held = {k: [t for i, t in enumerate(v) if i % 5 == 0 and len(v) >= 25] for k, v in texts.items()}
    model = fit(learn, order)
    _calibrate(model, held)
    return model


PREDICTION = "lang_pred string, score double, cross_entropy double, rejected boolean"


def predict(docs: DataFrame, model: Model | None, tolerance: float = 10.0, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns of ``docs`` (all by default), which must have ``text``, with PREDICTION.

    score: probability of the predicted language among all, from the log-likelihoods of at most 50
    characters' worth of evidence, so that it keeps grading long texts.
    """
    kept = keep or docs.columns
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample

    def start():
        model = shared.value
        sole_cache()
        scorer = Scorer(model) if model else None

        def one(e, n):
            if e is None:
                return "und", 0.0, None, True
            best = int(e.argmin())
            odds = np.exp((e[best] - e) * min(n, 50))
            a, b = model.spread[best]
            limit = model.mean[best] + tolerance * np.sqrt(a + b / n)
            return model.languages[best], float(1 / odds.sum()), float(e[best]), bool(e[best] > limit)

        def compute(texts):
            found = scorer.entropies(texts) if scorer else [(None, 0)] * len(texts)
            return list(zip(*(one(e, n) for e, n in found)))

        return compute

    return per_text(docs, kept, PREDICTION, start)
