"""Toxicity by maximum-scoring segment search.

A word scores by its log-odds between toxic and other labelled texts, smoothed by a Dirichlet
prior. A word that training has hardly seen scores by its best part, a run of five bytes, whose
log-odds are taken over the different words that hold it. Some standard errors and a drift are taken
off, so that ordinary text scores below zero on average. A linear scan finds all maximal scoring
segments of a text (Ruzzo and Tompa 1999): the passages that no extension or shortening improves.

Calibration: on texts of the other class the largest segment score of n words follows an
extreme-value law, P(S >= s) = 1 - exp(-K n exp(-lambda s)) (Karlin and Altschul 1990). lambda solves
E[exp(lambda score)] = 1 over that class's words, K is fitted to its observed segments. A segment is
significant if its E-value E, K n exp(-lambda s), is at most ``significant``. A document's evidence is
log(1 + 1/E) of its largest segment, significant or not, and -log E of every other significant one; a logistic
curve fitted on the training rows turns the sum into the score.

Training reads a bounded sample: at most ``rows_per_class`` labelled rows of each class, whole
texts, as many of them in seeded order as fit ``chars_per_class``, at least one; the lexicon keeps at most ``lexicon`` words and as many parts, those of the
largest scores.

Defined results: null and empty text have no segment and no evidence; without training rows
of both classes every score is 0; rows that repeat are scored each; of several labels of one id
the highest counts; a null label is none; further columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import few_rows, per_text, sole_cache
from wardline.session import written

# Punctuation of ASCII separates words here; it says nothing about toxicity.
_BREAKS = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in range(256))


def tokens(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_BREAKS).lower().split() if text else []


PART = 5
CACHE_WORDS = 300_000  # words whose scores a task keeps at a time


def parts(word: bytes) -> list[bytes]:
    """A word's runs of bytes, the word's ends marked."""
    marked = b"^" + word + b"$"
    return [marked[i : i + PART] for i in range(len(marked) - PART + 1)]


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) of a sequence, in linear time.

    Candidates are kept as (sum before it, sum after it, start, end); a new positive run is joined to
    the nearest candidate that begins lower, as long as it ends higher than that one did.
    """
    positive = np.flatnonzero(scores > 0)
    if not len(positive):
        return []
    sums = np.r_[0.0, scores.cumsum()]
    # Neighbouring positive scores always belong to one segment.
    breaks = np.flatnonzero(np.diff(positive) > 1)
    starts, ends = positive[np.r_[0, breaks + 1]], positive[np.r_[breaks, len(positive) - 1]] + 1
    stack: list[tuple[float, float, int, int]] = []
    links: list[int] = []  # of each candidate, the nearest earlier one that begins lower (-1: none)
    for s, e in zip(starts.tolist(), ends.tolist()):
        low, high, first = sums[s], sums[e], s
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][0] >= low:
                j = links[j]
            if j < 0 or stack[j][1] >= high:
                stack.append((low, high, first, e))
                links.append(j)
                break
            low, _, first, _ = stack[j]
            del stack[j:], links[j:]
    return [(a, b, float(h - low)) for low, h, a, b in stack]


@dataclass
class Model:
    weights: dict[bytes, float] = field(default_factory=dict)
    stems: dict[bytes, float] = field(default_factory=dict)
    other: float = -1.0  # score of words without proof
    lam: float = 1.0
    k: float = 1.0
    slope: float = 0.0
    offset: float = -30.0
    significant: float = 0.05
    known: dict[bytes, float] = field(default_factory=dict)

    def scores(self, found: list[bytes]) -> np.ndarray:
        """Scores of words; each new word is looked up by its parts once."""
        if len(self.known) > CACHE_WORDS:
            self.known = {}
        known = self.known
        for w in set(found).difference(known):
            score = self.weights.get(w)
            if score is None:
                score = max((self.stems[p] for p in parts(w) if p in self.stems), default=self.other)
            known[w] = score
        return np.array([known[w] for w in found])

    def passages(self, text: str | None) -> tuple[list[tuple[int, int, float]], float]:
        """Significant segments (first and last word, score) and the document's evidence."""
        found = tokens(text)
        if not found or not (self.weights or self.stems):
            return [], 0.0
        scores = self.scores(found)
        # E-values count the places where a passage could begin: the words outside are many and even.
        size = np.log(self.k * len(found))
        gains = [(self.lam * s - size, a, b, s) for a, b, s in segments(scores)]
        kept = [x for x in gains if x[0] >= -np.log(self.significant)]
        # E / (1 + E) stands for the probability of the largest segment, so that texts without a
        # significant one are still ranked by how near they come.
        top = max(gains, default=(-size,))[0]
        return [x[1:] for x in kept], float(np.logaddexp(0.0, top)) + sum(sorted(x[0] for x in kept)[:-1])

    def probability(self, evidence: float) -> float:
        if not self.slope:
            return 0.0
        return float(1 / (1 + np.exp(-np.clip(self.slope * evidence + self.offset, -500, 500))))


def _lambda(scores: np.ndarray, share: np.ndarray) -> float:
    """The positive root of E[exp(lambda s)] = 1."""
    low, high = 0.0, 1.0
    while (share * np.exp(high * scores)).sum() < 1 and high < 1e3:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if (share * np.exp(mid * scores)).sum() < 1 else (low, mid)
    return high


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 60) -> tuple[float, float]:
    """Slope and offset by Newton steps with a weak prior."""
    w = np.zeros(2)
    design = np.c_[x, np.ones_like(x)]
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        h = (design * (p * (1 - p))[:, None]).T @ design + np.diag([1e-3, 1e-3])
        step = np.linalg.solve(h, design.T @ (y - p) - 1e-3 * w)
        w += np.clip(step, -5, 5)
    return float(w[0]), float(w[1])


def _bound(n: tuple[int, int], sizes: tuple[int, int], prior: float, errors: float) -> float:
    """Lower bound of the smoothed log-odds between the second class and the first."""
    a, b = n[0] + prior, n[1] + prior
    return float(np.log(b / (sizes[1] + 1)) - np.log(a / (sizes[0] + 1)) - errors * np.sqrt(1 / a + 1 / b))


def fit(
    toxic: list[str], clean: list[str], prior: float = 0.5, lexicon: int = 50_000, drift: float = 0.5,
    errors: float = 2.5, significant: float = 0.05,
) -> Model:
    """A model from texts of both classes.

    ``prior``: occurrences that each class is given of every word and part (Dirichlet). ``drift`` and
    ``errors`` standard errors are taken from all log-odds: a word counts as toxic only as far as its
    frequency proves it. Words without proof score -drift.
    """
    if not toxic or not clean:
        return Model()
    # A word counts once per different word before it: copies of a text, its length and its
    # repetitions then add nothing, however many of them a class holds.
    of, texts = [Counter(), Counter()], [0, 0]
    for c, group in enumerate((clean, toxic)):
        met = set()
        for text in group:
            before = b""
            for w in tokens(text):
                if (pair := hash((before, w))) not in met:
                    met.add(pair)
                    of[c][w] += 1
                before = w
        texts[c] = max(1, len(met))
    words = {w: (of[0][w], of[1][w]) for w in {*of[0], *of[1]}}
    alone = {w: _bound(n, texts, prior, errors) for w, n in words.items() if n[1] > 1}
    # A part counts once per different word, so that it says what unseen words with it are like.
    kinds = [Counter(), Counter()]
    for w, n in words.items():
        for c in (0, 1):
            if n[c]:
                kinds[c].update(set(parts(w)))
    types = tuple(sum(1 for n in words.values() if n[c]) for c in (0, 1))
    stems = {}
    for part, n in kinds[1].items():
        if n > 2 and (sure := _bound((kinds[0][part], n), types, prior, errors)) > drift:
            stems[part] = sure - drift
    stems = dict(sorted(stems.items(), key=lambda x: (-x[1], x[0]))[:lexicon])
    known = {}
    for w, n in words.items():
        by_part = max((stems[p] for p in parts(w) if p in stems), default=None)
        by_word = alone.get(w, -drift) - drift
        if by_part is not None:
            # Texts of the other class that hold this very word speak against what its part says.
            rates = [(x + prior) / t for x, t in zip(n, texts)]
            by_part += min(0.0, float(np.log(rates[1] / rates[0])))
        if by_part is not None or by_word > 0:
            known[w] = max(by_word, by_part if by_part is not None else by_word, -drift)
    known = dict(sorted(known.items(), key=lambda x: (-abs(x[1]), x[0]))[:lexicon])
    model = Model(known, stems, -drift, significant=significant)
    # Extreme-value law of the clean class.
    seen = [model.scores(tokens(text)) for text in clean]
    values, share = np.unique(np.concatenate(seen), return_counts=True)
    if not len(values) or values.max() <= 0:
        # No toxic word in clean text at all: one could have gone unseen.
        values, share = np.r_[values, max([1.0, *model.weights.values(), *model.stems.values()])], np.r_[share, 1]
    model.lam = _lambda(values, share / share.sum())
    # Expected number of segments above s is K n exp(-lambda s); their number above zero gives K.
    model.k = max(sum(len(segments(s)) for s in seen), 1) / max(1, sum(map(len, seen)))
    x = np.array([model.passages(t)[1] for t in toxic + clean])
    y = np.array([1.0] * len(toxic) + [0.0] * len(clean))
    model.slope, model.offset = _logistic(np.log1p(x), y)
    model.known = {}
    return model


def train(
    docs: DataFrame, labels: DataFrame, rows_per_class: int = 3000, chars_per_class: int = 10_000_000, seed: int = 3
) -> Model:
    """From ``docs`` and (doc_id, toxic): a bounded sample of each class in seeded order.

    The order is settled on ids, hashes and lengths; no text meets the labels. The chosen ids, at most
    ``rows_per_class`` a class, are then sent to the documents, and only their texts are read out.
    """
    marks = labels.filter("toxic in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    texts = docs.filter(F.col("text").isNotNull() & F.col("doc_id").isNotNull()).select(
        "doc_id", "text", F.xxhash64(F.lit(seed), "doc_id", "text").alias("_h")
    )
    narrow = texts.select("doc_id", "_h", F.length("text").alias("_n")).distinct()
    order = written(narrow.join(marks, "doc_id"), "toxic-order")
    chosen = {}
    for c in (0, 1):
        first = order.filter(F.col("toxic") == c).orderBy("_h", "doc_id").limit(rows_per_class).collect()
        kept = max(1, int((np.cumsum([r["_n"] for r in first]) <= chars_per_class).sum()))
        chosen |= {(r["doc_id"], r["_h"]): (c, i) for i, r in enumerate(first[:kept])}
    if not chosen:
        return Model()
    kind = order.schema["doc_id"].dataType.simpleString()
    wanted = few_rows(docs.sparkSession, list(chosen), f"doc_id {kind}, _h long")
    found = {(r["doc_id"], r["_h"]): r["text"] for r in texts.join(F.broadcast(wanted), ["doc_id", "_h"]).collect()}
    samples = [[found[k] for k in sorted(chosen, key=chosen.get) if chosen[k][0] == c and k in found] for c in (0, 1)]
    return fit(samples[1], samples[0])


SCORE = "score double, passages array<struct<first:int,last:int,score:double>>"


def score(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns of ``docs`` with the score and the significant passages (word numbers)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the lexicon

    def start():
        model = shared.value
        sole_cache()

        def compute(texts):
            found = [model.passages(t) for t in texts]
            return (
                [model.probability(np.log1p(e)) for _, e in found],
                [[{"first": a, "last": b - 1, "score": s} for a, b, s in kept] for kept, _ in found],
            )

        return compute

    return per_text(docs, keep or docs.columns, SCORE, start)
