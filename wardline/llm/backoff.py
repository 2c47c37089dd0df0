"""Scoring whole texts with a weighted backoff automaton of smoothed word n-grams.

Model: tokens are lower-cased words and one end mark per text. Unigrams are add-one smoothed,
(c + 1) / (N + V + 1); higher orders interpolate with a prior of strength K(k) = strength * k^growth
for a context seen k times: P(w | h) = (c(h, w) + K P(w | h')) / (k + K). This sums to one for any K,
needs no statistic beyond the counts, and backs off by the factor K / (k + K). As an automaton, seen
contexts are states, seen n-grams are arcs weighted log P, and a state's failure arc, weighted
log K / (k + K), leads to the state of its longest proper suffix.

Jobs: texts are cut into blocks of about ``block_tokens`` tokens, written once with block-local token
numbers. Each block counts its own distinct n-grams (64-bit hashes, sorted arrays, split by hash
range); a range's counts of all blocks meet in one task, which sums them and answers each block for
its own n-grams only. A block so receives the slice of the model that its texts touch, compiles the
automaton, and traverses each text left to right. A frequent n-gram is one entry per block, ranges
hold ``range_entries`` on average whatever the corpus, nothing is broadcast or pruned, and all
traffic grows in proportion to the corpus.

Defined results: null text is empty (one token, the end mark); words are compared by 64-bit hashes;
rows that repeat are counted and scored each; a null id is training; no training rows give uniform
scores; further columns are ignored.
"""

from __future__ import annotations

from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from wardline.llm.common import partitions, return_memory, ship, words
from wardline.session import written

END, BOS = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
BLOCK = "block_id long, doc_ids array<long>, training array<boolean>, ends array<int>, tokens binary, vocab binary, entries long"
COUNTS = "block_id long, range int, level int, keys binary, counts binary"
SCORES = "doc_id long, training boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
TEXTS = 200  # texts of a batch that are made Python objects at a time


def _mix(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a context followed by a word (order matters)."""
    with np.errstate(over="ignore"):
        x = context * np.uint64(0xD6E8FEB86659FD93) + np.uint64(0x632BE59BD9B4E019) ^ word
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(29))


def _cut(block_tokens: int):
    schema = to_arrow_schema(StructType.fromDDL(BLOCK))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, serial = TaskContext.get().partitionId(), 0
        numbers, hold = None, None

        def fresh():
            nonlocal numbers, hold
            numbers = defaultdict()
            numbers.default_factory = numbers.__len__
            hold = {"doc_ids": [], "training": [], "ends": [], "tokens": [], "n": 0}

        def block():
            nonlocal serial
            serial += 1
            vocab = np.fromiter((xxhash.xxh64_intdigest(w) for w in numbers), "u8", len(numbers))
            row = {
                "block_id": (part << 32) + serial, "doc_ids": hold["doc_ids"], "training": hold["training"],
                "ends": hold["ends"], "tokens": _pack(np.concatenate(hold["tokens"])),
                "vocab": vocab.tobytes(), "entries": hold["n"],
            }
            fresh()
            return pa.RecordBatch.from_pylist([row], schema)

        fresh()
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                for row in batch.slice(at, TEXTS).to_pylist():
                    # The end mark is the reserved number -1 until the block is read.
                    ids = list(map(numbers.__getitem__, words(row["text"])))
                    ids.append(-1)
                    hold["doc_ids"].append(row["doc_id"])
                    hold["training"].append(row["training"])
                    hold["n"] += len(ids)
                    hold["ends"].append(hold["n"])
                    hold["tokens"].append(np.array(ids, "<i4"))
                    if hold["n"] >= block_tokens:
                        yield block()
        if hold["n"]:
            yield block()
        batch = row = ids = numbers = hold = None
        return_memory()

    return run


def _pack(values: np.ndarray) -> bytes:
    """Bytes of an array, those of equal weight together: sorted and small numbers compress well so."""
    return values.view("u1").reshape(-1, values.itemsize).T.tobytes()


def _unpack(raw: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, "u1").reshape(width, -1).T).view(kind).ravel()


class Grams:
    """The distinct n-grams of a block, sorted by hash, and where each position's n-gram is."""

    def __init__(self, row, order: int):
        vocab = np.append(np.frombuffer(row["vocab"], "u8"), END)
        tokens = _unpack(row["tokens"], "<i4")
        self.tokens = np.where(tokens < 0, len(vocab) - 1, tokens)
        self.ends = np.array(row["ends"], "i8")
        self.starts = np.r_[0, self.ends[:-1]]
        self.words = vocab[self.tokens]
        self.levels, self.context = [], []
        context, whole = None, self.words
        for m in range(1, order + 1):
            if m > 1:
                # Context of m - 1 tokens: the hash of the previous position's (m - 1)-gram.
                context = np.empty_like(whole)
                context[1:] = whole[:-1]
                context[self.starts] = self._begin(m - 1)
                whole = _mix(context, self.words)
            keys, first, inverse = np.unique(whole, return_index=True, return_inverse=True)
            self.levels.append((keys, first, inverse.astype("i4")))

    @staticmethod
    def _begin(length: int) -> np.uint64:
        out = np.array([BOS])
        for _ in range(length - 1):
            out = _mix(out, np.array([BOS]))
        return out[0]


def _slices(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Bounds of the hash ranges in a sorted array."""
    edges = (np.arange(1, ranges, dtype="f8") / ranges * 2.0**64).astype("u8")
    return np.r_[0, np.searchsorted(keys, edges), len(keys)]


def _counted(row: dict, order: int, ranges: int) -> list[dict]:
    """A block's own counts, a row for each hash range and level."""
    g = Grams(row, order)
    training = np.repeat(np.array(row["training"], bool), np.diff(np.r_[0, g.ends]))
    out = []
    for m, (keys, _, inverse) in enumerate(g.levels, 1):
        counts = np.bincount(inverse, training, len(keys)).astype("<u4")
        cut = _slices(keys, ranges)
        out += [
            {"block_id": row["block_id"], "range": r, "level": m, "keys": _pack(keys[a:b]), "counts": _pack(counts[a:b])}
            for r, (a, b) in enumerate(zip(cut[:-1], cut[1:])) if b > a
        ]
    return out


def _count(order: int, ranges: int):
    schema = to_arrow_schema(StructType.fromDDL(COUNTS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # One block at a time: a batch has all blocks of the task.
            for at in range(batch.num_rows):
                out = _counted(batch.slice(at, 1).to_pylist()[0], order, ranges)
                yield pa.RecordBatch.from_pylist(out, schema)
                out = None
                return_memory()

    return run


def _merge(piece: pd.DataFrame) -> pd.DataFrame:
    """Sum one range's counts over all blocks; answer each block in the order of its keys."""
    return_memory()  # what the group before has left
    lengths = np.array([len(k) // 8 for k in piece["keys"]])
    keys = np.concatenate([_unpack(k, "u8") for k in piece["keys"]])
    _, inverse = np.unique(keys, return_inverse=True)
    del keys
    counts = np.concatenate([_unpack(c, "<u4") for c in piece["counts"]])
    sums = np.bincount(inverse, counts)
    totals = sums[inverse].astype("<u8")
    del inverse, counts
    level = int(piece["level"].iloc[0])
    # Size and number of distinct unigrams, once per range: on its first row.
    n = np.zeros((2, len(piece)), "i8")
    if level == 1:
        n[:, 0] = sums.sum(), (sums > 0).sum()
    small = totals.astype("<u4") if len(totals) == 0 or totals.max() < 2**32 else totals
    at = np.r_[0, lengths.cumsum()]
    return pd.DataFrame({
        "block_id": piece["block_id"], "range": piece["range"], "level": piece["level"],
        "width": small.itemsize, "totals": [_pack(small[a:b]) for a, b in zip(at[:-1], at[1:])],
        "n_tokens": n[0], "n_types": n[1],
    })


def _numbers(code: str, values: np.ndarray) -> array:
    """Plain numbers that the traversal reads one by one; a list has an object for each."""
    return array(code, values.astype(code).tobytes())


class Automaton:
    """States, arcs and failure arcs for the n-grams that a block's texts touch."""

    def __init__(self, g: Grams, totals: list[np.ndarray], texts: int, n: int, v: int, strength: float, growth: float):
        order, self.vocabulary = len(g.levels), int(g.tokens.max()) + 1
        self.tokens = g.tokens
        seen = [t[inv] for t, (_, _, inv) in zip(totals, g.levels)]  # count of the m-gram at each position
        prob = [(seen[0] + 1.0) / (n + v + 1.0)]
        # States: 0 is the empty context, then each seen context, by length; the last positions of
        # texts end in the end mark and are no contexts.
        state_of, fail, fail_weight, base = [np.zeros(len(g.tokens), "i8")], [0], [0.0], 1
        is_end = np.zeros(len(g.tokens), bool)
        is_end[g.ends - 1] = True
        begins = [0]
        for m in range(1, order):
            keys, first, inv = g.levels[m - 1]
            number = np.where(totals[m - 1] > 0, np.arange(base, base + len(keys)), -1)
            here = np.where(is_end, -1, number[inv])
            k = totals[m - 1].astype("f8")
            prior = strength * np.maximum(k, 1.0) ** growth
            fail += state_of[-1][first].tolist()
            fail_weight += np.log10(prior / (k + prior)).tolist()
            # Where the m-gram was never seen the suffix state stands.
            state_of.append(np.where(here >= 0, here, state_of[-1]))
            base += len(keys)
            begins.append(base if texts else begins[-1])
            if texts:
                prior = strength * texts**growth
                fail.append(begins[-2])
                fail_weight.append(np.log10(prior / (texts + prior)))
                base += 1
        self.start = begins[-1]
        self.fail, self.fail_weight = array("q", fail), array("d", fail_weight)
        del fail, fail_weight
        arcs, weights, targets = [], [], []
        for m in range(1, order + 1):
            keys, first, inv = g.levels[m - 1]
            if m > 1:
                k = np.empty(len(g.tokens))
                k[1:] = seen[m - 2][:-1]
                k[g.starts] = texts
                prior = strength * np.maximum(k, 1.0) ** growth
                prob.append(np.where(k > 0, (seen[m - 1] + prior * prob[-1]) / (k + prior), prob[-1]))
            known = first if m == 1 else first[totals[m - 1] > 0]  # the root has an arc for every word
            if m == 1:
                source = np.zeros(len(known), "i8")
            else:
                at = np.empty(len(g.tokens), "i8")
                at[1:] = state_of[m - 1][:-1]
                at[g.starts] = begins[m - 1]
                source = at[known]
            arcs.append(source * self.vocabulary + g.tokens[known])
            weights.append(np.log10(prob[m - 1][known]))
            # An arc leads to the longest seen suffix that can still be a context.
            targets.append(state_of[min(m, order - 1)][known] if order > 1 else np.zeros(len(known), "i8"))
        self.seen = seen[0]
        self.weights, self.targets = _numbers("d", np.concatenate(weights)), _numbers("q", np.concatenate(targets))
        del seen, prob, state_of, weights, targets  # not kept beside the arcs
        self.arcs = dict(zip(np.concatenate(arcs).tolist(), range(len(self.weights))))

    def traverse(self, tokens: list[int]) -> float:
        arcs, weights, targets, fail, fail_weight = self.arcs, self.weights, self.targets, self.fail, self.fail_weight
        size, state, total = self.vocabulary, self.start, 0.0
        for token in tokens:
            arc = arcs.get(state * size + token)
            while arc is None:
                total += fail_weight[state]
                state = fail[state]
                arc = arcs.get(state * size + token)
            total += weights[arc]
            state = targets[arc]
        return total


def _score(order: int, texts: int, n: int, v: int, strength: float, growth: float):
    def run(block: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        return_memory()  # what the block before has left
        row = block.iloc[0]
        g = Grams(row, order)
        totals = []
        answers = answers.sort_values(["level", "range"])
        for m in range(1, order + 1):
            own = answers[answers["level"] == m]
            totals.append(np.concatenate([_unpack(t, f"<u{w}") for t, w in zip(own["totals"], own["width"])]).astype("i8"))
        del answers, own
        automaton = Automaton(g, totals, texts, n, v, strength, growth)
        del totals, g.levels
        base = np.log10((automaton.seen + 1.0) / (n + v + 1.0))
        scores = [automaton.traverse(g.tokens[a:b].tolist()) for a, b in zip(g.starts, g.ends)]
        return pd.DataFrame({
            "doc_id": pd.array(row["doc_ids"], dtype="Int64"), "training": row["training"],
            "n_tokens": g.ends - g.starts,
            "n_known": np.add.reduceat((automaton.seen > 0).astype("i8"), g.starts),
            "train_tokens": n, "base_score": np.add.reduceat(base, g.starts), "score": scores,
        })

    return run


def score(
    docs: DataFrame, order: int = 2, strength: float = 3.0, growth: float = 0.8,
    block_tokens: int = 400_000, range_entries: int = 2_000_000,
) -> DataFrame:
    """Scores of ``docs`` (doc_id, text, training): SCORES, one row per text."""
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), "text", F.coalesce("training", F.lit(True)).alias("training"))
    blocks = written(rows.mapInArrow(_cut(block_tokens), BLOCK), "lm-blocks")
    sizes = blocks.agg(
        F.sum("entries"), F.sum(F.size(F.filter("training", lambda t: t))), F.max(F.size("doc_ids"))
    ).first()
    if not sizes[0]:
        return docs.sparkSession.createDataFrame([], SCORES)
    texts = int(sizes[1] or 0)
    ranges = max(partitions(docs.sparkSession), -(-int(sizes[0]) // range_entries))
    counted = blocks.select("block_id", "training", "ends", "tokens", "vocab").mapInArrow(_count(order, ranges), COUNTS)
    answers = written(
        counted.groupBy("level", "range").applyInPandas(
            _merge,
            "block_id long, range int, level int, width int, totals binary, n_tokens long, n_types long",
        ),
        "lm-answers",
    )
    n, v = answers.filter("level = 1").agg(F.sum("n_tokens"), F.sum("n_types")).first()
    fields = _score(order, texts, int(n), int(v), strength, growth)
    return blocks.groupBy("block_id").cogroup(
        answers.select("block_id", "range", "level", "width", "totals").groupBy("block_id")
    ).applyInPandas(fields, SCORES)
