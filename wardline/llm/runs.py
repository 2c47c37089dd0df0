"""Periodic runs of words, found by online dyadic square catching.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q`` apart are identical),
of length ``max(least, 2 * q)`` or more, that no neighbouring word extends. Its first ``2 * q`` words
are a square: the same ``q`` words twice.

Words are appended from left to right. Catchers stand on completed blocks: the text is cut into
aligned blocks of a power of two of words, and a catcher compares its block with the text's suffix
of the same length, as soon as that suffix ends ``p`` words after the block, for the periods ``p`` of its
class (from one power of two up to the next). Blocks of a class are short enough that every square
with such a period has a whole block in its first half, so its catcher must fire. At any word only
the one or two latest blocks of a class are in range: a word costs one or two comparisons of block
keys per class, and there are as many classes as the text's length has bits.

A catcher that fires opens a comparison of words ``p`` apart: back from the block, and on with each
appended word. As soon as it has seen ``p`` equal words the square is there, and as long as it goes on, new
squares of that period end at every appended word; they merge into one run. Suffixes that lie, with
their block, inside a known run whose period divides ``p`` only repeat that run and open nothing, so even a
text of one repeated word costs little more than reading it.

Defined results: a null or empty text has no run; equal rows get equal results; very long texts are
read whole, with a few numbers per word in memory.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from wardline.llm.common import per_text

ADDED = "n_words long, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"


def period_classes(least: int, n: int) -> list[tuple[int, int, int]]:
    """(smallest period, largest period, block length) per class, for texts of ``n`` words.

    A run of period ``p`` has ``max(least - p, p)`` or more words that equal the word ``p`` further on. Any
    stretch of ``2 * block - 1`` words holds a whole aligned block.
    """
    out = []
    low = 1
    while 2 * low <= n:
        high = 2 * low - 1
        near = (least // 2, -(-least // 2))  # where max(least - p, p) is smallest
        stretch = min(max(least - p, p) for p in (min(max(q, low), high) for q in near))
        out.append((low, high, 1 << (((stretch + 1) // 2).bit_length() - 1)))
        low *= 2
    return out


def _catches(keys: np.ndarray, low: int, high: int, block: int) -> tuple[np.ndarray, np.ndarray]:
    """(block start, period) of every suffix that equals a block in range; chains of neighbouring
    blocks with one period count once, by their first block."""
    of_block = np.repeat(keys[::block], block)[: len(keys)]
    starts, periods = [], []
    for shift in range(low, high + 1, block):
        at = np.flatnonzero(keys[shift:] == of_block[: len(keys) - shift])
        if len(at):
            start = at - at % block
            period = at + shift - start
            fits = period <= high
            starts.append(start[fits])
            periods.append(period[fits])
    if not starts:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    start, period = np.concatenate(starts), np.concatenate(periods)
    order = np.lexsort((start, period))
    start, period = start[order], period[order]
    first = np.ones(len(start), bool)
    first[1:] = (period[1:] != period[:-1]) | (start[1:] != start[:-1] + block)
    return start[first], period[first]


def _equal_from(ids: np.ndarray, at: int, period: int) -> int:
    """First position from ``at`` on whose word differs from the one ``period`` later (or the text's end)."""
    end, step = len(ids) - period, 32
    while at < end:
        here = ids[at : min(at + step, end)]
        differ = here != ids[at + period : at + period + len(here)]
        k = int(differ.argmax())
        if differ[k]:
            return at + k
        at += len(here)
        step *= 4
    return end


def _equal_back(ids: np.ndarray, at: int, period: int) -> int:
    """Smallest position from which all words up to ``at`` equal the one ``period`` later."""
    step = 32
    while at > 0:
        low = max(0, at - step)
        differ = (ids[low:at] != ids[low + period : at + period])[::-1]
        k = int(differ.argmax())
        if differ[k]:
            return at - k
        at = low
        step *= 4
    return 0


def find_runs(ids: np.ndarray, least: int = 12) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start and period. ``ids``: equal numbers for equal words."""
    n = len(ids)
    if n < max(least, 2):
        return []
    caught = []
    keys, width = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), 1
    by_block: dict[int, list[tuple[int, int]]] = {}
    for low, high, block in period_classes(least, n):
        by_block.setdefault(block, []).append((low, high))
    for block in sorted(by_block):
        while width < block:  # the key of a block comes from the keys of its halves
            left, right = keys[:-width], keys[width:]
            keys = (left ^ (left >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) + right * np.uint64(0x94D049BB133111EB)
            width *= 2
        for low, high in by_block[block]:
            start, period = _catches(keys, low, high, block)
            if len(start):
                caught.append((start + period + block, period, start))
    if not caught:
        return []
    ended, periods, starts = (np.concatenate(x) for x in zip(*caught))
    order = np.lexsort((periods, ended))  # as appended words complete them
    found: dict[tuple[int, int], int] = {}
    live: list[tuple[int, int, int]] = []
    compared: dict[int, int] = {}
    for end, p, at in zip(ended[order].tolist(), periods[order].tolist(), starts[order].tolist()):
        if at < compared.get(p, 0):
            continue
        live = [r for r in live if r[1] >= end]
        if any(s <= at and p % q == 0 for s, _, q in live):
            continue
        low, high = _equal_back(ids, at, p), _equal_from(ids, at, p)
        compared[p] = high
        if high + p - low >= max(least, 2 * p):
            run = (low, high + p)
            found[run] = min(found.get(run, p), p)
            live.append((*run, found[run]))
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run contains after its first period."""
    if not runs:
        return words
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(kept)]


def periodic_runs(docs: DataFrame, keep: list[str] | None = None, least: int = 12) -> DataFrame:
    """``docs`` (``keep``: its columns to return) with ``n_words``, all ``runs`` of each whole text by start
    and period, and ``collapsed``: the text's words, one space between, with each run cut to its first period."""

    def start():
        def compute(texts: list[str | None]):
            counts, runs, short = [], [], []
            for text in texts:
                words = text.encode("utf-8", "surrogatepass").split() if text else []
                numbers: dict[bytes, int] = {}
                ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
                found = find_runs(ids, least) if len(numbers) < len(words) else []
                counts.append(len(words))
                runs.append([{"start": s, "length": n, "period": p} for s, n, p in found])
                short.append(b" ".join(collapse(words, found)))
            return counts, runs, short

        return compute

    return per_text(docs, docs.columns if keep is None else keep, ADDED, start)
