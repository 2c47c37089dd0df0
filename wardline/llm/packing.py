"""Packing documents into sequences by linear grouping.

Token ids of each document, an end id appended, are cut into pieces of at most ``capacity`` ids. The
plan is made from the numbers of pieces per length, at most ``capacity`` numbers: lengths above
``small`` are put in descending order into groups of equal cardinality and rounded up to the largest of their
group; configurations of these few sizes are chosen one after the other, each the fullest that holds
the largest size left, and used as often as the counts allow; then actual lengths are substituted,
which returns what rounding had taken, and the short pieces go, longest first, into the fullest
sequences that still hold them. The plan says for each length which ranks among its pieces go to
which sequences. Its size depends on the number of lengths, not of documents; the documents
themselves only get a rank among those of their length, in shards of bounded size.

Defined results: null text is empty: one piece, the end id; rows that repeat are packed each; an
empty table has no sequences; further columns are ignored.
"""

from __future__ import annotations

import bisect
import os
import re
import struct
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.common import per_text, sole_cache
from wardline.session import written

CACHE_WORDS = 600_000
END = b"\0\0\0\0"
_MARK = re.compile(rb"([,.])(?=[ \n])(?<=[a-z0-9].)")  # begins with the mark, which is found fastest
_encoders: dict[str, "Encoder"] = {}


def _words(text: str) -> list[bytes]:
    """Parts of a text that are encoded alone: A-Z lowered, commas and stops at a word's end cut off.

    The vocabulary lowers letters itself and makes such a mark a token of its own, so neither changes
    ids; both make equal words meet. Special tokens are written in lower case: their texts stay.
    """
    raw = text.encode()
    return raw.split() if b"<|" in raw else _MARK.sub(rb" \1 ", raw.lower()).split()


def _spelling() -> dict[int, str]:
    """The vocabulary's spelling of the Latin letters: a character for each byte of their UTF-8."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    of = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in shown)}
    return {c: "".join(of.get(b, chr(b)) for b in chr(c).encode()) for c in range(0xC0, 0x100)}


# Words of these characters only: composed already, and their parts are what the vocabulary's pattern cuts
# (the apostrophe, which begins parts of its own, is not among them).
_PLAIN = re.compile("[\x21-\x26\x28-\x7e\xc0-\xd6\xd8-\xf6\xf8-\xff]+")
_PART = re.compile("[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^a-z0-9\xdf-\xf6\xf8-\xff]+")
_SPELLING = _spelling()


class Encoder(dict):
    """Ids of whole texts; a task's worker keeps those of recent words (word -> little-endian ids).

    The vocabulary's pattern never crosses white space and its normaliser joins nothing across it, so
    a text's ids are its words' ids one after the other. A word of plain Latin letters, digits and marks
    goes straight to the vocabulary's merges, part by part; any other takes the whole way.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        # Tasks run side by side already; threads of each worker only add memory.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model
        # A vocabulary with other rules takes the whole way for every word.
        self.direct = all(self._merged(w) == self._whole(w) for w in ("the", "Stra\xdfe", "\xc0\xff", "a12.&&&\xe9"))

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _merged(self, text: str) -> list[int]:
        text, merged = text.lower(), self.merges.tokenize
        parts = [text] if text.isalpha() else _PART.findall(text)
        return [t.id for x in parts for t in merged(x if x.isascii() else x.translate(_SPELLING))]

    def __missing__(self, word: bytes) -> bytes:
        text = word.decode()
        if self.direct and word.isalpha() and word.islower():
            ids = [t.id for t in self.merges.tokenize(text)]
        elif self.direct and "<|" not in text and _PLAIN.fullmatch(text):
            ids = self._merged(text)
        else:
            ids = self._whole(text)
        self[word] = out = struct.pack(f"<{len(ids)}I", *ids)
        return out

    def encode(self, text: str | None) -> bytes:
        """Little-endian unsigned 32-bit ids of a text, with the end id."""
        if len(self) > CACHE_WORDS:
            self.clear()
        return b"".join(map(self.__getitem__, _words(text) if text else ())) + END


def pieces(docs: DataFrame, vocabulary: str, capacity: int = 2048, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids, as binary, if wanted) of each piece."""
    fields = "piece:int,start:long,length:long,ids_crc32:long" + (",ids:binary" if with_ids else "")

    def start():
        sole_cache(_encoders)  # another operator drops the vocabulary with the words
        if vocabulary not in _encoders:
            _encoders[vocabulary] = Encoder(vocabulary)
        encoder = _encoders[vocabulary]

        def compute(texts):
            out = []
            for ids in map(encoder.encode, texts):
                cuts = [ids[a : a + 4 * capacity] for a in range(0, len(ids), 4 * capacity)]
                out.append([
                    {"piece": i, "start": i * capacity, "length": len(c) // 4, "ids_crc32": zlib.crc32(c)}
                    | ({"ids": c} if with_ids else {})
                    for i, c in enumerate(cuts)
                ])
            return [out]

        return compute

    return per_text(docs, ["doc_id"], f"pieces array<struct<{fields}>>", start).select("doc_id", F.inline("pieces"))


def configurations(groups: list[tuple[int, int]], capacity: int) -> list[tuple[list[int], int]]:
    """Few-size packing: [(group numbers in one sequence, how many sequences)].

    groups: (size, count) by falling size. Each configuration starts with the largest size left and is
    completed to the fullest sum that the counts allow (bounded subset sums).
    """
    left = [c for _, c in groups]
    out = []
    for g, (size, _) in enumerate(groups):
        while left[g]:
            room = capacity - size
            # reached[s]: the group whose size was added last to come to sum s; larger sizes first.
            reached = np.full(room + 1, -1, "i4")
            uses = np.zeros(room + 1, "i4")
            open_sums = np.zeros(room + 1, bool)
            open_sums[0] = True
            for h in range(g, len(groups)):
                step = groups[h][0]
                spare = left[h] - (h == g)
                if step > room or spare <= 0:
                    continue
                uses[:] = 0
                for _ in range(min(spare, room // step)):
                    fresh = np.zeros(room + 1, bool)
                    fresh[step:] = open_sums[:-step] & (uses[:-step] < spare)
                    fresh &= ~open_sums
                    if not fresh.any():
                        break
                    at = np.flatnonzero(fresh)
                    uses[at] = uses[at - step] + 1
                    reached[at] = h
                    open_sums |= fresh
                if open_sums[room]:
                    break
            total = int(np.flatnonzero(open_sums)[-1])
            chosen = [g]
            while total:
                chosen.append(int(reached[total]))
                total -= groups[chosen[-1]][0]
            need = defaultdict(int)
            for h in chosen:
                need[h] += 1
            times = min(left[h] // n for h, n in need.items())
            for h, n in need.items():
                left[h] -= n * times
            out.append((sorted(chosen), times))
    return out


def plan(counts: dict[int, int], capacity: int = 2048, groups: int = 1024, small: int = 160) -> pd.DataFrame:
    """Rows (length, first_rank, last_rank, sequence, offset): the pieces of a length with ranks
    first..last go, one each, to sequences ``sequence``, ``sequence`` + 1, ... at ``offset``."""
    rows: list[tuple[int, int, int, int, int]] = []
    used = dict.fromkeys(counts, 0)
    opened = 0
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room -> runs (first sequence, number)

    def put(length: int, number: int, sequence: int, offset: int):
        if number:
            rows.append((length, used[length], used[length] + number - 1, sequence, offset))
            used[length] += number

    if counts.get(capacity):
        put(capacity, counts[capacity], 0, 0)
        opened = counts[capacity]
    large = sorted((x for x in counts if small < x < capacity), reverse=True)
    each = max(1, -(-sum(counts[x] for x in large) // groups))
    grouped: list[list[list[int]]] = []  # runs [length, number] of each group, longest first
    room = 0
    for x in large:
        n = counts[x]
        while n:
            if not room:
                grouped.append([])
                room = each
            take = min(n, room)
            grouped[-1].append([x, take])
            n -= take
            room -= take
    for chosen, times in configurations([(g[0][0], sum(n for _, n in g)) for g in grouped], capacity):
        # Each member takes the next ``times`` pieces of its group; where lengths change, runs split.
        taken = []
        for h in chosen:
            need, runs = times, []
            while need:
                length, n = grouped[h][0]
                k = min(n, need)
                runs.append((length, k))
                need -= k
                if k == n:
                    grouped[h].pop(0)
                else:
                    grouped[h][0][1] -= k
            taken.append(runs)
        ends = sorted({e for runs in taken for e in np.cumsum([k for _, k in runs]).tolist()})
        begin = 0
        for end in ends:
            offset = 0
            for runs in taken:
                length = next(x for (x, _), e in zip(runs, np.cumsum([k for _, k in runs])) if e > begin)
                put(length, end - begin, opened + begin, offset)
                offset += length
            gaps[capacity - offset].append((opened + begin, end - begin))
            begin = end
        opened += times
    sizes = sorted(r for r in gaps if r)
    for x in sorted((x for x in counts if x <= small), reverse=True):
        n = counts[x]
        while n:
            at = bisect.bisect_left(sizes, x)
            if at == len(sizes):
                number = -(-n // (capacity // x))
                gaps[capacity].append((opened, number))
                opened += number
                sizes.append(capacity)
                continue
            gap = sizes[at]
            first, number = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap], sizes[at]
            per = min(gap // x, n)
            filled = min(number, n // per)
            for i in range(per):
                put(x, filled, first, capacity - gap + i * x)
            n -= per * filled
            for rest, run in ((gap - per * x, (first, filled)), (gap, (first + filled, number - filled))):
                if run[1] and rest:
                    if rest not in gaps or not gaps[rest]:
                        bisect.insort(sizes, rest)
                    gaps[rest].append(run)
    return pd.DataFrame(rows, columns=["length", "first_rank", "last_rank", "sequence", "offset"])


def pack(cut: DataFrame, capacity: int = 2048, shard_rows: int = 20_000) -> DataFrame:
    """Adds sequence_id and offset to pieces (with ``length``, and doc_id, piece to order them)."""
    spark = cut.sparkSession
    cut = written(cut, "pack-pieces")
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(histogram.values())
    layout = plan(histogram, capacity)
    shared = spark.sparkContext.broadcast(
        {length: tuple(part[c].to_numpy() for c in ("first_rank", "sequence", "offset"))
         for length, part in layout.sort_values(["length", "first_rank"]).groupby("length")}
    )
    shards = max(1, -(-total // shard_rows))
    keyed = cut.withColumn("_shard", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(shards)))
    numbers = (
        keyed.groupBy("length", "_shard").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.sum("_n").over(Window.partitionBy("length").orderBy("_shard")) - F.col("_n"))
        .select("length", "_shard", "_before")
    )
    order = Window.partitionBy("length", "_shard").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        keyed.withColumn("_rank", F.row_number().over(order) - 1)
        .join(numbers, ["length", "_shard"])
        .withColumn("_rank", F.col("_rank") + F.col("_before"))
        .drop("_shard", "_before")
    )
    names = cut.columns
    schema = ", ".join(f"`{n}` {cut.schema[n].dataType.simpleString()}" for n in names)

    def place(batches):
        import pyarrow as pa

        layout = shared.value
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "_rank"))
            sequence, offset = np.empty(len(rank), "i8"), np.empty(len(rank), "i8")
            for x in np.unique(length):
                own = np.flatnonzero(length == x)
                first, start, inside = layout[int(x)]
                at = np.searchsorted(first, rank[own], "right") - 1
                sequence[own] = start[at] + rank[own] - first[at]
                offset[own] = inside[at]
            arrays = [batch.column(n) for n in names] + [pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(arrays, [*names, "sequence_id", "offset"])

    return ranked.select(*names, "_rank").mapInArrow(place, schema + ", sequence_id long, offset long")
