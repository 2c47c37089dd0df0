"""Phrase collocations, counted with one full-text index per shard of the corpus.

Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends, and pieces into words; a phrase
lies within one piece. A task gathers the words of its texts, per language, into shards of
``shard_words`` words and indexes each as a text over word ids: the Burrows-Wheeler transform of the text
and of the reversed text, both sorted as deep as phrases are long. A phrase is a pair of intervals, one per
direction. Extending it to the right by every word that follows somewhere reads its interval in the
reversed transform and moves both intervals; the last word is added on the left, out of the forward
transform. The sizes of the intervals are the counts, so all phrases of up to ``longest`` words of the shard
come out once each, with their counts; the empty phrase counts the words.

Counts are summed across shards by (language, segment of the phrases' hash): a shard's phrases of
a segment travel as one compressed value, so a frequent phrase or language is one small entry per
shard, and a frequent language is dealt over all segments. Nothing is pruned before the sums are
whole. What follows works on phrases with ``least`` or more occurrences only. All of their parts have as
many, so the same table holds the counts of the parts and of the left and right extensions.

Defined results: null texts are empty, a null language is ``und``; repeated rows count each; ties of the
score are broken by count and phrase; an empty table gives no rows. A shard ends at a piece's end, so
one endless piece makes its shard larger and loses nothing.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.common import partitions, ship
from wardline.session import written

PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
# A piece's end cannot be part of a word, so one of its characters stands for all of them.
TO_STOP = bytes.maketrans(PIECE_ENDS, b"." * len(PIECE_ENDS))
SHARD = "lang string, segment int, size long, phrases binary, n long, counts binary"


def _sorted_rows(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``text``, sorted by the ``depth`` symbols from there on (past the end: 0)."""
    padded = np.concatenate([text, np.zeros(depth, text.dtype)])
    rows = np.arange(len(text))
    for k in reversed(range(depth)):
        rows = rows[np.argsort(padded[rows + k], kind="stable")]
    return rows


class ShardIndex:
    """Both transforms of ``ids``, word ids from 1 with 0 wherever a piece ends, for phrases of up to ``longest`` words."""

    def __init__(self, ids: np.ndarray, longest: int):
        text = np.concatenate([[0], ids, [0]]).astype(np.int64)
        back = text[::-1]
        self.longest = longest
        self.symbols = int(text.max()) + 1
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=self.symbols))])
        self.forward = np.roll(text, 1)[_sorted_rows(text, max(1, longest - 1))]
        self.reverse = np.roll(back, 1)[_sorted_rows(back, max(1, longest - 2))]
        # Row of the reversed text that starts one symbol earlier.
        self.step = np.empty(len(text), np.int64)
        self.step[np.argsort(self.reverse, kind="stable")] = np.arange(len(text))

    def extensions(self, transform: np.ndarray, low: np.ndarray, size: np.ndarray):
        """(phrase number, symbol, first row, count) of all symbols in the intervals, by phrase and symbol."""
        at = np.repeat(np.arange(len(low)), size)
        rows = np.arange(len(at)) - np.repeat(np.cumsum(size) - size, size) + low[at]
        pair = at * self.symbols + transform[rows]
        order = np.argsort(pair, kind="stable")
        pair = pair[order]
        heads = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]])) if len(pair) else np.empty(0, np.int64)
        count = np.diff(np.concatenate([heads, [len(pair)]]))
        return pair[heads] // self.symbols, pair[heads] % self.symbols, rows[order[heads]], count

    def phrases(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(matrix of word ids, counts) per phrase length."""
        words = np.arange(1, self.symbols)
        size = np.diff(self.first)[1:]
        ahead = behind = self.first[1:-1]  # intervals in the text's and in the reversed text's rows
        matrix = words.reshape(-1, 1)
        yield matrix, size
        for length in range(2, self.longest + 1):
            if length < self.longest:  # to the right
                phrase, symbol, row, count = self.extensions(self.reverse, behind, size)
                before = np.cumsum(count) - count  # occurrences of smaller symbols after the same phrase
                base = (np.cumsum(size) - size)[phrase]
                ahead, behind = ahead[phrase] + before - base, self.step[row]
                told = symbol > 0
                ahead, behind = ahead[told], behind[told]
                matrix = np.column_stack([matrix[phrase[told]], symbol[told]])
            else:  # to the left
                phrase, symbol, _, count = self.extensions(self.forward, ahead, size)
                told = symbol > 0
                matrix = np.column_stack([symbol[told], matrix[phrase[told]]])
            size = count[told]
            yield matrix, size


def _packed(lang: str, numbers: dict[bytes, int], ids: np.ndarray, longest: int, segments: int) -> Iterator[pa.RecordBatch]:
    """The phrases of one shard with their counts, one row per segment."""
    words = sorted(numbers, key=numbers.__getitem__)  # words[0] stands for piece ends
    ends = pa.array([w + b"\n" for w in words], pa.large_binary())
    plain = pa.array(words, pa.large_binary())
    hashed = np.array([zlib.crc32(w) for w in words], np.uint64)
    codec = pa.Codec("zstd", compression_level=1)
    n_words = int(np.count_nonzero(ids))
    yield _batch([(lang, 0, 1, codec.compress(b"\n", asbytes=True), 1, codec.compress(np.array([n_words], np.uint32).tobytes(), asbytes=True))])
    for matrix, count in ShardIndex(ids, longest).phrases():
        key = np.zeros(len(matrix), np.uint64)
        for column in matrix.T:
            key = (key ^ hashed[column]) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
        segment = (key % np.uint64(segments)).astype(np.int64)
        order = np.argsort(segment, kind="stable")
        cuts = np.searchsorted(segment[order], np.arange(segments + 1))
        parts = [plain.take(pa.array(c[order])) for c in matrix.T[:-1]] + [ends.take(pa.array(matrix[order, -1]))]
        joined = pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.large_binary())) if len(parts) > 1 else parts[0]
        if isinstance(joined, pa.ChunkedArray):
            joined = joined.combine_chunks()
        _, offsets, data = joined.buffers()
        offsets = np.frombuffer(offsets, np.int64)[: len(joined) + 1]
        packed_counts = count[order].astype(np.uint32)
        rows = []
        for s in np.flatnonzero(np.diff(cuts)).tolist():
            low, high = int(cuts[s]), int(cuts[s + 1])
            a, b = int(offsets[low]), int(offsets[high])
            told = codec.compress(data[a:b], asbytes=True)
            rows.append((lang, s, b - a, told, high - low, codec.compress(packed_counts[low:high].tobytes(), asbytes=True)))
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.binary()]
    names = ["lang", "segment", "size", "phrases", "n", "counts"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def _numbers() -> dict[bytes, int]:
    numbers: dict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    numbers[b"."]  # number 0: a piece's end
    return numbers


def _parts(told: list[bytes], most: int) -> Iterator[list[bytes]]:
    """``told`` in parts of up to ``most`` words, cut at piece ends (longer where a piece is)."""
    start = 0
    while len(told) - start > most:
        near = (i for i in range(start + most, start, -1) if told[i] == b".")
        far = (i for i in range(start + most, len(told)) if told[i] == b".")
        cut = next(near, None) or next(far, len(told))
        yield told[start:cut]
        start = cut
    yield told[start:]


def _shards(batches: Iterator[pa.RecordBatch], longest: int, segments: int, shard_words: int) -> Iterator[pa.RecordBatch]:
    held: dict[str, tuple[dict[bytes, int], list[np.ndarray]]] = {}
    total = 0

    def packed():
        for lang, (numbers, gathered) in held.items():
            yield from _packed(lang, numbers, np.concatenate(gathered), longest, segments)

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
            text = (text.as_py() or "").encode("utf-8").lower()
            told = text.translate(TO_STOP).replace(b".", b" . ").split()
            for part in _parts(told, shard_words):
                numbers, gathered = held.setdefault(lang, (_numbers(), []))
                gathered += [np.fromiter(map(numbers.__getitem__, part), np.int32, len(part)), np.zeros(1, np.int32)]
                total += len(part)
                if total >= shard_words:
                    yield from packed()
                    held, total = {}, 0
    yield from packed()


def _summed(group: pa.Table, least: int) -> pa.Table:
    """Phrases of one (language, segment) with their counts over all shards: frequent ones, and the empty one."""
    codec = pa.Codec("zstd")

    def unpacked(name: str, sizes) -> bytes:
        return b"".join(codec.decompress(v.as_buffer(), n, asbytes=True) for v, n in zip(group[name], sizes.to_pylist()))

    data = unpacked("phrases", group["size"])
    counts = np.frombuffer(unpacked("counts", pc.multiply(group["n"], 4)), np.uint32)
    # A phrase's line ends with its line feed, which no word holds.
    ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 10).astype(np.int64) + 1
    offsets = np.concatenate([[0], ends])
    lines = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    table = pa.table({"phrase": lines, "a": pa.array(counts.astype(np.int64))})
    done = table.group_by("phrase", use_threads=False).aggregate([("a", "sum")])
    done = done.filter(pc.or_(pc.greater_equal(done["a_sum"], least), pc.equal(pc.binary_length(done["phrase"]), 1)))
    phrase = pc.binary_slice(done["phrase"].combine_chunks().cast(pa.binary()), 0, -1).cast(pa.string())
    lang = pa.array([group["lang"][0].as_py()] * len(phrase), pa.string())
    return pa.table({"lang": lang, "phrase": phrase, "a": done["a_sum"]}).combine_chunks()


def phrase_counts(docs: DataFrame, least: int = 10, longest: int = 3, shard_words: int = 2_000_000) -> DataFrame:
    """(lang, phrase, a): all phrases of up to ``longest`` words with ``least`` or more occurrences ``a`` in the
    language, and the empty phrase with the number of words."""
    ship(docs.sparkSession)
    segments = 2 * partitions(docs.sparkSession)
    source = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    packed = source.mapInArrow(lambda batches: _shards(batches, longest, segments, shard_words), SHARD)
    return packed.groupBy("lang", "segment").applyInArrow(lambda group: _summed(group, least), "lang string, phrase string, a long")


def collocations(
    docs: DataFrame, least: int = 10, longest: int = 3, percent: int = 50, shard_words: int = 2_000_000
) -> DataFrame:
    """Phrases of 2 to ``longest`` words that hang together, per language.

    ``a``, ``l``, ``r``: occurrences of the phrase and of both parts at its weakest cut; ``n``: words of the language;
    ``score``: floor(1000000 a a / (l r)); ``left_a``, ``right_a``: occurrences of the most frequent phrase with one more
    word on that side (null: none is frequent). Phrases of which a longer frequent one that holds them
    has ``percent`` or more of the occurrences are left out.
    """
    counts = written(phrase_counts(docs, least, longest, shard_words), "phrases")
    total = counts.filter("phrase = ''").select("lang", F.col("a").alias("n"))
    found = counts.filter("phrase <> ''").withColumn("words", F.split("phrase", " ", -1)).withColumn("m", F.size("words"))
    told = counts.filter("phrase <> ''")
    candidates = found.filter("m > 1")

    def part(start: str, length: str):
        return F.expr(f"array_join(slice(words, {start}, {length}), ' ')")

    cuts = candidates.select("lang", "phrase", "a", "words", "m", F.explode(F.expr("sequence(1, m - 1)")).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", part("1", "k").alias("left"), part("k + 1", "m - k").alias("right"))
    left = told.select("lang", F.col("phrase").alias("left"), F.col("a").alias("l"))
    right = told.select("lang", F.col("phrase").alias("right"), F.col("a").alias("r"))
    exact = {c: f"cast({c} as decimal(15, 0))" for c in "alr"}  # products stay within 38 digits
    score = F.expr(f"(cast(1000000 as decimal(7, 0)) * ({exact['a']} * {exact['a']})) div ({exact['l']} * {exact['r']})")
    scored = (
        cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"])
        .groupBy("lang", "phrase")
        .agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"), F.first("a").alias("a"))
    )

    # A phrase's place inside a longer one: 1 at its end (a left extension), 2 at its start, 3 elsewhere.
    inside = candidates.filter("m > 2").select(
        "lang", F.col("a").alias("longer"), "words", "m", F.explode(F.expr("sequence(2, m - 1)")).alias("size")
    ).select("*", F.explode(F.expr("sequence(1, m - size + 1)")).alias("at"))
    one_more = F.col("m") == F.col("size") + 1
    longer = inside.select(
        "lang", part("at", "size").alias("phrase"), "longer",
        F.when(one_more & (F.col("at") == 2), F.col("longer")).alias("left_a"),
        F.when(one_more & (F.col("at") == 1), F.col("longer")).alias("right_a"),
    ).groupBy("lang", "phrase").agg(*[F.max(c).alias(c) for c in ("longer", "left_a", "right_a")])
    kept = scored.join(longer, ["lang", "phrase"], "left").filter(f"longer is null or 100 * longer < {percent} * a")
    return kept.join(total, "lang").select(
        "lang", "phrase", "a", "cut.l", "cut.r", "n", F.col("cut.score").cast("long").alias("score"), "left_a", "right_a"
    )


def best(found: DataFrame, first: int = 2000) -> DataFrame:
    """The ``first`` phrases of each language by score, count and phrase, with their ``rank``."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return found.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= first)
