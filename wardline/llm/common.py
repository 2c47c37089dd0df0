"""What several operators share: words, row folds, tables of the test folders."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from wardline.session import scratch_root

# A word is a run of characters other than space and the control characters 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column | str, folds: int) -> Column:
    """Remainder of the id's checksum; a missing id counts as remainder 0."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(col.cast("string")) % folds, F.lit(0))


def words(text: str | None) -> list[bytes]:
    """Words of a text as UTF-8, A-Z lower-cased; None has none.

    ``bytes.lower`` touches A-Z only and ``bytes.split`` cuts at exactly the six separators of
    ``WORD``, so both agree with the pattern and run in C.
    """
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def partitions(spark: SparkSession, at_least: int = 1) -> int:
    """The session's shuffle partitions."""
    return max(at_least, int(spark.conf.get("spark.sql.shuffle.partitions")))


def remove_written(*tables: DataFrame) -> None:
    """Remove the files of tables made by ``written`` once their last reader has run."""
    for df in tables:
        spark = df.sparkSession
        folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
        for folder in folders:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            if scratch_root(spark).split(":", 1)[-1].lstrip("/") in folder:
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def few_rows(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A table of a few rows that the driver has, at least one, handed over as Arrow.

    As Python objects they would pass through Python workers of another kind than those of ``mapInArrow``,
    which executors then keep beside these.
    """
    schema = StructType.fromDDL(ddl)
    types = to_arrow_schema(schema)
    columns = [pa.array(list(values), field.type) for values, field in zip(zip(*rows), types)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=types), schema)


KEY_BITS = 1 << 25
SLICE = 200  # texts that a task computes together


def key_bits(df: DataFrame, key: str, wanted: DataFrame, bits: int = KEY_BITS) -> tuple[Column, Broadcast]:
    """Bit of a row of ``df``, and a bit map of the keys in the only column of ``wanted``, sent to all tasks."""
    at = lambda c: F.pmod(F.xxhash64(c), F.lit(bits))
    bit = F.expr("shiftleft(1L, cast(_at % 64 as int))")
    found = wanted.select(at(F.col(wanted.columns[0]).cast(df.schema[key].dataType)).alias("_at")).groupBy(
        F.shiftright("_at", 6).alias("word")
    ).agg(F.bit_or(bit).alias("bits")).toArrow()
    marks = np.zeros(-(-bits // 64), "u8")
    marks[found.column("word").to_numpy()] = found.column("bits").to_numpy().view("u8")
    return at(key), df.sparkSession.sparkContext.broadcast(marks)


def marked(batch: pa.RecordBatch, marks: np.ndarray, others: bool = False) -> pa.RecordBatch:
    """Rows of a batch whose bit, column ``_at``, is set; or else the others."""
    at = batch.column("_at").to_numpy().view("u8")
    keep = marks[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)
    return batch.filter(pa.array(keep.astype(bool) != others))


def split_by_keys(df: DataFrame, key: str, wanted: DataFrame, bits: int = KEY_BITS) -> tuple[DataFrame, DataFrame]:
    """Rows of ``df`` whose ``key`` is in the only column of ``wanted``, with a few others; and the rest.

    The wanted keys travel as a bit map of bounded size (4 MB), so that long rows need no shuffle. Every
    wanted row is in the first part, and so are rows whose key falls on a bit of another: readers still
    match exactly.
    """
    ship(df.sparkSession)
    at, shared = key_bits(df, key, wanted, bits)
    names = df.columns

    def part(others: bool) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield marked(batch, shared.value, others).select(names)

        return df.withColumn("_at", at).mapInArrow(run, df.schema)

    return part(False), part(True)


def likely_among(df: DataFrame, key: str, wanted: DataFrame, bits: int = KEY_BITS) -> DataFrame:
    """The first part of ``split_by_keys``."""
    return split_by_keys(df, key, wanted, bits)[0]


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the executors' Python workers, once per application.

    Spark's own file server hands out the archive, so executors need no shared path for it.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="wardline-code-"), "wardline_code.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)


_caches: list = []


def return_memory() -> None:
    """Freed memory goes back to the system: Arrow's, and the C library's (glibc) where it can be told so."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def sole_cache(cache=None) -> None:
    """Empty all other caches of this worker process, which serves one operator after the other."""
    held = [other for other in _caches if other is not cache and other]
    for other in held:
        other.clear()
    if held:
        return_memory()
    if cache is not None and not any(c is cache for c in _caches):
        _caches.append(cache)


def per_text(docs: DataFrame, keep: list[str], added: str, start, among: tuple[str, DataFrame] | None = None) -> DataFrame:
    """Columns ``keep`` of ``docs`` unchanged, and columns ``added`` computed from ``text``.

    ``start()`` runs once per task and returns a function from a list of texts to one sequence per
    added column. Kept columns pass through as Arrow arrays, so nulls and types stay as they are.
    ``among`` (key, wanted) leaves the rows of ``likely_among``; in the same worker, since one behind
    another doubles the workers that an executor has from then on.
    """
    ship(docs.sparkSession)
    at, shared = key_bits(docs, *among) if among else (None, None)
    extra = StructType.fromDDL(added)
    names = [f"k{i}" for i in range(len(keep))]
    read = [F.col("text").alias("_text"), *([at.alias("_at")] if among else [])]
    source = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, names)], *read)
    schema = StructType(source.schema.fields[: len(names)] + extra.fields)
    types = to_arrow_schema(extra)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = start()
        for batch in batches:
            batch = marked(batch, shared.value) if shared else batch
            # Slices bound what a task holds of very long texts and of their words.
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                made = compute(part.column("_text").to_pylist())
                arrays = [part.column(n) for n in names]
                arrays += [pa.array(values, field.type) for values, field in zip(made, types)]
                yield pa.RecordBatch.from_arrays(arrays, names + extra.names)
        # A worker outlives its tasks; what this one needed is not kept beside the next one's.
        compute = batch = part = made = arrays = None
        return_memory()

    done = source.mapInArrow(run, schema)
    return done.select(*[F.col(n).alias(c) for c, n in zip(keep, names)], *extra.names)
