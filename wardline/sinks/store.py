"""Keyed tables that change together: written beside the old rows, published by one small file.

A table's rows lie in folders by the version that wrote them and by range of the key::

    <root>/tables/<name>/version=<version>/key_range=<range>/...      rows
    <root>/ranges/<name>/<version>/                                   which version holds each range
    <root>/ledger/<version>-<n>/                                      landed batches taken so far
    <root>/published/<number>.json                                    the pointer: names all of the above

A transaction writes the touched ranges anew, under its own version, and a new list of ranges. Nothing
it writes is seen by anyone until ``publish`` creates the next pointer. So a run that stops anywhere leaves the
last published tables as they were, and the next run starts from them; several tables and the
ledger of taken batches change in one step; and readers, who follow one pointer, see one state
throughout. A pointer that was cut short while being written does not parse and does not count.

Columns follow the rows that are written (added ones are NULL in older rows, removed ones go), without
touching older ranges: the pointer holds the current columns and the name each is stored under. A column
that comes back after it was removed gets a new stored name, so old values do not return with it. A
column whose type changes has all ranges rewritten.

One writer at a time; a second one is noticed when it publishes.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.operators.joins import not_in_keys
from wardline.session import written

WIDTH = 10_000_000  # keys of a range
SENT_RANGES = 1_000_000  # a list of ranges is sent to all executors up to this many (some 20 bytes each)
RANGES = "key_range long, version string, state string"
LEDGER = "feed string, batch_id string, state string"


class PublishConflict(RuntimeError):
    """Another run has published since this one started."""


def key_range(key: str | None, width: int = WIDTH) -> Column:
    """Range number of a key; NULL keys are in range 0. Without a key all rows are."""
    at = F.coalesce(F.col(key).cast("long"), F.lit(0)) if key else F.lit(0)
    return F.floor(at / F.lit(width)).cast("long")


class Files:
    """The few file-system calls that pointers need."""

    def __init__(self, spark: SparkSession, root: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._io = spark._jvm.org.apache.commons.io.IOUtils
        self._fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def make_folder(self, path: str) -> None:
        self._fs.mkdirs(self._path(path))

    def names(self, path: str) -> list[str]:
        p = self._path(path)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(p)) if self._fs.exists(p) else []

    def read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._io.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> bool:
        """A new file; False if there is one already."""
        if self.exists(path):
            return False
        out = self._fs.create(self._path(path), False)
        out.write(bytearray(text.encode("utf-8")))
        out.close()
        return True

    def remove(self, path: str) -> None:
        self._fs.delete(self._path(path), True)


@dataclass(frozen=True)
class TableState:
    """What a pointer says of one table."""

    key: str | None
    width: int
    ranges: str  # version of its list of ranges
    n_ranges: int
    schema: dict
    stored: dict[str, str]  # column: name it is stored under
    used: list[str]  # all names ever stored under

    @property
    def columns(self) -> T.StructType:
        return T.StructType.fromJson(self.schema)

    @property
    def stored_schema(self) -> T.StructType:
        return T.StructType([T.StructField(self.stored[f.name], f.dataType) for f in self.columns])


@dataclass(frozen=True)
class Pointer:
    number: int = 0
    version: str = ""
    ledger: str | None = None
    tables: dict[str, TableState] = field(default_factory=dict)

    def text(self) -> str:
        return json.dumps({"version": self.version, "ledger": self.ledger, "tables": {n: vars(t) for n, t in self.tables.items()}})

    @staticmethod
    def parse(number: int, text: str) -> Pointer:
        d = json.loads(text)
        return Pointer(number, d["version"], d["ledger"], {n: TableState(**t) for n, t in d["tables"].items()})


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.files = Files(spark, root)

    # ── reading ─────────────────────────────────────────────────────────────────────────────────

    def numbers(self) -> list[int]:
        return [int(n[:-5]) for n in self.files.names(f"{self.root}/published") if n.endswith(".json")]

    def pointers(self, most: int) -> list[Pointer]:
        """The newest whole pointers, newest first."""
        out = []
        for number in reversed(self.numbers()):
            if len(out) == most:
                break
            try:
                out.append(Pointer.parse(number, self.files.read(f"{self.root}/published/{number:012d}.json")))
            except ValueError:  # cut short
                continue
        return out

    def current(self) -> Pointer:
        return next(iter(self.pointers(1)), Pointer())

    def folder(self, name: str) -> str:
        return f"{self.root}/tables/{name}"

    def has(self, name: str) -> bool:
        return name in self.current().tables

    def ranges(self, name: str, version: str) -> DataFrame:
        return self.spark.read.schema(RANGES).parquet(f"{self.root}/ranges/{name}/{version}")

    def table(self, name: str, touching: DataFrame | None = None, at: Pointer | None = None) -> DataFrame:
        """The published rows; with ``touching`` only those of ranges that hold one of its keys.

        The list of ranges prunes the folders that are read, before any file is opened.
        """
        state = (at or self.current()).tables[name]
        live = self.ranges(name, state.ranges).filter("state = 'live'")
        if touching is not None:
            live = live.join(touching.select(key_range(state.key, state.width).alias("key_range")).distinct(), "key_range", "left_semi")
        places = T.StructType([T.StructField("version", T.StringType()), T.StructField("key_range", T.LongType())])
        rows = self.spark.read.schema(T.StructType(state.stored_schema.fields + places.fields)).parquet(self.folder(name))
        if state.n_ranges <= SENT_RANGES:
            live = F.broadcast(live)
        kept = rows.join(live.drop("state"), ["version", "key_range"])
        return kept.select(*[F.col(state.stored[f.name]).alias(f.name) for f in state.columns])

    def ledger(self, at: Pointer | None = None) -> DataFrame:
        """(feed, batch_id): landed batches that the published tables have taken."""
        version = (at or self.current()).ledger
        if version is None:
            return self.spark.createDataFrame([], LEDGER)
        return self.spark.read.schema(LEDGER).parquet(f"{self.root}/ledger/{version}")

    # ── writing ─────────────────────────────────────────────────────────────────────────────────

    def begin(self) -> Transaction:
        base = self.current()
        number = max(self.numbers(), default=0) + 1
        return Transaction(self, base, number, f"{number:012d}-{uuid.uuid4().hex[:8]}")

    def expire(self, keep: int = 10) -> list[str]:
        """Remove versions that none of the newest ``keep`` pointers needs, unfinished ones included; returns them.

        Readers that still follow an older pointer lose its files, so keep as many as their runs take.
        """
        kept = self.pointers(keep)
        if not kept:
            return []
        needed = {p.version for p in kept} | {p.ledger for p in kept}
        for name in {n for p in kept for n in p.tables}:
            lists = {p.tables[name].ranges for p in kept if name in p.tables}
            needed |= lists
            for version in lists:
                needed |= {r[0] for r in self.ranges(name, version).select("version").distinct().toLocalIterator()}
        gone = set()
        for folder in ("ledger", *(f"{k}/{n}" for k in ("tables", "ranges") for n in self.files.names(f"{self.root}/{k}"))):
            for entry in self.files.names(f"{self.root}/{folder}"):
                version = entry.removeprefix("version=")
                # A transaction that is under way has a higher number than the newest pointer.
                if int(version[:12]) <= kept[0].number and version not in needed:
                    self.files.remove(f"{self.root}/{folder}/{entry}")
                    gone.add(version)
        for number in self.numbers():
            if number < kept[-1].number:
                self.files.remove(f"{self.root}/published/{number:012d}.json")
        return sorted(gone)


class Transaction:
    """Changes that become visible together; see the module's text."""

    def __init__(self, store: TableStore, base: Pointer, number: int, version: str):
        self.store, self.base, self.number, self.version = store, base, number, version
        self.tables = dict(base.tables)
        self.taken, self.takes = base.ledger, 0

    def table(self, name: str, touching: DataFrame | None = None) -> DataFrame:
        """A table as this transaction leaves it so far."""
        return self.store.table(name, touching, Pointer(self.number, self.version, self.taken, self.tables))

    def save(self, df: DataFrame, path: str, *partition_by: str) -> None:
        df.write.partitionBy(*partition_by).parquet(path) if partition_by else df.write.parquet(path)

    def _store_rows(self, name: str, df: DataFrame, state: TableState) -> None:
        """Rows are spread over tasks by range and a hash of the key, so one crowded range is not one task."""
        out = df.select(*[F.col(c).alias(state.stored[c]) for c in df.columns], key_range(state.key, state.width).alias("key_range"))
        if state.key:
            out = out.repartition("key_range", F.pmod(F.xxhash64(state.stored[state.key]), F.lit(16)))
        self.store.files.make_folder(self.store.folder(name))
        self.save(out, f"{self.store.folder(name)}/version={self.version}", "key_range")

    def _publish_ranges(self, name: str, ranges: DataFrame, state: TableState) -> None:
        self.save(ranges.select("key_range", "version", F.lit("live").alias("state")), f"{self.store.root}/ranges/{name}/{self.version}")
        n = self.store.ranges(name, self.version).count()
        self.tables[name] = TableState(**{**vars(state), "ranges": self.version, "n_ranges": n})

    def replace(self, name: str, df: DataFrame, key: str | None = None, width: int = WIDTH) -> None:
        """The whole table anew."""
        names = {c: c for c in df.columns}
        state = TableState(key, width, self.version, 0, df.schema.jsonValue(), names, list(names))
        self._store_rows(name, df, state)
        rows = self.store.spark.read.schema("key_range long").option("basePath", f"{self.store.folder(name)}/version={self.version}")
        ranges = rows.parquet(f"{self.store.folder(name)}/version={self.version}").distinct()
        self._publish_ranges(name, ranges.withColumn("version", F.lit(self.version)), state)

    def upsert(self, name: str, source: DataFrame) -> None:
        """Rows of ``source`` put in or replaced by key; only the ranges of its keys are written.

        ``source`` is read more than once: a written table.
        """
        state = self.tables[name]
        old_types = {f.name: f.dataType for f in state.columns}
        retyped = [f.name for f in source.schema if f.name in old_types and old_types[f.name] != f.dataType]
        stored, used = {}, list(state.used)
        for c in source.columns:
            if c in state.stored and c not in retyped:
                stored[c] = state.stored[c]
            else:
                stored[c] = c if c not in used else f"{c}__{self.number}"
                used.append(stored[c])
        follows = TableState(**{**vars(state), "schema": source.schema.jsonValue(), "stored": stored, "used": used})

        touched = source.select(key_range(state.key, state.width).alias("key_range")).distinct()
        old = self.table(name, touching=None if retyped else source)
        old = old.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in source.schema if f.name in old_types])
        kept = not_in_keys(old, source.select(state.key), state.key).unionByName(source, allowMissingColumns=True)
        self._store_rows(name, kept.select(*source.columns), follows)

        ranges = self.store.ranges(name, state.ranges).select("key_range", "version")
        if retyped:
            touched = touched.union(ranges.select("key_range")).distinct()
        untouched = ranges.join(touched, "key_range", "left_anti")
        self._publish_ranges(name, untouched.unionByName(touched.withColumn("version", F.lit(self.version))), follows)

    def take(self, feed: str, batches: DataFrame) -> DataFrame:
        """Enter the batches (``batch_id``) that the ledger does not have yet and return them (``batch_id``)."""
        ledger = self.store.ledger(Pointer(ledger=self.taken))
        known = ledger.filter(F.col("feed") == feed).select("batch_id")
        new = written(batches.select("batch_id").distinct().join(known, "batch_id", "left_anti"), "new-batches")
        entries = new.select(F.lit(feed).alias("feed"), "batch_id", F.lit("taken").alias("state"))
        self.takes += 1
        at = f"{self.version}-{self.takes}"
        self.save(ledger.unionByName(entries), f"{self.store.root}/ledger/{at}")  # one entry per batch ever landed
        self.taken = at
        return new

    def publish(self) -> Pointer:
        if self.store.current().number != self.base.number:
            raise PublishConflict(f"{self.store.root}: pointer {self.store.current().number} came after {self.base.number}")
        new = Pointer(self.number, self.version, self.taken, self.tables)
        self.store.files.make_folder(f"{self.store.root}/published")
        if not self.store.files.create(f"{self.store.root}/published/{self.number:012d}.json", new.text()):
            raise PublishConflict(f"{self.store.root}: pointer {self.number} exists")
        return new
