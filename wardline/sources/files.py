"""Arriving CSV files: listing, routing, raw lines, headers, cells."""

from __future__ import annotations

import datetime as dt
import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.feeds import FEEDS, FeedConfig
from wardline.functions.text import base_name, blank_to_null, header_name
from wardline.operators.joins import about_group
from wardline.session import written

CSV_OPTIONS = {
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
}
RAGGED = "_ragged"
MANIFEST = "path string, file_name string, size long, modified timestamp_ntz"


def file_manifest(spark: SparkSession, directory: str) -> DataFrame:
    """Name, size and time of each file of a folder, zero-byte files included.

    Spark's file sources skip empty files, so this asks the file system for its listing: one entry
    of metadata per file, never any content.
    """
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(directory)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    rows = []
    for status in fs.listStatus(folder):
        if status.isFile():
            modified = dt.datetime.fromtimestamp(status.getModificationTime() / 1000, dt.timezone.utc)
            rows.append(
                (status.getPath().toString(), status.getPath().getName(), status.getLen(), modified.replace(tzinfo=None))
            )
    return spark.createDataFrame(rows, MANIFEST)


def feed_of(file_name: Column) -> Column:
    """First feed whose name occurs in the file name, whatever its case; NULL if none."""
    out = None
    for cfg in FEEDS.values():
        hit = F.lower(file_name).contains(cfg.name)
        out = F.when(hit, cfg.name) if out is None else out.when(hit, cfg.name)
    return out


def recognised(manifest: DataFrame) -> DataFrame:
    """Files the gate takes: ``.csv`` ending and a known feed."""
    name = F.col("file_name")
    routed = manifest.withColumn("feed", feed_of(name))
    return routed.filter(name.endswith(".csv") & F.col("feed").isNotNull())


def file_name_read() -> Column:
    """Name of the file a row was read from; Spark gives it percent-encoded."""
    return F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))


def placed_lines(df: DataFrame) -> DataFrame:
    """Raw lines with file, upload time and first byte of their block, batch or streaming."""
    return df.select(
        F.col("_metadata.file_path").alias("path"),
        file_name_read().alias("file_name"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("upload_dttm"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.col("value").alias("line"),
    )


def numbered(lines: DataFrame) -> DataFrame:
    """Line numbers that grow within each block (streams number each micro-batch)."""
    return lines.withColumn("line_no", F.monotonically_increasing_id())


def read_lines(spark: SparkSession, directory: str) -> DataFrame:
    return numbered(placed_lines(spark.read.option("pathGlobFilter", "*.csv").text(directory)))


def _width(lines: Column) -> Column:
    """Cells a line can have at most: its commas and one."""
    return F.length(lines) - F.length(F.replace(lines, F.lit(","), F.lit(""))) + 1


def csv_raw_lines_scan(spark: SparkSession, directory: str, columns: int | None = None) -> DataFrame:
    """Every line is data, the header included, in as many columns as the widest line can fill
    (or ``columns``)."""
    files = spark.read.option("pathGlobFilter", "*.csv")
    if columns is None:
        columns = files.text(directory).agg(F.max(_width(F.col("value")))).first()[0] or 1
    schema = ", ".join(f"c{i} string" for i in range(columns))
    df = files.schema(schema).options(**CSV_OPTIONS).csv(directory)
    return df.select(
        file_name_read().alias("file_name"),
        *[blank_to_null(F.col(f"c{i}")).alias(f"c{i}") for i in range(columns)],
    )


def csv_feed_scan(spark: SparkSession, paths: str | list[str], cfg: FeedConfig) -> DataFrame:
    """A feed's files as text columns, header skipped, blanks and ``NULL`` as NULL."""
    schema = ", ".join(f"{c} string" for c in cfg.columns)
    df = spark.read.schema(schema).options(**CSV_OPTIONS, header="true").csv(paths)
    return df.select(
        *[blank_to_null(F.col(c)).alias(c) for c in cfg.columns],
        file_name_read().alias("file_name"),
        F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("upload_dttm"),
    )


def open_quote(line: Column) -> Column:
    """A quote is opened and not closed on the line: the record goes on in the next one."""
    return (F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))) % 2 == 1


def file_heads(lines: DataFrame) -> DataFrame:
    """One row per file of a known feed: first physical line, and whether records span lines.

    Only lines of a file's first block are candidates for the first one; minimum and flag are taken
    on the map side first, so one row per file and task is shuffled. The flag is a set of two values at
    most: with a set Spark aggregates by hash, where the minimum of lines alone would have every line sorted.
    """
    first = F.when(F.col("block_start") == 0, F.struct("line_no", "line"))
    heads = lines.groupBy("file_name").agg(
        F.first("path").alias("path"),
        F.max("file_size").alias("size"),
        F.max("upload_dttm").alias("upload_dttm"),
        F.min(first)["line"].alias("first_line"),
        F.array_contains(F.collect_set(open_quote(F.col("line"))), True).alias("multiline"),
    )
    known = heads.withColumn("feed", feed_of(F.col("file_name"))).filter(F.col("feed").isNotNull())
    return known.select("file_name", "feed", "path", "size", "upload_dttm", "first_line", "multiline")


def file_header(heads: DataFrame) -> DataFrame:
    """``heads`` with ``header``: the first line's names, all of them, lower-case and without blanks.

    ``heads`` is read twice (for the widest line, then for the names): a written table.
    """
    width = heads.agg(F.max(_width(F.col("first_line")))).first()[0] or 1
    columns = [f"c{i}" for i in range(width)]
    cells = F.from_csv("first_line", F.lit(", ".join(f"{c} string" for c in columns)), {**CSV_OPTIONS, "mode": "PERMISSIVE"})
    names = F.transform(F.array(*[F.col("_cells")[c] for c in columns]), header_name)
    found = F.filter(names, lambda x: x.isNotNull() & (x != ""))
    return heads.withColumn("_cells", cells).withColumn("header", found).drop("_cells", "first_line")


def _literal(path: str) -> str:
    """A file's address as a path that the reader takes word for word."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(path))


def staged_rows(headers: DataFrame) -> DataFrame:
    """Data records of the files as cells; ``ragged`` marks those with another number of cells than the header.

    Spark's CSV reader cuts the records: files are read together by feed and header width, whole ones (a
    record may then hold line ends) apart from those that can be split at every line. Empty lines are no
    records. To be written where checks and load both read it.
    """
    spark = headers.sparkSession
    groups: dict[tuple[str, int, bool], list[str]] = {}
    for r in headers.select("path", "feed", F.size("header").alias("n"), "multiline").toLocalIterator():
        groups.setdefault((r["feed"], max(r["n"], 1), r["multiline"]), []).append(_literal(r["path"]))
    out = None
    for (feed, n, multiline), paths in sorted(groups.items()):
        columns = [f"c{i}" for i in range(n)]
        reader = spark.read.schema(", ".join(f"{c} string" for c in [*columns, RAGGED])).options(
            **CSV_OPTIONS, header="true", multiLine=str(multiline).lower(), mode="PERMISSIVE",
            columnNameOfCorruptRecord=RAGGED, columnPruning="false",
        )
        rows = reader.csv(paths).select(
            file_name_read().alias("file_name"),
            F.lit(feed).alias("feed"),
            F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("upload_dttm"),
            F.array(*[blank_to_null(F.col(c)) for c in columns]).alias("cells"),
            F.col(RAGGED).isNotNull().alias("ragged"),
        )
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        out = spark.createDataFrame([], "file_name string, feed string, upload_dttm timestamp_ntz, cells array<string>, ragged boolean")
    return out


def read_files(lines: DataFrame, store: bool = True) -> tuple[DataFrame, DataFrame]:
    """(headers, staged rows) of the files of ``lines``, both written; without ``store``, for a caller that
    needs headers only, the rows stay in the files.

    A task stages files of one feed, so a filter on the feed skips the others' files by their statistics;
    folders per feed would have every task sort its rows.
    """
    headers = written(file_header(written(file_heads(lines), "heads")), "headers")
    staged = staged_rows(headers)
    return headers, written(staged, "staged") if store else staged


def ragged_counts(staged: DataFrame) -> DataFrame:
    """(file_name, kept, ragged): records with the header's number of cells, and others."""
    return staged.groupBy("file_name").agg(F.count_if(~F.col("ragged")).alias("kept"), F.count_if("ragged").alias("ragged"))


def lenient_load(staged: DataFrame) -> DataFrame:
    """Rows with the right number of cells; the others are skipped here and counted by ``ragged_counts``."""
    return staged.filter(~F.col("ragged")).drop("ragged")


def named_cells(staged: DataFrame, headers: DataFrame, cfg: FeedConfig) -> DataFrame:
    """The feed's columns by header name, not by position; a missing one is NULL."""
    h = headers.filter(F.col("feed") == cfg.name).select("file_name", "header")
    rows = about_group(lenient_load(staged).filter(F.col("feed") == cfg.name), h, "file_name")
    at = lambda c: F.get(F.col("cells"), F.nullif(F.array_position("header", c), F.lit(0)).cast("int") - 1)
    return rows.select(*[at(c).alias(c) for c in cfg.columns], "file_name", "upload_dttm")


def with_load_stamp(df: DataFrame, load_dttm: Column) -> DataFrame:
    """One stamp per batch, fixed on the driver."""
    return df.withColumn("load_dttm", load_dttm.cast("timestamp_ntz"))


def path_base_name(df: DataFrame, path: str) -> DataFrame:
    return df.withColumn("file_name", base_name(F.col(path)))
