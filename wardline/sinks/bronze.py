"""Typed, all-or-nothing load into the landing tables."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.feeds import LINEAGE, FeedConfig
from wardline.functions.numbers import try_number
from wardline.operators.joins import not_in_keys
from wardline.session import scratch_path, written
from wardline.sinks.store import Files


QUOTED = 20  # faults that an error message quotes; its table has all


class StrictLoadError(ValueError):
    """Rows that cannot be typed; nothing was written."""


def typed_rows(named: DataFrame, cfg: FeedConfig) -> DataFrame:
    """Typed business columns; ``bad_columns`` lists those a row cannot fill without loss."""
    typed, bad = [], []
    for f in cfg.fields:
        c = F.col(f.name)
        if f.number:
            value = try_number(c, f.number)
            wrong = c.isNotNull() & value.isNull()
            typed.append(value.cast(f.spark_type).alias(f.name))
        else:
            wrong = F.coalesce(F.length(c) > f.width, F.lit(False))
            typed.append(c.alias(f.name))
        bad.append(F.when(wrong, F.lit(f.name)))
    rest = [c for c in named.columns if c not in cfg.columns]
    return named.select(*typed, *rest, F.array_compact(F.array(*bad)).alias("bad_columns"))


def rejected_rows(typed: DataFrame) -> DataFrame:
    return typed.filter(F.size("bad_columns") > 0)


def load_problems(typed: DataFrame) -> DataFrame:
    """Rows that would abort the load, counted per file and column."""
    bad = rejected_rows(typed).select("file_name", F.explode("bad_columns").alias("column_name"))
    return bad.groupBy("file_name", "column_name").agg(F.count(F.lit(1)).alias("bad_rows"))


def strict_load(named: DataFrame, cfg: FeedConfig) -> DataFrame:
    """All rows typed, or an error that names where all files and columns at fault are listed.

    The complete list is a written table; the message quotes its largest entries.
    """
    typed = typed_rows(named, cfg)
    path = scratch_path(named.sparkSession, "load-problems")
    load_problems(typed).write.parquet(path)
    problems = named.sparkSession.read.parquet(path)
    worst = problems.orderBy(F.desc("bad_rows"), "file_name", "column_name").limit(QUOTED).collect()
    if worst:
        listing = "; ".join(f"{r['file_name']}: {r['bad_rows']} rows with bad {r['column_name']}" for r in worst)
        raise StrictLoadError(f"{cfg.name} not loaded, {problems.count()} faults listed in {path}: {listing}")
    return typed.drop("bad_columns")


def loadable(named: DataFrame, ragged: DataFrame, cfg: FeedConfig) -> tuple[DataFrame, DataFrame]:
    """(typed rows of the files that load, faults of the others).

    A file loads whole or not at all, and by itself: ``named`` rows that cannot be typed or ``ragged`` ones
    (``file_name, ragged``) keep their own file out, no other. Faults: ``file_name, column_name, bad_rows``
    (the column is NULL for ragged rows), a written table.
    """
    typed = typed_rows(named, cfg)
    uneven = ragged.filter("ragged > 0").select("file_name", F.lit(None).cast("string").alias("column_name"), F.col("ragged").alias("bad_rows"))
    faults = written(load_problems(typed).unionByName(uneven), "load-faults")
    return not_in_keys(typed.drop("bad_columns"), faults.select("file_name").distinct(), "file_name"), faults


def append_with_count(rows: DataFrame, path: str, batch_id: str) -> int:
    """Append one batch and return how many rows this load added.

    The count is observed while writing, not by counting the table before and after. The batch is
    a partition of its own, so a retried batch replaces itself instead of doubling.
    """
    seen = Observation()
    out = rows.observe(seen, F.count(F.lit(1)).alias("rows"))
    (
        out.withColumn("batch_id", F.lit(batch_id))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(path)
    )
    return seen.get["rows"]


def landed_batches(spark: SparkSession, path: str) -> DataFrame:
    """(batch_id): the batches of a landing table, from the names of its folders."""
    names = [n.removeprefix("batch_id=") for n in Files(spark, path).names(path) if n.startswith("batch_id=")]
    return spark.createDataFrame([(unquote(n),) for n in names], "batch_id string")


def read_landing(spark: SparkSession, path: str, cfg: FeedConfig, batches: DataFrame | None = None) -> DataFrame:
    """A landing table (empty if nothing has landed), or its rows of ``batches`` (``batch_id``), whose
    folders alone are read."""
    if not Files(spark, path).exists(path):
        return spark.createDataFrame([], cfg.landing_schema)
    schema = T.StructType(list(cfg.landing_schema.fields) + [T.StructField("batch_id", T.StringType())])
    df = spark.read.schema(schema).parquet(path)
    if batches is not None:
        df = df.join(batches.filter("batch_id > ''").select("batch_id"), "batch_id")
    return df.select(*cfg.columns, *LINEAGE)
