"""Failed tasks: their causes mined from task logs, an error log, and messages to send."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.operators import lognotes
from wardline.plans.ingest import Stores, recipients
from wardline.session import written
from wardline.sinks import audit

# Task logs lie in <logs>/dag_id=<dag>/run_id=<run>/task_id=<task>/attempt=<n>.log
TASK = ("dag_id", "run_id", "task_id")
FAILED = "dag_id string, run_id string, task_id string, triggered_by string, try_no int, max_tries int"
GATE_TASKS = tuple(lognotes.MEANINGS)


def failed_tasks(spark: SparkSession, path: str) -> DataFrame:
    """The scheduler's list of failed tasks, a CSV file with a header."""
    return spark.read.schema(FAILED).csv(path, header=True)


def log_lines(spark: SparkSession, logs: str) -> DataFrame:
    """(dag_id, run_id, task_id, line_no, line) of all task logs; lines keep their order within a file.

    The names come out of the path, so that a folder may hold any number of tasks."""
    lines = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "attempt=*.log").text(logs)
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    parts = [F.regexp_extract(path, rf"/{name}=([^/]+)/", 1).alias(name) for name in TASK]
    attempt = F.regexp_extract(path, r"attempt=(\d+)\.log$", 1).cast("long")
    at = F.struct(attempt.alias("attempt"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("n"))
    return lines.select(*parts, at.alias("line_no"), F.col("value").alias("line"))


def explained(failed: DataFrame, lines: DataFrame) -> DataFrame:
    """Failed tasks with ``root_cause`` and ``of_gate``: a gate task's meaning, another's errors as its log names them."""
    causes = lognotes.root_causes(lines, *TASK, tasks=failed)
    same = F.lit(True)
    for k in TASK:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    found = causes.select(*[F.col(k).alias(f"_{k}") for k in TASK], F.col("root_cause").alias("_cause"))
    of_gate = F.col("task_id").isin(*GATE_TASKS) | F.col("dag_id").startswith("gatekeeper")
    told = failed.join(found, same, "left").withColumn("of_gate", F.coalesce(of_gate, F.lit(False)))
    cause = F.when(F.col("of_gate"), lognotes.failure_meaning(F.col("task_id"))).otherwise(F.col("_cause"))
    return told.withColumn("root_cause", cause).drop("_cause", *[f"_{k}" for k in TASK])


def record(spark: SparkSession, stores: Stores, failures: DataFrame, batch_id: str, at: dt.datetime) -> DataFrame:
    """Error-log rows and messages of ``failures``; a repeated batch replaces its own. Returns the rows."""
    stamp = F.lit(at).cast("timestamp_ntz")
    failures = written(failures, "failures")
    audit.append_log(audit.error_log(failures, stamp), stores.log("pipeline_error_log"), batch_id)
    told = audit.addressed(audit.failure_messages(failures, stamp), recipients(spark, stores))
    audit.append_log(told.drop("dag_id", "task_id"), stores.log("alert_outbox"), batch_id)
    return spark.read.parquet(stores.log("pipeline_error_log")).filter(F.col("batch_id") == batch_id).drop("batch_id")


def mine(spark: SparkSession, logs: str, failed: str, stores: Stores, batch_id: str, at: dt.datetime) -> DataFrame:
    return record(spark, stores, explained(failed_tasks(spark, failed), log_lines(spark, logs)), batch_id, at)


def of_step(spark: SparkSession, step: str, error: BaseException) -> DataFrame:
    """A step of this program that failed, as a row for ``record``."""
    row = ("wardline", None, step, "manual", 1, 1, f"{type(error).__name__}: {error}".split("\n")[0], False)
    return spark.createDataFrame([row], f"{FAILED}, root_cause string, of_gate boolean")
