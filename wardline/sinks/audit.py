"""Audit tables and alert messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.functions.text import without_quotes
from wardline.operators.checks import PASSED

# Table layouts and message texts.
FILE_LOG = (
    "run_id string, file_name string, feed_type string, status string, rows_loaded long, checks_passed long, "
    "checks_failed long, failed_checks string, action string, processed_at timestamp_ntz"
)
CHECK_LOG = (
    "run_id string, file_name string, feed_type string, check_name string, check_tier string, "
    "check_result string, detail string, checked_at timestamp_ntz"
)
ERROR_LOG = (
    "dag_id string, task_id string, status string, triggered_by string, attempt string, error_summary string, "
    "action string, failed_at timestamp_ntz"
)
RECIPIENTS = "recipient_email string, alert_type string, is_active boolean, added_at timestamp_ntz"
LOADED_ACTION = "Loaded successfully; file archived to processed/."
QUARANTINE_ACTION = "File moved to quarantine/ folder. Review and re-upload a corrected file."
FAILURE_ALERT = "DQ_FAILURE"
OUTBOX = "alert_type string, subject string, body string, recipients array<string>"


def file_log(verdicts: DataFrame, loaded: DataFrame, run_id: str, at: Column) -> DataFrame:
    """One row per file. ``loaded``: ``file_name, n``, the rows kept of each file."""
    n = loaded.select(F.col("file_name").alias("_f"), F.col("n"))
    ok = F.col("status") == PASSED
    return verdicts.join(n, F.col("file_name") == F.col("_f"), "left").select(
        F.lit(run_id).alias("run_id"),
        "file_name",
        F.col("feed").alias("feed_type"),
        "status",
        F.when(ok, F.coalesce("n", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("rows_loaded"),
        "checks_passed",
        "checks_failed",
        F.when(ok, "").otherwise(F.col("failed_checks")).alias("failed_checks"),
        F.when(ok, LOADED_ACTION).otherwise(QUARANTINE_ACTION).alias("action"),
        at.cast("timestamp_ntz").alias("processed_at"),
    )


def check_log(checks: DataFrame, run_id: str, at: Column) -> DataFrame:
    """One row per check, written for all files in one append."""
    return checks.select(
        F.lit(run_id).alias("run_id"),
        "file_name",
        F.col("feed").alias("feed_type"),
        "check_name",
        F.col("tier").alias("check_tier"),
        F.when(F.col("passed"), "PASS").otherwise("FAIL").alias("check_result"),
        "detail",
        at.cast("timestamp_ntz").alias("checked_at"),
    )


def active_recipients(recipients: DataFrame, alert_type: str = FAILURE_ALERT) -> DataFrame:
    return recipients.filter((F.col("alert_type") == alert_type) & F.col("is_active"))


def _row(label: str, value: Column) -> Column:
    return F.concat(F.lit(f"  {label:<16}"), value.cast("string"))


def addressed(messages: DataFrame, recipients: DataFrame, alert_type: str = FAILURE_ALERT) -> DataFrame:
    """Messages with the list of active recipients. Each text is stored once, however many it goes to."""
    emails = active_recipients(recipients, alert_type).agg(F.array_sort(F.collect_list("recipient_email")).alias("recipients"))
    return messages.withColumn("recipients", emails.scalar())


def quarantine_messages(log: DataFrame, alert_type: str = FAILURE_ALERT) -> DataFrame:
    """One message per file that did not load, quotes removed; delivery is not done here."""
    stamp = F.date_format("processed_at", "yyyy-MM-dd HH:mm:ss")
    body = F.concat_ws(
        "\n",
        F.lit("Healthcare GATEKEEPER validation FAILED - file quarantined.\n"),
        _row("File:", F.col("file_name")),
        _row("Feed:", F.col("feed_type")),
        _row("Status:", F.concat("status", F.lit(" (not loaded)"))),
        _row("Checks passed:", F.col("checks_passed")),
        _row("Checks failed:", F.col("checks_failed")),
        F.concat(_row("Quarantined at:", stamp), F.lit("\n")),
        F.lit("  Failed checks:"),
        F.concat(F.col("failed_checks"), F.lit("\n")),
        F.concat(F.lit("  Action: "), F.col("action")),
    )
    return log.filter(F.col("status") != PASSED).select(
        "run_id",
        "file_name",
        F.lit(alert_type).alias("alert_type"),
        without_quotes(F.concat(F.lit("GATEKEEPER QUARANTINE - "), F.col("file_name"))).alias("subject"),
        without_quotes(body).alias("body"),
    )


def alert_outbox(log: DataFrame, recipients: DataFrame, alert_type: str = FAILURE_ALERT) -> DataFrame:
    """One row per quarantined file and active recipient, as delivery reads it."""
    told = addressed(quarantine_messages(log, alert_type), recipients, alert_type)
    return told.select("run_id", "file_name", F.explode("recipients").alias("recipient_email"), "subject", "body")


def _logs_place() -> Column:
    return F.concat(F.lit("Open Airflow > "), F.col("dag_id"), F.lit(" > "), F.col("task_id"))


def failure_action(of_gate: Column) -> Column:
    """What to do about a failed task: the gate's own words, or the transform's."""
    gate = F.lit(" > Logs for the full error, fix the issue, then re-run.")
    other = F.lit(" > Logs for the full stack trace, fix the issue, then re-run the pipeline.")
    return F.concat(_logs_place(), F.when(of_gate, gate).otherwise(other))


def _attempt() -> Column:
    return F.format_string("%d of %d", F.col("try_no").cast("int"), F.col("max_tries").cast("int"))


def error_log(failures: DataFrame, at: Column) -> DataFrame:
    """One row per task failure: ``dag_id, task_id, triggered_by, try_no, max_tries, root_cause`` and, if some
    are the gate's, ``of_gate``."""
    of_gate = F.col("of_gate") if "of_gate" in failures.columns else F.lit(False)
    return failures.select(
        "dag_id",
        "task_id",
        F.lit("FAILED").alias("status"),
        "triggered_by",
        _attempt().alias("attempt"),
        F.col("root_cause").alias("error_summary"),
        failure_action(of_gate).alias("action"),
        at.cast("timestamp_ntz").alias("failed_at"),
    )


def failure_messages(failures: DataFrame, at: Column, alert_type: str = FAILURE_ALERT) -> DataFrame:
    """One message per task failure (see ``error_log``), quotes removed."""
    gate = F.col("of_gate") if "of_gate" in failures.columns else F.lit(False)
    pick = lambda a, b: F.when(gate, F.lit(a)).otherwise(F.lit(b))
    stamp = F.date_format(at.cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss")
    body = F.concat_ws(
        "\n",
        pick("Healthcare GATEKEEPER pipeline FAILED - ingestion halted.\n", "Healthcare AIRFLOW pipeline FAILED - transform halted.\n"),
        _row("DAG:", F.col("dag_id")),
        _row("Failed task:", F.col("task_id")),
        _row("Status:", F.lit("FAILED (downstream steps skipped)")),
        _row("Triggered by:", F.col("triggered_by")),
        _row("Attempt:", _attempt()),
        F.concat(_row("Failed at:", stamp), F.lit("\n")),
        pick("  What happened:", "  Root cause:"),
        F.concat(F.lit("    - "), F.col("root_cause"), F.lit("\n")),
        F.concat(F.lit("  Action: "), failure_action(gate)),
    )
    subject = F.concat(pick("Gatekeeper Pipeline FAILED - ", "Airflow Pipeline FAILED - "), F.col("task_id"))
    return failures.select(
        "dag_id", "task_id", F.lit(alert_type).alias("alert_type"), without_quotes(subject).alias("subject"), without_quotes(body).alias("body")
    )


def append_log(log: DataFrame, path: str, batch_id: str) -> None:
    """Append a batch of log rows; a retried batch replaces its own partition."""
    (
        log.withColumn("batch_id", F.lit(batch_id))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(path)
    )


def insert_if_empty(table: DataFrame, rows: DataFrame) -> DataFrame:
    """``table`` plus ``rows``, the latter only if ``table`` holds nothing."""
    return table.unionByName(rows.filter(~table.exists()))
