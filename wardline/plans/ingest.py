"""Arriving files to landing tables: check all, load the good, set the bad aside, log everything."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.feeds import FEEDS, GateLimits
from wardline.operators import checks as c
from wardline.operators.joins import in_keys
from wardline.session import written
from wardline.sinks import audit, bronze, route
from wardline.sinks.store import Files
from wardline.sources import files


def new_run_id() -> str:
    return uuid.uuid4().hex[:8]


def utc_now() -> dt.datetime:
    """Taken once per run on the driver, so every row of a batch gets the same stamp."""
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def run_stamp(at: dt.datetime) -> str:
    return at.strftime("%Y%m%d_%H%M%S")


@dataclass
class GateRun:
    run_id: str
    files_seen: int = 0
    rows_loaded: int = 0
    loaded: dict[str, int] = field(default_factory=dict)
    files_quarantined: int = 0

    @property
    def any_quarantined(self) -> bool:
        return self.files_quarantined > 0


@dataclass(frozen=True)
class Stores:
    """Where a run writes."""

    root: str

    def landing(self, feed: str) -> str:
        return f"{self.root}/raw/{feed}"

    def log(self, name: str) -> str:
        return f"{self.root}/audit/{name}"

    def batch(self, batch_id: str) -> str:
        return f"{self.root}/batches/{batch_id}"

    @property
    def files(self) -> str:
        return f"{self.root}/files"


def recipients(spark: SparkSession, stores: Stores) -> DataFrame:
    path = stores.log("email_recipient_log")
    if not Files(spark, stores.root).exists(path):
        return spark.createDataFrame([], audit.RECIPIENTS)
    return spark.read.schema(audit.RECIPIENTS).parquet(path)


def seed_recipients(spark: SparkSession, stores: Stores, emails: list[str], at: dt.datetime) -> None:
    """Enter first recipients of failure alerts; a table that has some is left alone."""
    rows = spark.createDataFrame([(e, audit.FAILURE_ALERT, True, at) for e in emails], audit.RECIPIENTS)
    if recipients(spark, stores).isEmpty():
        audit.insert_if_empty(recipients(spark, stores), rows).write.mode("overwrite").parquet(stores.log("email_recipient_log"))


def planned(
    spark: SparkSession, stores: Stores, batch_id: str, manifest: Callable[[], DataFrame], at: dt.datetime
) -> tuple[DataFrame, dt.datetime]:
    """The files and the load stamp of a batch, written down when it is first tried.

    A repeated batch takes the same files at the same stamp, whatever has arrived meanwhile, so its
    rows replace themselves and never change under those who have taken them.
    """
    path = f"{stores.batch(batch_id)}/files"
    if not Files(spark, stores.root).exists(f"{path}/_SUCCESS"):
        manifest().withColumn("at", F.lit(at).cast("timestamp_ntz")).write.mode("overwrite").parquet(path)
    plan = spark.read.parquet(path)
    first = plan.select("at").first()
    return plan.drop("at"), first["at"] if first else at


def gated(spark: SparkSession, stores: Stores, batch_id: str) -> bool:
    """Whether all rows and log entries of the batch are written."""
    return Files(spark, stores.root).exists(f"{stores.batch(batch_id)}/gated")


def gate_result(spark: SparkSession, stores: Stores, batch_id: str) -> GateRun:
    """What the log says of a batch."""
    run = GateRun(run_id=batch_id)
    if Files(spark, stores.root).exists(stores.log("file_processing_log")):
        log = spark.read.parquet(stores.log("file_processing_log")).filter(F.col("run_id") == batch_id)
        summary = c.run_summary(log).first()
        if summary:
            run.files_seen, run.files_quarantined = summary["files_seen"], summary["files_quarantined"]
        run.loaded = {r[0]: r[1] for r in log.groupBy("feed_type").agg(F.sum("rows_loaded")).collect()}
        run.rows_loaded = sum(run.loaded.values())
    return run


def gate_batch(
    lines: DataFrame,
    manifest: Callable[[DataFrame], DataFrame],
    stores: Stores,
    batch_id: str,
    at: dt.datetime,
    limits: GateLimits = GateLimits(),
    keep_lines: bool = False,
) -> GateRun:
    """One batch of files through the gate. Safe to repeat with the same ``batch_id``: see ``planned``.

    One pass over the text finds headers and files whose records span lines; the records are then read
    once, into a table that checks and load share. ``manifest`` is called with the headers. A file that
    passes the checks and cannot be loaded whole, because of ragged or untypable rows, is kept out by itself; its
    faults are logged with the checks. With ``keep_lines`` the lines of files that don't load are written
    out, for sources that leave no file to move.
    """
    spark = lines.sparkSession
    if gated(spark, stores, batch_id):
        return gate_result(spark, stores, batch_id)
    headers, staged = files.read_files(lines)
    manifest, at = planned(spark, stores, batch_id, lambda: manifest(headers), at)
    stamp = F.lit(at).cast("timestamp_ntz")
    plan = written(c.file_plan(manifest, headers), "file-plan")
    results = written(c.check_rows(plan, staged, limits), "checks")
    checked = written(c.file_verdicts(results), "verdicts")
    counts = written(files.ragged_counts(staged), "row-counts")

    good = written(checked.filter(F.col("status") == c.PASSED).select("file_name"), "good-files")
    loading = in_keys(headers, good, "file_name")  # few: the rows meet their files' headers only
    ready, faults = {}, None
    for cfg in FEEDS.values():
        rows = files.named_cells(staged, loading, cfg)
        ragged = in_keys(counts.filter(files.feed_of(F.col("file_name")) == cfg.name), good, "file_name")
        ready[cfg.name], bad = bronze.loadable(files.with_load_stamp(rows, stamp), ragged, cfg)
        faults = bad if faults is None else faults.unionByName(bad)
    found = written(c.load_faults(faults, checked), "load-checks")
    verdicts = written(c.after_load(checked, found), "load-verdicts")
    run = GateRun(run_id=batch_id)
    for feed, rows in ready.items():
        run.loaded[feed] = bronze.append_with_count(rows, stores.landing(feed), batch_id)
    run.rows_loaded = sum(run.loaded.values())
    if keep_lines:
        bad = verdicts.filter(F.col("status") != c.PASSED)
        route.write_lines(route.routed_lines(lines, bad, f"{run_stamp(at)}_{batch_id}"), stores.files)
    log = written(audit.file_log(verdicts, counts.withColumnRenamed("kept", "n"), batch_id, stamp), "file-log")
    audit.append_log(audit.check_log(results.unionByName(found), batch_id, stamp), stores.log("dq_metrics_log"), batch_id)
    audit.append_log(log, stores.log("file_processing_log"), batch_id)
    told = audit.addressed(audit.quarantine_messages(log), recipients(spark, stores))
    audit.append_log(told.drop("run_id", "file_name"), stores.log("alert_outbox"), batch_id)
    Files(spark, stores.root).create(f"{stores.batch(batch_id)}/gated", "")
    summary = c.run_summary(log).first()
    if summary:
        run.files_seen, run.files_quarantined = summary["files_seen"], summary["files_quarantined"]
    return run


def run_gate(
    spark: SparkSession,
    incoming: str,
    stores: Stores,
    run_id: str | None = None,
    at: dt.datetime | None = None,
    limits: GateLimits = GateLimits(),
    move: bool = True,
) -> GateRun:
    """Check and load the files of a folder, then move each one to processed/ or quarantine/.

    A run that stopped while moving files goes on with the rest when repeated under its id."""
    run_id, at = run_id or new_run_id(), at or utc_now()
    if not gated(spark, stores, run_id):
        manifest = written(files.recognised(files.file_manifest(spark, incoming)), "manifest")
        if manifest.isEmpty():
            return GateRun(run_id=run_id)
        run = gate_batch(files.read_lines(spark, incoming), lambda _: manifest, stores, run_id, at, limits)
    else:
        run = gate_result(spark, stores, run_id)
    if move:
        log = spark.read.parquet(stores.log("file_processing_log")).filter(F.col("batch_id") == run_id)
        stamp = log.agg(F.max("processed_at")).first()[0] or at
        route.move_files(spark, log, incoming, stores.files, run_stamp(stamp))
    return run


def preflight(spark: SparkSession, incoming: str) -> DataFrame:
    """Read-only header comparison of a folder."""
    manifest = files.file_manifest(spark, incoming).withColumn("feed", files.feed_of(F.col("file_name")))
    text = spark.read.option("pathGlobFilter", "*.[cC][sS][vV]").text(incoming)
    heads = written(files.file_heads(files.numbered(files.placed_lines(text))), "heads")
    return c.preflight_header_diff(manifest, files.file_header(heads))


def problem_count(diff: DataFrame) -> DataFrame:
    return diff.agg(F.count_if(F.col("verdict") == "WARN").alias("problems"))
