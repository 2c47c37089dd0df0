"""The gate and the cleaning step on arriving files, as a Structured Streaming job.

A file is listed in exactly one micro-batch and arrives whole, so per-file checks see all of it.
Everything a batch writes is keyed by the batch number; a repeated batch replaces its own output.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wardline.feeds import ADMISSIONS, CLAIMS, TREATMENTS, GateLimits
from wardline.operators import incremental as inc
from wardline.plans import silver
from wardline.plans.ingest import GateRun, Stores, gate_batch, utc_now
from wardline.plans.pipeline import bring_up_to_date
from wardline.sinks.store import Files, TableStore
from wardline.sources import files

MANIFEST = ["file_name", "size"]


def _batch_manifest(spark: SparkSession, headers: DataFrame, incoming: str, stores: Stores) -> DataFrame:
    """Files of the micro-batch, and empty files of the folder that no log knows yet.

    An empty file has no line and so never shows up in the stream itself; it is picked up along
    with the next batch.
    """
    seen = headers.select(*MANIFEST)
    empty = files.file_manifest(spark, incoming).filter("size = 0").select(*MANIFEST)
    if Files(spark, stores.root).exists(stores.log("file_processing_log")):
        log = spark.read.parquet(stores.log("file_processing_log")).select(F.col("file_name").alias("_f"))
        empty = empty.join(log, F.col("file_name") == F.col("_f"), "left_anti")
    return files.recognised(seen.unionByName(empty))


def gate_stream(
    spark: SparkSession,
    incoming: str,
    stores: Stores,
    checkpoint: str,
    limits: GateLimits = GateLimits(),
    clock: Callable[[], dt.datetime] = utc_now,
    after: Callable[[str, dt.datetime], None] | None = None,
    files_per_batch: int | None = None,
    on_run: Callable[[GateRun], None] | None = None,
) -> StreamingQuery:
    """Check and load what has arrived, then stop; run again (or on a timer) for what comes later.

    ``after`` is called with the batch id once its rows have landed. Batch ids hold the query's id, which
    lives in the checkpoint: a new checkpoint starts new batches and replaces none.
    """
    reader = spark.readStream.option("pathGlobFilter", "*.csv")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    arriving = files.placed_lines(reader.text(incoming))

    def handle(batch: DataFrame, number: int) -> None:
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or ""
        batch_id, at = f"batch-{query[:8]}-{number:08d}", clock()
        manifest = lambda headers: _batch_manifest(spark, headers, incoming, stores)
        run = gate_batch(files.numbered(batch), manifest, stores, batch_id, at, limits, keep_lines=True)
        if after:
            after(batch_id, at)
        if on_run:
            on_run(run)

    return (
        arriving.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def silver_upsert(spark: SparkSession, stores: Stores, as_of: str | None = None) -> Callable[[str, dt.datetime], None]:
    """Bring the cleaned tables up to date with what has landed.

    Each landed batch is taken once: the ledger is published together with the rows. A repeated batch finds
    itself taken, and a step that stopped half way has published nothing.
    """

    def step(batch_id: str, at: dt.datetime) -> None:
        today = F.lit(as_of or at.date().isoformat()).cast("date")
        models = {
            ADMISSIONS: (
                "stg_admissions",
                lambda rows: silver.stg_admissions(rows, today),
                lambda target, rows: inc.rewritten_admissions(target, rows, today),
            ),
            TREATMENTS: ("stg_treatments", silver.stg_treatments, inc.rewritten_treatments),
            CLAIMS: ("stg_claims", silver.stg_claims, lambda target, rows: inc.rewritten_claims(rows)),
        }
        for cfg, model in models.items():
            bring_up_to_date(TableStore(spark, stores.root), stores, cfg, *model)

    return step
