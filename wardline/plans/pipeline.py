"""Landing tables to tested star schema, as one run over stored tables.

Order: cleaned tables, dimensions, facts, doctor snapshot, doctor history, enriched fact, tests. The
history is built after the snapshot of the same run, so the first run works and none lags behind.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.feeds import ADMISSIONS, CLAIMS, FEEDS, TREATMENTS, FeedConfig
from wardline.operators import data_tests
from wardline.operators import incremental as inc
from wardline.plans import gold, silver
from wardline.plans.ingest import Stores
from wardline.session import written
from wardline.sinks import bronze
from wardline.sinks.store import TableStore
from wardline.sources.seeds import seed_scan
from wardline.sources.spine import DEFAULT_DAYS, DEFAULT_START, date_spine

FRESH = ("batches", "watermark")  # what a step takes: batches the ledger lacks, or rows beyond the newest stamp


def bring_up_to_date(
    store: TableStore,
    stores: Stores,
    cfg: FeedConfig,
    name: str,
    build: Callable[[DataFrame], DataFrame],
    rewrite: Callable[[DataFrame, DataFrame], DataFrame],
    to_fact: Callable[[DataFrame], DataFrame] | None = None,
    full: bool = False,
    fresh_by: str = "batches",
) -> None:
    """Cleaned table of a feed, its fact and the ledger of taken batches, published as one.

    Only touched rows are rewritten unless ``full`` or new. By default each landed batch is taken
    once, in whatever order batches land; ``fresh_by="watermark"`` takes rows beyond the table's newest load
    stamp instead, and so misses batches that land late.
    """
    if fresh_by not in FRESH:
        raise ValueError(f"fresh_by is one of {FRESH}")
    spark, path = store.spark, stores.landing(cfg.name)
    fact = name.replace("stg_", "fct_")
    tx = store.begin()
    new = tx.take(cfg.name, bronze.landed_batches(spark, path))
    if full or name not in tx.tables or (to_fact and fact not in tx.tables):
        tx.replace(name, build(bronze.read_landing(spark, path, cfg)), cfg.key)
        if to_fact:
            tx.replace(fact, to_fact(tx.table(name)), cfg.key)
        tx.publish()
        return
    target = tx.table(name)
    if fresh_by == "watermark":
        fresh = inc.watermark_filter(bronze.read_landing(spark, path, cfg), target)
    else:
        fresh = inc.still_newest(bronze.read_landing(spark, path, cfg, new), target, cfg.key)
    rows = written(rewrite(target, fresh), "rewritten")
    if not rows.isEmpty():
        tx.upsert(name, rows)
        if to_fact:
            # the fact is compared in the ranges of the rewritten rows only
            changed = written(inc.incr_facts(tx.table(fact, touching=rows), rows, to_fact, cfg.key), "changed")
            if not changed.isEmpty():
                tx.upsert(fact, changed)
    tx.publish()


@dataclass(frozen=True)
class Pipeline:
    spark: SparkSession
    stores: Stores
    seeds: str  # folder with seed_doctors.csv, seed_hospitals.csv, seed_insurers.csv
    calendar_start: str = DEFAULT_START
    calendar_days: int = DEFAULT_DAYS
    fresh_by: str = "batches"

    @property
    def store(self) -> TableStore:
        return TableStore(self.spark, self.stores.root)

    def table(self, name: str) -> DataFrame:
        return self.store.table(name)

    # ── snapshot: one folder per run, never rewriting the one it reads ──────────────────────────

    def _snapshots(self) -> str:
        return f"{self.stores.root}/snapshots/scd_doctors"

    def _runs(self) -> list[str]:
        fs = self.store.files
        names = fs.names(self._snapshots())
        return [n for n in names if n.startswith("run-") and fs.exists(f"{self._snapshots()}/{n}/_SUCCESS")]

    def snapshot(self, run_ts: dt.datetime, doctors: DataFrame) -> DataFrame:
        """Compare with the newest snapshot before ``run_ts``; repeating a run gives the same one."""
        mine = f"run-{run_ts:%Y%m%d%H%M%S%f}"
        earlier = [r for r in self._runs() if r < mine]
        history = self.spark.read.parquet(f"{self._snapshots()}/{earlier[-1]}") if earlier else None
        out = gold.doctor_snapshot(history, doctors, F.lit(run_ts).cast("timestamp_ntz"))
        out.write.mode("overwrite").parquet(f"{self._snapshots()}/{mine}")
        return self.spark.read.parquet(f"{self._snapshots()}/{mine}")

    # ── runs ────────────────────────────────────────────────────────────────────────────────────

    def build(self, run_ts: dt.datetime, as_of: dt.date | None = None, full: bool = False) -> None:
        today = F.lit(as_of or run_ts.date())
        steps = {
            ADMISSIONS: (
                "stg_admissions",
                lambda rows: silver.stg_admissions(rows, today),
                lambda target, fresh: inc.rewritten_admissions(target, fresh, today),
                gold.fct_admissions,
            ),
            TREATMENTS: ("stg_treatments", silver.stg_treatments, inc.rewritten_treatments, gold.fct_treatments),
            CLAIMS: ("stg_claims", silver.stg_claims, lambda _, fresh: inc.rewritten_claims(fresh), gold.fct_claims),
        }
        for cfg, step in steps.items():
            bring_up_to_date(self.store, self.stores, cfg, *step, full=full, fresh_by=self.fresh_by)

        seed = lambda name: seed_scan(self.spark, f"{self.seeds}/{name}.csv", name)
        tx = self.store.begin()
        tx.replace("dim_doctor", gold.dim_doctor(seed("seed_doctors")))
        tx.replace("dim_hospital", gold.dim_hospital(seed("seed_hospitals")))
        tx.replace("dim_insurance", gold.dim_insurance(seed("seed_insurers")))
        tx.replace("dim_patient", gold.dim_patient(tx.table("stg_admissions")), "patient_id")
        tx.replace("dim_date", gold.dim_date(date_spine(self.spark, self.calendar_start, self.calendar_days)))
        tx.replace("dim_doctor_history", gold.dim_doctor_history(self.snapshot(run_ts, tx.table("dim_doctor"))))
        enriched = gold.fct_admissions_enriched(tx.table("fct_admissions"), tx.table("dim_doctor"), tx.table("dim_doctor_history"))
        tx.replace("fct_admissions_enriched", enriched, "admission_id")
        tx.publish()

    def test(self) -> DataFrame:
        names = {r.table for r in data_tests.RULES} | {r.to for r in data_tests.RULES if r.to}
        return data_tests.test_suite({n: self.table(n) for n in names})

    def check_keys(self) -> DataFrame:
        names = set(data_tests.PRIMARY_KEYS) | {f for f, _, _ in data_tests.FOREIGN_KEYS}
        return data_tests.key_catalog({n: self.table(n) for n in names})

    def reconcile(self) -> DataFrame:
        chains = []
        for feed, stg, key in (
            (ADMISSIONS.name, "stg_admissions", "admission_id"),
            (TREATMENTS.name, "stg_treatments", "treatment_id"),
            (CLAIMS.name, "stg_claims", "claim_id"),
        ):
            landed = bronze.read_landing(self.spark, self.stores.landing(feed), FEEDS[feed])
            chains.append((feed, key, landed, self.table(stg), self.table(stg.replace("stg_", "fct_"))))
        return data_tests.layer_reconciliation(chains)
