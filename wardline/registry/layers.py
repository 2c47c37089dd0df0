"""Models built once per session and data folder, as the layer tables they are in production.

Queries that stand for a step on top of finished tables (tests, upserts, serving) read these; the
model queries themselves always compute from the given tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.plans import gold, silver
from wardline.registry import adapters as a
from wardline.session import scratch_path
from wardline.sources.spine import date_spine_covering


def snapshot_two(spark: SparkSession, sf: str) -> DataFrame:
    first = gold.doctor_snapshot(None, gold.dim_doctor(a.doctors(spark, sf)), a.ntz(a.FIRST_SNAPSHOT))
    later = gold.dim_doctor(a.doctors_later(spark, sf))
    return gold.doctor_snapshot(first, later, a.ntz(a.SECOND_SNAPSHOT))


def calendar(spark: SparkSession, sf: str) -> DataFrame:
    return date_spine_covering(a.read(spark, sf, "orders"), F.col("o_orderdate").cast("date"))


def enriched(spark: SparkSession, sf: str) -> DataFrame:
    fact = gold.fct_admissions(silver.stg_admissions(a.admissions(spark, sf), a.as_of()))
    history = gold.dim_doctor_history(snapshot_two(spark, sf))
    return gold.fct_admissions_enriched(fact, gold.dim_doctor(a.doctors(spark, sf)), history)


MODELS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "raw_admissions": a.admissions,
    "raw_treatments": a.treatments,
    "raw_claims": a.claims,
    "stg_admissions": lambda s, d: silver.stg_admissions(table(s, d, "raw_admissions"), a.as_of()),
    "stg_treatments": lambda s, d: silver.stg_treatments(table(s, d, "raw_treatments")),
    "stg_claims": lambda s, d: silver.stg_claims(table(s, d, "raw_claims")),
    "dim_doctor": lambda s, d: gold.dim_doctor(a.doctors(s, d)),
    "dim_hospital": lambda s, d: gold.dim_hospital(a.hospitals(s, d)),
    "dim_insurance": lambda s, d: gold.dim_insurance(a.insurers(s, d)),
    "dim_patient": lambda s, d: gold.dim_patient(table(s, d, "stg_admissions")),
    "dim_date": lambda s, d: gold.dim_date(calendar(s, d)),
    "dim_doctor_history": lambda s, d: gold.dim_doctor_history(snapshot_two(s, d)),
    "fct_admissions": lambda s, d: gold.fct_admissions(table(s, d, "stg_admissions")),
    "fct_treatments": lambda s, d: gold.fct_treatments(table(s, d, "stg_treatments")),
    "fct_claims": lambda s, d: gold.fct_claims(table(s, d, "stg_claims")),
}



def _before(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """Landed rows up to the split: what an earlier run had seen."""
    return lambda s, d: table(s, d, name).filter(F.col("load_dttm") <= a.ntz(a.SPLIT_AT))


MODELS |= {
    "stg_admissions_before": lambda s, d: silver.stg_admissions(_before("raw_admissions")(s, d), a.as_of()),
    "stg_treatments_before": lambda s, d: silver.stg_treatments(_before("raw_treatments")(s, d)),
    "stg_claims_before": lambda s, d: silver.stg_claims(_before("raw_claims")(s, d)),
    "fct_admissions_before": lambda s, d: gold.fct_admissions(table(s, d, "stg_admissions_before")),
    "fct_treatments_before": lambda s, d: gold.fct_treatments(table(s, d, "stg_treatments_before")),
    "fct_claims_before": lambda s, d: gold.fct_claims(table(s, d, "stg_claims_before")),
}

_paths: dict[tuple[str, str, str], str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    at = (spark.sparkContext.applicationId, sf_dir, name)
    if at not in _paths:
        path = scratch_path(spark, name)
        MODELS[name](spark, sf_dir).write.parquet(path)
        _paths[at] = path
    return spark.read.parquet(_paths[at])
