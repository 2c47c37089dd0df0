"""Star schema: dimensions, facts, doctor history and the time-accurate admissions fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.functions.dates import day_of_week, is_weekend
from wardline.functions.keys import surrogate_key
from wardline.functions.rules import patient_segment, seniority_band, true_only
from wardline.operators import joins, scd2
from wardline.session import written

# Bounds of the open ends, compared columns.
FLOOR = "1900-01-01 00:00:00"
CEILING = "9999-12-31 00:00:00"
DOCTOR_COLUMNS = ("doctor_id", "doctor_name", "specialty", "years_experience", "seniority_band")
DOCTOR_CHECK = ("specialty", "years_experience", "seniority_band")


def _sk(column: str, alias: str | None = None) -> Column:
    return surrogate_key(F.col(column)).alias(alias or column.removesuffix("_id") + "_sk")


# ── dimensions ──────────────────────────────────────────────────────────────────────────────────


def dim_doctor(doctors: DataFrame) -> DataFrame:
    return doctors.select(
        _sk("doctor_id"),
        "doctor_id",
        "doctor_name",
        "specialty",
        "years_experience",
        seniority_band(F.col("years_experience")).alias("seniority_band"),
    )


def dim_hospital(hospitals: DataFrame) -> DataFrame:
    return hospitals.select(_sk("hospital_id"), "hospital_id", "hospital_name", "city")


def dim_insurance(insurers: DataFrame) -> DataFrame:
    return insurers.select(_sk("insurance_id"), "insurance_id", "insurer_name")


def patient_rollup(stg_admissions: DataFrame) -> DataFrame:
    """Counts per patient over all admissions, valid or not; combined before the shuffle."""
    return stg_admissions.groupBy("patient_id").agg(
        F.count(F.lit(1)).alias("total_admissions"),
        F.min("admit_date").alias("first_admit_date"),
        F.max("admit_date").alias("last_admit_date"),
        F.count_if("is_30day_readmission").alias("readmission_count"),
    )


def dim_patient(stg_admissions: DataFrame) -> DataFrame:
    return patient_rollup(stg_admissions).select(
        _sk("patient_id"), "*", patient_segment(F.col("total_admissions")).alias("patient_segment")
    )


def dim_date(spine: DataFrame) -> DataFrame:
    d = F.col("date_day")
    return spine.select(
        _sk("date_day", "date_sk"),
        "date_day",
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.monthname(d).alias("month_name"),
        F.dayofmonth(d).alias("day_of_month"),
        day_of_week(d).alias("day_of_week"),
        F.dayname(d).alias("day_name"),
        is_weekend(d).alias("is_weekend"),
    )


def doctor_snapshot(history: DataFrame | None, dim: DataFrame, run_ts: Column) -> DataFrame:
    source = dim.select(*DOCTOR_COLUMNS)
    scd2.require_unique(source, "doctor_id")
    if history is None:
        return scd2.first_snapshot(source, "doctor_id", run_ts)
    return scd2.next_snapshot(history, source, "doctor_id", DOCTOR_CHECK, run_ts)


def dim_doctor_history(snapshot: DataFrame) -> DataFrame:
    return scd2.history_view(
        snapshot, "doctor_id", DOCTOR_COLUMNS, "doctor_history_sk", F.lit(FLOOR), F.lit(CEILING)
    )


# ── facts ───────────────────────────────────────────────────────────────────────────────────────


def fct_admissions(stg: DataFrame) -> DataFrame:
    return stg.select(
        "admission_id",
        _sk("patient_id"),
        _sk("doctor_id"),
        _sk("hospital_id"),
        _sk("admit_date", "date_sk"),
        "admit_date",
        "discharge_date",
        "length_of_stay",
        "admission_type",
        "department",
        "diagnosis_code",
        "is_30day_readmission",
        "patient_visit_seq",
        "dq_status",
        "is_valid",
        "file_name",
        "load_dttm",
    )


def fct_treatments(stg: DataFrame) -> DataFrame:
    return stg.select(
        "treatment_id",
        "admission_id",
        _sk("doctor_id"),
        _sk("treatment_date", "date_sk"),
        "procedure_code",
        "treatment_date",
        "cost",
        "outcome",
        "is_success",
        "cost_zscore",
        "is_cost_outlier",
        "dq_status",
        "file_name",
        "load_dttm",
    )


def fct_claims(stg: DataFrame) -> DataFrame:
    return stg.select(
        "claim_id",
        "admission_id",
        _sk("insurance_id"),
        _sk("claim_date", "date_sk"),
        "claim_amount",
        "approved_amount",
        "unapproved_amount",
        "claim_status",
        "approval_ratio",
        "days_to_settle",
        "is_approved",
        "is_pending",
        "dq_status",
        "file_name",
        "load_dttm",
    )


ENRICHED_FROM_FACT = (
    "admission_id",
    "admit_date",
    "discharge_date",
    "length_of_stay",
    "admission_type",
    "department",
    "is_30day_readmission",
)


def fct_admissions_enriched(fact: DataFrame, dim: DataFrame, history: DataFrame) -> DataFrame:
    """Each admission with the doctor's specialty then and now.

    Inner joins: admissions of unknown or removed doctors, or in a gap of a history, drop out. The
    current specialty and the key of ``dim`` are put on the versions, few as they are, and written, so the fact
    meets them in one join that Spark plans by their size.
    """
    known = dim.select("doctor_sk", F.col("doctor_id").alias("_id"))
    versions = joins.with_current(history, "doctor_id", "specialty")
    versions = written(versions.join(known, F.col("doctor_id") == F.col("_id")).drop("_id"), "doctor-versions")
    both = joins.asof_join_by_part(
        fact.select("doctor_sk", *ENRICHED_FROM_FACT),
        versions,
        "doctor_sk",
        "admit_date",
        "doctor_id",
        F.col("specialty").alias("specialty_at_admission"),
        F.col("seniority_band").alias("seniority_at_admission"),
        "current_specialty",
    )
    changed = F.col("specialty_at_admission") != F.col("current_specialty")
    return both.select(
        *ENRICHED_FROM_FACT,
        "doctor_id",
        "specialty_at_admission",
        "seniority_at_admission",
        "current_specialty",
        true_only(changed).alias("specialty_changed_since"),
    )
