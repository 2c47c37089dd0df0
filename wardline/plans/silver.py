"""Cleaned feeds: newest version per key, decoded codes, per-key history, quality status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.feeds import LINEAGE
from wardline.functions import rules
from wardline.functions.dates import add_days, day_gap, parse_date
from wardline.functions.numbers import guarded_ratio
from wardline.functions.text import clean_code
from wardline.operators import spread
from wardline.operators.latest import dedup_latest
from wardline.operators.sequence import SAMPLES, Sequence, number_rows
from wardline.session import written

SOURCE_SYSTEM = "GATEKEEPER"  # fixed value

VISITS = Sequence(
    key="patient_id",
    day="admit_date",
    id="admission_id",
    seq="patient_visit_seq",
    total="patient_total_visits",
    value="discharge_date",
    previous="prev_discharge_date",
)
STEPS = Sequence(
    key="admission_id",
    day="treatment_date",
    id="treatment_id",
    seq="treatment_seq_in_admission",
    total="treatments_in_admission",
)


def _lineage() -> list[Column]:
    return [F.col(c) for c in LINEAGE] + [F.lit(SOURCE_SYSTEM).alias("source_system")]


# ── admissions ──────────────────────────────────────────────────────────────────────────────────


def clean_admissions(landed: DataFrame) -> DataFrame:
    latest = dedup_latest(landed, "admission_id")
    return latest.select(
        "admission_id",
        "patient_id",
        clean_code(F.col("doctor_id")).alias("doctor_id"),
        clean_code(F.col("hospital_id")).alias("hospital_id"),
        parse_date(F.col("admit_date")).alias("admit_date"),
        "length_of_stay",
        rules.decode(clean_code(F.col("admission_type")), rules.ADMISSION_TYPES).alias("admission_type"),
        clean_code(F.col("department")).alias("department"),
        clean_code(F.col("diagnosis_code")).alias("diagnosis_code"),
        F.col("readmission_flag").cast("boolean").alias("source_readmission_flag"),
        *_lineage(),
    ).withColumn("discharge_date", add_days(F.col("admit_date"), F.col("length_of_stay")))


def visit_places(landed: DataFrame) -> DataFrame:
    """What the visit order goes by, from landed rows; enough for a sample."""
    return landed.select("patient_id", parse_date(F.col("admit_date")).alias("admit_date"), "admission_id")


def step_places(landed: DataFrame) -> DataFrame:
    """The same for the order of treatments."""
    return landed.select("admission_id", parse_date(F.col("treatment_date")).alias("treatment_date"), "treatment_id")


def admission_history(
    cleaned: DataFrame, as_of: Column, landed: DataFrame | None = None, samples: int = SAMPLES
) -> DataFrame:
    """Visit order, gap to the previous discharge, 30-day readmission, status."""
    seen = number_rows(cleaned, VISITS, landed, visit_places if landed is not None else None, samples)
    gap = F.col("days_since_last_visit")
    stay, admitted = F.col("length_of_stay"), F.col("admit_date")
    doctor, hospital = F.col("doctor_id"), F.col("hospital_id")
    return seen.withColumn(
        "days_since_last_visit", day_gap(F.col("prev_discharge_date"), F.col("admit_date"))
    ).select(
        "admission_id",
        "patient_id",
        "doctor_id",
        "hospital_id",
        "admit_date",
        "discharge_date",
        "length_of_stay",
        "admission_type",
        "department",
        "diagnosis_code",
        "source_readmission_flag",
        "patient_visit_seq",
        "patient_total_visits",
        rules.is_readmission(gap).alias("is_30day_readmission"),
        "days_since_last_visit",
        rules.admission_status(gap, stay, admitted, doctor, hospital, as_of).alias("dq_status"),
        rules.admission_is_valid(stay, admitted, doctor, hospital, as_of).alias("is_valid"),
        *LINEAGE,
        "source_system",
    )


def stg_admissions(landed: DataFrame, as_of: Column, samples: int = SAMPLES) -> DataFrame:
    return admission_history(clean_admissions(landed), as_of, landed, samples)


# ── treatments ──────────────────────────────────────────────────────────────────────────────────


def clean_treatments(landed: DataFrame) -> DataFrame:
    latest = dedup_latest(landed, "treatment_id")
    return latest.select(
        "treatment_id",
        "admission_id",
        clean_code(F.col("doctor_id")).alias("doctor_id"),
        clean_code(F.col("procedure_code")).alias("procedure_code"),
        parse_date(F.col("treatment_date")).alias("treatment_date"),
        "cost",
        rules.decode(clean_code(F.col("outcome")), rules.OUTCOMES).alias("outcome"),
        *_lineage(),
    )


def treatment_costs(cleaned: DataFrame, stats: DataFrame) -> DataFrame:
    """Mean, z-score and outlier flag of each row against its procedure."""
    joined = spread.attach(cleaned, stats, "procedure_code")
    return joined.select(
        *cleaned.columns,
        F.col("mean").alias("avg_cost_for_procedure"),
        spread.z_score(F.col("cost")).alias("cost_zscore"),
        spread.above_percentile(F.col("cost")).alias("is_cost_outlier"),
    )


TREATMENT_COLUMNS = [
    "treatment_id",
    "admission_id",
    "doctor_id",
    "procedure_code",
    "treatment_date",
    "cost",
    "outcome",
    "treatment_seq_in_admission",
    "treatments_in_admission",
    "avg_cost_for_procedure",
    "cost_zscore",
    "is_cost_outlier",
    "is_success",
    "dq_status",
    "source_system",
    *LINEAGE,
]


def with_treatment_flags(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "is_success": rules.true_only(F.col("outcome") == "Success"),
            "dq_status": rules.treatment_status(F.col("cost"), F.col("treatment_date"), F.col("outcome")),
        }
    ).select(*TREATMENT_COLUMNS)


def stg_treatments(landed: DataFrame, samples: int = SAMPLES) -> DataFrame:
    # two statistics passes and the row pass read this: written once, each scans what it needs
    cleaned = written(clean_treatments(landed), "clean-treatments")
    stats = spread.cost_statistics(cleaned, "procedure_code", "cost")
    # numbered first: the exchange then carries no statistics
    return with_treatment_flags(treatment_costs(number_rows(cleaned, STEPS, samples=samples), stats))


# ── claims ──────────────────────────────────────────────────────────────────────────────────────


def clean_claims(landed: DataFrame) -> DataFrame:
    latest = dedup_latest(landed, "claim_id")
    return latest.select(
        "claim_id",
        "admission_id",
        clean_code(F.col("insurance_id")).alias("insurance_id"),
        "claim_amount",
        "approved_amount",
        rules.decode(clean_code(F.col("claim_status")), rules.CLAIM_STATUSES).alias("claim_status"),
        parse_date(F.col("claim_date")).alias("claim_date"),
        parse_date(F.col("settle_date")).alias("settle_date"),
        *_lineage(),
    )


def stg_claims(landed: DataFrame) -> DataFrame:
    claimed, approved = F.col("claim_amount"), F.col("approved_amount")
    status, filed, settled = F.col("claim_status"), F.col("claim_date"), F.col("settle_date")
    is_approved = rules.true_only(status == "Approved")
    return clean_claims(landed).select(
        "claim_id",
        "admission_id",
        "insurance_id",
        "claim_amount",
        "approved_amount",
        "claim_status",
        "claim_date",
        "settle_date",
        day_gap(filed, settled).alias("days_to_settle"),
        guarded_ratio(approved, claimed, is_approved).alias("approval_ratio"),
        (claimed - approved).alias("unapproved_amount"),
        is_approved.alias("is_approved"),
        rules.true_only(status == "Pending").alias("is_pending"),
        rules.claim_status_check(claimed, approved, status, filed, settled).alias("dq_status"),
        "source_system",
        *LINEAGE,
    )
