"""Decodes, bands and ordered data-quality rules."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code labels, bands and status names.
ADMISSION_TYPES = {"EMG": "Emergency", "URG": "Urgent", "ELC": "Elective"}
OUTCOMES = {"S": "Success", "P": "Partial", "F": "Failed"}
CLAIM_STATUSES = {"A": "Approved", "R": "Rejected", "P": "Pending"}
UNKNOWN = "Unknown"
VALID = "VALID"
MAX_STAY_DAYS = 365
READMISSION_DAYS = 30
SENIORITY = ((20, "Senior"), (10, "Mid-level"), (1, "Junior"))
SEGMENTS = ((4, "High-frequency"), (2, "Repeat"))


def decode(code: Column, labels: Mapping[str, str], default: str = UNKNOWN) -> Column:
    out = None
    for key, label in labels.items():
        out = F.when(code == key, label) if out is None else out.when(code == key, label)
    return out.otherwise(default)


def band(value: Column, steps: Iterable[tuple[int, str]], default: str) -> Column:
    """First step whose lower bound is reached; NULL falls to the default."""
    out = None
    for lower, label in steps:
        out = F.when(value >= lower, label) if out is None else out.when(value >= lower, label)
    return out.otherwise(default)


def first_match(rules: Iterable[tuple[str, Column]], default: str = VALID) -> Column:
    """Label of the first rule that is true; a NULL condition does not match."""
    out = None
    for label, condition in rules:
        out = F.when(condition, label) if out is None else out.when(condition, label)
    return out.otherwise(default)


def true_only(condition: Column) -> Column:
    """NULL counts as false."""
    return F.coalesce(condition, F.lit(False))


def seniority_band(years: Column) -> Column:
    return band(years, SENIORITY, UNKNOWN)


def patient_segment(visits: Column) -> Column:
    return band(visits, SEGMENTS, "One-time")


def is_readmission(gap_days: Column) -> Column:
    return true_only(gap_days.between(0, READMISSION_DAYS))


def admission_status(gap: Column, stay: Column, admitted: Column, doctor: Column, hospital: Column, as_of: Column) -> Column:
    return first_match(
        [
            ("OVERLAPPING_ADMISSION", gap < 0),
            ("INVALID_NEGATIVE_LOS", stay < 0),
            ("INVALID_EXCESSIVE_LOS", stay > MAX_STAY_DAYS),
            ("INVALID_FUTURE_DATE", admitted > as_of),
            ("MISSING_DOCTOR", doctor.isNull()),
            ("MISSING_HOSPITAL", hospital.isNull()),
        ]
    )


def admission_is_valid(stay: Column, admitted: Column, doctor: Column, hospital: Column, as_of: Column) -> Column:
    return true_only(
        stay.between(0, MAX_STAY_DAYS) & (admitted <= as_of) & doctor.isNotNull() & hospital.isNotNull()
    )


def treatment_status(cost: Column, treated: Column, outcome: Column) -> Column:
    return first_match(
        [
            ("INVALID_NEGATIVE_COST", cost < 0),
            ("MISSING_DATE", treated.isNull()),
            ("INVALID_OUTCOME", outcome == UNKNOWN),
        ]
    )


def claim_status_check(claimed: Column, approved: Column, status: Column, filed: Column, settled: Column) -> Column:
    return first_match(
        [
            ("APPROVED_EXCEEDS_CLAIM", approved > claimed),
            ("INVALID_CLAIM_AMOUNT", claimed <= 0),
            ("SETTLE_BEFORE_CLAIM", settled < filed),
            ("APPROVED_BUT_NO_AMOUNT", (status == "Approved") & approved.isNull()),
            ("INVALID_STATUS", status == UNKNOWN),
        ]
    )
