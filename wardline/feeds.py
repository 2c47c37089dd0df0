"""The three business feeds, declared once; a new feed is added by configuration."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    """One business column: Spark type after the strict load and, for text, its width limit."""

    name: str
    spark_type: T.DataType
    number: str | None = None  # decimal text is tried as, for numeric columns
    width: int | None = None


def _id(name: str) -> Field:
    return Field(name, T.LongType(), number="decimal(10,0)")


def _int(name: str, digits: int) -> Field:
    return Field(name, T.IntegerType(), number=f"decimal({digits},0)")


def _money(name: str) -> Field:
    return Field(name, T.DecimalType(12, 2), number="decimal(12,2)")


def _text(name: str, width: int) -> Field:
    return Field(name, T.StringType(), width=width)


@dataclass(frozen=True)
class FeedConfig:
    name: str  # also the pattern looked for in file names and the landing table name
    fields: tuple[Field, ...]
    required: tuple[str, ...]
    key: str
    numeric: tuple[str, ...]
    date_column: str
    category_column: str
    categories: tuple[str, ...]

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def landing_schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.spark_type) for f in self.fields] + LINEAGE_FIELDS)


LINEAGE_FIELDS = [
    T.StructField("file_name", T.StringType()),
    T.StructField("upload_dttm", T.TimestampNTZType()),
    T.StructField("load_dttm", T.TimestampNTZType()),
]
LINEAGE = [f.name for f in LINEAGE_FIELDS]


@dataclass(frozen=True)
class GateLimits:
    min_rows: int = 1
    max_null_pct: str = "5.0"
    date_min: str = "2020-01-01"
    date_max: str = "2030-12-31"
    null_is_bad: bool = True  # a blank numeric cell counts as non-numeric


# Feed column lists, widths, keys and code sets.
ADMISSIONS = FeedConfig(
    name="patient_admissions",
    fields=(
        _id("admission_id"),
        _id("patient_id"),
        _text("doctor_id", 5),
        _text("hospital_id", 5),
        _text("admit_date", 20),
        _text("department", 20),
        _text("admission_type", 5),
        _text("diagnosis_code", 10),
        _int("length_of_stay", 4),
        _int("readmission_flag", 1),
    ),
    required=("admission_id", "patient_id", "doctor_id", "hospital_id"),
    key="admission_id",
    numeric=("admission_id", "length_of_stay"),
    date_column="admit_date",
    category_column="admission_type",
    categories=("EMG", "URG", "ELC"),
)

TREATMENTS = FeedConfig(
    name="treatment_records",
    fields=(
        _id("treatment_id"),
        _id("admission_id"),
        _text("doctor_id", 5),
        _text("procedure_code", 10),
        _text("treatment_date", 20),
        _money("cost"),
        _text("outcome", 1),
    ),
    required=("treatment_id", "admission_id", "doctor_id"),
    key="treatment_id",
    numeric=("treatment_id", "admission_id", "cost"),
    date_column="treatment_date",
    category_column="outcome",
    categories=("P", "F", "S"),
)

CLAIMS = FeedConfig(
    name="insurance_claims",
    fields=(
        _id("claim_id"),
        _id("admission_id"),
        _text("insurance_id", 5),
        _money("claim_amount"),
        _money("approved_amount"),
        _text("claim_status", 1),
        _text("claim_date", 20),
        _text("settle_date", 20),
    ),
    required=("claim_id", "admission_id", "insurance_id"),
    key="claim_id",
    numeric=("claim_id", "admission_id", "claim_amount", "approved_amount"),
    date_column="claim_date",
    category_column="claim_status",
    categories=("P", "A", "R"),
)

FEEDS: dict[str, FeedConfig] = {f.name: f for f in (ADMISSIONS, TREATMENTS, CLAIMS)}
