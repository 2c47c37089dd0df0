"""Column tests, key checks and row reconciliation over finished tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.operators.joins import orphans


@dataclass(frozen=True)
class Rule:
    table: str
    column: str
    kind: str  # unique, not_null, accepted_values, relationships
    values: tuple[str, ...] = ()
    to: str | None = None

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.table}_{self.column}"


# The declared tests and keys.
_STATUS = (
    "VALID",
    "OVERLAPPING_ADMISSION",
    "INVALID_NEGATIVE_LOS",
    "INVALID_EXCESSIVE_LOS",
    "INVALID_FUTURE_DATE",
    "MISSING_DOCTOR",
    "MISSING_HOSPITAL",
)
_CLAIM = ("Approved", "Rejected", "Pending", "Unknown")


def _key(table: str, column: str) -> list[Rule]:
    return [Rule(table, column, "unique"), Rule(table, column, "not_null")]


def _foreign(table: str, column: str, to: str) -> list[Rule]:
    return [Rule(table, column, "not_null"), Rule(table, column, "relationships", to=to)]


def _among(table: str, column: str, *values: str) -> list[Rule]:
    return [Rule(table, column, "accepted_values", values=values)]


RULES: list[Rule] = [
    *_key("stg_admissions", "admission_id"),
    Rule("stg_admissions", "patient_id", "not_null"),
    *_among("stg_admissions", "admission_type", "Emergency", "Urgent", "Elective", "Unknown"),
    *_among("stg_admissions", "dq_status", *_STATUS),
    *_key("stg_treatments", "treatment_id"),
    *_among("stg_treatments", "outcome", "Success", "Partial", "Failed", "Unknown"),
    *_key("stg_claims", "claim_id"),
    *_among("stg_claims", "claim_status", *_CLAIM),
    *_key("dim_doctor", "doctor_sk"),
    *_key("dim_doctor", "doctor_id"),
    *_among("dim_doctor", "seniority_band", "Junior", "Mid-level", "Senior", "Unknown"),
    *_key("dim_hospital", "hospital_sk"),
    *_key("dim_insurance", "insurance_sk"),
    *_key("dim_patient", "patient_sk"),
    *_key("dim_date", "date_sk"),
    *_key("dim_date", "date_day"),
    *_key("fct_admissions", "admission_id"),
    *_foreign("fct_admissions", "doctor_sk", "dim_doctor"),
    *_foreign("fct_admissions", "hospital_sk", "dim_hospital"),
    *_key("fct_treatments", "treatment_id"),
    *_foreign("fct_treatments", "doctor_sk", "dim_doctor"),
    *_key("fct_claims", "claim_id"),
    *_among("fct_claims", "claim_status", *_CLAIM),
    *_foreign("fct_claims", "insurance_sk", "dim_insurance"),
]

PRIMARY_KEYS = {
    "dim_doctor": "doctor_sk",
    "dim_hospital": "hospital_sk",
    "dim_insurance": "insurance_sk",
    "dim_patient": "patient_sk",
    "dim_date": "date_sk",
}
FOREIGN_KEYS = (
    ("fct_admissions", "patient_sk", "dim_patient"),
    ("fct_admissions", "doctor_sk", "dim_doctor"),
    ("fct_admissions", "hospital_sk", "dim_hospital"),
    ("fct_admissions", "date_sk", "dim_date"),
    ("fct_treatments", "doctor_sk", "dim_doctor"),
    ("fct_treatments", "date_sk", "dim_date"),
    ("fct_claims", "insurance_sk", "dim_insurance"),
    ("fct_claims", "date_sk", "dim_date"),
)


# ── single tests: the failing rows ──────────────────────────────────────────────────────────────


def test_unique(df: DataFrame, column: str) -> DataFrame:
    counted = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counted.filter("n > 1")


def test_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def test_accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    counted = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(~F.col(column).isin(*values))


def test_relationships(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    return orphans(child, child_key, parent, parent_key)


for _f in (test_unique, test_not_null, test_accepted_values, test_relationships):
    _f.__test__ = False  # operators, not tests of this repository


def orphan_counts(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows without a parent, counted per key first: a hot key joins as one row."""
    keys = child.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return orphans(keys, key, parent, key)


# ── suites: one summary row per test ────────────────────────────────────────────────────────────


def test_suite(tables: Mapping[str, DataFrame], rules: Sequence[Rule] = tuple(RULES)) -> DataFrame:
    """``test, failures, passed`` for every rule.

    All NULL and value rules of a table share one scan and one aggregate; uniqueness and
    relationships each need a grouping of their own.
    """
    parts = []
    for table in dict.fromkeys(r.table for r in rules):
        df = tables[table]
        simple = [r for r in rules if r.table == table and r.kind in ("not_null", "accepted_values")]
        if simple:
            counters = [
                F.count_if(
                    F.col(r.column).isNull() if r.kind == "not_null" else ~F.col(r.column).isin(*r.values)
                ).alias(f"r{i}")
                for i, r in enumerate(simple)
            ]
            rows = [F.struct(F.lit(r.name).alias("test"), F.col(f"r{i}").alias("failures")) for i, r in enumerate(simple)]
            parts.append(df.agg(*counters).select(F.inline(F.array(*rows))))
        for r in rules:
            if r.table != table or r in simple:
                continue
            if r.kind == "unique":
                failing = test_unique(df, r.column).agg(F.count(F.lit(1)).alias("failures"))
            else:
                failing = orphan_counts(df, tables[r.to], r.column).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("failures"))
            parts.append(failing.select(F.lit(r.name).alias("test"), "failures"))
    return _summary(parts)


test_suite.__test__ = False


def _summary(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("passed", F.col("failures") == 0)


def key_catalog(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The declared keys, each verified: primary keys unique and present, foreign keys resolvable."""
    parts = []
    for table, pk in PRIMARY_KEYS.items():
        counted = tables[table].groupBy(pk).agg(F.count(F.lit(1)).alias("n"))
        failing = counted.agg(
            F.coalesce(F.sum(F.when((F.col("n") > 1) | F.col(pk).isNull(), F.col("n"))), F.lit(0)).alias("failures")
        )
        parts.append(_key_row(failing, "PRIMARY KEY", table, pk, None))
    for table, fk, parent in FOREIGN_KEYS:
        failing = orphan_counts(tables[table], tables[parent], fk).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("failures"))
        parts.append(_key_row(failing, "FOREIGN KEY", table, fk, parent))
    return _summary(parts)


def _key_row(failing: DataFrame, kind: str, table: str, column: str, parent: str | None) -> DataFrame:
    return failing.select(
        F.lit(kind).alias("kind"),
        F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"),
        F.lit(parent).cast("string").alias("references"),
        "failures",
    )


def layer_reconciliation(chains: Sequence[tuple[str, str, DataFrame, DataFrame, DataFrame]]) -> DataFrame:
    """Distinct keys landed, rows cleaned, rows in the fact; ``(name, key, landed, cleaned, fact)``."""
    parts = []
    for name, key, landed, cleaned, fact in chains:
        keys = landed.select(key).distinct().agg(F.count(F.lit(1)).alias("n")).select(F.lit("landed_keys").alias("what"), "n")
        rows = cleaned.agg(F.count(F.lit(1)).alias("n")).select(F.lit("cleaned_rows").alias("what"), "n")
        facts = fact.agg(F.count(F.lit(1)).alias("n")).select(F.lit("fact_rows").alias("what"), "n")
        counts = keys.unionByName(rows).unionByName(facts).withColumn("feed", F.lit(name))
        wide = counts.groupBy("feed").agg(
            *[F.max(F.when(F.col("what") == w, F.col("n"))).alias(w) for w in ("landed_keys", "cleaned_rows", "fact_rows")]
        )
        parts.append(wide)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumns(
        {
            "cleaned_difference": F.col("cleaned_rows") - F.col("landed_keys"),
            "fact_difference": F.col("fact_rows") - F.col("cleaned_rows"),
        }
    )
