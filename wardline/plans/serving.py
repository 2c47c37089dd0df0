"""Star joins, drill-down and the measures shown to readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def star_join(fact: DataFrame, *dims: tuple[DataFrame, str, list[str]]) -> DataFrame:
    """A fact with columns of its dimensions; facts without a dimension row drop out."""
    out = fact
    for dim, key, columns in dims:
        out = out.join(dim.select(key, *columns), key)
    return out


def admission_drill_join(admissions: DataFrame, treatments: DataFrame, claims: DataFrame) -> DataFrame:
    """Treatment and claim measures per admission.

    Both are summed per admission before they meet, so one treatment never repeats a claim and a
    crowded admission joins as one row.
    """
    t = treatments.groupBy("admission_id").agg(
        F.count(F.lit(1)).alias("treatments"), F.sum("cost").alias("total_cost")
    )
    c = claims.groupBy("admission_id").agg(
        F.count(F.lit(1)).alias("claims"), F.sum("claim_amount").alias("claimed_total")
    )
    return (
        admissions.select("admission_id", "department", "admission_type")
        .join(t, "admission_id")
        .join(c, "admission_id")
    )


def share(condition: Column) -> Column:
    """Fraction of rows for which ``condition`` holds, four digits."""
    n = F.count_if(condition).cast("decimal(20,0)")
    return F.round(n / F.count(F.lit(1)).cast("decimal(20,0)"), 4).cast("decimal(10,4)")


def kpi_admissions(fact: DataFrame) -> DataFrame:
    return fact.groupBy("department", "admission_type", F.trunc("admit_date", "month").cast("string").alias("month")).agg(
        F.count(F.lit(1)).alias("admissions"),
        F.round(F.avg(F.col("length_of_stay").cast("decimal(12,2)")), 2).alias("avg_length_of_stay"),
        share(F.col("is_30day_readmission")).alias("readmission_rate"),
    )


def kpi_claims(fact: DataFrame, insurers: DataFrame) -> DataFrame:
    named = fact.join(insurers.select("insurance_sk", "insurer_name"), "insurance_sk")
    return named.groupBy("insurer_name", F.col("claim_month").cast("string").alias("month")).agg(
        F.count(F.lit(1)).alias("claims"),
        share(F.col("is_approved")).alias("approval_rate"),
        F.sum("approved_amount").alias("approved_total"),
        F.sum("unapproved_amount").alias("unapproved_total"),
        F.round(F.avg(F.col("days_to_settle").cast("decimal(12,2)")), 2).alias("avg_days_to_settle"),
    )


def with_claim_month(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """The claim fact holds its date only as a key; the calendar gives it back."""
    month = dates.select("date_sk", F.trunc("date_day", "month").alias("claim_month"))
    return fact.join(month, "date_sk")


def kpi_treatment_cost(fact: DataFrame, doctors: DataFrame) -> DataFrame:
    named = fact.join(doctors.select("doctor_sk", "specialty"), "doctor_sk")
    return named.groupBy("procedure_code", "specialty").agg(
        F.count(F.lit(1)).alias("treatments"),
        F.sum("cost").alias("total_cost"),
        F.round(F.avg("cost"), 2).alias("avg_cost"),
        share(F.col("is_success")).alias("success_rate"),
        F.count_if("is_cost_outlier").alias("outliers"),
    )
