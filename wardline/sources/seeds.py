"""Small reference tables with declared types."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Declared seed columns.
SEEDS = {
    "seed_doctors": "doctor_id string, doctor_name string, specialty string, years_experience int",
    "seed_hospitals": "hospital_id string, hospital_name string, city string",
    "seed_insurers": "insurance_id string, insurer_name string",
}


def seed_scan(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.schema(SEEDS[name]).option("header", "true").csv(path)
