from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The default calendar.
DEFAULT_START = "2023-01-01"
DEFAULT_DAYS = 1095


def date_spine(spark: SparkSession, start: str = DEFAULT_START, days: int = DEFAULT_DAYS) -> DataFrame:
    """``days`` consecutive dates from ``start``, generated in parallel and without gaps."""
    first = F.lit(dt.date.fromisoformat(start))
    return spark.range(days).select(F.date_add(first, F.col("id").cast("int")).alias("date_day"))


def date_spine_covering(df: DataFrame, day: Column) -> DataFrame:
    """The days from the first to the last one found in ``df``."""
    span = df.agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    return span.select(F.explode(F.sequence("lo", "hi")).alias("date_day"))
