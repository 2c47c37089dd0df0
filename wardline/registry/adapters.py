"""Feeds, dimensions and history derived from the order tables, for queries and tests.

Every expression is a function of the row alone, so the same feeds can be stated in SQL for the
side-by-side check (``registry.feeds_sql``) and the amount of work follows the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values shared with the SQL side.
AS_OF = "2001-06-01"
SPLIT_AT = "1999-06-30 00:00:00"
FIRST_SNAPSHOT = "1995-01-01 00:00:00"
SECOND_SNAPSHOT = "1998-01-01 00:00:00"
SPECIALTIES = ("Cardiology", "Neurology", "Oncology", "Pediatrics", "Orthopedics")


def as_of() -> Column:
    return F.lit(AS_OF).cast("date")


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _padded(c: Column, width: int) -> Column:
    """Zeros on the left up to ``width``; longer numbers keep all digits."""
    text = c.cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))


def _iso(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def _day_first(c: Column) -> Column:
    return F.date_format(c, "dd/MM/yyyy")


def admissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    k, day = F.col("o_orderkey"), F.col("o_orderdate")
    again = F.when(k % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    o = o.withColumn("v", F.explode(again))
    doctor_no = _padded(k % 10, 3)
    first = F.substring("o_orderpriority", 1, 1)
    return o.select(
        k.alias("admission_id"),
        F.col("o_custkey").alias("patient_id"),
        F.when(k % 97 == 0, F.lit(None).cast("string"))
        .when(k % 5 == 0, F.concat(F.lit(" d"), doctor_no, F.lit(" ")))
        .otherwise(F.concat(F.lit("D"), doctor_no))
        .alias("doctor_id"),
        F.when(k % 89 != 0, F.concat(F.lit("H"), _padded(k % 25, 2))).alias("hospital_id"),
        F.when(k % 211 == 0, "n/a").when(k % 3 == 0, _day_first(day)).otherwise(_iso(day)).alias("admit_date"),
        F.substring("o_orderpriority", 3, 3).alias("department"),
        F.when(first == "1", "EMG").when(first == "2", " urg ").when(first == "3", "ELC").otherwise("ZZZ").alias("admission_type"),
        F.concat(F.lit(" dx"), (k % 40).cast("string")).alias("diagnosis_code"),
        F.when(k % 101 == 0, -1).when(k % 103 == 0, 400).otherwise(k % 12 + F.col("v")).cast("int").alias("length_of_stay"),
        F.when(k % 4 == 0, 1).otherwise(0).alias("readmission_flag"),
        F.concat(F.lit("patient_admissions_"), F.year(day).cast("string"), F.lit(".csv")).alias("file_name"),
        (day + F.make_dt_interval(days=F.col("v"))).alias("upload_dttm"),
        (day + F.make_dt_interval(days=F.col("v") + 1)).alias("load_dttm"),
    )


def treatments(spark: SparkSession, sf_dir: str) -> DataFrame:
    li, p = read(spark, sf_dir, "lineitem"), read(spark, sf_dir, "part")
    k, line, day = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_shipdate")
    flag = F.col("l_returnflag")
    amount = F.col("l_extendedprice").cast("decimal(12,2)")
    return li.join(p, F.col("l_partkey") == F.col("p_partkey")).select(
        (k * 10 + line).alias("treatment_id"),
        k.alias("admission_id"),
        F.concat(F.lit("D"), _padded(F.col("l_suppkey") % 10, 3)).alias("doctor_id"),
        F.concat(F.lit(" "), F.lower("p_brand")).alias("procedure_code"),
        F.when(k % 53 == 0, "soon").when(k % 3 == 0, _day_first(day)).otherwise(_iso(day)).alias("treatment_date"),
        F.when((k + line) % 83 == 0, -amount).otherwise(amount).cast("decimal(12,2)").alias("cost"),
        F.when(k % 47 == 0, "Q").when(flag == "A", "s").when(flag == "R", "F").otherwise("P").alias("outcome"),
        F.concat(F.lit("treatment_records_"), F.year(day).cast("string"), F.lit(".csv")).alias("file_name"),
        day.alias("upload_dttm"),
        day.alias("load_dttm"),
    )


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    k, day, status = F.col("o_orderkey"), F.col("o_orderdate"), F.col("o_orderstatus")
    price = F.col("o_totalprice").cast("decimal(12,2)")
    share = (k % 10).cast("decimal(2,0)") * F.lit("0.1").cast("decimal(2,1)")
    nothing = F.lit(None).cast("decimal(12,2)")
    settled = (
        F.when(status == "P", F.lit(None).cast("date"))
        .when(k % 67 == 0, F.date_sub(day.cast("date"), 3))
        .otherwise(F.date_add(day.cast("date"), (k % 45).cast("int")))
    )
    return o.select(
        k.alias("claim_id"),
        k.alias("admission_id"),
        F.concat(F.lit(" i"), _padded(k % 5 + 1, 2)).alias("insurance_id"),
        F.when(k % 61 == 0, F.lit(0)).otherwise(price).cast("decimal(12,2)").alias("claim_amount"),
        F.when(k % 53 == 0, F.lit(500000).cast("decimal(12,2)"))
        .when((k % 59 == 0) | (status == "P"), nothing)
        .when(status == "O", F.lit(0).cast("decimal(12,2)"))
        .otherwise((price * share).cast("decimal(12,2)"))
        .alias("approved_amount"),
        F.when(k % 71 == 0, "X").when(status == "F", "A").when(status == "O", "R").otherwise(" p").alias("claim_status"),
        F.when(k % 3 == 0, _day_first(day)).otherwise(_iso(day)).alias("claim_date"),
        F.when(k % 4 == 0, _day_first(settled)).otherwise(_iso(settled)).alias("settle_date"),
        F.concat(F.lit("insurance_claims_"), F.year(day).cast("string"), F.lit(".csv")).alias("file_name"),
        day.alias("upload_dttm"),
        day.alias("load_dttm"),
    )


def doctors(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read(spark, sf_dir, "supplier")
    names = F.array(*[F.lit(x) for x in SPECIALTIES])
    return s.select(
        F.concat(F.lit("D"), _padded(F.col("s_suppkey"), 3)).alias("doctor_id"),
        F.col("s_name").alias("doctor_name"),
        F.element_at(names, (F.col("s_nationkey") % len(SPECIALTIES) + 1).cast("int")).alias("specialty"),
        (F.col("s_suppkey") % 36).cast("int").alias("years_experience"),
    )


def doctors_later(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The doctors as a second snapshot sees them: some gone, some with another specialty."""
    no = F.substring("doctor_id", 2, 20).cast("long")
    return (
        doctors(spark, sf_dir)
        .filter(no % 7 != 6)
        .withColumn("specialty", F.when(no % 3 == 0, "Telehealth").otherwise(F.col("specialty")))
        .withColumn("doctor_name", F.when(no % 4 == 1, F.upper("doctor_name")).otherwise(F.col("doctor_name")))
    )


def hospitals(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read(spark, sf_dir, "nation")
    return n.select(
        F.concat(F.lit("H"), _padded(F.col("n_nationkey"), 2)).alias("hospital_id"),
        F.col("n_name").alias("hospital_name"),
        F.concat(F.lit("City "), F.col("n_regionkey").cast("string")).alias("city"),
    )


def insurers(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = read(spark, sf_dir, "region")
    return r.select(
        F.concat(F.lit("I"), _padded(F.col("r_regionkey") + 1, 2)).alias("insurance_id"),
        F.col("r_name").alias("insurer_name"),
    )
