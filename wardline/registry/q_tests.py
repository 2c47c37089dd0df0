"""Groups N, E, F: data tests, joins, aggregates and reader-facing measures on finished tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardline.operators import data_tests as dt
from wardline.operators import joins
from wardline.operators.incremental import max_watermark, watermark_filter
from wardline.plans import gold, serving
from wardline.registry import adapters as a
from wardline.registry import sql_models as m
from wardline.registry.layers import MODELS, table
from wardline.registry.sql_models import query, shown

TESTED = [n for n in MODELS if not n.startswith("raw_") and not n.endswith("_before")]


def _tables(spark, sf):
    return {n: table(spark, sf, n) for n in TESTED}


def unique(spark, sf):
    """Landed treatment ids that occur more than once."""
    return dt.test_unique(table(spark, sf, "raw_treatments"), "treatment_id")


def not_null(spark, sf):
    return dt.test_not_null(table(spark, sf, "stg_admissions"), "doctor_id").select("admission_id", "doctor_id")


def accepted(spark, sf):
    return dt.test_accepted_values(table(spark, sf, "raw_claims"), "claim_status", ("A", "R", "P"))


def relationships(spark, sf):
    bad = dt.test_relationships(table(spark, sf, "fct_admissions"), "doctor_sk", table(spark, sf, "dim_doctor"), "doctor_sk")
    return bad.select("admission_id", "doctor_sk")


def reconciliation(spark, sf):
    chain = lambda name, key, part: (
        name,
        key,
        table(spark, sf, f"raw_{part}"),
        table(spark, sf, f"stg_{part}"),
        table(spark, sf, f"fct_{part}"),
    )
    return dt.layer_reconciliation(
        [
            chain("patient_admissions", "admission_id", "admissions"),
            chain("treatment_records", "treatment_id", "treatments"),
            chain("insurance_claims", "claim_id", "claims"),
        ]
    )


# ── joins ───────────────────────────────────────────────────────────────────────────────────────


def _named_admissions(spark, sf):
    fact = table(spark, sf, "fct_admissions").select("admission_id", "doctor_sk", "admit_date")
    return joins.inner_equi_join(fact, table(spark, sf, "dim_doctor"), "doctor_sk", "doctor_id")


_THEN = lambda: (F.col("specialty").alias("specialty_at_admission"), F.col("seniority_band").alias("seniority_at_admission"))


def asof(spark, sf):
    df = joins.asof_join_by_part(_named_admissions(spark, sf), table(spark, sf, "dim_doctor_history"), "doctor_id", "admit_date", *_THEN())
    return df.drop("doctor_sk")


def asof_by_year(spark, sf):
    df = joins.asof_join_by_year(
        _named_admissions(spark, sf), table(spark, sf, "dim_doctor_history"), "doctor_id", "admit_date", *_THEN()
    )
    return df.drop("doctor_sk")


def current(spark, sf):
    now = joins.current_join(
        _named_admissions(spark, sf), table(spark, sf, "dim_doctor_history"), "doctor_id", F.col("specialty").alias("current_specialty")
    )
    return now.select("admission_id", "doctor_id", "current_specialty")


def _later(spark, sf, name):
    return table(spark, sf, name).filter(F.col("load_dttm") > a.ntz(a.SPLIT_AT))


def semi(spark, sf):
    """All landed admissions of patients with a later one."""
    raw = table(spark, sf, "raw_admissions")
    return joins.in_keys(raw, _later(spark, sf, "raw_admissions"), "patient_id").select("admission_id", "patient_id", "load_dttm")


def either(spark, sf):
    """Landed treatments that share a procedure or an admission with a late one."""
    raw = table(spark, sf, "raw_treatments")
    late = _later(spark, sf, "raw_treatments")
    return joins.in_either(raw, late, "procedure_code", late, "admission_id").select(
        "treatment_id", "admission_id", "procedure_code", "load_dttm", "doctor_id"
    )


def not_exists(spark, sf):
    """Insurers listed only as long as no claim has an unknown insurer."""
    claims = table(spark, sf, "raw_claims").filter(F.length(F.trim("insurance_id")) > 3)
    return table(spark, sf, "dim_insurance").filter(~claims.exists())


def orphan_rows(spark, sf):
    bad = joins.orphans(table(spark, sf, "fct_admissions"), "hospital_sk", table(spark, sf, "dim_hospital"), "hospital_sk")
    return bad.select("admission_id", "hospital_sk")


def star(spark, sf):
    """Admissions with columns of their four dimensions."""
    t = lambda n: table(spark, sf, n)
    fact = t("fct_admissions").select("admission_id", "patient_sk", "doctor_sk", "hospital_sk", "date_sk", "length_of_stay")
    return serving.star_join(
        fact,
        (t("dim_doctor"), "doctor_sk", ["specialty"]),
        (t("dim_hospital"), "hospital_sk", ["hospital_name", "city"]),
        (t("dim_date"), "date_sk", ["year", "month", "is_weekend"]),
        (t("dim_patient"), "patient_sk", ["patient_segment"]),
    ).drop("patient_sk", "doctor_sk", "hospital_sk", "date_sk")


def drill(spark, sf):
    return serving.admission_drill_join(
        table(spark, sf, "fct_admissions"), table(spark, sf, "fct_treatments"), table(spark, sf, "fct_claims")
    )


# ── aggregates ──────────────────────────────────────────────────────────────────────────────────


def counts(spark, sf):
    return table(spark, sf, "raw_admissions").agg(F.count(F.lit(1)).alias("n"))


def conditional(spark, sf):
    return table(spark, sf, "raw_admissions").groupBy("file_name").agg(
        F.count_if(F.col("doctor_id").isNull()).alias("no_doctor"),
        F.count_if(F.col("length_of_stay") < 0).alias("negative_stay"),
        F.count_if(~F.col("admission_type").isin("EMG", "URG", "ELC")).alias("odd_type"),
    )


def having(spark, sf):
    repeated = table(spark, sf, "raw_treatments").groupBy("file_name", "treatment_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return repeated.groupBy("file_name").agg(F.count(F.lit(1)).alias("repeated_ids"))


QUERIES = {
    "test_unique": unique,
    "test_not_null": not_null,
    "test_accepted_values": accepted,
    "test_relationships": relationships,
    "test_suite": lambda s, d: dt.test_suite(_tables(s, d)),
    "key_catalog": lambda s, d: dt.key_catalog(_tables(s, d)),
    "layer_reconciliation": reconciliation,
    "inner_equi_join": lambda s, d: _named_admissions(s, d),
    "asof_scd2_join": asof,
    "asof_scd2_join_by_year": asof_by_year,
    "current_version_join": current,
    "semi_join_in": semi,
    "disjunctive_semi_join": either,
    "not_exists": not_exists,
    "anti_join_orphans": orphan_rows,
    "star_join": star,
    "admission_drill_join": drill,
    "patient_rollup": lambda s, d: gold.patient_rollup(table(s, d, "stg_admissions")),
    "global_count": counts,
    "conditional_count": conditional,
    "group_having": having,
    "max_watermark": lambda s, d: max_watermark(table(s, d, "stg_admissions_before")).select(F.col("watermark").alias("load_dttm")),
    "watermark_filter": lambda s, d: watermark_filter(table(s, d, "raw_claims"), table(s, d, "stg_claims_before")).select("claim_id", "load_dttm"),
    "kpi_admissions": lambda s, d: serving.kpi_admissions(table(s, d, "fct_admissions")),
    "kpi_claims": lambda s, d: serving.kpi_claims(
        serving.with_claim_month(table(s, d, "fct_claims"), table(s, d, "dim_date")), table(s, d, "dim_insurance")
    ),
    "kpi_treatment_cost": lambda s, d: serving.kpi_treatment_cost(table(s, d, "fct_treatments"), table(s, d, "dim_doctor")),
}


# ── SQL ─────────────────────────────────────────────────────────────────────────────────────────


def _rule_sql(r: dt.Rule) -> str:
    t, c = r.table, r.column
    failing = {
        "unique": f"SELECT count(*) FROM (SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)",
        "not_null": f"SELECT count(*) FROM {t} WHERE {c} IS NULL",
        "accepted_values": f"SELECT count(*) FROM {t} WHERE {c} NOT IN ({', '.join(repr(v) for v in r.values)})",
        "relationships": f"SELECT count(*) FROM {t} WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {c} FROM {r.to})",
    }[r.kind]
    return f"SELECT '{r.name}' AS test, ({failing}) AS failures"


def _pk_sql(t: str, k: str) -> str:
    return f"""SELECT 'PRIMARY KEY' AS kind, '{t}' AS table_name, '{k}' AS column_name, CAST(NULL AS VARCHAR) AS "references",
  (SELECT coalesce(sum(n), 0) FROM (SELECT {k}, count(*) AS n FROM {t} GROUP BY {k}) WHERE n > 1 OR {k} IS NULL) AS failures"""


def _fk_sql(t: str, k: str, p: str) -> str:
    return f"""SELECT 'FOREIGN KEY', '{t}', '{k}', '{p}', (SELECT count(*) FROM {t} WHERE {k} IS NOT NULL AND {k} NOT IN (SELECT {k} FROM {p}))"""


_keys_sql = " UNION ALL ".join([_pk_sql(t, k) for t, k in dt.PRIMARY_KEYS.items()] + [_fk_sql(*f) for f in dt.FOREIGN_KEYS])


def _recon_sql(name: str, key: str, part: str) -> str:
    return f"""SELECT '{name}' AS feed, (SELECT count(DISTINCT {key}) FROM raw_{part}) AS landed_keys, (SELECT count(*) FROM stg_{part}) AS cleaned_rows,
  (SELECT count(*) FROM fct_{part}) AS fact_rows"""


_recon = " UNION ALL ".join(
    _recon_sql(*x)
    for x in (("patient_admissions", "admission_id", "admissions"), ("treatment_records", "treatment_id", "treatments"), ("insurance_claims", "claim_id", "claims"))
)
_asof = query(
    """SELECT admission_id, CAST(admit_date AS VARCHAR) AS admit_date, f.doctor_id, h.specialty AS specialty_at_admission, h.seniority_band AS seniority_at_admission
FROM fct_admissions f JOIN dim_doctor_history h ON f.doctor_id = h.doctor_id AND admit_date >= valid_from AND admit_date < valid_to
WHERE f.doctor_id IN (SELECT doctor_id FROM dim_doctor)"""
)
ORACLE = {
    "test_unique": query("SELECT treatment_id, count(*) AS n FROM raw_treatments GROUP BY treatment_id HAVING count(*) > 1"),
    "test_not_null": query("SELECT admission_id, doctor_id FROM stg_admissions WHERE doctor_id IS NULL"),
    "test_accepted_values": query("SELECT claim_status, count(*) AS n FROM raw_claims WHERE claim_status NOT IN ('A', 'R', 'P') GROUP BY claim_status"),
    "test_relationships": query("SELECT admission_id, doctor_sk FROM fct_admissions WHERE doctor_sk NOT IN (SELECT doctor_sk FROM dim_doctor)"),
    "test_suite": query("SELECT *, failures = 0 AS passed FROM (" + " UNION ALL ".join(_rule_sql(r) for r in dt.RULES) + ")"),
    "key_catalog": query(f"SELECT * REPLACE (CAST(failures AS BIGINT) AS failures), failures = 0 AS passed FROM ({_keys_sql})"),
    "layer_reconciliation": query(f"SELECT *, cleaned_rows - landed_keys AS cleaned_difference, fact_rows - cleaned_rows AS fact_difference FROM ({_recon})"),
    "inner_equi_join": query(
        "SELECT admission_id, CAST(admit_date AS VARCHAR) AS admit_date, doctor_sk, d.doctor_id FROM fct_admissions f JOIN dim_doctor d USING (doctor_sk)"
    ),
    "asof_scd2_join": _asof,
    "asof_scd2_join_by_year": _asof,
    "current_version_join": query(
        "SELECT admission_id, doctor_id, specialty AS current_specialty FROM stg_admissions JOIN dim_doctor_history USING (doctor_id) WHERE is_current"
    ),
    "semi_join_in": query(
        f"SELECT {shown('admission_id', 'patient_id', 'load_dttm')} FROM raw_admissions WHERE patient_id IN (SELECT patient_id FROM raw_admissions WHERE NOT {m.split_filter()})"
    ),
    "disjunctive_semi_join": query(
        f"SELECT {shown('treatment_id', 'admission_id', 'procedure_code', 'load_dttm', 'doctor_id')} FROM raw_treatments "
        "WHERE procedure_code IN (SELECT procedure_code FROM late_rows) OR admission_id IN (SELECT admission_id FROM late_rows)",
        late_rows=f"SELECT * FROM raw_treatments WHERE NOT {m.split_filter()}",
    ),
    "not_exists": query("SELECT * FROM dim_insurance WHERE NOT EXISTS (SELECT 1 FROM raw_claims WHERE length(trim(insurance_id)) > 3)"),
    "anti_join_orphans": query("SELECT admission_id, hospital_sk FROM fct_admissions WHERE hospital_sk NOT IN (SELECT hospital_sk FROM dim_hospital)"),
    "star_join": query(
        """SELECT admission_id, length_of_stay, specialty, hospital_name, city, year, month, is_weekend, patient_segment FROM fct_admissions
JOIN dim_doctor USING (doctor_sk) JOIN dim_hospital USING (hospital_sk) JOIN dim_date USING (date_sk) JOIN dim_patient USING (patient_sk)"""
    ),
    "admission_drill_join": query(
        """SELECT admission_id, department, admission_type, treatments, total_cost, claims, claimed_total FROM stg_admissions
JOIN (SELECT admission_id, count(*) AS treatments, CAST(sum(cost) AS DOUBLE) AS total_cost FROM fct_treatments GROUP BY 1) USING (admission_id)
JOIN (SELECT admission_id, count(*) AS claims, CAST(sum(claim_amount) AS DOUBLE) AS claimed_total FROM fct_claims GROUP BY 1) USING (admission_id)"""
    ),
    "patient_rollup": query(f"SELECT {shown(*[c for c in m.DIM_PATIENT if c not in ('patient_sk', 'patient_segment')])} FROM dim_patient"),
    "global_count": query("SELECT count(*) AS n FROM raw_admissions"),
    "conditional_count": query(
        """SELECT file_name, count(*) FILTER (WHERE doctor_id IS NULL) AS no_doctor, count(*) FILTER (WHERE length_of_stay < 0) AS negative_stay,
  count(*) FILTER (WHERE admission_type NOT IN ('EMG', 'URG', 'ELC')) AS odd_type FROM raw_admissions GROUP BY file_name"""
    ),
    "group_having": query(
        "SELECT file_name, count(*) AS repeated_ids FROM (SELECT file_name, treatment_id FROM raw_treatments GROUP BY ALL HAVING count(*) > 1) GROUP BY file_name"
    ),
    "max_watermark": query(f"SELECT strftime(max(load_dttm), '%Y-%m-%d %H:%M:%S') AS load_dttm FROM latest_admissions_before",
        latest_admissions_before=f"SELECT * FROM raw_admissions WHERE {m.split_filter()}"),
    "watermark_filter": query(
        f"SELECT claim_id, {shown('load_dttm')} FROM raw_claims WHERE load_dttm > (SELECT max(load_dttm) FROM raw_claims WHERE {m.split_filter()})"
    ),
    "kpi_admissions": query(
        """SELECT department, admission_type, strftime(date_trunc('month', admit_date), '%Y-%m-%d') AS month, count(*) AS admissions,
  sign(sum(length_of_stay)) * ((2 * 100 * abs(sum(length_of_stay)) + count(length_of_stay)) // (2 * count(length_of_stay))) / 100.0 AS avg_length_of_stay,
  ((2 * 10000 * count(*) FILTER (WHERE is_30day_readmission) + count(*)) // (2 * count(*))) / 10000.0 AS readmission_rate
FROM fct_admissions GROUP BY 1, 2, 3"""
    ),
    "kpi_claims": query(
        """SELECT insurer_name, strftime(date_trunc('month', date_day), '%Y-%m-%d') AS month, count(*) AS claims,
  ((2 * 10000 * count(*) FILTER (WHERE is_approved) + count(*)) // (2 * count(*))) / 10000.0 AS approval_rate,
  CAST(sum(approved_amount) AS DOUBLE) AS approved_total, CAST(sum(unapproved_amount) AS DOUBLE) AS unapproved_total,
  sign(sum(days_to_settle)) * ((2 * 100 * abs(sum(days_to_settle)) + count(days_to_settle)) // (2 * count(days_to_settle))) / 100.0 AS avg_days_to_settle
FROM fct_claims JOIN dim_date USING (date_sk) JOIN dim_insurance USING (insurance_sk) GROUP BY 1, 2"""
    ),
    "kpi_treatment_cost": query(
        """SELECT procedure_code, specialty, count(*) AS treatments, CAST(sum(cost) AS DOUBLE) AS total_cost,
  sign(sum(cents)) * ((2 * abs(sum(cents)) + count(*)) // (2 * count(*))) / 100.0 AS avg_cost,
  ((2 * 10000 * count(*) FILTER (WHERE is_success) + count(*)) // (2 * count(*))) / 10000.0 AS success_rate,
  count(*) FILTER (WHERE is_cost_outlier) AS outliers
FROM fct_treatments JOIN dim_doctor USING (doctor_sk) GROUP BY 1, 2"""
    ),
}
