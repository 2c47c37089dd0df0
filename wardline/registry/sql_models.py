"""The feeds and models stated in SQL for the side-by-side check.

Named relations are kept in a dictionary; ``query`` puts the ones a statement needs in front of it.
"""

from __future__ import annotations

import re

from wardline.functions.rules import (
    ADMISSION_TYPES,
    CLAIM_STATUSES,
    MAX_STAY_DAYS,
    OUTCOMES,
    READMISSION_DAYS,
    SEGMENTS,
    SENIORITY,
)
from wardline.registry.adapters import AS_OF, FIRST_SNAPSHOT, SECOND_SNAPSHOT, SPECIALTIES, SPLIT_AT

DATES = {"admit_date", "discharge_date", "treatment_date", "claim_date", "settle_date", "date_day",
         "first_admit_date", "last_admit_date", "first_day", "last_day"}
STAMPS = {"upload_dttm", "load_dttm", "valid_from", "valid_to", "updated_at", "processed_at", "checked_at", "failed_at", "added_at"}
REALS = {"cost", "claim_amount", "approved_amount", "unapproved_amount", "approval_ratio", "cost_zscore",
         "avg_cost_for_procedure", "total_cost", "avg_cost", "success_rate", "approval_rate", "approved_total",
         "unapproved_total", "avg_days_to_settle", "avg_length_of_stay", "readmission_rate", "claimed_total"}


def shown(*columns: str) -> str:
    """Select list with the plain result types of ``registry.compare``."""
    out = []
    for c in columns:
        if c in DATES:
            out.append(f"CAST({c} AS VARCHAR) AS {c}")
        elif c in STAMPS:
            out.append(f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}")
        elif c in REALS:
            out.append(f"CAST({c} AS DOUBLE) AS {c}")
        else:
            out.append(c)
    return ", ".join(out)


def _labels(code: str, labels: dict[str, str]) -> str:
    arms = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in labels.items())
    return f"CASE {code} {arms} ELSE 'Unknown' END"


def _steps(value: str, steps, default: str) -> str:
    arms = " ".join(f"WHEN {value} >= {low} THEN '{label}'" for low, label in steps)
    return f"CASE {arms} ELSE '{default}' END"


def parsed(c: str) -> str:
    return f"CAST(coalesce(try_strptime({c}, '%Y-%m-%d'), try_strptime({c}, '%d/%m/%Y')) AS DATE)"


def key_of(*columns: str) -> str:
    parts = [f"coalesce(CAST({c} AS VARCHAR), '_dbt_utils_surrogate_key_null_')" for c in columns]
    return "md5(" + " || '-' || ".join(parts) + ")"


def millis(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S.%g')"


def code(c: str) -> str:
    return f"upper(trim({c}))"


def newest(relation: str, key: str, columns: list[str]) -> str:
    order = ", ".join(["load_dttm DESC NULLS FIRST"] + [f"{c} DESC NULLS LAST" for c in columns])
    return f"SELECT * FROM {relation} QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {order}) = 1"


RELATIONS: dict[str, str] = {}

# ── feeds ───────────────────────────────────────────────────────────────────────────────────────

RELATIONS["raw_admissions"] = """
SELECT o_orderkey AS admission_id, o_custkey AS patient_id,
  CASE WHEN o_orderkey % 97 = 0 THEN NULL
       WHEN o_orderkey % 5 = 0 THEN ' d' || lpad(CAST(o_orderkey % 10 AS VARCHAR), 3, '0') || ' '
       ELSE 'D' || lpad(CAST(o_orderkey % 10 AS VARCHAR), 3, '0') END AS doctor_id,
  CASE WHEN o_orderkey % 89 <> 0 THEN 'H' || lpad(CAST(o_orderkey % 25 AS VARCHAR), 2, '0') END AS hospital_id,
  CASE WHEN o_orderkey % 211 = 0 THEN 'n/a'
       WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%d/%m/%Y')
       ELSE strftime(o_orderdate, '%Y-%m-%d') END AS admit_date,
  substr(o_orderpriority, 3, 3) AS department,
  CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'EMG' WHEN '2' THEN ' urg ' WHEN '3' THEN 'ELC' ELSE 'ZZZ' END AS admission_type,
  ' dx' || CAST(o_orderkey % 40 AS VARCHAR) AS diagnosis_code,
  CASE WHEN o_orderkey % 101 = 0 THEN -1 WHEN o_orderkey % 103 = 0 THEN 400 ELSE o_orderkey % 12 + v END AS length_of_stay,
  CASE WHEN o_orderkey % 4 = 0 THEN 1 ELSE 0 END AS readmission_flag,
  'patient_admissions_' || CAST(year(o_orderdate) AS VARCHAR) || '.csv' AS file_name,
  o_orderdate + to_days(v) AS upload_dttm,
  o_orderdate + to_days(v + 1) AS load_dttm
FROM orders, (VALUES (0), (1)) AS versions(v)
WHERE v = 0 OR o_orderkey % 10 = 0"""

RELATIONS["raw_treatments"] = """
SELECT l_orderkey * 10 + l_linenumber AS treatment_id, l_orderkey AS admission_id,
  'D' || lpad(CAST(l_suppkey % 10 AS VARCHAR), 3, '0') AS doctor_id,
  ' ' || lower(p_brand) AS procedure_code,
  CASE WHEN l_orderkey % 53 = 0 THEN 'soon'
       WHEN l_orderkey % 3 = 0 THEN strftime(l_shipdate, '%d/%m/%Y')
       ELSE strftime(l_shipdate, '%Y-%m-%d') END AS treatment_date,
  CAST(CASE WHEN (l_orderkey + l_linenumber) % 83 = 0 THEN -CAST(l_extendedprice AS DECIMAL(12,2))
       ELSE CAST(l_extendedprice AS DECIMAL(12,2)) END AS DECIMAL(12,2)) AS cost,
  CASE WHEN l_orderkey % 47 = 0 THEN 'Q' WHEN l_returnflag = 'A' THEN 's' WHEN l_returnflag = 'R' THEN 'F' ELSE 'P' END AS outcome,
  'treatment_records_' || CAST(year(l_shipdate) AS VARCHAR) || '.csv' AS file_name,
  l_shipdate AS upload_dttm, l_shipdate AS load_dttm
FROM lineitem JOIN part ON l_partkey = p_partkey"""

RELATIONS["raw_claims"] = """
SELECT o_orderkey AS claim_id, o_orderkey AS admission_id,
  ' i' || lpad(CAST(o_orderkey % 5 + 1 AS VARCHAR), 2, '0') AS insurance_id,
  CASE WHEN o_orderkey % 61 = 0 THEN CAST(0 AS DECIMAL(12,2)) ELSE CAST(o_totalprice AS DECIMAL(12,2)) END AS claim_amount,
  CASE WHEN o_orderkey % 53 = 0 THEN CAST(500000 AS DECIMAL(12,2))
       WHEN o_orderkey % 59 = 0 OR o_orderstatus = 'P' THEN NULL
       WHEN o_orderstatus = 'O' THEN CAST(0 AS DECIMAL(12,2))
       ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) * CAST(o_orderkey % 10 AS DECIMAL(2,0)) * CAST(0.1 AS DECIMAL(2,1)) AS DECIMAL(12,2))
       END AS approved_amount,
  CASE WHEN o_orderkey % 71 = 0 THEN 'X' WHEN o_orderstatus = 'F' THEN 'A' WHEN o_orderstatus = 'O' THEN 'R' ELSE ' p' END AS claim_status,
  CASE WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%d/%m/%Y') ELSE strftime(o_orderdate, '%Y-%m-%d') END AS claim_date,
  CASE WHEN o_orderkey % 4 = 0 THEN strftime(settled, '%d/%m/%Y') ELSE strftime(settled, '%Y-%m-%d') END AS settle_date,
  'insurance_claims_' || CAST(year(o_orderdate) AS VARCHAR) || '.csv' AS file_name,
  o_orderdate AS upload_dttm, o_orderdate AS load_dttm
FROM (SELECT *, CASE WHEN o_orderstatus = 'P' THEN NULL
                     WHEN o_orderkey % 67 = 0 THEN o_orderdate - to_days(3)
                     ELSE o_orderdate + to_days(CAST(o_orderkey % 45 AS INTEGER)) END AS settled FROM orders)"""

RELATIONS["doctors"] = f"""
SELECT 'D' || lpad(CAST(s_suppkey AS VARCHAR), greatest(3, length(CAST(s_suppkey AS VARCHAR)))::INTEGER, '0') AS doctor_id, s_name AS doctor_name,
  list_extract([{", ".join(f"'{x}'" for x in SPECIALTIES)}], s_nationkey % {len(SPECIALTIES)} + 1) AS specialty,
  s_suppkey % 36 AS years_experience
FROM supplier"""

RELATIONS["doctors_later"] = """
SELECT doctor_id,
  CASE WHEN CAST(substr(doctor_id, 2) AS BIGINT) % 4 = 1 THEN upper(doctor_name) ELSE doctor_name END AS doctor_name,
  CASE WHEN CAST(substr(doctor_id, 2) AS BIGINT) % 3 = 0 THEN 'Telehealth' ELSE specialty END AS specialty,
  years_experience
FROM doctors WHERE CAST(substr(doctor_id, 2) AS BIGINT) % 7 <> 6"""

RELATIONS["hospitals"] = """
SELECT 'H' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS hospital_id, n_name AS hospital_name,
  'City ' || CAST(n_regionkey AS VARCHAR) AS city FROM nation"""

RELATIONS["insurers"] = """
SELECT 'I' || lpad(CAST(r_regionkey + 1 AS VARCHAR), 2, '0') AS insurance_id, r_name AS insurer_name FROM region"""

# ── cleaned feeds ───────────────────────────────────────────────────────────────────────────────

ADM_REST = ["upload_dttm", "file_name", "patient_id", "doctor_id", "hospital_id", "admit_date", "department",
            "admission_type", "diagnosis_code", "length_of_stay", "readmission_flag"]
TRT_REST = ["upload_dttm", "file_name", "admission_id", "doctor_id", "procedure_code", "treatment_date", "cost", "outcome"]
CLM_REST = ["upload_dttm", "file_name", "admission_id", "insurance_id", "claim_amount", "approved_amount",
            "claim_status", "claim_date", "settle_date"]

RELATIONS["latest_admissions"] = newest("raw_admissions", "admission_id", ADM_REST)
RELATIONS["latest_treatments"] = newest("raw_treatments", "treatment_id", TRT_REST)
RELATIONS["latest_claims"] = newest("raw_claims", "claim_id", CLM_REST)

RELATIONS["visits"] = f"""
SELECT * EXCLUDE (admitted, left_on), admitted AS admit_date, left_on AS discharge_date,
  row_number() OVER seen AS patient_visit_seq,
  count(*) OVER (PARTITION BY patient_id) AS patient_total_visits,
  date_diff('day', lag(left_on) OVER seen, admitted) AS days_since_last_visit
FROM (
  SELECT *, admitted + CAST(length_of_stay AS INTEGER) AS left_on FROM (
    SELECT admission_id, patient_id, {code('doctor_id')} AS doctor_id, {code('hospital_id')} AS hospital_id,
      {parsed('admit_date')} AS admitted, length_of_stay,
      {_labels(code('admission_type'), ADMISSION_TYPES)} AS admission_type,
      {code('department')} AS department, {code('diagnosis_code')} AS diagnosis_code,
      readmission_flag <> 0 AS source_readmission_flag, file_name, upload_dttm, load_dttm, 'GATEKEEPER' AS source_system
    FROM latest_admissions))
WINDOW seen AS (PARTITION BY patient_id ORDER BY admitted NULLS LAST, admission_id NULLS LAST)"""

STATUS_ADMISSION = f"""
  CASE WHEN days_since_last_visit < 0 THEN 'OVERLAPPING_ADMISSION'
       WHEN length_of_stay < 0 THEN 'INVALID_NEGATIVE_LOS'
       WHEN length_of_stay > {MAX_STAY_DAYS} THEN 'INVALID_EXCESSIVE_LOS'
       WHEN admit_date > DATE '{AS_OF}' THEN 'INVALID_FUTURE_DATE'
       WHEN doctor_id IS NULL THEN 'MISSING_DOCTOR'
       WHEN hospital_id IS NULL THEN 'MISSING_HOSPITAL'
       ELSE 'VALID' END"""
VALID_ADMISSION = f"""
  coalesce(length_of_stay >= 0 AND length_of_stay <= {MAX_STAY_DAYS} AND admit_date <= DATE '{AS_OF}'
           AND doctor_id IS NOT NULL AND hospital_id IS NOT NULL, FALSE)"""

STG_ADMISSIONS = ["admission_id", "patient_id", "doctor_id", "hospital_id", "admit_date", "discharge_date", "length_of_stay",
                  "admission_type", "department", "diagnosis_code", "source_readmission_flag", "patient_visit_seq",
                  "patient_total_visits", "is_30day_readmission", "days_since_last_visit", "dq_status", "is_valid",
                  "file_name", "upload_dttm", "load_dttm", "source_system"]
RELATIONS["stg_admissions"] = f"""
SELECT *, coalesce(days_since_last_visit BETWEEN 0 AND {READMISSION_DAYS}, FALSE) AS is_30day_readmission,
  {STATUS_ADMISSION} AS dq_status, {VALID_ADMISSION} AS is_valid FROM visits"""

RELATIONS["clean_treatments"] = f"""
SELECT treatment_id, admission_id, {code('doctor_id')} AS doctor_id, {code('procedure_code')} AS procedure_code,
  {parsed('treatment_date')} AS treatment_date, cost, {_labels(code('outcome'), OUTCOMES)} AS outcome,
  CAST(cost * 100 AS HUGEINT) AS cents, 'GATEKEEPER' AS source_system, file_name, upload_dttm, load_dttm
FROM latest_treatments"""

RELATIONS["procedure_stats"] = """
SELECT procedure_code, n, s, sign(s) * ((2 * abs(s) + n) // (2 * n)) AS mean_cents,
  CASE WHEN n > 1 THEN sqrt(CAST(n * q - s * s AS DOUBLE) / (n * CAST(n - 1 AS DOUBLE))) END AS sd,
  lo * (100 - rest) + hi * rest AS p99_x100
FROM (
  SELECT procedure_code, n, any_value(rest) AS rest, sum(cents) AS s, sum(cents * cents) AS q,
    max(cents) FILTER (WHERE place = base) AS lo,
    max(cents) FILTER (WHERE place = base + CASE WHEN rest > 0 THEN 1 ELSE 0 END) AS hi
  FROM (
    SELECT *, ((n - 1) * 99) // 100 AS base, ((n - 1) * 99) % 100 AS rest FROM (
      SELECT procedure_code, cents, count(*) OVER (PARTITION BY procedure_code) AS n,
        row_number() OVER (PARTITION BY procedure_code ORDER BY cents) - 1 AS place
      FROM clean_treatments WHERE cost IS NOT NULL))
  GROUP BY procedure_code, n)"""

STG_TREATMENTS = ["treatment_id", "admission_id", "doctor_id", "procedure_code", "treatment_date", "cost", "outcome",
                  "treatment_seq_in_admission", "treatments_in_admission", "avg_cost_for_procedure", "cost_zscore",
                  "is_cost_outlier", "is_success", "dq_status", "source_system", "file_name", "upload_dttm", "load_dttm"]
RELATIONS["stg_treatments"] = """
SELECT t.*, row_number() OVER (PARTITION BY t.admission_id ORDER BY t.treatment_date NULLS LAST, t.treatment_id NULLS LAST) AS treatment_seq_in_admission,
  count(*) OVER (PARTITION BY t.admission_id) AS treatments_in_admission,
  mean_cents / 100.0 AS avg_cost_for_procedure,
  CASE WHEN sd > 0 THEN abs(round(abs(CAST(t.cents * n - s AS DOUBLE)) / (CAST(n AS DOUBLE) * sd), 2)) * CASE WHEN t.cents * n < s AND round(abs(CAST(t.cents * n - s AS DOUBLE)) / (CAST(n AS DOUBLE) * sd), 2) > 0 THEN -1 ELSE 1 END ELSE 0 END AS cost_zscore,
  coalesce(t.cents * 100 > p99_x100, FALSE) AS is_cost_outlier,
  outcome = 'Success' AS is_success,
  CASE WHEN cost < 0 THEN 'INVALID_NEGATIVE_COST' WHEN treatment_date IS NULL THEN 'MISSING_DATE'
       WHEN outcome = 'Unknown' THEN 'INVALID_OUTCOME' ELSE 'VALID' END AS dq_status
FROM clean_treatments t LEFT JOIN procedure_stats p ON t.procedure_code IS NOT DISTINCT FROM p.procedure_code"""

STG_CLAIMS = ["claim_id", "admission_id", "insurance_id", "claim_amount", "approved_amount", "claim_status", "claim_date",
              "settle_date", "days_to_settle", "approval_ratio", "unapproved_amount", "is_approved", "is_pending",
              "dq_status", "source_system", "file_name", "upload_dttm", "load_dttm"]
RELATIONS["clean_claims"] = f"""
SELECT claim_id, admission_id, {code('insurance_id')} AS insurance_id, claim_amount, approved_amount,
  {_labels(code('claim_status'), CLAIM_STATUSES)} AS claim_status, {parsed('claim_date')} AS claim_date,
  {parsed('settle_date')} AS settle_date, 'GATEKEEPER' AS source_system, file_name, upload_dttm, load_dttm
FROM latest_claims"""
RELATIONS["stg_claims"] = """
SELECT *, date_diff('day', claim_date, settle_date) AS days_to_settle,
  CASE WHEN claim_status = 'Approved' AND claim_amount > 0 THEN
    ((CAST(approved_amount * 100 AS HUGEINT) * 20000 + CAST(claim_amount * 100 AS HUGEINT)) // (2 * CAST(claim_amount * 100 AS HUGEINT))) / 10000.0
    END AS approval_ratio,
  claim_amount - approved_amount AS unapproved_amount,
  claim_status = 'Approved' AS is_approved, claim_status = 'Pending' AS is_pending,
  CASE WHEN approved_amount > claim_amount THEN 'APPROVED_EXCEEDS_CLAIM' WHEN claim_amount <= 0 THEN 'INVALID_CLAIM_AMOUNT'
       WHEN settle_date < claim_date THEN 'SETTLE_BEFORE_CLAIM'
       WHEN claim_status = 'Approved' AND approved_amount IS NULL THEN 'APPROVED_BUT_NO_AMOUNT'
       WHEN claim_status = 'Unknown' THEN 'INVALID_STATUS' ELSE 'VALID' END AS dq_status
FROM clean_claims"""

# ── star schema ─────────────────────────────────────────────────────────────────────────────────

DIM_DOCTOR = ["doctor_sk", "doctor_id", "doctor_name", "specialty", "years_experience", "seniority_band"]
for _name, _source in (("dim_doctor", "doctors"), ("dim_doctor_later", "doctors_later")):
    RELATIONS[_name] = f"""
SELECT {key_of('doctor_id')} AS doctor_sk, *, {_steps('years_experience', SENIORITY, 'Unknown')} AS seniority_band FROM {_source}"""
DIM_HOSPITAL = ["hospital_sk", "hospital_id", "hospital_name", "city"]
RELATIONS["dim_hospital"] = f"SELECT {key_of('hospital_id')} AS hospital_sk, * FROM hospitals"
DIM_INSURANCE = ["insurance_sk", "insurance_id", "insurer_name"]
RELATIONS["dim_insurance"] = f"SELECT {key_of('insurance_id')} AS insurance_sk, * FROM insurers"
DIM_PATIENT = ["patient_sk", "patient_id", "total_admissions", "first_admit_date", "last_admit_date", "readmission_count",
               "patient_segment"]
RELATIONS["dim_patient"] = f"""
SELECT {key_of('patient_id')} AS patient_sk, *, {_steps('total_admissions', SEGMENTS, 'One-time')} AS patient_segment FROM (
  SELECT patient_id, count(*) AS total_admissions, min(admit_date) AS first_admit_date, max(admit_date) AS last_admit_date,
    count(*) FILTER (WHERE is_30day_readmission) AS readmission_count
  FROM stg_admissions GROUP BY patient_id)"""
DIM_DATE = ["date_sk", "date_day", "year", "quarter", "month", "month_name", "day_of_month", "day_of_week", "day_name", "is_weekend"]
RELATIONS["spine"] = """
SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date_day
FROM (SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders)"""
RELATIONS["dim_date"] = f"""
SELECT {key_of('date_day')} AS date_sk, date_day, year(date_day) AS year, quarter(date_day) AS quarter, month(date_day) AS month,
  strftime(date_day, '%b') AS month_name, day(date_day) AS day_of_month, dayofweek(date_day) AS day_of_week,
  strftime(date_day, '%a') AS day_name, dayofweek(date_day) IN (0, 6) AS is_weekend FROM spine"""

SCD_DOCTORS = ["doctor_id", "doctor_name", "specialty", "years_experience", "seniority_band", "version_id", "updated_at",
               "valid_from", "valid_to"]


def _open_version(relation: str, at: str) -> str:
    stamp = f"TIMESTAMP '{at}'"
    return f"""SELECT doctor_id, doctor_name, specialty, years_experience, seniority_band,
  md5(doctor_id || '|' || {millis(stamp)}) AS version_id, {stamp} AS updated_at, {stamp} AS valid_from,
  CAST(NULL AS TIMESTAMP) AS valid_to FROM {relation}"""


RELATIONS["scd_first"] = _open_version("dim_doctor", FIRST_SNAPSHOT)
RELATIONS["scd_offered"] = _open_version("dim_doctor_later", SECOND_SNAPSHOT)
RELATIONS["scd_kept"] = """
SELECT f.* FROM scd_first f JOIN scd_offered o USING (doctor_id)
WHERE (f.specialty, f.years_experience, f.seniority_band) IS NOT DISTINCT FROM (o.specialty, o.years_experience, o.seniority_band)"""
RELATIONS["scd_doctors"] = f"""
SELECT * FROM scd_kept
UNION ALL SELECT * REPLACE (TIMESTAMP '{SECOND_SNAPSHOT}' AS updated_at, TIMESTAMP '{SECOND_SNAPSHOT}' AS valid_to)
  FROM scd_first WHERE doctor_id NOT IN (SELECT doctor_id FROM scd_kept)
UNION ALL SELECT * FROM scd_offered WHERE doctor_id NOT IN (SELECT doctor_id FROM scd_kept)"""
DOCTOR_HISTORY = ["doctor_history_sk", "doctor_id", "doctor_name", "specialty", "years_experience", "seniority_band",
                  "valid_from", "valid_to", "is_current"]
RELATIONS["dim_doctor_history"] = f"""
SELECT md5(doctor_id || '-' || {millis('valid_from')}) AS doctor_history_sk, doctor_id, doctor_name, specialty,
  years_experience, seniority_band, valid_to IS NULL AS is_current,
  CASE WHEN valid_from = min(valid_from) OVER (PARTITION BY doctor_id) THEN TIMESTAMP '1900-01-01' ELSE valid_from END AS valid_from,
  coalesce(valid_to, TIMESTAMP '9999-12-31') AS valid_to
FROM scd_doctors"""

FCT_ADMISSIONS = ["admission_id", "patient_sk", "doctor_sk", "hospital_sk", "date_sk", "admit_date", "discharge_date",
                  "length_of_stay", "admission_type", "department", "diagnosis_code", "is_30day_readmission",
                  "patient_visit_seq", "dq_status", "is_valid", "file_name", "load_dttm"]
RELATIONS["fct_admissions"] = f"""
SELECT *, {key_of('patient_id')} AS patient_sk, {key_of('doctor_id')} AS doctor_sk, {key_of('hospital_id')} AS hospital_sk,
  {key_of('admit_date')} AS date_sk FROM stg_admissions"""
FCT_TREATMENTS = ["treatment_id", "admission_id", "doctor_sk", "date_sk", "procedure_code", "treatment_date", "cost", "outcome",
                  "is_success", "cost_zscore", "is_cost_outlier", "dq_status", "file_name", "load_dttm"]
RELATIONS["fct_treatments"] = f"""
SELECT *, {key_of('doctor_id')} AS doctor_sk, {key_of('treatment_date')} AS date_sk FROM stg_treatments"""
FCT_CLAIMS = ["claim_id", "admission_id", "insurance_sk", "date_sk", "claim_amount", "approved_amount", "unapproved_amount",
              "claim_status", "approval_ratio", "days_to_settle", "is_approved", "is_pending", "dq_status", "file_name", "load_dttm"]
RELATIONS["fct_claims"] = f"""
SELECT *, {key_of('insurance_id')} AS insurance_sk, {key_of('claim_date')} AS date_sk FROM stg_claims"""
ENRICHED = ["admission_id", "admit_date", "discharge_date", "length_of_stay", "admission_type", "department",
            "is_30day_readmission", "doctor_id", "specialty_at_admission", "seniority_at_admission", "current_specialty",
            "specialty_changed_since"]
RELATIONS["fct_admissions_enriched"] = """
SELECT a.* EXCLUDE (doctor_id), d.doctor_id, h.specialty AS specialty_at_admission, h.seniority_band AS seniority_at_admission,
  c.specialty AS current_specialty, coalesce(h.specialty <> c.specialty, FALSE) AS specialty_changed_since
FROM fct_admissions a JOIN dim_doctor d USING (doctor_sk)
JOIN dim_doctor_history h ON h.doctor_id = d.doctor_id AND h.valid_from <= a.admit_date AND a.admit_date < h.valid_to
JOIN dim_doctor_history c ON c.doctor_id = d.doctor_id AND c.is_current"""


def query(body: str, **more: str) -> str:
    """``body`` preceded by the relations it uses, directly or through others."""
    known = {**RELATIONS, **more}
    order = list(known)
    wanted: set[str] = set()

    def visit(text: str) -> None:
        for name in set(re.findall(r"[A-Za-z_0-9]+", text)) & known.keys():
            if name not in wanted:
                wanted.add(name)
                visit(known[name])

    visit(body)
    used = sorted(wanted, key=order.index)
    if not used:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({known[n].strip()}\n)" for n in used) + "\n" + body


def table(relation: str, columns: list[str]) -> str:
    return query(f"SELECT {shown(*columns)} FROM {relation}")


def split_filter(column: str = "load_dttm") -> str:
    return f"{column} <= TIMESTAMP '{SPLIT_AT}'"
