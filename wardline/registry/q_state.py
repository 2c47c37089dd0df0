"""Groups B and I: upserts, incremental steps, history, logs and other writes."""

from __future__ import annotations

from functools import cache

from pyspark.sql import functions as F

from wardline.feeds import CLAIMS, FEEDS
from wardline.functions.dates import millis_text
from wardline.operators import incremental as inc
from wardline.operators import lognotes
from wardline.plans import gold
from wardline.registry import adapters as a
from wardline.registry import gate_files as g
from wardline.registry import q_gate
from wardline.registry import sql_models as m
from wardline.registry.layers import snapshot_two, table
from wardline.registry.sql_models import query, shown
from wardline.session import scratch_path, written
from wardline.sinks import audit, bronze, route
from wardline.sinks import tables as t
from wardline.sinks.store import TableStore

LOADED_AT = "2026-06-29 13:02:45"


# ── upserts ─────────────────────────────────────────────────────────────────────────────────────


def merge(spark, sf):
    """A stored table of earlier claims, upserted with the later ones and read back."""
    store = TableStore(spark, scratch_path(spark, "claims-by-range"))
    tx = store.begin()
    tx.replace("stg_claims", table(spark, sf, "stg_claims_before"), "claim_id")
    tx.publish()
    later = table(spark, sf, "stg_claims").filter(F.col("load_dttm") > a.ntz(a.SPLIT_AT))
    tx = store.begin()
    tx.upsert("stg_claims", later)
    tx.publish()
    return store.table("stg_claims")


def upserted_fact(spark, sf, name, to_fact, key):
    """A fact of earlier rows, upserted with the rows that differ today."""
    before = table(spark, sf, f"fct_{name}_before")
    changed = inc.incr_facts(before, table(spark, sf, f"stg_{name}"), to_fact, key)
    return t.merge_upsert(before, written(changed, "changed-facts"), key)


def schema_sync(spark, sf):
    """A stored table with a column the later rows lack, and without one they have."""
    store = TableStore(spark, scratch_path(spark, "claims-synced"))
    tx = store.begin()
    tx.replace("stg_claims", table(spark, sf, "stg_claims_before").drop("is_pending").withColumn("retired", F.lit("x")), "claim_id")
    tx.publish()
    later = table(spark, sf, "stg_claims").filter(F.col("load_dttm") > a.ntz(a.SPLIT_AT))
    tx = store.begin()
    tx.upsert("stg_claims", later)
    tx.publish()
    return store.table("stg_claims")


def refresh(spark, sf):
    prefix, root = _catalog(spark)
    t.full_refresh(table(spark, sf, "stg_claims_before"), "staging", "stg_claims", prefix)
    return t.full_refresh(table(spark, sf, "stg_claims"), "staging", "stg_claims", prefix)


@cache
def _catalog_for(app: str, spark) -> tuple[str, str]:
    root = scratch_path(spark, "catalog")
    prefix = "wl_" + root[-8:] + "_"
    t.ensure_layers(spark, root, prefix)
    return prefix, root


def _catalog(spark) -> tuple[str, str]:
    return _catalog_for(spark.sparkContext.applicationId, spark)


def ensure(spark, sf):
    """Layers with their empty typed tables, then one landed load per feed, counted by table."""
    root = scratch_path(spark, "layers")
    prefix = "wl_" + root[-8:] + "_"
    t.ensure_layers(spark, root, prefix)
    t.ensure_layers(spark, root, prefix)  # a second call finds everything in place
    out = None
    for feed, raw in (("patient_admissions", "raw_admissions"), ("treatment_records", "raw_treatments"), ("insurance_claims", "raw_claims")):
        full = f"{t.database('raw', prefix)}.{feed}"
        table(spark, sf, raw).select(*FEEDS[feed].landing_schema.names).write.insertInto(full)
        n = t.layer_table(spark, "raw", feed, prefix).agg(F.count(F.lit(1)).alias("row_count"))
        out = n.select(F.lit(feed).alias("table_name"), "row_count") if out is None else out.unionByName(
            n.select(F.lit(feed).alias("table_name"), "row_count"))
    for name in t.AUDIT_TABLES:
        n = t.layer_table(spark, "audit", name, prefix).agg(F.count(F.lit(1)).alias("row_count"))
        out = out.unionByName(n.select(F.lit(name).alias("table_name"), "row_count"))
    return out


def listing(spark, sf):
    """Tables of the marts layer after the star schema was saved there, with their row counts."""
    prefix, _ = _catalog(spark)
    for name in ("dim_patient", "dim_doctor", "fct_admissions", "fct_claims"):
        t.full_refresh(table(spark, sf, name), "marts", name, prefix)
    out = None
    for name in t.catalog_listing(spark, "marts", prefix):
        n = t.layer_table(spark, "marts", name, prefix).agg(F.count(F.lit(1)).alias("row_count"))
        n = n.select(F.lit(name).alias("table_name"), "row_count")
        out = n if out is None else out.unionByName(n)
    return out


def layer_scan(spark, sf):
    prefix, _ = _catalog(spark)
    t.full_refresh(table(spark, sf, "raw_claims"), "raw", "seen_claims", prefix)
    assert t.layer_name(" raw ", "public") == "RAW"
    return t.layer_table(spark, t.layer_name(" raw ", "public"), "SEEN_CLAIMS", prefix)


def append(spark, sf):
    """Two loads into one landing table; each reports its own rows."""
    path = scratch_path(spark, "landing")
    raw = table(spark, sf, "raw_claims")
    first = bronze.append_with_count(raw.filter(F.col("load_dttm") <= a.ntz(a.SPLIT_AT)), path, "b1")
    second = bronze.append_with_count(raw.filter(F.col("load_dttm") > a.ntz(a.SPLIT_AT)), path, "b2")
    landed = spark.read.parquet(path).groupBy("batch_id").agg(F.count(F.lit(1)).alias("rows_found"))
    told = F.when(F.col("batch_id") == "b1", first).otherwise(second)
    return landed.withColumn("rows_reported", told.cast("long"))


def quarantine(spark, sf):
    path = scratch_path(spark, "routed")
    verdicts = written(q_gate.verdicts(spark, sf), "verdicts")
    route.write_lines(route.routed_lines(g.gate_lines(spark, sf), verdicts, "20260629_130245"), path)
    back = spark.read.text(path)
    return back.groupBy("folder", "run_stamp", "file_name").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.length("value")).alias("characters")
    )


# ── logs ────────────────────────────────────────────────────────────────────────────────────────


def recipients(spark, sf):
    n = a.read(spark, sf, "nation")
    k = F.col("n_nationkey")
    return n.select(
        F.concat(F.lower("n_name"), F.lit("@example.org")).alias("recipient_email"),
        F.when(k % 2 == 0, "DQ_FAILURE").otherwise("OTHER").alias("alert_type"),
        (k % 3 == 0).alias("is_active"),
        a.ntz("2026-01-01 00:00:00").alias("added_at"),
    )


def log_lines(spark, sf):
    """One line per event, some of them errors, some coloured; ten runs per task."""
    e, k = a.read(spark, sf, "events"), F.col("event_id")
    task = F.element_at(
        F.array(*[F.lit(x) for x in ("dbt_run", "dbt_snapshot", "dbt_test", "reconciliation", "load_step")]), (k % 5 + 1).cast("int")
    )
    model = F.concat(F.lit("stg_"), F.col("event_type"), F.lit("_"), (F.col("user_id") % 4).cast("string"))
    esc = "\x1b"
    line = (
        F.when((k % 5 == 3), F.concat(F.lit("all fine "), k.cast("string")))
        .when(k % 13 == 0, F.concat(F.lit(f"{esc}[31mERROR creating sql view model STAGING."), model, F.lit(f"{esc}[0m [err]")))
        .when(k % 13 == 1, F.concat(F.lit("Compilation Error in model "), model, F.lit(" (models/x.sql)")))
        .when(k % 13 == 2, F.concat(F.lit(f"  {esc}[33mDatabase Error in snapshot{esc}[0m "), model))
        .when(k % 13 == 3, F.concat(F.lit("Failure in test not_null_"), model))
        .otherwise(F.concat(F.lit("ok "), F.col("event_type")))
    )
    return e.select((k % 50).alias("run_no"), task.alias("task_id"), k.alias("line_no"), line.alias("line"))


def root_causes(spark, sf):
    return lognotes.root_causes(log_lines(spark, sf), "run_no", "task_id")


def error_rows(spark, sf):
    causes = root_causes(spark, sf)
    failures = causes.select(
        F.lit("healthcare_pipeline").alias("dag_id"),
        "task_id",
        F.lit("scheduled").alias("triggered_by"),
        (F.col("run_no") % 2 + 1).alias("try_no"),
        F.lit(2).alias("max_tries"),
        "root_cause",
    )
    path = scratch_path(spark, "error-log")
    audit.append_log(audit.error_log(failures, a.ntz(LOADED_AT)), path, "b1")
    return spark.read.parquet(path).drop("batch_id")


def seed_recipients(spark, sf):
    """Rows go into an empty table and stay out of a filled one."""
    rows = recipients(spark, sf)
    first = audit.insert_if_empty(rows.filter("recipient_email is null"), rows)
    again = audit.insert_if_empty(first, rows.withColumn("alert_type", F.lit("LATE")))
    return again


_causes_sql = r"""
SELECT DISTINCT run_no, task_id, coalesce(found, CASE task_id WHEN 'dbt_run' THEN 'dbt failed to build the Silver/Gold models (broken SQL or model error).'
  WHEN 'dbt_snapshot' THEN 'dbt failed to capture SCD2 snapshot history.' WHEN 'dbt_test' THEN 'One or more dbt data-quality tests failed.'
  WHEN 'reconciliation' THEN 'The reconciliation step failed.' ELSE 'A pipeline task failed.' END) AS root_cause
FROM log_lines LEFT JOIN (
  SELECT run_no, task_id, string_agg(hit, '  ' ORDER BY place) AS found FROM (
    SELECT *, row_number() OVER (PARTITION BY run_no, task_id ORDER BY rank, line_no) AS place FROM (
      SELECT run_no, task_id, hit, arg_min(rank, (rank, line_no)) AS rank, arg_min(line_no, (rank, line_no)) AS line_no FROM log_hits GROUP BY run_no, task_id, hit))
  WHERE place <= 5 GROUP BY run_no, task_id) USING (run_no, task_id)"""
m.RELATIONS["log_lines"] = r"""
SELECT event_id % 50 AS run_no, list_extract(['dbt_run', 'dbt_snapshot', 'dbt_test', 'reconciliation', 'load_step'], event_id % 5 + 1) AS task_id,
  event_id AS line_no, event_id % 13 AS kind, event_id % 5 = 3 AS quiet, 'stg_' || event_type || '_' || (user_id % 4) AS model FROM events"""
m.RELATIONS["log_hits"] = r"""
SELECT run_no, task_id, line_no, kind AS rank, CASE kind WHEN 0 THEN 'Model failed to build: STAGING.' || model
  WHEN 1 THEN 'Compilation error in model: ' || model WHEN 2 THEN 'Database error in snapshot: ' || model
  ELSE 'Test failed: not_null_' || model END AS hit FROM log_lines WHERE kind <= 3 AND NOT quiet"""
m.RELATIONS["log_causes"] = _causes_sql
m.RELATIONS["recipients"] = """
SELECT lower(n_name) || '@example.org' AS recipient_email, CASE WHEN n_nationkey % 2 = 0 THEN 'DQ_FAILURE' ELSE 'OTHER' END AS alert_type,
  n_nationkey % 3 = 0 AS is_active, '2026-01-01 00:00:00' AS added_at FROM nation"""

QUERIES = {
    "append_with_count": append,
    "merge_upsert": merge,
    "schema_sync_upsert": schema_sync,
    "full_refresh": refresh,
    "quarantine_route": quarantine,
    "pipeline_error_log": error_rows,
    "insert_if_empty": seed_recipients,
    "alert_outbox": lambda s, d: audit.alert_outbox(q_gate.file_log(s, d), recipients(s, d)),
    "ensure_layer_tables": ensure,
    "catalog_listing": listing,
    "layer_table_scan": layer_scan,
    "incr_admissions": lambda s, d: inc.incr_admissions(
        table(s, d, "stg_admissions_before"), table(s, d, "raw_admissions"), a.as_of()
    ),
    "incr_treatments": lambda s, d: inc.incr_treatments(
        table(s, d, "stg_treatments_before"), table(s, d, "raw_treatments")
    ),
    "incr_claims": lambda s, d: inc.incr_claims(table(s, d, "stg_claims_before"), table(s, d, "raw_claims")),
    "incr_facts": lambda s, d: upserted_fact(s, d, "admissions", gold.fct_admissions, "admission_id"),
    "incr_facts_treatments": lambda s, d: upserted_fact(s, d, "treatments", gold.fct_treatments, "treatment_id"),
    "incr_facts_claims": lambda s, d: upserted_fact(s, d, "claims", gold.fct_claims, "claim_id"),
    "scd2_snapshot_check": snapshot_two,
    "scd2_hard_deletes": lambda s, d: snapshot_two(s, d)
    .filter(F.col("valid_to").isNotNull())
    .join(a.doctors_later(s, d).select("doctor_id"), "doctor_id", "left_anti"),
    "scd2_metadata": lambda s, d: snapshot_two(s, d).select(
        "doctor_id", "version_id", "updated_at", "valid_from", "valid_to", millis_text(F.col("valid_from")).alias("version_start")
    ),
    "active_recipients": lambda s, d: audit.active_recipients(recipients(s, d)),
    "log_root_cause": root_causes,
    "failure_meaning": lambda s, d: log_lines(s, d)
    .select(F.when(F.col("line_no") % 3 == 0, "gatekeeper_validate").when(F.col("line_no") % 3 == 1, "trigger_healthcare_pipeline").otherwise(F.col("task_id")).alias("task_id"))
    .groupBy("task_id")
    .agg(F.count(F.lit(1)).alias("n"))
    .withColumn("meaning", lognotes.failure_meaning(F.col("task_id"))),
}

_claims = m.table("stg_claims", m.STG_CLAIMS)
_deleted = query(
    f"SELECT {shown(*m.SCD_DOCTORS)} FROM scd_doctors WHERE valid_to IS NOT NULL AND doctor_id NOT IN (SELECT doctor_id FROM doctors_later)"
)


def _meanings() -> str:
    arms = " ".join(f"WHEN '{k}' THEN '{v.replace(chr(39), chr(39) * 2)}'" for k, v in lognotes.MEANINGS.items())
    return f"CASE task_id {arms} ELSE '{lognotes.MEANING_OTHER}' END"


ORACLE = {
    "append_with_count": query(
        f"""SELECT CASE WHEN {m.split_filter()} THEN 'b1' ELSE 'b2' END AS batch_id, count(*) AS rows_found, count(*) AS rows_reported
FROM raw_claims GROUP BY 1"""
    ),
    "merge_upsert": _claims,
    "schema_sync_upsert": query(
        f"SELECT {shown(*[c for c in m.STG_CLAIMS if c != 'is_pending'])}, CASE WHEN NOT {m.split_filter()} THEN is_pending END AS is_pending FROM stg_claims"
    ),
    "full_refresh": _claims,
    "quarantine_route": query(
        """SELECT CASE WHEN status = 'PASSED' THEN 'processed' ELSE 'quarantine' END AS folder, '20260629_130245' AS run_stamp, file_name,
  count(*) AS lines, CAST(sum(length(line)) AS BIGINT) AS characters FROM gate_lines JOIN gate_verdicts USING (file_name) GROUP BY 1, 2, 3"""
    ),
    "pipeline_error_log": query(
        f"""SELECT 'healthcare_pipeline' AS dag_id, task_id, 'FAILED' AS status, 'scheduled' AS triggered_by, (run_no % 2 + 1) || ' of 2' AS attempt,
  root_cause AS error_summary, 'Open Airflow > healthcare_pipeline > ' || task_id || ' > Logs for the full stack trace, fix the issue, then re-run the pipeline.' AS action,
  '{LOADED_AT}' AS failed_at FROM log_causes"""
    ),
    "insert_if_empty": query("SELECT * FROM recipients"),
    "alert_outbox": query(
        """SELECT run_id, file_name, recipient_email, 'GATEKEEPER QUARANTINE - ' || file_name AS subject,
  replace('Healthcare GATEKEEPER validation FAILED - file quarantined.' || chr(10) || chr(10) || '  File:           ' || file_name || chr(10)
  || '  Feed:           ' || feed_type || chr(10) || '  Status:         QUARANTINED (not loaded)' || chr(10)
  || '  Checks passed:  ' || checks_passed || chr(10) || '  Checks failed:  ' || checks_failed || chr(10)
  || '  Quarantined at: ' || processed_at || chr(10) || chr(10) || '  Failed checks:' || chr(10) || failed_checks || chr(10) || chr(10)
  || '  Action: ' || action, chr(39), '') AS body
FROM gate_file_log, recipients WHERE status = 'QUARANTINED' AND alert_type = 'DQ_FAILURE' AND is_active"""
    ),
    "ensure_layer_tables": query(
        """SELECT 'patient_admissions' AS table_name, count(*) AS row_count FROM raw_admissions
UNION ALL SELECT 'treatment_records', count(*) FROM raw_treatments UNION ALL SELECT 'insurance_claims', count(*) FROM raw_claims
UNION ALL SELECT unnest(['file_processing_log', 'dq_metrics_log', 'pipeline_error_log', 'email_recipient_log']), 0"""
    ),
    "catalog_listing": query(
        """SELECT 'dim_patient' AS table_name, count(*) AS row_count FROM dim_patient UNION ALL SELECT 'dim_doctor', count(*) FROM dim_doctor
UNION ALL SELECT 'fct_admissions', count(*) FROM fct_admissions UNION ALL SELECT 'fct_claims', count(*) FROM fct_claims"""
    ),
    "layer_table_scan": query(f"SELECT {shown(*CLAIMS.columns, 'file_name', 'upload_dttm', 'load_dttm')} FROM raw_claims").replace(
        "CAST(claim_date AS VARCHAR) AS claim_date, CAST(settle_date AS VARCHAR) AS settle_date", "claim_date, settle_date"
    ),
    "incr_admissions": m.table("stg_admissions", m.STG_ADMISSIONS),
    "incr_treatments": m.table("stg_treatments", m.STG_TREATMENTS),
    "incr_claims": _claims,
    "incr_facts": m.table("fct_admissions", m.FCT_ADMISSIONS),
    "incr_facts_treatments": m.table("fct_treatments", m.FCT_TREATMENTS),
    "incr_facts_claims": m.table("fct_claims", m.FCT_CLAIMS),
    "scd2_snapshot_check": m.table("scd_doctors", m.SCD_DOCTORS),
    "scd2_hard_deletes": _deleted,
    "scd2_metadata": query(
        f"SELECT {shown('doctor_id', 'version_id', 'updated_at', 'valid_from', 'valid_to')}, {m.millis('valid_from')} AS version_start FROM scd_doctors"
    ),
    "active_recipients": query("SELECT * FROM recipients WHERE alert_type = 'DQ_FAILURE' AND is_active"),
    "log_root_cause": query("SELECT * FROM log_causes"),
    "failure_meaning": query(
        f"""SELECT task_id, count(*) AS n, {_meanings()} AS meaning FROM (
  SELECT CASE line_no % 3 WHEN 0 THEN 'gatekeeper_validate' WHEN 1 THEN 'trigger_healthcare_pipeline' ELSE task_id END AS task_id FROM log_lines) GROUP BY task_id"""
    ),
}
