"""Group C: the gate checks over files derived from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardline.feeds import GateLimits
from wardline.operators import checks as c
from wardline.registry import gate_files as g
from wardline.registry import sql_gate as q
from wardline.registry.sql_models import query
from wardline.session import written
from wardline.sinks import audit
from wardline.sources import files
from wardline.registry.adapters import ntz


def parts(spark, sf, store=True):
    headers, staged = g.read_folder(spark, sf, store)
    manifest = files.recognised(files.file_manifest(spark, g.incoming(spark, sf)))
    return headers, staged, c.file_plan(manifest, headers)


def _one(name):
    def run(spark, sf):
        _, staged, plan = parts(spark, sf, store=name not in c.GATE_CHECKS)  # those read headers only
        return c.check_rows(plan, staged, only=[name])

    return run


def all_checks(spark, sf):
    """All ten checks; records are read once since several passes need them."""
    _, staged, plan = parts(spark, sf)
    return _checks(plan, staged)


def _checks(plan, staged):
    return c.check_rows(written(plan, "file-plan"), staged)


def verdicts(spark, sf):
    return c.file_verdicts(all_checks(spark, sf))


def file_log(spark, sf):
    _, staged, plan = parts(spark, sf)
    kept = files.lenient_load(staged).groupBy("file_name").agg(F.count(F.lit(1)).alias("n"))
    return audit.file_log(c.file_verdicts(_checks(plan, staged)), kept, q.RUN_ID, ntz(q.RUN_AT))


QUERIES = {f"chk_{n}": _one(n) for n in c.ALL_CHECKS}
QUERIES |= {
    "gate_short_circuit": lambda s, d: all_checks(s, d)
    .groupBy("file_name")
    .agg(F.count(F.lit(1)).alias("results"), F.bool_or((F.col("tier") == "GATE") & ~F.col("passed")).alias("gate_failed")),
    "file_verdict": lambda s, d: verdicts(s, d).select("file_name", "feed", "status"),
    "file_check_counts": lambda s, d: verdicts(s, d).select("file_name", "checks_passed", "checks_failed"),
    "failed_check_text": lambda s, d: verdicts(s, d).select("file_name", "failed_checks"),
    "advisory_warnings": lambda s, d: c.advisory_warnings(verdicts(s, d)),
    "preflight_header_diff": lambda s, d: c.preflight_header_diff(
        g.gate_manifest(s, d).withColumn("feed", files.feed_of(F.col("file_name"))),
        g.read_folder(s, d, False)[0],
    ),
    "gate_all_checks": all_checks,
    "gate_run_summary": lambda s, d: c.run_summary(file_log(s, d)),
    "audit_file_log": file_log,
    "audit_check_log": lambda s, d: audit.check_log(all_checks(s, d), q.RUN_ID, ntz(q.RUN_AT)),
    "lenient_load": lambda s, d: parts(s, d)[1]
    .groupBy("file_name", "feed")
    .agg(F.count_if(~F.col("ragged")).alias("kept"), F.count_if("ragged").alias("skipped")),
}

_expected = q._per_feed(lambda f: q._list(f.columns))
ORACLE = {name: query(sql) for name, sql in q.CHECKS.items()}
ORACLE |= {
    "gate_short_circuit": query(
        "SELECT file_name, count(*) AS results, bool_or(tier = 'GATE' AND NOT passed) AS gate_failed FROM gate_checks GROUP BY file_name"
    ),
    "file_verdict": query("SELECT file_name, feed, status FROM gate_verdicts"),
    "file_check_counts": query("SELECT file_name, checks_passed, checks_failed FROM gate_verdicts"),
    "failed_check_text": query("SELECT file_name, failed_checks FROM gate_verdicts"),
    "advisory_warnings": query(
        "SELECT file_name, feed, advisories FROM gate_verdicts WHERE status = 'PASSED' AND advisories IS NOT NULL"
    ),
    "preflight_header_diff": query(
        f"""SELECT file_name, feed, CASE WHEN header = wanted THEN 'OK' ELSE 'WARN' END AS verdict,
  array_to_string(list_filter(wanted, lambda x: NOT list_contains(header, x)), ', ') AS missing,
  array_to_string(list_filter(header, lambda x: NOT list_contains(wanted, x)), ', ') AS extra
FROM (SELECT *, {_expected} AS wanted FROM gate_plan)"""
    ),
    "gate_all_checks": query("SELECT * FROM gate_checks"),
    "gate_run_summary": query(
        """SELECT run_id, count(*) AS files_seen, CAST(sum(rows_loaded) AS BIGINT) AS rows_loaded,
  count(*) FILTER (WHERE status = 'QUARANTINED') AS files_quarantined, bool_or(status = 'QUARANTINED') AS any_quarantined
FROM gate_file_log GROUP BY run_id"""
    ),
    "audit_file_log": query("SELECT * FROM gate_file_log"),
    "audit_check_log": query(
        f"""SELECT '{q.RUN_ID}' AS run_id, file_name, feed AS feed_type, check_name, tier AS check_tier,
  CASE WHEN passed THEN 'PASS' ELSE 'FAIL' END AS check_result, detail, '{q.RUN_AT}' AS checked_at FROM gate_checks"""
    ),
    "lenient_load": query(
        """SELECT c.file_name, c.feed, count(*) FILTER (WHERE len(cells) = len(header)) AS kept,
  count(*) FILTER (WHERE len(cells) <> len(header)) AS skipped FROM gate_cells c JOIN gate_named USING (file_name) GROUP BY ALL"""
    ),
}
