"""Groups A and L: files, seeds, spine and the streaming job."""

from __future__ import annotations

import datetime as dt
from functools import partial

from pyspark.sql import functions as F

from wardline.feeds import ADMISSIONS, CLAIMS, TREATMENTS
from wardline.plans.ingest import Stores
from wardline.registry import adapters as a
from wardline.registry import gate_files as g
from wardline.registry import sql_gate as sg
from wardline.registry import sql_models as m
from wardline.registry.layers import calendar
from wardline.registry.sql_models import query
from wardline.session import scratch_path, written
from wardline.sinks import bronze
from wardline.sinks.store import TableStore
from wardline.sources import files
from wardline.sources.seeds import seed_scan
from wardline.operators import checks as c
from wardline.operators.joins import in_keys
from wardline.streaming import ingest as stream

LOADED_AT = "2026-06-29 13:02:45"
AT = dt.datetime(2026, 6, 29, 13, 2, 45)


WIDEST = 11  # cells of the widest derived line


def raw_lines(spark, sf):
    return files.csv_raw_lines_scan(spark, g.incoming(spark, sf), WIDEST)


def feed_scan(spark, sf, feed=CLAIMS):
    df = files.csv_feed_scan(spark, g.incoming(spark, sf) + f"/{feed.name}_*.csv", feed)
    return df.drop("upload_dttm")


def headers(spark, sf):
    return g.read_folder(spark, sf, False)[0].select("file_name", "feed", F.array_join("header", "|").alias("header"))


def manifest(spark, sf):
    return files.recognised(files.file_manifest(spark, g.incoming(spark, sf))).select("file_name", "feed", "size")


_NAMES = (
    "PATIENT_ADMISSIONS_{y}.csv",
    "late/treatment_records_{y}.csv",
    "insurance_claims_for_patient_admissions_{y}.csv",
    "lab_results_{y}.csv",
    "insurance_claims_{y}.txt",
)


def router(spark, sf):
    """Which feed each of the names takes; the first feed found wins, other endings are dropped."""
    o = a.read(spark, sf, "orders")
    year = F.year("o_orderdate").cast("string")
    names = F.array(*[F.replace(F.lit(n), F.lit("{y}"), year) for n in _NAMES])
    named = o.select(F.element_at(names, (F.col("o_orderkey") % len(_NAMES) + 1).cast("int")).alias("path"))
    routed = files.recognised(files.path_base_name(named, "path"))
    return routed.groupBy("file_name", "feed").agg(F.count(F.lit(1)).alias("n"))


def lineage(spark, sf, feed=CLAIMS):
    heads, staged = g.read_folder(spark, sf)
    rows = files.with_load_stamp(files.named_cells(staged, heads, feed), F.lit(AT))
    return rows.select(feed.key, "file_name", F.col("upload_dttm").isNotNull().alias("has_upload"), "load_dttm")


def projection(spark, sf, feed=TREATMENTS):
    heads, staged = g.read_folder(spark, sf)
    return files.named_cells(staged, heads, feed).drop("upload_dttm")


def strict(spark, sf, feed=ADMISSIONS):
    """The feed's files that pass, typed all or nothing."""
    heads, staged = g.read_folder(spark, sf)
    m_ = files.recognised(files.file_manifest(spark, g.incoming(spark, sf)))
    verdicts = c.file_verdicts(c.check_rows(c.file_plan(m_, heads), staged))
    good = written(verdicts.filter(F.col("status") == c.PASSED).select("file_name"), "good")
    rows = files.named_cells(in_keys(staged, good, "file_name"), heads, feed)
    return bronze.strict_load(rows, feed).drop("upload_dttm")


def seeds(spark, sf):
    path = scratch_path(spark, "seed_doctors")
    a.doctors(spark, sf).write.option("header", "true").csv(path)
    return seed_scan(spark, path, "seed_doctors")


def spine(spark, sf):
    """Every day of the covered span with its number of orders, days without any included."""
    days = calendar(spark, sf)
    per_day = a.read(spark, sf, "orders").groupBy(F.col("o_orderdate").cast("date").alias("d")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return days.join(per_day, F.col("date_day") == F.col("d"), "left").select("date_day", F.coalesce("n", F.lit(0)).alias("orders"))


def _stream(spark, sf, after=False):
    stores = Stores(scratch_path(spark, "stream"))
    step = stream.silver_upsert(spark, stores, a.AS_OF) if after else None
    for _ in range(2):  # the second start finds nothing new
        stream.gate_stream(
            spark, g.incoming(spark, sf), stores, f"{stores.root}/checkpoint", clock=lambda: AT, after=step
        ).awaitTermination()
    return stores


def stream_gate(spark, sf):
    stores = _stream(spark, sf)
    log = spark.read.parquet(stores.log("file_processing_log"))
    return log.select("file_name", "feed_type", "status", "rows_loaded", "checks_passed", "checks_failed")


def stream_silver(spark, sf):
    stores = _stream(spark, sf, after=True)
    df = TableStore(spark, stores.root).table("stg_claims")
    return df.select("claim_id", "admission_id", "claim_amount", "claim_status", "claim_date", "settle_date", "days_to_settle", "dq_status")


QUERIES = {
    "csv_feed_scan": feed_scan,
    "csv_raw_lines_scan": raw_lines,
    "file_header": headers,
    "file_manifest": manifest,
    "feed_router": router,
    "file_lineage_columns": lineage,
    "feed_projection": projection,
    "strict_load": strict,
    "seed_scan": seeds,
    "date_spine": spine,
    "stream_gate_ingest": stream_gate,
    "stream_silver_upsert": stream_silver,
}

_all_cells = ", ".join(f"cells[{i + 1}] AS c{i}" for i in range(WIDEST))
_name_case = "CASE o_orderkey % 5 " + " ".join(
    f"WHEN {i} THEN '{n.rsplit('/', 1)[-1].replace('{y}', chr(39) + ' || year(o_orderdate) || ' + chr(39))}'" for i, n in enumerate(_NAMES)
) + " END"
m.RELATIONS["stream_claims"] = sg.landed("insurance_claims")



def _scan_sql(feed):
    cells = ", ".join(f"cells[{i + 1}] AS {x}" for i, x in enumerate(feed.columns))
    return query(f"SELECT {cells}, file_name FROM gate_cells WHERE feed = '{feed.name}'")


def _lineage_sql(feed):
    return query(
        f"SELECT {sg.cell(feed.key)} AS {feed.key}, file_name, TRUE AS has_upload, '{LOADED_AT}' AS load_dttm FROM gate_kept WHERE feed = '{feed.name}'"
    )


def _projection_sql(feed):
    named = ", ".join(f"{sg.cell(x)} AS {x}" for x in feed.columns)
    return query(f"SELECT {named}, file_name FROM gate_kept WHERE feed = '{feed.name}'")


ORACLE = {
    "csv_feed_scan": _scan_sql(CLAIMS),
    "csv_raw_lines_scan": query(f"SELECT file_name, {_all_cells} FROM (SELECT file_name, {sg._CUT} AS cells FROM gate_lines)"),
    "file_header": query("SELECT file_name, feed, array_to_string(header, '|') AS header FROM gate_named"),
    "file_manifest": query("SELECT file_name, feed, CAST(size AS BIGINT) AS size FROM gate_files"),
    "feed_router": query(
        f"""SELECT file_name, CASE WHEN lower(file_name) LIKE '%patient_admissions%' THEN 'patient_admissions' ELSE 'treatment_records' END AS feed, count(*) AS n
FROM (SELECT {_name_case} AS file_name FROM orders) WHERE file_name LIKE '%.csv' AND lower(file_name) NOT LIKE 'lab%' GROUP BY ALL"""
    ),
    "file_lineage_columns": _lineage_sql(CLAIMS),
    "feed_projection": _projection_sql(TREATMENTS),
    "strict_load": query(sg.landed("patient_admissions")),
    "seed_scan": query("SELECT * FROM doctors"),
    "date_spine": query(
        "SELECT CAST(date_day AS VARCHAR) AS date_day, count(o_orderkey) AS orders FROM spine LEFT JOIN orders ON CAST(o_orderdate AS DATE) = date_day GROUP BY date_day"
    ),
    "stream_gate_ingest": query(
        "SELECT file_name, feed_type, status, rows_loaded, checks_passed, checks_failed FROM gate_file_log"
    ),
    "stream_silver_upsert": query(
        f"""SELECT claim_id, admission_id, claim_amount, claim_status, CAST(claim_date AS VARCHAR) AS claim_date, CAST(settle_date AS VARCHAR) AS settle_date,
  date_diff('day', claim_date, settle_date) AS days_to_settle,
  CASE WHEN approved_amount > claim_amount THEN 'APPROVED_EXCEEDS_CLAIM' WHEN claim_amount <= 0 THEN 'INVALID_CLAIM_AMOUNT'
       WHEN settle_date < claim_date THEN 'SETTLE_BEFORE_CLAIM' ELSE 'VALID' END AS dq_status
FROM (SELECT * REPLACE ({m.parsed('claim_date')} AS claim_date, {m.parsed('settle_date')} AS settle_date, {m._labels('claim_status', m.CLAIM_STATUSES)} AS claim_status) FROM stream_claims)"""
    ),
}

# The same sources for the feeds that the queries above do not read.
for _name, _run, _sql, _own in (
    ("csv_feed_scan", feed_scan, _scan_sql, CLAIMS),
    ("file_lineage_columns", lineage, _lineage_sql, CLAIMS),
    ("feed_projection", projection, _projection_sql, TREATMENTS),
    ("strict_load", strict, lambda feed: query(sg.landed(feed.name)), ADMISSIONS),
):
    for _feed in (ADMISSIONS, TREATMENTS, CLAIMS):
        if _feed is not _own:
            QUERIES[f"{_name}_{_feed.name}"] = partial(_run, feed=_feed)
            ORACLE[f"{_name}_{_feed.name}"] = _sql(_feed)
