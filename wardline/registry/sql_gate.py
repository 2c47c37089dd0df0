"""The derived CSV files and their checks stated in SQL, the twin of ``gate_files``."""

from __future__ import annotations

from wardline.feeds import FEEDS, GateLimits
from wardline.registry.gate_files import HEADERS, KEYS_PER_FILE, SHIFT_MONTHS, UPLOADED
from wardline.registry.sql_models import RELATIONS, query

LIMITS = GateLimits()


def _line(*cells: str) -> str:
    return " || ',' || ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in cells)


def _name(feed: str) -> str:
    return f"'{feed}_' || y || '_' || part || '.csv'"


def _sql(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


DOCTOR = "'D' || lpad(CAST(k % 10 AS VARCHAR), 3, '0')"

RELATIONS["gate_base"] = f"""
SELECT *, o_orderkey AS k, year(o_orderdate) AS y, o_orderkey // {KEYS_PER_FILE} AS part,
  strftime(CAST(o_orderdate AS DATE) + INTERVAL {SHIFT_MONTHS} MONTH, '%Y-%m-%d') AS iso,
  strftime(CAST(o_orderdate AS DATE) + INTERVAL {SHIFT_MONTHS} MONTH, '%d/%m/%Y') AS dmy,
  CAST(o_totalprice AS DECIMAL(12,2)) AS price FROM orders"""

_adm = [
    "k",
    "o_custkey",
    f"CASE WHEN y = 1998 AND k % 14 = 0 THEN 'NULL' WHEN y = 1998 AND k % 7 = 0 THEN '' ELSE {DOCTOR} END",
    "CASE WHEN k % 40 = 0 THEN '' ELSE 'H' || lpad(CAST(k % 25 AS VARCHAR), 2, '0') END",
    "CASE WHEN y = 2001 AND k % 31 = 0 THEN '1999-12-31' WHEN k % 3 = 0 THEN dmy ELSE iso END",
    "substr(o_orderpriority, 3, 3)",
    "CASE WHEN y = 2001 AND k % 17 = 0 THEN 'XXX' WHEN k % 3 = 0 THEN 'EMG' WHEN k % 3 = 1 THEN ' URG ' ELSE 'ELC' END",
    "CASE WHEN k % 23 = 0 THEN '\"D,' || (k % 10) || '\"' ELSE 'D' || (k % 40) END",
    "CASE WHEN y = 1999 AND k % 11 = 0 THEN 'abc' ELSE CAST(k % 12 AS VARCHAR) END",
    "k % 2",
]
_trt_lead = ["k", "k", DOCTOR, "'P' || (k % 25)", "iso"]
_cost = "CASE WHEN y = 1999 AND k % 20 = 0 THEN '' ELSE CAST(price AS VARCHAR) END"
_outcome = "CASE WHEN y = 2001 AND k % 9 = 0 THEN 'X' WHEN k % 3 = 0 THEN 'P' WHEN k % 3 = 1 THEN 'F' ELSE 'S' END"
_code = "CASE o_orderstatus WHEN 'F' THEN 'A' WHEN 'O' THEN 'R' ELSE 'P' END"
_clm = [
    "k",
    "k",
    "'I' || lpad(CAST(k % 5 + 1 AS VARCHAR), 2, '0')",
    "price",
    "CASE WHEN y = 1997 AND o_orderstatus = 'P' THEN '' WHEN o_orderstatus = 'F' THEN CAST(price AS VARCHAR) ELSE '0' END",
    f"CASE WHEN y = 2001 AND k % 8 = 0 THEN lower({_code}) ELSE {_code} END",
    "CASE WHEN y = 2000 AND k % 5 = 0 THEN '2019-12-31' ELSE iso END",
    "CASE WHEN o_orderstatus = 'P' THEN '' ELSE iso END",
]


def _headers(feed: str) -> str:
    arms = " ".join(f"WHEN {y} THEN {_sql(t)}" for y, t in HEADERS[feed].items() if y)
    text = f"CASE y {arms} ELSE {_sql(HEADERS[feed][0])} END" if arms else _sql(HEADERS[feed][0])
    keep = " WHERE y <> 1998" if feed == "insurance_claims" else ""
    return f"SELECT DISTINCT {_name(feed)} AS file_name, '{feed}' AS feed, 0 AS line_no, {text} AS line FROM gate_base{keep}"


RELATIONS["gate_data"] = f"""
SELECT {_name('patient_admissions')} AS file_name, 'patient_admissions' AS feed, k * 2 + i + 1 AS line_no,
  CASE WHEN y = 1996 THEN {_line(*_adm[:-1])} WHEN y = 2001 AND k % 19 = 0 THEN {_line(*_adm, "'x'")} ELSE {_line(*_adm)} END AS line
FROM gate_base, (VALUES (1), (2)) AS twice(i) WHERE i = 1 OR (y = 2000 AND k % 13 = 0)
UNION ALL
SELECT {_name('treatment_records')}, 'treatment_records', k + 1,
  CASE WHEN y = 1997 THEN {_line(*_trt_lead, _outcome, _cost)} WHEN y = 1998 THEN {_line(*_trt_lead, _cost, _outcome, "'n'")}
       WHEN y = 2000 THEN {_line(*_trt_lead, _cost)} ELSE {_line(*_trt_lead, _cost, _outcome)} END FROM gate_base
UNION ALL
SELECT {_name('insurance_claims')}, 'insurance_claims', k + 1, {_line(*_clm)} FROM gate_base WHERE y NOT IN (1998, 1999)"""
RELATIONS["gate_heads"] = " UNION ALL ".join(_headers(f) for f in FEEDS)
RELATIONS["gate_lines"] = "SELECT * FROM gate_data UNION ALL SELECT * FROM gate_heads"
RELATIONS["gate_files"] = """
SELECT file_name, any_value(feed) AS feed, sum(strlen(line) + 1) AS size FROM gate_lines GROUP BY file_name
UNION ALL SELECT DISTINCT 'insurance_claims_1998_' || part || '.csv', 'insurance_claims', 0 FROM gate_base WHERE y = 1998"""

# ── reading: a quoted separator is masked, then the line is cut ─────────────────────────────────

_CUT = """list_transform(string_split(regexp_replace(line, '"([^",]*),([^"]*)"', '\\1;\\2', 'g'), ','),
  lambda x: CASE WHEN trim(x) IN ('', 'NULL') THEN NULL ELSE replace(trim(x), ';', ',') END)"""
RELATIONS["gate_cells"] = f"SELECT file_name, feed, line_no, line, {_CUT} AS cells FROM gate_data"


def _per_feed(make) -> str:
    return "CASE feed " + " ".join(f"WHEN '{f.name}' THEN {make(f)}" for f in FEEDS.values()) + " END"


def _list(names) -> str:
    return "[" + ", ".join(f"'{n}'" for n in names) + "]"


RELATIONS["gate_named"] = f"""
SELECT file_name, feed, {_per_feed(lambda f: len(f.columns))} AS expected,
  list_filter(list_transform(string_split(line, ','), lambda x: lower(trim(x))), lambda x: x <> '') AS header
FROM gate_heads"""
RELATIONS["gate_plan"] = f"""
SELECT *, list_filter(required, lambda x: NOT list_contains(header, x)) AS missing FROM (
  SELECT f.file_name, f.feed, f.size, {_per_feed(lambda f: len(f.columns)).replace('CASE feed', 'CASE f.feed')} AS expected,
    coalesce(h.header, []) AS header, {_per_feed(lambda f: _list(f.required)).replace('CASE feed', 'CASE f.feed')} AS required
  FROM gate_files f LEFT JOIN gate_named h ON f.file_name = h.file_name)"""
RELATIONS["gate_open"] = "SELECT * FROM gate_plan WHERE size > 0 AND len(header) = expected AND len(missing) = 0"
RELATIONS["gate_kept"] = """
SELECT c.file_name, c.feed, c.line_no, c.cells, o.header FROM gate_cells c JOIN gate_named o ON c.file_name = o.file_name
WHERE len(c.cells) = len(o.header)"""


def cell(name: str) -> str:
    return f"cells[list_position(header, '{name}')]"


def _counters(f) -> str:
    bad = " OR ".join(f"TRY_CAST({cell(c)} AS DECIMAL(38,0)) IS NULL" for c in f.numeric)
    date = f"coalesce(try_strptime({cell(f.date_column)}, '%Y-%m-%d'), try_strptime({cell(f.date_column)}, '%d/%m/%Y'))"
    nulls = ", ".join(f"'{c}=' || printf('%.1f', coalesce(count(*) FILTER (WHERE {cell(c)} IS NULL) * 100.0 / nullif(count(*), 0), 0)) || '%'" for c in f.required)
    worst = ", ".join(f"count(*) FILTER (WHERE {cell(c)} IS NULL)" for c in f.required)
    gone = " OR ".join(f"NOT list_contains(any_value(header), '{c}')" for c in f.numeric)
    return f"""
SELECT file_name, count(*) AS n, concat_ws(', ', {nulls}) AS null_text, greatest({worst}) * 100.0 > {LIMITS.max_null_pct} * count(*) AS too_many_nulls,
  {gone} AS numeric_gone, count(*) FILTER (WHERE {bad}) AS bad_numbers,
  count(*) FILTER (WHERE {cell(f.category_column)} NOT IN ({', '.join(f"'{c}'" for c in f.categories)})) AS bad_categories,
  count(*) FILTER (WHERE {date} NOT BETWEEN DATE '{LIMITS.date_min}' AND DATE '{LIMITS.date_max}') AS bad_dates
FROM gate_kept WHERE feed = '{f.name}' AND file_name IN (SELECT file_name FROM gate_open) GROUP BY file_name"""


RELATIONS["gate_counters"] = "\nUNION ALL".join(_counters(f) for f in FEEDS.values())
RELATIONS["gate_twins"] = f"""
SELECT file_name, count(*) FILTER (WHERE first_of_key AND key_n > 1) AS dup_keys, count(*) FILTER (WHERE row_n > 1) AS dup_rows FROM (
  SELECT file_name, count(*) OVER (PARTITION BY file_name, kv) AS key_n, count(*) OVER (PARTITION BY file_name, cells) AS row_n,
    row_number() OVER (PARTITION BY file_name, kv) = 1 AS first_of_key
  FROM (SELECT *, {_per_feed(lambda f: cell(f.key))} AS kv FROM gate_kept WHERE file_name IN (SELECT file_name FROM gate_open)))
GROUP BY file_name"""

_zero_nulls = _per_feed(lambda f: "'" + ", ".join(f"{c}=0.0%" for c in f.required) + "'")
RELATIONS["gate_wide"] = f"""
SELECT file_name, feed, size, expected, header, missing, file_name IN (SELECT file_name FROM gate_open) AS open,
  coalesce(n, 0) AS n, coalesce(null_text, {_zero_nulls}) AS null_text, coalesce(too_many_nulls, FALSE) AS too_many_nulls,
  coalesce(numeric_gone, FALSE) AS numeric_gone, coalesce(bad_numbers, 0) AS bad_numbers, coalesce(bad_categories, 0) AS bad_categories,
  coalesce(bad_dates, 0) AS bad_dates, coalesce(dup_keys, 0) AS dup_keys, coalesce(dup_rows, 0) AS dup_rows
FROM gate_plan LEFT JOIN gate_counters USING (file_name) LEFT JOIN gate_twins USING (file_name)"""


def _check(order: int, name: str, tier: str, passed: str, detail: str, gated: bool = True) -> str:
    where = " WHERE open" if gated else ""
    return f"SELECT file_name, feed, {order} AS ord, {name} AS check_name, '{tier}' AS tier, {passed} AS passed, {detail} AS detail FROM gate_wide{where}"


CHECKS = {
    "chk_file_not_empty": _check(1, "'file_not_empty'", "GATE", "size > 0", "'size=' || CAST(size AS BIGINT) || ' bytes'", False),
    "chk_column_count": _check(2, "'column_count'", "GATE", "len(header) = expected", "'found ' || len(header) || ', expected ' || expected", False),
    "chk_required_columns": _check(3, "'required_columns'", "GATE", "len(missing) = 0",
        "CASE WHEN len(missing) = 0 THEN 'all present' ELSE 'missing=[''' || array_to_string(missing, ''', ''') || ''']' END", False),
    "chk_row_count": _check(4, "'row_count'", "THRESHOLD", f"n >= {LIMITS.min_rows}", "'rows=' || n"),
    "chk_null_percentage": _check(5, "'null_percentage'", "THRESHOLD", "NOT too_many_nulls", "null_text"),
    "chk_data_types": _check(6, "'data_types'", "THRESHOLD", "NOT numeric_gone AND bad_numbers = 0",
        "CASE WHEN numeric_gone THEN 'column missing' ELSE 'non-numeric rows=' || bad_numbers END"),
    "chk_pk_uniqueness": _check(7, "'pk_uniqueness'", "THRESHOLD", "dup_keys = 0", "'duplicate ids=' || dup_keys"),
    "chk_valid_category": _check(8, _per_feed(lambda f: f"'valid_{f.category_column}'"), "THRESHOLD", "bad_categories = 0", "'invalid values=' || bad_categories"),
    "chk_duplicate_rows": _check(9, "'duplicate_rows'", "ADVISORY", "dup_rows = 0", "'dup rows=' || dup_rows"),
    "chk_date_range": _check(10, "'date_range'", "ADVISORY", "bad_dates = 0", "'out-of-range dates=' || bad_dates"),
}
RELATIONS["gate_checks"] = "\nUNION ALL ".join(CHECKS.values())
RELATIONS["gate_verdicts"] = r"""
SELECT file_name, feed, CASE WHEN bool_or(NOT passed AND tier <> 'ADVISORY') THEN 'QUARANTINED' ELSE 'PASSED' END AS status,
  count(*) FILTER (WHERE passed) AS checks_passed, count(*) FILTER (WHERE NOT passed) AS checks_failed,
  coalesce(string_agg('    - ' || check_name || ' [' || tier || ']: ' || detail, chr(10) ORDER BY ord) FILTER (WHERE NOT passed AND tier <> 'ADVISORY'), '') AS failed_checks,
  string_agg(check_name, ', ' ORDER BY ord) FILTER (WHERE NOT passed AND tier = 'ADVISORY') AS advisories
FROM gate_checks GROUP BY file_name, feed"""
RUN_ID = "run00001"
RUN_AT = "2026-06-29 13:02:45"
RELATIONS["gate_file_log"] = f"""
SELECT '{RUN_ID}' AS run_id, v.file_name, v.feed AS feed_type, status, CASE WHEN status = 'PASSED' THEN coalesce(k.n, 0) ELSE 0 END AS rows_loaded,
  checks_passed, checks_failed, CASE WHEN status = 'PASSED' THEN '' ELSE failed_checks END AS failed_checks,
  CASE WHEN status = 'PASSED' THEN 'Loaded successfully; file archived to processed/.'
       ELSE 'File moved to quarantine/ folder. Review and re-upload a corrected file.' END AS action, '{RUN_AT}' AS processed_at
FROM gate_verdicts v LEFT JOIN (SELECT file_name, count(*) AS n FROM gate_kept GROUP BY file_name) k ON v.file_name = k.file_name"""


def landed(feed: str, only_passed: bool = True) -> str:
    """SQL for the typed rows of a feed's files that pass."""
    f = FEEDS[feed]
    kinds = {"LongType": "BIGINT", "IntegerType": "BIGINT", "DecimalType": "DOUBLE", "StringType": "VARCHAR"}
    cols = ", ".join(f"CAST({cell(x.name)} AS {kinds[type(x.spark_type).__name__]}) AS {x.name}" for x in f.fields)
    where = " AND file_name IN (SELECT file_name FROM gate_verdicts WHERE status = 'PASSED')" if only_passed else ""
    return f"SELECT {cols}, file_name FROM gate_kept WHERE feed = '{feed}'{where}"
