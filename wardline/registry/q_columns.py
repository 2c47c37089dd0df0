"""Groups D, G, J, K: single expressions, window steps and sorting, over whole landed tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardline.functions import dates, keys, numbers, rules, text
from wardline.operators import lognotes, spread
from wardline.operators.latest import dedup_latest
from wardline.operators.sequence import number_rows
from wardline.plans import ingest, silver
from wardline.registry import adapters as a
from wardline.registry import gate_files as g
from wardline.registry import q_state  # noqa: F401  (log relations)
from wardline.registry import sql_gate as sg
from wardline.registry import sql_models as m
from wardline.registry.layers import table
from wardline.registry.sql_models import query, shown
from wardline.sources import files
from wardline.registry.q_gate import parts
from wardline.operators import checks

C = F.col


def raw(name):
    return lambda s, d: table(s, d, f"raw_{name}")


adm, trt, clm = raw("admissions"), raw("treatments"), raw("claims")


def cleaned(part):
    fn = {"admissions": silver.clean_admissions, "treatments": silver.clean_treatments, "claims": silver.clean_claims}[part]
    return lambda s, d: fn(raw(part)(s, d))


def picked(source, **columns):
    """Query that selects named expressions, built when a session is there."""
    return lambda s, d: source(s, d).select(*[make().alias(n) for n, make in columns.items()])


def col(name):
    return lambda: C(name)


stg_adm = lambda s, d: table(s, d, "stg_admissions")
stg_trt = lambda s, d: table(s, d, "stg_treatments")
stg_clm = lambda s, d: table(s, d, "stg_claims")


# ── windows ─────────────────────────────────────────────────────────────────────────────────────


def latest_of_all(s, d):
    """Newest versions of the three feeds, as key and load stamp."""
    out = None
    for name, key, source in (("admissions", "admission_id", adm), ("treatments", "treatment_id", trt), ("claims", "claim_id", clm)):
        part = dedup_latest(source(s, d), key).select(F.lit(name).alias("feed"), C(key).alias("id"), "file_name", "load_dttm")
        out = part if out is None else out.unionByName(part)
    return out


def visits(s, d):
    return number_rows(silver.clean_admissions(adm(s, d)), silver.VISITS, adm(s, d), silver.visit_places)


def visits_by_chunks(s, d):
    """Groups cut in pieces of a few rows, as very large ones are in pieces of a partition's share."""
    return number_rows(silver.clean_admissions(adm(s, d)), silver.VISITS, adm(s, d), silver.visit_places, samples=2, sampled=20_000)


def steps(s, d):
    return number_rows(silver.clean_treatments(trt(s, d)), silver.STEPS, trt(s, d), silver.step_places)


def stats(s, d):
    return spread.cost_statistics(silver.clean_treatments(trt(s, d)), "procedure_code", "cost")


def outliers(s, d):
    c = silver.clean_treatments(trt(s, d))
    return silver.treatment_costs(c, spread.cost_statistics(c, "procedure_code", "cost"))


def twins(s, d):
    _, staged, plan = parts(s, d)
    rows = checks.placed_rows(staged, plan)
    return checks.repeated_rows(rows, checks.repeated_keys(rows))


def history_floor(s, d):
    from wardline.plans.gold import dim_doctor_history
    from wardline.registry.layers import snapshot_two

    h = dim_doctor_history(snapshot_two(s, d))
    return h.select("doctor_id", "valid_from", (C("valid_from") == a.ntz("1900-01-01 00:00:00")).alias("is_first"))


WINDOWS = {
    "dedup_latest": latest_of_all,
    "visit_sequence": lambda s, d: visits(s, d).select("admission_id", "patient_id", "patient_visit_seq"),
    "partition_count": lambda s, d: visits(s, d).select("admission_id", "patient_total_visits"),
    "lag_prev_discharge": lambda s, d: visits(s, d).select("admission_id", C("prev_discharge_date").alias("discharge_date")),
    "large_group_sequence": lambda s, d: visits_by_chunks(s, d).select(
        "admission_id", "patient_visit_seq", "patient_total_visits", C("prev_discharge_date").alias("discharge_date")
    ),
    "window_avg_stddev": lambda s, d: stats(s, d).select(
        "procedure_code", C("mean").alias("avg_cost"), F.round(C("deviation") / 100, 3).alias("deviation")
    ),
    "window_percentile_cont": lambda s, d: stats(s, d).select("procedure_code", "percentile_x100"),
    "treatment_sequence": lambda s, d: steps(s, d).select("treatment_id", "treatment_seq_in_admission", "treatments_in_admission"),
    "duplicate_row_window": twins,
    "first_version_flag": history_floor,
    "cost_zscore": lambda s, d: outliers(s, d).select("treatment_id", "cost_zscore"),
    "cost_outlier": lambda s, d: outliers(s, d).select("treatment_id", "is_cost_outlier"),
    "readmission_30d": lambda s, d: silver.stg_admissions(adm(s, d), a.as_of()).select(
        "admission_id", "is_30day_readmission", "days_since_last_visit", (C("dq_status") == "OVERLAPPING_ADMISSION").alias("overlaps")
    ),
}

# ── projections, filters ────────────────────────────────────────────────────────────────────────


def ranked(s, d):
    from pyspark.sql import Window as W

    w = W.partitionBy("admission_id").orderBy(C("load_dttm").desc_nulls_first())
    return adm(s, d).withColumn("version", F.row_number().over(w)).filter(C("version") == 1)


PROJECTIONS = {
    "project_rename_literal": picked(
        clm, claim=col("claim_id"), amount=lambda: C("claim_amount").cast("double"), source_system=lambda: F.lit("GATEKEEPER")
    ),
    "star_plus_computed": lambda s, d: stg_clm(s, d).withColumn("share_open", F.coalesce(C("unapproved_amount"), C("claim_amount"))),
    "filter_latest": lambda s, d: ranked(s, d).select("admission_id", "length_of_stay", "load_dttm"),
    "simple_case_decode": lambda s, d: adm(s, d)
    .groupBy(rules.decode(text.clean_code(C("admission_type")), rules.ADMISSION_TYPES).alias("label"))
    .agg(F.count(F.lit(1)).alias("n"))
    .unionByName(
        trt(s, d).groupBy(rules.decode(text.clean_code(C("outcome")), rules.OUTCOMES).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    )
    .unionByName(
        clm(s, d).groupBy(rules.decode(text.clean_code(C("claim_status")), rules.CLAIM_STATUSES).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    ),
    "searched_case_dq_admissions": picked(
        stg_adm,
        admission_id=col("admission_id"),
        status=lambda: rules.admission_status(
            C("days_since_last_visit"), C("length_of_stay"), C("admit_date"), C("doctor_id"), C("hospital_id"), a.as_of()
        ),
    ),
    "searched_case_dq_treatments": picked(
        stg_trt,
        treatment_id=col("treatment_id"),
        status=lambda: rules.treatment_status(C("cost"), C("treatment_date"), C("outcome")),
    ),
    "searched_case_dq_claims": picked(
        stg_clm,
        claim_id=col("claim_id"),
        status=lambda: rules.claim_status_check(
            C("claim_amount"), C("approved_amount"), C("claim_status"), C("claim_date"), C("settle_date")
        ),
    ),
    "is_valid_gate": picked(
        stg_adm,
        admission_id=col("admission_id"),
        is_valid=lambda: rules.admission_is_valid(C("length_of_stay"), C("admit_date"), C("doctor_id"), C("hospital_id"), a.as_of()),
    ),
    "boolean_flags": picked(
        cleaned("claims"),
        claim_id=col("claim_id"),
        is_approved=lambda: rules.true_only(C("claim_status") == "Approved"),
        is_pending=lambda: rules.true_only(C("claim_status") == "Pending"),
    ),
    "between_not_in_null_predicates": lambda s, d: clm(s, d).agg(
        F.count_if(C("approved_amount").between(0, 100000)).alias("within"),
        F.count_if(~C("approved_amount").between(0, 100000)).alias("outside"),
        F.count_if(C("claim_status").isin("A", "R")).alias("listed"),
        F.count_if(~C("claim_status").isin("A", "R")).alias("unlisted"),
        F.count_if(C("approved_amount").isNull() | C("settle_date").isNull()).alias("missing"),
        F.count_if(C("approved_amount").isNotNull() & (C("approved_amount") > C("claim_amount"))).alias("above"),
    ),
    "seniority_band": lambda s, d: a.doctors(s, d).select("doctor_id", rules.seniority_band(C("years_experience")).alias("seniority_band")),
    "patient_segment": lambda s, d: table(s, d, "dim_patient").select(
        "patient_id", rules.patient_segment(C("total_admissions")).alias("patient_segment")
    ),
}

# ── scalar functions ────────────────────────────────────────────────────────────────────────────


def task_lines(s, d):
    return q_state.log_lines(s, d)


SCALARS = {
    "str_upper_trim": picked(adm, admission_id=col("admission_id"), load_dttm=col("load_dttm"), doctor=lambda: text.clean_code(C("doctor_id"))),
    "str_lower_strip_replace": lambda s, d: a.read(s, d, "customer").select(
        "c_custkey",
        text.header_name(F.concat(F.lit("  "), C("c_name"), F.lit(" "))).alias("lowered"),
        text.without_quotes(F.concat(F.lit("O'"), C("c_mktsegment"))).alias("unquoted"),
        text.doubled_quotes(F.concat(F.lit("O'"), C("c_mktsegment"))).alias("doubled"),
    ),
    "str_split_last_contains_endswith": lambda s, d: a.read(s, d, "pages").select(
        "page_id",
        text.base_name(C("url")).alias("last_part"),
        C("url").contains("page").alias("has_page"),
        C("url").endswith("x").alias("ends_x"),
    ),
    "str_join_format": lambda s, d: adm(s, d)
    .groupBy("file_name")
    .agg(F.count_if(C("doctor_id").isNull()).alias("a"), F.count_if(C("hospital_id").isNull()).alias("b"), F.count(F.lit(1)).alias("n"))
    .select(
        "file_name",
        F.concat_ws(
            ", ",
            F.concat(F.lit("doctor_id="), text.percent_text(C("a"), C("n"))),
            F.concat(F.lit("hospital_id="), text.percent_text(C("b"), C("n"))),
        ).alias("detail"),
    ),
    "cast_to_varchar": picked(stg_adm, admission_id=col("admission_id"), admitted=lambda: C("admit_date").cast("string")),
    "cast_boolean": picked(adm, admission_id=col("admission_id"), load_dttm=col("load_dttm"), flag=lambda: C("readmission_flag").cast("boolean")),
    "try_cast_number": lambda s, d: a.read(s, d, "events").select(
        "event_id",
        numbers.try_number(F.when(C("event_id") % 3 == 0, C("event_type")).otherwise(C("value").cast("decimal(18,2)").cast("string")))
        .cast("double")
        .alias("number"),
    ),
    "date_parse_multi": picked(adm, admission_id=col("admission_id"), load_dttm=col("load_dttm"), admit_date=lambda: dates.parse_date(C("admit_date"))),
    "date_add_days": picked(stg_adm, admission_id=col("admission_id"), discharge_date=lambda: dates.add_days(C("admit_date"), C("length_of_stay"))),
    "date_diff_days": picked(stg_clm, claim_id=col("claim_id"), days=lambda: dates.day_gap(C("claim_date"), C("settle_date"))),
    "date_parts": picked(
        stg_adm,
        admission_id=col("admission_id"),
        year=lambda: F.year("admit_date"),
        quarter=lambda: F.quarter("admit_date"),
        month=lambda: F.month("admit_date"),
        day_of_month=lambda: F.dayofmonth("admit_date"),
    ),
    "date_names": picked(stg_adm, admission_id=col("admission_id"), month_name=lambda: F.monthname("admit_date"), day_name=lambda: F.dayname("admit_date")),
    "day_of_week_weekend": picked(
        stg_adm,
        admission_id=col("admission_id"),
        day_of_week=lambda: dates.day_of_week(C("admit_date")),
        is_weekend=lambda: dates.is_weekend(C("admit_date")),
    ),
    "as_of_date": picked(stg_adm, admission_id=col("admission_id"), in_future=lambda: C("admit_date") > a.as_of()),
    "utc_now": lambda s, d: files.with_load_stamp(clm(s, d).drop("load_dttm"), F.lit(ingest.utc_now()))
    .groupBy("file_name")
    .agg(F.count_distinct("load_dttm").alias("stamps"), F.count(F.lit(1)).alias("n")),
    "math_round_ratio": picked(
        stg_clm,
        claim_id=col("claim_id"),
        thirds=lambda: F.round(C("claim_amount") / F.lit(3), 2).cast("double"),
        open=lambda: (C("claim_amount") - C("approved_amount")).cast("double"),
    ),
    "guarded_ratio": picked(
        cleaned("claims"),
        claim_id=col("claim_id"),
        approval_ratio=lambda: numbers.guarded_ratio(C("approved_amount"), C("claim_amount"), C("claim_status") == "Approved"),
    ),
    "coalesce_nulls": picked(
        stg_clm,
        claim_id=col("claim_id"),
        settled=lambda: F.coalesce(C("settle_date"), C("claim_date")).cast("string"),
        only_settled=lambda: F.when(C("settle_date").isNotNull(), C("claim_status")),
    ),
    "surrogate_key": picked(
        stg_adm,
        admission_id=col("admission_id"),
        one=lambda: keys.surrogate_key(C("doctor_id")),
        two=lambda: keys.surrogate_key(C("patient_id"), C("admit_date")),
        stamped=lambda: keys.surrogate_key(C("hospital_id"), dates.millis_text(C("load_dttm"))),
    ),
    "run_id_stamp": lambda s, d: clm(s, d)
    .select(dates.stamp_text(C("load_dttm")).alias("stamp"), F.lit(len(ingest.new_run_id())).alias("run_id_length"))
    .groupBy("stamp", "run_id_length")
    .agg(F.count(F.lit(1)).alias("n")),
    "regex_extract_rules": lambda s, d: task_lines(s, d).select("line_no", F.inline(lognotes.line_hits(C("line")))),
    "list_ops": lambda s, d: g.read_folder(s, d, False)[0].select(
        "file_name",
        F.array_contains("header", "patient_id").alias("has_patient"),
        F.array_join(F.array_except(checks.per_feed(lambda f: F.array(*[F.lit(c) for c in f.columns])), C("header")), ",").alias("missing"),
        F.array_join(F.slice(F.array_distinct(F.concat(C("header"), C("header"))), 1, 5), ",").alias("first_five"),
    ),
    "limit_one": lambda s, d: g.read_folder(s, d, False)[0].select("file_name", F.get("header", F.lit(0)).alias("first_name")),
    "first_k_unique": lambda s, d: lognotes.root_causes(task_lines(s, d), "task_id"),
    "ordered_window_sort": lambda s, d: visits(s, d).filter(C("patient_visit_seq") == C("patient_total_visits")).select("patient_id", "admission_id", "admit_date"),
    "union_all_versions": lambda s, d: q_union(s, d),
}


def q_union(s, d):
    """Earlier and later admissions put together again, versions counted."""
    raw_ = adm(s, d)
    before = raw_.filter(C("load_dttm") <= a.ntz(a.SPLIT_AT))
    after = raw_.filter(C("load_dttm") > a.ntz(a.SPLIT_AT))
    return before.unionByName(after).groupBy("admission_id").agg(F.count(F.lit(1)).alias("versions"))


QUERIES = {**WINDOWS, **PROJECTIONS, **SCALARS}


def _adm(*more: str) -> str:
    return query("SELECT " + ", ".join(["admission_id", *more]) + " FROM stg_admissions")


def _raw_adm(expr: str) -> str:
    return query(f"SELECT admission_id, {shown('load_dttm')}, {expr} FROM raw_admissions")


_prev = "lag(discharge_date) OVER (PARTITION BY patient_id ORDER BY admit_date NULLS LAST, admission_id)"
_chunked = query(
    f"SELECT admission_id, patient_visit_seq, patient_total_visits, CAST({_prev} AS VARCHAR) AS discharge_date FROM visits"
)
_hits = "SELECT line_no, rank, hit AS text FROM log_hits"

ORACLE = {
    "dedup_latest": query(
        " UNION ALL ".join(
            f"SELECT '{n}' AS feed, {k} AS id, file_name, {shown('load_dttm')} FROM latest_{n}"
            for n, k in (("admissions", "admission_id"), ("treatments", "treatment_id"), ("claims", "claim_id"))
        )
    ),
    "visit_sequence": query("SELECT admission_id, patient_id, patient_visit_seq FROM visits"),
    "partition_count": query("SELECT admission_id, patient_total_visits FROM visits"),
    "lag_prev_discharge": query(f"SELECT admission_id, CAST({_prev} AS VARCHAR) AS discharge_date FROM visits"),
    "large_group_sequence": _chunked,
    "window_avg_stddev": query("SELECT procedure_code, mean_cents / 100.0 AS avg_cost, round(sd / 100, 3) AS deviation FROM procedure_stats"),
    "window_percentile_cont": query("SELECT procedure_code, CAST(p99_x100 AS BIGINT) AS percentile_x100 FROM procedure_stats"),
    "treatment_sequence": query("SELECT treatment_id, treatment_seq_in_admission, treatments_in_admission FROM stg_treatments"),
    "duplicate_row_window": query("SELECT file_name, dup_rows FROM gate_twins WHERE dup_rows > 0"),
    "first_version_flag": query(f"SELECT doctor_id, {shown('valid_from')}, valid_from = TIMESTAMP '1900-01-01' AS is_first FROM dim_doctor_history"),
    "cost_zscore": query("SELECT treatment_id, CAST(cost_zscore AS DOUBLE) AS cost_zscore FROM stg_treatments"),
    "cost_outlier": query("SELECT treatment_id, is_cost_outlier FROM stg_treatments"),
    "readmission_30d": query(
        "SELECT admission_id, is_30day_readmission, days_since_last_visit, coalesce(days_since_last_visit < 0, FALSE) AS overlaps FROM stg_admissions"
    ),
    "project_rename_literal": query("SELECT claim_id AS claim, CAST(claim_amount AS DOUBLE) AS amount, 'GATEKEEPER' AS source_system FROM raw_claims"),
    "star_plus_computed": query(
        f"SELECT {shown(*m.STG_CLAIMS)}, CAST(coalesce(unapproved_amount, claim_amount) AS DOUBLE) AS share_open FROM stg_claims"
    ),
    "filter_latest": query(f"SELECT admission_id, length_of_stay, {shown('load_dttm')} FROM latest_admissions"),
    "simple_case_decode": query(
        f"""SELECT {m._labels(m.code('admission_type'), m.ADMISSION_TYPES)} AS label, count(*) AS n FROM raw_admissions GROUP BY 1
UNION ALL SELECT {m._labels(m.code('outcome'), m.OUTCOMES)}, count(*) FROM raw_treatments GROUP BY 1
UNION ALL SELECT {m._labels(m.code('claim_status'), m.CLAIM_STATUSES)}, count(*) FROM raw_claims GROUP BY 1"""
    ),
    "searched_case_dq_admissions": _adm("dq_status AS status"),
    "searched_case_dq_treatments": query("SELECT treatment_id, dq_status AS status FROM stg_treatments"),
    "searched_case_dq_claims": query("SELECT claim_id, dq_status AS status FROM stg_claims"),
    "is_valid_gate": _adm("is_valid"),
    "boolean_flags": query("SELECT claim_id, is_approved, is_pending FROM stg_claims"),
    "between_not_in_null_predicates": query(
        """SELECT count(*) FILTER (WHERE approved_amount BETWEEN 0 AND 100000) AS within, count(*) FILTER (WHERE approved_amount NOT BETWEEN 0 AND 100000) AS outside,
  count(*) FILTER (WHERE claim_status IN ('A', 'R')) AS listed, count(*) FILTER (WHERE claim_status NOT IN ('A', 'R')) AS unlisted,
  count(*) FILTER (WHERE approved_amount IS NULL OR settle_date IS NULL) AS missing,
  count(*) FILTER (WHERE approved_amount IS NOT NULL AND approved_amount > claim_amount) AS above FROM raw_claims"""
    ),
    "seniority_band": query("SELECT doctor_id, seniority_band FROM dim_doctor"),
    "patient_segment": query("SELECT patient_id, patient_segment FROM dim_patient"),
    "str_upper_trim": _raw_adm("upper(trim(doctor_id)) AS doctor"),
    "str_lower_strip_replace": """SELECT c_custkey, lower(trim('  ' || c_name || ' ')) AS lowered, replace('O''' || c_mktsegment, '''', '') AS unquoted,
  replace('O''' || c_mktsegment, '''', '''''') AS doubled FROM customer""",
    "str_split_last_contains_endswith": """SELECT page_id, list_extract(string_split(url, '/'), -1) AS last_part, contains(url, 'page') AS has_page,
  ends_with(url, 'x') AS ends_x FROM pages""",
    "str_join_format": query(
        """SELECT file_name, concat_ws(', ', 'doctor_id=' || printf('%.1f', count(*) FILTER (WHERE doctor_id IS NULL) * 100.0 / count(*)) || '%',
  'hospital_id=' || printf('%.1f', count(*) FILTER (WHERE hospital_id IS NULL) * 100.0 / count(*)) || '%') AS detail FROM raw_admissions GROUP BY file_name"""
    ),
    "cast_to_varchar": _adm("strftime(admit_date, '%Y-%m-%d') AS admitted"),
    "cast_boolean": _raw_adm("readmission_flag = 1 AS flag"),
    "try_cast_number": """SELECT event_id, CAST(TRY_CAST(CASE WHEN event_id % 3 = 0 THEN event_type ELSE CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END AS DECIMAL(38,0)) AS DOUBLE) AS number FROM events""",
    "date_parse_multi": _raw_adm(f"CAST({m.parsed('admit_date')} AS VARCHAR) AS admit_date"),
    "date_add_days": _adm("CAST(CAST(admit_date + to_days(CAST(length_of_stay AS INTEGER)) AS DATE) AS VARCHAR) AS discharge_date"),
    "date_diff_days": query("SELECT claim_id, settle_date - claim_date AS days FROM stg_claims"),
    "date_parts": _adm("year(admit_date) AS year", "quarter(admit_date) AS quarter", "month(admit_date) AS month", "day(admit_date) AS day_of_month"),
    "date_names": _adm("strftime(admit_date, '%b') AS month_name", "strftime(admit_date, '%a') AS day_name"),
    "day_of_week_weekend": _adm("dayofweek(admit_date) AS day_of_week", "dayofweek(admit_date) IN (0, 6) AS is_weekend"),
    "as_of_date": _adm(f"admit_date > DATE '{a.AS_OF}' AS in_future"),
    "utc_now": query("SELECT file_name, 1 AS stamps, count(*) AS n FROM raw_claims GROUP BY file_name"),
    "math_round_ratio": query(
        """SELECT claim_id, ((CAST(claim_amount * 100 AS HUGEINT) * 2 + 3) // 6) / 100.0 AS thirds, CAST(claim_amount - approved_amount AS DOUBLE) AS open FROM stg_claims"""
    ),
    "guarded_ratio": query("SELECT claim_id, approval_ratio FROM stg_claims"),
    "coalesce_nulls": query(
        "SELECT claim_id, CAST(coalesce(settle_date, claim_date) AS VARCHAR) AS settled, CASE WHEN settle_date IS NOT NULL THEN claim_status END AS only_settled FROM stg_claims"
    ),
    "surrogate_key": _adm(
        f"{m.key_of('doctor_id')} AS one", f"{m.key_of('patient_id', 'admit_date')} AS two", f"{m.key_of('hospital_id', m.millis('load_dttm'))} AS stamped"
    ),
    "run_id_stamp": query("SELECT strftime(load_dttm, '%Y%m%d_%H%M%S') AS stamp, 8 AS run_id_length, count(*) AS n FROM raw_claims GROUP BY 1"),
    "regex_extract_rules": query(_hits),
    "list_ops": query(
        f"""SELECT file_name, list_contains(header, 'patient_id') AS has_patient,
  array_to_string(list_filter({sg._per_feed(lambda f: sg._list(f.columns))}, lambda x: NOT list_contains(header, x)), ',') AS missing,
  array_to_string(header[1:5], ',') AS first_five FROM gate_named"""
    ),
    "limit_one": query("SELECT file_name, header[1] AS first_name FROM gate_named"),
    "first_k_unique": query(
        m.RELATIONS["log_causes"].strip(),
    )
    .replace("run_no, task_id", "task_id")
    .replace("SELECT event_id % 50 AS run_no,", "SELECT"),
    "ordered_window_sort": query(
        "SELECT patient_id, admission_id, CAST(admit_date AS VARCHAR) AS admit_date FROM visits WHERE patient_visit_seq = patient_total_visits"
    ),
    "union_all_versions": query("SELECT admission_id, count(*) AS versions FROM raw_admissions GROUP BY admission_id"),
}
