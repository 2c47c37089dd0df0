"""The gate: tiered quality checks over all files of a batch at once.

Instead of a handful of scans per file, one grouped pass computes every counter of every file,
whatever its feed: each file carries the positions of its key, date, category, numeric and required
columns, found in its own header.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.feeds import FEEDS, FeedConfig, GateLimits
from wardline.functions.dates import parse_date
from wardline.functions.numbers import try_number
from wardline.functions.text import percent_text, quoted_list
from wardline.operators.joins import SENT_ROWS, about_group
from wardline.sources.files import lenient_load

GATE, THRESHOLD, ADVISORY = "GATE", "THRESHOLD", "ADVISORY"
LOAD = "LOAD"  # tier of faults that only the typed load finds
QUARANTINED, PASSED, LOAD_FAILED = "QUARANTINED", "PASSED", "LOAD_FAILED"
GATE_CHECKS = ("file_not_empty", "column_count", "required_columns")
ALL_CHECKS = GATE_CHECKS + (
    "row_count",
    "null_percentage",
    "data_types",
    "pk_uniqueness",
    "valid_category",
    "duplicate_rows",
    "date_range",
)
MAX_REQUIRED = max(len(f.required) for f in FEEDS.values())
MAX_NUMERIC = max(len(f.numeric) for f in FEEDS.values())


def per_feed(make: Callable[[FeedConfig], Column]) -> Column:
    out = None
    for cfg in FEEDS.values():
        hit = F.col("feed") == cfg.name
        out = F.when(hit, make(cfg)) if out is None else out.when(hit, make(cfg))
    return out


def _names(names: Iterable[str]) -> Column:
    return F.array(*[F.lit(n) for n in names])


def _position(name: str) -> Column:
    return F.nullif(F.array_position("header", name), F.lit(0)).cast("int")


def _positions(names: Iterable[str]) -> Column:
    return F.array(*[_position(n) for n in names])


def file_plan(manifest: DataFrame, headers: DataFrame) -> DataFrame:
    """One row per file: gate results and where the checked columns are."""
    h = headers.select(F.col("file_name").alias("_f"), F.col("header").alias("_h"))
    known = manifest.select("file_name", "feed", "size").join(h, F.col("file_name") == F.col("_f"), "left")
    header = F.coalesce(F.col("_h"), F.array().cast("array<string>"))
    plan = known.select("file_name", "feed", "size", header.alias("header")).withColumns(
        {
            "expected": per_feed(lambda c: F.lit(len(c.columns))),
            "missing": F.array_except(per_feed(lambda c: _names(c.required)), F.col("header")),
            "required_at": per_feed(lambda c: _positions(c.required)),
            "numeric_at": per_feed(lambda c: _positions(c.numeric)),
            "key_at": per_feed(lambda c: _position(c.key)),
            "date_at": per_feed(lambda c: _position(c.date_column)),
            "category_at": per_feed(lambda c: _position(c.category_column)),
            "categories": per_feed(lambda c: _names(c.categories)),
        }
    )
    open_gate = (F.col("size") > 0) & (F.size("header") == F.col("expected")) & (F.size("missing") == 0)
    return plan.withColumn("gate_ok", open_gate)


def _cell(position: Column) -> Column:
    return F.get(F.col("cells"), position - 1)


def placed_rows(staged: DataFrame, plan: DataFrame, most: int = SENT_ROWS) -> DataFrame:
    """Kept rows of the files that passed the gate tier, with their file's positions."""
    at = plan.filter("gate_ok").select(
        "file_name", "required_at", "numeric_at", "key_at", "date_at", "category_at", "categories"
    )
    return about_group(lenient_load(staged).select("file_name", "cells"), at, "file_name", most)


def file_counters(rows: DataFrame, limits: GateLimits) -> DataFrame:
    """Row, null, non-numeric, category and date counters per file, summed on the map side first."""
    bad_number = F.lit(False)
    for i in range(MAX_NUMERIC):
        at = F.get("numeric_at", F.lit(i))
        fails = try_number(_cell(at)).isNull()
        if not limits.null_is_bad:
            fails = fails & _cell(at).isNotNull()
        bad_number = bad_number | (at.isNotNull() & fails)
    category = _cell(F.col("category_at"))
    parsed = parse_date(_cell(F.col("date_at")))
    lo, hi = (F.lit(x).cast("date") for x in (limits.date_min, limits.date_max))
    return rows.groupBy("file_name").agg(
        F.count(F.lit(1)).alias("n"),
        *[
            F.count_if(_cell(F.get("required_at", F.lit(i))).isNull()).alias(f"null_{i}")
            for i in range(MAX_REQUIRED)
        ],
        F.count_if(bad_number).alias("bad_numbers"),
        F.count_if(category.isNotNull() & ~F.array_contains("categories", category)).alias("bad_categories"),
        F.count_if(~parsed.between(lo, hi)).alias("bad_dates"),
    )


def repeated_keys(rows: DataFrame) -> DataFrame:
    """(file, key) with more than one row; a missing key value is a value of its own."""
    keyed = rows.select("file_name", _cell(F.col("key_at")).alias("key"))
    return keyed.groupBy("file_name", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def repeated_rows(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Number of rows per file that have an equal twin.

    Equal rows have equal keys, so only rows under a repeated key are grouped by all their cells:
    a clean file costs no wide shuffle at all.
    """
    k = keys.select(F.col("file_name").alias("_kf"), F.col("key").alias("_kv"))
    suspects = rows.select("file_name", "cells", _cell(F.col("key_at")).alias("_v")).join(
        k, (F.col("file_name") == F.col("_kf")) & F.col("_v").eqNullSafe(F.col("_kv")), "left_semi"
    )
    groups = suspects.groupBy("file_name", "cells").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return groups.groupBy("file_name").agg(F.sum("n").alias("dup_rows"))


def _check(order: int, name: Column, tier: str, passed: Column, detail: Column) -> Column:
    return F.struct(
        F.lit(order).alias("ord"),
        name.alias("check_name"),
        F.lit(tier).alias("tier"),
        passed.alias("passed"),
        detail.alias("detail"),
    )


def _counted(label: str, c: Column) -> Column:
    return F.concat(F.lit(f"{label}="), c.cast("string"))


def check_rows(
    plan: DataFrame, staged: DataFrame, limits: GateLimits = GateLimits(), only: Iterable[str] = ALL_CHECKS
) -> DataFrame:
    """One row per file and check: ``file_name, feed, ord, check_name, tier, passed, detail``.

    If a GATE check fails only the GATE results appear. ``only`` restricts the checks, and with
    them the passes over the rows.
    """
    only = set(only)
    wide = plan
    if only - set(GATE_CHECKS):
        rows = placed_rows(staged, plan)
        zero = lambda c: F.coalesce(c, F.lit(0))
        counters = file_counters(rows, limits).withColumnRenamed("file_name", "_f")
        wide = wide.join(counters, F.col("file_name") == F.col("_f"), "left").drop("_f")
        wide = wide.withColumns(
            {c: zero(F.col(c)) for c in ["n", "bad_numbers", "bad_categories", "bad_dates"]}
            | {f"null_{i}": zero(F.col(f"null_{i}")) for i in range(MAX_REQUIRED)}
        )
        if only & {"pk_uniqueness", "duplicate_rows"}:
            keys = repeated_keys(rows)
            per_file = keys.groupBy(F.col("file_name").alias("_f")).agg(F.count(F.lit(1)).alias("dup_keys"))
            wide = wide.join(per_file, F.col("file_name") == F.col("_f"), "left").drop("_f")
            wide = wide.withColumn("dup_keys", zero(F.col("dup_keys")))
        if "duplicate_rows" in only:
            twins = repeated_rows(rows, keys).withColumnRenamed("file_name", "_f")
            wide = wide.join(twins, F.col("file_name") == F.col("_f"), "left").drop("_f")
            wide = wide.withColumn("dup_rows", zero(F.col("dup_rows")))

    gates, later = [], []
    for order, name in enumerate(ALL_CHECKS, start=1):
        if name in only:
            (gates if name in GATE_CHECKS else later).append(_one(order, name, limits))
    none = F.array().cast(
        "array<struct<ord:int,check_name:string,tier:string,passed:boolean,detail:string>>"
    )
    results = F.concat(
        F.array(*gates) if gates else none,
        F.when(F.col("gate_ok"), F.array(*later)).otherwise(none) if later else none,
    )
    return wide.select("file_name", "feed", F.explode(results).alias("r")).select("file_name", "feed", "r.*")


def _one(order: int, name: str, limits: GateLimits) -> Column:
    label = F.lit(name)
    missing = F.lit("column missing")
    if name == "file_not_empty":
        size = F.concat(F.lit("size="), F.col("size").cast("string"), F.lit(" bytes"))
        return _check(order, label, GATE, F.col("size") > 0, size)
    if name == "column_count":
        found = F.size("header")
        detail = F.format_string("found %d, expected %d", found, F.col("expected"))
        return _check(order, label, GATE, found == F.col("expected"), detail)
    if name == "required_columns":
        ok = F.size("missing") == 0
        detail = F.when(ok, "all present").otherwise(F.concat(F.lit("missing="), quoted_list(F.col("missing"))))
        return _check(order, label, GATE, ok, detail)
    if name == "row_count":
        return _check(order, label, THRESHOLD, F.col("n") >= limits.min_rows, _counted("rows", F.col("n")))
    if name == "null_percentage":
        share = lambda i: F.col(f"null_{i}").cast("decimal(20,0)") * 100
        most = F.lit(limits.max_null_pct).cast("decimal(6,3)") * F.col("n").cast("decimal(20,0)")
        named = lambda cfg: F.concat_ws(
            ", ",
            *[
                F.concat(F.lit(f"{c}="), percent_text(F.col(f"null_{i}"), F.col("n")))
                for i, c in enumerate(cfg.required)
            ],
        )

        def within(cfg: FeedConfig) -> Column:
            ok = F.lit(True)
            for i in range(len(cfg.required)):
                ok = ok & (share(i) <= most)
            return ok

        return _check(order, label, THRESHOLD, per_feed(within), per_feed(named))
    if name == "data_types":
        lost = F.exists("numeric_at", lambda p: p.isNull())
        detail = F.when(lost, missing).otherwise(_counted("non-numeric rows", F.col("bad_numbers")))
        return _check(order, label, THRESHOLD, ~lost & (F.col("bad_numbers") == 0), detail)
    if name == "pk_uniqueness":
        return _check(
            order, label, THRESHOLD, F.col("dup_keys") == 0, _counted("duplicate ids", F.col("dup_keys"))
        )
    if name == "valid_category":
        label = per_feed(lambda c: F.lit(f"valid_{c.category_column}"))
        lost = F.col("category_at").isNull()
        detail = F.when(lost, missing).otherwise(_counted("invalid values", F.col("bad_categories")))
        return _check(order, label, THRESHOLD, ~lost & (F.col("bad_categories") == 0), detail)
    if name == "duplicate_rows":
        return _check(order, label, ADVISORY, F.col("dup_rows") == 0, _counted("dup rows", F.col("dup_rows")))
    lost = F.col("date_at").isNull()
    detail = F.when(lost, missing).otherwise(_counted("out-of-range dates", F.col("bad_dates")))
    return _check(order, label, ADVISORY, ~lost & (F.col("bad_dates") == 0), detail)


# ── verdicts ────────────────────────────────────────────────────────────────────────────────────


def _listed(wanted: Column, text: Column) -> Column:
    """Texts of the wanted checks in check order; a file has ten checks at most."""
    picked = F.collect_list(F.when(wanted, F.struct("ord", text.alias("text"))))
    return F.transform(F.array_sort(picked), lambda x: x["text"])


def file_verdicts(checks: DataFrame) -> DataFrame:
    """Status, counts and texts per file; ADVISORY checks never block."""
    failed = ~F.col("passed")
    blocking = failed & F.col("tier").isin(GATE, THRESHOLD)
    line = F.format_string("    - %s [%s]: %s", F.col("check_name"), F.col("tier"), F.col("detail"))
    return checks.groupBy("file_name", "feed").agg(
        F.when(F.bool_or(blocking), QUARANTINED).otherwise(PASSED).alias("status"),
        F.count_if("passed").alias("checks_passed"),
        F.count_if(failed).alias("checks_failed"),
        F.array_join(_listed(blocking, line), "\n").alias("failed_checks"),
        _listed(failed & (F.col("tier") == ADVISORY), F.col("check_name")).alias("advisories"),
    )


def load_faults(faults: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Check rows of what kept passed files from loading (``file_name, column_name, bad_rows``)."""
    feeds = verdicts.select(F.col("file_name").alias("_f"), "feed")
    name = F.coalesce(F.concat(F.lit("load_"), F.col("column_name")), F.lit("load_ragged_rows"))
    return faults.join(feeds, F.col("file_name") == F.col("_f")).select(
        "file_name", "feed", F.lit(len(ALL_CHECKS) + 1).alias("ord"), name.alias("check_name"), F.lit(LOAD).alias("tier"),
        F.lit(False).alias("passed"), _counted("bad rows", F.col("bad_rows")).alias("detail"),
    )


def after_load(verdicts: DataFrame, faults: DataFrame) -> DataFrame:
    """Verdicts once the load is tried: a passed file with faults is LOAD_FAILED."""
    line = F.format_string("    - %s [%s]: %s", F.col("check_name"), F.col("tier"), F.col("detail"))
    texts = faults.groupBy(F.col("file_name").alias("_f")).agg(
        F.count(F.lit(1)).alias("_n"), F.array_join(F.array_sort(F.collect_list(line)), "\n").alias("_text")
    )
    failed = F.col("_n").isNotNull()
    return verdicts.join(texts, F.col("file_name") == F.col("_f"), "left").select(
        "file_name", "feed", F.when(failed, LOAD_FAILED).otherwise(F.col("status")).alias("status"), "checks_passed",
        (F.col("checks_failed") + F.coalesce("_n", F.lit(0))).alias("checks_failed"),
        F.when(failed, F.col("_text")).otherwise(F.col("failed_checks")).alias("failed_checks"), "advisories",
    )


def advisory_warnings(verdicts: DataFrame) -> DataFrame:
    passed = verdicts.filter((F.col("status") == PASSED) & (F.size("advisories") > 0))
    return passed.select("file_name", "feed", F.array_join("advisories", ", ").alias("advisories"))


def run_summary(file_log: DataFrame) -> DataFrame:
    """What happened in a run; a quarantined file is reported, not raised."""
    return file_log.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("files_seen"),
        F.sum("rows_loaded").alias("rows_loaded"),
        F.count_if(F.col("status") != PASSED).alias("files_quarantined"),
        F.bool_or(F.col("status") != PASSED).alias("any_quarantined"),
    )


# ── pre-flight ──────────────────────────────────────────────────────────────────────────────────


def preflight_header_diff(manifest: DataFrame, headers: DataFrame) -> DataFrame:
    """Header against the expected list, in order: OK, WARN with differences, or SKIP."""
    h = headers.select(F.col("file_name").alias("_f"), F.col("header").alias("_h"))
    files = manifest.filter(F.lower("file_name").endswith(".csv")).select("file_name", "feed")
    both = files.join(h, F.col("file_name") == F.col("_f"), "left")
    header = F.coalesce(F.col("_h"), F.array().cast("array<string>"))
    expected = per_feed(lambda c: _names(c.columns))
    both = both.withColumns({"found": header, "expected": expected})
    names = lambda a, b: F.when(F.col("feed").isNotNull(), F.array_join(F.array_except(a, b), ", "))
    return both.select(
        "file_name",
        "feed",
        F.when(F.col("feed").isNull(), "SKIP")
        .when(F.col("found") == F.col("expected"), "OK")
        .otherwise("WARN")
        .alias("verdict"),
        names("expected", "found").alias("missing"),
        names("found", "expected").alias("extra"),
    )
