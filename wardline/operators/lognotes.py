"""Root causes of failed tasks, mined from log lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from wardline.functions.text import without_colours

# Error patterns in order of precedence, message texts, the number of hits shown.
_NAME = r"([A-Za-z0-9_.]+)"
PATTERNS = (
    (rf"ERROR creating.*model\s+{_NAME}", "Model failed to build: ", None),
    (rf"Compilation Error in (model|test|snapshot)\s+{_NAME}", "Compilation error in ", ": "),
    (rf"Database Error in (model|test|snapshot)\s+{_NAME}", "Database error in ", ": "),
    (rf"Failure in test\s+{_NAME}", "Test failed: ", None),
)
GENERIC = {
    "dbt_run": "dbt failed to build the Silver/Gold models (broken SQL or model error).",
    "dbt_snapshot": "dbt failed to capture SCD2 snapshot history.",
    "dbt_test": "One or more dbt data-quality tests failed.",
    "reconciliation": "The reconciliation step failed.",
}
GENERIC_OTHER = "A pipeline task failed."
MEANINGS = {
    "gatekeeper_validate": (
        "The gatekeeper worker itself failed to run (e.g. Snowflake unreachable, bad credentials, or a script "
        "error). This is NOT a file quarantine - if a file had failed the 12 checks you'd get a QUARANTINE email "
        "instead."
    ),
    "trigger_healthcare_pipeline": "Failed to trigger the downstream healthcare_pipeline transform DAG.",
}
MEANING_OTHER = "A gatekeeper task failed."
SHOWN = 5  # messages of a task that its text keeps unless told otherwise


def looked_up(key: Column, texts: dict[str, str], default: str) -> Column:
    out = None
    for k, text in texts.items():
        out = F.when(key == k, text) if out is None else out.when(key == k, text)
    return out.otherwise(default)


def generic_cause(task: Column) -> Column:
    return looked_up(task, GENERIC, GENERIC_OTHER)


def failure_meaning(task: Column) -> Column:
    return looked_up(task, MEANINGS, MEANING_OTHER)


def line_hits(line: Column) -> Column:
    """Messages of one line with the rank of their pattern."""
    clean = without_colours(line)
    hits = []
    for rank, (pattern, label, joint) in enumerate(PATTERNS):
        first = F.regexp_extract(clean, pattern, 1)
        text = F.concat(F.lit(label), first)
        if joint is not None:
            text = F.concat(text, F.lit(joint), F.regexp_extract(clean, pattern, 2))
        hits.append(F.when(F.regexp_like(clean, F.lit(pattern)), F.struct(F.lit(rank).alias("rank"), text.alias("text"))))
    return F.array_compact(F.array(*hits))


def root_causes(lines: DataFrame, *task_keys: str, shown: int = SHOWN, tasks: DataFrame | None = None) -> DataFrame:
    """One text per task from ``line_no, line`` rows; the last of ``task_keys`` is the task id.

    Hits come pattern by pattern, each in line order, once, the first ``shown``, two blanks apart. Equal
    messages are merged before the shuffle and only the first few of a task are ever gathered, so
    a task that wrote most of the log is no burden. ``tasks`` (``task_keys``) are the failed tasks, also
    those that wrote no line; by default those that wrote one.
    """
    keys = list(task_keys)
    hits = lines.select(*keys, "line_no", F.inline(line_hits(F.col("line"))))
    unique = hits.groupBy(*keys, "text").agg(F.min(F.struct("rank", "line_no")).alias("at"))
    order = W.partitionBy(*keys).orderBy("at")
    top = unique.withColumn("i", F.row_number().over(order)).filter(F.col("i") <= shown)
    joined = top.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("i", "text"))).alias("found"))
    found = joined.select(
        *[F.col(k).alias(f"_{k}") for k in keys],
        F.array_join(F.transform("found", lambda x: x["text"]), "  ").alias("found"),
    )
    match = F.lit(True)
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_{k}"))
    tasks = (lines if tasks is None else tasks).select(*keys).distinct()
    return tasks.join(found, match, "left").select(
        *keys, F.coalesce("found", generic_cause(F.col(keys[-1]))).alias("root_cause")
    )
