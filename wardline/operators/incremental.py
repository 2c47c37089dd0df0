"""Keeping cleaned tables and facts current from newly landed rows.

The cleaned table already holds the newest version of every older row, so a step reads the landing
table only beyond the watermark and takes neighbours from the cleaned table. Each step gives what a
full rebuild would. "Fresh" rows are those landed since: beyond the watermark, or one batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.functions.dates import add_days
from wardline.operators import spread
from wardline.operators.joins import in_keys, not_in_keys
from wardline.operators.sequence import SAMPLES, number_rows
from wardline.plans import silver
from wardline.session import written
from wardline.sinks.tables import changed_rows, merge_upsert

BEFORE_ALL = "0001-01-01 00:00:00"


def max_watermark(target: DataFrame) -> DataFrame:
    """Newest load stamp of a table; an empty one lets everything through."""
    floor = F.lit(BEFORE_ALL).cast("timestamp_ntz")
    return target.agg(F.coalesce(F.max("load_dttm"), floor).alias("watermark"))


def watermark_filter(landed: DataFrame, target: DataFrame) -> DataFrame:
    """Rows loaded after the target's newest; the scalar subquery reaches the Parquet scan."""
    return landed.filter(F.col("load_dttm") > max_watermark(target).scalar())


def still_newest(fresh: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """``fresh`` rows that no row of ``target`` with their key outdates, in the order of ``latest.newest_first``.

    A batch may land after a younger one. Its rows count where the table has no newer version; two
    batches with one load stamp, upload stamp and file hold the same file, so equals may go either way.
    """
    stamps = ("load_dttm", "upload_dttm", "file_name")
    t = target.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_{c}") for c in stamps])
    older, same = F.lit(False), F.lit(True)
    for i, c in enumerate(stamps):
        mine, theirs = F.col(c), F.col(f"_{c}")
        # NULL counts as the newest load stamp and as the oldest of the others
        low, high = (theirs, mine) if i == 0 else (mine, theirs)
        less = F.coalesce(mine < theirs, F.lit(False)) | (low.isNull() & high.isNotNull())
        older, same = older | (same & less), same & mine.eqNullSafe(theirs)
    return fresh.join(t, F.col(key).eqNullSafe(F.col("_k")) & older, "left_anti")


def _touched(new: DataFrame, target: DataFrame, key: str, group: str) -> DataFrame:
    """Groups of the new rows and groups those keys were in before."""
    before = in_keys(target, new, key).select(group)
    return new.select(group).unionByName(before).distinct()


# ── admissions ──────────────────────────────────────────────────────────────────────────────────


def rewritten_admissions(
    target: DataFrame, fresh: DataFrame, as_of: Column, samples: int = SAMPLES
) -> DataFrame:
    """Full histories of the patients touched by the freshly landed rows, the ones an admission
    moved away from included."""
    new = written(silver.clean_admissions(fresh), "new-admissions")
    patients = _touched(new, target, "admission_id", "patient_id")
    old = in_keys(not_in_keys(target, new, "admission_id"), patients, "patient_id").withColumn(
        "discharge_date", add_days(F.col("admit_date"), F.col("length_of_stay"))
    )
    base = written(new.unionByName(old.select(*new.columns)), "touched-admissions")
    return silver.admission_history(base, as_of, samples=samples)


def incr_admissions(target: DataFrame, landed: DataFrame, as_of: Column) -> DataFrame:
    return merge_upsert(target, written(rewritten_admissions(target, watermark_filter(landed, target), as_of), "upsert"), "admission_id")


# ── treatments ──────────────────────────────────────────────────────────────────────────────────

_COSTED = ["avg_cost_for_procedure", "cost_zscore", "is_cost_outlier"]
_NUMBERED = ["treatment_seq_in_admission", "treatments_in_admission"]


def _marked_treatments(target: DataFrame, fresh: DataFrame) -> DataFrame:
    """All rows as they are now, new ones and those of ``target`` that stay, each with its stored values;
    ``_costs`` and ``_steps`` mark rows of touched procedures and of touched admissions."""
    new = written(silver.clean_treatments(fresh), "new-treatments")
    procedures = written(_touched(new, target, "treatment_id", "procedure_code"), "procedures")
    admissions = written(_touched(new, target, "treatment_id", "admission_id"), "admissions")

    kept = not_in_keys(target, new, "treatment_id")
    stored = kept.select(*new.columns, *_COSTED, *_NUMBERED)
    now = stored.unionByName(new, allowMissingColumns=True)
    in_procedure = procedures.select(F.col("procedure_code").alias("_p"), F.lit(True).alias("_costs"))
    in_admission = admissions.select(F.col("admission_id").alias("_a"), F.lit(True).alias("_steps"))
    return (
        now.join(in_procedure, F.col("procedure_code").eqNullSafe(F.col("_p")), "left")
        .join(in_admission, F.col("admission_id").eqNullSafe(F.col("_a")), "left")
        .drop("_p", "_a")
    )


def _recomputed_treatments(touched: DataFrame, samples: int) -> DataFrame:
    """``touched`` (written) with new statistics and numbers where they are marked."""
    renumber = touched.filter("_steps").drop(*_NUMBERED)
    numbered = number_rows(renumber, silver.STEPS, samples=samples)
    rows = numbered.unionByName(touched.filter(F.col("_steps").isNull()))
    stats = spread.cost_statistics(touched.filter("_costs"), "procedure_code", "cost")
    joined = spread.attach(rows, stats, "procedure_code")
    chosen = lambda name, c: F.when(F.col("_costs"), c).otherwise(F.col(name))
    out = joined.withColumns(
        {
            "avg_cost_for_procedure": chosen("avg_cost_for_procedure", F.col("mean")),
            "cost_zscore": chosen("cost_zscore", spread.z_score(F.col("cost"))),
            "is_cost_outlier": chosen("is_cost_outlier", spread.above_percentile(F.col("cost"))),
        }
    )
    return silver.with_treatment_flags(out)


def rewritten_treatments(target: DataFrame, fresh: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Rows of every touched procedure and of every touched admission.

    Statistics are recomputed only for touched procedures and numbering only for touched
    admissions, each over its complete group; a row that is in one of the two keeps its stored
    values for the other, which are still right because that group did not change.
    """
    marked = _marked_treatments(target, fresh)
    return _recomputed_treatments(written(marked.filter("_costs or _steps"), "touched-treatments"), samples)


def incr_treatments(target: DataFrame, landed: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """``target`` with the rewritten rows put in or replaced by key.

    The rows that stay untouched are known from the pass that marks the others, so the table does not meet
    the rewritten keys a second time.
    """
    marked = written(_marked_treatments(target, watermark_filter(landed, target)), "marked-treatments")
    touched = F.coalesce("_costs", "_steps", F.lit(False))
    untouched = silver.with_treatment_flags(marked.filter(~touched)).select(*target.columns)
    return untouched.unionByName(_recomputed_treatments(marked.filter(touched), samples))


# ── claims ──────────────────────────────────────────────────────────────────────────────────────


def rewritten_claims(fresh: DataFrame) -> DataFrame:
    return silver.stg_claims(fresh)


def incr_claims(target: DataFrame, landed: DataFrame) -> DataFrame:
    return merge_upsert(target, written(rewritten_claims(watermark_filter(landed, target)), "upsert"), "claim_id")


# ── facts ───────────────────────────────────────────────────────────────────────────────────────


def incr_facts(
    target: DataFrame,
    cleaned: DataFrame,
    to_fact: Callable[[DataFrame], DataFrame],
    key: str,
    by_watermark: bool = False,
) -> DataFrame:
    """Fact rows to upsert.

    By default every row that differs from the stored fact, so that flags of older rows changed by
    a new neighbour arrive; ``cleaned`` may be just the rows the cleaning step rewrote. With
    ``by_watermark`` only rows loaded after the fact's newest.
    """
    if by_watermark:
        return to_fact(watermark_filter(cleaned, target))
    return changed_rows(to_fact(cleaned), target, key)


