"""Layer databases, full refresh and upsert by key. Stored tables that change together: see ``store``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.feeds import FEEDS
from wardline.operators.joins import not_in_keys
from wardline.sinks import audit

# Layer names.
LAYERS = ("raw", "staging", "marts", "snapshots", "audit")
AUDIT_TABLES = {
    "file_processing_log": audit.FILE_LOG,
    "dq_metrics_log": audit.CHECK_LOG,
    "pipeline_error_log": audit.ERROR_LOG,
    "email_recipient_log": audit.RECIPIENTS,
}


def layer_name(custom: str | None, default: str) -> str:
    """A custom layer name is trimmed and upper-cased; without one the default holds."""
    return default if custom is None else custom.strip().upper()


def database(layer: str, prefix: str = "") -> str:
    return f"{prefix}{layer}".lower()


def layer_table(spark: SparkSession, layer: str, name: str, prefix: str = "") -> DataFrame:
    return spark.table(f"{database(layer, prefix)}.{name.lower()}")


def ensure_layers(spark: SparkSession, root: str, prefix: str = "") -> None:
    """Databases and the empty landing and audit tables, where they do not exist yet."""
    for layer in LAYERS:
        db = database(layer, prefix)
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{root}/{db}'")
    wanted = {("raw", f.name): f.landing_schema for f in FEEDS.values()}
    wanted |= {("audit", name): ddl for name, ddl in AUDIT_TABLES.items()}
    for (layer, name), schema in wanted.items():
        full = f"{database(layer, prefix)}.{name}"
        if not spark.catalog.tableExists(full):
            spark.createDataFrame([], schema).write.mode("ignore").saveAsTable(full)


def catalog_listing(spark: SparkSession, layer: str, prefix: str = "") -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(database(layer, prefix)))


def full_refresh(df: DataFrame, layer: str, name: str, prefix: str = "") -> DataFrame:
    full = f"{database(layer, prefix)}.{name}"
    df.write.mode("overwrite").saveAsTable(full)
    return df.sparkSession.table(full)


# ── upsert ──────────────────────────────────────────────────────────────────────────────────────


def merge_upsert(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """``target`` with the rows of ``source`` put in or replaced by key."""
    return not_in_keys(target, source.select(key), key).unionByName(source)


def schema_sync_upsert(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Same, following the columns of ``source``: added ones are NULL in old rows, removed ones go."""
    kept = not_in_keys(target, source.select(key), key)
    return kept.unionByName(source, allowMissingColumns=True).select(*source.columns)


def changed_rows(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Rows of ``source`` that are new or differ from their ``target`` row in any column, NULL-safe.

    One join on the key; the other columns are compared beside it, not shuffled on.
    """
    t = target.select(*[F.col(c).alias(f"_t_{c}") for c in source.columns], F.lit(True).alias("_found"))
    joined = source.join(t, F.col(key).eqNullSafe(F.col(f"_t_{key}")), "left")
    equal = F.lit(True)
    for c in source.columns:
        equal = equal & F.col(c).eqNullSafe(F.col(f"_t_{c}"))
    return joined.filter(F.col("_found").isNull() | ~equal).select(*source.columns)
