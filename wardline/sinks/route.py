"""Where a checked file goes: processed/ or quarantine/, one folder per run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.operators.checks import PASSED
from wardline.operators.joins import about_group


def routed_lines(lines: DataFrame, verdicts: DataFrame, run_stamp: str) -> DataFrame:
    """Raw lines with the folder their file belongs to."""
    to = verdicts.select("file_name", folder_of(F.col("status")).alias("folder"))
    return about_group(lines, to, "file_name").select(
        "folder", F.lit(run_stamp).alias("run_stamp"), "file_name", "line_no", "line"
    )


def folder_of(status: Column) -> Column:
    return F.when(status == PASSED, "processed").otherwise("quarantine")


def write_lines(routed: DataFrame, path: str) -> None:
    """Lines as text under ``folder=/run_stamp=/file_name=``.

    No repartitioning: each task writes the lines it has read, so a huge file stays spread over
    tasks. A run writes only below its own stamp, and a repeated run replaces its files there.
    """
    out = routed.select("folder", "run_stamp", "file_name", F.col("line").alias("value"))
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("folder", "run_stamp", "file_name").text(path)


def move_files(spark: SparkSession, verdicts: DataFrame, incoming: str, root: str, run_stamp: str) -> int:
    """Rename each checked file into its folder; no content is read or rewritten.

    One metadata call per file. A target that exists (a retried run) is left as it is.
    """
    jvm = spark._jvm
    Path = jvm.org.apache.hadoop.fs.Path
    fs = Path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    moved = 0
    for r in verdicts.select("file_name", folder_of(F.col("status")).alias("folder")).toLocalIterator():
        folder = Path(f"{root}/{r['folder']}/{run_stamp}")
        source, target = Path(f"{incoming}/{r['file_name']}"), Path(folder, r["file_name"])
        fs.mkdirs(folder)
        if fs.exists(source) and not fs.exists(target):
            moved += bool(fs.rename(source, target))
    return moved
