"""Keep the newest version of each key."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.types import StructField, StructType

from wardline.operators.sequence import SAMPLES


def newest_first(columns: Sequence[str], key: str) -> list:
    """Total order: load stamp, then upload stamp, file, and every other column.

    All rows of one load share a stamp, so the stamp alone would leave the winner to chance.
    """
    lead = [c for c in ("load_dttm", "upload_dttm", "file_name") if c in columns]
    rest = [c for c in columns if c not in lead and c != key]
    return [F.col(c).desc_nulls_last() if i else F.col(c).desc_nulls_first() for i, c in enumerate(lead + rest)]


def large_keys(df: DataFrame, key: str, samples: int = SAMPLES) -> list | None:
    """Keys that hold some two shares of a shuffle partition or more, in a sample; None if ``df`` is smaller than the sample.

    ``samples`` rows per shuffle partition are drawn in one pass over the key, so at most half as many keys
    as there are partitions come out.
    """
    wanted = samples * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    picked = df.select(F.col(key).alias("key")).orderBy(F.rand(1)).limit(wanted).collect()
    if len(picked) < wanted:
        return None
    return [k for k, n in Counter(r["key"] for r in picked).items() if n >= 2 * samples]


def dedup_latest(df: DataFrame, key: str, samples: int = SAMPLES) -> DataFrame:
    """One row per key (NULL is a key of its own).

    Rows of large keys and those of small tables are filtered directly on ``row_number``, so Spark keeps one row
    per key and map task before the shuffle (WindowGroupLimit): a key with any number of copies never
    lands whole in a task. That sorts a whole input split in each map task and keeps nearly all of it where keys
    repeat little; so the other rows, nearly all usually, are sorted behind the shuffle only, by a
    partition's share. Which keys count as large only deals the work.
    """
    order = newest_first(df.columns, key)
    newest = W.partitionBy(key).orderBy(*order)
    limited = lambda rows: rows.withColumn("_version", F.row_number().over(newest)).filter(F.col("_version") == 1).drop("_version")
    large = large_keys(df, key, samples)
    if large is None:
        return limited(df)
    # the first row of a key has none before it
    shuffled = lambda rows: rows.withColumn("_follows", F.lag(F.lit(True)).over(newest)).filter(F.col("_follows").isNull()).drop("_follows")
    if not large:
        return shuffled(df)
    schema = StructType([StructField("_large", df.schema[key].dataType)])
    listed = F.broadcast(df.sparkSession.createDataFrame([(k,) for k in large], schema))
    is_large = F.col(key).eqNullSafe(F.col("_large"))
    return limited(df.join(listed, is_large, "left_semi")).unionByName(shuffled(df.join(listed, is_large, "left_anti")))
