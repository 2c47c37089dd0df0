"""Result layout for the side-by-side check: plain numbers and ISO texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, integers as bigint, dates and timestamps as text."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType | T.FloatType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.ByteType | T.ShortType | T.IntegerType):
            c = c.cast("long")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, T.TimestampType | T.TimestampNTZType):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        out.append(c.alias(f.name))
    return df.select(*out)
