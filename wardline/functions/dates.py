from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_date(c: Column) -> Column:
    """``yyyy-MM-dd``, else ``dd/MM/yyyy``, else NULL.

    The layout is told apart by its separators, so only one cast runs per row and no parser
    exception is raised and caught for the second layout.
    """
    iso = (F.length(c) == 10) & (F.substring(c, 5, 1) == "-") & (F.substring(c, 8, 1) == "-")
    day_first = (F.length(c) == 10) & (F.substring(c, 3, 1) == "/") & (F.substring(c, 6, 1) == "/")
    turned = F.concat_ws("-", F.substring(c, 7, 4), F.substring(c, 4, 2), F.substring(c, 1, 2))
    return F.when(iso, c).when(day_first, turned).try_cast("date")


def add_days(d: Column, n: Column) -> Column:
    return F.date_add(d, n)


def day_gap(start: Column, end: Column) -> Column:
    """Days from ``start`` to ``end``; Spark's ``datediff`` takes the end first."""
    return F.datediff(end, start)


def day_of_week(d: Column) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return F.dayofweek(d) - 1


def is_weekend(d: Column) -> Column:
    return day_of_week(d).isin(0, 6)


def millis_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSS")


def stamp_text(ts: Column) -> Column:
    """Folder stamp, one per run."""
    return F.date_format(ts, "yyyyMMdd_HHmmss")
