from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def try_number(c: Column, number: str = "decimal(38,0)") -> Column:
    return c.try_cast(number)


def guarded_ratio(part: Column, whole: Column, allowed: Column, digits: int = 4) -> Column:
    """``part / whole`` where ``allowed`` and ``whole`` is positive, else NULL."""
    usable = allowed & (whole > 0)
    return F.when(usable, F.round(part / F.when(usable, whole), digits).cast(f"decimal(16,{digits})"))
