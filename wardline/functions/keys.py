from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: text hashed in place of NULL.
NULL_KEY_TEXT = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*parts: Column) -> Column:
    """Deterministic hash key, so facts carry dimension keys without looking them up.

    Timestamps must be passed as text (``dates.millis_text``) to fix their layout.
    """
    return F.md5(F.concat_ws("-", *[F.coalesce(p.cast("string"), F.lit(NULL_KEY_TEXT)) for p in parts]))
