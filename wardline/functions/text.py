from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cell texts read as NULL, and the terminal colour code pattern.
NULL_TOKENS = ("", "NULL")
COLOUR_CODE = r"\x1b\[[0-9;]*m"


def clean_code(c: Column) -> Column:
    """Codes are compared upper-cased and without outer blanks."""
    return F.upper(F.trim(c))


def blank_to_null(c: Column) -> Column:
    trimmed = F.trim(c)
    return F.when(~trimmed.isin(*NULL_TOKENS), trimmed)


def header_name(c: Column) -> Column:
    return F.lower(F.trim(c))


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def without_quotes(c: Column) -> Column:
    return F.replace(c, F.lit("'"), F.lit(""))


def doubled_quotes(c: Column) -> Column:
    return F.replace(c, F.lit("'"), F.lit("''"))


def without_colours(c: Column) -> Column:
    return F.regexp_replace(c, COLOUR_CODE, "")


def percent_text(count: Column, total: Column) -> Column:
    """``12.3%`` with half-even rounding on the exact quotient; 0 rows give ``0.0%``."""
    exact = count.cast("decimal(20,0)") * F.lit(100) / F.nullif(total, F.lit(0)).cast("decimal(20,0)")
    shown = F.bround(F.coalesce(exact, F.lit(0)), 1).cast("decimal(5,1)").cast("string")
    return F.concat(shown, F.lit("%"))


def quoted_list(names: Column) -> Column:
    """``['a', 'b']``"""
    return F.concat(F.lit("['"), F.array_join(names, "', '"), F.lit("']"))
