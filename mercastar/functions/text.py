"""Text cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mercastar.fixed_values import MISSING_TOKENS

BLANKS = " \t\n\r\x0b\x0c"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def title_case(text: Column) -> Column:
    """Upper-case the first letter of every run of letters, lower-case the rest.

    `initcap` alone only starts words at blanks, so it misses `D'Oeste`.
    """
    runs = F.regexp_extract_all(F.lower(strip(text)), F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def state_code(text: Column) -> Column:
    return F.upper(strip(text))


def blank_missing(expression: str) -> str:
    """SQL that gives NULL for every text that stands for a missing value."""
    tokens = ", ".join(f"'{token}'" for token in MISSING_TOKENS)
    return f"CASE WHEN {expression} NOT IN ({tokens}) THEN {expression} END"


def thousands(number: Column) -> Column:
    """Whole number with separators, rounded half up."""
    return F.format_number(F.round(number, 0), 0)


def fixed_point(number: Column, scale: int) -> Column:
    """Text with exactly `scale` decimals, as in `4.10`."""
    return F.round(number, scale).cast(f"decimal(20,{scale})").cast("string")
