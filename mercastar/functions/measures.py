"""Aggregates and rounding used by the reports.

Money is decimal and quotients are exact decimals rounded half up, so a result
does not depend on how rows are spread over tasks.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

WIDE = "decimal(20,2)"


def quotient(numerator: Column, denominator: Column) -> Column:
    """Exact decimal quotient; NULL where the denominator is zero."""
    return numerator.cast(WIDE) / F.nullif(denominator.cast(WIDE), F.lit(0).cast(WIDE))


def rounded(numerator: Column, denominator: Column, scale: int) -> Column:
    return F.round(quotient(numerator, denominator), scale)


def exact(number: float) -> Column:
    """A threshold as a decimal literal, compared without binary rounding."""
    return F.lit(Decimal(str(number)))


def items() -> Column:
    return F.count(F.lit(1))


def mean(column: str | Column, scale: int) -> Column:
    values = F.col(column) if isinstance(column, str) else column
    return rounded(F.sum(values), F.count(values), scale)


def tally(condition: Column) -> Column:
    """Rows where the condition holds; 0 when there are rows but no match."""
    return F.sum(F.when(condition, 1).otherwise(0))


def percent_of_rows(condition: Column, scale: int = 1) -> Column:
    """Share of all rows, those with an unknown condition included."""
    return rounded(F.lit(100) * tally(condition), items(), scale)


def share_of_all(value: Column, scale: int = 1) -> Column:
    """Percent of the column total. Use it on grouped rows only."""
    return rounded(F.lit(100) * value, F.sum(value).over(Window.partitionBy()), scale)


def growth(current: Column, previous: Column, scale: int = 1) -> Column:
    return rounded(F.lit(100) * (current - previous), previous, scale)


def band_label(value: Column, bands: tuple, inclusive: bool = True) -> Column:
    """Label of the first band whose bound holds the value."""
    return _band(value, [(bound, label) for bound, label in bands], inclusive)


def band_number(value: Column, bands: tuple, inclusive: bool = True) -> Column:
    return _band(value, [(bound, n) for n, (bound, _) in enumerate(bands, 1)], inclusive)


def _band(value: Column, pairs: list, inclusive: bool) -> Column:
    *bounded, (_, rest) = pairs
    out = None
    for bound, result in bounded:
        holds = value <= bound if inclusive else value < bound
        out = F.when(holds, result) if out is None else out.when(holds, result)
    return out.otherwise(rest)


def label_of(value: Column, labels: tuple, default: str | None = None) -> Column:
    out = None
    for key, label in labels:
        out = F.when(value == key, label) if out is None else out.when(value == key, label)
    return out if default is None else out.otherwise(default)
