"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None
) -> DataFrame:
    """Keep the first row of every key.

    A distributed table has no file order, so "first" is the least row by
    `order`, then by the remaining columns, NULLs before values. This is a `min`
    over a struct: each task reduces its own copies before the shuffle, so a key
    that holds a large share of the rows does not land in one task as a whole.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(list(keys))
    ranked = list(order or [])
    ranked += [c for c in rest if c not in ranked]
    picked = df.groupBy(*keys).agg(F.min(F.struct(*ranked)).alias("_row"))
    return picked.select(*[c if c in keys else F.col(f"_row.{c}") for c in df.columns])


def duplicate_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row `(rows, duplicates)`; duplicates are rows beyond the first of a key."""
    copies = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return copies.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"),
    )
