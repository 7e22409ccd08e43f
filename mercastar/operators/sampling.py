"""Repeatable exact-size sample."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercastar.storage import durable

# Digits of the md5 that one histogram tells apart: at most 4,096 cells.
DIGITS, ALL_DIGITS = 3, 32
CHUNK = 100_000


def _histogram(keyed: DataFrame, prefix: str, weight: F.Column) -> dict[str, int]:
    """Rows by the digits that follow `prefix`; at most 16**DIGITS numbers reach the driver."""
    cell = F.substring("_digest", len(prefix) + 1, DIGITS)
    inside = keyed.where(F.col("_digest").startswith(prefix)) if prefix else keyed
    return {r["cell"]: r["n"] for r in inside.groupBy(cell.alias("cell")).agg(F.sum(weight).alias("n")).collect()}


def _cut(counts: dict[str, int], wanted: int) -> tuple[str, int]:
    """The cell in which the `wanted` least rows end, and how many of them it holds."""
    for cell in sorted(counts):
        if wanted <= counts[cell]:
            return cell, wanted
        wanted -= counts[cell]
    raise ValueError("fewer rows than wanted")


def exact_sample(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    """Sample exactly `round(fraction * rows)` rows, whatever the size of the table.

    The sample is the set of rows with the least md5 over (seed, row), so it repeats on
    the same data. A histogram over the first md5 digits finds the cell in which the
    sample ends; the digests of that cell, one in some thousand, are stored, and
    histograms over the next digits narrow it down to one digest. All rows before it
    are taken by a filter. Only if that digest belongs to copies of one row of which
    some are left out, they are written out anew. No data row is sorted or windowed.
    """
    as_text = [F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in df.columns]
    digest = F.md5(F.concat_ws("\u0001", F.lit(str(seed)), *as_text).cast("binary"))
    keyed = df.withColumn("_digest", digest)
    counts = _histogram(keyed, "", F.lit(1))
    rows = sum(counts.values())
    wanted = round(rows * fraction)
    if not 0 < wanted < rows:
        return df.limit(0) if wanted <= 0 else df
    last, rest = _cut(counts, wanted)
    if counts[last] > rest:
        cell = keyed.where(F.col("_digest").startswith(last)).groupBy("_digest").agg(F.count(F.lit(1)).alias("_n"))
        cell = durable(cell)
        copies = counts[last]
        while copies > rest and len(last) < ALL_DIGITS:
            counts = _histogram(cell, last, F.col("_n"))
            digits, rest = _cut(counts, rest)
            last, copies = last + digits, counts[digits]
    else:
        copies = rest
    below = F.col("_digest") < last
    if copies == rest:
        return keyed.where(below | F.col("_digest").startswith(last)).select(*df.columns)

    # Copies of one row, written out in chunks that can move to other tasks.
    one = keyed.where(F.col("_digest") == last).dropDuplicates(["_digest"])
    chunks = one.withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.lit((rest - 1) // CHUNK))))
    size = F.least(F.lit(CHUNK), F.lit(rest) - F.col("_chunk") * CHUNK).cast("int")
    edge = chunks.repartition("_digest", "_chunk").withColumn("_copy", F.explode(F.sequence(F.lit(1), size)))
    return keyed.where(below).select(*df.columns).unionByName(edge.select(*df.columns))
