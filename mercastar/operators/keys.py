"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Hex digits of the bucket: 4 give at most 65,536 buckets, which one task may number and
# every task may hold.
BUCKET_DIGITS = 4
# Rows of a bucket, which are sorted together, before there are 16 times as many buckets.
BUCKET_ROWS = 1 << 18
MD5_DIGITS = 32


def bucket_digits(rows: int) -> int:
    """Digits of the bucket for a table of so many rows."""
    digits = BUCKET_DIGITS
    while rows > BUCKET_ROWS << 4 * digits and digits < MD5_DIGITS:
        digits += 1
    return digits


def _starts(sizes: DataFrame, digits: int) -> DataFrame:
    """`(_bucket, _start)`: rows in the buckets before each.

    Buckets of more than BUCKET_DIGITS digits are summed inside the bucket of their first
    digits, side by side, and shifted by the start of that one.
    """

    def before(*parts: str):
        window = Window.partitionBy(*parts).orderBy("_bucket")
        rows = F.sum("_size").over(window.rowsBetween(Window.unboundedPreceding, -1))
        return F.coalesce(rows, F.lit(0))

    if digits <= BUCKET_DIGITS:
        return sizes.select("_bucket", before().alias("_start"))
    outer = F.substring("_bucket", 1, BUCKET_DIGITS)
    totals = sizes.groupBy(outer.alias("_bucket")).agg(F.sum("_size").alias("_size"))
    shifts = totals.select(F.col("_bucket").alias("_outer"), before().alias("_shift"))
    inside = sizes.withColumn("_outer", outer).select("*", before("_outer").alias("_inside"))
    return inside.join(F.broadcast(shifts), "_outer").select(
        "_bucket", (F.col("_shift") + F.col("_inside")).alias("_start")
    )


def with_dense_key(
    df: DataFrame, natural_key: str, key: str, digits: int | None = None
) -> DataFrame:
    """Number the rows 1..N without gaps and without a global sort.

    `natural_key` must be unique. Rows are numbered by (first `digits` of its md5, natural
    key): each bucket is numbered on its own and shifted by the sizes of the buckets
    before it. Buckets are even whatever the keys look like. Without `digits`, the rows
    are counted, and buckets get a digit more each time they would grow past BUCKET_ROWS
    rows; keys are the same for the same digits. The starts of BUCKET_DIGITS digits are
    broadcast; those of more are joined, on the buckets by which the rows lie already.
    """
    digits = bucket_digits(df.count()) if digits is None else digits
    bucket = F.substring(F.md5(F.col(natural_key).cast("binary")), 1, digits)
    sizes = df.groupBy(bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_size"))
    starts = _starts(sizes, digits)
    inside = Window.partitionBy("_bucket").orderBy(natural_key)
    numbered = df.withColumn("_bucket", bucket).withColumn("_n", F.row_number().over(inside))
    starts = F.broadcast(starts) if digits <= BUCKET_DIGITS else starts.hint("merge")
    return numbered.join(starts, "_bucket").select(
        (F.col("_start") + F.col("_n")).cast("bigint").alias(key), *df.columns
    )
