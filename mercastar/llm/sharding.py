"""Shards that each hold the mixture of the sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercastar.llm.columns import packed, unpacked
from mercastar.storage import durable

SHARDS = 16
SEED = 20240501

# Rows are ranked inside cells: 2**12 cells for each source, 2**16 for the whole order.
# The numbers bound the tables of cell sizes, not the rows in a cell.
SOURCE_CELL_DIGITS = 3
ORDER_CELLS = 1 << 16


def interleave(
    df: DataFrame, key: str, source: str, shards: int = SHARDS, seed: int = SEED
) -> DataFrame:
    """Put every row into one of `shards` shards by proportional stratified interleaving.

    Rows are shuffled within their source by the md5 of (seed, key). Row number r of
    a source of n rows gets the fraction (r - 0.5) / n. All rows are ordered by
    fraction, then md5, key and source, and the order is cut into `shards` runs whose
    lengths differ by one at most. Every run therefore holds each source in its
    share, to about one row per source.

    Adds `shard` (0 to shards - 1) and `slot` (from 0 without gaps in a shard);
    columns of those names in the input are replaced. NULL sources form a source of
    their own, NULL keys are shuffled together by the md5 of an empty key, repeated
    rows are separate rows, and an empty table gives no rows. Texts are not looked at.

    No sort runs in one task: a source is dealt over 4,096 cells by md5, the whole
    order over 65,536 cells by fraction, and rows are numbered in a cell and shifted
    by the sizes of the cells before it. A source that holds most rows is spread like
    all rows.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    as_text = F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))
    rows = packed(
        df,
        _source=F.col(f"`{source}`").cast("string"),
        _key=F.col(f"`{key}`"),
        _hash=F.md5(F.concat(F.lit(f"{seed}|"), as_text).cast("binary")),
    ).withColumn("_cell", F.substring("_hash", 1, SOURCE_CELL_DIGITS))

    # Sizes of the cells: at most 4,096 rows for a source, whatever its size.
    sizes = rows.groupBy("_source", "_cell").agg(F.count(F.lit(1)).alias("_size"))
    own = Window.partitionBy("_source")
    before = own.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        F.col("_source").alias("_s"),
        F.col("_cell").alias("_c"),
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"),
        F.sum("_size").over(own).alias("_total"),
    )
    inside = Window.partitionBy("_source", "_cell").orderBy("_hash", "_key")
    numbered = rows.withColumn("_n", F.row_number().over(inside))
    same = F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_cell") == F.col("_c"))
    fraction = (F.col("_start") + F.col("_n") - F.lit(0.5)) / F.col("_total")
    placed = durable(
        numbered.join(starts, same)
        .withColumn("_fraction", fraction)
        .withColumn("_place", F.floor(F.col("_fraction") * ORDER_CELLS).cast("int"))
        .select("_mx_row", "_source", "_key", "_hash", "_fraction", "_place")
    )

    cells = placed.groupBy("_place").agg(F.count(F.lit(1)).alias("_size"))
    through = Window.orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    # The windows without partitions see one row for each of at most ORDER_CELLS cells.
    edges = cells.select(
        F.col("_place").alias("_p"),
        F.coalesce(F.sum("_size").over(through), F.lit(0)).alias("_first"),
        F.sum("_size")
        .over(Window.orderBy("_place").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        .alias("_rows"),
    )
    line = Window.partitionBy("_place").orderBy("_fraction", "_hash", "_key", "_source")
    position = F.col("_first") + F.row_number().over(line) - 1
    ordered = placed.join(edges, F.col("_place") == F.col("_p")).withColumn("_at", position)
    # Shard s holds the positions from ceil(s * rows / shards) on.
    shard = F.expr(f"(_at * {shards}L) DIV _rows")
    first = F.expr(f"(_shard * _rows + {shards - 1}L) DIV {shards}L")
    ordered = ordered.withColumn("_shard", shard)
    return unpacked(
        ordered,
        df.columns,
        shard=F.col("_shard").cast("int"),
        slot=(F.col("_at") - first).cast("bigint"),
    )
