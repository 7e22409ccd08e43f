"""Table sinks. Every load replaces the table, so it can be repeated."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from mercastar.schemas import create_table_ddl

JDBC_BATCH = 5000
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Delete the shuffle files of what runs in the block as soon as it ends.

    Otherwise they stay until the driver happens to collect garbage, and those of one
    table lie beside those of the next.
    """
    before = spark.conf.get(DROP_SHUFFLES)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(DROP_SHUFFLES, before)


def write_parquet(
    df: DataFrame, path: str, folders_by: str | None = None, add: bool = False
) -> None:
    """Replace the table at `path`, or add rows to it.

    `folders_by` makes a folder for each value of a column.
    """
    writer = df.write.mode("append" if add else "overwrite")
    with shuffles_dropped(df.sparkSession):
        (writer.partitionBy(folders_by) if folders_by else writer).parquet(path)


def read_parquet(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def write_table(df: DataFrame, name: str, bucket_by: str | None = None, buckets: int = 0) -> None:
    """Replace a catalog table.

    With `bucket_by`, tables bucketed alike on their join key join without a
    shuffle. Rows are spread by that key first, so that each bucket is one file.
    """
    if bucket_by:
        writer = df.repartition(buckets, bucket_by).write.bucketBy(buckets, bucket_by)
        writer = writer.sortBy(bucket_by)
    else:
        writer = df.write
    writer.format("parquet").mode("overwrite").saveAsTable(name)


def write_jdbc(df: DataFrame, url: str, table: str, **options: str) -> None:
    """Replace the rows of a database table in batches; its definition is kept."""
    (
        df.write.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("truncate", True)
        .option("batchsize", JDBC_BATCH)
        .options(**options)
        .mode("overwrite")
        .save()
    )


def fill_tables(
    spark: SparkSession, tables: Mapping[str, DataFrame], folder: str, prefix: str = ""
) -> dict[str, DataFrame]:
    """Create staging or warehouse tables by their DDL, files below `folder`, and fill them.

    Tables of those names are replaced in the catalog, and their rows by the new ones.
    Returns them as the catalog has them.
    """
    for name, df in tables.items():
        spark.sql(f"DROP TABLE IF EXISTS {prefix}{name}")
        spark.sql(create_table_ddl(name, f"{prefix}{name}", f"{folder.rstrip('/')}/{name}"))
        df.write.insertInto(f"{prefix}{name}", overwrite=True)
    return {name: spark.table(f"{prefix}{name}") for name in tables}


def described(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per column of the tables, with its place, type, rows and values that are not NULL.

    A table is scanned once for all of its columns.
    """
    parts = []
    for name, df in tables.items():
        counts = df.agg(
            F.count(F.lit(1)).alias("row_count"),
            F.array(
                *[
                    F.struct(
                        F.lit(place).alias("position"),
                        F.lit(field.name).alias("column_name"),
                        F.lit(field.dataType.simpleString()).alias("data_type"),
                        F.count(F.col(f"`{field.name}`")).alias("value_count"),
                    )
                    for place, field in enumerate(df.schema, 1)
                ]
            ).alias("columns"),
        )
        parts.append(counts.select(F.lit(name).alias("table_name"), "row_count", F.inline("columns")))
    return reduce(DataFrame.unionByName, parts)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row `(table_name, row_count)` per table."""
    counts = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        counts = one if counts is None else counts.unionByName(one)
    return counts
