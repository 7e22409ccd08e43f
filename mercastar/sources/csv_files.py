"""Raw CSV sources, read by header name into the declared types."""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DecimalType,
    IntegralType,
    NumericType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from mercastar.fixed_values import SAMPLE_SEED
from mercastar.functions.text import blank_missing
from mercastar.operators.sampling import exact_sample
from mercastar.schemas import SOURCES
from mercastar.sources.csv_records import first_lines, read_records

# File name patterns inside a source folder; override them with `files`.
FILES = {
    "orders": "*_orders_dataset.csv",
    "order_items": "*_order_items_dataset.csv",
    "payments": "*_order_payments_dataset.csv",
    "reviews": "*_order_reviews_dataset.csv",
    "customers": "*_customers_dataset.csv",
    "sellers": "*_sellers_dataset.csv",
    "products": "*_products_dataset.csv",
    "geolocation": "*_geolocation_dataset.csv",
    "translation": "*category_name_translation.csv",
}

# Free text may hold line breaks. Finding the records then takes a second look at the
# text, so only the source that needs it pays for it.
MULTILINE = ("reviews",)

# A pruned parser would not see how many fields a row has.
OPTIONS = {"mode": "FAILFAST", "columnPruning": "false", "encoding": "UTF-8", "quote": '"', "escape": '"'}


def _exact(text: str, target: str) -> str:
    """A number of the target type; a part that the type cannot hold is an error."""
    wide = f"CAST({text} AS DECIMAL(38,12))"
    return (
        f"CASE WHEN {wide} = CAST({wide} AS {target}) THEN CAST({wide} AS {target}) "
        f"WHEN {text} IS NOT NULL THEN raise_error(concat('no {target}: ', {text})) END"
    )


def _typed(column: str, target: DataType) -> str:
    text = blank_missing(f"`{column}`")
    name = target.simpleString()
    if isinstance(target, StringType):
        return text
    if isinstance(target, TimestampNTZType):
        return f"TRY_CAST({text} AS {name})"
    if isinstance(target, (IntegralType, DecimalType)):
        # Whole numbers may be written as 5 or 5.0, money with zeros at the end.
        return _exact(text, name)
    if isinstance(target, NumericType):
        return f"CAST({text} AS {name})"
    raise TypeError(f"no CSV reading for {name}")


def _headers(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """Files of a path, folder or pattern by their header."""
    found: dict[tuple[str, ...], list[str]] = {}
    for line, files in first_lines(spark, path).items():
        line = line.removeprefix("\ufeff").removesuffix("\r")
        if line:
            found.setdefault(tuple(next(csv.reader([line]))), []).extend(files)
    if not found:
        raise FileNotFoundError(f"no CSV file with a header at {path}")
    return found


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema)


def read_csv(spark: SparkSession, path: str, schema: StructType, multiline: bool) -> DataFrame:
    """Read CSV files by header name into `schema`.

    Files may order their columns differently and have extra ones, which are ignored;
    each group of files with one header is read on its own. A missing column is
    refused. A row with too few or too many fields, an unreadable number and a number
    that its type cannot hold exactly fail the job; an unreadable moment becomes NULL,
    as do the texts that mean "missing". With `multiline`, quoted fields may hold line
    breaks; such files are read in blocks by many tasks as well (see `csv_records`).
    """
    parts = []
    for header, files in _headers(spark, path).items():
        missing = [c for c in schema.names if c not in header]
        if missing:
            raise ValueError(f"{files[0]} lacks the columns {missing}")
        text = StructType([StructField(c, StringType()) for c in header])
        if multiline:
            records = read_records(spark, files)
            parsed = F.from_csv("text", _ddl(text), {**OPTIONS, "multiLine": "true"})
            raw = records.select(parsed.alias("r")).select("r.*")
        else:
            # enforceSchema has the parser compare the header, too.
            raw = spark.read.schema(text).option("header", True).option("enforceSchema", False)
            raw = raw.options(**OPTIONS).csv(files)
        parts.append(raw.selectExpr(*[f"{_typed(f.name, f.dataType)} AS `{f.name}`" for f in schema]))
    return reduce(DataFrame.unionByName, parts)


def read_source(spark: SparkSession, path: str, key: str) -> DataFrame:
    return read_csv(spark, path, SOURCES[key], key in MULTILINE)


def read_sources(
    spark: SparkSession,
    folder: str,
    files: dict[str, str] | None = None,
    sample_fraction: float | None = None,
) -> dict[str, DataFrame]:
    """Read all sources of a folder, whole unless a fraction of the locations is asked for."""
    names = FILES | (files or {})
    out = {key: read_source(spark, f"{folder.rstrip('/')}/{names[key]}", key) for key in SOURCES}
    if sample_fraction is not None:
        out["geolocation"] = exact_sample(out["geolocation"], sample_fraction, SAMPLE_SEED)
    return out
