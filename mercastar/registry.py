"""Named queries over a folder of test tables."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DateType,
    DecimalType,
    FloatType,
    IntegralType,
    TimestampNTZType,
    TimestampType,
)

from mercastar.fixed_values import MISSING_TOKENS, SAMPLE_FRACTION, SAMPLE_SEED
from mercastar.functions.text import blank_missing, title_case
from mercastar.functions.time import as_timestamp, timestamp_text
from mercastar.operators import profiling
from mercastar.operators.ranking import global_ntile
from mercastar.operators.sampling import exact_sample
from mercastar.plans import quality, star
from mercastar.plans.reports import REPORTS
from mercastar.plans.staging import STAGED_SOURCES, build_staging, load_staging
from mercastar.plans.warehouse import Warehouse, load_warehouse
from mercastar.schemas import AUDIT_COLUMN, SOURCES, WAREHOUSE
from mercastar.sources import testdata
from mercastar.sources.csv_files import read_csv, read_source
from mercastar.sources.sinks import described, fill_tables, row_counts
from mercastar.storage import workspace

Query = Callable[[SparkSession, str], DataFrame]


@dataclass
class Opened:
    """What is kept for one folder: its sources and star schema."""

    sources: Mapping[str, DataFrame]
    warehouse: Warehouse


_open: dict[tuple[str, str], Opened] = {}


def opened(spark: SparkSession, folder: str) -> Opened:
    """Sources and star schema of a folder, kept for the application until `refresh`."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _open:
        sources = testdata.sources(spark, folder)
        place = f"{_place(spark, folder)}/warehouse"
        _open[key] = Opened(sources, Warehouse(sources, testdata.regions(spark, folder), place))
    return _open[key]


def refresh(spark: SparkSession, folder: str) -> None:
    """Forget what is kept for a folder whose tables have changed."""
    _open.pop((spark.sparkContext.applicationId, folder), None)


def _place(spark: SparkSession, folder: str) -> str:
    """One fixed place for what is stored for a folder, so that loads replace each other."""
    return f"{workspace(spark)}/{hashlib.md5(folder.encode()).hexdigest()}"


def warehouse(spark: SparkSession, folder: str) -> Warehouse:
    return opened(spark, folder).warehouse


def presentable(df: DataFrame) -> DataFrame:
    """Plain result types: whole numbers as BIGINT, decimals as DOUBLE, moments as text."""
    columns = []
    for field in df.schema:
        name, kind = f"`{field.name}`", field.dataType
        if isinstance(kind, (IntegralType, BooleanType)):
            value = f"CAST({name} AS BIGINT)"
        elif isinstance(kind, (DecimalType, FloatType)):
            value = f"CAST({name} AS DOUBLE)"
        elif isinstance(kind, DateType):
            value = f"CAST({name} AS STRING)"
        elif isinstance(kind, (TimestampType, TimestampNTZType)):
            value = f"date_format({name}, 'yyyy-MM-dd HH:mm:ss')"
        else:
            value = name
        columns.append(f"{value} AS {name}")
    return df.selectExpr(*columns)


def _table(name: str) -> Query:
    return lambda spark, folder: warehouse(spark, folder).table(name)


def _report(name: str) -> Query:
    return lambda spark, folder: REPORTS[name](warehouse(spark, folder), testdata.PARAMETERS)


def _staged(name: str) -> Query:
    return lambda spark, folder: build_staging(opened(spark, folder).sources)[name].drop(
        AUDIT_COLUMN
    )


def _profile(build: Callable[[Mapping[str, DataFrame]], DataFrame]) -> Query:
    return lambda spark, folder: build(opened(spark, folder).sources)


def _load_staging(spark: SparkSession, folder: str) -> DataFrame:
    place = f"{_place(spark, folder)}/staging"
    return row_counts(load_staging(spark, opened(spark, folder).sources, place))


def _load_warehouse(spark: SparkSession, folder: str) -> DataFrame:
    sources = opened(spark, folder).sources
    place = f"{_place(spark, folder)}/reloaded"
    loaded = load_warehouse(spark, sources, place, testdata.regions(spark, folder))
    return row_counts(loaded.load())


def _in_catalog(spark: SparkSession, folder: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Tables made by their DDL and filled, as the catalog describes them."""
    place = f"{_place(spark, folder)}/catalog"
    prefix = f"made_{hashlib.md5(folder.encode()).hexdigest()}_"
    return described(fill_tables(spark, tables, place, prefix))


def _create_staging(spark: SparkSession, folder: str) -> DataFrame:
    return _in_catalog(spark, folder, build_staging(opened(spark, folder).sources))


def _create_warehouse(spark: SparkSession, folder: str) -> DataFrame:
    here = warehouse(spark, folder)
    return _in_catalog(spark, folder, {name: here.table(name) for name in WAREHOUSE})


def _warnings(spark: SparkSession, folder: str) -> DataFrame:
    """Warnings about the sources when no order has the asked status, so that orders are empty."""
    sources = dict(opened(spark, folder).sources.items())
    sources["orders"] = sources["orders"].where("order_status = 'lost'")
    found = [(text,) for text in profiling.validate_all(sources)]  # a few for each source
    return spark.createDataFrame(found, "warning string")


def _table_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    return row_counts(warehouse(spark, folder).load())


def _star_summary(spark: SparkSession, folder: str) -> DataFrame:
    return star.star_summary(warehouse(spark, folder).load())


def _fact_summary(spark: SparkSession, folder: str) -> DataFrame:
    return star.fact_summary(warehouse(spark, folder).fact)


def _sample(spark: SparkSession, folder: str) -> DataFrame:
    """An exact, repeatable fifth of the locations."""
    return exact_sample(opened(spark, folder).sources["geolocation"], SAMPLE_FRACTION, SAMPLE_SEED)


def _state_table(spark: SparkSession, folder: str) -> DataFrame:
    """The fixed state table with orders dealt over its 27 rows."""
    states = star.dim_region(spark)
    orders = spark.read.parquet(f"{folder}/orders.parquet").select(
        (F.col("o_orderkey") % 27 + 1).cast("int").alias("region_key")
    )
    dealt = orders.groupBy("region_key").agg(F.count(F.lit(1)).alias("orders"))
    return states.join(dealt, "region_key", "left").select(
        *states.columns, F.coalesce("orders", F.lit(0)).alias("orders")
    )


def _write_csv(df: DataFrame, place: str) -> None:
    """Rows as CSV files of two kinds: the second orders its columns differently and has one more."""
    second = F.pmod(F.xxhash64(df.columns[0]), F.lit(2)) == 1
    kinds = {
        "first": df.where(~second),
        "second": df.where(second).select(F.lit("x").alias("more"), *reversed(df.columns)),
    }
    for name, part in kinds.items():
        (
            part.write.mode("overwrite")
            .option("header", True)
            .option("quote", '"')
            .option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .csv(f"{place}/{name}")
        )


def _csv_source(key: str) -> Query:
    """A source written to CSV files with differing headers and read again."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        place = f"{_place(spark, folder)}/csv_{key}"
        _write_csv(opened(spark, folder).sources[key], place)
        return read_source(spark, f"{place}/*/*.csv", key)

    return query


def _csv_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Whole texts, with quotes and line breaks, through CSV files and back."""
    place = f"{_place(spark, folder)}/csv_documents"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    _write_csv(docs, place)
    return read_csv(spark, f"{place}/*/*.csv", docs.schema, multiline=True)


def _coerce_timestamps(spark: SparkSession, folder: str) -> DataFrame:
    """Order dates as text, some of it unreadable, back to timestamps."""
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    key, day = F.col("o_orderkey"), timestamp_text(F.col("o_orderdate"))
    text = (
        F.when(key % 13 == 0, F.concat(F.lit("about "), day))
        .when(key % 7 == 0, F.substring(day, 1, 10))
        .when(key % 5 == 0, F.col("o_orderpriority"))
        .otherwise(day)
    )
    return orders.select("o_orderkey", text.alias("raw_text")).withColumn(
        "moment", as_timestamp(F.col("raw_text"))
    )


def _normalize_missing(spark: SparkSession, folder: str) -> DataFrame:
    """Market segments, some replaced by a missing-value text, back to NULL."""
    customer = spark.read.parquet(f"{folder}/customer.parquet")
    tokens = F.array(*[F.lit(t) for t in MISSING_TOKENS])
    place = (F.col("c_custkey") % 40).cast("int")
    text = F.when(place < len(MISSING_TOKENS), F.get(tokens, place)).otherwise(
        F.col("c_mktsegment")
    )
    return customer.select("c_custkey", text.alias("raw_segment")).selectExpr(
        "c_custkey", f"{blank_missing('raw_segment')} AS segment"
    )


def _title_case(spark: SparkSession, folder: str) -> DataFrame:
    cities = opened(spark, folder).sources["customers"].select("customer_city").distinct()
    return cities.withColumn("clean_city", title_case(F.col("customer_city")))


def _balance_tiles(spark: SparkSession, folder: str) -> DataFrame:
    """Customers in five tiles by balance, poorest first and richest first."""
    customer = spark.read.parquet(f"{folder}/customer.parquet").select("c_custkey", "c_acctbal")
    scores = {"poor_tile": ("c_acctbal", True), "rich_tile": ("c_acctbal", False)}
    return global_ntile(customer, "c_custkey", scores, 5).select(
        "c_custkey", "poor_tile", "rich_tile"
    )


def _quality(check: Callable[..., DataFrame]) -> Query:
    return lambda spark, folder: check(warehouse(spark, folder))


def _quality_with(check: Callable[..., DataFrame]) -> Query:
    return lambda spark, folder: check(warehouse(spark, folder), testdata.PARAMETERS)


def _staging_consistency(spark: SparkSession, folder: str) -> DataFrame:
    staging = build_staging(opened(spark, folder).sources)
    return quality.check_staging(warehouse(spark, folder), staging, testdata.PARAMETERS)


def _quality_report(spark: SparkSession, folder: str) -> DataFrame:
    staging = build_staging(opened(spark, folder).sources)
    return quality.run_checks(warehouse(spark, folder), staging, testdata.PARAMETERS)


def _quality_verdict(spark: SparkSession, folder: str) -> DataFrame:
    return quality.verdict(_quality_report(spark, folder))


def _plain() -> dict[str, Query]:
    out: dict[str, Query] = {name: _table(name) for name in WAREHOUSE}
    out |= {name: _staged(name) for name in STAGED_SOURCES}
    out |= {
        "coerce_timestamps": _coerce_timestamps,
        "normalize_missing": _normalize_missing,
        "title_case": _title_case,
        "sample_hash": _sample,
        "state_table": _state_table,
        "csv_documents": _csv_documents,
        "global_ntile": _balance_tiles,
        "load_staging": _load_staging,
        "load_warehouse": _load_warehouse,
        "create_staging": _create_staging,
        "create_warehouse": _create_warehouse,
        "validate_warnings": _warnings,
        "table_row_counts": _table_row_counts,
        "star_schema_summary": _star_summary,
        "fact_summary": _fact_summary,
        "profile_columns": _profile(profiling.profile_all_columns),
        "profile_tables": _profile(profiling.profile_all_tables),
        "validate_primary_keys": _profile(profiling.primary_key_duplicates),
        "validate_non_negative": _profile(profiling.negative_values),
        "validate_score_range": _profile(profiling.scores_out_of_range),
        "dq_row_counts": _quality_with(quality.check_row_counts),
        "dq_staging_consistency": _staging_consistency,
        "dq_null_checks": _quality(quality.check_nulls),
        "dq_referential_integrity": _quality(quality.check_references),
        "dq_business_rules": _quality_with(quality.check_business_rules),
        "dq_distribution": _quality(quality.distribution),
        "dq_top_categories": _quality(quality.top_categories),
        "dq_status_mix": _quality(quality.status_mix),
        "dq_fact_unique": _quality(quality.fact_duplicates),
        "dq_report": _quality_report,
        "dq_verdict": _quality_verdict,
    }
    out |= {f"csv_{key}": _csv_source(key) for key in SOURCES}
    out |= {name: _report(name) for name in REPORTS}
    return out


def _presented(query: Query) -> Query:
    return lambda spark, folder: presentable(query(spark, folder))


QUERIES: dict[str, Query] = {name: _presented(query) for name, query in _plain().items()}
