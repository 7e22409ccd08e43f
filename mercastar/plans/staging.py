"""Staging layer: the sources with dates and numbers coerced, one row per key."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercastar.fixed_values import UNKNOWN_CATEGORY
from mercastar.operators.dedup import first_per_key
from mercastar.schemas import AUDIT_COLUMN, PRIMARY_KEYS, PRODUCT_NUMBERS, STAGING, conform
from mercastar.sources.lazy import LazyTables
from mercastar.sources.sinks import read_parquet, write_parquet
from mercastar.sources.versions import current, loading

# Staging table per source; the translation is folded into the products.
STAGED_SOURCES = {
    "stg_orders": "orders",
    "stg_order_items": "order_items",
    "stg_order_payments": "payments",
    "stg_order_reviews": "reviews",
    "stg_customers": "customers",
    "stg_sellers": "sellers",
    "stg_products": "products",
    "stg_geolocation": "geolocation",
}


def whole_number(value: F.Column) -> F.Column:
    """Integer part, 0 for a missing or unreadable number."""
    return F.coalesce(value.try_cast("double"), F.lit(0.0)).cast("int")


def translated(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Products with an English category: the translation, else the own name."""
    names = first_per_key(translation, ["product_category_name"])
    own = F.coalesce(F.col("product_category_name"), F.lit(UNKNOWN_CATEGORY))
    return products.join(names, "product_category_name", "left").select(
        *[c for c in products.columns if c != "product_category_name"],
        own.alias("product_category_name"),
        F.coalesce("product_category_name_english", own).alias("product_category_name_english"),
    )


def staging_table(
    name: str, sources: Mapping[str, DataFrame], loaded_at: datetime
) -> DataFrame:
    source = STAGED_SOURCES[name]
    df = sources[source]
    if source in PRIMARY_KEYS:
        df = first_per_key(df, PRIMARY_KEYS[source])
    if source == "products":
        df = translated(df, sources["translation"])
        df = df.withColumns({c: whole_number(F.col(c)) for c in PRODUCT_NUMBERS})
    return conform(df.withColumn(AUDIT_COLUMN, F.lit(loaded_at)), STAGING[name])


def build_staging(
    sources: Mapping[str, DataFrame], loaded_at: datetime | None = None
) -> LazyTables:
    """All eight staging tables, lazily. One load time marks the whole run."""
    moment = loaded_at or datetime.now().replace(microsecond=0)

    def builder(name: str) -> Callable[[], DataFrame]:
        return lambda: staging_table(name, sources, moment)

    return LazyTables({name: builder(name) for name in STAGED_SOURCES})


def write_staging(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    folder: str,
    loaded_at: datetime | None = None,
) -> dict[str, DataFrame]:
    """Write the staging tables under `folder` and return them as stored."""
    for name, df in build_staging(sources, loaded_at).items():
        write_parquet(df, f"{folder.rstrip('/')}/{name}")
    return stored_staging(spark, folder)


def load_staging(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    folder: str,
    loaded_at: datetime | None = None,
) -> dict[str, DataFrame]:
    """Load a new version of the staging tables, published when all are written."""
    with loading(spark, folder) as version:
        return write_staging(spark, sources, version, loaded_at)


def stored_staging(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The staging tables in `folder`, or in the version published there."""
    place = current(spark, folder)
    return {name: read_parquet(spark, f"{place}/{name}", STAGING[name]) for name in STAGED_SOURCES}
