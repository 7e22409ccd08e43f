"""Table contracts: raw sources, staging tables and warehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType


# Spark parses DDL text only inside a session; these names need none.
_TYPE_NAMES = {"int": "integer", "bigint": "long"}


def _schema(columns: str) -> StructType:
    """Schema from `name type` pairs, separated by a comma and a blank."""
    schema = StructType()
    for column in columns.split(", "):
        name, kind = column.split(" ")
        schema.add(name, _TYPE_NAMES.get(kind, kind))
    return schema


SOURCES: dict[str, StructType] = {
    "orders": _schema(
        "order_id string, customer_id string, order_status string, "
        "order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz, "
        "order_delivered_carrier_date timestamp_ntz, "
        "order_delivered_customer_date timestamp_ntz, "
        "order_estimated_delivery_date timestamp_ntz"
    ),
    "order_items": _schema(
        "order_id string, order_item_id int, product_id string, seller_id string, "
        "shipping_limit_date timestamp_ntz, price decimal(10,2), freight_value decimal(10,2)"
    ),
    "payments": _schema(
        "order_id string, payment_sequential int, payment_type string, "
        "payment_installments int, payment_value decimal(10,2)"
    ),
    "reviews": _schema(
        "review_id string, order_id string, review_score int, review_comment_title string, "
        "review_comment_message string, review_creation_date timestamp_ntz, "
        "review_answer_timestamp timestamp_ntz"
    ),
    "customers": _schema(
        "customer_id string, customer_unique_id string, customer_zip_code_prefix string, "
        "customer_city string, customer_state string"
    ),
    "sellers": _schema(
        "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string"
    ),
    "products": _schema(
        "product_id string, product_category_name string, product_name_lenght double, "
        "product_description_lenght double, product_photos_qty double, product_weight_g double, "
        "product_length_cm double, product_height_cm double, product_width_cm double"
    ),
    "geolocation": _schema(
        "geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double, "
        "geolocation_city string, geolocation_state string"
    ),
    "translation": _schema(
        "product_category_name string, product_category_name_english string"
    ),
}

# The translation lookup and the locations have no declared key.
PRIMARY_KEYS: dict[str, tuple[str, ...]] = {
    "orders": ("order_id",),
    "order_items": ("order_id", "order_item_id"),
    "payments": ("order_id", "payment_sequential"),
    "reviews": ("review_id",),
    "customers": ("customer_id",),
    "sellers": ("seller_id",),
    "products": ("product_id",),
}

AUDIT_COLUMN = "_etl_loaded_at"

PRODUCT_NUMBERS = (
    "product_name_lenght",
    "product_description_lenght",
    "product_photos_qty",
    "product_weight_g",
    "product_length_cm",
    "product_height_cm",
    "product_width_cm",
)


def _staged(source: str) -> StructType:
    return StructType(SOURCES[source].fields + _schema(f"{AUDIT_COLUMN} timestamp").fields)


STAGING: dict[str, StructType] = {
    "stg_orders": _staged("orders"),
    "stg_order_items": _staged("order_items"),
    "stg_order_payments": _staged("payments"),
    "stg_order_reviews": _staged("reviews"),
    "stg_customers": _staged("customers"),
    "stg_sellers": _staged("sellers"),
    "stg_products": _schema(
        "product_id string, product_category_name string, product_category_name_english string, "
        + ", ".join(f"{c} int" for c in PRODUCT_NUMBERS)
        + f", {AUDIT_COLUMN} timestamp"
    ),
    "stg_geolocation": _schema(
        "geolocation_zip_code_prefix string, geolocation_lat decimal(10,6), "
        "geolocation_lng decimal(10,6), geolocation_city string, geolocation_state string, "
        f"{AUDIT_COLUMN} timestamp"
    ),
}

# Surrogate keys are BIGINT: an INT runs out at two billion orders.
WAREHOUSE: dict[str, StructType] = {
    "dim_time": _schema(
        "time_key int, full_date date, year int, quarter int, month int, month_name string, "
        "week_of_year int, day_of_month int, day_of_week int, day_name string, is_weekend boolean"
    ),
    "dim_region": _schema(
        "region_key int, state_code string, state_name string, macro_region string"
    ),
    "dim_customer": _schema(
        "customer_key bigint, customer_id string, customer_unique_id string, "
        "customer_zip_code_prefix string, customer_city string, customer_state string"
    ),
    "dim_product": _schema(
        "product_key bigint, product_id string, product_category_name string, "
        "product_category_name_english string, product_weight_g int, product_length_cm int, "
        "product_height_cm int, product_width_cm int"
    ),
    "dim_seller": _schema(
        "seller_key bigint, seller_id string, seller_zip_code_prefix string, "
        "seller_city string, seller_state string"
    ),
    "fact_orders": _schema(
        "order_id string, order_item_id int, customer_key bigint, product_key bigint, "
        "seller_key bigint, purchase_time_key int, delivery_time_key int, "
        "customer_region_key int, seller_region_key int, price decimal(10,2), "
        "freight_value decimal(10,2), total_revenue decimal(11,2), payment_value decimal(20,2), "
        "payment_installments int, review_score int, delivery_days int, "
        "estimated_delivery_days int, delay_days int, is_on_time boolean, "
        "order_status string, payment_type string"
    ),
}


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select a schema's columns by name, in its order and types."""
    return df.selectExpr(
        *[f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema]
    )


def create_table_ddl(table: str, name: str | None = None, location: str | None = None) -> str:
    """`CREATE TABLE` text for a staging or warehouse table, stored as Parquet.

    With a location its files lie there and outlive the table; a quote in it is refused.
    """
    schema = (STAGING | WAREHOUSE)[table]
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
    if location is not None and ("'" in location or "\\" in location):
        raise ValueError(f"no location for a table: {location}")
    place = f" LOCATION '{location}'" if location is not None else ""
    return f"CREATE TABLE IF NOT EXISTS {name or table} ({columns}) USING parquet{place}"
