from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pyarrow as pa
from mercastar.schemas import SOURCES
from pyspark.sql.pandas.types import to_arrow_schema


def ts(text: str | None) -> datetime | None:
    return datetime.fromisoformat(text) if text else None


def frame(spark, source: str, *rows: dict):
    """Rows of a source; columns left out are NULL."""
    schema = SOURCES[source]
    values = []
    for row in rows:
        unknown = set(row) - set(schema.names)
        assert not unknown, unknown
        record = []
        for field in schema:
            value = row.get(field.name)
            kind = field.dataType.typeName()
            if value is not None and kind == "decimal":
                value = Decimal(str(value))
            elif value is not None and kind == "timestamp_ntz":
                value = ts(value)
            elif value is not None and kind == "double":
                value = float(value)
            record.append(value)
        values.append(tuple(record))
    # From Arrow, the rows become a local relation instead of a scan of many tasks.
    columns = list(zip(*values, strict=True)) or [()] * len(schema)
    fields = to_arrow_schema(schema)
    arrays = [pa.array(c, type=f.type) for c, f in zip(columns, fields, strict=True)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=fields), schema)


def order(n: int = 1, **more) -> dict:
    base = {
        "order_id": f"o{n}",
        "customer_id": f"c{n}",
        "order_status": "delivered",
        "order_purchase_timestamp": "2018-01-01 10:00:00",
        "order_delivered_customer_date": "2018-01-08 09:00:00",
        "order_estimated_delivery_date": "2018-01-11 00:00:00",
    }
    return base | more


def item(n: int = 1, line: int = 1, **more) -> dict:
    base = {
        "order_id": f"o{n}",
        "order_item_id": line,
        "product_id": "p1",
        "seller_id": "s1",
        "price": 100,
        "freight_value": 10,
    }
    return base | more


def customer(n: int = 1, **more) -> dict:
    base = {
        "customer_id": f"c{n}",
        "customer_unique_id": f"u{n}",
        "customer_zip_code_prefix": "01310",
        "customer_city": "são paulo",
        "customer_state": "sp",
    }
    return base | more


def small_sources(spark, **tables: list[dict]) -> dict:
    """A complete set of sources; `tables` replaces the rows of some."""
    rows = {
        "orders": [order()],
        "order_items": [item()],
        "payments": [
            {
                "order_id": "o1",
                "payment_sequential": 1,
                "payment_type": "boleto",
                "payment_installments": 2,
                "payment_value": 110,
            }
        ],
        "reviews": [{"review_id": "r1", "order_id": "o1", "review_score": 4}],
        "customers": [customer()],
        "sellers": [{"seller_id": "s1", "seller_city": "rio", "seller_state": "RJ"}],
        "products": [{"product_id": "p1", "product_category_name": "livros"}],
        "geolocation": [],
        "translation": [
            {"product_category_name": "livros", "product_category_name_english": "books"}
        ],
    } | tables
    return {name: frame(spark, name, *rows[name]) for name in SOURCES}
