"""The stored star schema that checks and reports read."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from mercastar.plans import star
from mercastar.plans.staging import build_staging
from mercastar.schemas import STAGING, WAREHOUSE
from mercastar.sources.sinks import read_parquet, write_parquet, write_table
from mercastar.sources.versions import current, loading
from mercastar.storage import delete_folder

# Tables of one bucket count on customer_key join without a shuffle.
BUCKETED = ("dim_customer", "fact_orders")
MONTH = "purchase_month"
# Rows of the fact in a file: some 100 MB.
FILE_ROWS = 1 << 22
# Items that are loaded into the fact at once: some 4 GB of shuffles.
PASS_ROWS = 1 << 25
# Columns of the fact that differ between the items of an order.
ITEM_COLUMNS = (
    "order_item_id",
    "product_key",
    "seller_key",
    "seller_region_key",
    "price",
    "freight_value",
    "total_revenue",
)


def _slices(rows: int, days: int) -> int:
    """Slices of a month's orders, so that one of an average month fills a file."""
    return -(-rows // (FILE_ROWS * max(1, days // 30))) or 1


def _passes(rows: int) -> int:
    """Passes that load so many items."""
    return -(-rows // PASS_ROWS) or 1


def _of_pass(df: DataFrame, number: int, passes: int) -> DataFrame:
    """Rows of the orders of one pass.

    The seed makes passes independent of slices and of shuffle partitions.
    """
    place = F.pmod(F.xxhash64(F.lit(PASS_ROWS), "order_id"), F.lit(passes))
    return df.where(place == number) if passes > 1 else df


def _laid_out(fact: DataFrame, slices: int) -> DataFrame:
    """Rows of the fact as they are to lie in files.

    There is a folder for each month of purchase, so that a bound on the purchase date
    skips folders. A month is dealt to tasks whole, or in slices of its orders where it is
    large, so files are few and even; rebalancing splits a slice too large for one task.
    Inside, rows are sorted by day, so that least and greatest values of parts of a file
    prune too, and items of an order lie together, which lets distinct orders collapse
    before a shuffle. The shuffle has the columns of an order side by side, since those
    repeat from item to item and are compressed as one.
    """
    dealt = fact.withColumn("_slice", F.pmod(F.xxhash64("order_id"), F.lit(slices)))
    own = [c for c in dealt.columns if c not in ITEM_COLUMNS]
    return (
        dealt.select(*own, *ITEM_COLUMNS)
        .hint("rebalance", MONTH, "_slice")
        .sortWithinPartitions(MONTH, "purchase_time_key", "order_id")
        .select(*fact.columns)
    )


def _month() -> Column:
    return F.expr("purchase_time_key DIV 100").cast("int")


def _fact(parts: Mapping[str, DataFrame]) -> DataFrame:
    return star.fact_orders(parts).withColumn(MONTH, _month())


def _stored_schema(name: str) -> StructType:
    extra = [StructField(MONTH, IntegerType())] if name == "fact_orders" else []
    return StructType([*WAREHOUSE[name].fields, *extra])


class Warehouse:
    """Six tables, each built at first use.

    With a folder, a table is written there once and read from there on, so the
    cost of keys and joins is paid once and not per report; dimensions are stored
    before the fact that needs them. Without a folder, tables stay lazy plans.

    Customers, products and sellers come from their staging tables, so that their
    copies are dropped once; orders and items are taken as they are.
    """

    def __init__(
        self,
        sources: Mapping[str, DataFrame],
        region: DataFrame | None = None,
        folder: str | None = None,
        staging: Mapping[str, DataFrame] | None = None,
    ):
        self.sources = sources
        self._staging = dict(staging or {})
        self._derived: dict[str, DataFrame] = {}
        self._opened = False  # opened tables are read only
        self.region = region
        self.folder = folder.rstrip("/") if folder else None
        self._tables: dict[str, DataFrame] = {}

    @classmethod
    def stored(cls, spark: SparkSession, folder: str) -> Warehouse:
        """Open the tables in `folder`, or in the version published there."""
        warehouse = cls({}, folder=current(spark, folder))
        warehouse._opened = True
        for name in WAREHOUSE:
            warehouse._tables[name] = read_parquet(
                spark, f"{warehouse.folder}/{name}", _stored_schema(name)
            )
        return warehouse

    @classmethod
    def catalog(cls, spark: SparkSession, database: str) -> Warehouse:
        """Open tables that `save_to_catalog` wrote."""
        warehouse = cls({})
        for name in WAREHOUSE:
            warehouse._tables[name] = spark.table(f"{database}.{name}")
        return warehouse

    def table(self, name: str) -> DataFrame:
        """A table with the columns of its schema."""
        return self._table(name).select(*WAREHOUSE[name].names)

    def _table(self, name: str) -> DataFrame:
        if name not in self._tables:
            if not self.folder:
                df = self._plan(name)
            else:
                path = f"{self.folder}/{name}"
                if name == "fact_orders":
                    spark = self._write_fact(path)
                else:
                    df = self._plan(name)
                    spark = df.sparkSession
                    write_parquet(df, path)
                df = read_parquet(spark, path, _stored_schema(name))
            self._tables[name] = df
        return self._tables[name]

    def _plan(self, name: str) -> DataFrame:
        s = self.sources
        plans: dict[str, Callable[[], DataFrame]] = {
            "dim_time": lambda: star.dim_time(s["orders"]),
            "dim_region": lambda: (
                star.dim_region(s["orders"].sparkSession) if self.region is None else self.region
            ),
            "dim_customer": lambda: star.dim_customer(self._unique("stg_customers")),
            "dim_product": lambda: star.dim_product(self._unique("stg_products")),
            "dim_seller": lambda: star.dim_seller(self._unique("stg_sellers")),
            "fact_orders": lambda: _fact(self._fact_parts()),
        }
        return plans[name]()

    def _fact_parts(self) -> dict[str, DataFrame]:
        return star.fact_parts(
            self.sources, self.customer, self.product, self.seller, self.dim_region
        )

    def _write_fact(self, path: str) -> SparkSession:
        """Write the fact in passes over its orders.

        The shuffles of a pass are deleted before the next one, so that the disk holds
        those of PASS_ROWS items at a time, however many there are. Orders with their
        customers are stored for it, as they are not dealt by order before they met them.
        """
        parts = self._fact_parts()
        spark = parts["orders"].sparkSession
        rows = self.sources["order_items"].count()
        passes = _passes(rows)
        slices = _slices(-(-rows // passes), self.time.count())
        placed = f"{self.folder}/placed_orders"
        if passes > 1:
            write_parquet(parts["orders"], placed)
            parts["orders"] = read_parquet(spark, placed, parts["orders"].schema)
        for number in range(passes):
            taken = {name: _of_pass(df, number, passes) for name, df in parts.items()}
            write_parquet(_laid_out(_fact(taken), slices), path, MONTH, add=number > 0)
        if passes > 1:
            delete_folder(spark, placed)
        return spark

    def _unique(self, name: str) -> DataFrame:
        """A staging table, which has one row per key: given, or built and stored here."""
        if name not in self._staging:
            df = build_staging(self.sources)[name]
            if self.folder:
                path = f"{self.folder}/unique/{name}"
                write_parquet(df, path)
                df = read_parquet(df.sparkSession, path, STAGING[name])
            self._staging[name] = df
        return self._staging[name]

    def derived(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A table that several reports derive from the star schema, built at first use."""
        if name not in self._derived:
            df = build()
            if self.folder and not self._opened:
                path = f"{self.folder}/derived/{name}"
                write_parquet(df, path)
                df = read_parquet(df.sparkSession, path, df.schema)
            self._derived[name] = df
        return self._derived[name]

    def load(self) -> dict[str, DataFrame]:
        """All tables, dimensions first."""
        return {name: self.table(name) for name in WAREHOUSE}

    def create_views(self) -> None:
        """Name the tables for SQL: `spark.sql("SELECT ... FROM fact_orders")`."""
        for name, df in self.load().items():
            df.createOrReplaceTempView(name)

    def save_to_catalog(self, database: str, buckets: int = 0) -> None:
        """Replace the catalog tables.

        With `buckets`, the fact and its largest dimension are bucketed on their
        common key. A bucket is read by one task, so leave it out where a single
        customer may hold a large share of the fact: then the shuffled join, which
        splits skewed keys, is the better plan.
        """
        for name, df in self.load().items():
            key = "customer_key" if buckets and name in BUCKETED else None
            write_table(df, f"{database}.{name}", key, buckets)

    @property
    def fact(self) -> DataFrame:
        """The fact with the month of purchase, as yyyymm."""
        df = self._table("fact_orders")
        return df if MONTH in df.columns else df.withColumn(MONTH, _month())

    @property
    def time(self) -> DataFrame:
        return self.table("dim_time")

    @property
    def customer(self) -> DataFrame:
        return self.table("dim_customer")

    @property
    def product(self) -> DataFrame:
        return self.table("dim_product")

    @property
    def seller(self) -> DataFrame:
        return self.table("dim_seller")

    @property
    def dim_region(self) -> DataFrame:
        return self.table("dim_region")


def load_warehouse(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    folder: str,
    region: DataFrame | None = None,
    staging: Mapping[str, DataFrame] | None = None,
) -> Warehouse:
    """Load a new version of the star schema, published when all six tables are written.

    Until then, and if the load fails, `Warehouse.stored` opens the version before.
    """
    with loading(spark, folder) as version:
        warehouse = Warehouse(sources, region, version, staging)
        warehouse.load()
    return warehouse


def build_star(
    sources: Mapping[str, DataFrame], region: DataFrame | None = None
) -> dict[str, DataFrame]:
    """All six tables as lazy plans. `region` replaces the fixed state table."""
    return Warehouse(sources, region).load()
