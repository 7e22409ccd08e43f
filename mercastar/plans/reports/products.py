"""Product reports: categories, price bands, quality, growth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercastar import fixed_values as fixed
from mercastar.functions.measures import (
    band_label,
    band_number,
    growth,
    share_of_all,
    tally,
)
from mercastar.functions.time import month_label
from mercastar.plans.parameters import ReportParameters
from mercastar.plans.reports.scopes import (
    CATEGORY,
    bought_before,
    delivered,
    metrics,
    with_product,
    with_purchase_day,
)
from mercastar.plans.warehouse import Warehouse

UNNAMED = "Unknown"
UNNAMED_SERIES = "Other"
TREND_CATEGORIES = 5


# Product keys, which are dense, in one row of the lookup of categories.
BLOCK = 1 << 12
SET_BITS = 64


def _numbered_categories(w: Warehouse) -> DataFrame:
    """Categories, NULL among them, numbered from 0 as `_place`."""
    names = w.product.select(CATEGORY).distinct()
    place = F.row_number().over(Window.partitionBy().orderBy(CATEGORY)) - 1
    return names.select(CATEGORY, place.alias("_place"))


def _category_blocks(w: Warehouse) -> DataFrame:
    """`(_block, _places)`: places of the categories of BLOCK product keys in a row, -1 for no product.

    A product takes a few bytes here, so that the lookup is broadcast for far more products
    than their table; beyond, the fact is shuffled by block as it would be by product.
    """
    names = _numbered_categories(w).withColumnRenamed(CATEGORY, "_category")
    known = w.product.join(names, F.col(CATEGORY).eqNullSafe(F.col("_category"))).select(
        _block().alias("_block"), _slot().alias("_slot"), "_place"
    )
    slots = F.explode(F.sequence(F.lit(0), F.lit(BLOCK - 1))).alias("_slot")
    empty = known.select("_block").distinct().select("_block", slots, F.lit(-1).alias("_place"))
    filled = known.unionByName(empty).groupBy("_block", "_slot").agg(F.max("_place").alias("_place"))
    places = F.array_sort(F.collect_list(F.struct("_slot", "_place")))["_place"]
    return filled.groupBy("_block").agg(places.alias("_places"))


def _slot() -> Column:
    return F.pmod("product_key", F.lit(BLOCK)).cast("int")


def _block() -> Column:
    return F.expr(f"(product_key - pmod(product_key, {BLOCK})) DIV {BLOCK}")


def _members(sets: DataFrame, key: str, name: str) -> DataFrame:
    """Distinct values of `key` for each category; equal sets of categories are counted as one."""
    each = sets.groupBy(key, "_word").agg(F.bit_or("_set").alias("_set"))
    alike = each.groupBy("_word", "_set").agg(F.count(key).alias("_n"))
    bits = F.explode(F.sequence(F.lit(0), F.lit(SET_BITS - 1))).alias("_bit")
    return (
        alike.select("*", bits)
        .where("(shiftrightunsigned(_set, _bit) & 1) = 1")
        .groupBy((F.col("_word") * SET_BITS + F.col("_bit")).alias("_place"))
        .agg(F.sum("_n").alias(name))
    )


def category_leaderboard(w: Warehouse, p: ReportParameters) -> DataFrame:
    """Fifteen best categories; shares are of all categories.

    Orders and buyers move once with the set of their categories, as bits of a number, and
    not once with each category. Items of an order lie together, so they become one row
    where they are read.
    """
    blocks = w.derived("category_blocks", lambda: _category_blocks(w))
    rows = (
        delivered(w)
        .withColumn("_block", _block())
        .join(blocks, "_block")
        .withColumn("_place", F.get("_places", _slot()))
        .where("_place >= 0")
    )
    sums = rows.groupBy("_place").agg(
        *metrics(
            items_sold="items",
            total_revenue="price_sum",
            avg_price="price_mean",
            avg_review_score="score_mean",
            avg_delivery_days="delivery_mean",
        )
    )
    bit = F.expr(f"shiftleft(1L, _place % {SET_BITS})")
    word = F.expr(f"_place DIV {SET_BITS}").alias("_word")
    sets = rows.groupBy("order_id", "customer_key", word).agg(F.bit_or(bit).alias("_set"))
    return (
        sums.join(_members(sets, "order_id", "unique_orders"), "_place", "left")
        .join(_members(sets, "customer_key", "unique_buyers"), "_place", "left")
        .join(_numbered_categories(w), "_place")
        .select(
            CATEGORY,
            "items_sold",
            F.coalesce("unique_orders", F.lit(0)).alias("unique_orders"),
            F.coalesce("unique_buyers", F.lit(0)).alias("unique_buyers"),
            "total_revenue",
            "avg_price",
            "avg_review_score",
            "avg_delivery_days",
        )
        .withColumn("revenue_share_pct", share_of_all(F.col("total_revenue")))
        .withColumn("category", F.coalesce(CATEGORY, F.lit(UNNAMED)))
        .drop(CATEGORY)
        .orderBy(F.desc("total_revenue"), "category")
        .limit(15)
    )


def category_trend(w: Warehouse, p: ReportParameters) -> DataFrame:
    """Months of the five best categories.

    The five come first, from sums alone; only their items are counted by month.
    """
    rows = with_product(delivered(w), w).where(F.col(CATEGORY).isNotNull())
    best = (
        rows.groupBy(CATEGORY)
        .agg(F.sum("price").alias("overall"))
        .orderBy(F.desc("overall"), CATEGORY)
        .limit(TREND_CATEGORIES)
        .select(CATEGORY)
    )
    # At most TREND_CATEGORIES rows are broadcast.
    chosen = with_purchase_day(rows.join(F.broadcast(best), CATEGORY, "left_semi"), w)
    return (
        chosen.groupBy("year", "month", CATEGORY)
        .agg(*metrics(orders="orders", revenue="price_sum"))
        .orderBy("year", "month", F.desc("revenue"), CATEGORY)
        .select(
            month_label(F.col("year"), F.col("month")).alias("period"),
            F.coalesce(CATEGORY, F.lit(UNNAMED_SERIES)).alias("category"),
            "orders",
            "revenue",
        )
    )


def price_segments(w: Warehouse, p: ReportParameters) -> DataFrame:
    price = F.col("price")
    return (
        delivered(w)
        .groupBy(
            band_label(price, fixed.PRICE_BANDS, inclusive=False).alias("price_segment"),
            band_number(price, fixed.PRICE_BANDS, inclusive=False).alias("segment_order"),
        )
        .agg(
            *metrics(
                items_sold="items",
                total_revenue="price_sum",
                avg_review_score="score_mean",
                avg_delivery_days="delivery_mean",
            )
        )
        .withColumn("pct_items", share_of_all(F.col("items_sold")))
        .withColumn("pct_revenue", share_of_all(F.col("total_revenue")))
        .orderBy("segment_order")
    )


def _quality_score() -> F.Column:
    """Mean score weighs 60 of 100 (5 stars are full marks), on-time share 40.

    Both shares are put over one denominator and rounded half up in integers.
    """
    stars, rated = F.sum("review_score"), F.count("review_score")
    on_time, rows = tally(F.col("is_on_time")), F.count(F.lit(1))
    big = "decimal(38,0)"
    # 60 / 5 = 12 points per star.
    top = F.lit(12) * stars.cast("decimal(18,0)") * rows.cast("decimal(18,0)") + F.lit(
        40
    ) * on_time.cast("decimal(18,0)") * rated.cast("decimal(18,0)")
    bottom = rated.cast("decimal(18,0)") * rows.cast("decimal(18,0)")
    tenths = F.call_function(
        "div",
        (F.lit(20) * top + bottom).cast(big),
        F.nullif(F.lit(2) * bottom, F.lit(0)).cast(big),
    )
    return (tenths / F.lit(10)).cast("decimal(20,1)")


def quality_matrix(w: Warehouse, p: ReportParameters) -> DataFrame:
    return (
        with_product(delivered(w), w)
        .groupBy(CATEGORY)
        .agg(
            *metrics(
                items_sold="items",
                total_revenue="price_sum",
                avg_price="price_mean",
                avg_review_score="score_mean",
                avg_delivery_days="delivery_mean",
                on_time_pct="on_time_pct",
            ),
            _quality_score().alias("quality_score_100"),
        )
        .where(F.col("items_sold") >= p.min_category_items)
        .withColumn("category", F.coalesce(CATEGORY, F.lit(UNNAMED)))
        .drop(CATEGORY)
        .orderBy(F.desc("quality_score_100"), "category")
        .limit(20)
    )


def hot_categories(w: Warehouse, p: ReportParameters) -> DataFrame:
    """Growth of one month over the category's previous month with sales.

    Later months change no growth and are not read.
    """
    year, month = map(int, p.hot_period.split("-"))
    after = (year + month // 12) * 10_000 + (month % 12 + 1) * 100 + 1
    rows = bought_before(delivered(w), after)
    # Unnamed categories keep their own group but share the shown name.
    monthly = (
        with_product(with_purchase_day(rows, w), w)
        .groupBy("year", "month", CATEGORY)
        .agg(F.sum("price").alias("current_revenue"))
        .withColumn("category", F.coalesce(CATEGORY, F.lit(UNNAMED)))
    )
    by_month = Window.partitionBy("category").orderBy("year", "month")
    now, before = F.col("current_revenue"), F.col("prev_month_revenue")
    return (
        monthly.withColumn("prev_month_revenue", F.lag("current_revenue").over(by_month))
        .withColumn("period", month_label(F.col("year"), F.col("month")))
        .where((F.col("period") == p.hot_period) & before.isNotNull())
        .select(
            "period",
            "category",
            "current_revenue",
            "prev_month_revenue",
            growth(now, before).alias("mom_growth_pct"),
            F.when(now > before, "Growing")
            .when(now < before, "Declining")
            .otherwise("Stable")
            .alias("trend"),
        )
        .orderBy(F.desc("mom_growth_pct"), "category")
        .limit(15)
    )
