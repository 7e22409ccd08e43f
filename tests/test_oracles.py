"""Every registered query against its SQL on the same tables."""

from __future__ import annotations

import glob
import math
import os

import duckdb
import pytest

from mercastar.registry import QUERIES
from oracles import ORACLES

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _key(row):
    return tuple((value is not None, str(value)) for value in row)


def _same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-12)
    return type(a) is type(b) and a == b


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, database, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    ours = sorted((tuple(row[c] for c in columns) for row in df.collect()), key=_key)

    result = database.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    theirs = sorted((tuple(row[i] for i in places) for row in result.fetchall()), key=_key)

    assert len(ours) == len(theirs)
    for mine, other in zip(ours, theirs, strict=True):
        assert all(_same(a, b) for a, b in zip(mine, other, strict=True)), (columns, mine, other)
    assert ours or name in ALLOWED_EMPTY


# Sort keys of reports: + ascending, - descending.
ORDERED = {
    "q3_category_by_revenue": "-total_revenue +category",
    "q3_category_by_items": "-items_sold +category",
    "q3_revenue_by_month": "+year +month",
    "q3_revenue_by_quarter": "+year +quarter",
    "q3_revenue_by_weekday": "+day_of_week",
    "q3_state_revenue": "-total_revenue +state_code",
    "q3_macro_region_share": "-total_revenue +macro_region",
    "q3_rfm_customers": "-rfm_total +customer_unique_id",
    "q3_rfm_segments": "-total_monetary +rfm_segment",
    "q3_delivery_by_seller_state": "+avg_delivery_days +seller_state",
    "q3_review_distribution": "+review_score",
    "q3_payment_methods": "-orders +payment_type",
    "q3_seller_performance": "-total_revenue +seller_id",
    "q3_cohort_activity": "+cohort_month +months_since_first",
    "ex2_revenue_trend": "+period",
    "ex3_quarterly": "+quarter_label",
    "ex4_macro_region": "-total_revenue +macro_region",
    "ex5_payment_mix": "-order_count",
    "ex6_weekday_pattern": "+day_of_week",
    "cus1_rfm_segments": "-total_revenue_from_segment +segment_label",
    "cus2_state_map": "-total_revenue +state_code",
    "cus3_repeat_buyers": "-customer_count +buyer_type",
    "cus4_cohort_retention": "+cohort_month +month_number",
    "cus4b_retention_curve": "+month_number",
    "cus5_review_distribution": "-review_score",
    "cus6_top_cities": "-unique_customers +city_state",
    "prd1_category_leaderboard": "-total_revenue +category",
    "prd2_category_trend": "+period -revenue +category",
    "prd3_price_segments": "+segment_order",
    "prd4_quality_matrix": "-quality_score_100 +category",
    "prd5_hot_categories": "-mom_growth_pct +category",
    "ops2_seller_state_sla": "-on_time_pct +seller_state",
    "ops3_delay_review_impact": "+sort_order",
    "ops4_seller_tiers": "-total_revenue +seller_id",
    "ops5_delivery_histogram": "+delivery_bucket",
    "ops6_ontime_trend": "+period",
    "dq_status_mix": "-item_rows +order_status",
}


@pytest.mark.parametrize("name", sorted(ORDERED))
def test_rows_come_in_order(spark, name):
    rows = QUERIES[name](spark, DATA).collect()
    for key in reversed(ORDERED[name].split()):
        sign, column = key[0], key[1:]
        known = [r for r in rows if r[column] is not None]
        unknown = [r for r in rows if r[column] is None]
        known = sorted(known, key=lambda r: r[column], reverse=sign == "-")
        rows = known + unknown if sign == "-" else unknown + known
    assert rows == QUERIES[name](spark, DATA).collect()


# Queries that may have no rows on the test data.
ALLOWED_EMPTY: set[str] = set()
