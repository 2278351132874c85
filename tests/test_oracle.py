"""Every catalog query against its DuckDB oracle, at the driver's scale."""

import pytest

from quarry.plans.catalog import CATALOG
from quarry.plans.check import compare, duck_connection

from conftest import SF001, SF01


@pytest.fixture(scope="module")
def duck01():
    return duck_connection(SF01)


@pytest.mark.parametrize("key", sorted(CATALOG))
def test_oracle_sf0_01(spark, duck01, key):
    res = compare(spark, key, SF01, duck01)
    assert res["ok"], res


@pytest.mark.parametrize("key", ["rolling_dense_sum", "match_points", "k_hop", "traffic_percent_rank"])
def test_oracle_smoke_scale(spark, key):
    res = compare(spark, key, SF001)
    assert res["ok"], res


@pytest.mark.parametrize("key", ["star_revenue_filtered", "daily_max_ties", "weekday_totals_calendar",
                                 "top_n_per_day", "weekday_weekend_pivot"])
def test_results_do_not_depend_on_session_time_zone(spark, duck01, key):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        res = compare(spark, key, SF01, duck01)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert res["ok"], res
