"""The query catalog: every operator bound to the driver's tables.

Each entry is ``fn(spark, sf_dir) -> DataFrame`` and reads whole tables;
constants are those of FIXTURES.md section 3 (the re-aimed questions).  The
keys are also the keys of ``quarry.plans.oracles.SQL``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry import operators as op
from quarry.functions import before_year, day_of, exact_product, exact_sum, in_month, in_year, on_days
from quarry.sources import Tables, edges, matches, roster, services

Query = Callable[[SparkSession, str], DataFrame]
CATALOG: dict[str, Query] = {}


def query(fn: Query) -> Query:
    CATALOG[fn.__name__] = fn
    return fn


# -- filter and aggregate ---------------------------------------------------

@query
def children_threshold(spark, root):
    o = Tables(spark, root).orders
    parent = F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(F.col("o_custkey"))
    return op.children_threshold(o, parent, 10, out="parent_id")


@query
def count_threshold(spark, root):
    ev = Tables(spark, root).events
    cancelled = F.col("event_type") == "error"
    booked = F.col("event_type") == "purchase"
    return op.count_threshold(ev, "user_id", 10, count_col="event_id",
                              must_be_true=[booked], must_be_false=[cancelled])


@query
def weekday_weekend_pivot(spark, root):
    return op.weekday_weekend_pivot(Tables(spark, root).events, "ts")


@query
def exact_length_count(spark, root):
    return op.exact_length_count(Tables(spark, root).part, "p_name", 9)


@query
def two_entity_daily_diff(spark, root):
    ev = Tables(spark, root).events
    return op.two_entity_daily_diff(ev, day_of("ts"), "event_type", "click", "view", gt=2)


# -- star joins --------------------------------------------------------------

@query
def star_revenue_filtered(spark, root):
    t = Tables(spark, root)
    return op.star_revenue_filtered(
        t.lineitem, t.part, t.orders,
        fact_dim_key="l_partkey", dim_key="p_partkey",
        fact_header_key="l_orderkey", header_key="o_orderkey",
        dim_pred=F.col("p_type").like("%M%"),
        header_pred=in_year("o_orderdate", 1997),
        group="p_type", price="p_retailprice", quantity="l_quantity", scale=2)


@query
def distinct_count_and_list(spark, root):
    t = Tables(spark, root)
    asia = (t.region.where(F.col("r_name").ilike("%asia%")).select("r_regionkey")
            .join(t.nation, F.col("r_regionkey") == F.col("n_regionkey"))
            .join(t.supplier.select("s_suppkey", "s_nationkey"),
                  F.col("n_nationkey") == F.col("s_nationkey"))
            .select("s_suppkey", "n_nationkey", "n_name"))
    # Distinct (order, nation) and then (customer, nation) rows: plain hash
    # aggregates, combined map-side, with nothing collected per key.
    per_order = (t.lineitem.select("l_orderkey", "l_suppkey")
                 .join(asia, F.col("l_suppkey") == F.col("s_suppkey"))
                 .select("l_orderkey", "n_nationkey", "n_name").distinct())
    per_customer = (per_order.join(t.orders.select("o_orderkey", "o_custkey"),
                                   F.col("l_orderkey") == F.col("o_orderkey"))
                    .select("o_custkey", "n_nationkey", "n_name").distinct())
    rows = (per_customer.join(t.customer.select("c_custkey", F.col("c_name").alias("customer_name")),
                              F.col("o_custkey") == F.col("c_custkey"))
            .select("customer_name", "n_nationkey", "n_name"))
    return op.distinct_count_and_list(rows, "customer_name", "n_nationkey", "n_name",
                                      "distinct_nations", "list_of_nations")


@query
def percentage_bonus(spark, root):
    t = Tables(spark, root)
    li = t.lineitem.join(t.orders.select(F.col("o_orderkey").alias("l_orderkey")),
                         "l_orderkey", "left_semi")
    # Each line's value is an exact product; the sum per supplier is combined
    # map-side, so after the part join only one row per supplier and task is
    # shuffled.  (Summing per (supplier, part) first would shuffle again for
    # the part join: such pairs rarely repeat within a task at scale.)
    lines = li.join(t.part.select("p_partkey", "p_retailprice"), F.col("l_partkey") == F.col("p_partkey"))
    line = exact_product(lines, "l_quantity", "p_retailprice", 2)
    per_supp = lines.groupBy("l_suppkey").agg(*line.sums("_t")).select("l_suppkey", line.total("_t").alias("_t"))
    per_supp = per_supp.select("l_suppkey", line.to_decimal(F.col("_t")).alias("value"))
    values = per_supp.join(t.supplier.select("s_suppkey", F.col("s_name").alias("name")),
                           F.col("l_suppkey") == F.col("s_suppkey"))
    return op.percentage_bonus(values, "name", "value", "0.1")


@query
def weekday_totals(spark, root):
    ev = Tables(spark, root).events.where(F.col("event_type") == "purchase")
    return op.weekday_totals(ev, "ts", "value", weekday=5, month=1, year=2024,
                             spine="observed", day_out="day", total_out="total", scale=2)


@query
def weekday_totals_any_year(spark, root):
    ev = Tables(spark, root).events.where(F.col("event_type") == "purchase")
    return op.weekday_totals(ev, "ts", "value", weekday=5, month=1, scale=2)


@query
def weekday_totals_calendar(spark, root):
    ev = Tables(spark, root).events.where(F.col("event_type") == "purchase")
    return op.weekday_totals(ev, "ts", "value", weekday=5, month=1, year=2024,
                             spine="calendar", day_out="day", total_out="total", scale=2)


@query
def anti_join_spend(spark, root):
    t = Tables(spark, root)
    installed = t.lineitem.where(F.col("l_returnflag") == "R")
    return op.anti_join_spend(t.orders, installed, t.customer,
                              tx_key="o_orderkey", excluded_key="l_orderkey",
                              tx_entity="o_custkey", entity_key="c_custkey",
                              name="c_name", amount="o_totalprice", min_total=1000000, scale=2)


# -- partitioned windows -------------------------------------------------------

@query
def strictly_increasing(spark, root):
    o = Tables(spark, root).orders.where(before_year("o_orderdate", 2001))
    return op.strictly_increasing(o, "o_custkey", F.year("o_orderdate"), "o_totalprice", scale=2)


@query
def nth_exceeds_prior(spark, root):
    t = Tables(spark, root)
    price = exact_sum(t.lineitem, "l_extendedprice", 2)
    spend = t.lineitem.groupBy("l_orderkey").agg(*price.sums("_p")).select("l_orderkey", price.total("_p").alias("_p"))
    spend = spend.select("l_orderkey", price.to_double(F.col("_p")).alias("spend"))
    tx = (spend.join(t.orders.select("o_orderkey", "o_custkey",
                                     day_of("o_orderdate").alias("tx_date")),
                     F.col("l_orderkey") == F.col("o_orderkey")))
    return op.nth_exceeds_prior(tx, "o_custkey", ["tx_date", "o_orderkey"], "spend",
                                n=3, prior=2, date="tx_date")


def _max_per_group(spark, root, limit):
    t = Tables(spark, root)
    rows = (t.lineitem.select("l_orderkey", "l_partkey")
            .join(t.part.select("p_partkey", "p_retailprice"),
                  F.col("l_partkey") == F.col("p_partkey")))
    # an order has a handful of lines: one stage
    return op.max_per_group_ties(rows, "l_orderkey", "p_partkey", "p_retailprice", limit=limit, sort=limit is not None, salts=1)


@query
def max_per_group_ties(spark, root):
    return _max_per_group(spark, root, 5)


@query
def max_per_group_ties_all(spark, root):
    return _max_per_group(spark, root, None)


@query
def consecutive_days(spark, root):
    return op.consecutive_days(Tables(spark, root).events, "user_id", "ts", n=4, mode="windows")


@query
def consecutive_days_islands(spark, root):
    return op.consecutive_days(Tables(spark, root).events, "user_id", "ts", n=4, mode="islands")


@query
def largest_gap(spark, root):
    return op.largest_gap(Tables(spark, root).events, "user_id", "ts", min_count=10,
                          count_col="event_id")


@query
def largest_gap_as_written(spark, root):
    return op.largest_gap(Tables(spark, root).events, "user_id", "ts", min_count=10,
                          count_col="event_id", repeats=True)


@query
def first_last_same(spark, root):
    t = Tables(spark, root)
    building = t.customer.where(F.col("c_mktsegment") == "BUILDING")
    return op.first_last_same(t.orders, building, owner="o_custkey", trip="o_orderkey",
                              order=["o_orderdate"], dest="o_orderpriority", min_trips=2,
                              qualifies=F.col("o_orderstatus") == "F",
                              owner_key="c_custkey", out="user_id")


@query
def sequence_scan(spark, root):
    """Each user's previous event but one and running value, at raw timestamps."""
    ev = Tables(spark, root).events.select("user_id", "ts", "event_id", "event_type", "value")
    out = op.sequence_scan(ev, "user_id", ["ts", "event_id"], lags={"previous_type": ("event_type", 1), "second_last_id": ("event_id", 2)},
                           running={"running_value": "value"}, scale=2)
    return out.select("event_id", "user_id", "previous_type", "second_last_id", "running_value")


# -- two-role rows -----------------------------------------------------------

@query
def match_points(spark, root):
    t = Tables(spark, root)
    return op.match_points(matches(t.events), roster(t.customer))


@query
def argmin_per_entity(spark, root):
    return op.argmin_per_entity(matches(Tables(spark, root).events))


@query
def semi_any_role(spark, root):
    t = Tables(spark, root)
    return op.semi_any_role(t.customer, matches(t.events), key="c_custkey", name="c_name")


@query
def union_distinct_roles(spark, root):
    t = Tables(spark, root)
    return op.union_distinct_roles(t.customer, matches(t.events), key="c_custkey", name="c_name")


def _services(spark, root):
    t = Tables(spark, root)
    return services(t.lineitem, t.orders, t.customer, t.supplier)


@query
def two_sided_traffic_top1(spark, root):
    return op.two_sided_traffic_top1(_services(spark, root), "origin", "destination",
                                     "seats", "round_trip", scale=2)


@query
def traffic_percent_rank(spark, root):
    return op.traffic_percent_rank(_services(spark, root), "origin", "destination", "seats",
                                   "round_trip", method="buckets", scale=2)


@query
def traffic_percent_rank_window(spark, root):
    # The nodes are nations: at most 25 rows reach the single window task.
    return op.traffic_percent_rank(_services(spark, root), "origin", "destination", "seats",
                                   "round_trip", method="window", scale=2)


# -- global comparisons --------------------------------------------------------

@query
def top_with_ties(spark, root):
    t = Tables(spark, root)
    return op.top_with_ties(t.orders, "o_custkey", t.customer, "c_custkey", "c_name")


@query
def daily_max_ties(spark, root):
    ev = Tables(spark, root).events.where((F.col("event_type") == "purchase")
                                          & in_month("ts", 2024, 1))
    return op.daily_max_ties(ev, day_of("ts"), F.floor("value"), "event_id")


@query
def max_above_max_avg(spark, root):
    ev = Tables(spark, root).events.where((F.col("event_type") == "purchase")
                                          & F.col("event_id").isNotNull())
    return op.max_above_max_avg(ev, "user_id", "event_id", "value", min_trips=2, scale=2)


@query
def max_above_max_avg_ratio(spark, root):
    # a value with more than two decimals: the product of two rates
    li = Tables(spark, root).lineitem
    rate = F.col("l_discount").cast("decimal(18,2)") * F.col("l_tax").cast("decimal(18,2)")
    return op.max_above_max_avg(li, "l_suppkey", "l_orderkey", rate, min_trips=2, out="supplier_id")


TOP_DAYS = (dt.date(2024, 1, 5), dt.date(2024, 1, 6))


def _day_counts(spark, root):
    ev = Tables(spark, root).events.where(on_days("ts", TOP_DAYS))
    return op.day_counts(ev, day_of("ts"), "user_id", "event_id")


@query
def top_n_per_day(spark, root):
    return op.top_n_per_day(_day_counts(spark, root), "day", "user_id", "num_posts", n=2)


@query
def top_two_values_global(spark, root):
    return op.top_two_values_global(_day_counts(spark, root), "day", "user_id", "num_posts")


# -- sets and grids ------------------------------------------------------------

def _basket_rows(t):
    types = ["PROMO", "ECONOMY", "LARGE"]
    # One flag per type and order on the order key (plain hash aggregate), so
    # the orders join reuses that exchange; rows again only after it.
    flags = [F.bool_or(F.col("p_type") == x).alias(f"_{x}") for x in types]
    per_order = (t.lineitem.select("l_orderkey", "l_partkey")
                 .join(t.part.where(F.col("p_type").isin(*types)).select("p_partkey", "p_type"),
                       F.col("l_partkey") == F.col("p_partkey"))
                 .groupBy("l_orderkey").agg(*flags))
    has = F.array_compact(F.array(*[F.when(F.col(f"_{x}"), F.lit(x)) for x in types]))
    return (per_order.join(t.orders.select("o_orderkey", "o_custkey"),
                           F.col("l_orderkey") == F.col("o_orderkey"))
            .select(F.col("o_custkey").alias("customer_id"), F.explode(has).alias("p_type")))


@query
def basket_intersect_except(spark, root):
    t = Tables(spark, root)
    keys = op.basket_intersect_except(_basket_rows(t), "customer_id", "p_type",
                                      ["PROMO", "ECONOMY"], ["LARGE"])
    names = t.customer.select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("name"))
    return keys.join(names, "customer_id").select("customer_id", "name").orderBy("customer_id")


@query
def basket_intersect_except_sets(spark, root):
    t = Tables(spark, root)
    rows = (t.customer.select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("name"))
            .join(t.orders.select("o_orderkey", "o_custkey"),
                  F.col("customer_id") == F.col("o_custkey"))
            .join(t.lineitem.select("l_orderkey", "l_partkey"),
                  F.col("o_orderkey") == F.col("l_orderkey"))
            .join(t.part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey")))
    return op.basket_intersect_except_sets(rows, ["customer_id", "name"], "p_type",
                                           ["PROMO", "ECONOMY"], ["LARGE"])


def _rolling(spark, root, limit):
    t = Tables(spark, root)
    rows = (t.lineitem.select("l_orderkey", "l_partkey", "l_quantity")
            .join(t.orders.select("o_orderkey", F.month("o_orderdate").alias("_month")),
                  F.col("l_orderkey") == F.col("o_orderkey")))
    return op.rolling_dense_sum(rows, "l_partkey", F.col("_month"), "l_quantity",
                                width=3, drop_latest=True, limit=limit, sort=limit is not None, scale=2)


@query
def rolling_dense_sum(spark, root):
    return _rolling(spark, root, 10)


@query
def rolling_dense_sum_all(spark, root):
    return _rolling(spark, root, None)


@query
def rolling_dense_sum_revenue(spark, root):
    """Price x quantity per part and year-month, all rows."""
    t = Tables(spark, root)
    two = "decimal(18,2)"
    rows = (t.lineitem.select("l_orderkey", "l_partkey", "l_quantity")
            .join(t.part.select("p_partkey", "p_retailprice"), F.col("l_partkey") == F.col("p_partkey"))
            .join(t.orders.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("_month")),
                  F.col("l_orderkey") == F.col("o_orderkey")))
    value = F.col("l_quantity").cast(two) * F.col("p_retailprice").cast(two)
    return op.rolling_dense_sum(rows, "l_partkey", F.col("_month"), value, width=3, drop_latest=True, sort=False)


# -- graph ---------------------------------------------------------------------

def _k_hop(spark, root, mode, limit=None):
    g = edges(Tables(spark, root).events)
    return op.k_hop(g, lambda e: e.agg(F.min("dst").alias("node")), k=4, mode=mode, limit=limit)


@query
def k_hop(spark, root):
    return _k_hop(spark, root, "exact")


@query
def k_hop_within(spark, root):
    return _k_hop(spark, root, "within")


@query
def k_hop_first_10(spark, root):
    return _k_hop(spark, root, "exact", limit=10)
