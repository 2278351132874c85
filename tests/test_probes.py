"""Cases the driver's tables do not hold: more decimals, huge sums, undated
events, ties that fill a group, totals that concentrate."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quarry import operators as op
from quarry.functions import exact_product, exact_sum

from test_skew import HOT, N, rows_per_task, skewed


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_three_decimals_are_kept(spark):
    data = [(1, 1, 0.101), (1, 2, 0.104), (2, 3, 0.102), (2, 4, 0.102)]
    df = spark.createDataFrame(data, "k long, t long, v double")
    assert rows(op.max_above_max_avg(df, "k", "t", "v")) == [(1,)]
    df = spark.createDataFrame([(7, 2000, 1.001), (7, 2001, 1.004), (8, 2000, 1.004), (8, 2001, 1.001)], "k long, y int, v double")
    assert rows(op.strictly_increasing(df, "k", "y", "v")) == [(7,)]


def test_an_average_equal_to_the_maximum_is_not_below_it(spark):
    df = spark.createDataFrame([(1, i, 0.1) for i in range(3)], "k long, t long, v double")
    assert rows(op.max_above_max_avg(df, "k", "t", "v")) == []


def test_threshold_is_not_truncated(spark):
    tx = spark.createDataFrame([(1, 1, 99.99), (2, 2, 99.995), (3, 3, 100.0)], "o long, c long, amt double")
    none = spark.createDataFrame([], "o long")
    names = spark.createDataFrame([(i, f"n{i}") for i in (1, 2, 3)], "k long, n string")
    got = op.anti_join_spend(tx, none, names, tx_key="o", excluded_key="o", tx_entity="c", entity_key="k", name="n",
                             amount="amt", min_total="99.995")
    assert [r[0] for r in rows(got)] == [2, 3]


def test_large_products_and_sums_do_not_overflow(spark):
    fact = spark.createDataFrame([(1, 1, 2000.0)] * 4, "p long, o long, q double")
    dim = spark.createDataFrame([(1, "g", 9.0e15)], "p long, g string, price double")
    header = spark.createDataFrame([(1,)], "o long")
    got = op.star_revenue_filtered(fact, dim, header, fact_dim_key="p", dim_key="p", fact_header_key="o", header_key="o",
                                   dim_pred=F.lit(True), header_pred=F.lit(True), group="g", price="price", quantity="q", scale=2)
    assert rows(got) == [("g", 7.2e19)]
    df = spark.createDataFrame([(1, Decimal("90000000000000000.123"))] * 200, "k long, v decimal(28,3)")
    e = exact_sum(df, "v")
    assert df.agg(*e.sums("t")).select(e.to_decimal(e.total("t"))).first()[0] == Decimal("18000000000000000024.600")


def exact_total(df, value="v", scale=6):
    e = exact_sum(df, value, scale)
    return df.agg(*e.sums("t")).select(e.total("t").alias("t")).select(e.to_double(F.col("t")).alias("d"), "t").first()


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_plain_doubles_are_summed_exactly_in_any_order(spark, ansi):
    import math
    import random
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        rng = random.Random(8)
        odd = [rng.uniform(-1, 1) * 10 ** rng.randrange(-4, 14) for _ in range(3000)] + [1 / 3, 0.1 * 3, 2.0e13, -2.0e13, None] * 20
        total = None
        for parts in (1, 7):
            rng.shuffle(odd)
            got = exact_total(spark.createDataFrame([(v,) for v in odd], "v double").repartition(parts))
            assert got["d"] == pytest.approx(math.fsum(v for v in odd if v is not None), rel=1e-15) and total in (None, got["t"])
            total = got["t"]
        for v in (1 / 3, 0.1 * 3, 2.0e13, -0.07, 1e18, 123456.789, 0.0):
            assert exact_total(spark.createDataFrame([(v,), (v,), (None,)], "v double"))["d"] == 2 * v
        assert exact_total(spark.createDataFrame([(0.1,), (0.2,)], "v double"))["t"] == exact_total(spark.createDataFrame([(0.3,)], "v double"))["t"]
        assert exact_total(spark.createDataFrame([(1e300,), (1.0,)], "v double"))["d"] == 1e300
        assert math.isnan(exact_total(spark.createDataFrame([(float("nan"),), (1.0,)], "v double"))["d"])
        assert tuple(exact_total(spark.createDataFrame([(None,)], "v double"))) == (None, None)
        for kind, v, total in (("long", -(1 << 62), -(1 << 63)), ("decimal(18,3)", Decimal("-0.007"), -0.014), ("int", 5, 10), ("float", 0.25, 0.5)):
            assert exact_total(spark.createDataFrame([(v,), (v,), (None,)], f"v {kind}"))["d"] == total
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_products_of_doubles(spark):
    df = spark.createDataFrame([(0.1, 3.0), (1 / 3, 3.0), (2.0e13, 0.01), (None, 1.0)], "a double, b double")
    e = exact_product(df, "a", "b", 2)
    got = df.agg(*e.sums("t")).select(e.to_double(e.total("t"))).first()[0]
    assert got == pytest.approx(0.3 + 1.0 + 2.0e11, rel=1e-15)
    e = exact_product(df.limit(1), "a", "b", 2)
    assert df.limit(1).agg(*e.sums("t")).select(e.to_decimal(e.total("t"))).first()[0] == Decimal("0.3")


def test_inexact_values_take_part_in_every_sum(spark):
    third = spark.createDataFrame([(1, i, 1 / 3) for i in range(3)] + [(2, i, 0.2) for i in range(3)], "k long, t long, v double")
    assert rows(op.max_above_max_avg(third, "k", "t", "v")) == []
    up = spark.createDataFrame([(1, 1, 1 / 3), (1, 2, 0.1 * 3 + 1), (2, 1, 0.1 * 3), (2, 2, 0.3)], "k long, y int, v double")
    assert rows(op.strictly_increasing(up, "k", "y", "v")) == [(1,)]  # 0.1 * 3 is a little above 0.3
    busy = spark.createDataFrame([(dt.datetime(2024, 1, 5), 2.0e13), (dt.datetime(2024, 1, 5), 1 / 3)], "ts timestamp_ntz, v double")
    assert rows(op.weekday_totals(busy, "ts", "v", month=1)) == [(dt.date(2024, 1, 5), 2.0e13 + 1 / 3)]
    grid = spark.createDataFrame([(1, m, 0.1 * 3.0 * m) for m in range(1, 5)], "k long, m int, v double")
    got = rows(op.rolling_dense_sum(grid, "k", F.col("m"), "v", drop_latest=False))
    assert [r[2] for r in got] == pytest.approx([2.7, 1.8, 0.9, 0.3])


def test_null_totals_do_not_rise(spark):
    df = spark.createDataFrame([(1, 1, 5.0), (1, 2, None), (1, 3, 3.0), (2, 1, None), (3, 1, 1.0), (3, None, 2.0), (4, 1, 2.0), (4, None, 1.0),
                                (5, 1, None), (5, 2, 1.0)], "k long, y int, v double")
    assert rows(op.strictly_increasing(df, "k", "y", "v")) == [(2,), (3,)]


@pytest.mark.parametrize("salts", [1, 32])
def test_null_groups_and_values_are_ranked(spark, salts):
    df = spark.createDataFrame([(1, 1, None), (1, 2, None), (None, 3, 2.0), (None, 4, 2.0), (None, 5, 1.0), (2, 6, 1.0), (2, 7, None)], "g long, i long, v double")
    got = rows(op.max_per_group_ties(df, "g", "i", "v", sort=False, salts=salts))
    assert sorted(got, key=str) == [(1, 1), (1, 2), (2, 6), (None, 3), (None, 4)]
    high = rows(op.max_per_group_ties(df, "g", "i", "v", sort=False, nulls_first=True, salts=salts))
    assert sorted(high, key=str) == [(1, 1), (1, 2), (2, 7), (None, 3), (None, 4)]
    counts = spark.createDataFrame([(None, 1, 5), (None, 2, 5), (None, 3, 4), (None, 4, 3), (dt.date(2024, 1, 1), 5, None), (dt.date(2024, 1, 1), 6, 1)], "d date, u long, n long")
    assert rows(op.top_n_per_day(counts, "d", "u", "n")) == [(None, 1, 5), (None, 2, 5), (None, 3, 4), (dt.date(2024, 1, 1), 5, None), (dt.date(2024, 1, 1), 6, 1)]
    days = spark.createDataFrame([(1, None, 2.0), (2, None, 2.0), (3, dt.date(2024, 1, 1), 1.0), (4, dt.date(2024, 1, 1), None)], "i long, d date, v double")
    assert sorted(rows(op.daily_max_ties(days, "d", "v", "i"))) == [(1,), (2,), (3,)]


def test_repeated_event_ids_give_the_self_joins_rows(spark):
    from quarry.sources import edges, matches
    ev = spark.createDataFrame([(0, 5, 1.0, "error"), (0, 6, 2.0, "error"), (1, 7, 3.0, "error"), (1, 7, 4.0, "error"), (2, 8, 5.0, "error"), (None, 1, 1.0, "error")],
                               "event_id long, user_id long, value double, event_type string")
    assert sorted(rows(matches(ev))) == [(0, 5, 7, 1, 3), (0, 5, 7, 1, 4), (0, 6, 7, 2, 3), (0, 6, 7, 2, 4)]
    assert sorted(rows(edges(ev))) == [(5, 7), (6, 7), (7, 8)]


def test_undated_events_have_no_gap(spark):
    day = dt.datetime(2024, 1, 1, 5)
    one = [(1, day, 0)] + [(1, None, i) for i in range(1, 12)]
    two = [(2, day, 0), (2, day, 1)] + [(2, None, i) for i in range(2, 12)]
    three = [(3, day, 0), (3, day + dt.timedelta(days=4), 1), (3, day + dt.timedelta(days=8), 2)] + [(3, None, i) for i in range(3, 12)]
    df = spark.createDataFrame(one + two + three, "u long, ts timestamp_ntz, id long")
    assert sorted(rows(op.largest_gap(df, "u", "ts", 10, count_col="id"))) == [(2, 0), (3, 4)]
    assert sorted(rows(op.largest_gap(df, "u", "ts", 10, count_col="id", repeats=True))) == [(2, 0), (3, 4), (3, 4)]


def test_repeats_of_a_busy_day_build_no_large_array(spark):
    df = spark.range(10_001).select(F.lit(1).alias("u"), F.lit(dt.date(2024, 1, 1)).alias("ts"), "id")
    assert op.largest_gap(df, "u", "ts", 10, repeats=True).count() == 10_000


def test_only_qualifying_trips_are_counted(spark):
    trips = [(1, 1, 1, "A", True), (1, 2, 2, "B", True), (1, 3, 3, "A", False),
             (2, 4, 1, "A", True), (2, 5, 2, "A", False), (2, 6, 3, "A", None)]
    df = spark.createDataFrame(trips, "u long, t long, d int, dest string, home boolean")
    owners = spark.createDataFrame([(1,), (2,)], "u long")
    how = dict(owner="u", trip="t", order=["d"], dest="dest")
    assert rows(op.first_last_same(df, owners, qualifies=F.col("home"), **how)) == [(1,)]
    assert sorted(rows(op.first_last_same(df, owners, **how))) == [(1,), (2,)]



def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_ties_that_fill_a_group_are_dealt_and_moved_once(spark):
    df = skewed(spark, "g long, i long, v double", lambda i: (0, i, 9.0), lambda i: (1 + i % 7, i, float(i % 5)))
    conf = {"spark.sql.adaptive.skewJoin.enabled": "false", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {c: spark.conf.get(c) for c in conf}
    for c, v in conf.items():
        spark.conf.set(c, v)
    try:
        res = op.max_per_group_ties(df, "g", "i", "v", sort=False)
        plan = final_plan(res)
        assert len(res.collect()) == HOT + sum(1 for i in range(HOT, N) if i % 5 == 4)
        assert plan.count("Scan ExistingRDD") == 1 and "ReusedExchange" in plan
        assert rows_per_task(res)[-1] < HOT / 2  # no task has the hot group
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)


def test_concentrated_totals_spread_over_ranges(spark):
    totals = spark.range(200_000).select(F.concat(F.lit("n"), "id").alias("node"), (F.col("id") * 1.0 + 1.0e8).alias("total"))
    ranked = op.ranking.percent_rank_of(totals, "total")
    got = ranked.agg(F.min("_rm1"), F.max("_rm1"), F.countDistinct("_rm1")).first()
    assert tuple(got) == (0, 199_999, 200_000)
    from quarry.operators.prefix import cut_into_ranges
    sizes = [r["count"] for r in cut_into_ranges(totals, "total", 256).groupBy("_b").count().collect()]
    assert len(sizes) == 256 and max(sizes) < 4 * 200_000 / 256


def test_many_timestamps_as_periods(spark):
    """Periods are numbered in ranges: no exchange brings all of them to one task."""
    df = spark.range(60_000).select((F.col("id") % 3).alias("k"), F.timestamp_seconds(F.col("id") * 7).alias("t"), F.lit(0.5).alias("v"))
    res = op.rolling_dense_sum(df, "k", F.col("t"), "v", width=4, sort=False)
    import re
    one = re.findall(r"Exchange SinglePartition[^\n]*\n([^\n]*)", final_plan(res))
    assert all("Aggregate(keys=[], functions=[partial_" in line for line in one)  # one row a task: edges and sums of ranges
    got = res.groupBy("part_id", "part_summary").count().collect()
    assert sum(r["count"] for r in got) == 60_000 - 3
    assert {(r["part_id"], r["part_summary"]): r["count"] for r in got if r["part_summary"] == 0.5} == {(1, 0.5): 1, (2, 0.5): 1, (0, 0.5): 1}
    words = spark.createDataFrame([("b",), ("a",), (None,), ("é",)], "p string")
    assert sorted(rows(op.dense_index(words, "p", "n", ranges=2)), key=str) == [("a", 1), ("b", 2), ("é", 3), (None, 4)]


def test_building_k_hop_starts_no_job(spark):
    edges = spark.createDataFrame([(1, 0), (2, 1), (3, 2)], "src long, dst long")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("k-hop-build", "")
    res = op.k_hop(edges, lambda e: e.agg(F.min("dst").alias("node")), k=3, mode="within", limit=2)
    assert not list(tracker.getJobIdsForGroup("k-hop-build"))
    assert rows(res) == [(1,), (2,)]
    spark.sparkContext.setJobGroup("other", "")


def test_any_year_weekdays(spark):
    df = spark.createDataFrame([(dt.datetime(y, 1, d), 1.005) for y in (2023, 2024) for d in range(1, 32)], "ts timestamp_ntz, v double")
    got = rows(op.weekday_totals(df, "ts", "v", month=1))
    assert len(got) == 8 and {r[1] for r in got} == {1.005}


def test_dealt_k_hop_reaches_the_same_nodes(spark):
    edges = spark.range(3000).select(F.col("id").alias("src"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500).alias("dst"))
    start = spark.createDataFrame([(0,)], "node long")
    for mode in ("exact", "within"):
        for k in (1, 3):
            plain = rows(op.k_hop(edges, start, k=k, mode=mode, parts=1))
            for parts in (2, 8, 256):
                assert rows(op.k_hop(edges, start, k=k, mode=mode, parts=parts)) == plain
