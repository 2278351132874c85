"""Unit tests on literal frames (FIXTURES.md section 4): NULLs, ties, empty
input and single-row groups, which the driver's tables do not contain."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quarry import operators as op
from quarry.sources import matches

D = dt.date


def rows(df):
    return [tuple(r) for r in df.collect()]


def match_frame(spark, data):
    return spark.createDataFrame(
        data, "match_id long, one_id long, two_id long, one_time long, two_time long")


# -- O1 / O17 / O21 / O25 / O26 ------------------------------------------------

def test_children_threshold_null_parent(spark):
    df = spark.createDataFrame([(None,), (None,), (None,), (1,), (1,), (2,)], "p long")
    assert rows(op.children_threshold(df, "p", 2)) == [(1,)]
    assert rows(op.children_threshold(df.where("p = 99"), "p", 1)) == []


def test_count_threshold_three_valued(spark):
    df = spark.createDataFrame(
        [(1, True, False), (1, True, None), (1, None, False), (2, True, False), (2, True, False)],
        "u long, booked boolean, cancelled boolean")
    res = op.count_threshold(df, "u", 2, must_be_true=["booked"], must_be_false=["cancelled"])
    assert rows(res) == [(2,)]


def test_weekday_weekend(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, d, 12),) for d in range(1, 8)], "ts timestamp_ntz")
    assert rows(op.weekday_weekend_pivot(df, "ts")) == [(5, 2)]


def test_exact_length_counts_code_points(spark):
    df = spark.createDataFrame([("abc",), ("äbc",), ("ab",), (None,)], "t string")
    assert rows(op.exact_length_count(df, "t", 3)) == [(2,)]


def test_two_entity_diff_boundary(spark):
    data = [(D(2024, 1, 1), "a")] * 2 + [(D(2024, 1, 2), "a")] * 3 + [(D(2024, 1, 3), "c")] * 5
    df = spark.createDataFrame(data, "d date, who string")
    assert rows(op.two_entity_daily_diff(df, "d", "who", "a", "b", gt=2)) == [(D(2024, 1, 2),)]


# -- O2 / O3 / O5 / O8 / O10 -----------------------------------------------------

def test_weekday_totals_spines(spark):
    # Two of the four Fridays of January 2024 have rows.
    data = [(dt.datetime(2024, 1, 5, 9), 1.5), (dt.datetime(2024, 1, 5, 10), 2.0),
            (dt.datetime(2024, 1, 19, 9), 4.0), (dt.datetime(2024, 1, 20, 9), 9.0)]
    df = spark.createDataFrame(data, "ts timestamp_ntz, v double")
    obs = rows(op.weekday_totals(df, "ts", "v", weekday=5, month=1, year=2024))
    assert obs == [(D(2024, 1, 5), 3.5), (D(2024, 1, 19), 4.0)]
    cal = rows(op.weekday_totals(df, "ts", "v", weekday=5, month=1, year=2024, spine="calendar"))
    assert cal == [(D(2024, 1, 5), 3.5), (D(2024, 1, 12), 0.0),
                   (D(2024, 1, 19), 4.0), (D(2024, 1, 26), 0.0)]


def test_distinct_count_and_list(spark):
    df = spark.createDataFrame(
        [("bach", 1, "b"), ("bach", 1, "b"), ("bach", 2, "a"), (None, 3, "c"), ("cage", 3, "c")],
        "k string, id long, name string")
    res = rows(op.distinct_count_and_list(df, "k", "id", "name", "n", "names"))
    assert res == [("bach", 2, "a,b"), ("cage", 1, "c")]


def test_percentage_bonus_rounds_half_up(spark):
    df = spark.createDataFrame([("x", Decimal("5.00")), ("y", Decimal("14.90"))], "name string, v decimal(18,2)")
    # 0.50 rounds up to 1, 1.49 down to 1; ties ordered by name
    assert rows(op.percentage_bonus(df, "name", "v", "0.1")) == [("x", 1), ("y", 1)]


def test_star_revenue_filtered(spark):
    fact = spark.createDataFrame([(1, 10, 2.0), (1, 11, 1.0), (2, 10, 5.0)], "h long, d long, q double")
    dim = spark.createDataFrame([(10, "video", 1.5), (11, "audio", 3.0)], "dk long, g string, price double")
    hdr = spark.createDataFrame([(1, 2024), (2, 2023)], "hk long, yr int")
    res = op.star_revenue_filtered(fact, dim, hdr, fact_dim_key="d", dim_key="dk", fact_header_key="h",
                                   header_key="hk", dim_pred=F.col("g").like("%video%"),
                                   header_pred=F.col("yr") == 2024, group="g", price="price", quantity="q")
    assert rows(res) == [("video", 3.0)]


def test_anti_join_spend(spark):
    tx = spark.createDataFrame([(1, 7, 1500.0), (2, 7, 600.0), (3, 8, 3000.0)], "o long, c long, amt double")
    ex = spark.createDataFrame([(3,), (3,)], "o long")
    ent = spark.createDataFrame([(7, "ann"), (8, "bob")], "c long, name string")
    res = op.anti_join_spend(tx, ex, ent, tx_key="o", excluded_key="o", tx_entity="c", entity_key="c",
                             name="name", amount="amt", min_total=2000)
    assert rows(res) == [(7, "ann")]


# -- O6 / O7 / O13 / O30 -------------------------------------------------------

def test_match_points_rules(spark):
    m = match_frame(spark, [(0, 1, 2, 5, 7), (2, 3, 4, 6, 6), (4, 2, 5, None, 3)])
    roster = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "d"), (9, "idle")],
                                   "entity_id long, name string")
    res = {r[0]: (r[1], r[2]) for r in rows(op.match_points(m, roster))}
    assert res == {1: ("a", 3), 2: ("b", 0), 3: ("c", 1), 4: ("d", 1), 5: (None, 0), 9: ("idle", 0)}


def test_argmin_ties_and_nulls(spark):
    m = match_frame(spark, [(9, 1, 2, 4, 4), (3, 1, 5, 4, 1), (7, 6, 8, None, 3), (8, 6, 2, 5, 9),
                            (11, 10, 2, None, 1), (4, 10, 2, None, 1)])
    res = {r[1]: (r[0], r[2]) for r in rows(op.argmin_per_entity(m))}
    assert res[1] == (3, 4)          # equal times: lower match id
    assert res[6] == (8, 5)          # a NULL time loses to a real one
    assert res[10] == (4, None)      # only NULL times: one row, lowest match id


def test_roles_semi_and_union(spark):
    m = match_frame(spark, [(0, 1, 2, 1, 1), (2, 2, 3, 1, 1)])
    ent = spark.createDataFrame([(1, "x"), (2, "y"), (3, "x"), (4, "z")], "k long, n string")
    assert rows(op.semi_any_role(ent, m, key="k", name="n")) == [("x",), ("x",), ("y",)]
    assert rows(op.union_distinct_roles(ent, m, key="k", name="n")) == [("x",), ("y",)]


def test_matches_pairs_even_with_next(spark):
    ev = spark.createDataFrame([(0, 5, 1.7), (1, 6, 2.2), (2, 7, 3.0), (4, 8, 1.0), (5, 9, 1.9)],
                               "event_id long, user_id long, value double")
    assert sorted(rows(matches(ev))) == [(0, 5, 6, 1, 2), (4, 8, 9, 1, 1)]


# -- O23 / O24 ---------------------------------------------------------------

def test_services_worked_example(spark):
    flows = spark.createDataFrame([("LAX", "SFO", 3, True)], "o string, d string, seats int, rt boolean")
    totals = op.two_sided_totals(flows, "o", "d", "seats", "rt")
    assert sorted(rows(totals.select("node", "total"))) == [("LAX", 6), ("SFO", 6)]
    assert rows(op.traffic_top(totals)) == [("LAX",)]
    for method in ("buckets", "window"):
        assert rows(op.percent_rank_totals(totals, method=method)) == [("LAX", 0.0), ("SFO", 0.0)]
    assert rows(op.two_sided_traffic_top1(flows, "o", "d", "seats", "rt")) == [("LAX",)]
    assert rows(op.traffic_percent_rank(flows, "o", "d", "seats", "rt")) == [("LAX", 0.0), ("SFO", 0.0)]
    one_way = op.two_sided_totals(flows.withColumn("rt", F.lit(False)), "o", "d", "seats", "rt")
    assert sorted(rows(one_way.select("node", "total"))) == [("LAX", 3), ("SFO", 3)]


def test_percent_rank_formula_and_ties(spark):
    totals = spark.createDataFrame([("a", 1), ("b", 5), ("c", 5), ("d", 9), ("e", None)],
                                   "node string, total long")
    exp = [("a", 0.0), ("b", 25.0), ("c", 25.0), ("d", 75.0), ("e", 100.0)]
    for method in ("buckets", "window"):
        assert rows(op.percent_rank_totals(totals, method=method)) == exp
    single = totals.where("node = 'a'")
    assert rows(op.percent_rank_totals(single)) == [("a", 0.0)]


def test_percent_rank_buckets_equal_window_random(spark):
    import random
    rnd = random.Random(7)
    data = [(f"n{i}", rnd.choice([rnd.randint(-30, 30), rnd.randint(0, 10**9), None]))
            for i in range(400)]
    totals = spark.createDataFrame(data, "node string, total long")
    b = rows(op.percent_rank_totals(totals, method="window"))
    for n in (2, 64):  # few ranges put many values in one range
        a = rows(op.percent_rank_totals(totals, method="buckets", buckets=n))
        assert sorted(a) == sorted(b)


# -- O9 / O15 / O18 / O22 / O28 / O29 -------------------------------------------

def test_top_with_ties_keeps_all(spark):
    facts = spark.createDataFrame([(1,), (1,), (2,), (2,), (3,)], "k long")
    ent = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k long, n string")
    assert rows(op.top_with_ties(facts, "k", ent, "k", "n")) == [("a",), ("b",)]


def test_max_per_group_ties(spark):
    df = spark.createDataFrame([(1, 10, 5.0), (1, 11, 5.0), (1, 12, 1.0), (2, 13, 2.0)], "g long, i long, v double")
    assert rows(op.max_per_group_ties(df, "g", "i", "v")) == [(1, 10), (1, 11), (2, 13)]
    assert rows(op.max_per_group_ties(df, "g", "i", "v", limit=1)) == [(1, 10)]


def test_daily_max_ties_excludes_null(spark):
    df = spark.createDataFrame([(1, D(2024, 1, 1), 3.0), (2, D(2024, 1, 1), 3.0), (3, D(2024, 1, 1), None),
                                (4, D(2024, 1, 2), None)], "id long, d date, v double")
    assert sorted(rows(op.daily_max_ties(df, "d", "v", "id"))) == [(1,), (2,)]


def test_max_above_max_avg(spark):
    df = spark.createDataFrame([(1, 1, 10.0), (1, 2, 30.0), (2, 3, 18.0), (2, 4, 20.0), (3, 5, 99.0)],
                               "u long, t long, v double")
    # averages 20 and 19; user 3 has one trip; max 30 > 20, max 20 is not
    assert rows(op.max_above_max_avg(df, "u", "t", "v")) == [(1,)]


def test_top_n_and_top_two_global(spark):
    counts = spark.createDataFrame([(1, 1, 5), (1, 2, 5), (1, 3, 4), (1, 4, 1), (2, 1, 3), (2, 2, 2)],
                                   "d int, u long, n long")
    assert rows(op.top_n_per_day(counts, "d", "u", "n", n=2)) == [(1, 1, 5), (1, 2, 5), (1, 3, 4), (2, 1, 3), (2, 2, 2)]
    assert rows(op.top_two_values_global(counts, "d", "u", "n")) == [(1, 1, 5), (1, 2, 5), (1, 3, 4)]


# -- O4 / O14 / O16 / O19 / O20 --------------------------------------------------

def test_strictly_increasing(spark):
    df = spark.createDataFrame([(1, 2000, 1.0), (1, 2001, 2.0), (2, 2000, 2.0), (2, 2001, 2.0),
                                (3, 2005, 9.0), (4, 2000, 3.0), (4, 2003, 1.0)], "k long, y int, v double")
    assert rows(op.strictly_increasing(df, "k", F.col("y"), "v")) == [(1,), (3,)]


def test_nth_exceeds_prior(spark):
    df = spark.createDataFrame([(1, D(2024, 1, 1), 1, 5.0), (1, D(2024, 1, 2), 2, 6.0), (1, D(2024, 1, 3), 3, 7.0),
                                (1, D(2024, 1, 4), 4, 1.0), (2, D(2024, 1, 1), 5, 9.0), (2, D(2024, 1, 1), 6, 1.0),
                                (2, D(2024, 1, 2), 7, 8.0), (3, D(2024, 1, 1), 8, 1.0)],
                               "k long, d date, id long, v double")
    assert rows(op.nth_exceeds_prior(df, "k", ["d", "id"], "v", n=3, date="d")) == [(1, 7.0, D(2024, 1, 3))]


def test_consecutive_days_run_of_five(spark):
    data = [(1, dt.datetime(2024, 1, d, h)) for d in range(3, 8) for h in (1, 2)] + [(1, dt.datetime(2024, 1, 10))]
    df = spark.createDataFrame(data, "u long, ts timestamp_ntz")
    assert rows(op.consecutive_days(df, "u", "ts", n=4)) == [(1, D(2024, 1, 3), D(2024, 1, 6)),
                                                             (1, D(2024, 1, 4), D(2024, 1, 7))]
    assert rows(op.consecutive_days(df, "u", "ts", n=4, mode="islands")) == [(1, D(2024, 1, 3), D(2024, 1, 7))]


def test_largest_gap_ties_and_same_day(spark):
    days = [1, 4, 7, 8] + [9] * 8
    data = [(1, dt.datetime(2024, 1, d), i) for i, d in enumerate(days)]
    data += [(2, dt.datetime(2024, 2, 1, h), 100 + h) for h in range(12)]
    df = spark.createDataFrame(data, "u long, ts timestamp_ntz, id long")
    assert rows(op.largest_gap(df, "u", "ts", 10, count_col="id")) == [(1, 3), (2, 0)]
    rep = rows(op.largest_gap(df, "u", "ts", 10, count_col="id", repeats=True))
    assert rep == [(1, 3), (1, 3)] + [(2, 0)] * 11


def test_first_last_same(spark):
    trips = spark.createDataFrame([(1, 10, D(2024, 1, 1), "A"), (1, 11, D(2024, 1, 5), "B"), (1, 12, D(2024, 1, 9), "A"),
                                   (2, 20, D(2024, 1, 1), "A"), (3, 30, D(2024, 1, 1), "C"), (3, 31, D(2024, 1, 1), "C"),
                                   (4, 40, D(2024, 1, 1), "A"), (4, 41, D(2024, 1, 2), "A")],
                                  "o long, t long, d date, dest string")
    owners = spark.createDataFrame([(1,), (2,), (3,)], "o long")
    res = op.first_last_same(trips, owners, owner="o", trip="t", order=["d"], dest="dest")
    assert rows(res) == [(1,), (3,)]


# -- O11 / O12 -----------------------------------------------------------------

def test_basket_forms_agree(spark):
    df = spark.createDataFrame([(1, "A"), (1, "B"), (2, "A"), (2, "B"), (2, "C"), (3, "A")], "k long, t string")
    assert rows(op.basket_intersect_except(df, "k", "t", ["A", "B"], ["C"])) == [(1,)]
    assert rows(op.basket_intersect_except_sets(df, ["k"], "t", ["A", "B"], ["C"])) == [(1,)]


def test_rolling_rules(spark):
    data = [(1, 1, 1.0), (1, 2, 2.0), (1, 5, 4.0), (1, 6, 8.0), (2, 3, 16.0), (2, 4, 32.0)]
    df = spark.createDataFrame(data, "k long, m int, v double")
    res = rows(op.rolling_dense_sum(df, "k", F.col("m"), "v"))
    assert res == [(1, 5, 4.0), (1, 2, 3.0), (1, 1, 1.0), (2, 3, 16.0)]


def test_rolling_matches_dense_grid_brute_force(spark):
    import random
    rnd = random.Random(3)
    data = [(rnd.randint(0, 6), rnd.choice([1, 2, 3, 5, 8, 9, 12]), float(rnd.randint(1, 9))) for _ in range(120)]
    df = spark.createDataFrame(data, "k long, m int, v double")
    got = rows(op.rolling_dense_sum(df, "k", F.col("m"), "v"))
    keys = sorted({k for k, _, _ in data})
    months = sorted({m for _, m, _ in data})
    tot = {}
    for k, m, v in data:
        tot[(k, m)] = tot.get((k, m), 0.0) + v
    exp = []
    for k in keys:
        grid = [(m, tot.get((k, m), 0.0)) for m in months]
        sums = [(m, t, sum(x for _, x in grid[max(0, i - 2):i + 1])) for i, (m, t) in enumerate(grid)]
        active = [(m, s) for m, t, s in sums if t != 0]
        exp += [(k, m, s) for m, s in sorted(active, reverse=True)[1:]]
    assert got == exp


# -- O27 -----------------------------------------------------------------------

def test_k_hop_path_and_cycle(spark):
    # Z -> Y -> X -> W (follower -> followee) plus a 2-cycle P <-> Q into W.
    e = spark.createDataFrame([("Z", "Y"), ("Y", "X"), ("X", "W"), ("P", "W"), ("Q", "P"), ("P", "Q")],
                              "src string, dst string")
    start = spark.createDataFrame([("W",)], "node string")
    exact = lambda k: [r[0] for r in rows(op.k_hop(e, start, k=k))]
    assert exact(1) == ["P", "X"]
    assert exact(2) == ["Q", "Y"]
    assert exact(3) == ["P", "Z"]
    assert exact(4) == ["Q"]
    within = [r[0] for r in rows(op.k_hop(e, start, k=3, mode="within"))]
    assert within == ["P", "Q", "X", "Y", "Z"]


def test_k_hop_brute_force_and_checkpoint(spark):
    import random
    rnd = random.Random(11)
    edges = sorted({(rnd.randint(0, 25), rnd.randint(0, 25)) for _ in range(60)})
    e = spark.createDataFrame(edges, "src long, dst long")
    start = spark.createDataFrame([(0,)], "node long")
    for k in (1, 3, 5):
        level, seen = {0}, set()
        for _ in range(k):
            level = {s for s, d in edges if d in level}
            seen |= level
        got = [r[0] for r in rows(op.k_hop(e, start, k=k, checkpoint_every=2))]
        assert got == sorted(level)
        got_w = [r[0] for r in rows(op.k_hop(e, start, k=k, mode="within", checkpoint_every=2))]
        assert got_w == sorted(seen)


# -- empty input -------------------------------------------------------------

def test_empty_inputs(spark):
    m = match_frame(spark, [])
    roster = spark.createDataFrame([], "entity_id long, name string")
    assert rows(op.match_points(m, roster)) == []
    assert rows(op.argmin_per_entity(m)) == []
    totals = spark.createDataFrame([], "node string, total long")
    assert rows(op.traffic_top(totals)) == []
    assert rows(op.percent_rank_totals(totals)) == []
    counts = spark.createDataFrame([], "d int, u long, n long")
    assert rows(op.top_two_values_global(counts, "d", "u", "n")) == []
    df = spark.createDataFrame([], "k long, m int, v double")
    assert rows(op.rolling_dense_sum(df, "k", F.col("m"), "v")) == []


def test_max_per_group_ties_compares_raw_values(spark):
    # values closer than a cent must not tie
    df = spark.createDataFrame([(1, 10, 1.001), (1, 11, 1.004)], "g long, i long, v double")
    assert rows(op.max_per_group_ties(df, "g", "i", "v")) == [(1, 11)]


def test_every_operator_accepts_empty_input(spark):
    e = lambda schema: spark.createDataFrame([], schema)
    ev = e("event_id long, ts timestamp_ntz, user_id long, event_type string, value double")
    m = match_frame(spark, [])
    ent = e("k long, n string")
    roster = e("entity_id long, name string")
    flows = e("o string, d string, seats long, rt boolean")
    cases = {
        "children_threshold": op.children_threshold(e("p long"), "p", 2),
        "count_threshold": op.count_threshold(ev, "user_id", 1, must_be_true=[F.col("event_type") == "x"]),
        "weekday_weekend_pivot": op.weekday_weekend_pivot(ev, "ts"),
        "exact_length_count": op.exact_length_count(e("t string"), "t", 3),
        "two_entity_daily_diff": op.two_entity_daily_diff(ev, F.col("ts").cast("date"), "event_type", "a", "b"),
        "star_revenue_filtered": op.star_revenue_filtered(
            e("h long, d long, q double"), e("dk long, g string, price double"), e("hk long"),
            fact_dim_key="d", dim_key="dk", fact_header_key="h", header_key="hk",
            dim_pred=F.lit(True), header_pred=F.lit(True), group="g", price="price", quantity="q"),
        "distinct_count_and_list": op.distinct_count_and_list(e("k string, i long, n string"), "k", "i", "n", "c", "l"),
        "percentage_bonus": op.percentage_bonus(e("name string, v decimal(18,2)"), "name", "v", "0.1"),
        "weekday_totals": op.weekday_totals(ev, "ts", "value", month=1, year=2024),
        "anti_join_spend": op.anti_join_spend(e("o long, c long, amt double"), e("o long"), ent,
                                              tx_key="o", excluded_key="o", tx_entity="c", entity_key="k",
                                              name="n", amount="amt", min_total=1),
        "strictly_increasing": op.strictly_increasing(ev, "user_id", F.year("ts"), "value"),
        "nth_exceeds_prior": op.nth_exceeds_prior(ev, "user_id", ["ts", "event_id"], "value"),
        "consecutive_days": op.consecutive_days(ev, "user_id", "ts"),
        "consecutive_days_islands": op.consecutive_days(ev, "user_id", "ts", mode="islands"),
        "largest_gap": op.largest_gap(ev, "user_id", "ts", 1, repeats=True),
        "first_last_same": op.first_last_same(ev, e("user_id long"), owner="user_id", trip="event_id",
                                              order=["ts"], dest="event_type"),
        "match_points": op.match_points(m, roster),
        "argmin_per_entity": op.argmin_per_entity(m),
        "semi_any_role": op.semi_any_role(ent, m, key="k", name="n"),
        "union_distinct_roles": op.union_distinct_roles(ent, m, key="k", name="n"),
        "two_sided_traffic_top1": op.two_sided_traffic_top1(flows, "o", "d", "seats", "rt", ties=True),
        "traffic_percent_rank": op.traffic_percent_rank(flows, "o", "d", "seats", "rt"),
        "top_with_ties": op.top_with_ties(e("k long"), "k", ent, "k", "n"),
        "max_per_group_ties": op.max_per_group_ties(ev, "user_id", "event_id", "value"),
        "daily_max_ties": op.daily_max_ties(ev, F.col("ts").cast("date"), "value", "event_id"),
        "max_above_max_avg": op.max_above_max_avg(ev, "user_id", "event_id", "value"),
        "top_n_per_day": op.top_n_per_day(e("d date, u long, n long"), "d", "u", "n"),
        "top_two_values_global": op.top_two_values_global(e("d date, u long, n long"), "d", "u", "n"),
        "basket_intersect_except": op.basket_intersect_except(e("k long, t string"), "k", "t", ["A"], ["B"]),
        "basket_intersect_except_sets": op.basket_intersect_except_sets(e("k long, t string"), ["k"], "t", ["A"], ["B"]),
        "rolling_dense_sum": op.rolling_dense_sum(ev, "user_id", F.month("ts"), "value"),
        "k_hop": op.k_hop(e("src long, dst long"), e("node long"), k=2),
    }
    for name, df in cases.items():
        got = rows(df)
        if name == "weekday_weekend_pivot":
            assert got == [(0, 0)], name
        elif name == "exact_length_count":
            assert got == [(0,)], name
        else:
            assert got == [], name


def test_k_hop_stops_on_empty_frontier(spark):
    e = spark.createDataFrame([(1, 0), (2, 1)], "src long, dst long")
    start = spark.createDataFrame([(0,)], "node long")
    assert rows(op.k_hop(e, start, k=40, checkpoint_every=2)) == []
    assert [r[0] for r in rows(op.k_hop(e, start, k=40, mode="within", checkpoint_every=2))] == [1, 2]


def test_invalid_parameters_are_rejected(spark):
    df = spark.createDataFrame([(1, 1, 1.0)], "k long, m int, v double")
    e = spark.createDataFrame([(1, 0)], "src long, dst long")
    start = spark.createDataFrame([(0,)], "node long")
    for call in (lambda: op.k_hop(e, start, k=0, mode="within"),
                 lambda: op.nth_exceeds_prior(df, "k", ["m"], "v", n=3, prior=3),
                 lambda: op.consecutive_days(df, "k", F.lit(None).cast("timestamp_ntz"), n=0),
                 lambda: op.rolling_dense_sum(df, "k", F.col("m"), "v", width=0)):
        with pytest.raises(ValueError):
            call()
