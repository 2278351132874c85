"""Property tests: operators against plain-Python brute force on random input."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry import operators as op

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])
BASE = dt.date(2024, 1, 1)

events = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 20), st.integers(0, 23)),
                  min_size=0, max_size=60)


def frame(spark, evs):
    data = [(u, dt.datetime(2024, 1, 1, h) + dt.timedelta(days=d), i) for i, (u, d, h) in enumerate(evs)]
    return spark.createDataFrame(data, "u long, ts timestamp_ntz, id long")


@SETTINGS
@given(evs=events, n=st.integers(2, 4))
def test_consecutive_days_brute_force(spark, evs, n):
    days = {}
    for u, d, _ in evs:
        days.setdefault(u, set()).add(d)
    windows, islands = [], []
    for u, ds in days.items():
        for d in ds:
            if all(d + j in ds for j in range(n)):
                windows.append((u, BASE + dt.timedelta(d), BASE + dt.timedelta(d + n - 1)))
            if d - 1 not in ds:
                e = d
                while e + 1 in ds:
                    e += 1
                if e - d + 1 >= n:
                    islands.append((u, BASE + dt.timedelta(d), BASE + dt.timedelta(e)))
    df = frame(spark, evs)
    got_w = [tuple(r) for r in op.consecutive_days(df, "u", "ts", n=n).collect()]
    got_i = [tuple(r) for r in op.consecutive_days(df, "u", "ts", n=n, mode="islands").collect()]
    assert got_w == sorted(windows)
    assert got_i == sorted(islands)


@SETTINGS
@given(evs=events, k=st.integers(0, 6))
def test_largest_gap_brute_force(spark, evs, k):
    per = {}
    for u, d, h in evs:
        per.setdefault(u, []).append((d, h))
    exp, exp_rep = [], []
    for u, xs in per.items():
        if len(xs) <= k:
            continue
        ds = sorted(d for d, _ in xs)
        gaps = [b - a for a, b in zip(ds, ds[1:])]
        if not gaps:
            continue
        m = max(gaps)
        exp.append((u, m))
        exp_rep += [(u, m)] * gaps.count(m)
    df = frame(spark, evs)
    got = [tuple(r) for r in op.largest_gap(df, "u", "ts", k, count_col="id").collect()]
    rep = [tuple(r) for r in op.largest_gap(df, "u", "ts", k, count_col="id", repeats=True).collect()]
    assert got == sorted(exp)
    assert rep == sorted(exp_rep)


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 3), st.integers(2000, 2005),
                               st.integers(0, 500).map(lambda c: c / 100)), max_size=40))
def test_strictly_increasing_brute_force(spark, rows):
    tot = {}
    for k, y, v in rows:
        tot[(k, y)] = tot.get((k, y), 0) + round(v * 100)
    exp = []
    for k in sorted({k for k, _, _ in rows}):
        seq = [tot[(k, y)] for y in sorted(y for kk, y in tot if kk == k)]
        if all(b > a for a, b in zip(seq, seq[1:])):
            exp.append((k,))
    df = spark.createDataFrame(rows, "k long, y int, v double")
    assert [tuple(r) for r in op.strictly_increasing(df, "k", F.col("y"), "v").collect()] == exp
