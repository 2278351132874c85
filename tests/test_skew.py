"""A key holding a third of all rows must not travel whole through a shuffle.

Each case builds input where one key has 1/3 of the rows, checks the result,
and reads the shuffle metrics of the final adaptive plan: the hot key's rows
are cut (per-task top-n, per-day collapse, partial aggregation) before any
exchange, so no exchange writes anywhere near the hot key's row count.
"""

import datetime as dt

from quarry import operators as op

N = 30000          # rows
HOT = N // 3       # rows of the hot key
SLICES = 8         # input partitions (createDataFrame from a local list)


def exchange_records(df):
    """shuffleRecordsWritten of every exchange in the final plan."""
    out = []

    def walk(p):
        name = p.nodeName()
        if "Exchange" in name:
            ms = p.metrics()
            if ms.contains("shuffleRecordsWritten"):
                out.append(ms.apply("shuffleRecordsWritten").value())
        ch = p.children()
        for i in range(ch.size()):
            walk(ch.apply(i))
        if name.endswith("QueryStage"):
            walk(p.plan())
        if name == "AdaptiveSparkPlan":
            walk(p.executedPlan())

    walk(df._jdf.queryExecution().executedPlan())
    return out


def skewed(spark, schema, hot_row, cold_row):
    rows = [hot_row(i) if i < HOT else cold_row(i) for i in range(N)]
    return spark.createDataFrame(spark.sparkContext.parallelize(rows, SLICES), schema)


def test_nth_transaction_hot_customer(spark):
    # hot customer 0 has 10k transactions; every other customer has 2
    base = dt.date(2024, 1, 1)
    df = skewed(spark, "k long, d date, id long, v double",
                lambda i: (0, base + dt.timedelta(days=i), i, float(i)),
                lambda i: (1 + i // 2, base, i, float(i % 7)))
    res = op.nth_exceeds_prior(df, "k", ["d", "id"], "v", n=3, date="d")
    assert [tuple(r) for r in res.collect()] == [(0, 2.0, base + dt.timedelta(days=2))]
    cold = N - HOT
    assert max(exchange_records(res)) <= cold + 3 * SLICES


def test_largest_gap_hot_user(spark):
    # hot user 0 has 10k events over 50 days (every other day); each cold
    # user has two events on one day and two on the next
    day = dt.datetime(2024, 1, 1)
    df = skewed(spark, "u long, ts timestamp_ntz, id long",
                lambda i: (0, day + dt.timedelta(days=(i % 50) * 2, seconds=i), i),
                lambda i: (1 + (i - HOT) // 4, day + dt.timedelta(days=(i % 4) // 2, seconds=i), i))
    res = op.largest_gap(df, "u", "ts", 3, count_col="id")
    got = dict(tuple(r) for r in res.collect())
    assert got[0] == 2 and set(got.values()) == {1, 2} and len(got) == 1 + (N - HOT) // 4
    # one row per (user, day) and task: 50 per task for the hot user, half
    # the cold rows (plus pairs split at task borders)
    bound = (N - HOT) // 2 + 50 * SLICES + 2 * SLICES
    assert max(exchange_records(res)) <= bound < N - HOT


def test_match_points_hot_player(spark):
    # player 0 plays a third of all matches
    df = skewed(spark, "match_id long, one_id long, two_id long, one_time long, two_time long",
                lambda i: (i, 0, 1 + i % 500, 1, 2),
                lambda i: (i, 1 + i % 500, 1 + (i + 1) % 500, i % 3, i % 5))
    roster = spark.createDataFrame([(0, "hot")], "entity_id long, name string")
    res = op.match_points(df, roster)
    top = res.collect()[0]
    assert (top[0], top[1], top[2]) == (0, "hot", 3 * HOT)
    # partial sums: one row per player and task
    assert max(exchange_records(res)) <= SLICES * 501 + 1


def rows_per_task(df):
    """Rows of each task of ``df``'s last stage."""
    return sorted(df.rdd.mapPartitions(lambda it: [sum(1 for _ in it)]).collect())


def test_hot_target_is_dealt_over_many_parts(spark):
    """A node followed by a third of all edges: k-hop deals its edges over parts in proportion to its degree."""
    from pyspark.sql import functions as F
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    old = {c: spark.conf.get(c) for c in conf}
    for c, v in conf.items():
        spark.conf.set(c, v)
    try:
        n = 60000
        edges = spark.range(n).select(F.col("id").alias("src"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000).alias("dst"))
        start = spark.createDataFrame([(0,)], "node long")
        hot = sum(1 for i in range(n) if i % 3 == 0 or i % 5000 == 0)
        res = op.k_hop(edges, start, k=1)
        assert res.count() == hot
        from quarry.operators.graph import _hot_targets
        e = edges.select(F.col("src").alias("_s"), F.col("dst").alias("_d"))
        found = _hot_targets(e, 256).collect()
        assert [tuple(r) for r in found] == [(0, -(-hot * 256 // n))]
        dealt = e.select("_d", F.when(F.col("_d") == 0, F.pmod(F.xxhash64("_s"), F.lit(found[0]["_parts"]))).otherwise(0).alias("_part"))
        sizes = rows_per_task(dealt.repartition(16, "_d", "_part"))
        assert sizes[-1] < 2 * n / 16  # without parts the hot node's task alone would have a third
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)


def test_one_key_with_all_rows_is_scanned_in_ranges(spark):
    """Lags and running sums of one key with all rows: no task sees much more than a range, and the window agrees."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    df = spark.range(20000, numPartitions=8).select(
        F.lit(7).alias("k"), F.pmod(F.xxhash64("id"), F.lit(1000)).alias("t"), "id", F.when(F.col("id") % 5 > 0, F.col("id") % 97 * 0.01).alias("v"))
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        res = op.sequence_scan(df, "k", ["t", "id"], lags={"a": ("v", 1), "b": ("id", 5)}, running={"s": "v"}, ranges=64, scale=2)
        w = Window.partitionBy("k").orderBy("t", "id")
        total = F.sum(F.col("v").cast("decimal(18,2)")).over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("double")
        want = df.withColumns({"a": F.lag("v").over(w), "b": F.lag("id", 5).over(w), "s": total})
        assert sorted(map(tuple, res.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
        assert rows_per_task(res)[-1] < 20000 / 2  # 64 ranges over 8 tasks
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def test_sequences_over_many_keys_equal_the_window(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    df = spark.range(900, numPartitions=5).select(
        F.when(F.col("id") % 7 > 0, F.floor(F.sqrt("id")) % 11).alias("k"), "id", (F.col("id") * 0.25).alias("v"), F.col("id").cast("string").alias("w"))
    w = Window.partitionBy("k").orderBy("id")
    for ranges in (2, 9, 300):
        res = op.sequence_scan(df, "k", ["id"], lags={"a": ("w", 3), "b": ("v", 1)}, running={"s": "v", "n": "id"}, ranges=ranges)
        run = w.rowsBetween(Window.unboundedPreceding, 0)
        want = df.withColumns({"a": F.lag("w", 3).over(w), "b": F.lag("v").over(w), "s": F.sum("v").over(run), "n": F.sum("id").over(run).cast("double")})
        assert sorted(map(tuple, res.collect()), key=str) == sorted(map(tuple, want.collect()), key=str), ranges
    assert op.sequence_scan(df.limit(0), "k", ["id"], lags={"a": ("w", 3)}, running={"s": "v"}).count() == 0
