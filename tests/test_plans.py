"""Plan assertions: the scale designs show up in the physical plans."""

from quarry.plans.catalog import CATALOG

from conftest import SF01


def plan(spark, key):
    df = CATALOG[key](spark, SF01)
    return df._jdf.queryExecution().executedPlan().toString()


def test_semi_any_role_has_no_nested_loop(spark):
    p = plan(spark, "semi_any_role")
    assert "NestedLoopJoin" not in p
    assert "LeftSemi" in p


def test_top_with_ties_has_no_global_window(spark):
    assert "Window" not in plan(spark, "top_with_ties")


def test_no_cartesian_products_anywhere(spark):
    for key in CATALOG:
        p = plan(spark, key)
        assert "CartesianProduct" not in p, key
        assert "NestedLoopJoin" not in p, key


def test_rank_filters_become_group_limits(spark):
    for key in ("top_n_per_day", "nth_exceeds_prior"):
        assert "WindowGroupLimit" in plan(spark, key), key


def test_year_filter_reaches_the_scan(spark):
    p = plan(spark, "star_revenue_filtered")
    assert "GreaterThanOrEqual(o_orderdate" in p and "LessThan(o_orderdate" in p


def test_scans_read_only_needed_columns(spark):
    p = plan(spark, "children_threshold")
    assert "ReadSchema: struct<o_custkey:bigint,o_orderstatus:string>" in p


def test_percent_rank_windows_are_partitioned_by_range(spark):
    import re
    p = plan(spark, "traffic_percent_rank")
    windows = [w for w in re.findall(r"\bWindow \[[^\n]*", p) if "sum(_w" in w]
    assert windows and all("[_b#" in w for w in windows)


def test_basket_flags_are_plain_hash_aggregates(spark):
    assert "ObjectHashAggregate" not in plan(spark, "basket_intersect_except")


def test_each_base_table_is_scanned_once(spark):
    """Branches that need the same aggregate share its exchange: in the final
    adaptive plan every base table is scanned once."""
    import collections
    import re
    for key in CATALOG:
        df = CATALOG[key](spark, SF01)
        df.collect()
        p = df._jdf.queryExecution().executedPlan().toString()
        if "== Final Plan ==" in p:
            p = p.split("== Final Plan ==")[1].split("== Initial Plan ==")[0]
        scans = collections.Counter(re.findall(r"FileScan parquet \[[^\]]*\][^\n]*?/(\w+)\.parquet", p))
        assert all(n == 1 for n in scans.values()), (key, dict(scans))


def test_month_and_day_filters_reach_the_scan(spark):
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")  # untruncated scan metadata
    try:
        assert "GreaterThanOrEqual(ts,2024-01-01" in plan(spark, "weekday_totals")
        p = plan(spark, "top_n_per_day")
        assert "GreaterThanOrEqual(ts,2024-01-05" in p and "LessThan(ts,2024-01-07" in p
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)


def test_bucketed_tables_are_joined_and_grouped_without_exchange(spark, tmp_path):
    """lineitem, bucketed by its order key, is not shuffled for O14 nor for the join of O12."""
    import re
    from quarry.plans.check import digest
    from quarry.sources import Tables, write_bucketed
    old = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold",)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # joins as between large tables
    spark.sql(f"CREATE DATABASE IF NOT EXISTS bucket_test LOCATION '{tmp_path}'")
    try:
        write_bucketed(Tables(spark, SF01), "bucket_test.b", buckets=8)
        for key in ("nth_exceeds_prior", "rolling_dense_sum_all"):
            df = CATALOG[key](spark, "table:bucket_test.b")
            p = df._jdf.queryExecution().executedPlan().toString()
            assert not re.search(r"hashpartitioning\((l_orderkey|o_orderkey)#", p), key
            assert "Bucketed: true" in p
            plain = CATALOG[key](spark, SF01)
            assert digest(df.columns, [tuple(r) for r in df.collect()]) == digest(plain.columns, [tuple(r) for r in plain.collect()])
    finally:
        spark.sql("DROP DATABASE bucket_test CASCADE")
        for c, v in old.items():
            spark.conf.set(c, v)


def test_a_changed_file_has_its_new_schema(spark, tmp_path):
    import os

    from quarry.sources import Tables

    spark.range(3).toPandas().to_parquet(tmp_path / "part.parquet")
    assert Tables(spark, str(tmp_path)).part.columns == ["id"] == Tables(spark, str(tmp_path)).part.columns
    spark.range(3).selectExpr("id AS other", "'x' AS more").toPandas().to_parquet(tmp_path / "part.parquet")
    os.utime(tmp_path / "part.parquet", (1, 1))
    assert Tables(spark, str(tmp_path)).part.columns == ["other", "more"]
    spark.range(3).write.parquet(str(tmp_path / "orders.parquet"))  # a folder is asked each time
    assert Tables(spark, str(tmp_path)).orders.columns == ["id"]
    spark.range(3).selectExpr("id AS other").write.mode("overwrite").parquet(str(tmp_path / "orders.parquet"))
    assert Tables(spark, str(tmp_path)).orders.columns == ["other"]
