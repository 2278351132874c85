"""Ranks over all rows together: prefix sums over ranges of the values.

A rank without a group needs the number of rows before each value.  The
distinct values are dealt into ranges by edges drawn from themselves, counted
by range, and a running sum inside each range goes on from the sum of the
ranges before it.  Any edges give exact sums; drawn ones make even ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_DRAWS = 16  # values drawn for each edge: ranges then differ little


def _with_range(rows: DataFrame, value: str, edges: Column, ranges: int) -> DataFrame:
    """Adds ``_b``, how many of the sorted ``edges`` are at or below ``value``, by halving; NULLs come after all ranges."""
    steps = ", ".join(str(1 << b) for b in reversed(range((ranges - 1).bit_length())))
    found = F.expr(f"CASE WHEN `{value}` IS NULL THEN {ranges} ELSE "
                   f"aggregate(array({steps}), 0, (n, s) -> CASE WHEN get(_edges, n + s - 1) <= `{value}` THEN n + s ELSE n END) END")
    return rows.withColumn("_edges", edges).withColumn("_b", found).drop("_edges")


def cut_into_ranges(rows: DataFrame, value: str, ranges: int) -> DataFrame:
    """Adds ``_b``, the number of a row's range of ``value`` (any orderable type; NULLs come last, as range ``ranges``).

    ``ranges`` - 1 edges stand evenly among 16 times as many values drawn by
    hash: a one-row subquery over the smallest hashes of each task.
    """
    if ranges < 2:
        raise ValueError("ranges must be at least 2")
    v = F.col(value)
    drawn = rows.where(v.isNotNull()).orderBy(F.xxhash64(v), v).limit(_DRAWS * ranges).agg(F.sort_array(F.collect_list(v)).alias("d"))
    edges = drawn.select(F.expr(f"slice(filter(d, (x, i) -> (i + 1) % greatest(1, size(d) div {ranges}) = 0), 1, {ranges - 1})")).scalar()
    return _with_range(rows, value, edges, ranges)


def prefix_sums(values: DataFrame, value: str, weight: Column | None = None, ranges: int = 256) -> DataFrame:
    """Adds ``_before``, the weights of all rows with smaller values, and ``_all``, those of all rows.

    ``values`` has one row per distinct value of any orderable type (a
    histogram); NULL comes last.  ``weight`` (1 by default) is a long.

    Plan: ``cut_into_ranges``; sums per range (a one-row subquery, at most
    ``ranges`` + 1 longs); then one exchange by range and a running sum inside
    each.  No task sees all values, and nothing is collected by the driver.
    """
    rows = values.withColumn("_w", F.lit(1).cast("long") if weight is None else weight.cast("long"))
    v = F.col(value)
    dealt = cut_into_ranges(rows, value, ranges)
    sums = dealt.groupBy("_b").agg(F.sum("_w").alias("_s")).agg(F.collect_list(F.struct("_b", "_s")).alias("s"))
    upto = f"transform(sequence(0, {ranges + 1}), i -> aggregate(filter(s, x -> x._b < i), 0L, (a, x) -> a + x._s))"
    offsets = sums.select(F.expr(upto).alias("o")).scalar()
    inside = Window.partitionBy("_b").orderBy(v.asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    summed = dealt.withColumn("_in", F.coalesce(F.sum("_w").over(inside), F.lit(0))).withColumn("_o", offsets)
    return summed.withColumns({"_before": F.get("_o", F.col("_b")) + F.col("_in"), "_all": F.get("_o", F.lit(ranges + 1))}).drop("_w", "_b", "_in", "_o")


def dense_index(values: DataFrame, value: str, out: str, ranges: int = 256) -> DataFrame:
    """Adds ``out``, the dense rank (from 1) of each distinct value; see ``prefix_sums``."""
    return prefix_sums(values, value, ranges=ranges).withColumn(out, F.col("_before") + 1).drop("_before", "_all")


def top_values(rows: DataFrame, group: Column, value: Column, spread: Column, keep: dict[str, Column], n: int = 1,
               nulls_first: bool = False, salts: int = 32) -> DataFrame:
    """The columns ``keep`` of the rows whose value is among their group's ``n`` largest distinct values (``DENSE_RANK() <= n``), all ties.

    NULL groups are one group.  NULL values are one value, the smallest, or
    with ``nulls_first`` the largest.

    Two stages, so that a group of any size, ties included, is never in one
    task: rows are dealt by (group, salt), where ``spread`` makes the salt,
    and ranked there (pruned in each task before the exchange); the few values
    that each part leaves, not rows, are ranked by group, and each part keeps
    what reaches the group's lowest.  The rows are read and moved once.
    ``salts=1`` is for groups that are small by construction (the lines of an
    order): one stage.
    """
    if salts < 1 or salts & salts - 1:
        raise ValueError("salts must be a power of two")
    order = value.desc_nulls_first() if nulls_first else value.desc_nulls_last()
    if salts == 1:
        ranked = rows.select(F.dense_rank().over(Window.partitionBy(group).orderBy(order)).alias("_r"), *[c.alias(k) for k, c in keep.items()])
        return ranked.where(F.col("_r") <= n).drop("_r")
    first = value.isNull() if nulls_first else value.isNotNull()
    # a struct is never NULL itself: it can be a join key and is compared field by field
    keyed = rows.select(F.struct(group.alias("g")).alias("_g"), F.struct(first.alias("f"), value.alias("v")).alias("_v"),
                        F.xxhash64(spread).bitwiseAND(salts - 1).alias("_salt"), *[c.alias(k) for k, c in keep.items()])
    part = Window.partitionBy("_g", "_salt").orderBy(F.desc("_v"))
    kept = keyed.withColumn("_r", F.dense_rank().over(part)).where(F.col("_r") <= n).drop("_r")
    # the hash of all columns keeps both branches alike, so that they share one exchange
    all_of = F.max(F.xxhash64(*[F.col(f"`{c}`") for c in keep]))
    found = kept.groupBy("_g", "_salt", "_v").agg(all_of.alias("_x")).where(F.col("_x").isNotNull())
    whole = Window.partitionBy("_g").orderBy(F.desc("_v"))
    lowest = (found.withColumn("_r", F.dense_rank().over(whole)).where(F.col("_r") <= n)
                   .groupBy("_g", "_salt").agg(F.min("_v").alias("_low")))
    return kept.join(lowest, ["_g", "_salt"]).where(F.col("_v") >= F.col("_low")).drop("_g", "_salt", "_v", "_low")
