"""Ranking operators: top-k with ties, per-group maxima, global comparisons.

Global maxima are 1-row scalar subqueries (``DataFrame.scalar()``), never a
window without ``PARTITION BY`` over the data.  Maxima of groups are found in
two salted stages, so ties never meet in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import exact_sum
from quarry.operators.prefix import prefix_sums, top_values


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def top_with_ties(facts: DataFrame, key: str, entities: DataFrame, entity_key: str,
                  label: str, out: str = "name") -> DataFrame:
    """Label(s) of the entities with the most fact rows, all ties kept.

    Rows are counted per key (map-side combined), joined to the entities
    (inner, as in the question) and compared with the 1-row maximum.
    """
    counts = (facts.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
                   .join(entities.select(F.col(entity_key).alias("_k"), F.col(label).alias(out)),
                         "_k"))
    # The subquery returns a struct over every column the main branch reads,
    # so column pruning leaves both branches identical and the subquery
    # reuses the main branch's exchanges instead of re-reading the inputs.
    top = counts.agg(F.struct(F.max("_n").alias("n"), F.max(out).alias("l"))).scalar()
    return counts.where(F.col("_n") == top.getField("n")).select(out)


def max_per_group_ties(df: DataFrame, group: str, item: str, value: str,
                       limit: int | None = None, sort: bool = True, group_out: str = "order_id",
                       item_out: str = "part_id", nulls_first: bool = False, salts: int = 32) -> DataFrame:
    """All rows holding their group's maximum ``value`` (ties kept, duplicate
    rows kept); ``limit`` keeps the first rows by (group, item); without a limit
    ``sort=False`` saves the sort of the whole result.

    Rows without a group are one group.  A NULL value is below every other, so
    a group of NULL values returns all its rows; with ``nulls_first`` it is
    above every other, as ``ORDER BY value DESC`` has it where NULLs sort high.
    ``salts`` parts share a group of any size (``top_values``).
    """
    res = top_values(df, F.col(group), F.col(value), F.col(item), {group_out: F.col(group), item_out: F.col(item)},
                     nulls_first=nulls_first, salts=salts)
    if limit is not None:
        return res.orderBy(group_out, item_out).limit(limit)
    return res.orderBy(group_out, item_out) if sort else res


def daily_max_ties(df: DataFrame, day, value, id_col: str, out: str = "event_id") -> DataFrame:
    """Rows holding the maximum ``value`` of their day (NULL values excluded,
    rows without a day are one group), all ties kept, in no order."""
    rows = df.where(_col(value).isNotNull())
    return top_values(rows, _col(day), _col(value), F.col(id_col), {out: F.col(id_col)})


def max_above_max_avg(df: DataFrame, key: str, trip: str, value,
                      min_trips: int = 2, scale: int = 6, out: str = "user_id") -> DataFrame:
    """Keys with at least ``min_trips`` distinct trips whose maximum value is
    strictly greater than the largest per-key average (over the same keys).

    Two combinable aggregates, (key, trip) then key, stand in for a
    count-distinct next to avg/max; the largest average is a scalar subquery.
    Sums are exact (``exact_sum``), and a maximum is compared with an average
    by multiplying it with the count, not by dividing.
    """
    e = exact_sum(df, value, scale)
    per_trip = (df.groupBy(F.col(key).alias("_k"), F.col(trip).alias("_t"))
                  .agg(*e.sums("_s"), F.count(_col(value)).alias("_c"), F.max(_col(value)).alias("_m")))
    per_key = (per_trip.groupBy("_k")
                       .agg(F.count("_t").alias("_trips"), *e.resum("_s"), F.sum("_c").alias("_c"), F.max("_m").alias("_m"))
                       .where((F.col("_trips") >= min_trips) & (F.col("_c") > 0))
                       .select("_k", "_c", "_m", e.total("_s").alias("_sum")))
    # Both branches must read the same columns of ``per_key`` for column
    # pruning to leave their aggregates identical, so that the subquery
    # reuses the main branch's exchange instead of re-reading the input.
    if e.limbs:
        average = F.struct((e.to_double(F.col("_sum")) / F.col("_c")).alias("avg"), "_sum", "_c", "_m")
        best = per_key.agg(F.max(average)).scalar()
        # both sides times the count of the best: whole limbs, no rounding
        mine = exact_sum(per_key, "_m", scale).scaled(best.getField("_c")).one()
        return per_key.where(mine > best.getField("_sum")).select(F.col("_k").alias(out))
    best = per_key.agg(F.max(F.struct((F.col("_sum") / F.col("_c")).alias("avg"), "_m"))).scalar()
    return per_key.where(F.col("_m") > best.getField("avg")).select(F.col("_k").alias(out))


def two_sided_totals(flows: DataFrame, origin: str, dest: str, amount: str,
                     round_trip: str | None = None, scale: int = 6) -> DataFrame:
    """Total per node counted at both ends of each flow, doubled for round
    trips: (node, total, exact).  One scan; each flow becomes two rows that are
    summed map-side.  ``exact`` orders as the totals do (``exact_sum``)."""
    weight = F.when(F.col(round_trip), 2).otherwise(1) if round_trip else F.lit(1)
    e = exact_sum(flows, amount, scale)
    flows = flows.withColumn("_ends", F.array(F.col(origin), F.col(dest))).withColumn("_weight", weight.cast("long"))
    ends = flows.select(F.explode("_ends").alias("node"), F.col(amount), "_weight")
    totals = ends.groupBy("node").agg(*e.scaled(F.col("_weight")).sums("_a")).select("node", e.total("_a").alias("exact"))
    return totals.select("node", e.to_number(F.col("exact")).alias("total"), "exact")


def _order_of(totals: DataFrame) -> str:
    return "exact" if "exact" in totals.columns else "total"


def traffic_top(totals: DataFrame, ties: bool = False, out: str = "airport") -> DataFrame:
    """The node with the largest total (NULL totals dropped).  Ties go to the
    smallest node id unless ``ties=True``, which returns all of them."""
    value = _order_of(totals)
    t = totals.where(F.col(value).isNotNull())
    if ties:
        best = t.agg(F.max(value)).scalar()
        return t.where(F.col(value) == best).select(F.col("node").alias(out)).orderBy(out)
    return (t.orderBy(F.col(value).desc(), F.col("node").asc())
             .limit(1)
             .select(F.col("node").alias(out)))


def _rounded_percent(rank_minus_one: Column, n_minus_one: Column) -> Column:
    """``round((rank - 1) * 100 / (n - 1), 1)`` with halves away from zero,
    in exact integer arithmetic; 0 when there is a single row."""
    num = rank_minus_one.cast("long") * 2000 + n_minus_one
    den = n_minus_one * 2
    tenths = (num - F.pmod(num, den)) / den
    return F.when(n_minus_one <= 0, F.lit(0.0)).otherwise(tenths / F.lit(10.0))


def percent_rank_of(totals: DataFrame, value: str = "total", method: str = "buckets",
                    buckets: int = 256) -> DataFrame:
    """Adds ``_rm1`` (rank - 1, ascending, ties share the lowest rank, NULLs
    last) and ``_nm1`` (rows - 1) to ``totals``.

    ``method='window'`` uses ``rank()`` over one global window: one task,
    right when the rows are few by construction (a fixed node domain).
    ``method='buckets'`` is the scale form.  The rank of a value is one plus
    the number of rows with a smaller value, so it only depends on the
    histogram of distinct values (a value shared by a third of all rows is
    one histogram row): ``prefix_sums`` over ``buckets`` ranges of it, joined
    to the rows by value.
    """
    if method == "window":
        w = Window.orderBy(F.col(value).asc_nulls_last())
        return (totals.withColumn("_rm1", (F.rank().over(w) - 1).cast("long"))
                      .withColumn("_nm1", F.count(F.lit(1)).over(Window.partitionBy()) - 1))
    if method != "buckets":
        raise ValueError(f"unknown method {method!r}")
    hist = totals.groupBy(F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    ranks = prefix_sums(hist, "_v", F.col("_c"), buckets)
    ranks = ranks.select("_v", F.col("_before").alias("_rm1"), (F.col("_all") - 1).alias("_nm1"))
    return totals.join(ranks, F.col(value).eqNullSafe(F.col("_v"))).drop("_v")


def percent_rank_totals(totals: DataFrame, method: str = "buckets", buckets: int = 256,
                        out: str = "airport", rank_out: str = "percent_rank") -> DataFrame:
    """Percent rank of each (node, total) row, ``(rank - 1) * 100 / (n - 1)``
    rounded to one decimal; ascending; ties share a rank."""
    ranked = percent_rank_of(totals, _order_of(totals), method=method, buckets=buckets)
    pr = _rounded_percent(F.col("_rm1"), F.col("_nm1"))
    return (ranked.select(F.col("node").alias(out), pr.alias(rank_out))
                  .orderBy(rank_out, out))


def two_sided_traffic_top1(flows: DataFrame, origin: str, dest: str, amount: str,
                           round_trip: str | None = None, ties: bool = False, scale: int = 6,
                           out: str = "airport") -> DataFrame:
    """The node with the most traffic, counting each flow at both ends and
    twice for round trips (``two_sided_totals`` then ``traffic_top``)."""
    return traffic_top(two_sided_totals(flows, origin, dest, amount, round_trip, scale), ties=ties, out=out)


def traffic_percent_rank(flows: DataFrame, origin: str, dest: str, amount: str,
                         round_trip: str | None = None, method: str = "buckets",
                         buckets: int = 256, scale: int = 6, out: str = "airport",
                         rank_out: str = "percent_rank") -> DataFrame:
    """Percent rank of every node's two-sided traffic (``two_sided_totals``
    then ``percent_rank_totals``)."""
    totals = two_sided_totals(flows, origin, dest, amount, round_trip, scale)
    return percent_rank_totals(totals, method=method, buckets=buckets, out=out,
                               rank_out=rank_out)


def day_counts(df: DataFrame, day, key: str, count_col: str,
               day_out: str = "day", out: str = "num_posts") -> DataFrame:
    """Rows per (day, key), counting non-null ``count_col``."""
    return (df.groupBy(_col(day).alias(day_out), F.col(key))
              .agg(F.count(F.col(count_col)).alias(out)))


def top_n_per_day(counts: DataFrame, day: str, key: str, value: str, n: int = 2) -> DataFrame:
    """Per day, the rows whose value is among the ``n`` largest distinct
    values of that day (all ties), in order of day and key.

    Rows without a day are one group; a NULL value is the smallest value.
    """
    keep = {c: F.col(c) for c in (day, key, value)}
    return top_values(counts, F.col(day), F.col(value), F.col(key), keep, n=n).orderBy(day, key)


def top_two_values_global(counts: DataFrame, day: str, key: str, value: str) -> DataFrame:
    """Rows holding the largest or the second-largest value over all days
    together (two nested 1-row scalar subqueries)."""
    v = F.col(value)
    best = counts.agg(F.max(value)).scalar()
    second = counts.where(v != best).agg(F.max(value)).scalar()
    return (counts.where((v == best) | (v == second))
                  .select(day, key, value)
                  .orderBy(day, key))
