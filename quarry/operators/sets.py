"""Set-algebra and dense-grid operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import exact_sum
from quarry.operators.prefix import dense_index


def basket_intersect_except(rows: DataFrame, key: str, attr: str, have_all, have_none) -> DataFrame:
    """Keys having a row with every value of ``have_all`` and none of
    ``have_none`` (``A INTERSECT B EXCEPT C`` on key sets).

    One aggregation with one boolean flag per value replaces one pipeline
    per set; only rows carrying one of the values are read.
    """
    a = F.col(attr)
    wanted = list(have_all) + list(have_none)
    flags = [F.bool_or(a == v).alias(f"_f{i}") for i, v in enumerate(wanted)]
    g = rows.where(a.isin(*wanted)).groupBy(key).agg(*flags)
    cond = F.lit(True)
    for i in range(len(have_all)):
        cond = cond & F.col(f"_f{i}")
    for j in range(len(have_all), len(wanted)):
        cond = cond & ~F.col(f"_f{j}")
    return g.where(cond).select(key)


def basket_intersect_except_sets(rows: DataFrame, cols: list, attr: str, have_all,
                                 have_none) -> DataFrame:
    """The same question with the set operators themselves: distinct ``cols``
    rows of the first value, ``intersect`` each further value, ``subtract``
    (EXCEPT DISTINCT) each excluded value.  One aggregate marks the values of
    each ``cols`` row in a bit mask, and all sets are taken from it."""
    vals = list(have_all)
    bits = {v: 1 << n for n, v in enumerate(dict.fromkeys([*vals, *have_none]))}
    bit = F.lit(0)
    for v, b in bits.items():
        bit = F.when(F.col(attr) == v, b).otherwise(bit)
    once = rows.where(F.col(attr).isin(*bits)).groupBy(*cols).agg(F.bit_or(bit).alias("_m"))

    def picked(v):
        # a condition on the aggregate is not pushed below it, so the sets share its exchange
        return once.where(F.col("_m").bitwiseAND(bits[v]) != 0).select(*cols)

    res = picked(vals[0]).distinct()
    for v in vals[1:]:
        res = res.intersect(picked(v))
    for v in have_none:
        res = res.subtract(picked(v))
    return res


def rolling_dense_sum(df: DataFrame, key: str, period, value, *, width: int = 3,
                      drop_latest: bool = True, limit: int | None = None,
                      scale: int = 6, sort: bool = True,
                      key_out: str = "part_id", period_out: str = "month",
                      out: str = "part_summary") -> DataFrame:
    """Rolling sum over the current and ``width - 1`` preceding periods of a
    zero-filled key x period grid, reported only for periods in which the key
    was active (total <> 0), without each key's latest active period; ordered
    by key and period descending (or not, with ``sort=False``), first
    ``limit`` rows.  ``value`` is a name or an expression such as price x
    quantity, summed exactly (``exact_sum``).  Rows without a period have no
    place on the grid.

    The grid is never built.  Its periods are the distinct periods of the
    data, so "the 2 preceding grid rows" means the 2 preceding distinct
    periods.  Each period gets its dense index (``dense_index``: ranges of the
    distinct periods, no task with all of them), and the sum is a RANGE frame
    over that index on the active rows: missing grid rows contributed 0
    anyway.  Rows per key are bounded by the number of periods.

    The index is derived from the (key, period) totals themselves, so the
    fact table is scanned and joined once; AQE broadcasts it only if it
    measures it small.
    """
    if width < 1:
        raise ValueError("width must be at least 1")
    # Filtering rows without a period here, once, also keeps the two branches
    # below identical (the optimizer would otherwise infer the filter for one).
    e = exact_sum(df, value, scale)
    totals = (df.where(period.isNotNull())
                .groupBy(F.col(key).alias(key_out), period.alias(period_out)).agg(*e.sums("_t")))
    # The periods are read off the totals.  A bare distinct (or an unused
    # aggregate) lets the optimizer drop the per-(key, period) aggregate and
    # re-read the fact rows; consuming every sum (counts are >= 0) keeps the
    # aggregate whole, so both branches share one exchange.
    kept = F.lit(0)
    for c in e.names("_t"):
        kept = kept + F.count(c)
    periods = totals.groupBy(period_out).agg(kept.alias("_keys")).where(F.col("_keys") >= 0).select(period_out)
    index = dense_index(periods, period_out, "_i")
    active = totals.where(e.nonzero(e.total("_t"))).join(index, period_out)
    frame = Window.partitionBy(key_out).orderBy("_i").rangeBetween(-(width - 1), 0)
    res = active.withColumns({c: F.sum(c).over(frame) for c in e.names("_t")}).withColumn("_s", e.total("_t"))
    if drop_latest:
        ahead = Window.partitionBy(key_out).orderBy("_i")  # the frame's own sort
        res = res.withColumn("_next", F.lead("_i").over(ahead)).where(F.col("_next").isNotNull())
    res = res.select(key_out, period_out, e.to_double(F.col("_s")).alias(out))
    if sort or limit is not None:
        res = res.orderBy(F.col(key_out).asc(), F.col(period_out).desc())
    return res.limit(limit) if limit is not None else res
