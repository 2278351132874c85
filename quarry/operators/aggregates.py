"""Filter-and-aggregate operators: one scan, a map-side combined aggregate,
a filter on the result.  A key holding a third of all rows costs nothing
extra: partial aggregation collapses it to one row per map task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions import is_false, is_true, iso_weekday


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def children_threshold(df: DataFrame, parent, k: int, out: str = "parent_id") -> DataFrame:
    """Parents with at least ``k`` non-null child rows (``COUNT(parent) >= k``).

    The NULL parent forms no group: ``COUNT(parent)`` is 0 there.
    """
    p = _col(parent)
    return (df.where(p.isNotNull())
              .groupBy(p.alias(out))
              .agg(F.count(F.lit(1)).alias("_n"))
              .where(F.col("_n") >= k)
              .select(out)
              .orderBy(out))


def count_threshold(df: DataFrame, key: str, k: int, count_col: str | None = None,
                    must_be_true=(), must_be_false=()) -> DataFrame:
    """Keys with at least ``k`` counted rows after three-valued boolean filters.

    ``must_be_true`` / ``must_be_false`` are boolean columns tested with
    ``IS TRUE`` / ``IS FALSE``: a NULL flag passes neither.
    """
    conds = [is_true(_col(c)) for c in must_be_true] + \
            [is_false(_col(c)) for c in must_be_false]
    cond = reduce(lambda a, b: a & b, conds, F.lit(True))
    n = F.count(F.col(count_col)) if count_col else F.count(F.lit(1))
    return (df.where(cond)
              .groupBy(key)
              .agg(n.alias("_n"))
              .where(F.col("_n") >= k)
              .select(key)
              .orderBy(key))


def weekday_weekend_pivot(df: DataFrame, ts: str, work_out: str = "working_cnt",
                          weekend_out: str = "weekend_cnt") -> DataFrame:
    """One row: rows on Monday-Friday and rows on Saturday-Sunday (ISO days)."""
    d = iso_weekday(ts)
    return df.agg(F.count_if(d.isin(1, 2, 3, 4, 5)).alias(work_out),
                  F.count_if(d.isin(6, 7)).alias(weekend_out))


def exact_length_count(df: DataFrame, text: str, n: int,
                       out: str = "char_limit_count") -> DataFrame:
    """Number of rows whose text is exactly ``n`` characters (code points)."""
    return df.where(F.char_length(F.col(text)) == n).agg(F.count(F.lit(1)).alias(out))


def two_entity_daily_diff(df: DataFrame, day, entity: str, a, b, gt: int = 2,
                          out: str = "day") -> DataFrame:
    """Days on which the row counts of entities ``a`` and ``b`` differ by more
    than ``gt``.  Only rows of the two entities are read (filter first), so a
    day on which neither has rows never appears."""
    e = F.col(entity)
    diff = F.count_if(e == a) - F.count_if(e == b)
    return (df.where(e.isin(a, b))
              .groupBy(_col(day).alias(out))
              .agg(diff.alias("_d"))
              .where(F.abs(F.col("_d")) > gt)
              .select(out)
              .orderBy(F.col(out).desc()))
