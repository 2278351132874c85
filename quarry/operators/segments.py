"""Lags and running sums along keys of any size.

A window puts each key into one task.  Here the rows are cut into ranges of
(key, order), whatever the keys' sizes, and what a range needs of those before
it, its last few rows and the sum of the key that goes on, comes from one-row
subqueries whose size depends on the number of ranges only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import exact_sum
from quarry.operators.prefix import cut_into_ranges


def sequence_scan(df: DataFrame, key: str, order: list[str], *, lags: dict[str, tuple[str, int]] | None = None,
                  running: dict[str, str] | None = None, ranges: int = 256, scale: int = 6) -> DataFrame:
    """Adds ``LAG(column, n)`` for each name in ``lags`` and the running sum of a column for each in ``running``,
    both ``OVER (PARTITION BY key ORDER BY order)``.

    ``order`` must tell rows of a key apart (end it in a unique id).  NULL
    keys are one key, NULLs in ``order`` come first.  Running sums leave NULLs
    out, are NULL before the first value, exact (``exact_sum``) and doubles.

    Plan: edges of ``ranges`` drawn from the rows; one exchange by range; one
    sort in each.  The last rows of each range (as many as the longest lag)
    and the sum of its last key are ``ranges`` times a few values.
    """
    lags, running = lags or {}, running or {}
    if any(n < 1 for _, n in lags.values()):
        raise ValueError("a lag must be at least 1")
    sums = {out: exact_sum(df, col, scale) for out, col in running.items()}
    parts = {f"_{i}_{j}": p for i, s in enumerate(sums.values()) for j, p in enumerate([*s.rows, *([] if s.wide is None else [s.wide])])}
    rows = df.withColumns({"_k": F.struct(F.col(key).alias("k")), "_at": F.struct(F.col(key).alias("k"), *order), **parts})
    dealt = cut_into_ranges(rows, "_at", ranges)
    inside, mine = Window.partitionBy("_b").orderBy("_at"), Window.partitionBy("_b", "_k").orderBy("_at")
    out = dealt.withColumn("_p", F.row_number().over(inside))
    longest = max((n for _, n in lags.values()), default=0)
    if longest:
        seen = list(dict.fromkeys(c for c, _ in lags.values()))
        held = F.struct("_b", "_at", "_k", *[F.col(c).alias(f"v{i}") for i, c in enumerate(seen)])
        from_end = Window.partitionBy("_b").orderBy(F.desc("_at"))
        tails = dealt.withColumn("_r", F.row_number().over(from_end)).where(F.col("_r") <= longest)
        tails = tails.agg(F.sort_array(F.collect_list(held)).alias("t"))
        before = f"transform(sequence(0, {ranges}), i -> size(filter(t, x -> x._b < i)))"
        border = tails.select(F.struct("t", F.expr(before).alias("n"))).scalar()
        near = {f"_l{n}": F.lag(F.struct("_k", *[F.col(c).alias(f"v{i}") for i, c in enumerate(seen)]), n).over(inside) for n in {n for _, n in lags.values()}}
        out = out.withColumns(near).withColumn("_border", border)
        for name, (col, n) in lags.items():
            far = F.get(F.col("_border.t"), F.get(F.col("_border.n"), F.col("_b")) + F.col("_p") - n - 1)
            i = seen.index(col)
            there = F.when(F.col("_p") > n, F.when(F.col(f"_l{n}._k") == F.col("_k"), F.col(f"_l{n}.v{i}"))).otherwise(
                F.when(far.getField("_k") == F.col("_k"), far.getField(f"v{i}")))
            out = out.withColumn(name, there)
        out = out.drop("_border", *near)
    if parts:
        per_key = dealt.groupBy("_b", "_k").agg(*[F.sum(p).alias(p) for p in parts])
        ends = per_key.groupBy("_b").agg(F.min("_k").alias("head"), F.max(F.struct("_k", *parts)).alias("tail"))
        ends = ends.agg(F.sort_array(F.collect_list(F.struct("_b", "head", "tail"))).alias("e"))
        carried = ", ".join(f"aggregate(filter(e, x -> x._b < i AND x.tail._k = h AND x.tail.{p} IS NOT NULL), CAST(NULL AS {kind}), "
                            f"(a, x) -> coalesce(a, {zero}) + x.tail.{p}) AS {p}"
                            for p, kind, zero in ((f.name, f.dataType.simpleString(), f"CAST(0 AS {f.dataType.simpleString()})") for f in per_key.schema.fields[2:]))
        heads = f"transform(sequence(0, {ranges}), i -> transform(filter(e, x -> x._b = i), y -> y.head))"
        step = ends.select("e", F.expr(heads).alias("hs"))
        step = step.select(F.expr(f"transform(hs, (q, i) -> CASE WHEN size(q) > 0 THEN transform(q, h -> struct(h AS head, {carried})) END)").alias("c")).scalar()
        out = out.withColumn("_carry", step).withColumn("_carry", F.get(F.get("_carry", F.col("_b")), F.lit(0)))
        goes_on = F.col("_carry.head") == F.col("_k")
        frame = mine.rowsBetween(Window.unboundedPreceding, 0)
        total = {}
        for p in parts:
            own, old = F.sum(p).over(frame), F.when(goes_on, F.col(f"_carry.{p}"))
            total[p] = F.coalesce(own + old, own, old)
        out = out.withColumns(total)
        for i, (name, s) in enumerate(sums.items()):
            names = s.names(f"_{i}_")
            if s.wide is not None:  # ``names`` ends the wide part with a letter, ``parts`` with its number
                out = out.withColumnRenamed(f"_{i}_{len(s.rows)}", names[-1])
            out = out.withColumn(name, s.to_double(s.total(f"_{i}_"))).drop(*names)
        out = out.drop("_carry")
    return out.drop("_k", "_at", "_b", "_p")
