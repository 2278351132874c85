"""Star-join operators: a fact table filtered and valued through its
dimensions.  Dimensions are reduced before they meet the fact, and the fact is
aggregated to the dimension key before the join wherever the value
factorises (``sum(price * qty) = price * sum(qty)`` per dimension row, exact
with decimals).  No broadcast is forced: AQE turns a join into a broadcast
only when the runtime size of a side is under the threshold."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions import day_of, exact_sum, in_month, pg_weekday


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def star_revenue_filtered(fact: DataFrame, dim: DataFrame, header: DataFrame, *,
                          fact_dim_key: str, dim_key: str,
                          fact_header_key: str, header_key: str,
                          dim_pred: Column, header_pred: Column,
                          group: str, price, quantity, scale: int = 6,
                          out: str = "total_revenue") -> DataFrame:
    """``SUM(price * quantity)`` per dimension group over fact rows whose
    dimension satisfies ``dim_pred`` and whose header satisfies ``header_pred``.

    ``price`` is a dimension column and ``quantity`` a fact column; header and
    dimension keys are unique (primary keys), so the header join is a semi-join.
    Plan: fact semi-join filtered headers -> sum(quantity) per dimension key
    (partial aggregation) -> join filtered dimension -> sum of price x
    quantity per group.  Numbers that stand for decimals (``exact_sum``) are
    multiplied and summed as such, a product with any other as a double; a
    group's sum is exact over these products.
    """
    hdr = header.where(header_pred).select(F.col(header_key).alias("_hk"))
    q, p = exact_sum(fact, quantity, scale), exact_sum(dim, price, scale)
    kept = fact.join(hdr, F.col(fact_header_key) == F.col("_hk"), "left_semi")
    qty = (kept.groupBy(F.col(fact_dim_key).alias("_dk")).agg(*q.sums("_q"))
               .select("_dk", q.total("_q").alias("_q")))
    d = dim.where(dim_pred).select(F.col(dim_key).alias("_dk2"), group, p.one().alias("_price"))
    joined = qty.join(d, F.col("_dk") == F.col("_dk2"))
    whole = q.stands_for_decimal("_q") & p.stands_for_decimal("_price", 56)
    product = q.to_decimal(F.col("_q")).cast(f"decimal(20,{q.scale})") * p.to_decimal(F.col("_price")).cast(f"decimal(17,{p.scale})")
    other = joined.select(group, F.when(whole, product).alias("_whole"),
                          F.when(~whole, q.to_double(F.col("_q")) * p.to_double(F.col("_price"))).alias("_other"))
    rest = exact_sum(other, "_other", scale)
    return (other.groupBy(group).agg(F.sum("_whole").alias("_w"), *rest.sums("_r"))
                 .select(group, F.coalesce(F.col("_w").cast("double") + F.coalesce(rest.to_double(rest.total("_r")), F.lit(0.0)),
                                           F.col("_w").cast("double"), rest.to_double(rest.total("_r"))).alias(out)))


def distinct_count_and_list(df: DataFrame, key: str, item_id: str, item_name: str,
                            count_out: str, list_out: str, sep: str = ",") -> DataFrame:
    """Per key: number of distinct items and the sorted, ``sep``-joined list of
    their distinct names.  Rows with a NULL key are dropped.

    Distinct (key, item, name) rows first, combined map-side, then per key the
    distinct items and Spark's sorted ``listagg`` of the distinct names: what a
    key holds is bounded by its distinct items, never by the fact rows.  A key
    without names has an empty list.
    """
    once = (df.where(F.col(key).isNotNull())
              .select(key, F.col(item_id).alias("_item"), F.col(item_name).cast("string").alias("_name")).distinct())
    quoted = sep.replace("\\", "\\\\").replace("'", "\\'")
    names = F.expr(f"listagg(DISTINCT _name, '{quoted}') WITHIN GROUP (ORDER BY _name)")
    return (once.groupBy(key)
                .agg(F.size(F.collect_set("_item")).cast("long").alias(count_out), F.coalesce(names, F.lit("")).alias(list_out))
                .orderBy(key))


def percentage_bonus(values: DataFrame, name: str, value: str, rate,
                     out: str = "bonus") -> DataFrame:
    """``ROUND(SUM(value) * rate)`` per name (namesakes merge), ascending.

    ``value`` should be exact (a decimal); rounding is half away from zero.
    """
    r = F.lit(Decimal(str(rate)))
    return (values.groupBy(name)
                  .agg(F.round(F.sum(F.col(value)) * r, 0).cast("bigint").alias(out))
                  .orderBy(out, name))


def weekday_totals(facts: DataFrame, ts: str, value: str, *, weekday: int = 5,
                   month: int | None = None, year: int | None = None, scale: int = 6,
                   spine: str = "observed", day_out: str = "day",
                   total_out: str = "total") -> DataFrame:
    """Total of ``value`` per date that falls on ``weekday`` (0 = Sunday) in a
    month.

    ``spine='observed'``: dates present in ``facts`` (as the question was
    answered).  ``spine='calendar'``: every such date of ``year``/``month``,
    0 where nothing happened (as the question was asked); the calendar is at
    most 5 rows.  ``month`` without ``year`` takes that month of any year.
    ``value`` is summed exactly (``exact_sum``).
    """
    if year is not None and month is not None:
        when = in_month(ts, year, month)
    elif month is not None:
        when = F.month(ts) == month
    else:
        when = F.lit(True)
    exact = exact_sum(facts, value, scale)
    totals = (facts.where(when & (pg_weekday(ts) == weekday))
                   .groupBy(day_of(ts).alias(day_out)).agg(*exact.sums("_t"))
                   .select(day_out, exact.to_double(exact.total("_t")).alias("_t")))
    if spine == "observed":
        res = totals
    elif spine == "calendar":
        if year is None or month is None:
            raise ValueError("calendar spine needs year and month")
        start = dt.date(year, month, 1)
        end = dt.date(year + (month == 12), month % 12 + 1, 1) - dt.timedelta(days=1)
        cal = (facts.sparkSession.range(1)
               .select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias(day_out))
               .where(pg_weekday(day_out) == weekday))
        res = cal.join(totals, day_out, "left")
    else:
        raise ValueError(f"unknown spine {spine!r}")
    return (res.select(day_out, F.coalesce(F.col("_t"), F.lit(0.0)).alias(total_out))
               .orderBy(day_out))


def anti_join_spend(tx: DataFrame, excluded: DataFrame, entities: DataFrame, *,
                    tx_key: str, excluded_key: str, tx_entity: str,
                    entity_key: str, name: str, amount, min_total, scale: int = 6,
                    id_out: str = "customer_id", name_out: str = "name") -> DataFrame:
    """Entities whose spend on transactions absent from ``excluded`` reaches
    ``min_total``.

    ``NOT EXISTS`` as a left-anti join (the excluded keys are de-duplicated
    map-side first, which also leaves them partitioned for the join); spend is
    aggregated per entity before the entity table is joined for the name.
    ``amount`` is summed exactly (``exact_sum``) and compared with the
    threshold without rounding either.
    """
    ex = excluded.select(F.col(excluded_key).alias("_x")).distinct()
    kept = tx.join(ex, F.col(tx_key) == F.col("_x"), "left_anti")
    exact = exact_sum(tx, amount, scale)
    spend = (kept.groupBy(F.col(tx_entity).alias("_e")).agg(*exact.sums("_s"))
                 .where(exact.total("_s") >= exact.literal(min_total)))
    ent = entities.select(F.col(entity_key).alias(id_out), F.col(name).alias(name_out))
    return (spend.join(ent, F.col("_e") == F.col(id_out))
                 .select(id_out, name_out)
                 .orderBy(id_out))
