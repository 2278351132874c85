"""Derived inputs that re-aim the operators at the driver's tables.

These are the recipes of FIXTURES.md section 3, written so that each reads
its base tables once and shuffles as little as possible.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def matches(events: DataFrame) -> DataFrame:
    """Two-role rows: event ``2m`` plays event ``2m + 1``.

    Columns: match_id (the even event id), one_id, two_id (user ids) and
    one_time, two_time (``floor(value)``, so equal times occur).

    Equivalent to joining events to itself on ``b.event_id = a.event_id + 1``
    for even ``a.event_id``: both members of a pair share ``event_id >> 1``, so
    one grouping (one shuffle) replaces the self-join's two.  Where ids
    repeat, every event of one plays every event of the other, as in the
    join; the lists hold the events of two ids.
    """
    even = F.col("event_id").bitwiseAND(F.lit(1)) == 0
    who = F.struct(F.col("event_id").alias("m"), F.col("user_id").alias("u"), F.floor(F.col("value")).cast("bigint").alias("t"))
    g = (events.where(F.col("event_id").isNotNull())
         .groupBy(F.shiftright("event_id", 1).alias("_pair"))
         .agg(F.collect_list(F.when(even, who)).alias("_one"), F.collect_list(F.when(~even, who)).alias("_two")))
    pairs = g.select(F.explode("_one").alias("a"), "_two").select("a", F.explode("_two").alias("b"))
    return pairs.select(F.col("a.m").alias("match_id"), F.col("a.u").alias("one_id"), F.col("b.u").alias("two_id"),
                        F.col("a.t").alias("one_time"), F.col("b.t").alias("two_time"))


def edges(events: DataFrame, event_type: str = "error") -> DataFrame:
    """Follower graph: an edge src -> dst for every pair of consecutive event
    ids that are both of ``event_type``; src/dst are their user ids, distinct.

    Each event stands under its own id as the end of an edge and under the
    next id as its beginning, so one grouping by that key (one scan) replaces
    a self-join.  Where ids repeat, the sets hold the users of one id, and
    each of one is paired with each of the other.
    """
    e = events.where((F.col("event_type") == event_type) & F.col("event_id").isNotNull()).select("event_id", "user_id")
    none = F.lit(None).cast("bigint")
    user = F.col("user_id").cast("bigint")
    ends = e.select(F.inline(F.array(
        F.struct(F.col("event_id").alias("_k"), none.alias("_src"), user.alias("_dst")),
        F.struct((F.col("event_id") + 1).alias("_k"), user.alias("_src"), none.alias("_dst")))))
    pairs = ends.groupBy("_k").agg(F.collect_set("_src").alias("_srcs"), F.collect_set("_dst").alias("_dsts"))
    return pairs.select(F.explode("_srcs").alias("src"), "_dsts").select("src", F.explode("_dsts").alias("dst")).distinct()


def roster(customer: DataFrame) -> DataFrame:
    """Registered entities for the match operators: customers with even keys
    (so odd players are off-roster and idle members exist)."""
    return (customer.where(F.col("c_custkey") % 2 == 0)
            .select(F.col("c_custkey").alias("entity_id"), F.col("c_name").alias("name")))


def services(lineitem: DataFrame, orders: DataFrame, customer: DataFrame,
             supplier: DataFrame) -> DataFrame:
    """Lineitems as trips between two nations.

    origin = the customer's nation (through orders), destination = the
    supplier's nation, seats = l_quantity, round_trip = (l_returnflag = 'R').
    Orders are resolved to their origin nation before meeting lineitem, so
    lineitem joins one narrow (o_orderkey, origin) frame.
    """
    origin = (orders.select("o_orderkey", "o_custkey")
              .join(customer.select("c_custkey", F.col("c_nationkey").alias("origin")),
                    F.col("o_custkey") == F.col("c_custkey"))
              .select("o_orderkey", "origin"))
    dest = supplier.select("s_suppkey", F.col("s_nationkey").alias("destination"))
    li = lineitem.select("l_orderkey", "l_suppkey", "l_quantity", "l_returnflag")
    return (li.join(origin, F.col("l_orderkey") == F.col("o_orderkey"))
              .join(dest, F.col("l_suppkey") == F.col("s_suppkey"))
              .select("origin", "destination",
                      F.col("l_quantity").alias("seats"),
                      (F.col("l_returnflag") == "R").alias("round_trip")))
