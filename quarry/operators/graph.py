"""k-hop reach in a directed edge table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def k_hop(edges: DataFrame, start: DataFrame | Callable[[DataFrame], DataFrame], *,
          k: int = 4, mode: str = "exact", src: str = "src", dst: str = "dst",
          node: str = "node", limit: int | None = None, checkpoint_every: int | None = None,
          parts: int = 256, out: str = "follower_id") -> DataFrame:
    """Distinct nodes that reach a start node along ``src -> dst`` edges in
    exactly ``k`` steps (``mode='exact'``: walks, nodes may repeat, cycles are
    allowed) or in 1..k steps (``mode='within'``).

    ``start`` is a frame with a ``node`` column, or a function that derives
    it from the edges.  ``limit`` keeps the first nodes by id.

    Exact: the nodes at step s depend only on those at step s - 1, so a level
    is a semi-join of the edges with the frontier and a ``distinct``: no
    per-path rows.  Within: semi-naive evaluation.  The state holds each node
    with its first step; only nodes first reached in the last step are
    expanded, and one aggregate keeps the least step.  Each level refers to
    the one before once, so the plan grows linearly, with one exchange a level
    beside that of the edges, which all levels share.  Building the result
    starts no job.

    Hot targets (a node followed by a third of all edges) would put all their
    edges into one join task.  A target with more than 1 / ``parts`` of all
    edges is dealt over parts in proportion to its degree (fewer than
    ``parts`` targets, at most twice ``parts`` parts in all; both bounds hold
    for any data, so their list may be broadcast), and such a node stands in
    the frontier once for each of its parts.  ``parts=1`` deals nothing.

    For a large ``k`` the caller may ask for a reliable checkpoint every
    ``checkpoint_every`` levels, into the folder that the session names
    (``spark.checkpoint.dir``; without one Spark raises).  That runs the
    levels so far, keeps the plan short, and stops once nothing new is reached.
    """
    if mode not in ("exact", "within"):
        raise ValueError(f"unknown mode {mode!r}")
    if k < 1 or parts < 1:
        raise ValueError("k and parts must be at least 1")
    e = edges.select(F.col(src).alias("_s"), F.col(dst).alias("_d")).where(F.col("_s").isNotNull() & F.col("_d").isNotNull())
    if callable(start):
        start = start(e.select(F.col("_s").alias(src), F.col("_d").alias(dst)))
    first = start.select(F.col(node).alias("_n")).where(F.col("_n").isNotNull())
    if parts > 1:
        hot = _hot_targets(e, parts)
        mine, theirs = (hot.select(F.col("_h").alias(f"_h{c}"), F.col("_parts").alias(f"_p{c}")) for c in "ds")
        of = F.coalesce(F.col("_pd"), F.lit(1))
        dealt = (e.join(F.broadcast(mine), F.col("_d") == F.col("_hd"), "left")
                  .join(F.broadcast(theirs), F.col("_s") == F.col("_hs"), "left")
                  .select("_s", "_d", F.pmod(F.xxhash64("_s"), of).cast("int").alias("_part"), F.coalesce(F.col("_ps"), F.lit(1)).alias("_of")))
        first = (first.join(F.broadcast(mine), F.col("_n") == F.col("_hd"), "left")
                      .select("_n", F.explode(_numbers(of)).alias("_at")))
    else:
        dealt = e.select("_s", "_d", F.lit(0).alias("_part"), F.lit(1).alias("_of"))
        first = first.select("_n", F.lit(0).alias("_at"))
    meets = (F.col("_d") == F.col("_n")) & (F.col("_part") == F.col("_at"))
    state = first.distinct()
    for step in range(1, k + 1):
        if mode == "exact" or step == 1:
            nxt = dealt.join(state, meets, "left_semi").select(F.col("_s").alias("_n"), F.explode(_numbers(F.col("_of"))).alias("_at"))
            state = nxt.distinct() if mode == "exact" else nxt.groupBy("_n", "_at").agg(F.lit(1).alias("_step"))
        else:
            there = F.array(F.struct(F.col("_n").alias("_n"), F.col("_at").alias("_at"), F.col("_step").alias("_step")))
            more = F.transform(_numbers(F.col("_of")), lambda p: F.struct(F.col("_s").alias("_n"), p.alias("_at"), F.lit(step).alias("_step")))
            both = F.concat(there, F.when(F.col("_s").isNotNull(), more).otherwise(F.slice(there, 1, 0)))
            state = (state.join(dealt, meets & (F.col("_step") == step - 1), "left").select(F.inline(both))
                          .groupBy("_n", "_at").agg(F.min("_step").alias("_step")))
        if checkpoint_every and step % checkpoint_every == 0 and step < k:
            state = state.checkpoint(eager=True)
            last = state if mode == "exact" else state.where(F.col("_step") == step)
            if last.isEmpty():  # reads the checkpoint: no later level adds anything
                break
    res = state.where(F.col("_at") == 0).select(F.col("_n").alias(out)).orderBy(out)
    return res.limit(limit) if limit is not None else res


def _numbers(n: Column) -> Column:
    return F.sequence(F.lit(0), n - 1)


def _hot_targets(e: DataFrame, parts: int) -> DataFrame:
    """(``_h``, ``_parts``): targets with more than 1 / ``parts`` of all edges, and how many parts share their edges.

    Degrees and their sum are part of the plan (the sum a one-row subquery).
    """
    degree = e.groupBy("_d").agg(F.count(F.lit(1)).alias("_deg"))
    edges = degree.agg(F.struct(F.sum("_deg").alias("n"), F.max("_d").alias("d"))).scalar().getField("n")
    share = F.col("_deg") * parts / edges
    return degree.where(F.col("_deg") * parts > edges).select(F.col("_d").alias("_h"), F.ceil(share).cast("int").alias("_parts"))
