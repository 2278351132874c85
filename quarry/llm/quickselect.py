"""The k-th key of a distributed table by random pivots and exact counts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarry.llm.common import materialise


def _literal(key: Row, kind: StructType) -> Column:
    return F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(key, kind.fields)])


def _part_counts(keys: DataFrame, pivots: pa.Table) -> np.ndarray:
    """How many keys are below the first pivot, at it, between it and the second, and so on: exact, for pivots in order.

    Each batch is sorted together with two marks for each pivot, one before and one after the keys equal to it.
    """
    p, names = pivots.num_rows, pivots.column_names
    twice = pivots.take(pa.array(np.repeat(np.arange(p), 2)))
    marks = twice.append_column("mark", pa.array(np.tile([-1, 1], p), pa.int8()))
    order = [(c, "ascending") for c in marks.column_names]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 * p + 1, np.int64)
        for batch in batches:
            n = batch.num_rows
            both = pa.concat_tables([pa.Table.from_batches([batch]).append_column("mark", pa.array(np.zeros(n), pa.int8())).cast(marks.schema), marks])
            place = np.flatnonzero(pc.sort_indices(both, sort_keys=order, null_placement="at_end").to_numpy() >= n)
            before = np.concatenate([[0], place - np.arange(2 * p), [n]])
            total += np.diff(before)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(2 * p + 1), pa.int32()), pa.array(total)], names=["part", "n"])

    out = np.zeros(2 * p + 1, np.int64)
    found = keys.select(*[f"key.{c}" for c in names]).mapInArrow(count, "part int, n long").groupBy("part").agg(F.sum("n").alias("n"))
    for r in found.collect():
        out[r["part"]] = r["n"]
    return out


def kth_key(keys: DataFrame, k: int, seed: int = 0, pivots: int = 255) -> Row | None:
    """The ``k``-th smallest (from 1) of the column ``key``, a struct with no equal values.

    ``keys`` must be a written table.  Each round draws random pivot keys
    from the keys still in question, counts all of these exactly below, at
    and above each pivot, and goes on with the one gap that holds the k-th,
    written anew.  Only pivots and counts (at most 2 * ``pivots`` + 1) reach
    the driver.  None where there are fewer than ``k`` keys or ``k`` < 1.
    Fields order as given; null fields must be told by a field before them.
    """
    kind = keys.schema["key"].dataType
    if k < 1:
        return None
    active, turn = keys.select("key"), 0
    while True:
        drawn = active.orderBy(F.xxhash64(F.lit(seed), F.lit(turn), "key"), "key").limit(pivots).orderBy("key").select("key.*").toArrow()
        ends = np.cumsum(_part_counts(active, drawn))
        part = int(np.searchsorted(ends, k))
        if part == len(ends):
            return None
        marks = [Row(*r.values()) for r in drawn.to_pylist()]
        gap, exact = divmod(part, 2)
        if exact:
            return marks[gap]
        if gap > 0:
            active = active.filter(F.col("key") > _literal(marks[gap - 1], kind))
        if gap < len(marks):
            active = active.filter(F.col("key") < _literal(marks[gap], kind))
        k -= int(ends[part - 1]) if part else 0
        active, turn = materialise(active, "keys-in-question"), turn + 1


def smallest_ranked(keys: DataFrame, k: int, seed: int = 0) -> DataFrame:
    """(key, rank): the ``k`` smallest keys and their ranks from 1; all of them if there are fewer.

    Only these winners are sorted: by ranges of the key, each range in one
    task; counts per range (one row per task) carry the ranks on.
    """
    last = kth_key(keys, k, seed)
    winners = keys.select("key")
    if last is not None:
        winners = winners.filter(F.col("key") <= _literal(last, keys.schema["key"].dataType))
    elif k < 1:
        winners = winners.limit(0)
    ordered = winners.repartitionByRange("key").sortWithinPartitions("key").withColumn("_at", F.monotonically_increasing_id())
    ordered = materialise(ordered, "winners").withColumn("_range", F.shiftright("_at", 33))
    ranges = ordered.groupBy("_range").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("low"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("low").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = ranges.select("_range", before.alias("before"))
    place = F.col("before") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1
    return ordered.join(F.broadcast(ranges), "_range").select("key", place.alias("rank"))
