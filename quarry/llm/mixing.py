"""Mixing sources to target weights by Pfair scheduling of their blocks."""

from __future__ import annotations

import heapq
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import hash128, whole_row

CYCLE = 1 << 40  # slots that weights are rounded to
MOST_BLOCKS = 1 << 22  # each is scheduled in the driver; blocks of larger tables are longer
MOST_SOURCES = 100_000  # a weight for each is kept in the driver
_BUCKETS = 14  # bits
_PART = 256  # slots of a source in a row of the schedule


def shares(weights: list[float], cycle: int) -> list[int]:
    """Slots of each source in a cycle: proportional to the weights by largest remainders, exactly ``cycle`` in all.

    Sources whose share is less than a slot get one.
    """
    top = max(weights)
    exact = [int(w / top * (1 << 60)) for w in weights]
    more, total, free = list(range(len(weights))), sum(exact), cycle
    while low := [i for i in more if exact[i] * free < total]:
        free -= len(low)
        total -= sum(exact[i] for i in low)
        gone = set(low)
        more = [i for i in more if i not in gone]
    got = [1] * len(weights)
    for i in more:
        got[i] = exact[i] * free // total
    left = free - sum(got[i] for i in more)
    for i in sorted(more, key=lambda i: (-(exact[i] * free % total), i))[:left]:
        got[i] += 1
    return got


def timed(slots: list[int], blocks: list[int]) -> Iterator[tuple[int, int, int]]:
    """(slot, source, block) of the first ``blocks`` of each source, in the order of slots.

    Block j of a source with n of the cycle's N slots is released at
    floor(j N / n) and due at ceil((j + 1) N / n).  Each slot goes to the
    released block that is due first, which meets every deadline, so at any
    time each source is less than one block from its share.  Slots of sources
    without further blocks stay empty.
    """
    total = sum(slots)
    later = [(0, source, 0) for source, n in enumerate(blocks) if n]  # a source's next block: released then
    ready: list[tuple[int, int, int]] = []
    t = 0
    while later or ready:
        if not ready:
            t = max(t, later[0][0])
        while later and later[0][0] <= t:
            _, source, j = heapq.heappop(later)
            heapq.heappush(ready, (-(-(j + 1) * total // slots[source]), source, j))
        due, source, j = heapq.heappop(ready)
        if due <= t:
            raise AssertionError("a deadline is missed")
        yield t, source, j
        if j + 1 < blocks[source]:
            heapq.heappush(later, ((j + 1) * total // slots[source], source, j + 1))
        t += 1


def pfair(slots: list[int]) -> list[tuple[int, int]]:
    """(source, block) of each slot of a cycle."""
    return [(source, j) for _, source, j in timed(slots, slots)]


def _source_key(source: Column) -> Column:
    """A text that is not null and differs for null."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("n"))


def schedule(docs: DataFrame, weights: dict[str | None, float] | None = None, alpha: float = 0.7, block_chars: int = 1 << 16,
             cycle: int | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Every document with the block of its source and the block's slot.

    Target weights are given by source, or the sources' sizes to the power
    ``alpha``; a source without a weight gets the least share, one slot of a
    cycle (``CYCLE`` slots, unless ``cycle`` is given).  Each source's documents are put in the order of a hash and cut
    into blocks of ``block_chars`` characters, or of one part in
    ``MOST_BLOCKS`` of all characters where that is more (a document belongs
    to the block in which it begins).  So the blocks are at most
    ``MOST_BLOCKS`` and one for each source, whatever the size of the table.
    The weights become whole numbers of slots of a cycle, so long that
    rounding is no block off before the schedule ends, and all blocks are
    scheduled once, by source and number.  The documents themselves
    are only counted by (source, range of hashes), summed, and dealt by the
    same keys.  A source that is exhausted leaves its
    later slots empty and the others keep their proportions; nothing is dropped.

    Defined results: a null source is a source of its own; null and empty
    texts take one character; repeated rows are placed each; at most
    ``MOST_SOURCES`` sources (more raise an error); an empty table gives no
    rows; extra columns stay inside ``doc``.

    Returns doc (the whole row), source, block, release, deadline, slot, at
    (characters of its source before it).
    """
    d1, d2 = hash128(F.col(id_col), F.col(text_col))
    bucket = F.call_function("shiftrightunsigned", d1, F.lit(64 - _BUCKETS)).cast("int")
    rows = docs.select(whole_row(docs).alias("doc"), _source_key(F.col(source_col)).alias("source"),
                       (F.coalesce(F.char_length(text_col), F.lit(0)) + 1).cast("long").alias("size"),
                       bucket.alias("bucket"), d1.alias("d1"), d2.alias("d2"))
    slim = rows.select("source", "bucket", "size")
    sizes = {r.source: r.size for r in slim.groupBy("source").agg(F.sum("size").alias("size")).limit(MOST_SOURCES + 1).collect()}
    if len(sizes) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources: give a coarser source column")
    names = sorted(sizes)
    if weights is None:
        wanted = [sizes[s] ** alpha for s in names]
    else:
        given = {"n" if s is None else f"s{s}": w for s, w in weights.items()}
        wanted = [max(0.0, given.get(s, 0.0)) for s in names]
        wanted = wanted if sum(wanted) else [1.0] * len(names)
    block_chars = max(block_chars, -(-sum(sizes.values()) // MOST_BLOCKS))
    blocks = [(sizes[s] - 1) // block_chars + 1 for s in names]
    cycle = max(cycle or CYCLE, len(names))
    slots = shares(wanted, cycle) if names else []
    turns = [array("q") for _ in names]
    for t, s, _ in timed(slots, [min(b, n) for b, n in zip(blocks, slots)]):
        turns[s].append(t)
    parts = [(s, at // _PART, turn[at:at + _PART].tolist()) for s, turn in zip(names, turns) for at in range(0, len(turn), _PART)]
    kinds = [pa.string(), pa.int64(), pa.list_(pa.int64())]
    spark = docs.sparkSession
    places = spark.createDataFrame(pa.table([pa.array([r[n] for r in parts], k) for n, k in enumerate(kinds)], ["source", "part", "turns"]))
    share = spark.createDataFrame(list(zip(names, slots)), "source string, slots long")

    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = slim.groupBy("source", "bucket").agg(F.sum("size").alias("size")).select(
        "source", "bucket", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("source", "bucket").orderBy("d1", "d2").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.join(starts, ["source", "bucket"]).withColumn("at", F.col("start") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    block = F.floor(F.col("at") / block_chars)
    cut = placed.withColumn("block", block).join(F.broadcast(share), "source").withColumns(
        {"nth": F.col("block") % F.col("slots"), "part": F.floor(F.col("block") % F.col("slots") / _PART)})
    placed = cut.join(F.broadcast(places), ["source", "part"])
    n = f"{cycle}L"  # whole numbers all the way: products pass the range of exact doubles
    return placed.select(
        "doc", F.when(F.col("source") != "n", F.substring("source", 2, 1 << 30)).alias("source"), "block",
        F.expr(f"block * {n} div slots").alias("release"), F.expr(f"((block + 1) * {n} + slots - 1) div slots").alias("deadline"),
        (F.expr(f"block div slots * {n}") + F.element_at("turns", (F.col("nth") % _PART + 1).cast("int"))).alias("slot"), "at", "d1", "d2")


def mix(docs: DataFrame, **how) -> DataFrame:
    """``docs`` interleaved in the order of ``schedule``; all rows and columns stay.

    Partitions are ranges of slots, sorted, so files written from the result
    hold the mixture in order.
    """
    order = ["slot", "at", "d1", "d2"]
    return schedule(docs, **how).repartitionByRange(*order).sortWithinPartitions(*order).select("doc.*")
