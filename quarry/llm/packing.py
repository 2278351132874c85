"""Packing token sequences by Karmarkar-Karp multiway differencing."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.tokens import tokenizer
from quarry.llm.words import text_runs


def differencing(sizes: list[int], ways: int) -> tuple[list[int], int]:
    """Parts of near-equal sums: the part of each size, and the largest sum.

    Every size begins as a partial partition of its own, with one non-empty
    part.  The two partial partitions with the widest imbalance are merged,
    largest part onto smallest, until one is left.
    """
    heap, made = [], []  # made: (sums, left slots, right slots) of merge n, or the item it began as
    for item, size in enumerate(sizes):
        sums = np.zeros(ways, np.int64)
        sums[0] = size
        heap.append((-size, item))
        made.append((sums, None, None))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        sums = made[a][0] + made[b][0][::-1]
        order = np.argsort(-sums, kind="stable")
        sums = sums[order]
        made[a], made[b] = (None, *made[a][1:]), (None, *made[b][1:])
        made.append((sums - sums[-1], (a, order), (b, ways - 1 - order)))
        heapq.heappush(heap, (-int(sums[0] - sums[-1]), len(made) - 1))
    part = [0] * len(sizes)
    open_ = [(len(made) - 1, np.arange(ways))]  # slot of each final part in this partial partition
    while open_:
        at, slots = open_.pop()
        _, left, right = made[at]
        if left is None:
            part[at] = int(np.flatnonzero(slots == 0)[0])
        else:
            for child, order in (left, right):
                open_.append((child, order[slots]))
    total = np.bincount(part, weights=sizes, minlength=ways)
    return part, int(total.max())


def windows(sizes: list[int], capacity: int) -> tuple[list[int], int]:
    """The window of each size and the number of windows, none above ``capacity``; no size may be above it."""
    if not sizes:
        return [], 0
    ways = -(-sum(sizes) // capacity)
    while True:
        part, top = differencing(sizes, ways)
        if top <= capacity:
            return part, ways
        ways += 1


def pack_documents(docs: DataFrame, vocabulary: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
                   length: int = 1024, group: int = 512, piece: int = 256) -> DataFrame:
    """Pieces of tokenized documents, packed into sequences of at most ``length`` ids.

    A document is its ids with ``end_id`` behind.  As many whole sequences as
    it fills are cut off it; what is left over is cut into pieces of at most
    ``piece`` ids.  The pieces of each ``group`` left-overs in a row are
    divided by Karmarkar-Karp differencing into near-equal windows, as few as
    fit; a window too many raises the number.  Every task packs the rows it
    reads in groups of bounded size, so nothing is shuffled.

    Defined results: null and empty texts are one piece with ``end_id``;
    repeated rows are packed each; an empty table gives no rows; extra
    columns are ignored.

    Returns id, start, length, doc_tokens, sequence_id (unique, with gaps),
    offset, ids (little-endian unsigned 32-bit).
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 40
        encode = tokenizer(vocabulary).encode
        out: list[tuple] = []
        rest: list[tuple] = []
        waiting = 0
        kind_of_id = None

        def place() -> None:
            nonlocal sequence, waiting
            part, ways = windows([len(x[3]) // 4 for x in rest], length)
            used = [0] * ways
            for w, (key, start, n, ids) in zip(part, rest):
                out.append((key, start, len(ids) // 4, n, sequence + w, used[w], ids))
                used[w] += len(ids) // 4
            sequence += ways
            rest.clear()
            waiting = 0

        def batch_of() -> pa.RecordBatch:
            cols = list(zip(*out)) if out else [()] * 7
            types = [kind_of_id, *[pa.int64()] * 5, pa.binary()]
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                              names=["id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])
            out.clear()
            return made

        for batch in batches:
            kind_of_id = batch.schema.field("id").type
            keys = batch.column("id").to_pylist()
            for lo, _, data, offsets in text_runs(batch.column("text")):
                ids, at = encode(data, offsets)
                for d in range(len(offsets) - 1):
                    doc = np.append(ids[at[d]:at[d + 1]], np.uint32(end_id)).astype("<u4")
                    n, raw = len(doc), doc.tobytes()
                    whole = n // length * length
                    for s in range(0, whole, length):
                        out.append((keys[lo + d], s, length, n, sequence, 0, raw[4 * s:4 * (s + length)]))
                        sequence += 1
                    for s in range(whole, n, piece):
                        rest.append((keys[lo + d], s, n, raw[4 * s:4 * min(s + piece, n)]))
                    waiting += whole < n
                    if waiting >= group:
                        place()
                yield batch_of()
        if rest:
            place()
            yield batch_of()

    return rows.mapInArrow(pack, f"id {kind}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")
