"""Passages that repeat across documents, by sparse suffix arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import hash128, materialise
from quarry.llm.words import grams, mix, text_runs, word_hashes, word_spans

ORDER = 8  # words of the grams whose hashes choose positions
_STEP = 1 << 18
_DEPTH = 8  # words behind the key, and before it, that order suffixes of one key
_HELD = 20_000  # rows of one document in a row that wait for the next document's


def _windows(words: np.ndarray, first: np.ndarray, min_words: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every run of ``min_words`` words inside a document: its first word, its minimiser, and whether that is tied.

    A run holds ``window`` positions whose next ``min_words - window + 1``
    words are inside it; its minimiser is the one whose gram has the lowest
    hash, so equal runs have equal minimisers.
    """
    if len(words) < min_words:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
    begin = np.arange(len(words) - min_words + 1)
    doc = np.searchsorted(first, begin, "right") - 1
    inside = begin + min_words <= first[doc + 1]
    low, tied = np.empty(len(begin), np.int64), np.empty(len(begin), bool)
    view = sliding_window_view(grams(words, ORDER), window)
    for at in range(0, len(begin), _STEP):
        part = view[at:at + _STEP][:len(begin) - at]
        low[at:at + _STEP] = part.argmin(1)
        tied[at:at + _STEP] = low[at:at + _STEP] != window - 1 - part[:, ::-1].argmin(1)
    return begin[inside], (begin + low)[inside], tied[inside]


def sample_positions(words: np.ndarray, first: np.ndarray, min_words: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Minimisers (indexes of words) of the untied windows, and one of each document's equal tied windows.

    Tied windows stand in periodic text, so few of them differ.
    """
    begin, low, tied = _windows(words, first, min_words, window)
    begin = begin[tied]
    whole, doc = grams(words, min_words)[begin], np.searchsorted(first, begin, "right") - 1
    order = np.lexsort((whole, doc))
    new = np.append(True, (np.diff(doc[order]) != 0) | (whole[order][1:] != whole[order][:-1]))[:len(order)]
    return np.unique(low[~tied]), begin[order[new]]


def _runs(words: np.ndarray, first: np.ndarray, min_words: int, window: int, shared: np.ndarray, periodic: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows of one shared minimiser, and tied windows equal to a ``periodic`` one: (position or -1, first window, windows)."""
    begin, low, tied = _windows(words, first, min_words, window)
    mark = np.zeros(len(words) + 1, bool)
    mark[shared] = True
    whole = grams(words, min_words)
    among = np.zeros(len(begin), bool)
    among[tied] = np.isin(whole[begin[tied]], whole[periodic])
    wanted = among | (~tied & mark[low])
    begin, own = begin[wanted], np.where(tied, -1, low)[wanted]
    heads = np.flatnonzero(np.append(True, (own[1:] != own[:-1]) | (own[1:] < 0) | (np.diff(begin) != 1))[:len(begin)])
    return own[heads], begin[heads], np.diff(np.append(heads, len(begin)))


def _contexts(words: np.ndarray, first: np.ndarray, at: np.ndarray, owner: np.ndarray, key: int) -> tuple[pa.Array, pa.Array]:
    """16-bit hashes of the ``_DEPTH`` words behind each key and before it (nearest first); 0 beyond the document."""
    short = np.append((words >> np.uint64(48)) | np.uint64(1), np.uint64(0)).astype(">u2")
    out = []
    for step in (at[:, None] + key + np.arange(_DEPTH), at[:, None] - 1 - np.arange(_DEPTH)):
        inside = (step >= first[owner][:, None]) & (step < first[owner + 1][:, None])
        rows = short[np.where(inside, step, -1)]
        out.append(pa.FixedSizeBinaryArray.from_buffers(pa.binary(2 * _DEPTH), len(at), [None, pa.py_buffer(np.ascontiguousarray(rows))]).cast(pa.binary()))
    return out[0], out[1]


def _aligned(batch: pa.RecordBatch, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Each row's windows in a row of a matrix, in the column that tells where they begin before the suffix, and which are there."""
    n = batch.column("n").to_numpy().astype(np.int64)
    row = np.repeat(np.arange(len(n)), n)
    column = np.repeat(window - 1 - batch.column("lead").to_numpy().astype(np.int64), n) + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    whole, there = np.zeros((len(n), window), np.uint64), np.zeros((len(n), window), bool)
    whole[row, column] = np.frombuffer(b"".join(batch.column("windows").to_pylist()), np.uint64)
    there[row, column] = True
    return whole, there


def _spans_with(batch: pa.RecordBatch, equal: np.ndarray, with_: np.ndarray, min_words: int, window: int) -> list[np.ndarray]:
    """(row, start, end, other) of the runs of equal windows of each row and the row it is compared with."""
    edge = np.zeros((len(equal), 1), np.int8)
    turn = np.diff(np.concatenate([edge, equal.astype(np.int8), edge], 1), axis=1)
    row, low = np.nonzero(turn == 1)
    high = np.nonzero(turn == -1)[1]
    zero = batch.column("start").to_numpy() + batch.column("lead").to_numpy() - (window - 1)
    return [row, zero[row] + low, zero[row] + high - 1 + min_words, batch.column("d1").to_numpy()[with_[row]]]


def compare_neighbours(batch: pa.RecordBatch, min_words: int, window: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Spans that sorted suffixes share with their neighbours, and which rows have windows that no neighbour has.

    A row's neighbours are the nearest row of another document before it and
    the nearest after it, of the same key.  A match is extended to the left and to
    the right window by window.
    """
    h, d1, d2 = (batch.column(c).to_numpy() for c in ("h", "d1", "d2"))
    new = np.append(True, (h[1:] != h[:-1]) | (d1[1:] != d1[:-1]) | (d2[1:] != d2[:-1]))[:len(h)]
    heads = np.flatnonzero(new)
    run = np.cumsum(new) - 1
    whole, there = _aligned(batch, window)
    left = there.copy()
    found = []
    for other in (heads[run] - 1, np.append(heads, len(h))[run + 1]):
        inside = (other >= 0) & (other < len(h))
        other = np.where(inside, other, 0)
        inside &= h[other] == h
        equal = (whole == whole[other]) & there & there[other] & inside[:, None]
        found.append(_spans_with(batch, equal, other, min_words, window))
        left &= ~equal
    return [np.concatenate(c) for c in zip(*found)], left.any(1)


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 50, window: int = 30) -> DataFrame:
    """Maximal spans of at least ``min_words`` words that also occur in another document.

    Retained suffixes begin at minimiser positions (tied windows of periodic
    text stand for themselves), and only those count whose first ``min_words
    - window + 1`` words, their key, occur in two documents or more.  They
    are sorted by key and the words behind and before it: a range partitioning
    over all of them, so a passage in a great many documents spreads over
    tasks, with the rows at the ends of ranges compared once more.  Neighbours
    of different documents are compared and extended left and right by the
    windows of ``min_words`` words around the key.

    Two equal passages need not be neighbours (others may share more on one
    side and too little on the other).  So where a key has windows that no
    neighbour has, all its windows are grouped by their hashes: rows with
    equal windows, a class, as one, so that every window meets all documents.
    Groups are combined map-side.  Overlapping windows of a document are
    merged, so a copied document is one span.  Words are runs without white
    space, A-Z lowered; windows are compared by 64-bit hashes of their words.

    Defined results: null, empty and short texts have no spans; rows that
    repeat both id and text count as one document; null ids are allowed; an
    empty table gives no rows; extra columns are ignored.

    Returns id, start_word, n_words, other_id (a document it also occurs in).
    """
    key = min_words - window + 1
    if key < ORDER:
        raise ValueError(f"min_words - window must be {ORDER - 1} or more")
    text = F.coalesce(F.col(text_col), F.lit(""))
    d1, d2 = hash128(F.col(id_col), text)
    rows = docs.select(d1.alias("d1"), d2.alias("d2"), F.col(id_col).cast("long").alias("id"), text.alias("text"))

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, _, data, offsets in text_runs(batch.column("text")):
                starts, ends, first = word_spans(data, offsets)
                words = word_hashes(data, starts, ends)
                lowest, periodic = sample_positions(words, first, min_words, window)
                at = np.concatenate([lowest, periodic])
                owner = np.searchsorted(first, at, "right") - 1
                which = pa.array(lo + owner)
                h = np.concatenate([grams(words, key)[lowest], grams(words, min_words)[periodic]])
                pos = np.where(np.arange(len(at)) < len(lowest), at - first[owner], first[owner] - at - 1)  # below 0: a tied window
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), batch.column("d1").take(which), batch.column("d2").take(which), pa.array(pos.astype(np.int32))],
                    names=["h", "d1", "d2", "pos"])

    samples = materialise(rows.select("d1", "d2", "text").mapInArrow(sample, "h long, d1 long, d2 long, pos int"), "samples")
    often = samples.groupBy("h").agg((F.min("d1") != F.max("d1")).alias("shared")).filter("shared").select("h")
    often = materialise(often, "shared-keys")
    shared = samples.join(often, "h").groupBy("d1", "d2").agg(F.collect_set("pos").alias("at"))
    wanted = rows.join(shared, ["d1", "d2"]).select("d1", "d2", "id", "text", "at")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_runs(batch.column("text")):
                starts, ends, first = word_spans(data, offsets)
                words = word_hashes(data, starts, ends)
                lists = batch.column("at").slice(lo, hi - lo)
                head = np.repeat(first[:-1], lists.value_lengths().to_numpy(zero_copy_only=False))
                pos = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                at, a, n = _runs(words, first, min_words, window, (head + pos)[pos >= 0], (head - pos - 1)[pos < 0])
                whole = grams(words, min_words)
                h = np.where(at < 0, whole[a], grams(words, key)[at])
                with np.errstate(over="ignore"):  # the first and the last window hold all words between them
                    same = mix(mix(whole[a] + (at - a).astype(np.uint64)) ^ (whole[a + n - 1] + n.astype(np.uint64)))
                owner = np.searchsorted(first, a, "right") - 1
                which = pa.array(lo + owner)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), *_contexts(words, first, np.where(at < 0, a, at), owner, key), pa.array(same.view(np.int64)),
                     *[batch.column(c).take(which) for c in ("d1", "d2", "id")], pa.array(a - first[owner]), pa.array(np.where(at < 0, 0, at - a).astype(np.int32)),
                     pa.array(n.astype(np.int32)), pa.array([whole[x:x + m].tobytes() for x, m in zip(a.tolist(), n.tolist())], pa.binary())], names=columns)

    suffix = "h long, right binary, left binary, class long, d1 long, d2 long, id long, start long, lead int, n int, windows binary"
    columns = [c.split()[0] for c in suffix.split(", ")]
    runs = named = materialise(wanted.mapInArrow(cut, suffix), "suffixes")

    # the rows in suffix order, each compared with its neighbours
    order = ["h", "right", "left", "d1", "d2", "start"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, done, ends = None, 0, []

        def made(size: int, **given: pa.Array) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([given[f.name] if f.name in given else pa.nulls(size, f.type) for f in passed], schema=passed)

        def out(rows: pa.RecordBatch, low: int, high: int) -> Iterator[pa.RecordBatch]:
            (row, start, end, other), left = compare_neighbours(rows, min_words, window)
            mine = (row >= low) & (row < high)
            which = pa.array(row[mine])
            yield made(len(which), **{c: rows.column(c).take(which) for c in ("h", "d1", "d2", "id")}, start=pa.array(start[mine]),
                       end=pa.array(end[mine]), other=pa.array(other[mine]))
            odd = np.unique(rows.column("h").to_numpy()[low:high][left[low:high]])  # keys with windows still unmatched
            yield made(len(odd), h=pa.array(odd))

        for batch in batches:
            if not batch.num_rows:
                continue
            batch = batch.select(columns)
            ends = [ends[0] if ends else batch.slice(0, 1), batch.slice(batch.num_rows - 1, 1)]
            rows = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            h, d1, d2 = (rows.column(c).to_numpy() for c in ("h", "d1", "d2"))
            turns = np.flatnonzero((h[1:] != h[:-1]) | (d1[1:] != d1[:-1]) | (d2[1:] != d2[:-1]))
            last = int(turns[-1]) + 1 if len(turns) else 0  # the last document's rows wait for the next one's
            last = last if rows.num_rows - last <= _HELD else rows.num_rows
            if last > done:
                yield from out(rows, done, last)
            keep = max(0, last - 1)
            held, done = rows.slice(keep), max(done, last) - keep
        if held is not None:
            if held.num_rows > done:
                yield from out(held, done, held.num_rows)
            for row in ends:
                yield made(1, **{c: row.column(c) for c in columns})

    kinds = [pa.int64(), pa.binary(), pa.binary(), *[pa.int64()] * 5, pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64()]
    passed = pa.schema(list(zip([*columns, "end", "other"], kinds)))
    schema = suffix + ", `end` long, other long"  # a span, a key alone, or a row at an end of a range
    sorted_ = runs.select(columns).repartitionByRange(*order).sortWithinPartitions(*order)
    compared = materialise(sorted_.mapInArrow(compare, schema), "neighbours")

    # two rows of each range at most: the ends of neighbouring ranges
    across = compared.filter("windows IS NOT NULL").select(columns).distinct().repartition(1).sortWithinPartitions(*order)
    matched = compared.unionByName(across.mapInArrow(compare, schema)).filter("`end` IS NOT NULL").select("d1", "d2", "id", "start", "end", "other")
    unmatched = materialise(compared.filter("d1 IS NULL").select("h").distinct(), "unmatched-keys")

    # keys with windows that no neighbour has: all their windows, by hash
    runs = runs.drop("right", "left", "lead").join(unmatched, "h")
    classes = runs.groupBy("h", "class").agg(F.min("d1").alias("lo"), F.max("d1").alias("hi"))
    classes = materialise(classes, "window-classes")
    known = runs.join(classes, ["h", "class"])
    single_columns = ["d1", "d2", "id", "start", "end", "lo", "hi", "w"]

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d1, lo, hi, start = (batch.column(c).to_numpy() for c in ("d1", "lo", "hi", "start"))
            n = batch.column("n").to_numpy().astype(np.int64)
            repeats = pa.array(lo != hi)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c).filter(repeats) for c in ("d1", "d2", "id", "start")], pa.array(start + n - 1 + min_words).filter(repeats),
                 batch.column("lo").filter(repeats), batch.column("hi").filter(repeats), pa.nulls(int((lo != hi).sum()), pa.int64())], names=single_columns)
            asked = np.flatnonzero(d1 == lo)
            which = pa.array(np.repeat(asked, n[asked]))
            nth = np.arange(n[asked].sum()) - np.repeat(np.cumsum(n[asked]) - n[asked], n[asked])
            w = np.frombuffer(b"".join(batch.column("windows").take(pa.array(asked)).to_pylist()), np.int64)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c).take(which) for c in ("d1", "d2", "id")], pa.array(np.repeat(start[asked], n[asked]) + nth), pa.nulls(len(w), pa.int64()),
                 batch.column("lo").take(which), batch.column("hi").take(which), pa.array(w)], names=single_columns)

    found = materialise(known.select("d1", "d2", "id", "start", "n", "lo", "hi", "windows").mapInArrow(
        spread, "d1 long, d2 long, id long, start long, `end` long, lo long, hi long, w long"), "passages")
    single = found.filter("w IS NOT NULL")
    twice = single.groupBy("w").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).filter("lo != hi")
    more = (single.filter("lo = hi").select("d1", "d2", "id", "start", (F.col("start") + min_words).alias("end"), "w")
            .join(twice, "w").select("d1", "d2", "id", "start", "end", "lo", "hi"))
    found = found.filter("w IS NULL").drop("w").unionByName(more)
    found = found.select("d1", "d2", "id", "start", "end", F.when(F.col("lo") == F.col("d1"), F.col("hi")).otherwise(F.col("lo")).alias("other"))
    found = found.unionByName(matched)

    w = Window.partitionBy("d1", "d2").orderBy("start", "end")
    new = F.coalesce((F.col("start") > F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))).cast("int"), F.lit(1))
    island = found.withColumn("new", new).withColumn("island", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    spans = island.groupBy("d1", "d2", "id", "island").agg(F.min("start").alias("start_word"), F.max("end").alias("last"), F.max_by("other", F.col("end") - F.col("start")).alias("other"))
    named = named.select(F.col("d1").alias("other"), F.col("id").alias("other_id")).distinct()
    return spans.join(named, "other").select("id", "start_word", (F.col("last") - F.col("start_word")).alias("n_words"), "other_id")
