"""Benchmark decontamination: a prefix-filtered join of word shingles, confirmed on the words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import few_parts, materialise
from quarry.llm.letters import Words, word_runs
from quarry.llm.words import grams, mix, word_hashes

PIECE = 1 << 20  # bytes looked at together, unless one word is longer: arrays of a piece are many times as large
_MOST_SLOTS = 1 << 27  # bits of the filter that every task gets: 16 MB at most
_BLOCK = 1 << 16  # words of a document whose hits are counted together
_BATCH = 10_000


def shingle_hashes(run: Words, width: int, start: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of each run of ``width`` words inside one row: those with a word not seen before, or all from word ``start`` on."""
    n = len(run) - width + 1
    if n < 1:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    row = run.rows()
    start = run.fresh - width + 1 if start is None else start
    mine = np.flatnonzero((row[:n] == row[width - 1:]) & (np.arange(n) >= start))
    hashes = grams(word_hashes(run.text, run.at[:-1], run.at[1:] - 1), width)
    return mine, mix(hashes[mine] ^ np.uint64(width))


class SlotFilter:
    """A bit set of hashes in which each has two slots: no hash of the set is refused."""

    def __init__(self, bits: int, words: np.ndarray):
        self.bits, self.words = bits, words

    @staticmethod
    def of(hashes: DataFrame) -> SlotFilter:
        """The filter of a column ``h``: 128 bits a distinct value, _MOST_SLOTS in all at most.

        It is put together by tasks; the driver gets one long for 64 slots, so its size is bounded whatever the table's.
        """
        n = hashes.distinct().count()
        bits = min(_MOST_SLOTS.bit_length() - 1, max(16, (128 * n).bit_length()))
        slots = hashes.select(F.explode(F.array(F.shiftrightunsigned("h", 64 - bits), F.col("h").bitwiseAND((1 << bits) - 1))).alias("s"))
        one = F.expr("shiftleft(1L, cast(s & 63 as int))")
        words = np.zeros(1 << (bits - 6), np.int64)
        found = slots.groupBy(F.shiftright("s", 6).cast("int").alias("w")).agg(F.bit_or(one).alias("b")).toArrow()
        words[found.column("w").to_numpy()] = found.column("b").to_numpy()
        return SlotFilter(bits, words.view(np.uint64))

    def _has(self, slot: np.ndarray) -> np.ndarray:
        return (self.words[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1

    def may_have(self, hashes: np.ndarray) -> np.ndarray:
        out = self._has(hashes >> np.uint64(64 - self.bits))
        out[out] = self._has(hashes[out] & np.uint64((1 << self.bits) - 1))
        return out


def _batch(columns: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def item_windows(items: DataFrame, window: int, id_col: str, text_col: str, piece: int = PIECE) -> tuple[DataFrame, DataFrame]:
    """Written tables (wid, window, n) of distinct windows and (wid, item) of the items that hold them.

    ``window`` is the words, each with a blank before and after; ``n`` how many.
    """
    rows = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("item"), F.col(text_col).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in word_runs(batch.column("text"), window, piece):
                text, at, row = b" " + run.text.tobytes(), run.at, run.rows()
                ends = np.minimum(np.arange(len(run)) + window, np.repeat(run.first[1:], np.diff(run.first)))
                full = ends - np.arange(len(run)) == window
                short = (np.isin(np.arange(len(run)), run.first[:-1]) & ~full) if not run.fresh else np.zeros(len(run), bool)
                starts = np.flatnonzero(full & (ends > run.fresh) | short)
                for a in range(0, len(starts), _BATCH):
                    s = starts[a:a + _BATCH]
                    yield _batch({"item": batch.column("item").take(pa.array(row[s])), "window": pa.array([text[at[i]:at[j] + 1] for i, j in zip(s, ends[s])], pa.binary()),
                                  "n": pa.array(ends[s] - s, pa.int32())})

    held = materialise(rows.mapInArrow(cut, "item string, window binary, n int"), "item-windows")
    most = held.count()
    distinct = few_parts(held.select("window", "n").distinct(), most)
    distinct = materialise(distinct.withColumn("wid", F.monotonically_increasing_id()), "windows")
    return distinct, materialise(few_parts(held.join(distinct, ["window", "n"]).select("wid", "item").distinct(), most), "window-items")


def _window_shingles(windows: DataFrame, shingle: int) -> DataFrame:
    """(wid, width, p, lead, h): each window's shingles of min(``shingle``, its length) words; ``lead`` bytes stand before word p."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wid = batch.column("wid").to_numpy()
            for run in word_runs(batch.column("window").cast(pa.string()), limit=1 << 62):  # windows have few words
                size, row = np.diff(run.first), run.rows() - run.start_row
                for width in range(1, shingle + 1):
                    place, h = shingle_hashes(run, width)
                    own = np.minimum(size, shingle)[row[place]] == width
                    place, h = place[own], h[own]
                    begin = run.first[row[place]]
                    yield _batch({"wid": pa.array(wid[run.start_row + row[place]]), "width": pa.array(np.full(len(place), width), pa.int32()),
                                  "p": pa.array(place - begin, pa.int32()), "h": pa.array(h.view(np.int64)),
                                  "lead": pa.array(1 + run.at[place] - run.at[begin], pa.int32())})

    return windows.select("wid", "window").mapInArrow(cut, "wid long, width int, p int, h long, lead int")


def _frequencies(docs: DataFrame, shingles: DataFrame, widths: list[int], piece: int) -> DataFrame:
    """(h, n): how often each of ``shingles`` stands in all documents; one pass over the texts, counted in tasks first."""
    wanted = SlotFilter.of(shingles.select("h"))
    most = max(widths, default=1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in word_runs(batch.column(0), most - 1, piece):
                for width in widths:
                    _, h = shingle_hashes(run, width)
                    h, n = np.unique(h[wanted.may_have(h)], return_counts=True)
                    if len(h):
                        yield _batch({"h": pa.array(h.view(np.int64)), "n": pa.array(n, pa.int64())})

    found = docs.select("text").mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    return found.join(shingles.select("h").distinct(), "h", "left_semi")


def _hits(docs: DataFrame, prefixes: DataFrame, widths: list[int], window: int, piece: int) -> DataFrame:
    """One row (``h`` null) per document with its row number, id and number of words, and one per place where a prefix shingle may stand.

    ``near`` holds the up to ``window`` - 1 words before the place and those after it, ``lead`` says how many bytes
    stand before the place, ``after`` how many words from it on (``window`` at most).
    """
    wanted = SlotFilter.of(prefixes.select("h"))
    kind = docs.schema["id"].dataType.simpleString()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            ids, total = batch.column("id"), np.zeros(batch.num_rows, np.int64)
            for run in word_runs(batch.column("text"), 2 * window, piece):
                size = np.diff(run.first)
                np.add.at(total, np.arange(run.start_row, run.start_row + len(size)), size)
                total[run.start_row] -= run.fresh
                text, row = None, run.rows()
                for width in widths:
                    place, h = shingle_hashes(run, width, max(0, run.fresh - window))
                    if not run.last:  # places near the end are left to the next piece, which has the words after them
                        early = place < len(run) - window
                        place, h = place[early], h[early]
                    some = wanted.may_have(h)
                    place, h = place[some], h[some]
                    text = text or (b" " + run.text.tobytes() if len(place) else None)
                    for a in range(0, len(place), _BATCH):
                        p = place[a:a + _BATCH]
                        mine = row[p] - run.start_row
                        low = np.maximum(p - window + 1, run.first[mine])
                        high = np.minimum(p + window, run.first[mine + 1])
                        near = [text[run.at[i]:run.at[j] + 1] for i, j in zip(low, high)]
                        yield _batch({"row": pa.array(number + row[p], pa.int64()), "id": ids.take(pa.array(row[p])), "n_words": pa.nulls(len(p), pa.int64()),
                                      "h": pa.array(h[a:a + _BATCH].view(np.int64)), "pos": pa.array(run.base + p - run.first[mine], pa.int64()),
                                      "after": pa.array(high - p, pa.int32()), "lead": pa.array(1 + run.at[p] - run.at[low], pa.int32()), "near": pa.array(near, pa.binary())})
            n = batch.num_rows
            yield _batch({"row": pa.array(number + np.arange(n), pa.int64()), "id": ids, "n_words": pa.array(total), "h": pa.nulls(n, pa.int64()),
                          "pos": pa.nulls(n, pa.int64()), "after": pa.nulls(n, pa.int32()), "lead": pa.nulls(n, pa.int32()), "near": pa.nulls(n, pa.binary())})
            number += n

    return docs.mapInArrow(find, f"row long, id {kind}, n_words long, h long, pos long, after int, lead int, near binary")


def window_occurrences(docs: DataFrame, items: DataFrame, window: int = 10, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text",
                       item_col: str = "item_id", item_text: str = "text", piece: int = PIECE) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Written tables (row, id, n_words), (row, start, n, wid) and (wid, item): documents, where windows of items stand in them, and whose they are.

    Every distinct window is a set of shingles.  All shingles are ordered by
    their number in all documents; as a window is contained only if all its
    shingles are, its rarest one is its whole necessary prefix.  Documents
    give the places where a prefix may stand (one bounded filter, no shuffle
    of other words); the join on the prefix is bounded by position (enough
    words before) and length (enough after) and verified word by word.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    windows, owners = item_windows(items, window, item_col, item_text, piece)
    shingles = materialise(_window_shingles(windows, shingle), "window-shingles")
    widths = sorted(r["width"] for r in shingles.select("width").distinct().collect())  # ``shingle`` of them at most
    often = materialise(few_parts(_frequencies(rows, shingles, widths, piece), shingles.count()), "shingle-counts")
    # a window with a shingle that no document has occurs nowhere
    known = shingles.join(often, "h", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rarest = known.groupBy("wid").agg(F.min(F.struct("n", "h", "p", "lead", "width")).alias("s")).filter("s.n > 0")
    prefixes = rarest.join(windows, "wid").select("wid", "s.h", "s.width", "s.p", F.col("s.lead").alias("skip"), "window", F.col("n").alias("size"))
    prefixes = materialise(few_parts(prefixes, windows.count()), "window-prefixes")
    widths = sorted(r["width"] for r in prefixes.select("width").distinct().collect())
    found = materialise(_hits(rows, prefixes, widths, window, piece), "prefix-hits")
    places = found.filter(F.col("h").isNotNull()).select("row", "h", "pos", "after", "lead", "near")
    enough = (F.col("pos") >= F.col("p")) & (F.col("size") - F.col("p") <= F.col("after")) & (F.col("lead") >= F.col("skip"))
    same = F.substr("near", F.col("lead") - F.col("skip") + 1, F.octet_length("window")) == F.col("window")
    spans = places.join(prefixes, "h").filter(enough).filter(same)
    spans = spans.select("row", (F.col("pos") - F.col("p")).alias("start"), F.col("size").alias("n"), "wid")
    return found.filter(F.col("h").isNull()).select("row", "id", "n_words"), materialise(spans, "occurrences"), owners


def covered_words(spans: DataFrame) -> DataFrame:
    """(row, n_hit): how many words of each row lie inside spans (row, start, n).

    Spans are cut at blocks of _BLOCK words, so that a very long document's are counted in many tasks.
    """
    end = F.col("start") + F.col("n")
    block = F.explode(F.sequence(F.floor(F.col("start") / _BLOCK), F.floor((end - 1) / _BLOCK))).alias("block")
    parts = spans.select("row", block, "start", end.alias("end"))
    parts = parts.select("row", "block", F.greatest("start", F.col("block") * _BLOCK).alias("s"), F.least("end", (F.col("block") + 1) * _BLOCK).alias("e"))
    parts = parts.groupBy("row", "block", "s").agg(F.max("e").alias("e"))
    w = Window.partitionBy("row", "block").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    new = F.greatest(F.lit(0), F.col("e") - F.greatest("s", F.coalesce(F.max("e").over(w), F.lit(0))))
    return parts.select("row", new.alias("new")).groupBy("row").agg(F.sum("new").alias("n_hit"))


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 10, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", piece: int = PIECE) -> DataFrame:
    """How much of each document stands in a benchmark, and in which items.

    A window is ``window`` consecutive words of an item, or all words of a
    shorter one; a document's word is hit if it lies in an occurrence of a
    window.  See ``window_occurrences`` for the join.

    Defined results: null and empty texts have no words, so no windows and no
    hits; items equal in id are one item, a null id is the item "null";
    windows that several items share count for each; documents are rows, so
    repeated ids and null ids keep a row each; an empty benchmark gives every
    document 0 hits and an empty list, an empty table no rows; other columns
    are not looked at.  Longer texts than ``piece`` bytes are read in pieces.

    Returns one row per document: id, n_words, n_hit, items (strings, sorted).
    """
    rows, spans, owners = window_occurrences(docs, items, window, shingle, id_col, text_col, item_col, item_text, piece)
    found = spans.join(owners, "wid").select("row", "item").distinct().groupBy("row").agg(F.array_sort(F.collect_list("item")).alias("items"))
    out = rows.join(covered_words(spans), "row", "left").join(found, "row", "left")
    out = out.select("id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                     F.coalesce("items", F.array().cast("array<string>")).alias("items"))
    return few_parts(out, rows.count())
