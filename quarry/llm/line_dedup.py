"""Line deduplication by range-partitioned hashes (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import SPACES, ascii_lower, hash128, materialise


def line_key(line: Column) -> Column:
    """White space stripped at both ends, A-Z lowered."""
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def _document(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, text (null is empty) and the 128-bit key d1, d2 of a document."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    d1, d2 = hash128(F.col(id_col), text)
    return docs.select(F.col(id_col).alias("id"), text.alias("text"), d1.alias("d1"), d2.alias("d2"))


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10,
                  min_chars: int = 1, keep_first: bool = False, hot_share: int | None = None) -> DataFrame:
    """Compressed bitmaps of the lines to drop, one row per document that loses any.

    Lines become 128-bit hashes of their keys.  The hashes are range-
    partitioned and sorted by document and position inside each, and one pass
    over that order marks first occurrences and counts the documents.  Hashes
    of more than 1 / ``hot_share`` of all lines, hence fewer than ``hot_share``,
    are counted by a combined aggregate instead and joined back by broadcast,
    so no hash fills a range by itself.  By default that is the share of one
    range: the session's number of shuffle partitions.

    A key found in at least ``min_docs`` documents loses all its lines, or
    all but its first one (smallest id, then position) with ``keep_first``.

    Returns d1, d2, bits: array of (word, bits), word w holding the lines
    64 w .. 64 w + 63, only words with a dropped line.
    """
    lines = _document(docs, id_col, text_col).select("id", "d1", "d2", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    keyed = lines.select("id", "d1", "d2", "pos", line_key(F.col("line")).alias("key")).filter(
        (F.char_length("key") >= min_chars) & (F.col("key") != ""))
    h1, h2 = hash128(F.col("key"))
    seen = materialise(keyed.select(h1.alias("h1"), h2.alias("h2"), "id", "d1", "d2", "pos"), "lines")

    key, order = ["h1", "h2"], [F.col("id").asc_nulls_last(), F.col("d1"), F.col("d2"), F.col("pos")]
    least = seen.count() // (hot_share or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    hot = materialise(seen.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > least).filter("n > 1").select(*key), "hot-lines")
    first = F.min(F.struct(F.col("id").isNull().alias("u"), *[F.col(c) for c in ("id", "d1", "d2", "pos")])).alias("first")
    per_doc = seen.join(F.broadcast(hot), key, "left_semi").groupBy(*key, "id", "d1", "d2").agg(F.min("pos").alias("pos"))
    often = (per_doc.groupBy(*key).agg(F.count(F.lit(1)).alias("n_docs"), first).filter(F.col("n_docs") >= min_docs)
             .select(*key, *[F.col(f"first.{c}").alias(f"first_{c}") for c in ("d1", "d2", "pos")]))
    is_first = (F.col("d1") == F.col("first_d1")) & (F.col("d2") == F.col("first_d2")) & (F.col("pos") == F.col("first_pos"))
    out_hot = seen.join(F.broadcast(often), key).filter(~is_first if keep_first else F.lit(True))

    ranged = seen.join(F.broadcast(hot), key, "left_anti").repartitionByRange(*key)
    w = Window.partitionBy(*key).orderBy(*order)
    new = F.when(F.lag("d1").over(w).isNull() | (F.lag("d1").over(w) != F.col("d1")) | (F.lag("d2").over(w) != F.col("d2")), 1).otherwise(0)
    streamed = ranged.select("*", new.alias("new"), F.row_number().over(w).alias("nth"))
    counted = streamed.withColumn("n_docs", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    out = counted.filter((F.col("n_docs") >= min_docs) & ((F.col("nth") > 1) if keep_first else F.lit(True)))

    gone = out.select("d1", "d2", "pos").unionByName(out_hot.select("d1", "d2", "pos"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("pos") % 64).cast("int"))
    words = gone.groupBy("d1", "d2", F.floor(F.col("pos") / 64).cast("int").alias("word")).agg(F.bit_or(bit).alias("bits"))
    return words.groupBy("d1", "d2").agg(F.array_sort(F.collect_list(F.struct("word", "bits"))).alias("bits"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10,
               min_chars: int = 1, keep_first: bool = False, hot_share: int | None = None) -> DataFrame:
    """Every document without its repeated lines (see ``dropped_lines``).

    Defined results: a null or empty text is one empty line and stays; lines
    whose key is empty or shorter than ``min_chars`` code points always stay;
    rows that repeat both id and text count as one document and lose the same
    lines; an empty table gives no rows; extra columns are ignored.

    Returns id, n_lines (before dropping), n_dropped, text (kept lines joined
    by newlines).
    """
    bitmaps = dropped_lines(docs, id_col, text_col, min_docs, min_chars, keep_first, hot_share)
    lines = F.split("text", "\n", -1)
    joined = _document(docs, id_col, text_col).join(bitmaps, ["d1", "d2"], "left")
    found = F.map_from_entries("bits")
    dense = F.transform(F.sequence(F.lit(0), F.floor(F.size(lines) / 64).cast("int")),
                        lambda w: F.coalesce(F.try_element_at(found, w), F.lit(0).cast("long")))
    gone = F.flatten(F.transform(dense, lambda word: F.transform(
        F.sequence(F.lit(0), F.lit(63)), lambda i: F.call_function("shiftrightunsigned", word, i).bitwiseAND(F.lit(1).cast("long")) == 1)))
    marked = F.arrays_zip(lines.alias("line"), F.slice(gone, F.lit(1), F.size(lines)).alias("gone"))
    stays = F.transform(F.filter(marked, lambda x: ~x["gone"]), lambda x: x["line"])
    dropped = F.aggregate("bits", F.lit(0).cast("long"), lambda n, b: n + F.bit_count(b["bits"]))
    return joined.select("id", F.size(lines).cast("long").alias("n_lines"), F.coalesce(dropped, F.lit(0).cast("long")).alias("n_dropped"),
                         F.when(F.col("bits").isNull(), F.col("text")).otherwise(F.array_join(stays, "\n")).alias("text"))
