"""Exact deduplication by deterministic block naming (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import delete_spaces, hash128, materialise, ranks, row_hash, whole_row

_NONE = -(1 << 63)  # no right neighbour
_INFO = ("id", "d1", "d2", "chars", "sha")


def name_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = 4096) -> DataFrame:
    """One row per document with a collision-free identity of its normal form.

    The normal form (text without white space; null is empty) is cut into
    blocks of ``block`` code points.  Equal blocks get equal integer names by
    sorting; then the names of adjacent pairs are named again until one is
    left, so ``n_blocks`` and ``name`` are equal exactly for equal normal
    forms.  No hash decides: where two blocks share one, they are compared.

    Returns row, id, d1, d2 (128-bit key of id and text), chars (code points
    of the original), sha (of the normal form), n_blocks, name.  ``row`` numbers the input rows, so repeated rows
    and repeated or null ids stay apart.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    d1, d2 = hash128(F.col(id_col), text)
    norm = docs.select(F.col(id_col).alias("id"), d1.alias("d1"), d2.alias("d2"), F.char_length(text).alias("chars"), delete_spaces(text).alias("norm"))
    cut = norm.select(
        F.monotonically_increasing_id().alias("row"), "id", "d1", "d2", "chars", F.unhex(F.sha2("norm", 256)).alias("sha"),
        F.when(F.col("norm") == "", F.array(F.lit("")))
        .otherwise(F.regexp_extract_all("norm", F.lit(f"(?s).{{1,{block}}}"), F.lit(0))).alias("blocks"))
    first = F.col("pos") == 0
    blocks = materialise(
        cut.select("row", *_INFO, F.size("blocks").alias("n_blocks"), F.posexplode("blocks").alias("pos", "block"))
        .select("row", "pos", "n_blocks", *[F.when(first, F.col(c)).alias(c) for c in _INFO], "block", F.xxhash64("block").alias("_h")), "blocks")

    level = materialise(ranks(blocks, ["block"], "name"), "names")
    info = level.filter(first).select("row", *_INFO, "n_blocks", "name")
    single = info.filter("n_blocks = 1")
    closed, names = [], level.filter("n_blocks > 1").select("row", "n_blocks", "pos", "name")
    left = blocks.agg(F.max("n_blocks")).first()[0] or 1
    while left > 1:
        half = F.floor(F.col("pos") / 2).cast("int")
        pairs = names.groupBy("row", "n_blocks", half.alias("at")).agg(
            F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("l"),
            F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(_NONE)).alias("r"))
        pairs = materialise(pairs.withColumnRenamed("at", "pos").withColumn("_h", F.xxhash64("l", "r")), "pairs")
        left = -(-left // 2)
        names = materialise(ranks(pairs, ["l", "r"], "name"), "names")
        # a document is done once no second name is left
        more = names.groupBy("row").agg(F.max("pos").alias("top")).filter("top > 0").select("row") if left > 1 else None
        if more is None:
            closed.append(names.select("row", "name"))
        else:
            done = names.join(more, "row", "left_anti")
            closed.append(done.select("row", "name"))
            names = names.join(more, "row", "left_semi")
    if not closed:
        return single
    whole = closed[0]
    for c in closed[1:]:
        whole = whole.unionByName(c)
    return single.unionByName(info.filter("n_blocks > 1").drop("name").join(whole, "row"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = 4096) -> DataFrame:
    """Groups of documents whose texts are equal without white space.

    Of each group the row with the most code points in its original text
    stays, then the smallest id (a null id comes last), then the first row.

    Defined results: null text counts as empty, and empty texts are one
    group; repeated rows are members of their group and exactly one row of a
    group stays; an empty table gives no rows; extra columns are ignored,
    whatever their names.

    Returns row, id, d1, d2, keep_row, keep_id, group_size, kept, text_sha256.
    """
    named = materialise(name_documents(docs, id_col, text_col, block), "identities")
    best = F.min(F.struct((-F.col("chars")).alias("c"), F.col("id").isNull().alias("u"), F.col("id"), F.col("row")))
    groups = materialise(
        named.groupBy("n_blocks", "name").agg(F.count(F.lit(1)).alias("group_size"), best.alias("b"))
        .select("n_blocks", "name", "group_size", F.col("b.id").alias("keep_id"), F.col("b.row").alias("keep_row")), "groups")
    return (named.join(groups, ["n_blocks", "name"])
            .select("row", "id", "d1", "d2", "keep_row", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
                    F.lower(F.hex("sha")).alias("text_sha256")))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts; all columns stay.

    Kept rows are found again by a 128-bit hash of id and text; of rows that
    repeat both, the one with the lowest hash of all its columns stays.
    Null, empty and repeated rows as in ``exact_dedup``.
    """
    kept = exact_dedup(docs, id_col, text_col).filter("kept").select("d1", "d2")
    d1, d2 = hash128(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")))
    held = docs.select(whole_row(docs).alias("doc"), d1.alias("d1"), d2.alias("d2"), row_hash(docs).alias("tie"))
    w = Window.partitionBy("d1", "d2").orderBy("tie")
    return held.join(kept, ["d1", "d2"], "left_semi").withColumn("nth", F.row_number().over(w)).filter("nth = 1").select("doc.*")
