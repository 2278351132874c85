"""Shared helpers of the training-data operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.session import ensure_checkpoint_dir

#: The white space that normal forms delete or strip: [\x20\x09-\x0D].
SPACES = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
_PART_ROWS = 1 << 14  # rows in a part of a small table


def shared_path(spark: SparkSession, what: str) -> str:
    """A new folder name under the cluster's shared folder (``spark.checkpoint.dir``)."""
    if spark.sparkContext.getCheckpointDir() is None and spark.sparkContext.master.startswith("local["):
        # tests and trials on one machine, with no folder named
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="quarry-"))
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, what: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    This cuts the lineage: what is read back no longer depends on any
    executor, and row ids handed out before it stay as they were.
    """
    path = shared_path(df.sparkSession, what)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def few_parts(df: DataFrame, rows: int) -> DataFrame:
    """``df``, known to have at most ``rows`` rows, in parts of some _PART_ROWS rows where these are fewer than shuffle partitions.

    A small table is then written as few files, not as a tiny one a partition;
    what computes its rows keeps its own partitions.
    """
    parts = rows // _PART_ROWS + 1
    return df.repartition(parts) if parts < int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def whole_row(docs: DataFrame) -> Column:
    """All columns of a row as one struct, so that no name of theirs can clash."""
    return F.struct(*[docs[f"`{c}`"].alias(c) for c in docs.columns])


def row_hash(docs: DataFrame) -> Column:
    """A hash of all columns that Spark can hash: tells rows apart that share id and text."""
    plain = [f.name for f in docs.schema.fields if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    return F.xxhash64(*[docs[f"`{c}`"] for c in plain]) if plain else F.lit(0).cast("long")


def delete_spaces(text: Column) -> Column:
    for c in SPACES:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def ascii_lower(text: Column) -> Column:
    """A-Z lowered, every other character left alone (``lower`` also maps É)."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER))


def hash128(*cols: Column) -> tuple[Column, Column]:
    """Two differently seeded 64-bit hashes; a null differs from every value."""
    parts = [x for c in cols for x in (c.isNull(), c)]
    return F.xxhash64(*parts), F.xxhash64(F.lit(1), *parts)


def hot_keys(rows: DataFrame, keys: list[str], most: int) -> DataFrame:
    """The ``most`` keys with the most rows (two at least).

    Counted with map-side combine.  Any key with more than 1/``most`` of all
    rows is among them, and the list has a fixed bound, so it may be broadcast.
    """
    n = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    return n.orderBy(F.desc("_n"), *keys).limit(most)


def ranks(rows: DataFrame, keys: list[str], out: str, buckets: int = 1 << 20, most: int = 1000) -> DataFrame:
    """``rows`` without ``keys`` and ``_h``, but with ``out``: a long that is equal exactly where ``keys`` are equal.

    ``_h`` must be a hash of ``keys``, any one, and ``rows`` a written table: it is
    read several times.  Keys must not be null.  Only distinct keys are
    shuffled, combined map-side, and counted by hash; the hashes are sorted in
    many buckets, and each is given as many names as it has keys.  Rows find
    their name by the hash alone.  Where several keys share a hash, these keys
    are sorted and their rows compared with them.  The ``most`` most frequent
    hashes are joined by broadcast (their names only), the others by a join
    of two written tables.
    """
    rest = [c for c in rows.columns if c not in (*keys, "_h")]
    counted = rows.select("_h", *keys).distinct().groupBy("_h").agg(F.count(F.lit(1)).alias("_n"))
    bucket = F.pmod("_h", F.lit(buckets))
    before = F.sum("_n").over(Window.partitionBy("_bucket").orderBy("_h").rowsBetween(Window.unboundedPreceding, -1))
    names = materialise(counted.withColumn("_bucket", bucket).select(
        "_h", "_n", (F.col("_bucket") * (1 << 40) + F.coalesce(before, F.lit(0))).cast("long").alias("_first")), "key-names")
    hot = hot_keys(rows.select("_h"), ["_h"], most).select("_h")
    hot = F.broadcast(materialise(names.join(F.broadcast(hot), "_h", "left_semi"), "hot-names"))
    slim = rows.select(*rest, "_h")
    single = names.filter("_n = 1").select("_h", "_first")
    named = slim.join(hot.filter("_n = 1").select("_h", "_first"), "_h").unionByName(
        slim.join(hot.select("_h"), "_h", "left_anti").join(single, "_h")).select(*rest, F.col("_first").alias(out))
    shared = names.filter("_n > 1").select("_h", "_first")
    if shared.isEmpty():
        return named
    among = rows.join(shared, "_h")
    nth = F.row_number().over(Window.partitionBy("_h").orderBy(*keys)) - 1
    apart = materialise(among.select("_h", "_first", *keys).distinct().withColumn(out, (F.col("_first") + nth).cast("long")).drop("_first"), "apart")
    return named.unionByName(among.drop("_first").join(apart, ["_h", *keys]).select(*rest, out))
