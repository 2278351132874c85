"""Importance resampling to a target's distribution: array-scored weights, Gumbel keys, distributed quickselect."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import materialise
from quarry.llm.letters import PIECE, Words, distinct_words, word_runs
from quarry.llm.quickselect import smallest_ranked


def feature_buckets(run: Words, longest: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, bucket) of all runs of 1 to ``longest`` words, by their number of words.

    A feature's bucket is the unsigned CRC-32 of its words joined by one blank, modulo ``buckets``.
    """
    words, which = distinct_words(run)
    row = run.rows()
    names, code = words, which
    for n in range(1, longest + 1):
        if n > 1:  # name runs of n words by the run of n - 1 and the word after it
            pair, code = np.unique(code[:-1] * max(1, len(words)) + which[n - 1:], return_inverse=True)
            names = [names[p // len(words)] + b" " + words[p % len(words)] for p in pair.tolist()]
        if not len(code):
            return
        bucket = np.fromiter((zlib.crc32(w) % buckets for w in names), np.int64, len(names))
        ends = np.arange(len(code)) + n - 1
        mine = (row[:len(code)] == row[ends]) & (ends >= run.fresh)
        yield row[:len(code)][mine], bucket[code[mine]]


def bucket_counts(texts: DataFrame, text_col: str, longest: int, buckets: int, piece: int = PIECE) -> np.ndarray:
    """How many features of all texts are in each bucket; each task counts in one array."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for run in word_runs(batch.column(0), longest - 1, piece):
                for _, bucket in feature_buckets(run, longest, buckets):
                    total += np.bincount(bucket, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some], pa.int64())], names=["bucket", "n"])

    partial = texts.select(F.col(text_col).alias("text")).mapInArrow(count, "bucket int, n long")
    out = np.zeros(buckets, np.int64)
    for r in partial.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most ``buckets`` rows
        out[r["bucket"]] = r["n"]
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Each bucket's floored 1000-fold log ratio of smoothed target and source shares."""
    n, s, t = len(source), float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((b + 1.0) * (s + n) / ((a + 1.0) * (t + n)))) for a, b in zip(source.tolist(), target.tolist())], np.int64)


def target_weights(docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = 10000, id_col: str = "doc_id",
                   text_col: str = "text", target_col: str = "text", piece: int = PIECE) -> DataFrame:
    """(id, n_words, n_features, weight) of every row: the floored mean of its features' gains, 0 without features."""
    gains = bucket_gains(bucket_counts(docs, text_col, longest, buckets, piece), bucket_counts(target, target_col, longest, buckets, piece))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, features, total = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for run in word_runs(batch.column("text"), longest - 1, piece):
                np.add.at(words, np.arange(run.start_row, run.start_row + len(run.first) - 1), np.diff(run.first))
                words[run.start_row] -= run.fresh
                for row, bucket in feature_buckets(run, longest, buckets):
                    features += np.bincount(row, minlength=batch.num_rows)
                    total += np.bincount(row, weights=gains[bucket], minlength=batch.num_rows).astype(np.int64)  # whole numbers below 2^53
            weight = total // np.maximum(features, 1)
            yield pa.RecordBatch.from_arrays([batch.column("id"), *[pa.array(x, pa.int64()) for x in (words, features, weight)]],
                                             names=["id", "n_words", "n_features", "weight"])

    return rows.mapInArrow(weigh, f"id {kind}, n_words long, n_features long, weight long")


def importance_resample(docs: DataFrame, target: DataFrame, percent: int = 10, min_words: int = 20, seed: int = 2024, longest: int = 1,
                        buckets: int = 10000, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", piece: int = PIECE) -> DataFrame:
    """Draw ``percent`` of the documents of ``min_words`` words or more so that they resemble ``target``.

    Features (runs of 1 to ``longest`` words, repeats counted) fall into
    buckets by CRC-32; exact counts over all documents and all target texts
    give each bucket a gain, kept in one array.  A document's weight is the
    floored mean gain; with Gumbel noise from a hash of seed and id it becomes
    its score.  A distributed quickselect finds the last drawn key (score
    down, id up); only the drawn rows are sorted and ranked.

    Defined results: a null or empty text has no words, weight 0 and is never
    drawn (unless ``min_words`` is 0); a null id hashes as "null" and comes
    after all others of its score; rows equal in score and id are drawn in
    the order of the written table; an empty target, or an empty table of
    documents, counts as 0 features; other columns are not looked at.

    Returns one row per document: id, n_words, n_features, weight, score,
    rank (from 1; null where not drawn).
    """
    rows = target_weights(docs, target, longest, buckets, id_col, text_col, target_col, piece)
    text_id = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(text_id.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000.0 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")
    scored = materialise(rows.withColumn("score", F.col("weight") + noise).withColumn("_row", F.monotonically_increasing_id()), "scores")
    able = scored.filter(F.col("n_words") >= min_words)
    k = able.count() * percent // 100
    key = F.struct((-F.col("score")).alias("down"), F.col("id").isNull().alias("no_id"), "id", "_row")
    drawn = smallest_ranked(materialise(able.select(key.alias("key")), "keys"), k, seed).select(F.col("key._row").alias("_row"), "rank")
    return scored.join(drawn, "_row", "left").select("id", "n_words", "n_features", "weight", "score", "rank")
