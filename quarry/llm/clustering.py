"""Centroid clustering of integer vectors with scalar lookup tables."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import materialise

_LONG = (1 << 63) - 1
_SMALL = 1 << 26  # below it, squared differences of 512 components add up in a long


def _usable(v: Column, dim: int, scale: int) -> Column:
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double") * float(scale)) == float("inf")))
    return F.coalesce((F.size(v) == dim) & ~bad, F.lit(False))


def coded_blocks(rows: DataFrame, dim: int, scale: int, block: int) -> DataFrame:
    """Rows (id, v) in blocks of at most ``block`` vectors, each component a number into its block's list of occurring values.

    For each dimension a block holds the occurring values floor(``scale`` * x), ascending, and for each vector
    which of them it has.  Whole numbers of any size are exact: a floored double is one.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[pa.Array] = []
        parts: list[np.ndarray] = []

        def out() -> pa.RecordBatch:
            x = np.floor(scale * np.concatenate(parts)) + 0.0
            lists, codes = zip(*(np.unique(x[:, d], return_inverse=True) for d in range(dim)))
            held = pa.concat_arrays(ids)
            offsets = pa.array([0, len(held)], pa.int32())
            batch = pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(offsets, held), pa.array([np.array([len(v) for v in lists], "<i4").tobytes()]),
                 pa.array([np.concatenate(lists).astype("<f8").tobytes()]), pa.array([np.concatenate(codes).astype("<u2").tobytes()])],
                names=["ids", "sizes", "occurring", "codes"])
            ids.clear()
            parts.clear()
            return batch

        for batch in batches:
            flat = batch.column("v").flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, dim)
            at = 0
            while at < len(flat):
                take = min(len(flat) - at, block - sum(map(len, parts)))
                ids.append(batch.column("id").slice(at, take))
                parts.append(flat[at:at + take])
                at += take
                if sum(map(len, parts)) == block:
                    yield out()
        if parts:
            yield out()

    return rows.mapInArrow(pack, "ids array<bigint>, sizes binary, occurring binary, codes binary")


def _open(sizes: bytes, occurring: bytes, codes: bytes) -> tuple[list[np.ndarray], np.ndarray]:
    ends = np.cumsum(np.frombuffer(sizes, "<i4"))
    lists = np.split(np.frombuffer(occurring, "<f8"), ends[:-1])
    return lists, np.frombuffer(codes, "<u2").reshape(len(ends), -1)


def _whole(values: np.ndarray, small: bool) -> np.ndarray:
    return values.astype(np.int64) if small else np.array([int(v) for v in values.tolist()], object)


def nearest(lists: list[np.ndarray], codes: np.ndarray, centroids: list[list[int]]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(cluster, squared distance, occurring values as integers) of a block's vectors.

    Per dimension a table holds the squared difference of each occurring value and each centroid;
    distances are sums of gathers from these tables.  Numbers too large for longs are Python integers.
    """
    most = max((max(abs(v[0]), abs(v[-1])) for v in lists), default=0.0)
    small = most < _SMALL and max(abs(c) for row in centroids for c in row) < _SMALL and len(lists) <= 512
    ints = [_whole(v, small) for v in lists]
    total = np.zeros((codes.shape[1], len(centroids)), np.int64 if small else object)
    for d, values in enumerate(ints):
        middle = np.array([c[d] for c in centroids], np.int64 if small else object)
        table = (values[:, None] - middle[None, :]) ** 2
        total += table[codes[d]]
    cluster = total.argmin(axis=1).astype(np.int64)  # the first of equal ones: the smaller number
    return cluster, total[np.arange(len(cluster)), cluster], ints


def _limbs(whole: int) -> list[int]:
    """``whole`` = sum of limb j * 2^(32 j): longs whose sums stay longs over 2^31 of them."""
    out = []
    while not -(1 << 31) <= whole < 1 << 31:
        out.append(whole & 0xFFFFFFFF)
        whole >>= 32
    return [*out, whole]


def _moved(blocks: DataFrame, centroids: list[list[int]], dim: int) -> list[list[int]]:
    """The centroids after one round; sums are exact and map-side combined."""
    k = len(centroids)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((k, dim + 1), object)  # the last column counts vectors
        for batch in batches:
            for sizes, occurring, codes in zip(*(batch.column(c).to_pylist() for c in ("sizes", "occurring", "codes"))):
                lists, which = _open(sizes, occurring, codes)
                cluster, _, ints = nearest(lists, which, centroids)
                for d, values in enumerate(ints):
                    n = np.bincount(cluster * len(values) + which[d], minlength=k * len(values)).reshape(k, -1)
                    sums[:, d] += n.astype(values.dtype).dot(values)
                sums[:, dim] += np.bincount(cluster, minlength=k)
        found = [(c, d, j, limb) for c in range(k) for d in range(dim + 1) for j, limb in enumerate(_limbs(int(sums[c, d]))) if limb]
        yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.int32(), pa.int64()))],
                                         names=["cluster", "d", "limb", "part"])

    parts = blocks.select("sizes", "occurring", "codes").mapInArrow(add, "cluster int, d int, limb int, part long")
    sums = [[0] * (dim + 1) for _ in centroids]
    for r in parts.groupBy("cluster", "d", "limb").agg(F.sum("part").alias("part")).collect():  # k * dim sums, a few limbs each
        sums[r["cluster"]][r["d"]] += r["part"] << 32 * r["limb"]
    return [[s // row[dim] for s in row[:dim]] if row[dim] else old for row, old in zip(sums, centroids)]


def cluster_vectors(vectors: DataFrame, k: int = 8, rounds: int = 10, dim: int = 64, scale: int = 1024, seed: int = 3,
                    id_col: str = "vec_id", vec_col: str = "embedding", block: int = 16384) -> DataFrame:
    """Lloyd's rounds over integer vectors, exact and the same on every partitioning.

    Vectors of exactly ``dim`` finite components take part, each component
    as floor(``scale`` * x).  The ``k`` vectors with the smallest SHA-256 of
    "seed:id" are the first centroids.  Each round assigns every vector to its
    nearest centroid (ties: smaller number) and replaces each centroid that
    has vectors by their componentwise floored mean; after ``rounds`` of them
    vectors are assigned once more.  Vectors are packed once into written
    blocks; a round sends k * dim sums a task.

    Defined results: vectors that are null, of another length, or hold a null
    or non-finite component (also one beyond doubles after scaling) give no
    row; a null id hashes as "null"; rows equal in id are ordered by their
    vector and each take part; fewer than ``k`` vectors are that many
    centroids; distances and inertias are held to the range of long; an empty
    table gives no rows; other columns are not looked at.

    Returns vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.
    """
    if not 0 < block <= 1 << 16:
        raise ValueError("block: 1 to 65,536 vectors")
    spark = vectors.sparkSession
    kept = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v")).filter(_usable(F.col("v"), dim, scale))
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("null"))).cast("binary")
    blocks = materialise(coded_blocks(kept, dim, scale, block), "coded-vectors")
    first = kept.select(F.sha2(name, 256).alias("h"), "id", "v").orderBy("h", "id", "v").limit(k).collect()
    centroids = [[int(np.floor(scale * float(x))) for x in r["v"]] for r in first]
    for _ in range(rounds if centroids else 0):
        centroids = _moved(blocks, centroids, dim)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                lists, codes = _open(*(batch.column(c)[i].as_py() for c in ("sizes", "occurring", "codes")))
                cluster, distance, _ = nearest(lists, codes, centroids)
                held = distance if distance.dtype != object else [min(x, _LONG) for x in distance]
                yield pa.RecordBatch.from_arrays([batch.column("ids")[i].values, pa.array(cluster, pa.int32()), pa.array(held, pa.int64())],
                                                 names=["vec_id", "cluster", "distance"])

    found = materialise(blocks.mapInArrow(assign, "vec_id long, cluster int, distance long"), "assigned")
    inertia = {r["cluster"]: int(r["s"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("s")).collect()}
    facts = [(c, min(inertia.get(c, 0), _LONG), min(sum(inertia.values()), _LONG), hashlib.sha256(",".join(map(str, row)).encode()).hexdigest())
             for c, row in enumerate(centroids)]
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
