"""Exact top-k inner products with multi-resolution segment statistics."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import materialise

LEVELS = (4, 16)  # segments, coarse to fine
_BLOCK = "dim int, n int, wide boolean, ids binary, values binary"


def _matrix(wide: bool, raw: bytes, dim: int) -> np.ndarray:
    return np.frombuffer(raw, "<f8" if wide else "<i2").reshape(-1, dim).astype(np.float64)


def _blocks(rows: DataFrame, scale: int, size: int) -> DataFrame:
    """Rows (id, v) as blocks of at most ``size`` vectors of one dimension, quantised to floor(scale * x)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def block(dim: int) -> pa.RecordBatch:
            ids, values = (np.concatenate(x) for x in zip(*held.pop(dim)))
            wide = bool(np.abs(values).max() >= 1 << 15)
            return pa.RecordBatch.from_arrays(
                [pa.array([dim], pa.int32()), pa.array([len(ids)], pa.int32()), pa.array([wide]), pa.array([ids.astype("<i8").tobytes()]),
                 pa.array([values.astype("<f8" if wide else "<i2").tobytes()])], names=["dim", "n", "wide", "ids", "values"])

        for batch in batches:
            vectors, ids = batch.column("v"), batch.column("id")
            length = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            flat = vectors.flatten()
            x = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)
            bad = ~np.isfinite(x)
            row = np.repeat(np.arange(len(length)), length)
            good = length > 0
            good[row[bad]] = False
            first = np.cumsum(length) - length
            for dim in np.unique(length[good]):
                which = np.flatnonzero(good & (length == dim))
                for at in range(0, len(which), size):
                    part = which[at:at + size]
                    values = np.floor(scale * x[first[part][:, None] + np.arange(dim)])
                    held.setdefault(int(dim), []).append((ids.take(pa.array(part)).to_numpy(zero_copy_only=False), values))
                    if sum(len(i) for i, _ in held[int(dim)]) >= size:
                        yield block(int(dim))
        for dim in list(held):
            yield block(dim)

    return rows.mapInArrow(pack, _BLOCK)


def segment_features(x: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of each segment, scaled so that products of features bound inner products.

    For segments of length l, the squared distance of two vectors is at least
    the sum of l * ((difference of means)^2 + (difference of deviations)^2).
    The first segments are the shortest.
    """
    dim = x.shape[1]
    edges = np.unique(np.round(dim * (np.arange(1, segments + 1) / segments) ** 2).astype(int))
    out, start = [], 0
    for end in edges[edges > 0]:
        s = x[:, start:end]
        out += [s.mean(1) * (end - start) ** 0.5, s.std(1) * (end - start) ** 0.5]
        start = end
    return np.stack(out, 1)


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """All integer inner products, held to the range of int64; whole numbers below 2^53 are exact in doubles in any order."""
    if np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * q.shape[1] < 2 ** 53:
        return (q @ x.T).astype(np.int64)
    low, high = -(1 << 63), (1 << 63) - 1
    left, right = ([[int(v) for v in r] for r in m] for m in (q, x))
    return np.array([[min(max(sum(a * b for a, b in zip(r, s)), low), high) for s in right] for r in left], np.int64)


def near_order(x: np.ndarray, size: int) -> np.ndarray:
    """An order of the rows in which runs of ``size`` lie near each other: halves along the widest axis, again and again."""
    parts, out = [np.arange(len(x))], []
    while parts:
        part = parts.pop()
        if len(part) <= size:
            out.append(part)
            continue
        own = x[part, np.argmax(x[part].std(0))]
        half = -(-len(part) // (2 * size)) * size
        part = part[np.argsort(own, kind="stable")]
        parts += [part[half:], part[:half]]
    return np.concatenate(out)


class _Best:
    """The ``k`` highest scores so far of each query of a block.

    Bounds are taken along the queries' principal axes, an orthogonal turn
    that changes no product: there the first, shortest segments hold most.
    Queries are compared in tiles of near ones, so that whole tiles fall away.
    """

    def __init__(self, ids: np.ndarray, q: np.ndarray, k: int, tile: int = 32):
        self.tile = tile
        size = np.abs(q).max(initial=0) or 1.0
        self.axes = np.linalg.eigh((q / size).T @ (q / size))[1][:, ::-1]
        turned = q @ self.axes
        order = near_order(turned, tile)
        self.ids, self.q, self.k = ids[order], q[order], k
        self.slot = order
        self.norm = (self.q * self.q).sum(1)
        self.features = [segment_features(turned[order], n) for n in LEVELS]
        self.score = [np.empty(0, np.int64)] * len(ids)
        self.vec = [np.empty(0, np.int64)] * len(ids)
        self.floor = np.full(len(ids), -np.inf)
        self.seen = self.scored = 0  # pairs in all, and those with an exact score

    def _bounds(self, level: int, rows: np.ndarray, norm: np.ndarray, features: np.ndarray) -> np.ndarray:
        """Upper bounds of products: lower bounds of squared distances, turned round."""
        nq, nx = self.norm[rows][:, None], norm[None, :]
        distance = nq + nx - 2 * (self.features[level][rows] @ features.T)
        return (nq + nx - distance) / 2 + 1 + 1e-9 * (nq + nx)

    def see(self, ids: np.ndarray, x: np.ndarray, step: int = 256) -> None:
        norm = (x * x).sum(1)
        turned = x @ self.axes
        features = [segment_features(turned, n) for n in LEVELS]
        for top in range(0, len(self.ids), self.tile):
            tile = np.arange(top, min(top + self.tile, len(self.ids)))
            self.seen += len(tile) * len(ids)
            coarse = self._bounds(0, tile, norm, features[0])
            high = coarse.max(0)
            order = np.argsort(-high, kind="stable")  # the most promising vectors raise the floor soonest
            for at in range(0, len(ids), step):
                cols, rows = order[at:at + step], tile
                if high[cols[0]] < self.floor[tile].min():
                    break
                bound = coarse[:, cols]
                for level in range(len(LEVELS)):
                    if level:
                        bound = self._bounds(level, rows, norm[cols], features[level][cols])
                    alive = bound >= self.floor[rows][:, None]
                    rows, cols = rows[alive.any(1)], cols[alive.any(0)]
                    if not len(rows):
                        break
                if len(rows):
                    self._score(rows, ids[cols], x[cols])

    def _score(self, rows: np.ndarray, ids: np.ndarray, x: np.ndarray) -> None:
        """Exact scores of some queries with some vectors, as one matrix product."""
        self.scored += len(rows) * len(ids)
        score = _products(self.q[rows], x)
        good = self.ids[rows][:, None] != ids[None, :]
        good &= score >= self.floor[rows][:, None]
        if len(ids) > self.k + 1:  # one may be the query's own
            good &= score >= np.partition(score, -self.k - 1, axis=1)[:, -self.k - 1][:, None]
        i, j = np.nonzero(good)
        start = np.searchsorted(i, np.arange(len(rows) + 1))
        for r in np.unique(i):
            part, n = slice(start[r], start[r + 1]), rows[r]
            s, v = np.append(self.score[n], score[r, j[part]]), np.append(self.vec[n], ids[j[part]])
            best = np.lexsort((v, ~s))[:self.k]  # ~s: descending without overflow
            self.score[n], self.vec[n] = s[best], v[best]
            if len(best) == self.k:
                self.floor[n] = self.score[n][-1]


def top_inner_products(vectors: DataFrame, queries: Column, k: int = 5, scale: int = 256, id_col: str = "vec_id",
                       vec_col: str = "embedding", query_block: int = 4096, block: int = 16384) -> DataFrame:
    """The ``k`` rows of highest integer inner product for each row that fulfils ``queries``.

    Components become floor(scale * x).  Queries and candidates are packed
    into blocks of bounded size, and each pair of blocks is a piece of work
    dealt by a grid key.  In it, segment means and deviations bound each
    distance from below, coarse to fine, along the principal axes of the
    queries.  Vectors whose bound reaches no k-th best so far fall away; the
    others are scored exactly, a tile of near queries as one matrix product.

    Defined results: rows with a null id, a null or empty vector, or a null
    or non-finite component take no part; vectors of different dimensions
    don't meet; a row is no candidate for a query of its own id; ties go to
    the smaller id; fewer rows than ``k`` are all returned; repeated queries
    are answered each; scores are held to the range of long; an empty table
    gives no rows.

    Returns query_id, rank (from 1), vec_id, score.
    """
    rows = vectors.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v"), queries.alias("asked"))
    asked = rows.filter("asked").select("id", "v")
    pool = materialise(_blocks(rows.select("id", "v"), scale, block), "vector-blocks")
    wanted = asked.count()
    q = _blocks(asked.repartition(max(1, -(-wanted // query_block))), scale, query_block)
    q = materialise(q.withColumn("block", F.monotonically_increasing_id()), "query-blocks")  # blocks of repeated queries may be equal
    across, down = max(1, q.count()), max(1, pool.count())
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = q.select("block", "dim", F.pmod(F.xxhash64("ids"), F.lit(across)).cast("int").alias("gq"), each(down).alias("gc"),
                    F.col("wide").alias("q_wide"), F.col("ids").alias("q_ids"), F.col("values").alias("q_values"))
    right = pool.select("dim", each(across).alias("gq"), F.pmod(F.xxhash64("ids"), F.lit(down)).cast("int").alias("gc"), "wide", "ids", "values")
    cells = left.join(right, ["dim", "gq", "gc"]).select("block", "dim", "q_wide", "q_ids", "q_values", "wide", "ids", "values")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[int, _Best] = {}

        def found() -> Iterator[pa.RecordBatch]:
            for key, best in open_.items():
                n = [len(s) for s in best.score]
                at = np.repeat(np.arange(len(n)), n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key] * len(at), pa.int64()), pa.array(best.slot[at], pa.int32()), pa.array(best.ids[at], pa.int64()),
                     pa.array(np.concatenate(best.vec), pa.int64()), pa.array(np.concatenate(best.score), pa.int64())],
                    names=["block", "slot", "query_id", "vec_id", "score"])
            open_.clear()

        for batch in batches:
            for r in range(batch.num_rows):
                key, dim, q_wide, q_ids, q_values, wide, ids, values = (batch.column(c)[r].as_py() for c in range(8))
                if key not in open_:
                    if len(open_) >= 16:
                        yield from found()
                    open_[key] = _Best(np.frombuffer(q_ids, "<i8"), _matrix(q_wide, q_values, dim), k)
                open_[key].see(np.frombuffer(ids, "<i8"), _matrix(wide, values, dim))
        yield from found()

    hits = cells.mapInArrow(search, "block long, slot int, query_id long, vec_id long, score long")
    w = Window.partitionBy("block", "slot", "query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
