"""Words and word shingles of text batches as numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15 | 1
_PIECE = 1 << 18  # bytes hashed at once


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    have = 1
    step = np.uint64(base)
    with np.errstate(over="ignore"):
        while have < n:
            more = min(have, n - have)
            out[have:have + more] = out[:more] * step
            step = step * step
            have += more
    return out


_POW: dict[str, np.ndarray] = {}


def _pows(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _POW or len(_POW["up"]) < n:
        n = max(n, _PIECE * 2)
        _POW["up"] = _powers(_BASE, n)
        _POW["down"] = _powers(pow(_BASE, -1, 1 << 64), n)
    return _POW["up"], _POW["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def text_runs(texts: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows with at most ``limit`` bytes, one row at least; null is empty."""
    texts = texts.fill_null("") if texts.null_count else texts
    if len(texts) == 0:
        return
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield at, end, data[offsets[at]:offsets[end]], offsets[at:end + 1] - offsets[at]
        at = end


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the words ``[^\\x20\\x09-\\x0D]+`` and, for each document, its first word."""
    word = ~((data == 32) | ((data >= 9) & (data <= 13)))
    start, end = word.copy(), word.copy()
    if len(data):
        start[1:] &= ~word[:-1]
        end[:-1] &= ~word[1:]
        heads = offsets[:-1][offsets[:-1] < len(data)]
        start[heads] = word[heads]
        tails = offsets[1:][offsets[1:] > 0] - 1
        end[tails] = word[tails]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of every word, with A-Z lowered unless ``lower`` is false."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    with np.errstate(over="ignore"):
        while at < len(starts):
            end = max(at + 1, int(np.searchsorted(ends, starts[at] + _PIECE, "right")))
            lo, hi = starts[at], ends[end - 1]
            piece = data[lo:hi]
            if lower:
                piece = piece + ((piece >= 65) & (piece <= 90)).astype(np.uint8) * np.uint8(32)
            up, down = _pows(len(piece) + 1)
            total = np.zeros(len(piece) + 1, np.uint64)
            np.cumsum((piece.astype(np.uint64) + np.uint64(1)) * up[:len(piece)], out=total[1:])
            s, e = starts[at:end] - lo, ends[at:end] - lo
            out[at:end] = mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
            at = end
    return out


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words (of one or more documents in a row)."""
    if len(words) < n:
        return np.empty(0, np.uint64)
    weight = _powers(_BASE, n + 1)[1:]
    m = len(words) - n + 1
    with np.errstate(over="ignore"):
        out = words[:m] * weight[0]
        for j in range(1, n):
            out += words[j:j + m] * weight[j]
    return mix(out)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> Iterator[np.ndarray]:
    """For each document the sorted distinct hashes of its ``n``-word shingles.

    A document with fewer words has one shingle, the whole sequence; one
    without words has none.
    """
    starts, ends, first = word_spans(data, offsets)
    words = word_hashes(data, starts, ends)
    all_grams = grams(words, n)
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= n:
            yield np.unique(all_grams[a:b - n + 1])
        elif b > a:
            yield grams(words[a:b], int(b - a)) ^ np.uint64(b - a)
        else:
            yield np.empty(0, np.uint64)
