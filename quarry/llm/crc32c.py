"""CRC-32C of many byte strings at once, with numpy."""

from __future__ import annotations

from functools import cache

import numpy as np

_POLY = 0x82F63B78  # the reflected Castagnoli polynomial
_CHUNK, _FAN = 64, 16


@cache
def _byte_table() -> np.ndarray:
    x = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        x = np.where(x & 1, (x >> 1) ^ np.uint32(_POLY), x >> 1).astype(np.uint32)
    return x


def _apply(columns: np.ndarray, x: np.ndarray) -> np.ndarray:
    out = np.zeros_like(x)
    for bit in range(32):
        out ^= np.where((x >> np.uint32(bit)) & 1, columns[bit], 0).astype(np.uint32)
    return out


@cache
def _zeros(n: int) -> np.ndarray:
    """What ``n`` zero bytes do to each bit of the register."""
    if n == 0:
        return np.uint32(1) << np.arange(32, dtype=np.uint32)
    if n == 1:
        x = np.uint32(1) << np.arange(32, dtype=np.uint32)
        return _byte_table()[x & 255] ^ (x >> np.uint32(8))
    half = _zeros(n // 2)
    twice = _apply(half, half)
    return _apply(_zeros(1), twice) if n % 2 else twice


@cache
def _shift_tables(n: int) -> list[np.ndarray]:
    x = np.arange(256, dtype=np.uint32)
    return [_apply(_zeros(n), x << np.uint32(8 * k)) for k in range(4)]


@cache
def _position_tables() -> list[np.ndarray]:
    return [_apply(_zeros(_CHUNK - 1 - j), _byte_table()) for j in range(_CHUNK)]


def _shifted(x: np.ndarray, n: int) -> np.ndarray:
    if n == 0:
        return x
    t = _shift_tables(n)
    return t[0][x & 255] ^ t[1][(x >> np.uint32(8)) & 255] ^ t[2][(x >> np.uint32(16)) & 255] ^ t[3][x >> np.uint32(24)]


def _front_padded(items: np.ndarray, counts: np.ndarray, multiple: int) -> tuple[np.ndarray, np.ndarray]:
    """Zeros before each run of ``items``, so that its length is a multiple."""
    full = -(-np.maximum(counts, 1) // multiple) * multiple
    out = np.zeros(int(full.sum()), items.dtype)
    ends = np.cumsum(full)
    first = ends - counts
    out[np.repeat(first - (np.cumsum(counts) - counts), counts) + np.arange(len(items))] = items
    return out, full // multiple


def crc32c(data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32C of consecutive byte strings in ``data``, each of four bytes at least."""
    lengths = np.asarray(lengths, np.int64)
    if len(lengths) == 0:
        return np.empty(0, np.uint32)
    first = np.cumsum(lengths) - lengths
    data = data.copy()
    for k in range(4):  # a register of ones at the start inverts the first four bytes
        data[first + k] ^= 255
    padded, counts = _front_padded(data, lengths, _CHUNK)
    chunks = padded.reshape(-1, _CHUNK)
    state = np.zeros(len(chunks), np.uint32)
    for j, table in enumerate(_position_tables()):
        state ^= table[chunks[:, j]]
    size = _CHUNK
    while counts.max() > 1:
        state, counts = _front_padded(state, counts, _FAN)
        parts = state.reshape(-1, _FAN)
        state = np.zeros(len(parts), np.uint32)
        for j in range(_FAN):
            state ^= _shifted(parts[:, j], (_FAN - 1 - j) * size)
        size *= _FAN
    return state ^ np.uint32(0xFFFFFFFF)


def masked(crc: np.ndarray) -> np.ndarray:
    """The rotated and offset form that record files store."""
    with np.errstate(over="ignore"):
        return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(0xA282EAD8)
