"""Words of letters and digits as numpy arrays, for whole texts of any length.

A word is a run of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lowering A-Z: ASCII
letters, digits and every character outside ASCII.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from quarry.llm.words import text_runs

PIECE = 4 << 20  # bytes looked at together, unless one word is longer


@dataclass
class Words:
    """Words of some rows in a row, or of a piece of one row.

    ``text`` holds each word, lowered and followed by one blank; word i starts
    at ``at[i]``.  ``first`` has the first word of each row and the end.  A
    piece starts with words already seen: those before ``fresh``; ``base`` is
    the number in its row of its first word, ``last`` tells the row's end.
    """

    start_row: int
    first: np.ndarray
    text: np.ndarray
    at: np.ndarray
    base: int = 0
    fresh: int = 0
    last: bool = True

    def __len__(self) -> int:
        return len(self.at) - 1

    def rows(self) -> np.ndarray:
        """The row of each word."""
        return self.start_row + np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def _is_word(data: np.ndarray) -> np.ndarray:
    return (data >= 128) | ((data >= 97) & (data <= 122)) | ((data >= 65) & (data <= 90)) | ((data >= 48) & (data <= 57))


def _split(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first, text, at, starts): see ``Words``; ``starts`` are the words' places in ``data``."""
    word = _is_word(data)
    begin, end = word.copy(), word.copy()
    if len(data):
        begin[1:] &= ~word[:-1]
        end[:-1] &= ~word[1:]
        heads = offsets[:-1][offsets[:-1] < len(data)]
        begin[heads] = word[heads]
        tails = offsets[1:][offsets[1:] > 0] - 1
        end[tails] = word[tails]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    size = ends - starts
    at = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(size + 1, out=at[1:])
    text = np.full(int(at[-1]), 32, np.uint8)
    low = data[word]
    low = low + ((low >= 65) & (low <= 90)).astype(np.uint8) * np.uint8(32)
    text[np.arange(len(low)) + np.repeat(np.arange(len(size)), size)] = low
    return np.searchsorted(starts, offsets), text, at, starts


def word_runs(texts: pa.Array, overlap: int = 0, limit: int = PIECE) -> Iterator[Words]:
    """All words of a batch of texts (null: none), at most about ``limit`` bytes at a time.

    A longer row comes in pieces, cut between words; each but the first
    starts with the ``overlap`` words before it.
    """
    for lo, hi, data, offsets in text_runs(texts, limit):
        if len(data) <= limit:
            first, text, at, _ = _split(data, offsets)
            yield Words(lo, first, text, at)
            continue
        begin, base, fresh, step = 0, 0, 0, limit
        while True:
            end = min(begin + step, len(data))
            while end < len(data):  # on to the next byte outside a word
                gap = np.flatnonzero(~_is_word(data[end:end + 4096]))
                if len(gap):
                    end += int(gap[0])
                    break
                end = min(end + 4096, len(data))
            piece = data[begin:end]
            first, text, at, starts = _split(piece, np.array([0, len(piece)]))
            n = len(starts)
            if overlap and n - overlap <= fresh and end < len(data):
                step *= 2  # too few new words: a longer piece
                continue
            yield Words(lo, first, text, at, base, fresh, end == len(data))
            if end == len(data):
                break
            begin += int(starts[n - overlap]) if overlap else end - begin
            base, fresh, step = base + n - overlap, overlap, limit


def distinct_words(run: Words) -> tuple[list[bytes], np.ndarray]:
    """The distinct words of a run and which of them each word is."""
    if not len(run):
        return [], np.empty(0, np.int64)
    large = len(run.text) >= 1 << 31
    array = pa.Array.from_buffers(pa.large_binary() if large else pa.binary(), len(run),
                                  [None, pa.py_buffer(run.at.astype(np.int64 if large else np.int32)), pa.py_buffer(run.text)])
    coded = array.dictionary_encode()
    return [w[:-1] for w in coded.dictionary.to_pylist()], coded.indices.to_numpy().astype(np.int64)
