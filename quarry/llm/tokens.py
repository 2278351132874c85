"""Token ids of text batches with a `tokenizers` file, each distinct word encoded once."""

from __future__ import annotations

import json
import os
import re
from array import array

import numpy as np
import pyarrow as pa

from quarry.llm.words import word_hashes

_BYTES = 24 << 20  # memory of each of the two generations of words that a worker remembers, but for one run of texts more
_TOGETHER = 1000  # words encoded at once
_PLAIN = re.compile("(?: [!-~\u00c0-\u024f]+)").fullmatch  # a blank and a word of characters that neither compose nor hide a white space
_LETTERS = re.compile("(?: [A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u023f]+)").fullmatch  # a blank and letters that lower to letters
_MARK = " \0"
_STOP = np.zeros(256, bool)
_STOP[list(b",.;:!?)\"")] = True


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of ranges, one behind the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)


class _Remembered:
    """Words and their ids in arrays: some 45 bytes a word, where a dict of objects takes 250.

    A word is found by a hash and then compared as a whole.  Of different
    words with one hash only the first is found again.
    """

    def __init__(self):
        self._hashes, self._number = np.empty(0, np.uint64), np.empty(0, np.int32)  # in the order of hashes
        self._text, self._text_at = np.empty(0, np.uint8), np.zeros(1, np.int64)  # in the order of numbers
        self._ids, self._ids_at = np.empty(0, np.uint32), np.zeros(1, np.int64)

    @property
    def nbytes(self) -> int:
        return sum(x.nbytes for x in (self._hashes, self._number, self._text, self._text_at, self._ids, self._ids_at))

    def find(self, hashes: np.ndarray, text: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """The number of each word (none empty), or -1."""
        found = np.full(len(hashes), -1, np.int64)
        if len(self._hashes) == 0 or len(hashes) == 0:
            return found
        at = np.searchsorted(self._hashes, hashes)
        at[at == len(self._hashes)] = 0
        number = self._number[at]
        like = np.flatnonzero((self._hashes[at] == hashes) & (self._text_at[number + 1] - self._text_at[number] == sizes))
        if len(like):
            n = sizes[like]
            same = self._text[_ranges(self._text_at[number[like]], n)] == text[_ranges(starts[like], n)]
            like = like[np.logical_and.reduceat(same, np.cumsum(n) - n)]
            found[like] = number[like]
        return found

    def add(self, hashes: np.ndarray, text: np.ndarray, sizes: np.ndarray, ids: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The numbers of further words."""
        numbers = np.arange(len(self._hashes), len(self._hashes) + len(hashes))
        order = np.argsort(hashes)
        at = np.searchsorted(self._hashes, hashes[order], "right")
        self._hashes, self._number = np.insert(self._hashes, at, hashes[order]), np.insert(self._number, at, numbers[order])
        self._text, self._ids = np.concatenate([self._text, text]), np.concatenate([self._ids, ids])
        self._text_at = np.append(self._text_at, self._text_at[-1] + np.cumsum(sizes))
        self._ids_at = np.append(self._ids_at, self._ids_at[-1] + np.cumsum(n))
        return numbers

    def codes(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words in a row, and how many each has."""
        first = self._ids_at[numbers]
        n = self._ids_at[numbers + 1] - first
        return self._ids[_ranges(first, n)], n


def _after_letter(data: np.ndarray) -> np.ndarray:
    """For each byte but the first: whether a letter of U+0041 to U+023F that lowers to one letter ends before it."""
    before, lead = data[:-1], data[:-2]
    low = before | np.uint8(32)
    out = (low >= 97) & (low <= 122)
    other = ((lead == 0xC3) & ((before[1:] == 0x97) | (before[1:] == 0xB7))) | ((lead == 0xC4) & (before[1:] == 0xB0))  # signs, and the dotted I
    out[1:] |= (before[1:] >= 128) & (lead >= 0xC3) & (lead <= 0xC8) & ~other
    return out


class WordTokenizer:
    """Encodes texts exactly as the file's tokenizer does, word by word.

    A cut is made only before a blank, tab or line end whose left neighbour
    is surely no white space, and between a letter and a mark such as a comma.
    Neither kind of pre-tokenizer used here (byte
    level with leading blank, or words with white space dropped) makes a
    token across such a place, so the pieces can be encoded apart, and each
    distinct piece only once.  Strings that look like special tokens are
    ordinary text.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True
        self._known, self._before = _Remembered(), _Remembered()
        self._mark = self._ids(_MARK)
        odd = [t for t in self._mark if t not in self._ids(" ")]
        self._odd = odd[0] if len(odd) == 1 and self._ids(f" a{_MARK} b") == self._ids(" a") + self._mark + self._ids(" b") else None
        self._edge, self._at_end = self._edges()

    def _edges(self) -> tuple[np.ndarray | None, bool]:
        """Which ids stand at the one edge of each word of letters, and whether that edge is its end.

        A model with a suffix for words has it in the last id of a word, a byte-level one the blank in the first.
        """
        suffix = json.loads(self._tokenizer.to_str())["model"].get("end_of_word_suffix")
        vocabulary = self._tokenizer.get_vocab(with_added_tokens=False)
        edge = np.zeros(max(vocabulary.values()) + 1, bool)
        edge[[n for t, n in vocabulary.items() if (t.endswith(suffix) if suffix else t.startswith("\u0120"))]] = True
        apart = [np.array(self._ids(w)) for w in (" a", " Word", " \u00c9t\u00e9", " zqxJjv", " \u023f\u0131", " unbelievably")]
        alone = all(edge[x].sum() == 1 and edge[x[-1 if suffix else 0]] for x in apart)
        return (edge, bool(suffix)) if alone else (None, False)

    def _ids(self, text: str) -> list[int]:
        return self._tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _codes(self, words: list[str]) -> list[bytes]:
        """The ids of each word.

        Words of letters are encoded as one text: each is one word to the
        pre-tokenizer, so the ids at its edges tell the words' ids apart.
        Plain words are, too, with a blank and a NUL behind
        each: no token crosses a blank, and only these marks hold the token of
        NUL.  All others are encoded apart.
        """
        codes: list[bytes | None] = [None] * len(words)
        letters = [n for n, w in enumerate(words) if _LETTERS(w)] if self._edge is not None else []
        if letters:
            ids = np.array(self._ids("".join([words[n] for n in letters])), np.uint32)
            edges = np.flatnonzero(self._edge[ids])
            if len(edges) == len(letters):
                bounds = np.append(0, edges + 1) if self._at_end else np.append(edges, len(ids))
                bounds, raw = (bounds * 4).tolist(), ids.tobytes()
                for n, a, b in zip(letters, bounds, bounds[1:]):
                    codes[n] = raw[a:b]
        plain = [n for n, w in enumerate(words) if codes[n] is None and _PLAIN(w)] if self._odd is not None else []
        if plain:
            ids = np.array(self._ids("".join([words[n] + _MARK for n in plain])), np.uint32)
            ends = np.flatnonzero(ids == self._odd) - self._mark.index(self._odd)
            if len(ends) == len(plain):
                starts = (np.append(0, ends[:-1] + len(self._mark)) * 4).tolist()
                raw = ids.tobytes()
                for n, a, b in zip(plain, starts, (ends * 4).tolist()):
                    codes[n] = raw[a:b]
        apart = [n for n, c in enumerate(codes) if c is None]
        for n, e in zip(apart, self._tokenizer.encode_batch_fast([words[n] for n in apart], add_special_tokens=False)):
            codes[n] = array("I", e.ids).tobytes()
        return codes

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids (uint32) of all documents in a row, and where each document's ids begin."""
        if len(data) == 0:
            return np.empty(0, np.uint32), np.zeros(len(offsets), np.int64)
        cut = np.zeros(len(data), bool)
        before, blank = data[:-1], (data[1:] == 32) | (data[1:] == 10) | (data[1:] == 9) | (data[1:] == 13)
        sure = (before > 32) & (before < 127)
        high = before >= 128  # the last byte of a longer character: no white space unless a lead byte of one precedes it
        odd = np.isin(data[:-2], (0xC2, 0x80, 0x81, 0x9A)) if len(data) > 2 else np.zeros(0, bool)
        sure[1:] |= high[1:] & ~odd if len(data) > 2 else False
        cut[1:] = blank & sure | _STOP[data[1:]] & _after_letter(data)
        cut[offsets[:-1][offsets[:-1] < len(data)]] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(data))
        bounds = np.append(starts, len(data)).astype(np.int32)
        words = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))])
        coded = words.dictionary_encode()
        distinct, which = coded.dictionary, coded.indices.to_numpy()
        _, bounds, text = distinct.buffers()
        bounds, text = np.frombuffer(bounds, np.int32)[:len(distinct) + 1].astype(np.int64), np.frombuffer(text, np.uint8)
        begin, size = bounds[:-1], np.diff(bounds)
        hashes = word_hashes(text, begin, bounds[1:], lower=False)
        if self._known.nbytes > _BYTES:  # words not met since the last turn are forgotten
            self._known, self._before = _Remembered(), self._known
        known, older = self._known, self._before
        held = known.find(hashes, text, begin, size)
        new = np.flatnonzero(held < 0)
        place = older.find(hashes[new], text, begin[new], size[new])
        again, place, new = new[place >= 0], place[place >= 0], new[place < 0]
        if len(again):
            held[again] = known.add(hashes[again], text[_ranges(begin[again], size[again])], size[again], *older.codes(place))
        if len(new):
            codes: list[bytes] = []
            for at in range(0, len(new), _TOGETHER):
                codes += self._codes(distinct.take(pa.array(new[at:at + _TOGETHER])).to_pylist())
            n = np.fromiter(map(len, codes), np.int64, len(codes)) // 4
            held[new] = known.add(hashes[new], text[_ranges(begin[new], size[new])], size[new], np.frombuffer(b"".join(codes), np.uint32), n)
        ids, n = known.codes(held[which])
        at = np.cumsum(n) - n
        total = len(ids)
        doc_word = np.searchsorted(starts, offsets)  # the first word of each document
        return ids, np.append(at, total)[doc_word]


_LOADED: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """The worker's tokenizer of this file."""
    if path not in _LOADED:
        _LOADED[path] = WordTokenizer(path)
    return _LOADED[path]
