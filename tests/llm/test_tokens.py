"""Packing and record files against the tokenizers library."""

import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from helpers import SCHEMA, awkward, frame
from quarry.llm.crc32c import crc32c, masked
from quarry.llm.packing import differencing, pack_documents, windows
from quarry.llm.records import read_records, read_shuffled, write_records
from quarry.llm.tokens import WordTokenizer

BYTES, WORDS = (public_tokenizers.path(f"{n}.json") for n in ("byte_bpe_50k", "word_bpe_49k"))
ODD = ["a b c", "x  y", "é è　ö z", "<|endoftext|> a", " lead", "trail  ", "\n\n a\t\tb\r\nc", "don't 's 12 345", "\u0085 b", "é ́x", "日本 語", "\x1c a\x1c b", "ΣΑΣ σας", "İ i",
       "a \0 b", " \0", "a \0", " a\0 b \0\0 c", "é à Àb, ×÷ ñ. ǅ ŉ \u0301a"]


def ids(path, texts):
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_words_apart_give_the_same_ids(path):
    rng = random.Random(3)
    alphabet = list("aé \n\t\r'.!1S\0") + [" ", " ", "　", "ß", "́", "the", "  "]
    texts = [x or "" for x in awkward()] + ODD + ["".join(rng.choices(alphabet, k=rng.randrange(40))) for _ in range(500)]
    coded = [x.encode() for x in texts]
    offsets = np.cumsum([0, *map(len, coded)])
    flat, at = WordTokenizer(path).encode(np.frombuffer(b"".join(coded), np.uint8), offsets)
    assert [flat[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == ids(path, texts)


def encoded(tokenizer, texts):
    coded = [x.encode() for x in texts]
    flat, at = tokenizer.encode(np.frombuffer(b"".join(coded), np.uint8), np.cumsum([0, *map(len, coded)]))
    return [flat[a:b].tolist() for a, b in zip(at[:-1], at[1:])]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_marks_behind_letters_give_the_same_ids(path):
    """Every character up to U+0260 and some beyond, as a letter may stand before a comma, in words of letters and in others."""
    rng = random.Random(8)
    some = [chr(c) for c in [*range(0x20, 0x260), 0x301, 0x307, 0x345, 0x3a3, 0x2019, 0x2028, 0x3000, 0xfb01, 0x1f600]]
    texts = [f"x{c}, y {c}. {c}{c}! a{c}b:{c}'s?{c}\u0301,{c},\u0307; ({c}) \"{c}\"\n{c}" for c in some]
    texts += [" ".join(f"ab{c} {c}z" for c in some), ",", "a", "é", "a,", "é,", ",é", ""]
    texts += ["".join(rng.choices([*some, *" ,.;:!?)\"'a" * 12], k=rng.randrange(50))) for _ in range(1500)]
    assert encoded(WordTokenizer(path), texts) == ids(path, texts)


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_a_word_before_marks_is_encoded_once(path):
    """Words of letters need no marks between, and a comma behind one makes no other word of it."""
    rng = random.Random(2)
    vocabulary = ["".join(rng.choices("abcdeéñß", k=9)) for _ in range(300)]
    text = "".join(f" {w}{m}" for w in vocabulary for m in ("", *",.;:!?)\""))
    tokenizer, given = WordTokenizer(path), []
    library = tokenizer._tokenizer

    class Counting:
        def encode_batch_fast(self, texts, **options):
            given.extend(texts)
            return library.encode_batch_fast(texts, **options)

    tokenizer._tokenizer = Counting()
    assert encoded(tokenizer, [text]) == ids(path, [text])
    assert sum(map(len, given)) <= 300 * 10 + 8


def check_packing(rows, want, length=1024):
    cover, windows_ = {}, {}
    for r in rows:
        doc = np.array(want[r.id], "<u4")
        assert bytes(r.ids) == doc[r.start:r.start + r.length].tobytes() and r.doc_tokens == len(doc)
        cover.setdefault(r.id, []).append((r.start, r.length))
        windows_.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for key, doc in want.items():
        at = 0
        for start, n in sorted(cover[key]):
            assert start == at and n > 0
            at += n
        assert at == len(doc)
    for parts in windows_.values():
        at = 0
        for start, n in sorted(parts):
            assert start == at
            at += n
        assert at <= length
    return len(windows_) * length / sum(map(len, want.values()))


def test_packing_awkward_rows(spark):
    texts = awkward() + ODD
    rows = pack_documents(frame(spark, texts), BYTES, end_id=0).collect()
    check_packing(rows, {i: [*x, 0] for i, x in enumerate(ids(BYTES, texts))})
    assert pack_documents(spark.createDataFrame([], SCHEMA), BYTES, 0).count() == 0
    twice = pack_documents(frame(spark, ["a b", "a b", None], [1, 1, None]), BYTES, 0).collect()
    assert sorted((str(r.id), r.length) for r in twice) == [("1", 3), ("1", 3), ("None", 1)]


def test_packing_whole_table_has_little_padding(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    table = [(r.doc_id, r.text) for r in docs.collect()]
    want = {k: [*x, 0] for (k, _), x in zip(table, ids(BYTES, [t for _, t in table]))}
    assert check_packing(pack_documents(docs, BYTES, end_id=0).collect(), want) < 1.01


def test_differencing():
    part, top = differencing([8, 7, 6, 5, 4], 2)
    assert top == 16 and len(part) == 5  # the known result of the method; the best is 15
    rng = random.Random(2)
    for n in (1, 2, 5, 40, 300):
        sizes = [rng.randrange(1, 257) for _ in range(n)]
        part, ways = windows(sizes, 1024)
        sums = [0] * ways
        for p, s in zip(part, sizes):
            sums[p] += s
        assert max(sums) <= 1024
        assert n < 40 or max(sums) - min(sums) <= 64
    assert windows([1024, 1024], 1024)[1] == 2 and windows([600, 600, 600], 1024)[1] == 3  # the count rises
    assert windows([], 1024) == ([], 0)


def test_crc32c():
    def plain(data):
        c = 0xFFFFFFFF
        for x in data:
            c ^= x
            for _ in range(8):
                c = (c >> 1) ^ (0x82F63B78 if c & 1 else 0)
        return c ^ 0xFFFFFFFF

    rng = np.random.default_rng(4)
    parts = [b"123456789", *(rng.integers(0, 256, n, np.uint8).tobytes() for n in (4, 63, 64, 65, 1024, 1025, 20_000))]
    got = crc32c(np.frombuffer(b"".join(parts), np.uint8), [len(p) for p in parts])
    assert got[0] == 0xE3069283 and got.tolist() == [plain(p) for p in parts]
    assert masked(np.array([0], np.uint32))[0] == 0xA282EAD8


def test_records_round_trip(spark):
    texts = awkward() + ODD
    keys = [*range(len(texts) - 3, 0, -1), 5, None, -4]  # out of order, a repeated, a null and a negative id
    docs = frame(spark, texts, keys)
    index = write_records(docs, WORDS, end_id=1)
    want = {}
    for k, x in zip(keys, ids(WORDS, texts)):
        want.setdefault(k, []).append(np.array([*x, 1], "<u4").tobytes())
    rows = sorted(read_records(spark, index).collect(), key=lambda r: r.start)
    at = 0
    for r in rows:
        assert r.start == at and bytes(r.ids) in want[r.id] and r.n_tokens == len(r.ids) // 4
        at += r.n_tokens
    assert [r.id for r in rows] == sorted(keys, key=lambda k: (k is not None, k or 0))
    again = read_shuffled(index, seed=3).collect()
    assert sorted((str(r.id), bytes(r.ids)) for r in again) == sorted((str(k), x) for k, xs in want.items() for x in xs)
    assert read_records(spark, write_records(spark.createDataFrame([], SCHEMA), WORDS, 1)).count() == 0


def test_record_files_are_framed_and_checked(spark):
    index = write_records(frame(spark, ["a b c"], [77]), WORDS, end_id=1).collect()
    path = index[0].file.removeprefix("file:")
    raw = open(path, "rb").read()
    n, of_n = struct.unpack_from("<QI", raw)
    assert len(raw) == n + 16 and of_n == masked(crc32c(np.frombuffer(raw[:8], np.uint8), [8]))[0]
    assert zlib.crc32(raw) and struct.unpack_from("<q", raw, 12)[0] == 77
    with open(path, "r+b") as f:
        f.seek(len(raw) - 6)
        f.write(b"\xff")
    with pytest.raises(Exception, match="checksum"):
        read_records(spark, spark.createDataFrame(index)).collect()
