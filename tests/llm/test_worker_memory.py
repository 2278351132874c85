"""What a Python worker holds: remembered words and the arrays of a run of texts."""

import random
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from quarry.llm import quality, tokens
from quarry.llm.words import shingle_sets, text_runs, word_hashes

PATH = public_tokenizers.path("byte_bpe_50k.json")
MB = 1 << 20


def invented(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices("abcdefghijklmnopqrstuvwxyzé", k=rng.randrange(3, 14))) for _ in range(n)]


def encoded(tokenizer, texts):
    for _, _, data, offsets in text_runs(pa.array(texts)):
        ids, at = tokenizer.encode(data, offsets)
        yield from (ids[a:b].tolist() for a, b in zip(at[:-1], at[1:]))


def wanted(texts):
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("bits", [0, 3, 64])
@pytest.mark.parametrize("most", [0, 20_000, 24 * MB])
def test_remembered_words_give_the_same_ids(monkeypatch, bits, most):
    """However many words share a hash, and however soon words are forgotten."""
    monkeypatch.setattr(tokens, "_BYTES", most)
    monkeypatch.setattr(tokens, "word_hashes", lambda *a, **b: word_hashes(*a, **b) & np.uint64((1 << bits) - 1))
    rng, vocabulary = random.Random(4), invented(400, 5) + ["The", "the", "THE", "a", "ab", "ba"]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randrange(60))) for _ in range(150)]
    tokenizer = tokens.WordTokenizer(PATH)
    found = [x for at in range(0, 150, 10) for x in encoded(tokenizer, texts[at:at + 10])]
    assert found == wanted(texts)


def test_remembered_words_take_little_memory():
    words = invented(160_000, 6)
    texts = [" ".join(words[at:at + 400]) for at in range(0, len(words), 400)]
    tokenizer = tokens.WordTokenizer(PATH)
    list(encoded(tokenizer, texts[:2]))
    tracemalloc.start()
    try:
        for _ in encoded(tokenizer, texts):
            pass
        held, _ = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert held < 16 * MB


def test_remembered_words_are_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "_BYTES", 100_000)
    tokenizer = tokens.WordTokenizer(PATH)
    for n in range(30):
        list(encoded(tokenizer, [" ".join(invented(500, n))]))
        assert tokenizer._known.nbytes + tokenizer._before.nbytes < 2 * (100_000 + 60_000)


def test_runs_of_texts_need_little_memory():
    """Arrays of a run are many times as large as its texts, so runs are short."""
    line = " ".join(invented(12, 7)) + "\n"
    texts = pa.array([line * 30] * (8 * MB // (30 * len(line))))
    model = quality.QualityModel(np.zeros(quality.WIDTH), np.zeros((2, 2)), np.zeros(quality.WIDTH), np.ones(quality.WIDTH))
    for work in (lambda data, offsets: quality.document_scores(model, data, offsets), lambda data, offsets: sum(len(s) for s in shingle_sets(data, offsets, 5))):
        tracemalloc.start()
        try:
            for _, _, data, offsets in text_runs(texts):
                work(data, offsets)
            _, most = tracemalloc.get_traced_memory()
        finally:
            tracemalloc.stop()
        assert most < 56 * MB
