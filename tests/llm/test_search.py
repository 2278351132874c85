"""Top-k search, archives and passages against brute force."""

import base64
import hashlib
import math
import random
import zipfile

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pytest
from pyspark.sql import functions as F

from helpers import SCHEMA, awkward, frame, words
from quarry.llm import warc
from quarry.llm.passages import repeated_passages
from quarry.llm.topk import segment_features, top_inner_products
from quarry.llm.words import grams, word_hashes, word_spans

VECTORS = "vec_id long, embedding array<float>, label int, v string, id long, score int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, "v", 1, 2) for i, v in rows], VECTORS)


def top_truth(rows, k, scale=256):
    good = [(i, [math.floor(scale * float(np.float32(x))) for x in v]) for i, v in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in good:
        if i % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, x)), j) for j, x in good if j != i and len(x) == len(q))
            out += [(i, r, j, -s) for r, (s, j) in enumerate(scores[:k], 1)]
    return sorted(out)


def test_top_k_awkward_rows(spark):
    rng = random.Random(8)
    rows = [(i, [rng.gauss(0, 1) for _ in range(10)]) for i in range(300)]
    rows += [(400, rows[3][1]), (401, rows[3][1]), (402, rows[0][1])]  # ties
    rows += [(450, None), (451, []), (452, [None] * 10), (500, [math.nan] * 10), (501, [math.inf] + [0.0] * 9), (None, rows[1][1])]
    rows += [(550, [1.0, 2.0]), (551, [3.0, -1.0]), (600, [5e4] * 10), (601, [-5e4] * 10)]
    for blocks in ({}, {"query_block": 2, "block": 37}):
        got = top_inner_products(vectors(spark, rows), F.col("vec_id") % 50 == 0, k=5, **blocks).collect()
        assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == top_truth(rows, 5)
    assert top_inner_products(vectors(spark, []), F.col("vec_id") % 50 == 0).count() == 0


def test_segment_statistics_bound_products():
    rng = np.random.default_rng(1)
    for dim, n in ((64, 4), (10, 4), (3, 16)):
        x, y = rng.normal(size=(2, 50, dim))
        bound = (segment_features(x, n) * segment_features(y, n)).sum(1)
        assert (bound + 1e-9 >= (x * y).sum(1)).all()


def test_bounds_spare_most_exact_scores_of_clustered_vectors():
    from quarry.llm.topk import _Best

    rng = np.random.default_rng(6)
    shares = []
    for noise in (0.05, 0.3):
        centres = rng.normal(size=(40, 64))
        x = np.floor(256 * (centres[rng.integers(0, 40, 8000)] + noise * rng.normal(size=(8000, 64))))
        ids = np.arange(8000)
        best = _Best(ids[::16], x[::16], 5)
        for at in range(0, 8000, 3000):
            best.see(ids[at:at + 3000], x[at:at + 3000])
        exact = x[::16] @ x.T
        exact[np.arange(500), ids[::16]] = -np.inf
        for n, i in enumerate(best.slot):
            want = np.lexsort((ids, -exact[i]))[:5]
            assert list(best.vec[n]) == list(want) and list(best.score[n]) == list(exact[i][want])
        assert best.seen == 500 * 8000
        shares.append(best.scored / best.seen)
    assert max(shares) < 0.3, shares


PAGES = "page_id long, url string, html string, revisit string, same int, head int"


def test_archives_round_trip(spark):
    html = ["<p>a</p>", "<p>a</p>", None, "", "é\r\n\r\nWARC/1.1", "x" * 3_000_000, "<p>a</p>", "b", "b"]
    rows = [(i, None if i == 4 else f"http://a/{i} \r\n", h, "r", 1, 2) for i, h in enumerate(html)] + [(None, "u", "b", "r", 1, 2), (8, "u", "b", "r", 1, 2)]
    pages = spark.createDataFrame(rows, PAGES)
    for least in (0, 2):
        got = warc.read_archives(warc.locate(warc.write_archives(pages, min_bytes=least))).collect()
        assert len(got) == len(rows)
        best = {}
        for i, _, h, *_ in rows:
            best[h or ""] = max(best.get(h or "", -1), -1 if i is None else i)
        for r in got:
            h = next(h or "" for i, _, h, *_ in rows if i == r.page_id)
            raw = h.encode()
            assert (r.payload_bytes, r.payload_digest) == (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode())
            first = len(raw) < least or r.page_id == best[h]
            assert (r.record_type, r.refers_to, r.payload) == (("response", None, h) if first else ("revisit", best[h], None))
    assert warc.read_archives(warc.locate(warc.write_archives(spark.createDataFrame([], PAGES)))).count() == 0


@pytest.mark.parametrize("wide", [False, True])
def test_directory_of_plain_and_zip64_archives(monkeypatch, tmp_path, wide):
    if wide:  # every size, offset and count is stored in the ZIP64 records
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 0)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 0)
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("archive/data.warc.gz", b"one" * 100, zipfile.ZIP_STORED)
        z.writestr("squeezed", b"two" * 100, zipfile.ZIP_DEFLATED)
        z.writestr("indexes/é.cdxj", b"three", zipfile.ZIP_STORED)
        z.comment = b"end"
    raw = (tmp_path / "a.zip").read_bytes()
    assert (b"PK\x06\x06" in raw) == wide
    with pyarrow.fs.LocalFileSystem().open_input_file(str(tmp_path / "a.zip")) as f:
        found = warc.directory(f, f.size())
    assert {n: raw[a:a + size] for n, (a, size) in found.items()} == {"archive/data.warc.gz": b"one" * 100, "indexes/é.cdxj": b"three"}
    (tmp_path / "b.zip").write_bytes(b"no archive")
    with pytest.raises(ValueError), pyarrow.fs.LocalFileSystem().open_input_file(str(tmp_path / "b.zip")) as f:
        warc.directory(f, f.size())


def passage_truth(texts, ids, n):
    seen = {}
    split = [words(t) for t in texts]
    for i, t, w in zip(ids, texts, split):
        for p in range(len(w) - n + 1):
            seen.setdefault(tuple(w[p:p + n]), set()).add((i, t))
    out = {}
    for i, w in zip(ids, split):
        for p in range(len(w) - n + 1):
            if len(seen[tuple(w[p:p + n])]) > 1:
                out.setdefault(i, set()).update(range(p, p + n))
    return out


def test_passages_against_all_windows(spark):
    rng = random.Random(6)
    fresh = lambda n: " ".join(f"q{rng.randrange(10 ** 9)}" for _ in range(n))
    shared = [fresh(n) for n in (49, 50, 51, 60, 120)]
    texts = awkward()
    for s in shared:
        texts += [f"{fresh(rng.randrange(80))} {s}\n{fresh(rng.randrange(80))}" for _ in range(rng.choice([2, 3, 60]))]
    texts += [shared[4].upper(), "la " * 700, fresh(5) + " " + "la " * 300, fresh(200), shared[3] + " " + shared[3]]
    ids = list(range(len(texts)))
    got = {}
    for r in repeated_passages(frame(spark, texts), min_words=50).collect():
        assert r.n_words >= 50 and r.other_id != r.id
        got.setdefault(r.id, set()).update(range(r.start_word, r.start_word + r.n_words))
    want = passage_truth(texts, ids, 50)
    assert set(got) == set(want)
    for i in want:
        assert got[i] == want[i], i
    assert repeated_passages(spark.createDataFrame([], SCHEMA)).count() == 0


def test_passages_repeated_rows_and_null_ids(spark):
    text = " ".join(f"w{i}" for i in range(90))
    alone = repeated_passages(frame(spark, [text, text], [1, 1])).count()
    both = repeated_passages(frame(spark, [text, text + " x"], [1, None])).collect()
    assert alone == 0 and sorted((str(r.id), r.n_words) for r in both) == [("1", 90), ("None", 90)]


def test_top_k_answers_each_of_equal_query_blocks(spark):
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(4)]) for i in range(1, 30)]
    rows += [(0, [0.5, 0.25, -0.5, 1.0])] * 3
    got = top_inner_products(vectors(spark, rows), F.col("vec_id") == 0, k=5, query_block=1).collect()
    assert sorted(map(tuple, got)) == sorted([
        (0, n + 1, v, s) for n, (s, v) in enumerate(sorted(
            ((sum(math.floor(256 * float(np.float32(a))) * math.floor(256 * b) for a, b in zip(x, rows[-1][1])), v) for v, x in rows[:-3]),
            key=lambda h: (-h[0], h[1]))[:5])] * 3)


def low_gram(fresh):
    """Eight words whose gram has a low hash, so that their position is retained."""
    text = " ".join(" ".join(fresh(8)) for _ in range(500)).encode()
    starts, ends, _ = word_spans(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    at = 8 * int(grams(word_hashes(np.frombuffer(text, np.uint8), starts, ends), 8)[::8].argmin())
    return text.decode().split()[at:at + 8]


def check_passages(spark, texts, n=50):
    texts, got = [" ".join(t) for t in texts], {}
    for r in repeated_passages(frame(spark, texts), min_words=n).collect():
        assert r.n_words >= n and r.other_id != r.id
        got.setdefault(r.id, set()).update(range(r.start_word, r.start_word + r.n_words))
    assert got == passage_truth(texts, range(len(texts)), n)
    return got


def test_passages_through_a_hot_key(spark):
    """Pairs share 12 words before a boilerplate that stands in 30,000 documents with other text behind it."""
    rng = random.Random(1)
    fresh = lambda n: [f"q{rng.randrange(10 ** 9)}" for _ in range(n)]
    common = fresh(10) + low_gram(fresh) + fresh(22)
    texts = [fresh(2) + common + fresh(10) for _ in range(30_000)]
    for _ in range(12):
        before = fresh(12)
        texts += [fresh(4) + before + common + fresh(12) for _ in range(2)]
    got = check_passages(spark, texts)
    assert sorted(got) == list(range(30_000, 30_024)) and all(len(x) == 52 for x in got.values())


def test_passages_behind_decoys(spark):
    """Other documents share more on one side of a passage, and too little on the other."""
    rng = random.Random(2)
    fresh = lambda n: [f"q{rng.randrange(10 ** 9)}" for _ in range(n)]
    texts = []
    for _ in range(20):
        p, x, y = fresh(15) + low_gram(fresh) + fresh(27), fresh(5), fresh(5)
        texts += [fresh(20) + x + p + y + fresh(20), fresh(20) + p + fresh(20)]
        texts += [t for _ in range(4) for t in (fresh(20) + p[10:] + y + fresh(20), fresh(20) + x + p[:40] + fresh(20))]
    got = check_passages(spark, texts)
    assert all(len(got[10 * n]) == len(got[10 * n + 1]) == 50 for n in range(20))


def test_passages_of_periodic_text(spark):
    """A repeated gram of the lowest hash, with other words between, entered at different laps."""
    rng = random.Random(3)
    fresh = lambda n: [f"q{rng.randrange(10 ** 9)}" for _ in range(n)]
    texts = []
    for _ in range(20):
        gram = low_gram(fresh)
        whole = [w for _ in range(8) for w in gram + fresh(12)]
        texts += [fresh(9) + whole + fresh(9), fresh(9) + whole[20:75] + fresh(9), fresh(9) + whole[40:92] + fresh(9)]
    check_passages(spark, texts)


def test_sorted_neighbours_give_the_spans(spark, monkeypatch):
    """Suffixes are range-partitioned and sorted; where neighbours share all windows nothing is left to the grouping by hash."""
    from quarry.llm import passages as module

    written, plans = {}, {}
    real = module.materialise

    def keep(df, what):
        plans[what] = df._jdf.queryExecution().executedPlan().toString()
        return written.setdefault(what, real(df, what))

    monkeypatch.setattr(module, "materialise", keep)
    rng = random.Random(9)
    fresh = lambda n: " ".join(f"q{rng.randrange(10 ** 9)}" for _ in range(n))
    texts = []
    for _ in range(30):
        shared = fresh(rng.randrange(50, 300))
        texts += [f"{fresh(20)} {shared} {fresh(20)}" for _ in range(2)]
    got = repeated_passages(frame(spark, texts), min_words=50).collect()
    assert {r.id for r in got} == set(range(60)) and all(r.other_id == r.id ^ 1 for r in got)
    assert "rangepartitioning(h" in plans["neighbours"] and "Sort [h" in plans["neighbours"]
    covered = {}
    for r in written["neighbours"].filter("`end` IS NOT NULL").collect():
        covered.setdefault(r.id, set()).update(range(r.start, r.end))
    whole = [r.id for r in got if covered.get(r.id) == set(range(r.start_word, r.start_word + r.n_words))]
    assert len(whole) >= 48  # all but those cut by the ends of ranges


def test_neighbours_are_extended_over_equal_windows_only():
    from quarry.llm.passages import compare_neighbours

    def row(h, d, start, lead, windows):
        return (h, b"", b"", 0, d, d, d, start, lead, len(windows), np.array(windows, np.uint64).tobytes())

    rows = [row(1, 10, 0, 2, [5, 6, 7]), row(1, 11, 40, 1, [6, 7]), row(1, 11, 90, 1, [6, 9]), row(1, 12, 3, 0, [7]), row(2, 13, 0, 0, [7])]
    names = ["h", "right", "left", "class", "d1", "d2", "id", "start", "lead", "n", "windows"]
    batch = pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows])
    spans, left = compare_neighbours(batch, 50, 30)
    found = sorted(zip(*(x.tolist() for x in spans)))
    # windows 5 and 9 have no equal; the row of document 12 is compared with 11's second row, which has another window there
    assert found == [(0, 1, 52, 11), (1, 40, 91, 10), (1, 41, 91, 12), (2, 90, 140, 10)]
    assert left.tolist() == [True, False, True, True, True]
