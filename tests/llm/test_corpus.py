"""Quality, mixing and the pipeline."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import SCHEMA, awkward, components, frame, shingles
from quarry.llm.mixing import mix, pfair, schedule, shares
from quarry.llm.quality import (QualityModel, WIDTH, _chain, fit_quality, held_out, keep_good, quality_score,
                                score_documents)

SF01 = "/root/testdata/sf0.01"


def test_forward_backward_against_all_labellings():
    rng = np.random.default_rng(3)
    score, moves = rng.normal(size=(4, 5)), rng.normal(size=(2, 2))
    there = np.arange(5) < np.array([1, 3, 5, 2])[:, None]
    odds, pairs = _chain(np.where(there, score, 0), there, moves)
    want = np.zeros((2, 2))
    for d, n in enumerate(there.sum(1)):
        total, good = 0.0, np.zeros(n)
        seen = np.zeros((2, 2))
        for code in range(2 ** n):
            y = [code >> i & 1 for i in range(n)]
            p = np.exp(sum(score[d, i] * y[i] for i in range(n)) + sum(moves[a, b] for a, b in zip(y, y[1:])))
            total += p
            good += p * np.array(y)
            for a, b in zip(y, y[1:]):
                seen[a, b] += p
        want += seen / total
        assert np.allclose(1 / (1 + np.exp(-odds[d, :n])), good / total)
    assert np.allclose(pairs, want)


def test_quality_on_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = score_documents(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert np.mean([r.predicted == r.quality for r in held]) > 0.99
    low, high = ([r.score for r in held if r.quality == q] for q in (0, 1))
    assert np.mean(np.array(high)[:, None] > np.array(low)[None, :]) > 0.99


def test_quality_awkward_rows(spark):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)] + [(None, 1, 0), (3, None, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    texts = (awkward() + ["fine words here.\nand more.", "BAD!! WORDS!!"] * 12)[:40]
    docs = frame(spark, texts, [*range(39), None])
    got = score_documents(docs, labels).collect()
    assert len(got) == 40 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    same = [r.score for r in got if r.doc_id in (0, 1)]
    assert same[0] == same[1]  # null and empty
    kept = keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted for r in got)
    empty = spark.createDataFrame([], SCHEMA)
    assert score_documents(empty, labels).count() == 0
    assert {r.score for r in score_documents(docs, labels.limit(0)).collect()} == {0.5}
    assert docs.filter(held_out(F.col("doc_id"))).count() > 0


def test_model_is_not_fitted_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = fit_quality(docs, labels), fit_quality(docs, turned)
    assert np.array_equal(a.weights, b.weights) and np.array_equal(a.moves, b.moves)
    model = QualityModel(np.zeros(WIDTH), np.zeros((2, 2)), np.zeros(WIDTH), np.ones(WIDTH))
    assert docs.limit(3).select(quality_score(F.col("text"), model)).distinct().collect()[0][0] == 0.5


def test_scores_against_a_plain_reading(spark):
    """Document scores of a model with given weights: neighbours' features, all labellings, length-weighted marginals."""
    from quarry.llm.quality import document_scores, line_features

    rng = np.random.default_rng(4)
    model = QualityModel(rng.normal(size=WIDTH), rng.normal(size=(2, 2)), rng.normal(size=WIDTH) * 0.1, 1 + rng.random(WIDTH))
    for text in ["", "one line.", "A b c!\n\n12 34\nend", "x|y|z\nx|y|z\nx|y|z\nfine words, here.\n!!!!"]:
        data = np.frombuffer(text.encode(), np.uint8)
        x, weight, first = line_features(data, np.array([0, len(data)]))
        lines = text.split("\n")
        assert len(x) == len(lines) and list(weight) == [len(s.encode()) + 1 for s in lines]
        for i, line in enumerate(lines):  # a line alone has the features it has at the same place among others, but for its neighbours
            alone, _, _ = line_features(np.frombuffer(line.encode(), np.uint8), np.array([0, len(line.encode())]))
            assert np.sum(np.isclose(alone[0], x[i])) >= WIDTH // 3
        score = ((x - model.mean) / model.scale) @ model.weights
        total, good = 0.0, np.zeros(len(lines))
        for code in range(2 ** len(lines)):
            y = [code >> i & 1 for i in range(len(lines))]
            p = np.exp(sum(s * v for s, v in zip(score, y)) + sum(model.moves[a, b] for a, b in zip(y, y[1:])))
            total, good = total + p, good + p * np.array(y)
        want = float((good / total * weight).sum() / weight.sum())
        assert abs(document_scores(model, data, np.array([0, len(data)]))[0] - want) < 1e-9
        assert abs(spark.createDataFrame([(text,)], "t string").select(quality_score(F.col("t"), model)).first()[0] - want) < 1e-9


def test_long_texts_are_scored_piece_by_piece():
    """The same scores as all lines at once, whatever the pieces; a million lines in bounded memory."""
    import tracemalloc

    from quarry.llm.quality import document_scores

    rng = np.random.default_rng(5)
    model = QualityModel(rng.normal(size=WIDTH), rng.normal(size=(2, 2)), rng.normal(size=WIDTH) * 0.1, 1 + rng.random(WIDTH))
    some = ["", "", "a", "b", "a b", "a a a", "fine words, here.", "BAD!! | 12", "x|y|z"]
    for n in (1, 2, 3, 40, 200):
        texts = ["\n".join(rng.choice(some, n)).encode(), b"", "\n".join(rng.choice(some, 3)).encode(), b"\n" * n, "\n".join(rng.choice(some, n)).encode()]
        data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
        want = document_scores(model, data, offsets)
        for lines, size in ((1, 1), (2, 1 << 20), (7, 10), (50, 1 << 20)):
            assert np.allclose(document_scores(model, data, offsets, lines, size), want, rtol=0, atol=1e-9)
    data = np.frombuffer(b"some words, and more.\n" * 1_000_000, np.uint8)
    tracemalloc.start()
    score = document_scores(model, data, np.array([0, len(data)]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert 0 <= score[0] <= 1 and peak < 200 << 20


def test_whole_documents_are_fitted_on_within_a_budget_of_lines(spark, monkeypatch):
    from quarry.llm import quality as module

    seen = {}
    real = module._fit
    monkeypatch.setattr(module, "_fit", lambda x, weight, first, labels, **how: seen.update(sizes=np.diff(first), n=len(labels)) or real(x, weight, first, labels, **how))
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 3 != 1]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in ids], "doc_id long, quality int, toxic int")
    docs = frame(spark, ["\n".join(f"line {k} of {i}" for k in range(1 + i % 90)) for i in range(400)])
    module.fit_quality(docs, labels, lines=9000)
    assert sorted(seen["sizes"]) == sorted(1 + i % 90 for i in ids if i < 400) or seen["sizes"].sum() <= 9000
    module.fit_quality(docs, labels, lines=3000)
    assert 1000 < seen["sizes"].sum() <= 3000 and seen["sizes"].max() <= 30
    assert all(n in {1 + i % 90 for i in ids} for n in seen["sizes"])


@pytest.mark.parametrize("slots", [[1], [1, 1, 1], [3, 5, 8], [100, 1, 1, 1], [7, 7, 7, 7, 4], [1] * 30 + [970]])
def test_pfair_deviates_by_less_than_one_block(slots):
    total, done = sum(slots), [0] * len(slots)
    for t, (source, j) in enumerate(pfair(slots)):
        assert j == done[source] and j * total // slots[source] <= t < -(-(j + 1) * total // slots[source])
        done[source] += 1
        assert all(abs(d - n * (t + 1) / total) < 1 for d, n in zip(done, slots))
    assert done == slots


def test_shares():
    assert shares([1, 1, 2], 8) in ([2, 2, 4], [3, 2, 3], [2, 3, 3]) and sum(shares([5, 0, 1e-9, 3], 4096)) == 4096
    assert min(shares([1e9, 1, 1], 16)) == 1


def test_mixing_follows_target_weights(spark):
    docs = frame(spark, [f"text {i} " + "x" * (i % 90) for i in range(3000)], sources=["hot" if i % 3 == 0 else f"s{i % 5}" for i in range(3000)])
    weights = {"hot": 1.0, "s1": 3.0, "s2": 2.0, "s4": 1.0, "s0": 1.0}
    got = schedule(docs, weights, block_chars=500, cycle=64).select("doc.doc_id", "source", "block", "release", "deadline", "slot", "at").collect()
    assert sorted(r.doc_id for r in got) == list(range(3000))
    target = dict(zip(sorted({r.source for r in got}), shares([weights.get(s, 0) for s in sorted({r.source for r in got})], 64)))
    slots = {r.slot: r.source for r in got}
    ends = {s: max(r.slot for r in got if r.source == s) for s in target}
    for t in range(min(ends.values())):  # until a source is exhausted
        for s, n in target.items():
            assert abs(sum(slots.get(u) == s for u in range(t + 1)) - n * (t + 1) / 64) < 1
    assert all(r.release <= r.slot < r.deadline for r in got)
    by = {}
    for r in sorted(got, key=lambda r: (r.source, r.at)):
        assert r.block == r.at // 500 and by.setdefault((r.source, r.block), r.slot) == r.slot
    assert len(set(by.values())) == len(by)
    for s in target:  # blocks of a source come in their order
        own = [v for (x, _), v in sorted(by.items()) if x == s]
        assert own == sorted(own)


def test_shares_follow_the_weights():
    for n in (3, 20, 1000, 4096, 20_000):
        weights = [n / 2] + [1.0] * n
        got = shares(weights, 1 << 40)
        assert sum(got) == 1 << 40 and abs(got[0] - 2 ** 40 / 3) < 1 and max(abs(g - 2 ** 41 / 3 / n) for g in got[1:]) < 1


@pytest.mark.parametrize("sources", [20, 5000])
def test_mixing_deviates_by_less_than_one_block_from_the_weights(spark, sources):
    """A source of weight 1/3 among few sources and many blocks, and among thousands of sources."""
    n = 12_000
    docs = frame(spark, ["x" * 9] * n, sources=["hot" if i % 2 else f"s{i // 2 % sources}" for i in range(n)])
    weights = {"hot": sources / 2.0} | {f"s{i}": 1.0 for i in range(sources)}
    got = schedule(docs, weights, block_chars=10).select("source", "slot").collect()
    share = {s: w / (1.5 * sources) for s, w in weights.items()}
    by = {}
    for r in got:
        by.setdefault(r.source, []).append(r.slot)
    assert len({r.slot for r in got}) == n
    for s, own in by.items():  # block j is less than one block from its share before and after its slot
        for j, t in enumerate(sorted(own)):
            assert abs(j - share[s] * t) < 1 + 1e-6 and abs(j + 1 - share[s] * (t + 1)) < 1 + 1e-6


def test_blocks_grow_with_the_table_and_keep_the_bound(spark, monkeypatch):
    """Past the number of blocks that are scheduled, blocks are longer and still less than one off."""
    from quarry.llm import mixing as module

    monkeypatch.setattr(module, "MOST_BLOCKS", 500)
    n, share = 30_000, {"hot": 1 / 2, "a": 1 / 3, "b": 1 / 6}
    docs = frame(spark, ["x" * (i % 19) for i in range(n)], sources=["hot" if i % 2 else "ab"[i // 2 % 2] for i in range(n)])
    got = schedule(docs, share, block_chars=10).select("doc.doc_id", "source", "block", "slot", "at").collect()
    chars = sum(i % 19 + 1 for i in range(n))
    size = -(-chars // 500)
    assert sorted(r.doc_id for r in got) == list(range(n)) and all(r.block == r.at // size for r in got)
    by = {s: sorted({r.slot for r in got if r.source == s}) for s in share}
    assert 490 < sum(map(len, by.values())) <= 503
    for s, own in by.items():
        for j, t in enumerate(own):
            assert abs(j - share[s] * t) < 1 + 1e-6 and abs(j + 1 - share[s] * (t + 1)) < 1 + 1e-6


def test_mixing_awkward_rows(spark):
    texts = awkward() + ["r", "r"]
    docs = frame(spark, texts, [*range(len(texts) - 2), 50, 50], [None, "n", "", "s"] * 4 + ["n", "n"])
    got = mix(docs, block_chars=10)
    assert got.columns == docs.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, docs.collect()))
    assert mix(spark.createDataFrame([], SCHEMA)).count() == 0


def test_pipeline_against_brute_force(spark):
    import re

    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    good = pipeline.quality(spark, docs, SF01)
    assert good.columns == docs.columns
    left = sorted(r.doc_id for r in good.collect())
    scored = {r.doc_id: r.predicted for r in score_documents(docs, spark.read.parquet(f"{SF01}/labels.parquet")).collect()}
    assert left == sorted(i for i, p in scored.items() if p)
    groups = {}
    for i in left:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", texts[i]), []).append(i)
    left = sorted(min(g, key=lambda i: (-len(texts[i]), i)) for g in groups.values())
    low = components([shingles(texts[i], 5) for i in left])
    left = [i for n, i in enumerate(left) if low[n] == n]
    packed = pipeline.run(spark, SF01).collect()
    assert sorted({r.doc_id for r in packed}) == left
    assert [n for n, _ in pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "mixing", "packing"]
    assert pipeline.ORACLE_SQL is None


def test_stages_keep_the_columns_of_documents(spark):
    import corpus_pipeline as pipeline

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for name, stage in pipeline.STAGES[:-1]:
        assert stage(spark, docs, "/root/testdata/sf0.001").schema == docs.schema, name
