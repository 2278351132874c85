"""Importance resampling, decontamination and clustering against plain readings of their contracts."""

import hashlib
import math
import random
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest

from helpers import SCHEMA, awkward, frame, lower
from quarry.llm import clustering, common, decontamination
from quarry.llm.clustering import _limbs, cluster_vectors, nearest
from quarry.llm.decontamination import covered_words, decontaminate
from quarry.llm.letters import word_runs
from quarry.llm.quickselect import kth_key, smallest_ranked
from quarry.llm.resampling import feature_buckets, importance_resample

ITEMS = "item_id long, text string, doc_id string, h int, row int, n int"


def plain_words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(text))


def items_of(spark, texts, ids=None):
    return spark.createDataFrame([(i, t, "d", 1, 2, 3) for i, t in zip(ids or range(len(texts)), texts)], ITEMS)


# --- words ---------------------------------------------------------------

TEXTS = awkward() + ["a" * 70, "x-y", "\x00é\x7f", "ÀB c9", ". . .", "one two", "w " * 40 + "." * 90 + " last"]


@pytest.mark.parametrize("limit", [1 << 22, 64, 7])
@pytest.mark.parametrize("overlap", [0, 2, 5])
def test_words_come_whole_in_pieces_of_any_size(limit, overlap):
    texts = [t if t is None or len(t) < 3000 else t[:3000] for t in TEXTS]
    got = {i: [] for i in range(len(texts))}
    for run in word_runs(pa.array(texts), overlap, limit):
        words = [run.text[a:b - 1].tobytes().decode() for a, b in zip(run.at, run.at[1:])]
        for r, (a, b) in enumerate(zip(run.first, run.first[1:])):
            row = got[run.start_row + r]
            assert run.base + run.fresh == len(row) or b - a == 0 or run.base == 0
            assert run.base == 0 or words[a:a + run.fresh] == row[len(row) - run.fresh:]
            row += words[a + run.fresh:b]
    assert [got[i] for i in range(len(texts))] == [plain_words(t) for t in texts]


# --- quickselect and resampling ------------------------------------------

@pytest.mark.parametrize("pivots", [3, 255])
def test_quickselect_finds_the_kth_key(spark, pivots):
    rng = random.Random(pivots)
    keys = [(rng.randrange(4), i % 5 == 0, None if i % 5 == 0 else rng.choice("aébB"), i) for i in range(60)]
    rows = spark.createDataFrame([(k,) for k in keys], "key struct<down: long, no_id: boolean, id: string, row: long>")
    order = sorted(keys, key=lambda k: (k[0], k[1], (k[2] or "").encode(), k[3]))
    for k in (1, 17, 60):
        assert tuple(kth_key(rows, k, pivots=pivots)) == order[k - 1]
    assert kth_key(rows, 0) is None and kth_key(rows, 61) is None
    for k in (0, 25, 99):
        got = smallest_ranked(rows, k).orderBy("rank").collect()
        assert [tuple(r["key"]) for r in got] == order[:k] and [r["rank"] for r in got] == list(range(1, len(order[:k]) + 1))
    assert smallest_ranked(rows.limit(0), 3).count() == 0


def resampled(docs, target, percent, least, longest, buckets, seed=2024):
    def features(text):
        w = plain_words(text)
        return [" ".join(w[i:i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]

    def bucket(f):
        return zlib.crc32(f.encode()) % buckets

    s, t = [0] * buckets, [0] * buckets
    for side, texts in ((s, [d[1] for d in docs]), (t, target)):
        for text in texts:
            for f in features(text):
                side[bucket(f)] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + buckets) / ((s[b] + 1) * (sum(t) + buckets)))) for b in range(buckets)]
    out = []
    for i, text in docs:
        f = features(text)
        weight = sum(gain[bucket(x)] for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(plain_words(text)), len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for n, r in enumerate(able[:len(able) * percent // 100], 1):
        r[5] = n
    return sorted(map(tuple, out), key=str)


@pytest.mark.parametrize("longest,piece", [(1, 1 << 22), (3, 1 << 22), (3, 50)])
def test_resampling_against_a_plain_reading(spark, longest, piece):
    run = next(iter(word_runs(pa.array(["b a b a"]))))
    assert [len(b) for _, b in feature_buckets(run, 2, 100)] == [4, 3]
    texts = [t if t is None or len(t) < 9000 else t[:9000] for t in TEXTS] + [f"word{i} of the {i % 3} kind " * (i % 9) for i in range(60)]
    ids = [None, 7, 7, *range(10, len(texts) + 7)]
    target = ["kind of the word word", None, "", "Of! THE É"]
    docs = frame(spark, texts, ids)
    got = importance_resample(docs, items_of(spark, target), 30, 5, 2024, longest, 500, piece=piece)
    assert sorted((tuple(r) for r in got.collect()), key=str) == resampled(list(zip(ids, texts)), target, 30, 5, longest, 500)


def test_resampling_of_empty_tables(spark):
    docs, none = frame(spark, ["a b c", None]), spark.createDataFrame([], SCHEMA)
    assert importance_resample(none, items_of(spark, ["a"])).count() == 0
    got = importance_resample(docs, items_of(spark, []), percent=100, min_words=0).collect()
    assert sorted(r["rank"] for r in got) == [1, 2]
    assert {r["rank"] for r in importance_resample(docs, items_of(spark, ["a"])).collect()} == {None}


def test_equal_ids_and_scores_take_one_rank_each(spark):
    got = importance_resample(frame(spark, ["a b"] * 40, [3] * 20 + [None] * 20), items_of(spark, ["a"]), percent=50, min_words=1).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 21))


# --- decontamination -----------------------------------------------------

def contaminated(docs, items, window):
    wins = []
    for i, text in items:
        w = plain_words(text)
        n = min(window, len(w))
        wins += [("null" if i is None else str(i), tuple(w[p:p + n])) for p in range(len(w) - n + 1)] if w else []
    out = []
    for i, text in docs:
        w = plain_words(text)
        at = {}
        for p in range(len(w)):
            for n in {len(x) for _, x in wins}:
                if p + n <= len(w):
                    at.setdefault(tuple(w[p:p + n]), []).append(p)
        hit, names = set(), set()
        for name, x in wins:
            for p in at.get(x, ()):
                hit.update(range(p, p + len(x)))
                names.add(name)
        out.append((i, len(w), len(hit), sorted(names, key=lambda s: s.encode())))
    return sorted(out, key=str)


@pytest.mark.parametrize("window,shingle,piece", [(10, 5, 1 << 22), (10, 5, 40), (4, 5, 40), (3, 1, 1 << 22)])
def test_decontamination_against_a_plain_reading(spark, monkeypatch, window, shingle, piece):
    monkeypatch.setattr(decontamination, "_BLOCK", 8)
    rng = random.Random(window)
    voc = ["the", "of", "A9", "é", "x"]
    say = lambda n: " ".join(rng.choice(voc) for _ in range(n))
    items = [say(n) for n in (1, 2, 3, 4, 6, 11, 14, 14)] + ["zz " * 12, None, "", "...", "Übung macht den Meister", "Übung macht den Meister"]
    ids = [*range(len(items) - 3), None, 3, 100]
    texts = [say(rng.randrange(60)) for _ in range(40)] + [items[5] + ". " + items[6].upper(), items[7] + "x", "zz," * 40, "ZZ\n" * 9,
                                                           "die übung macht den meister", "y Übung macht den Meister!"] + [
        t if t is None or len(t) < 2000 else t[:2000] for t in awkward()]
    doc_ids = [None, 5, 5, *range(10, len(texts) + 7)]
    got = decontaminate(frame(spark, texts, doc_ids), items_of(spark, items, ids), window, shingle, piece=piece)
    want = contaminated(list(zip(doc_ids, texts)), list(zip(ids, items)), window)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    assert any(r[2] for r in want) and not all(r[2] for r in want)


def test_decontamination_of_empty_tables(spark):
    docs, none = frame(spark, ["a b c", None]), spark.createDataFrame([], SCHEMA)
    assert decontaminate(none, items_of(spark, ["a"])).count() == 0
    assert [tuple(r)[1:] for r in decontaminate(docs, items_of(spark, [])).orderBy("id").collect()] == [(3, 0, []), (0, 0, [])]
    assert [tuple(r)[1:] for r in decontaminate(docs, items_of(spark, [None, "", "C b"])).orderBy("id").collect()] == [(3, 0, []), (0, 0, [])]


def test_a_hot_passage_and_a_long_document(spark):
    passage = " ".join(f"w{i}" for i in range(15))
    texts = [passage + f" tail{i}" for i in range(400)] + [" ".join([passage] * 3000)]
    got = {r["id"]: r for r in decontaminate(frame(spark, texts), items_of(spark, [passage, passage + " more"])).collect()}
    assert all(got[i]["n_hit"] == 15 and got[i]["items"] == ["0", "1"] for i in range(400))
    assert got[400]["n_hit"] == 45_000 == got[400]["n_words"]


def test_tables_of_a_small_benchmark_are_few_files(spark, monkeypatch, tmp_path):
    """Not a tiny file a shuffle partition: each costs a task three started processes on a local disk."""
    many = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {key: spark.conf.get(key) for key in many}
    monkeypatch.setattr(common, "shared_path", lambda _, what: str(tmp_path / what))
    rng = random.Random(9)
    try:
        for key, value in many.items():
            spark.conf.set(key, value)
        items = [" ".join(f"w{rng.randrange(300)}" for _ in range(60)) for _ in range(12)]
        found = decontaminate(frame(spark, [*items, "no hit"]), items_of(spark, items))
        assert {r["id"]: r["n_hit"] for r in found.collect()} == {**dict.fromkeys(range(12), 60), 12: 0}
        assert found.rdd.getNumPartitions() == 1
        for what in ("windows", "window-items", "window-shingles", "shingle-counts", "window-prefixes"):
            assert len(list((tmp_path / what).glob("part-*"))) <= 2, what
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)


def test_a_piece_of_text_needs_little_memory():
    text = " ".join(f"word{i % 5000}" for i in range(800_000))
    tracemalloc.start()
    try:
        n = sum(len(decontamination.shingle_hashes(run, 5)[0]) for run in word_runs(pa.array([text[:4 << 20]] * 2), 9, decontamination.PIECE))
        _, most = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert n == 2 * (len(text[:4 << 20].split()) - 4)
    assert most < 80 << 20


def test_spans_that_overlap_count_once(spark):
    spans = [(1, 0, 3), (1, 2, 4), (1, 3, 1), (1, 65530, 20), (1, 65540, 3), (2, 65535, 2)]
    got = covered_words(spark.createDataFrame(spans, "row long, start long, n int")).collect()
    assert {r["row"]: r["n_hit"] for r in got} == {1: 26, 2: 2}


# --- clustering ----------------------------------------------------------

def clustered(vectors, k, rounds, scale, seed):
    rows = [(i, [math.floor(scale * float(x)) for x in v]) for i, v in vectors]
    name = lambda i: hashlib.sha256(f"{seed}:{'null' if i is None else i}".encode()).hexdigest()
    centres = [v for _, v in sorted(rows, key=lambda r: (name(r[0]), r[1]))[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centres)) for _, v in rows]

    for _ in range(rounds):
        found = assign()
        for j in range(len(centres)):
            mine = [v for (_, v), (_, c) in zip(rows, found) if c == j]
            if mine:
                centres[j] = [sum(x) // len(mine) for x in zip(*mine)]
    found = assign()
    most = (1 << 63) - 1
    held = [min(d, most) for d, _ in found]
    sums = [min(sum(d for d, (_, c) in zip(held, found) if c == j), most) for j in range(len(centres))]
    total = sum(sum(d for d, (_, c) in zip(held, found) if c == j) for j in range(len(centres)))
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, c, d, sums[c], min(total, most), sha[c]) for (i, _), (_, c), d in zip(rows, found, held)), key=str)


VECTORS = "vec_id long, embedding array<{}>, label int, cluster string, ids int"


@pytest.mark.parametrize("kind,size", [("float", 1.0), ("double", 1.0), ("double", 1e200), ("float", 3e30)])
def test_clustering_against_a_plain_reading(spark, kind, size):
    rng = np.random.default_rng(5)
    cast = np.float32 if kind == "float" else np.float64
    good = [(i, [float(cast(x * size)) for x in rng.normal(size=6) + 3 * (i % 4)]) for i in range(200)]
    good += [(None, good[3][1]), (7, good[9][1]), (7, good[9][1]), (500, [-0.0] * 6), (501, [0.0] * 6)]
    bad = [(900, None), (901, []), (902, [1.0] * 5), (903, [None] + [1.0] * 5), (904, [float("nan")] * 6), (905, [float("inf")] + [0.0] * 5)]
    bad += [(906, [1.7e308] + [0.0] * 5)] if kind == "double" else []
    rows = spark.createDataFrame([(i, v, 1, "c", 2) for i, v in good + bad], VECTORS.format(kind)).repartition(5)
    got = cluster_vectors(rows, k=5, rounds=4, dim=6, scale=1024, seed=3, block=16)
    assert sorted((tuple(r) for r in got.collect()), key=str) == clustered(good, 5, 4, 1024, 3)


def test_few_vectors_and_none(spark):
    rows = [(1, [0.5, 0.25], 1, "c", 2), (2, [0.5, 0.25], 1, "c", 2), (3, [-0.5, 1.0], 1, "c", 2)]
    got = cluster_vectors(spark.createDataFrame(rows, VECTORS.format("float")), k=8, rounds=3, dim=2)
    assert sorted((tuple(r) for r in got.collect()), key=str) == clustered([r[:2] for r in rows], 8, 3, 1024, 3)
    assert cluster_vectors(spark.createDataFrame([], VECTORS.format("float"))).count() == 0


def test_tables_give_equal_distances_and_ties_go_to_the_smaller_number():
    lists = [np.array([-3.0, 5.0]), np.array([0.0, 1.0, 2.0])]
    codes = np.array([[0, 1, 1], [2, 0, 1]], np.uint16)
    cluster, distance, _ = nearest(lists, codes, [[1, 1], [1, 1], [5, 0]])
    assert cluster.tolist() == [0, 2, 2] and distance.tolist() == [17, 0, 1]
    for whole in (0, -1, 1 << 31, -(1 << 31), (1 << 95) + 5, -(1 << 200) - 3):
        assert sum(x << 32 * j for j, x in enumerate(_limbs(whole))) == whole
    assert clustering._SMALL ** 2 * 4 * 512 <= 1 << 63


# --- the registered queries ----------------------------------------------

@pytest.mark.parametrize("key", ["op11_importance_resampling", "op12_decontamination", "op13_clustering"])
def test_queries_against_their_sql(spark, key):
    from quarry.llm.queries import ORACLE_SQL, QUERIES
    from quarry.plans.check import digest, duck_connection, run_oracle

    df = QUERIES[key](spark, "/root/testdata/sf0.01")
    columns, rows = run_oracle(duck_connection("/root/testdata/sf0.01"), ORACLE_SQL[key])
    assert sorted(df.columns) == sorted(columns) and digest(df.columns, [tuple(r) for r in df.collect()]) == digest(columns, rows)
