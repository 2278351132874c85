"""Exact, line and near deduplication against plain Python."""

import hashlib
import random
import re

from pyspark.sql import functions as F
from pyspark.testing.utils import assertDataFrameEqual

from helpers import PROSE, SCHEMA, SPACE, awkward, components, frame, lower, shingles
from quarry.llm.components import components as spark_components
from quarry.llm.exact_dedup import drop_exact_copies, exact_dedup
from quarry.llm.line_dedup import dropped_lines, line_dedup
from quarry.llm.near_dedup import drop_near_copies, near_dedup


def exact_truth(texts, ids):
    norm = [re.sub(SPACE, "", t or "") for t in texts]
    out = []
    for n, t, i in zip(norm, texts, ids):
        group = [(-len(u or ""), j is None, j or 0) for m, u, j in zip(norm, texts, ids) if m == n]
        keep = min(group)
        out.append((i, None if keep[1] else keep[2], len(group), hashlib.sha256(n.encode()).hexdigest()))
    return sorted(out, key=str)


def test_exact_dedup_awkward_rows(spark):
    texts = awkward() + [PROSE, PROSE, None]
    ids = [*range(len(texts) - 2), 9, None]  # an id and text that repeat, and a null id
    got = exact_dedup(frame(spark, texts, ids), block=1024).collect()
    assert sorted(((r.id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == exact_truth(texts, ids)
    groups = {}
    for r in got:
        groups.setdefault(r.text_sha256, []).append(r.kept)
    assert all(sum(g) == 1 for g in groups.values())


def test_block_names_are_exact_for_any_number_of_blocks(spark):
    rng = random.Random(1)
    blocks = ["".join(rng.choice("ab") for _ in range(4)) for _ in range(6)]
    texts = ["".join(rng.choice(blocks) for _ in range(rng.randrange(0, 9))) + rng.choice(["", "a"]) for _ in range(300)]
    got = exact_dedup(frame(spark, texts), block=4).collect()
    assert sorted(((r.id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == exact_truth(texts, range(300))


def test_names_of_keys_that_share_a_hash(spark):
    from quarry.llm.common import materialise, ranks

    rng = random.Random(3)
    keys = [rng.choice(["hot", "b", "c", *map(str, range(50))]) if i % 3 else "hot" for i in range(900)]
    for spread in (1, 2, 7, 10 ** 6):  # hashes in all, from one to about one a key
        rows = [(i, k, sum(map(ord, k)) * 7919 % spread) for i, k in enumerate(keys)]
        table = materialise(spark.createDataFrame(rows, "row long, key string, _h long"), "rows")
        for most in (2, 1000):
            got = ranks(table, ["key"], "name", buckets=4, most=most)
            assert got.columns == ["row", "name"]
            found = {(keys[r.row], r.name) for r in got.collect()}
            assert got.count() == 900 and len(found) == len(set(keys)) == len({n for _, n in found})


def test_hot_blocks_are_not_shuffled_row_by_row(spark):
    """Blocks are combined before they move: what moves doesn't grow with the copies."""
    from quarry.llm.common import materialise, ranks

    rows = spark.range(4000).select("id", F.lit("x" * 4000).alias("block")).withColumn("_h", F.xxhash64("block"))
    table = materialise(rows, "rows")
    assert ranks(table, ["block"], "name").select("name").distinct().count() == 1
    plan = table.select("_h", "block").distinct()._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.rindex("HashAggregate") and plan.count("HashAggregate") == 2


def test_drop_exact_copies_keeps_whole_rows(spark):
    docs = frame(spark, ["a b", "ab", "c", "c", None, ""], [1, 2, 3, 3, 4, 5])
    got = drop_exact_copies(docs)
    assert got.columns == docs.columns
    assert sorted((r.doc_id, r.text, r.id) for r in got.collect()) == sorted([(1, "a b", "x"), (3, "c", "x"), (4, None, "x")], key=lambda r: r[0])


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert exact_dedup(docs).count() == 0
    assert line_dedup(docs).count() == 0
    assert near_dedup(docs).count() == 0
    assert drop_exact_copies(docs).columns == docs.columns
    assert drop_near_copies(docs).count() == 0


def line_truth(texts, min_docs, keep_first=False, min_chars=1):
    key = lambda x: lower(re.sub(f"^{SPACE}+|{SPACE}+$", "", x))
    split = [(t or "").split("\n") for t in texts]
    where = {}
    for d, lines in enumerate(split):
        for n, x in enumerate(lines):
            if len(key(x)) >= min_chars and key(x):
                where.setdefault(key(x), []).append((d, n))
    gone = set()
    for spots in where.values():
        if len({d for d, _ in spots}) >= min_docs:
            gone.update(sorted(spots)[1:] if keep_first else spots)
    return [(d, len(lines), sum((d, n) in gone for n in range(len(lines))),
             "\n".join(x for n, x in enumerate(lines) if (d, n) not in gone)) for d, lines in enumerate(split)]


def test_line_dedup_awkward_rows(spark):
    texts = awkward() + ["Same É\nown 1\n same É\t", "sAME É\n\nsame É", "\x0bsame É", "same é"]
    # almost all keys by ranges, or all by counts
    for min_docs, keep_first, share in ((2, False, 1), (2, True, 1), (2, True, 10 ** 6), (3, False, 10 ** 6), (1, True, 1)):
        got = line_dedup(frame(spark, texts), min_docs=min_docs, keep_first=keep_first, hot_share=share).collect()
        assert sorted((r.id, r.n_lines, r.n_dropped, r.text) for r in got) == line_truth(texts, min_docs, keep_first)


def test_line_dedup_counts_a_repeated_row_once_and_allows_null_ids(spark):
    docs = frame(spark, ["x\na", "x\na", "x\nb", "x"], [1, 1, None, 2])
    got = line_dedup(docs, min_docs=4).collect()
    assert {r.n_dropped for r in got} == {0}
    got = line_dedup(docs, min_docs=3).collect()
    assert sorted((str(r.id), r.text) for r in got) == [("1", "a"), ("1", "a"), ("2", ""), ("None", "b")]


def test_the_stream_answers_on_the_given_documents(spark, monkeypatch):
    """No line there is as frequent as a range is large, so every dropped line comes from the sorted ranges."""
    from quarry.llm import line_dedup as module

    written = {}
    real = module.materialise
    monkeypatch.setattr(module, "materialise", lambda df, what: written.setdefault(what, real(df, what)))
    bits = dropped_lines(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), min_docs=10)
    assert bits.count() > 0 and written["hot-lines"].count() == 0


def test_keep_bitmaps_are_sparse(spark):
    docs = frame(spark, ["\n".join(f"l{i}" for i in range(200)), "l3\nl70\nz", "q"])
    bits = dropped_lines(docs, min_docs=2).collect()
    assert sorted([(w.word, w.bits) for w in r.bits] for r in bits) == [[(0, 3)], [(0, 1 << 3), (1, 1 << 6)]]


def variants(rng, base, n, most):
    out = []
    for _ in range(n):
        w = base.split()
        for _ in range(rng.randrange(most)):
            w[rng.randrange(len(w))] = f"v{rng.randrange(10 ** 6)}"
        out.append(" ".join(w))
    return out


def test_near_dedup_against_all_pairs(spark):
    rng = random.Random(5)
    common = " ".join(f"c{i}" for i in range(60))
    texts = awkward()
    for b in range(6):  # groups of near copies around 0.8, a passage they all share
        base = common + " " + " ".join(f"b{b}w{rng.randrange(200)}" for _ in range(120 + 40 * b))
        texts += variants(rng, base, 25, 8)
    texts += ["one two", "one  TWO", "one two three", "one", "", texts[-1]]
    for n in (4, 5):
        sets = [shingles(t, n) for t in texts]
        got = near_dedup(frame(spark, texts), words=n).collect()
        want = components(sets)
        assert sorted((r.id, r.n_shingles, r.component_id, r.kept) for r in got) == [
            (i, len(s), c, c == i) for i, (s, c) in enumerate(zip(sets, want))]


def test_near_dedup_splits_large_groups(spark, monkeypatch):
    from quarry.llm import near_dedup as module

    monkeypatch.setattr(module, "GROUP", 16)
    rng = random.Random(9)
    texts = variants(rng, " ".join(f"w{i}" for i in range(150)), 120, 9)
    got = near_dedup(frame(spark, texts), words=5).collect()
    assert [r.component_id for r in sorted(got, key=lambda r: r.id)] == components([shingles(t, 5) for t in texts])


def test_large_groups_are_paired_only_where_the_leader_leaves_members(spark, monkeypatch):
    """Sets around 0.8 from each other and from the first, in blocks of 8: linked members aren't paired with each other."""
    from quarry.llm import near_dedup as module

    monkeypatch.setattr(module, "GROUP", 8)
    seen, real = [], module.materialise
    monkeypatch.setattr(module, "materialise", lambda df, what: seen.append((what, real(df, what))) or seen[-1][1])
    rng = random.Random(11)
    base = " ".join(f"w{i}" for i in range(300))
    near = [base] + variants(rng, base, 150, 4)
    for texts, open_ in ((near, False), (near + variants(rng, base, 100, 26), True)):
        seen.clear()
        got = near_dedup(frame(spark, texts), words=5).collect()
        assert [r.component_id for r in sorted(got, key=lambda r: r.id)] == components([shingles(t, 5) for t in texts])
        tables = dict(seen)
        linked = tables["stars"].groupBy("linked").count().collect()
        assert tables["groups"].filter("nb > 10").count() > 0 and sum(r["count"] for r in linked) >= len(texts) // 2
        assert (tables["open-groups"].count() > 0) == open_


def test_near_dedup_repeated_rows_and_null_ids(spark):
    docs = frame(spark, [PROSE, PROSE, PROSE, None, None], [3, 3, None, None, 4])
    got = near_dedup(docs).collect()
    assert sorted((str(r.id), str(r.component_id)) for r in got) == [("3", "3"), ("3", "3"), ("4", "4"), ("None", "3"), ("None", "None")]
    assert sum(r.kept for r in got) == 3
    kept = drop_near_copies(docs)
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["3", "4", "None"]


def test_components_of_chains_and_hubs(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    hub = [(500, 500 + i) for i in range(1, 50)]
    links = spark.createDataFrame([*chain, *hub, (500, 9), (7, 7)], "a long, b long")
    got = spark_components(links)
    want = [(i, 100) for i in range(100, 161)] + [(500 + i, 9) for i in range(50)] + [(9, 9)]
    assertDataFrameEqual(got, spark.createDataFrame(want, "node long, component long"))
    assert spark_components(links.filter("a < 0")).count() == 0


def test_op_queries_equal_duckdb(spark):
    from quarry.llm.queries import ORACLE_SQL, QUERIES
    from quarry.plans.check import digest, duck_connection, run_oracle

    con = duck_connection("/root/testdata/sf0.01")
    for key, sql in ORACLE_SQL.items():
        df = QUERIES[key](spark, "/root/testdata/sf0.01")
        columns, rows = run_oracle(con, sql)
        assert sorted(df.columns) == sorted(columns)
        assert digest(df.columns, [tuple(r) for r in df.collect()]) == digest(columns, rows), key


def test_main_paths_have_no_python(spark):
    from quarry.llm import queries

    for key in ("op7_exact_dedup", "op9_line_dedup"):
        plan = queries.QUERIES[key](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|Arrow", plan)
