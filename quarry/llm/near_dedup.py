"""Near-duplicate documents by bottom-k sketches of one hash function."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import hash128, materialise, row_hash, whole_row
from quarry.llm.components import components
from quarry.llm.words import shingle_sets, text_runs

K = 64  # values kept of each set
SHARE = 0.5  # of a sketch must be shared by candidates; 0.8 +- 6 standard errors at K
GROUP, GROUP_MB = 128, 32  # members and MB of sets compared at once


def _binary(sets: list[np.ndarray]) -> pa.Array:
    return pa.array([s.tobytes() for s in sets], pa.binary())


def sketches(docs: DataFrame, id_col: str, text_col: str, words: int, k: int = K) -> DataFrame:
    """row, id, d1, d2, n (set size), f1, f2 (fingerprint of the whole set), sketch (its ``k`` lowest hashes)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    d1, d2 = hash128(F.col(id_col), text)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), d1.alias("d1"), d2.alias("d2"), text.alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_runs(batch.column("text")):
                sizes, prints, kept = [], [], []
                for s in shingle_sets(data, offsets, words):
                    sizes.append(len(s))
                    prints.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                    kept.append(s[:k].view(np.int64))
                fp = np.frombuffer(b"".join(prints), np.int64).reshape(-1, 2)
                flat = np.concatenate(kept) if kept else np.empty(0, np.int64)
                at = np.cumsum([0, *map(len, kept)]).astype(np.int32)
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in ("row", "id", "d1", "d2")]
                    + [pa.array(sizes, pa.int64()), pa.array(fp[:, 0]), pa.array(fp[:, 1]), pa.ListArray.from_arrays(pa.array(at), pa.array(flat))],
                    names=["row", "id", "d1", "d2", "n", "f1", "f2", "sketch"])

    return rows.mapInArrow(sketch, f"row long, id {kind}, d1 long, d2 long, n long, f1 long, f2 long, sketch array<long>")


def _full_sets(docs: DataFrame, id_col: str, text_col: str, wanted: DataFrame, words: int) -> DataFrame:
    """(class, items) of the classes in ``wanted`` (d1, d2, class): whole sorted sets as bytes."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    d1, d2 = hash128(F.col(id_col), text)
    texts = (docs.select(d1.alias("d1"), d2.alias("d2"), text.alias("text")).join(wanted, ["d1", "d2"])
             .select("class", "text"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_runs(batch.column("text")):
                found = list(shingle_sets(data, offsets, words))
                yield pa.RecordBatch.from_arrays([batch.column("class").slice(lo, hi - lo), _binary(found)], names=["class", "items"])

    return texts.mapInArrow(sets, "class long, items binary")


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    both = int(np.count_nonzero(large[at] == small))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _estimate(a: np.ndarray, b: np.ndarray, both: int) -> float:
    """Jaccard similarity of the two sets below the lower of their sketches' top values."""
    top = min(a[-1], b[-1])
    return both / (np.searchsorted(a, top, "right") + np.searchsorted(b, top, "right") - both)


def _links(ids: list[int], blocks: list[int], sets: list[np.ndarray], linked: np.ndarray, i: int, j: int, k: int, percent: int) -> list[tuple[int, int]]:
    """Links that connect what is connected among the pairs of blocks ``i`` and ``j``; ``linked`` members are connected already."""
    root = list(range(len(ids)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    known = np.flatnonzero(linked)
    for x in known[1:]:
        root[x] = int(known[0])
    out: list[tuple[int, int]] = []
    left = [x for x in range(len(ids)) if blocks[x] == i]
    right = [x for x in range(len(ids)) if blocks[x] == j]
    if len(left) == 0 or len(right) == 0 or (i == j and len(left) < 2):
        return out
    heads = [s[:k] for s in sets]
    size = np.array([len(h) for h in heads])
    values, col, often = np.unique(np.concatenate(heads), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(ids)), size)
    new = np.cumsum(often > 1) - 1
    keep = often[col] > 1
    seen = np.zeros((len(ids), int((often > 1).sum())), np.float32)
    seen[row[keep], new[col[keep]]] = 1
    both = seen[left] @ seen[right].T
    lx, rx = np.array(left), np.array(right)
    share = percent / 100 - (0.8 - SHARE)
    possible = both >= share * np.minimum.outer(size[lx], size[rx])
    possible &= ~np.logical_and.outer(linked[lx], linked[rx])
    if i == j:
        possible = np.triu(possible, 1)
    xs, ys = np.nonzero(possible)
    for n in np.argsort(-both[xs, ys], kind="stable"):
        x, y = left[xs[n]], right[ys[n]]
        if find(x) == find(y) or _estimate(heads[x], heads[y], int(both[xs[n], ys[n]])) < share:
            continue
        if _similar(sets[x], sets[y], percent):
            root[find(x)] = find(y)
            out.append((ids[x], ids[y]))
    return out


def _stars(dealt: DataFrame, percent: int) -> DataFrame:
    """``dealt`` rows (leader, blk, class, items) of members, each with whether it is similar to its leader.

    A leader's set goes once to each block of its group and is all that a
    task holds of the group, so a group of any size is one pass.
    """
    first = F.col("class") == F.col("leader")
    copies = F.when(first, F.sequence(F.lit(0), F.col("nb") - 1)).otherwise(F.array("blk"))
    work = dealt.select("leader", F.explode(copies).alias("blk"), (~first).alias("later"), "class", "items")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead = np.empty(0, np.uint64)
        for batch in batches:
            out: list[tuple[int, int, bool]] = []
            for leader, later, cls, items in zip(*(batch.column(c).to_pylist() for c in ("leader", "later", "class", "items"))):
                own = np.frombuffer(items, np.uint64)
                if later:
                    out.append((leader, cls, _similar(lead, own, percent)))
                else:
                    lead = own
            yield pa.RecordBatch.from_arrays([pa.array([x[n] for x in out], t) for n, t in enumerate((pa.int64(), pa.int64(), pa.bool_()))],
                                             names=["leader", "class", "linked"])

    order = ["leader", "blk", "later"]
    return work.repartition("leader", "blk").sortWithinPartitions(*order).mapInArrow(compare, "leader long, class long, linked boolean")


def near_links(docs: DataFrame, rows: DataFrame, classes: DataFrame, id_col: str, text_col: str, words: int, percent: int, k: int = K) -> DataFrame:
    """Verified links (a, b) between set classes that connect all similar ones.

    The inverted lists hold, of each sketch, only its values of lowest
    frequency: sketches that share at least ``SHARE`` of their values must
    meet in such a list, whereas values in a great many documents are in the
    lists of documents that hold little else.  All lists with the same
    lowest member (the leader) are one group, and each member is compared
    with the leader, then with the members that aren't yet connected with it.
    A group of more than one block of bounded size is first compared with its
    leader block by block; the members that are not similar to it are dealt
    into blocks again and compared with each other and with the rest, a pair
    of blocks at a time.  So a large group of near copies costs one pass, and
    only what its leader leaves is paired.  Candidates pass the union-sketch
    estimate and are verified on whole sets; a group yields a spanning
    forest, not all pairs.
    """
    reps = rows.join(classes.select("class"), rows["row"] == classes["class"], "left_semi")
    reps = reps.select(F.col("row").alias("class"), "d1", "d2", "n", "sketch")
    values = reps.select("class", F.size("sketch").alias("held"), F.explode("sketch").alias("v"))
    often = materialise(values.groupBy("v").agg(F.count(F.lit(1)).alias("often")).filter("often > 1"), "frequencies")
    own = values.join(often, "v").groupBy("class", "held").agg(F.array_sort(F.collect_list(F.struct("often", "v"))).alias("vs"))
    # the values that no other sketch has come first in the order of frequency
    share = percent / 100 - (0.8 - SHARE)
    prefix = F.col("held") - F.ceil(F.col("held") * share) + 1 - (F.col("held") - F.size("vs"))
    posts = materialise(own.select("class", F.explode(F.slice("vs", F.lit(1), F.greatest(prefix, F.lit(0)).cast("int"))).alias("p"))
                        .select(F.col("p.v").alias("v"), "class"), "postings")
    leads = materialise(posts.groupBy("v").agg(F.min("class").alias("leader"), F.count(F.lit(1)).alias("m")).filter("m > 1").drop("m"), "leaders")
    members = materialise(posts.join(leads, "v").select("leader", "class").distinct(), "members")

    wanted = reps.select("class", "d1", "d2", "n").join(members.select("class").distinct(), "class", "left_semi")
    sets = materialise(_full_sets(docs, id_col, text_col, wanted.select("d1", "d2", "class"), words)
                       .dropDuplicates(["class"]), "sets")
    n_blocks = F.greatest(F.ceil(F.count(F.lit(1)) / GROUP), F.ceil(F.sum("bytes") / F.lit(GROUP_MB << 20)), F.lit(1)).cast("int")
    sized = members.join(sets.select("class", F.octet_length("items").alias("bytes")), "class")
    big = materialise(sized.groupBy("leader").agg(n_blocks.alias("nb")), "groups")
    dealt = members.join(big, "leader").withColumn("blk", F.pmod(F.xxhash64("class"), F.col("nb")).cast("int"))
    stars = materialise(_stars(dealt.filter("nb > 1").join(sets, "class"), percent), "stars")

    # what the leaders leave gets the first blocks of its group, what they link the others
    counts = stars.join(sets.select("class", F.octet_length("items").alias("bytes")), "class").groupBy("leader", "linked").agg(n_blocks.alias("n"))
    width = materialise(counts.groupBy("leader").agg(F.max(F.when(~F.col("linked"), F.col("n"))).alias("nu"),
                                                     F.coalesce(F.max(F.when(F.col("linked"), F.col("n"))), F.lit(0)).alias("nl")).filter("nu > 0"), "open-groups")
    open_ = stars.join(width, "leader")
    nth = F.xxhash64(F.lit(2), "class")
    blk = F.when(F.col("linked"), F.col("nu") + F.pmod(nth, F.col("nl"))).otherwise(F.pmod(nth, F.col("nu"))).cast("int")
    partner = F.explode(F.sequence(F.lit(0), F.when(F.col("linked"), F.col("nu")).otherwise(F.col("nu") + F.col("nl")) - 1))
    work = open_.select("leader", "class", "linked", blk.alias("blk"), partner.alias("x"))
    work = work.select("leader", F.least("x", "blk").alias("i"), F.greatest("x", "blk").alias("j"), "class", "blk", "linked")
    zero, unknown = F.lit(0), F.lit(None).cast("boolean")
    whole = dealt.filter("nb = 1").select("leader", zero.alias("i"), zero.alias("j"), "class", zero.alias("blk"), unknown.alias("linked"))
    work = work.unionByName(whole).join(sets, "class").select("leader", "i", "j", "class", "blk", "linked", "items")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        key = None

        def done() -> list[tuple[int, int]]:
            if len(held) < 2:
                return []
            ids, blocks, linked, items = zip(*held)
            sets, star = [np.frombuffer(s, np.uint64) for s in items], []
            if linked[0] is None:  # a group of one block: its leader is in it
                lead = sets[ids.index(key[0])]
                linked = [_similar(lead, s, percent) for s in sets]
                star = [(key[0], x) for x, near in zip(ids, linked) if near and x != key[0]]
            return star + _links(list(ids), list(blocks), sets, np.array(linked), *key[1:], k, percent)

        for batch in batches:
            out: list[tuple[int, int]] = []
            for leader, i, j, cls, blk, linked, items in zip(*(batch.column(c).to_pylist() for c in range(7))):
                if (leader, i, j) != key:
                    out += done()
                    key, held = (leader, i, j), []
                held.append((cls, blk, linked, items))
            yield pa.RecordBatch.from_arrays([pa.array([x[n] for x in out], pa.int64()) for n in (0, 1)], names=["a", "b"])
        if key is not None:
            out = done()
            yield pa.RecordBatch.from_arrays([pa.array([x[n] for x in out], pa.int64()) for n in (0, 1)], names=["a", "b"])

    pairs = work.repartition("leader", "i", "j").sortWithinPartitions("leader", "i", "j").mapInArrow(compare, "a long, b long")
    return pairs.unionByName(stars.filter("linked").select(F.col("leader").alias("a"), F.col("class").alias("b")))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80, k: int = K) -> DataFrame:
    """Components of documents linked by Jaccard similarity of at least ``percent`` / 100.

    Sets are distinct ``words``-word shingles (words: runs without white
    space, A-Z lowered); a shorter text has one shingle, its whole sequence.
    Documents with the same set are one class before anything else, so exact
    copies cost one sketch.  ``percent`` must be 80 or more.

    Defined results: null, empty and blank texts have an empty set and are
    linked with nothing, each its own component; repeated rows share a
    component and one of them is kept; null ids come after all others; an
    empty table gives no rows; extra columns are ignored.

    Returns row, id, d1, d2, n_shingles, component_id (smallest id of the
    component), kept (one row of each component).
    """
    if percent < 80:
        raise ValueError("percent must be 80 or more")
    rows = materialise(sketches(docs, id_col, text_col, words, k), "sketches")
    full = rows.filter("n > 0")
    classes = materialise(full.groupBy("f1", "f2").agg(F.min("row").alias("class")), "classes")
    links = materialise(near_links(docs, rows, classes, id_col, text_col, words, percent, k), "links")
    parts = materialise(components(links), "components")
    owner = materialise(classes.join(parts, classes["class"] == parts["node"], "left")
                        .select("f1", "f2", F.coalesce("component", "class").alias("component")), "owners")
    slim = full.select("row", "id", "d1", "d2", "n", "f1", "f2")
    placed = materialise(slim.join(owner, ["f1", "f2"]).drop("f1", "f2")
                         .unionByName(rows.filter("n = 0").select("row", "id", "d1", "d2", "n", (-F.col("row") - 1).alias("component"))), "placed")
    first = F.min(F.struct(F.col("id").isNull().alias("u"), "id", "row")).alias("first")
    heads = materialise(placed.groupBy("component").agg(first).select("component", F.col("first.id").alias("component_id"), F.col("first.row").alias("head")), "heads")
    return (placed.join(heads, "component")
            .select("row", "id", "d1", "d2", F.col("n").alias("n_shingles"), "component_id", (F.col("row") == F.col("head")).alias("kept")))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each component of ``near_dedup``; all columns stay.

    Of rows that repeat both id and text, the one with the lowest hash of all
    its columns stays.  Null, empty and repeated rows as in ``near_dedup``.
    """
    kept = near_dedup(docs, id_col, text_col, words, percent).filter("kept").select("d1", "d2")
    d1, d2 = hash128(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")))
    held = docs.select(whole_row(docs).alias("doc"), d1.alias("d1"), d2.alias("d2"), row_hash(docs).alias("tie"))
    w = Window.partitionBy("d1", "d2").orderBy("tie")
    return held.join(kept, ["d1", "d2"], "left_semi").withColumn("nth", F.row_number().over(w)).filter("nth = 1").select("doc.*")
