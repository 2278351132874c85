"""Document quality by a linear-chain conditional random field over lines."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.words import mix, text_runs, word_hashes, word_spans

SAMPLE = 6000  # labelled documents fitted on, at most
SAMPLE_LINES = 384_000  # lines of all of them together, at most
_PLAIN = b".,;:'\"()?-"
_LINES = 1 << 15  # lines whose features are made at once
_BYTES = 1 << 20  # and bytes of them, unless one line has more


def _counts(mask: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


@dataclass
class _Behind:
    """What the lines that follow need of the text before them: its last two words, and the words of its last line."""

    words: np.ndarray
    content: np.uint64


def _own_features(data: np.ndarray, offsets: np.ndarray, behind: _Behind | None = None):
    """Features of all lines in a row that need no line around them.

    Returns those that only count for the line itself, those that its
    neighbours see too, the weights (bytes + 1), each document's first line,
    and what a further piece of the last document needs.  ``behind`` is that
    of the piece of the first document before.
    """
    breaks = np.flatnonzero(data == 10)
    docs = len(offsets) - 1
    starts = np.concatenate([offsets[:-1], breaks + 1])
    owner = np.concatenate([np.arange(docs), np.searchsorted(offsets, breaks, "right") - 1])
    order = np.lexsort((starts, owner))
    starts, owner = starts[order], owner[order]
    last = np.append(owner[1:] != owner[:-1], True)
    ends = np.where(last, offsets[owner + 1], np.append(starts[1:], 0) - 1)
    first = np.searchsorted(owner, np.arange(docs + 1))
    bounds = np.append(starts, len(data))  # a line and its line end

    ws, we, _ = word_spans(data, offsets)
    hashes = word_hashes(data, ws, we)
    word_doc = np.searchsorted(offsets, ws, "right") - 1
    word_line = np.searchsorted(starts, ws, "right") - 1
    earlier = behind.words if behind else np.empty(0, np.uint64)
    row, row_doc = np.concatenate([earlier, hashes]), np.concatenate([np.zeros(len(earlier), np.int64), word_doc])
    again = np.zeros((2, len(row)), bool)
    for d in (1, 2):
        if len(row) > d:
            again[d - 1, d:] = (row[d:] == row[:-d]) & (row_doc[d:] == row_doc[:-d])
    again = again[:, len(earlier):]
    n = len(starts)
    words = np.bincount(word_line, minlength=n)
    rep1 = np.bincount(word_line, again[0], n)
    rep2 = np.bincount(word_line, again[1], n)
    with np.errstate(over="ignore"):
        running = np.append(np.uint64(0), np.cumsum(mix(hashes)))
    cut = np.searchsorted(word_line, np.arange(n + 1))
    content = running[cut[1:]] - running[cut[:-1]]

    upper = _counts((data >= 65) & (data <= 90), bounds)
    lower = _counts((data >= 97) & (data <= 122), bounds)
    digit = _counts((data >= 48) & (data <= 57), bounds)
    odd = np.zeros(256, bool)
    odd[33:127] = True
    for c in (*range(48, 58), *range(65, 91), *range(97, 123), *_PLAIN):
        odd[c] = False
    symbol = _counts(odd[data], bounds)
    pipe, bang = _counts(data == 124, bounds), _counts(data == 33, bounds)
    size = ends - starts
    same = np.zeros(n)
    same[1:] = (content[1:] == content[:-1]) & (owner[1:] == owner[:-1]) & (words[1:] > 0)
    if behind:
        same[0] = content[0] == behind.content and words[0] > 0
    own = np.stack([
        upper / (upper + lower + 1), symbol / (size + 1), pipe / (words + 1), bang / (words + 1), digit / (size + 1),
        rep1 / (words + 1), rep2 / (words + 1), same, (words == 0).astype(float), (words <= 3).astype(float),
    ], 1)
    alone = np.stack([np.ones(n), np.log1p(size) / 5, np.minimum(size / (words + 1), 40) / 10], 1)
    return alone, own, size + 1.0, first, _Behind(row[row_doc == docs - 1][-2:], content[-1])


def line_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines in a row, their weights (bytes + 1), and each document's first line.

    A line's features are its own, and those of the lines before and behind
    it in its document.
    """
    alone, own, weight, first, _ = _own_features(data, offsets)
    before, behind = np.zeros_like(own), np.zeros_like(own)
    before[1:], behind[:-1] = own[:-1], own[1:]
    before[first[:-1]] = 0
    behind[first[1:] - 1] = 0
    return np.concatenate([alone, own, before, behind], 1), weight, first


def _groups(data: np.ndarray, offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """(first document, end) of documents in a row with at most ``most`` lines together, or one with more."""
    breaks = np.flatnonzero(data == 10)
    lines = np.searchsorted(breaks, offsets) + np.arange(len(offsets))  # of all documents before
    at = 0
    while at < len(offsets) - 1:
        end = max(at + 1, int(np.searchsorted(lines, lines[at] + most, "right")) - 1)
        yield at, end
        at = end


WIDTH = 3 + 3 * 10


@dataclass
class QualityModel:
    """Weights of the line features for "good" against "bad", and the transition scores [before, this]."""

    weights: np.ndarray
    moves: np.ndarray
    mean: np.ndarray
    scale: np.ndarray


def _grouped(first: np.ndarray) -> list[np.ndarray]:
    """Documents in groups of like numbers of lines."""
    n = np.diff(first)
    kind = np.ceil(np.log2(np.maximum(n, 1))).astype(int)
    return [np.flatnonzero((kind == k) & (n > 0)) for k in np.unique(kind[n > 0])]


def _chain(score: np.ndarray, there: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over padded chains: log marginal odds of "good" and expected transitions.

    ``score``: [document, line] of "good" (bad is 0); ``there``: which lines exist.
    """
    docs, t = score.shape
    a = np.zeros((t, docs, 2))
    b = np.zeros((t, docs, 2))
    a[0, :, 1] = score[:, 0]
    for i in range(1, t):
        step = np.logaddexp(a[i - 1][:, [0]] + moves[0], a[i - 1][:, [1]] + moves[1])
        step[:, 1] += score[:, i]
        a[i] = np.where(there[:, [i]], step, a[i - 1])
    for i in range(t - 2, -1, -1):
        ahead = b[i + 1] + np.stack([np.zeros(docs), score[:, i + 1]], 1)
        step = np.logaddexp(moves[:, 0] + ahead[:, [0]], moves[:, 1] + ahead[:, [1]])
        b[i] = np.where(there[:, [i + 1]], step, 0)
    odds = (a + b)[..., 1] - (a + b)[..., 0]
    pairs = np.zeros((2, 2))
    if t > 1:
        ahead = b[1:] + np.stack([np.zeros((t - 1, docs)), score[:, 1:].T], 2)
        joint = a[:-1, :, :, None] + moves + ahead[:, :, None, :]
        joint -= joint.max((2, 3), keepdims=True)
        p = np.exp(joint)
        pairs = ((p / p.sum((2, 3), keepdims=True)) * there[:, 1:].T[:, :, None, None]).sum((0, 1))
    return odds.T, pairs


def _marginals(model: QualityModel, x: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of "good" of every line; expected transitions."""
    score = ((x - model.mean) / model.scale) @ model.weights
    good, pairs = np.empty(len(x)), np.zeros((2, 2))
    n = np.diff(first)
    for docs in _grouped(first):
        t = int(n[docs].max())
        there = np.arange(t) < n[docs][:, None]
        at = np.where(there, first[docs][:, None] + np.arange(t), 0)
        odds, p = _chain(np.where(there, score[at], 0), there, model.moves)
        good[at[there]] = 1 / (1 + np.exp(-np.clip(odds[there], -500, 500)))
        pairs += p
    return good, pairs


def _pieces(data: np.ndarray, lines: int, size: int) -> Iterator[np.ndarray]:
    """A text in pieces of whole lines, at most ``lines`` and ``size`` bytes, or one line; the line end between two pieces is in neither."""
    ends = np.append(np.flatnonzero(data == 10), len(data))
    at = start = 0
    while at < len(ends):
        end = min(at + lines, max(at + 1, int(np.searchsorted(ends, start + size, "right"))), len(ends))
        yield data[start:ends[end - 1]]
        at, start = end, int(ends[end - 1]) + 1


def _line_scores(model: QualityModel, data: np.ndarray, lines: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Score of "good" and weight of each line of one text, whose features are made piece by piece."""
    weights = model.weights / model.scale
    const = -float(model.mean @ weights)
    parts = np.split(weights, [3, 3 + 10, 3 + 20])  # of the line alone, its own, and those before and behind it
    scores, sizes, state, edge = [], [], None, None
    for piece in _pieces(data, lines, size):
        alone, own, weight, _, state = _own_features(piece, np.array([0, len(piece)]), state)
        score = alone @ parts[0] + own @ parts[1] + const
        score[1:] += own[:-1] @ parts[2]
        score[:-1] += own[1:] @ parts[3]
        if edge is not None:
            score[0] += edge @ parts[2]
            scores[-1][-1] += own[0] @ parts[3]
        edge = own[-1].copy()
        scores.append(score)
        sizes.append(weight)
    return np.concatenate(scores), np.concatenate(sizes)


def _ahead(odds: float, a: float, b: float, c: float, d: float) -> float:
    """log((a + b e^odds) / (c + d e^odds))"""
    if odds > 0:
        r = math.exp(-odds)
        return math.log((a * r + b) / (c * r + d))
    r = math.exp(odds)
    return math.log((a + b * r) / (c + d * r))


def _long_chain(score: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Log marginal odds of "good" along one chain, as ``_chain`` has them; messages are log odds, one number a line."""
    (bb, bg), (gb, gg) = np.exp(moves).tolist()
    odds = np.empty(len(score))
    message = 0.0
    for i in range(len(score)):  # what the lines before say
        odds[i] = message + score[i]
        message = _ahead(odds[i], bg, gg, bb, gb)
    message = 0.0
    for i in range(len(score) - 1, -1, -1):  # what the lines behind say
        odds[i] += message
        message = _ahead(message + score[i], gb, gg, bb, bg)
    return odds


def document_scores(model: QualityModel, data: np.ndarray, offsets: np.ndarray, lines: int = _LINES, size: int = _BYTES) -> np.ndarray:
    """Mean marginal of "good" over each document's lines, weighted by their lengths.

    Documents are taken together while they have at most ``lines`` lines.
    One with more is taken in pieces of as many lines or ``size`` bytes, each
    with what it needs of its neighbours, and its messages are numbers: some
    50 bytes a line stay in memory.
    """
    found = []
    for lo, hi in _groups(data, offsets, lines):
        part, ends = data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        if hi == lo + 1 and np.count_nonzero(part == 10) >= lines:
            score, weight = _line_scores(model, part, lines, size)
            good = 1 / (1 + np.exp(-np.clip(_long_chain(score, model.moves), -500, 500)))
            found.append([(good @ weight) / weight.sum()])
        else:
            x, weight, first = line_features(part, ends)
            good, _ = _marginals(model, x, first)
            found.append(np.add.reduceat(good * weight, first[:-1]) / np.add.reduceat(weight, first[:-1]))
    return np.concatenate(found) if found else np.empty(0)


def _fit(x: np.ndarray, weight: np.ndarray, first: np.ndarray, labels: np.ndarray, rounds: int = 3, steps: int = 60) -> QualityModel:
    """Likelihood of line labels, by Adam; lines begin with their document's label.

    After each round the lines that look good inside bad documents are
    relabelled, as long as most of the document's length stays bad.
    """
    model = QualityModel(np.zeros(WIDTH), np.zeros((2, 2)), np.zeros(WIDTH), np.ones(WIDTH))
    if len(labels) == 0:
        return model
    model.mean[1:], model.scale[1:] = x[:, 1:].mean(0), x[:, 1:].std(0) + 1e-3
    z = (x - model.mean) / model.scale
    owner = np.repeat(np.arange(len(labels)), np.diff(first))
    y = labels[owner].astype(float)
    chained = owner[1:] == owner[:-1]
    moment = [np.zeros(WIDTH + 4), np.zeros(WIDTH + 4)]
    step = 0
    for _ in range(rounds):
        i, j = y[:-1][chained].astype(int), y[1:][chained].astype(int)
        seen = np.bincount(2 * i + j, minlength=4).reshape(2, 2)
        for _ in range(steps):
            good, pairs = _marginals(model, x, first)
            slope = np.concatenate([(y - good) @ z, (seen - pairs).ravel()]) / len(x)
            slope -= 1e-4 * np.concatenate([model.weights, model.moves.ravel()])
            step += 1
            moment[0] = 0.9 * moment[0] + 0.1 * slope
            moment[1] = 0.99 * moment[1] + 0.01 * slope ** 2
            change = 0.1 * (moment[0] / (1 - 0.9 ** step)) / (np.sqrt(moment[1] / (1 - 0.99 ** step)) + 1e-8)
            model.weights += change[:WIDTH]
            model.moves += change[WIDTH:].reshape(2, 2)
        good, _ = _marginals(model, x, first)
        better = (labels[owner] == 0) & (good > 0.5)
        freed = np.bincount(owner, weight * better, len(labels)) < 0.5 * np.bincount(owner, weight, len(labels))
        y = np.where(better & freed[owner], 1.0, labels[owner])
    return model


def held_out(doc_id: Column) -> Column:
    """Rows that are never fitted on: crc32 of the id as text, modulo 3, is 1 (false for a null id)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, lines: int = SAMPLE_LINES) -> QualityModel:
    """A model from at most ``sample`` labelled documents that are not held out.

    They are chosen by a hash of their id and fitted on as a whole.  Their
    lines are ``lines`` at most in all, which keeps what reaches the driver
    small: documents that would go beyond it, and such of more than a
    hundredth of it alone, are left out.  Of labels that repeat for an id the
    lowest counts, null labels don't.  Without any label every score is 0.5.
    """
    asked = (labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.min("quality").alias("quality"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    text = F.coalesce(F.col("text"), F.lit(""))
    given = docs.select(F.col("doc_id").alias("key"), text.alias("text"), F.xxhash64("doc_id", text).alias("h"),
                        (F.char_length(text) - F.char_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).alias("n"))
    given = given.join(F.broadcast(asked), F.col("key") == F.col("doc_id"))
    sizes = given.filter(F.col("n") <= max(1, lines // 100)).select("h", "n").orderBy("h").limit(sample).collect()
    kept, total = [], 0
    for r in sizes:
        if total + r.n <= lines:
            kept.append((r.h,))
            total += r.n
    kept = docs.sparkSession.createDataFrame(kept, "h long").distinct()
    chosen = given.join(F.broadcast(kept), "h", "left_semi").select("quality", "text")

    def features(batches):
        for batch in batches:
            for lo, hi, data, offsets in text_runs(batch.column("text")):
                rows = []
                for a, b in _groups(data, offsets, _LINES):
                    x, weight, first = line_features(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                    both = np.concatenate([x, weight[:, None]], 1).astype("<f4")
                    rows += [both[f:l].tobytes() for f, l in zip(first[:-1], first[1:])]
                yield pa.RecordBatch.from_arrays([batch.column("quality").slice(lo, hi - lo).cast(pa.int32()), pa.array(rows, pa.binary())], names=["quality", "x"])

    found = sorted(((r.quality, bytes(r.x)) for r in chosen.mapInArrow(features, "quality int, x binary").collect()), key=lambda r: r[1])
    if not found:
        return _fit(np.empty((0, WIDTH)), np.empty(0), np.zeros(1, int), np.empty(0))
    parts = [np.frombuffer(x, "<f4").reshape(-1, WIDTH + 1).astype(float) for _, x in found]
    first = np.cumsum([0, *map(len, parts)])
    both = np.concatenate(parts)
    return _fit(both[:, :WIDTH], both[:, WIDTH], first, np.array([q for q, _ in found]))


def quality_score(text: Column, model: QualityModel) -> Column:
    """Score from 0 to 1 of a whole text under a fitted model.

    Null and empty texts are one empty line and get that line's score.
    """

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
        found = [document_scores(model, data, offsets) for _, _, data, offsets in text_runs(texts)]
        return pa.array(np.concatenate(found) if found else np.empty(0))

    return score(text)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from 0.5) of every document.

    Only ``doc_id``, ``text`` and the labels' ``quality`` are read; ids take
    no part in a score, so repeated texts have equal scores.  An empty table
    gives no rows.
    """
    model = fit_quality(docs, labels)
    scored = docs.select(F.col("doc_id"), held_out(F.col("doc_id")).alias("held_out"), quality_score(F.col("text"), model).alias("score"))
    return scored.select("doc_id", "held_out", "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose predicted label is 1; all columns stay."""
    model = fit_quality(docs, labels)
    return docs.filter(quality_score(docs["text"], model) >= 0.5)
