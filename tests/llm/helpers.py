"""Small frames with every awkward case, and a plain reading of the contracts."""

import re

SPACE = r"[\x20\x09-\x0D]"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, row int, d1 int, name string, slot int, doc string"
PROSE = " ".join(f"wort{i % 37} and{i % 11} The{i}" for i in range(60))


def frame(spark, texts, ids=None, sources=None):
    ids = list(range(len(texts))) if ids is None else ids
    sources = ["s"] * len(texts) if sources is None else sources
    rows = [(i, t, "en", s, None, "x", 7, 8, "n", 9, "d") for i, t, s in zip(ids, texts, sources)]
    return spark.createDataFrame(rows, SCHEMA)


def awkward():
    """Texts: null, empty, blank, ties, repeated, non-ASCII, very long."""
    long = "\n".join(f"Line {i % 50} of É {i}" for i in range(6_000))
    return [None, "", " \t\n", "a b", "ab", "A B", "Éa\x0bb", "éa b", "a b", PROSE, PROSE + " end", PROSE.upper(), long, long + " ", "x\n\nx", "\n"]


def lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text))


def shingles(text, n):
    w = words(text)
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def components(sets, percent=80):
    """Smallest position reachable for each set, by comparing all pairs."""
    low = list(range(len(sets)))

    def find(x):
        while low[x] != x:
            x = low[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                low[b] = a
    return [find(i) for i in range(len(sets))]
