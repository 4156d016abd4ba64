"""Frames and plain Python versions shared by these tests."""

import re
from collections import defaultdict

DOC = "doc_id long, text string"
BASE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"
EDGES = [
    (1, BASE), (2, None), (3, ""), (4, " \t\n "), (None, "no identifier here"), (None, None),
    (5, BASE.replace(" ", "  ")), (6, BASE), (6, BASE), (7, "one"), (8, "um café \U0001f642 ok"), (9, "lorem ipsum dolor " * 20_000),
    (10, "1" * 30_000), (11, BASE + " phi"),
]


def edges(spark):
    """Nulls, empty, blank and very long texts, ties, repeated rows and a clashing column."""
    rows = [(*r, "x", 1) for r in EDGES]
    return spark.createDataFrame(rows, DOC + ", source string, ROW int").repartition(3)


def empty(spark):
    return spark.createDataFrame([], DOC)


def shingles(text, words):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(found) < words:
        return frozenset([tuple(found)]) if found else frozenset()
    return frozenset(tuple(found[i : i + words]) for i in range(len(found) - words + 1))


def groups(sets, linked):
    """Component (smallest key) of every key, comparing all pairs."""
    up = {k: k for k in sets}

    def find(k):
        while up[k] != k:
            k = up[k]
        return k

    keys = sorted(sets)
    by_item = defaultdict(set)
    for k in keys:
        for item in sets[k]:
            by_item[item].add(k)
    for k in keys:
        for other in sorted(set().union(*[by_item[i] for i in sets[k]])) if sets[k] else []:
            if other < k and linked(sets[k], sets[other]):
                a, b = find(k), find(other)
                up[max(a, b)] = min(a, b)
    return {k: find(k) for k in keys}


def near(a, b):
    common = len(a & b)
    return 100 * common >= 80 * (len(a) + len(b) - common)
