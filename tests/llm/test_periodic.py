import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from helpers import BASE, DOC, EDGES, edges, empty
from hypothesis import given, settings
from hypothesis import strategies as st
from wavelens.llm import periodic
from wavelens.llm.registry import op13_periodic_runs

SF = "/root/testdata/sf0.001"
SPACES = "[\x20\x09-\x0d]+"


def brute(words, least=24, periods=3):
    """All runs, by comparing the words at every distance; a stretch takes its smallest period."""
    found = {}
    for q in range(1, len(words) // periods + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            if length >= max(least, periods * q):
                found.setdefault((start, length), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def row(doc_id, text, alter):
    words = [w for w in re.split(SPACES, text or "") if w]
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if alter and doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        original = list(words)
        for i in range(a, n):
            words[i] = original[a + (i - a) % p]
    found = brute(words)
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    return (
        doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
        digest("".join(f"{s},{n},{q}\n" for s, n, q in found)), digest(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def same(df, expected):
    assert sorted(map(tuple, df.collect()), key=repr) == sorted(expected, key=repr)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=12), st.integers(1, 12), st.lists(st.integers(0, 2), max_size=30), st.integers(0, 40))
def test_runs_of_few_words(unit, times, tail, cut):
    words = (tail[::-1] + unit * times + tail + unit * 4)[cut // 4:]
    for least, periods in ((24, 3), (6, 3), (9, 4)):
        assert periodic.runs(np.array(words, np.int64), least, periods) == brute(words, least, periods)


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_long_texts(seed):
    draw = random.Random(seed)
    words = []
    while len(words) < 1500:
        unit = [draw.randrange(draw.choice([2, 40])) for _ in range(draw.randrange(1, 60))]
        words += (unit * draw.randrange(1, 9))[: draw.randrange(10, 400)]
    assert periodic.runs(np.array(words)) == brute(words)


def test_one_word_many_times():
    assert periodic.runs(np.zeros(20_000, np.int64)) == [(0, 20_000, 1)]


def test_repeats_let_nothing_go():
    draw = random.Random(1)
    texts = [[draw.randrange(50) for _ in range(draw.randrange(80))] for _ in range(40)]
    for t in texts[::2]:
        t += t[: draw.randrange(len(t) + 1)]
    starts = np.cumsum([0, *map(len, texts)])
    got = periodic.repeats(np.array(sum(texts, [])), starts, 16)
    for t, maybe in zip(texts, got, strict=True):
        grams = [tuple(t[i : i + 16]) for i in range(len(t) - 15)]
        assert maybe == (len(set(grams)) < len(grams))


def test_query_over_the_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = op13_periodic_runs(spark, SF)
    same(got, [row(r["doc_id"], r["text"], True) for r in docs])
    assert got.filter("n_runs > 0").count() > 5


@pytest.mark.parametrize("alter", [False, True])
def test_edges(spark, alter):
    same(periodic.report(edges(spark), alter), [row(d, t if d != 9 else "lorem ipsum dolor " * 20_000, alter) for d, t in EDGES if d != 9] + [row_of_nine(alter)])


def row_of_nine(alter):
    """The long text by hand: 60,000 words of period 3, altered or not."""
    assert zlib.crc32(b"9") % 10  # so it is left as it is
    empty_line = hashlib.sha256(b"0,60000,3\n").hexdigest()
    return 9, 1, 0, 60_000, 3, 20_000_000, empty_line, hashlib.sha256(b"lorem ipsum dolor").hexdigest()


def test_collapse_keeps_rows_and_columns(spark):
    docs = edges(spark)
    got = periodic.collapse(docs)
    assert got.columns == docs.columns and got.count() == len(EDGES)
    texts = {r["doc_id"]: r["text"] for r in got.collect() if r["doc_id"]}
    assert texts[9] == "lorem ipsum dolor" and texts[5] == BASE.replace(" ", "  ") and texts[2] is None


def test_no_rows(spark):
    assert periodic.report(empty(spark), True).count() == 0
    assert periodic.collapse(empty(spark)).count() == 0


def test_ties_and_neighbouring_runs(spark):
    rows = [(1, " ".join(["a b"] * 12 + ["c d"] * 12)), (2, " ".join(["x"] * 24 + ["y"] + ["x"] * 24)), (3, "a " * 23)]
    same(periodic.report(spark.createDataFrame(rows, DOC)), [row(d, t, False) for d, t in rows])


def test_registered_query_against_sql(spark):
    from parity import compare, connect
    from wavelens.llm.registry import QUERIES, SQL

    folder = "/root/testdata/sf0.001"
    assert compare(QUERIES["op13_periodic_runs"](spark, folder), connect(folder), SQL["op13_periodic_runs"]) is None
