import math
import re
from collections import Counter

import pytest
from helpers import BASE, DOC, EDGES, edges, empty
from parity import compare, connect
from wavelens.llm import lexical_search as ls
from wavelens.llm.registry import SQL, op11_lexical_search

SF = "/root/testdata/sf0.001"
ITEM = "item_id long, text string"


def terms(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def brute(docs, items, k=50):
    found = [(d, Counter(terms(t))) for d, t in docs if terms(t)]
    total, length = len(found), sum(sum(c.values()) for _, c in found)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    out = []
    for item, words in wanted.items():
        scores = []
        for doc, tf in found:
            m = 100 - 50 + (50 * sum(tf.values()) * total) // length
            score = 0
            for w in words & tf.keys():
                df = sum(w in c for _, c in found)
                score += math.floor(1000 * math.log((2 * total + 2) / (2 * df + 1))) * ((10**9 * tf[w]) // (1000 * tf[w] + 20 * m))
            if score > 0:
                scores.append((-score, doc is None, doc))
        for rank, (score, _, doc) in enumerate(sorted(scores, key=lambda s: (s[0], s[1], s[2] or 0))[:k], 1):
            out.append((item, rank, doc, -score))
    return sorted(out, key=repr)


def same(df, expected):
    assert sorted(map(tuple, df.collect()), key=repr) == expected


def test_query_against_sql(spark):
    assert compare(op11_lexical_search(spark, SF), connect(SF), SQL["op11_lexical_search"]) is None


ITEMS = [(1, "Alpha beta, café!"), (2, None), (3, ""), (None, "gamma"), (4, "lorem one"), (4, "\U0001f642 one"), (5, "nowhere"), (6, BASE + " alpha")]


@pytest.mark.parametrize("k", [1, 3, 50])
def test_edges(spark, k):
    items = spark.createDataFrame([(*r, 0) for r in ITEMS], ITEM + ", TERM int")
    same(ls.search(edges(spark), items, k), brute(EDGES, ITEMS, k))


def test_blocks_of_items_change_nothing(spark):
    items = spark.createDataFrame(ITEMS, ITEM)
    for limits in ({"block_items": 2}, {"block_terms": 5}):
        same(ls.search(edges(spark), items, 5, **limits), brute(EDGES, ITEMS, 5))


def test_chunks_and_ties(spark, monkeypatch):
    docs = [(i, "tie tie " + "pad " * (i % 3) + f"only{i}") for i in range(200)]
    items = [(1, "tie"), (2, "pad only7"), (3, "tie pad")]
    got = ls.search(spark.createDataFrame(docs, DOC).repartition(7), spark.createDataFrame(items, ITEM), 9)
    same(got, brute(docs, items, 9))


def test_terms_inside_others_are_not_counted(spark):
    docs = [(1, "catalog cat-cat scat cats"), (2, "CAT\ncat"), (3, "concat")]
    got = ls.counts(spark.createDataFrame(docs, DOC), ["cat"]).collect()
    assert {r["doc_id"]: (r["n"], list(r["tf"])) for r in got} == {1: (5, [2]), 2: (2, [2]), 3: (1, [])}


def test_best_holds_the_first_of_equal_scores():
    import numpy as np

    best = ls.Best(2)
    for docs in ([9, 3], [5, 1]):
        best.add(np.zeros(2, np.int64), np.full(2, 7), np.zeros(2, np.int64), np.array(docs))
    assert best.rows[3].tolist() == [1, 3] and best.least(2).tolist() == [7, 1]


def test_no_rows(spark):
    items = spark.createDataFrame(ITEMS, ITEM)
    none = spark.createDataFrame([], ITEM)
    assert ls.search(empty(spark), items).count() == 0
    assert ls.search(edges(spark), none).count() == 0
    assert ls.search(edges(spark), items).columns == ["item_id", "rank", "doc_id", "score"]
