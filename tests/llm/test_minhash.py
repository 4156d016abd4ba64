import random
import re

import numpy as np
import pytest
from helpers import BASE, DOC, EDGES, edges, empty, groups, near, shingles
from pyspark.sql import functions as F
from wavelens.llm import minhash as mh
from wavelens.llm.components import Forest, components


def corpus(seed=0, families=25, size=8):
    """Chains of small edits, copies, and texts of their own."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    out = []
    for _ in range(families):
        text = [rng.choice(words) for _ in range(rng.randint(8, 60))]
        for _ in range(rng.randint(1, size)):
            out.append(" ".join(text))
            text = list(text)
            for _ in range(rng.choice([0, 1, 1, 2])):
                text[rng.randrange(len(text))] = rng.choice(words)
    rng.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("words", [2, 5])
def test_components_are_those_of_all_pairs(spark, words):
    rows = corpus(words)
    sets = {i: shingles(t, words) for i, t in rows}
    want = groups(sets, near)
    got = {r["doc_id"]: r for r in mh.near_dedup(spark.createDataFrame(rows, DOC), words=words).collect()}
    assert {i: (len(sets[i]), want[i], want[i] == i) for i, _ in rows} == {
        i: (r["n_shingles"], r["component_id"], r["kept"]) for i, r in got.items()}


def test_edges(spark):
    got = mh.near_dedup(edges(spark), words=2).collect()
    assert len(got) == len(EDGES)
    group = [r for r in got if r["doc_id"] in (1, 5, 6, 11)]
    assert {r["component_id"] for r in group} == {1} and sum(r["kept"] for r in group) == 1
    alone = {r["doc_id"]: r for r in got if r["doc_id"] in (2, 3, 4, 7, 8, 9, 10)}
    assert all(r["kept"] and r["component_id"] == i for i, r in alone.items())
    assert [alone[i]["n_shingles"] for i in (2, 3, 4, 7, 10)] == [0, 0, 0, 1, 1]
    twice = mh.near_dedup(spark.createDataFrame([(6, BASE)] * 3 + [(None, BASE)], DOC)).collect()
    assert sum(r["kept"] for r in twice) == 1 and {r["component_id"] for r in twice} == {6}


def test_no_rows(spark):
    assert mh.near_dedup(empty(spark)).count() == 0


def test_words_and_shingles():
    same = mh.shingle_set("A b\tC", 2), mh.shingle_set(" a  B\x0bc\n", 2)
    assert np.array_equal(*same) and len(same[0]) == 2
    assert not np.array_equal(mh.shingle_set("É a", 2), mh.shingle_set("é a", 2))
    assert len(mh.shingle_set("a", 2)) == 1 and len(mh.shingle_set(" \n", 2)) == 0 == len(mh.shingle_set(None, 2))
    assert len(mh.shingle_set("a\xa0b c", 2)) == 1
    long = "x" * 3_000_000 + " tail of words"
    assert len(mh.shingle_set(long, 2)) == 3


def test_families_larger_than_a_block(spark):
    rng = np.random.default_rng(0)
    core = rng.integers(0, 1 << 62, 40)
    sets = [np.unique(np.append(core, rng.integers(0, 1 << 62, 3))) for _ in range(30)]  # one dense group
    far = rng.integers(0, 1 << 62, 40)
    sets += [np.unique(np.append(far, rng.integers(0, 1 << 62, 2))) for _ in range(11)]  # and another, same family
    sets += [np.unique(rng.integers(0, 1 << 62, 30)) for _ in range(9)]
    rows = [(i, 7, s.tolist()) for i, s in enumerate(sets)]
    df = spark.createDataFrame(rows, "row long, family long, shingles array<long>")
    got = {r["node"]: r["component"] for r in components(mh.confirm(df, 80, block=4)).collect()}
    want = groups({i: frozenset(s.tolist()) for i, s in enumerate(sets)}, near)
    assert {i: got.get(i, i) for i in range(len(sets))} == want


def test_long_lists_in_blocks_lose_no_pair(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(-(1 << 31), 1 << 31, 32)
    sigs = []
    for _ in range(40):
        s = base.copy()
        s[rng.choice(32, rng.integers(0, 16), replace=False)] = rng.integers(-(1 << 31), 1 << 31)
        sigs.append(s.tolist())
    vertices = spark.createDataFrame([(i, s) for i, s in enumerate(sigs)], "row long, sig array<int>")
    edges_ = mh.collisions(mh.postings(vertices, 32, 16), vertices, 16, block=6)
    got = {r["node"]: r["component"] for r in components(edges_).collect()}
    up = Forest(40)
    for i in range(40):
        for j in range(i):
            if (np.array(sigs[i]) == np.array(sigs[j])).sum() >= 16:
                up.join(i, j)
    want = {i: up.find(i) for i in range(40)}
    assert all((got.get(i, i) == got.get(j, j)) == (want[i] == want[j]) for i in range(40) for j in range(i))


def test_components_of_random_graphs(spark):
    rng = random.Random(5)
    pairs = [(i, i + 1) for i in range(100, 140)] + [(rng.randrange(90), rng.randrange(90)) for _ in range(60)]
    up = Forest(141)
    for a, b in pairs:
        up.join(a, b)
    for local in (1 << 20, 15):
        found = components(spark.createDataFrame(pairs, "a long, b long").repartition(5), local=local)
        assert {r["node"]: r["component"] for r in found.collect()} == {n: up.find(n) for p in pairs if p[0] != p[1] for n in p}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_a_hot_group_gives_no_pairs(spark):
    rows = [(i, BASE + f" x{i}") for i in range(400)]
    docs = spark.createDataFrame(rows, DOC).withColumn("row", F.col("doc_id"))
    vertices = mh.signatures(docs, 2).select("row", "sig")
    assert mh.collisions(mh.postings(vertices, 32, 16), vertices, 16).count() < 32 * 400


def test_tables_sized_too_low_are_not_broadcast(spark, monkeypatch):
    plans, stored = [], mh.stored

    def planned(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df, name)

    monkeypatch.setattr(mh, "stored", planned)
    monkeypatch.setattr("wavelens.llm.components.stored", planned)
    rows = [(i, " ".join([BASE, f"x{i // 2}", *(f"y{i // 2}z{k}" for k in range(i // 2 % 7 * 20))])) for i in range(60)]
    found = mh.near_dedup(spark.createDataFrame(rows, DOC), 2)
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    assert found.count() == 60
    keys = {k for plan in plans for k in re.findall(r"BroadcastHashJoin \[(\w+)#", plan)}
    assert not keys & {"sig", "key", "row", "root", "set"}, keys


def test_registered_query_against_sql(spark):
    from parity import compare, connect
    from wavelens.llm.registry import QUERIES, SQL

    folder = "/root/testdata/sf0.001"
    assert compare(QUERIES["op10_minhash"](spark, folder), connect(folder), SQL["op10_minhash"]) is None
