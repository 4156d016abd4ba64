import numpy as np
from helpers import groups
from wavelens.llm import embed_dedup as em

SF = "/root/testdata/sf0.001"
VEC = "vec_id long, embedding array<float>, Row int"


def truth(rows):
    """Links and components by all pairs; ``rows`` maps a key to a vector or None."""
    unit = {}
    for key, v in rows.items():
        if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v, float)
            unit[key] = x / np.linalg.norm(x)
    near = {k: {o for o in unit if o != k and len(unit[o]) == len(unit[k]) and unit[o] @ unit[k] >= 0.95} for k in unit}
    sets = {k: {(min(k, o), max(k, o)) for o in near.get(k, ())} for k in rows}
    return {k: len(near.get(k, ())) for k in rows}, groups(sets, lambda a, b: bool(a & b))


def check(rows, got, recall=1.0):
    links, parts = truth(rows)
    assert len(got) == len(rows)
    found = sum(r["n_links"] for r in got)
    assert all(r["n_links"] <= links[r["vec_id"]] for r in got) and found >= recall * sum(links.values())
    if found == sum(links.values()):
        assert all(r["component_id"] == parts[r["vec_id"]] for r in got)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_whole_table(spark):
    from wavelens.llm.registry import op7_embed_dedup

    rows = {r["vec_id"]: r["embedding"] for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    check(rows, op7_embed_dedup(spark, SF).collect(), 0.99)


def test_edges(spark):
    v = [0.5, -1.0, 2.0, 0.25]
    rows = {
        1: v, 2: v, 3: [x * 3 for x in v], 4: None, 5: [0.0] * 4, 6: [None, 1.0, 1.0, 1.0], 7: [float("nan"), 1, 1, 1],
        8: [float("inf"), 1, 1, 1], 9: [], 10: [0.5, -1.0, 2.0], 11: [0.51, -1.0, 2.0], 12: [-x for x in v], 13: [1e30, 0, 0, 0], 14: [1e-30, 0, 0, 0],
    }
    df = spark.createDataFrame([(k, x if x is None else [None if y is None else float(y) for y in x], 0) for k, x in rows.items()], VEC)
    got = em.near_dedup(df).collect()
    check(rows, got)
    assert {r["vec_id"]: r["n_links"] for r in got}[1] == 2


def test_rows_that_repeat_and_null_identifiers(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], 0), (1, [1.0, 2.0], 0), (None, [1.0, 2.1], 0), (None, None, 0)], VEC)
    got = sorted(((r["vec_id"] or 0, r["n_links"], r["component_id"], r["kept"]) for r in em.near_dedup(df).collect()), key=repr)
    assert got == sorted([(1, 2, 1, True), (1, 2, 1, False), (0, 2, 1, False), (0, 0, None, True)], key=repr)


def test_a_dense_group_in_small_blocks(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=16)
    rows = {i: (base + 0.05 * rng.normal(size=16)).astype(np.float32).tolist() for i in range(60)}
    rows |= {i: rng.normal(size=16).astype(np.float32).tolist() for i in range(60, 80)}
    df = spark.createDataFrame([(k, x, 0) for k, x in rows.items()], VEC)
    check(rows, em.near_dedup(df, block=16).collect(), 0.99)


def test_no_rows(spark):
    assert em.near_dedup(spark.createDataFrame([], VEC)).count() == 0


def test_hadamard_keeps_lengths_and_is_its_own_inverse():
    x = np.random.default_rng(1).normal(size=(5, 8))
    assert np.allclose(em.hadamard(em.hadamard(x)) / 8, x)
    own, more = em.hash_vectors(x, 3, 2, 3)
    assert all(own[i, t] not in more[i, t] and len(set(more[i, t])) == 3 for i in range(5) for t in range(3))


def test_registered_query_against_sql(spark):
    from parity import compare, connect
    from wavelens.llm.registry import QUERIES, SQL

    folder = "/root/testdata/sf0.001"
    assert compare(QUERIES["op7_embed_dedup"](spark, folder), connect(folder), SQL["op7_embed_dedup"]) is None
