import re
from collections import defaultdict

import corpus_pipeline as cp
import pytest
from helpers import EDGES, edges, empty, groups, near, shingles
from pyspark.sql import functions as F
from test_pii import spans

SF = "/root/testdata/sf0.001"
STAGE = dict(cp.STAGES)


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage made of the smallest table, the table itself first."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs.collect()]
    for _, stage in cp.STAGES:
        docs = cp.stored(stage(spark, docs, SF), "stage")
        out.append(docs.collect())
    return out


def test_columns_and_order(stages):
    assert [n for n, _ in cp.STAGES] == ["language_id", "exact_dedup", "minhash_near_dedup", "pii", "best_fit_packing"]
    assert all(rows[0].asDict().keys() == stages[0][0].asDict().keys() for rows in stages[:5])


def test_clean_documents_stay(stages):
    assert {r["doc_id"] for r in stages[1]} == {r["doc_id"] for r in stages[0] if re.search(r"[^\W\d_]", r["text"] or "")}


def test_exact_duplicates(stages):
    first = {}
    for r in sorted(stages[1], key=lambda r: r["doc_id"]):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r["text"]), r["doc_id"])
    assert sorted(r["doc_id"] for r in stages[2]) == sorted(first.values())


def test_near_duplicates(stages):
    part = groups({r["doc_id"]: shingles(r["text"], 5) for r in stages[2]}, near)
    assert {r["doc_id"] for r in stages[3]} == set(part.values())


def test_personal_data(stages):
    before = {r["doc_id"]: r for r in stages[3]}
    assert len(before) == len(stages[4])
    for r in stages[4]:
        assert spans(r["text"]) == []
        if not spans(before[r["doc_id"]]["text"]):
            assert r == before[r["doc_id"]]


def test_packing(stages):
    held = defaultdict(list)
    for r in stages[5]:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    assert {r["doc_id"] for r in stages[5]} == {r["doc_id"] for r in stages[4]}
    for places in held.values():
        ends = [0, *(o + n for o, n in sorted(places))]
        assert [o for o, _ in sorted(places)] == ends[:-1] and ends[-1] <= 2048


def test_edges_with_clashing_columns(spark):
    df = edges(spark).withColumns({c: F.lit("x") for c in ("lang", "key", "row", "spans", "c0", "kept", "score", "lang_pred")}).drop("ROW")
    df = df.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "en").otherwise("fr"))
    for name, stage in cp.STAGES[:4]:
        out = stage(spark, df, SF)
        assert out.columns == df.columns, name
        rows = out.collect()
        if name == "exact_dedup":
            texts = {re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in EDGES}
            assert len(rows) == len(texts) == len({re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or "") for r in rows})
        elif name == "minhash_near_dedup":
            assert sum(r["doc_id"] in (1, 5, 6, 11) for r in rows) == 1 and len(rows) == len(EDGES) - 4
        elif name == "pii":
            assert len(rows) == len(EDGES)


def test_no_rows(spark):
    df = empty(spark).withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.lit(1)})
    for _, stage in cp.STAGES:
        assert stage(spark, df, SF).count() == 0


def test_texts_stay_where_no_language_can_be_learned(spark):
    rows = [(1, "some words", None, "a", 10), (2, "12 34", None, "a", 5), (3, None, None, "b", None), (4, "слово", None, "b", 5), (4, "слово", None, "b", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = STAGE["language_id"](spark, docs, SF)
    assert got.columns == docs.columns and sorted(r["doc_id"] for r in got.collect()) == [1, 4, 4]


def test_characters_are_counted_anew_after_masking(spark):
    rows = [(1, "mail me@x.yz now", "en", "a", 16), (2, "clean", "en", "a", 5), (3, None, "en", "a", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: r for r in STAGE["pii"](spark, docs, SF).collect()}
    assert got[1]["text"] == "mail [EMAIL] now" and got[1]["n_chars"] == 16 and got[2]["n_chars"] == 5 and got[3]["n_chars"] == 0
    assert all(r["n_chars"] == len(r["text"] or "") for r in got.values())
