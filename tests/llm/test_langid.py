import itertools
import zlib

import numpy as np
from helpers import EDGES, edges, empty
from pyspark.sql import functions as F
from wavelens.llm import langid as li

SF = "/root/testdata/sf0.01"


def test_forward_backward_against_all_paths():
    rng = np.random.default_rng(0)
    lengths = np.array([3, 1, 4])
    scores, moves = rng.normal(size=(8, 3)), rng.normal(size=(3, 3))
    got, at = li.forward_backward(scores, lengths, moves), 0
    for n in lengths:
        total = np.zeros((n, 3))
        for path in itertools.product(range(3), repeat=int(n)):
            w = np.exp(sum(scores[at + i, k] for i, k in enumerate(path)) + sum(moves[a, b] for a, b in zip(path, path[1:], strict=False)))
            for i, k in enumerate(path):
                total[i, k] += w
        assert np.allclose(got[at : at + n], total / total.sum(1, keepdims=True))
        at += n


def test_features_are_the_ngrams_with_borders():
    ids, starts = li.features(["ab", "b"])
    assert len(ids) == (4 + 3 + 2 + 1 + 1) + (3 + 2 + 1 + 1) and starts.tolist() == [0, 11]
    again, _ = li.features(["b", "ab"])
    assert sorted(ids[:11]) == sorted(again[7:]) and (ids < li.FEATURES).all()


def test_code_switched_lines_are_told_apart():
    en, fr = "the cat and the house was with", "le chat et une maison avec des"
    runs = [(lang, [w for w in np.random.default_rng(i).choice(t.split(), 12)]) for i in range(60) for lang, t in (("en", en), ("fr", fr))]
    model = li.fit(runs)
    words, post, _ = li.posteriors(model, ["the cat was with the house une maison avec le chat 12 !"])
    assert [model.languages[i] for i in post.argmax(1)] == ["en"] * 6 + ["fr"] * 5 and len(words) == 11
    assert model.transitions.diagonal().min() > model.transitions[0, 1]


def test_held_out_accuracy_and_contract(spark):
    from wavelens.llm.registry import op6_langid

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = op6_langid(spark, SF).join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == r["lang"] for r in held]) >= 0.97


def test_edges_and_clashing_names(spark):
    model = li.fit([("en", ["lorem", "ipsum", "one"]), ("fr", ["café", "um", "alpha"])] * 10)
    df = edges(spark).withColumn("lang", F.lit("zz"))
    got = {(r["doc_id"], r["text"]): (r["lang_pred"], r["score"]) for r in li.predict(df, model, ["doc_id", "text", "lang"]).collect()}
    assert set(got) == set(EDGES)
    for (_, text), (lang, score) in got.items():
        assert (lang == "und") == (not any(c.isalpha() for c in text or "")) and (score > 0) == (lang != "und")
    labels = {r["key"]: r for r in li.word_labels(df.select(F.col("doc_id").alias("key"), "text").filter("key = 8"), model).collect()}
    assert labels[8]["words"] == ["um", "café", "ok"] and len(labels[8]["langs"]) == 3


def test_nothing_to_learn_from(spark):
    docs = empty(spark).withColumn("lang", F.lit(None).cast("string"))
    model = li.trained(docs)
    assert model.languages == [] and li.predict(docs, model, ["doc_id"]).count() == 0
    assert {r["lang_pred"] for r in li.predict(edges(spark), model, ["doc_id"]).collect()} == {"und"}


def test_the_sample_is_bounded_and_whole_otherwise(spark):
    docs = spark.range(3000).select(F.col("id").alias("key"), F.lit("a b c").alias("text"), F.lit("en").alias("lang"))
    assert 40 <= len(li.training_runs(docs, documents=50)) <= 50
    assert len(li.training_runs(docs.limit(30), documents=50)) == 30


def log_likelihood(model, chunk):
    """Sum over all paths, by plain dynamic programming."""
    total = 0.0
    for words, tags in chunk:
        scores = li._scores(model, words)[0]
        move = model.transitions.astype(np.float64)
        total += scores[np.arange(len(words)), tags].sum() + sum(move[a, b] for a, b in zip(tags, tags[1:], strict=False))
        state = scores[0]
        for own in scores[1:]:
            state = own + np.logaddexp.reduce(state[:, None] + move, axis=0)
        total -= np.logaddexp.reduce(state)
    return total


def test_gradients_are_those_of_the_likelihood():
    rng = np.random.default_rng(3)
    words = ["casa", "house", "maison", "haus", "la", "the", "das", "x"]
    chunk = [([words[rng.integers(8)] for _ in range(n)], rng.integers(3, size=n).tolist()) for n in (1, 2, 5, 9)]
    model = li.Model(
        ["a", "b", "c"], rng.normal(size=(li.FEATURES, 3)), rng.normal(size=(3, 3)), rng.normal(size=(3, 3)), {"casa": 0, "the": 1, "das": 2}
    )
    slope, lex, moves = li.gradients(model, chunk)
    used = np.unique(li.features(words)[0])[:12]
    for value, grad, places in (
        (model.transitions, moves, [(i, j) for i in range(3) for j in range(3)]),
        (model.lexical, lex, [(i, j) for i in range(3) for j in range(3)]),
        (model.weights, slope, [(f, int(f) % 3) for f in used]),
    ):
        for at in places:
            kept, step = value[at], 1e-5
            value[at] = kept + step
            up = log_likelihood(model, chunk)
            value[at] = kept - step
            down = log_likelihood(model, chunk)
            value[at] = kept
            assert abs((up - down) / (2 * step) - grad[at]) < 1e-5


def test_every_language_is_drawn_at_any_size():
    for n in (1, 400, 801, 10**6, 10**10, 10**15):
        limit = li.hash_limit(n, 400)
        assert 1 <= limit <= 1 << li.HASH_BITS
        if 801 <= n <= 10**10:
            assert abs(n * limit / 2**li.HASH_BITS - 800) < 1
