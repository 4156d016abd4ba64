import random
from collections import Counter

from helpers import DOC, EDGES, edges, empty
from parity import compare, connect
from wavelens.llm import line_dedup as ld
from wavelens.llm.registry import SQL, op3_line_dedup

SF = "/root/testdata/sf0.001"


def brute(rows, percent=80):
    lines = [(d is None, d or 0, n, set(x.split())) for d, t in rows for n, x in enumerate((t or "").split("\n"))]
    lines = sorted((x for x in lines if x[3]), key=lambda x: x[:3])
    out = Counter()
    for i, (none, d, n, ws) in enumerate(lines):
        if any((100 + percent) * len(ws & o) >= percent * (len(ws) + len(o)) for _, _, _, o in lines[:i]):
            out[None if none else d, n] += 1
    return out


def found(df):
    return Counter((r["doc_id"], int(x)) for r in df.collect() for x in r["removed"].split(",") if x)


def test_query_against_sql(spark):
    assert compare(op3_line_dedup(spark, SF), connect(SF), SQL["op3_line_dedup"]) is None


def test_near_lines_ties_and_chains(spark):
    words = [f"w{i}" for i in range(30)]
    rows = [(i, "\n".join([" ".join(words[i : i + 20]), " ".join(words[:10]), "a b c", f"u{i} v{i} x{i} y{i} z{i}"])) for i in range(8)]
    assert found(ld.report(spark.createDataFrame(rows, DOC))) == brute(rows)


def test_edges(spark):
    rows = [r for r in EDGES if r != (6, EDGES[7][1])] + [(6, EDGES[7][1])]  # rows that repeat are one document
    got = ld.report(edges(spark))
    assert got.count() == len(EDGES)
    assert set(found(got)) == set(brute(rows))
    assert {r["doc_id"]: r["n_lines"] for r in got.collect()}[4] == 2


def test_short_and_unspaced_lines_go_too(spark):
    texts = [
        "All rights reserved.\nha ha ha ha ha ha\n今日は天気がいいです\n\n",
        "reserved. rights All\nha\n今日は天気がいいです\n \n\na b c d\nred green blue",
        "e a b c d\nred green\nred green blue grey\nx",
    ]
    got = found(ld.report(spark.createDataFrame(list(enumerate(texts)), DOC)))
    assert got == Counter([(1, 0), (1, 1), (1, 2), (2, 0)])  # four words of five are 0.8, three of four are not


def test_texts_without_the_lines(spark):
    line = "one two three four five six"
    rows = [(1, f"{line}\nkeep"), (2, f"first\n{line}\nlast"), (3, None)]
    docs = spark.createDataFrame(rows, DOC)
    got = ld.without_lines(docs, ld.removals(docs)).collect()
    assert {r["doc_id"]: r["text"] for r in got} == {1: f"{line}\nkeep", 2: "first\nlast", 3: None}


def test_a_group_of_near_copies_does_not_make_all_its_pairs(spark, monkeypatch):
    made, stored = [], ld.stored

    def counted(df, name):
        out = stored(df, name)
        made.append(out.count() if name == "line-pairs" else 0)
        return out

    monkeypatch.setattr(ld, "stored", counted)
    words = [f"word{i}" for i in range(20)]
    rows = [(i, " ".join([*words[: i % 20], f"other{i}", *words[i % 20 + 1 :]])) for i in range(60)]
    assert found(ld.report(spark.createDataFrame(rows, DOC))) == brute(rows)
    assert 59 <= sum(made) < 10 * len(rows)  # all pairs are 1,770


def test_other_shares_and_sets_longer_than_an_id_tells(spark):
    draw = random.Random(3)
    sizes = [draw.randrange(1, 14) for _ in range(150)]
    rows = [(i, " ".join(draw.sample([f"{'w' * (k % 4)}{k}" for k in range(15)], n))) for i, n in enumerate(sizes)]
    long = [f"w{k}" for k in range(700)]
    rows += [(200 + k, " ".join(long[: 700 - k])) for k in (0, 130, 150, 400)]
    docs = spark.createDataFrame(rows, DOC)
    for percent in (50, 67, 90):
        assert found(ld.report(docs, percent)) == brute(rows, percent)


def test_long_lines_that_share_words_of_a_key_alone_make_no_pairs(spark, monkeypatch):
    made, stored = [], ld.stored

    def counted(df, name):
        out = stored(df, name)
        made.append(out.count() if name == "line-pairs" else 0)
        return out

    monkeypatch.setattr(ld, "stored", counted)
    draw = random.Random(5)
    words = [f"w{i:04}" for i in range(9000)]
    rows = [(i, " ".join(["commonword1", "commonword2", *draw.sample(words, 200)])) for i in range(60)]
    rows += [(60 + i, rows[i][1].rsplit(" ", 20)[0]) for i in range(5)]
    assert found(ld.report(spark.createDataFrame(rows, DOC))) == brute(rows) == Counter((60 + i, 0) for i in range(5))
    assert 5 <= sum(made) <= 10  # by 64 bits, as many as the lines and more


def test_slices_of_keys_lose_no_pair(spark, monkeypatch):
    named, stored = [], ld.stored
    monkeypatch.setattr(ld, "stored", lambda df, name: named.append(name) or stored(df, name))
    monkeypatch.setattr(ld, "SLICE_LINES", 30)
    draw = random.Random(4)
    words = [f"word{i}" for i in range(40)]
    rows = [(draw.randrange(90), "\n".join(" ".join(draw.sample(words[j : j + 14], 12)) for j in (0, 3, 20))) for _ in range(40)]
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    assert found(ld.report(spark.createDataFrame(rows, DOC))) == brute(rows)
    assert named.count("line-shared") == 5


def test_no_rows(spark):
    assert ld.report(empty(spark)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = op3_line_dedup(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
