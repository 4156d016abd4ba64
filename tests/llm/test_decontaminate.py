import hashlib
import re

import pytest
from helpers import BASE, DOC, EDGES, edges, empty
from parity import compare, connect
from wavelens.llm import decontaminate as dc
from wavelens.llm.registry import SQL, op12_decontaminate

SF = "/root/testdata/sf0.001"
ITEM = "item_id long, text string"
ITEMS = [
    (1, " ".join(BASE.split()[3:15])), (2, "One"), (3, None), (4, "..."), (5, "um CAFÉ"), (6, "dolor lorem ipsum dolor"),
    (7, "zeta eta theta iota kappa lambda mu nu xi omicron"), (None, "no identifier"), (8, "never seen at all in any of these texts here at"),
]


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window=10):
    out = []
    for doc, text in docs:
        own, hit, named = words(text), set(), set()
        joined = " " + " ".join(own) + " "
        begins = [i for i, c in enumerate(joined) if c == " "]
        number = {b: i for i, b in enumerate(begins)}
        for item, body in items:
            ws = words(body)
            k = min(len(ws), window)
            for i in range(len(ws) - k + 1) if k else []:
                gram, at = " " + " ".join(ws[i : i + k]) + " ", -1
                while (at := joined.find(gram, at + 1)) >= 0:
                    hit.update(range(number[at], number[at] + k))
                    named.add("" if item is None else str(item))
        listed = hashlib.sha256(",".join(sorted(named)).encode()).hexdigest()
        out.append((doc, len(own), len(hit), len(named), listed, bool(hit)))
    return sorted(out, key=repr)


def same(df, expected):
    assert sorted(map(tuple, df.collect()), key=repr) == expected


def test_query_against_sql(spark):
    assert compare(op12_decontaminate(spark, SF), connect(SF), SQL["op12_decontaminate"]) is None


@pytest.mark.parametrize("block_bytes", [1 << 25, 400])
def test_edges_in_one_block_and_in_many(spark, block_bytes):
    items = spark.createDataFrame([(*r, "x") for r in ITEMS], ITEM + ", words string")
    same(dc.report(edges(spark), items, block_bytes=block_bytes), brute(EDGES, ITEMS))


def test_windows_of_other_sizes(spark):
    docs = [(1, "a b c d e f g"), (2, "x a b c"), (3, "g f e"), (4, "a b c a b c a b")]
    items = [(1, "A-B-c"), (2, "b c a b c"), (3, "f"), (4, "q")]
    for window in (1, 2, 3, 4, 7):
        got = dc.report(spark.createDataFrame(docs, DOC), spark.createDataFrame(items, ITEM), window)
        same(got, brute(docs, items, window))


def test_items_that_share_a_passage(spark):
    passage = " ".join(BASE.split()[:12])
    items = [(i, f"start{i} {passage} end{i}") for i in range(300)]
    docs = [(1, f"so {passage} it goes"), (2, passage[: passage.rindex(" ", 0, -12)]), (3, "clean text")]
    got = dc.report(spark.createDataFrame(docs, DOC), spark.createDataFrame(items, ITEM))
    same(got, brute(docs, items))


def test_spans_and_documents_go(spark):
    passage = " ".join(BASE.split()[:10])
    docs = [(1, f"Before, {passage.upper()}! After."), (1, "same id, other text"), (2, passage), (3, None), (4, "clean  text\n"), (5, f"{passage}; mid {passage}")]
    frame = spark.createDataFrame([(*r, 1, "k") for r in docs], DOC + ", KEY int, ranges string")
    items = spark.createDataFrame([(1, passage)], ITEM)
    cut = dc.decontaminate(frame, items)
    assert cut.columns == frame.columns
    assert sorted((r["doc_id"], r["text"] or "") for r in cut.collect()) == [
        (1, "Before! After."), (1, "same id, other text"), (2, ""), (3, ""), (4, "clean  text\n"), (5, "; mid"),
    ]
    whole = dc.decontaminate(frame, items, remove="documents")
    assert sorted(r["text"] or "" for r in whole.collect()) == ["", "clean  text\n", "same id, other text"]
    with pytest.raises(ValueError):
        dc.decontaminate(frame, items, remove="lines")


def test_no_rows(spark):
    items = spark.createDataFrame(ITEMS, ITEM)
    assert dc.report(empty(spark), items).count() == 0
    same(dc.report(edges(spark), spark.createDataFrame([], ITEM)), brute(EDGES, []))


def test_no_python_in_the_plan(spark):
    plan = op12_decontaminate(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct"))
