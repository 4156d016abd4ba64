import json
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from helpers import EDGES, edges, empty
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer
from wavelens.llm import packing
from wavelens.session import stored

PATH = P.path("byte_bpe_50k.tiktoken")
JSON = P.path("byte_bpe_50k.json")
ADDED = packing.added_tokens(JSON)
TRUE = Tokenizer.from_file(JSON)


def check_plan(counts, size, plan):
    got, places = defaultdict(int), defaultdict(list)
    for length, rank, n, first, offset in plan.runs:
        assert rank == got[length]
        got[length] += n
        for k in range(n):
            places[first + k].append((offset, length))
    assert all(got[x] == counts[x] for x in range(1, size + 1)) and sorted(places) == list(range(plan.bins))
    for slots in places.values():
        at = 0
        for offset, length in sorted(slots):
            assert offset == at
            at += length
        assert at <= size


@pytest.mark.parametrize("make", [
    lambda r: np.exp(r.normal(4, 1, 3000)).astype(int) + 1, lambda r: r.integers(1, 257, 2000),
    lambda r: np.full(500, 90), lambda r: r.integers(80, 140, 700), lambda r: np.array([1, 256, 128, 128, 255, 1]),
])
def test_plans_are_whole_and_near_the_bound(make):
    lengths = np.minimum(make(np.random.default_rng(2)), 256)
    counts = np.bincount(lengths, minlength=257)
    plan = packing.best_plan(counts, 256)
    check_plan(counts, 256, plan)
    for scheme in packing.SCHEMES:
        check_plan(counts, 256, packing.make_plan(counts, 256, *scheme))
    greedy = packing.Plan(256)
    for x in range(256, 0, -1):
        if counts[x]:
            greedy.best_fit(x, int(counts[x]))
    assert -(-int(lengths.sum()) // 256) <= plan.bins <= greedy.bins


def test_groups_hold_equal_numbers():
    counts = np.bincount([9, 9, 9, 8, 7, 7, 6, 5], minlength=11)
    grouped = packing.linear_groups(counts, list(range(5, 11)), 4)
    assert grouped == {9: [[9, 2], [9, 1], [8, 1]], 7: [[7, 2]], 6: [[6, 1], [5, 1]]}


def test_configurations_solve_the_program():
    found = packing.configurations([6, 4], [10, 10], 10)
    assert sum(times for _, times in found) == 10  # every 6 goes with a 4


def test_pieces_and_places_of_edges(spark):
    tokens = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    pieces = stored(packing.cut_pieces(edges(spark), PATH, P.PATTERN, with_ids=True), "pieces")
    rows = packing.pack(pieces).collect()
    want = defaultdict(list)
    for doc, text in EDGES:
        ids = [*tokens.encode(text or "", add_special_tokens=False).ids, 0]
        cuts = sorted({0, *range(len(ids), 0, -2048), len(ids)})
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            want[doc].append((k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()), ids[a:b]))
    got = defaultdict(list)
    taken = defaultdict(list)
    for r in rows:
        got[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"], list(r["ids"])))
        taken[r["sequence_id"]].append((r["offset"], r["length"]))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    for places in taken.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    whole = {r["sequence_id"]: r["ids"] for r in packing.sequences(packing.pack(pieces)).collect()}
    assert all(len(whole[s]) == sum(n for _, n in p) for s, p in taken.items())


END = "<|endoftext|>"
PARTS = st.sampled_from([END, END[:-1], END[1:], "<|", "|>", " ", "  ", "\n", "\t ", "a", " b", "'s", "12", "é", "日本", "\U0001f642", "\x00"])


@settings(max_examples=3000, deadline=None)
@given(st.lists(PARTS | st.text(max_size=6), max_size=12).map("".join))
def test_ids_are_those_of_the_tokenizer_file(text):
    mine = packing.codec(PATH, P.PATTERN, ADDED).encode(text, allowed_special="all")
    assert mine == TRUE.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", [END, END * 3, f"{END}a", f"a{END}", f"a  {END}  b", f"a {END}{END} b", f"<|endof{END}text|>", f"{END[:-1]} {END}"])
def test_added_tokens_in_every_place(spark, text):
    docs = spark.createDataFrame([(1, text), (2, text * 900)], "doc_id long, text string")
    rows = packing.cut_pieces(docs, PATH, P.PATTERN, with_ids=True, added=ADDED).orderBy("doc_id", "piece").collect()
    for doc, whole in ((1, text), (2, text * 900)):
        ids = [x for r in rows if r["doc_id"] == doc for x in r["ids"]]
        assert ADDED[END] in ids and ids == [*TRUE.encode(whole, add_special_tokens=False).ids, 0]


def test_rules_of_added_tokens_that_are_not_kept(tmp_path):
    flags = dict.fromkeys(("single_word", "lstrip", "rstrip", "normalized"), False)
    for rows in ([{"content": "<a>", "id": 1, **flags, "lstrip": True}], [{"content": x, "id": 1, **flags} for x in ("<a>", "<a><b>")]):
        file = tmp_path / "own.json"
        file.write_text(json.dumps({"added_tokens": rows}))
        with pytest.raises(ValueError, match="added tokens"):
            packing.added_tokens(str(file))


def test_no_rows(spark):
    assert packing.pack_documents(empty(spark), PATH, P.PATTERN).count() == 0
