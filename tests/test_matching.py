import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from wavelens.operators import matching as ma

WORDS = ["criterios", "salario", "uso", "ia", "banco", "dados", "cloud", "r", "faixa", "etl", "o"]


def names_of(rng, n):
    out = set()
    while len(out) < n:
        word = "_".join(rng.choice(WORDS) for _ in range(rng.randint(1, 4)))
        if rng.random() < 0.4:
            i = rng.randrange(len(word))
            word = word[:i] + rng.choice("xyzs") + word[i + rng.randint(0, 1):]
        out.add(word)
    return sorted(out)


def frame(spark, names):
    return spark.createDataFrame(list(enumerate(names)), "position int, name string")


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


SCORES = {
    "sequence": lambda a, b: SequenceMatcher(None, a, b).ratio(),
    "levenshtein": lambda a, b: 1 - distance(a, b) / max(len(a), len(b)),
}


@pytest.mark.parametrize("kind", SCORES)
@pytest.mark.parametrize("seed", [1, 2])
def test_no_candidate_is_lost_and_none_added(spark, kind, seed):
    rng = random.Random(seed)
    left, right = names_of(rng, 40), names_of(rng, 45)
    found = ma.fuzzy_candidates(frame(spark, left), frame(spark, right), kind=kind)
    got = {(r["base"], r["other"]): r["score"] for r in found.collect()}
    want = {(a, b): SCORES[kind](a, b) for a in left for b in right if SCORES[kind](a, b) >= 0.6}
    assert got.keys() == want.keys() and len(got) == found.count()
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_long_names_score_like_the_sequence_matcher_in_this_order(spark):
    # Beyond 200 letters the matcher ignores popular ones, so order and length matter.
    a, b = "faixa_" * 40 + "salarial_xyz", "faixa_" * 38 + "salario_xyzw_abc"
    for left, right in ((a, b), (b, a)):
        found = ma.fuzzy_candidates(frame(spark, [left]), frame(spark, [right]), min_score=0.05, kind="sequence").collect()
        expected = SequenceMatcher(None, left, right).ratio()
        assert [r["score"] for r in found] == ([expected] if expected >= 0.05 else [])


@pytest.mark.parametrize("seed", range(4))
def test_assignment_is_the_greedy_one(spark, seed):
    rng = random.Random(seed)
    pairs = [(i, f"a{i}", j, f"b{j}", rng.choice([0.6, 0.7, 0.7, 0.9])) for i in range(9) for j in range(8) if rng.random() < 0.6]
    rng.shuffle(pairs)
    df = spark.createDataFrame(pairs, "base_position int, base string, other_position int, other string, score double")
    taken, used = set(), set()
    for i, a, j, b, _ in sorted(pairs, key=lambda p: (-p[4], p[0], p[2])):
        if a not in used and b not in used:
            taken.add((a, b))
            used |= {a, b}
    got = ma.assign_one_to_one(df).collect()
    assert {(r["base"], r["other"]) for r in got} == taken and len(got) == len(taken)


def test_a_long_chain_of_falling_scores_takes_few_rounds(spark, monkeypatch):
    """500 names, each better matched to the one before: every other pair is taken."""
    rounds, cut = [], ma.cut_lineage
    monkeypatch.setattr(ma, "cut_lineage", lambda df: rounds.append(1) or cut(df))
    pairs = []
    for i in range(499):
        a, b = (i + 1) // 2, i // 2
        pairs.append((a, f"a{a}", b, f"b{b}", 1 - i / 1000))
    df = spark.createDataFrame(pairs, "base_position int, base string, other_position int, other string, score double")
    got = {(r["base"], r["other"]) for r in ma.assign_one_to_one(df).collect()}
    assert got == {(f"a{i}", f"b{i}") for i in range(250)} and len(rounds) <= 12


@pytest.mark.parametrize("seed", range(4))
def test_assignment_is_the_greedy_one(spark, seed):
    rng = random.Random(seed)
    pairs = [(a, f"a{a}", b, f"b{b}", rng.randrange(1, 9) / 10) for a in range(25) for b in range(20) if rng.random() < (0.1, 0.3, 0.9, 0.05)[seed]]
    want, used = set(), set()
    for a, base, b, other, _ in sorted(pairs, key=lambda p: (-p[4], p[0], p[2])):
        if base not in used and other not in used:
            used |= {base, other}
            want.add((base, other))
    df = spark.createDataFrame(pairs, "base_position int, base string, other_position int, other string, score double")
    assert {(r["base"], r["other"]) for r in ma.assign_one_to_one(df).collect()} == want


def test_a_chain_of_falling_scores_needs_several_rounds(spark):
    pairs = [(i, f"a{i}", j, f"b{j}", 0.9 - 0.01 * (i + j)) for i in range(6) for j in (i - 1, i) if j >= 0]
    df = spark.createDataFrame(pairs, "base_position int, base string, other_position int, other string, score double")
    assert {(r["base"], r["other"]) for r in ma.assign_one_to_one(df).collect()} == {(f"a{i}", f"b{i}") for i in range(6)}


def test_no_pairs(spark):
    df = spark.createDataFrame([], "base_position int, base string, other_position int, other string, score double")
    assert ma.assign_one_to_one(df).count() == 0


def test_correspondence_names_every_column_once(spark):
    base = frame(spark, ["idade", "faixa_salarial", "uso_de_ia", "so_na_base"])
    other = frame(spark, ["idade", "faixa_salariall", "usa_ia", "zzzzzz"])
    got = {(r["base"], r["name_w"]): (r["method_w"], r["score_w"], r["confidence_w"]) for r in ma.correspond(base, {"w": other}, "sequence").collect()}
    assert got[("idade", "idade")] == ("exact", 1.0, "high")
    assert got[("faixa_salarial", "faixa_salariall")] == ("fuzzy", 0.97, "high")
    assert got[("uso_de_ia", "usa_ia")] == ("fuzzy", 0.67, "low")
    assert got[("so_na_base", None)] == ("no_match", 0.0, None)
    assert got[(None, "zzzzzz")] == ("only_here", None, None)
    assert len(got) == 5


@pytest.mark.parametrize("kind, score", [("sequence", 0.62), ("levenshtein", 0.63)])
def test_published_score_of_a_tie(spark, kind, score):
    row = ma.correspond(frame(spark, ["abcdexyz"]), {"w": frame(spark, ["abcdeuvw"])}, kind).first()
    assert (row["method_w"], row["score_w"], row["confidence_w"]) == ("fuzzy", score, "low")


def test_two_other_waves(spark):
    base = frame(spark, ["a_name", "b_name"])
    others = {"x": frame(spark, ["a_name"]), "y": frame(spark, ["qqq", "b_name"])}
    got = {r["base"]: r for r in ma.correspond(base, others).collect() if r["base"]}
    assert got["a_name"]["method_x"] == "exact" and got["a_name"]["name_y"] is None
    extra = [r for r in ma.correspond(base, others).collect() if not r["base"]]
    assert [(r["name_x"], r["name_y"], r["method_y"]) for r in extra] == [(None, "qqq", "only_here")]


def test_confidence_uses_the_rounded_score(spark):
    df = spark.createDataFrame([("fuzzy", 0.85), ("fuzzy", 0.84), ("fuzzy", 0.69), ("exact", 0.1), ("no_match", 0.0)], "m string, s double")
    assert [r[0] for r in df.select(ma.confidence(F.col("m"), F.col("s"))).collect()] == ["high", "medium", "low", "high", None]


def test_trust_policy(spark):
    df = spark.createDataFrame(
        [("exact", "high", None), ("exact", "high", "rejected"), ("fuzzy", "low", "approved"), ("fuzzy", "high", None),
         ("fuzzy", "medium", None), ("no_match", None, None), (None, None, None)], "m string, c string, r string")
    got = [r[0] for r in df.select(ma.trusted(F.col("m"), F.col("c"), F.col("r"))).collect()]
    assert got == [True, False, True, True, False, False, False]


def test_canonical_map(spark, rows):
    df = spark.createDataFrame(
        [("a", "a", "exact", "high", None, "x", "fuzzy", "low"), ("b", "b2", "fuzzy", "high", "rejected", None, "no_match", None),
         (None, "p_only", "only_here", None, None, None, None, None), (None, None, None, None, None, "q_only", "only_here", None)],
        "base string, name_p string, method_p string, confidence_p string, review_p string, name_q string, method_q string, confidence_q string")
    got = rows(ma.canonical_map(df, "base", ["p", "q"]))
    assert got == [("base", "a", "a"), ("base", "b", "b"), ("p", "a", "a"), ("p", "p_only", "p_only"), ("q", "q_only", "q_only")]
    assert [r[0] for r in ma.canonical_names(ma.canonical_map(df, "base", ["p", "q"])).collect()] == ["a", "b", "p_only", "q_only"]


def test_a_joined_pair_leaves_the_join_once_and_no_letter_holds_a_task(spark):
    rng = random.Random(3)
    left, right = frame(spark, names_of(rng, 60)), frame(spark, names_of(rng, 60))
    pairs = ma.fuzzy_candidates(left, right)
    assert pairs.count() == pairs.dropDuplicates(["base", "other"]).count()
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert "letter" in plan and "salt" in plan and "Cartesian" not in plan


def test_the_default_kind_needs_no_python(spark):
    found = ma.correspond(frame(spark, ["abc_d"]), {"w": frame(spark, ["abc_e"])})
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()
