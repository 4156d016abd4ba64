import random

import pytest

from wavelens.operators import ordinal as od


def counts(spark, rows):
    return spark.createDataFrame(rows, "d string, pos int, n long")


def test_basis_decides_just_below_the_half(spark, rows):
    # 99 of 200 reach band 1: 49.5 %, which rounds to 50 without decimals.
    df = counts(spark, [("s", 1, 99), ("s", 2, 101)])
    got = {b: od.ordinal_quantiles(df, ["d"], "pos", 3, weight="n", basis=b).first()["p50"] for b in ("exact", "round2", "round0")}
    assert got == {"exact": 2, "round2": 2, "round0": 1}


def test_reaching_the_share_exactly_counts(spark):
    df = counts(spark, [("s", 1, 5), ("s", 2, 5)])
    assert tuple(od.ordinal_quantiles(df, ["d"], "pos", 2, weight="n").first()) == ("s", 10, 1, 2)


def test_null_dims_and_off_scale_rows(spark, rows):
    df = counts(spark, [("s", 2, 1), ("s", None, 5), (None, 1, 1), ("t", None, 1)])
    assert rows(od.ordinal_quantiles(df, ["d"], "pos", 2, weight="n")) == [("s", 1, 2, 2)]
    assert rows(od.ordinal_quantiles(df, ["d"], "pos", 2, weight="n", off_scale="lowest")) == [("s", 6, None, None), ("t", 1, None, None)]
    mixed = counts(spark, [("s", None, 1), ("s", 1, 2), ("s", 2, 3)])
    assert rows(od.ordinal_quantiles(mixed, ["d"], "pos", 2, weight="n", off_scale="lowest")) == [("s", 6, 1, 2)]


@pytest.mark.parametrize("seed", range(3))
def test_bands_agree_with_sorting_the_answers(spark, seed):
    rng = random.Random(seed)
    answers = [(rng.choice("ab"), rng.randint(1, 5)) for _ in range(rng.randint(5, 60))]
    df = spark.createDataFrame(answers, "d string, pos int")
    for row in od.ordinal_quantiles(df, ["d"], "pos", 5).collect():
        own = sorted(p for d, p in answers if d == row["d"])
        for name, q in od.P50_P75.items():
            first = next(p for i, p in enumerate(own, 1) if i >= q * len(own))
            first = min(p for p in set(own) if sum(x <= p for x in own) >= q * len(own))
            assert row[name] == first


def test_running_share_and_first_at(spark, rows):
    df = counts(spark, [("s", 1, 1), ("s", 3, 2), ("s", 2, 1)])
    run = od.running_share(df, ["d"], "pos")
    assert rows(run, "pos", "cumulated", "pct_cumulated") == [(1, 1, 25.0), (2, 2, 50.0), (3, 4, 100.0)]
    assert rows(od.first_at(run, ["d"], "pos", "pct_cumulated", 50)) == [("s", 2)]


def test_dense_rank_shares_positions_and_handles_nulls(spark, rows):
    df = spark.createDataFrame(
        [("w", "a", 5, 7), ("w", "b", 5, 7), ("w", "c", 5, 6), ("w", "d", 4, 9), (None, "e", 1, None), (None, "f", 1, 2)],
        "w string, r string, p50 int, p75 int")
    got = rows(od.rank_by(df, ["w"], ["p50", "p75"]), "r", "ranking")
    assert got == [("a", 1), ("b", 1), ("c", 2), ("d", 3), ("e", 2), ("f", 1)]
    assert rows(od.leaders(od.rank_by(df, ["w"], ["p50", "p75"])), "r") == [("a",), ("b",), ("f",)]


def test_band_movement_keeps_all_waves_of_movers_only(spark, rows):
    df = spark.createDataFrame(
        [("up", "1", 3, 4), ("up", "2", 3, 4), ("up", "3", 3, 5), ("still", "1", 2, 2), ("still", "3", 2, 2),
         ("only_first", "1", 1, 1), ("only_last", "3", 9, 9)], "k string, w string, p50 int, p75 int")
    change = od.band_change(df, ["k"], "w", "1", "3", ["p50", "p75"])
    assert rows(change) == [("still", 0, 0), ("up", 0, 1)]
    assert rows(od.band_movement(df, ["k"], "w", "1", "3", ["p50", "p75"]), "k", "w") == [("up", "1"), ("up", "2"), ("up", "3")]


def test_band_labels(spark, rows):
    df = spark.createDataFrame([(1, 2), (None, 9)], "a int, b int")
    assert rows(od.with_band_labels(df, ["lo", "hi"], {"a": "la", "b": "lb"}), "la", "lb") == [("lo", "hi"), (None, None)]
