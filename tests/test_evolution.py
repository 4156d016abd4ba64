from pyspark.sql import functions as F

from wavelens.operators import evolution as ev


def table(spark, rows):
    return spark.createDataFrame(rows, "k string, w string, v double")


DATA = [("a", "1", 10.0), ("a", "2", 12.0), ("a", "3", 9.5), ("b", "1", 5.0), ("c", "3", 7.0)]


def test_evolution_is_null_when_a_wave_is_absent(spark, rows):
    got = rows(ev.evolution(table(spark, DATA), ["k"], "w", "v", ["1", "2", "3"]))
    assert got == [("a", 10.0, 12.0, 9.5, -0.5), ("b", 5.0, None, None, None), ("c", None, None, 7.0, None)]


def test_evolution_without_keys_is_one_row(spark):
    got = ev.evolution(table(spark, DATA[:3]), [], "w", "v", ["1", "3"], 1).collect()
    assert [tuple(r) for r in got] == [(10.0, 9.5, -0.5)]


def test_pivot_discovers_waves(spark):
    assert ev.pivot_waves(table(spark, DATA), ["k"], "w", "v").columns == ["k", "1", "2", "3"]


def test_first_and_last_available_wave(spark, rows):
    got = rows(ev.evolution_available(table(spark, DATA + [("d", "2", 1.0), ("d", "3", 4.0)]), ["k"], "w", "v"))
    assert got == [("a", "1", "3", 3, 10.0, 9.5, -0.5), ("d", "2", "3", 2, 1.0, 4.0, 3.0)]
    single = rows(ev.first_last(table(spark, DATA), ["k"], "w", "v"))
    assert ("b", "1", "1", 5.0, 5.0) in single


def test_compare_waves_keeps_keys_of_both(spark, rows):
    assert rows(ev.compare_waves(table(spark, DATA), ["k"], "w", ["v"], "1", "3")) == [("a", 10.0, 9.5)]


def test_comparable_needs_every_wave_and_a_base(spark, rows):
    df = spark.createDataFrame([("a", "1", 20), ("a", "2", 25), ("b", "1", 19), ("b", "2", 90), ("c", "1", 50)], "k string, w string, n long")
    assert rows(ev.comparable(df, ["k"], "w", 2, "n", 20)) == [("a", 2, 20, 25)]
    assert rows(ev.comparable(df, ["k"], "w", 2), "k") == [("a",), ("b",)]


def test_movers_rank_each_direction(spark, rows):
    df = spark.createDataFrame([("c", "x", 2.0), ("c", "y", 2.0), ("c", "z", 3.0), ("c", "u", -1.0), ("c", "v", 0.0)],
                               "cat string, o string, variation double")
    assert rows(ev.movers(df, ["cat"], "o", k=2), "ranking", "o") == [(1, "z"), (2, "x")]
    assert rows(ev.movers(df, ["cat"], "o", k=2, rising=False), "ranking", "o") == [(1, "u")]


def test_latest_wave_and_topk_history(spark, rows):
    df = table(spark, DATA + [("b", "3", 7.0)])
    assert rows(ev.in_latest_wave(df, "w"), "k") == [("a",), ("b",), ("c",)]
    assert rows(ev.in_latest_wave(df.filter("w = '1'"), "w", df)) == []
    assert rows(ev.topk_history(df, "k", "v", "w", "3", 2), "k", "w") == [("a", "1"), ("a", "2"), ("a", "3"), ("b", "1"), ("b", "3")]


def test_keep_keys_ignores_repeated_keys(spark):
    df = table(spark, DATA)
    keys = df.select("k").filter(F.col("k") == "a")
    assert ev.keep_keys(df, keys.unionAll(keys), ["k"]).count() == 3


def test_attach_first_last_keeps_keys_without_values(spark, rows):
    df = table(spark, DATA)
    first = df.filter("w = '1'").select("k", F.col("v").alias("f"))
    last = df.filter("w = '3'").select("k", F.col("v").alias("l"))
    assert rows(ev.attach_first_last(df.select("k").distinct(), first, last, ["k"])) == [("a", 10.0, 9.5), ("b", 5.0, None), ("c", None, 7.0)]
