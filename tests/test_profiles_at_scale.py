"""Profiles and adoption in the forms made for wide, long and growing tables."""

import random
import re

import pytest
from pyspark.sql import functions as F

from wavelens.operators import adoption as ad
from wavelens.operators import profile as pr


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


# --- checks beside a write


def test_checks_are_counted_by_the_write(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", None), (None, 3)], "x string, n int")
    out, profile = pr.ProfileOnWrite.of(df, {"x_known": F.col("x") == "a", "n_small": F.col("n") < 3})
    out.write.parquet(str(tmp_path / "t"))
    assert sorted(map(tuple, profile.failures(spark).collect())) == [("n_small", 3, 1), ("x_known", 3, 1)]
    assert {r["column"]: r["nulls"] for r in profile.counts(spark).collect()} == {"x": 1, "n": 1}


# --- distinct values


def test_sketches_of_waves_merge_without_the_waves(spark):
    waves = {w: spark.range(20_000).select((F.col("id") + 10_000 * w).cast("string").alias("open"), (F.col("id") % 7).alias("few"), F.lit(None).cast("string").alias("none")) for w in range(3)}
    parts = [pr.distinct_sketches(df, str(w)) for w, df in waves.items()]
    got = {r["column"]: (r["waves"], r["distinct_values"]) for r in pr.merged_distinct(parts[0].unionAll(parts[1]).unionAll(parts[2])).collect()}
    assert got["few"] == (3, 7) and got["none"] == (3, 0)
    assert abs(got["open"][1] - 40_000) < 40_000 * 0.033


# --- frequent labels


def brute_top(rows, k):
    counts = {}
    for dim, label in rows:
        if label is not None:
            counts.setdefault(dim, {}).setdefault(label, 0)
            counts[dim][label] += 1
    out = []
    for dim, own in counts.items():
        first = sorted(own.items(), key=lambda x: (-x[1], x[0]))[:k]
        out += [(dim, label, n, i) for i, (label, n) in enumerate(first, 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("slots", [1, 16, 1 << 14])
@pytest.mark.parametrize("k", [1, 5])
def test_top_labels_are_exact(spark, slots, k):
    draw = random.Random(slots)
    rows = [(draw.choice(["w1", "w2", None]), f"rare{draw.randrange(2000)}" if draw.random() < 0.8 else f"top{draw.randrange(6)}") for _ in range(1500)]
    rows += [("w3", "only"), ("w3", None), ("w4", None), ("w5", "tie b"), ("w5", "tie a")]
    df = spark.createDataFrame(rows, "wave string, answer string")
    assert sorted(map(tuple, pr.top_labels(df, ["wave"], "answer", k, slots).collect()), key=repr) == brute_top(rows, k)


def test_top_labels_without_dimensions_and_without_rows(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "x string")
    assert list(map(tuple, pr.top_labels(df, [], "x", 1).collect())) == [("a", 2, 1)]
    assert pr.top_labels(df.limit(0), [], "x", 3).count() == 0


def test_labels_of_sparse_slots_never_move(spark, tmp_path):
    """Nearly every row has its own label: only those that share a slot with a frequent one are exchanged."""
    spark.range(60_000).select(F.when(F.col("id") % 4 > 0, F.concat(F.lit("r"), "id")).otherwise(F.concat(F.lit("top"), (F.col("id") % 5).cast("string"))).alias("x")).write.parquet(str(tmp_path / "t"))
    got = pr.top_labels(spark.read.parquet(str(tmp_path / "t")), [], "x", 5)
    assert {r["label"] for r in got.collect()} == {f"top{i}" for i in range(5)}
    plan = got._jdf.queryExecution().executedPlan()
    counted = re.findall(r"LeftSemi", plan.toString())
    assert counted and "Window" in plan.toString()


# --- duplicates


def duplicates(spark, rows, schema):
    df = spark.createDataFrame(rows, schema).repartition(3)
    one, two = pr.duplicates_by_fingerprint(df).collect()[0], pr.duplicate_count(df).collect()[0]
    assert tuple(one) == tuple(two)
    return tuple(one)


def test_duplicates_by_fingerprint(spark):
    schema = "a string, b int, `c.d` double"
    assert duplicates(spark, [("x", 1, 0.5), ("x", 1, 0.5), ("x", None, 0.5), (None, 1, 0.5), (None, None, None), (None, None, None)], schema) == (6, 4, 2)
    assert duplicates(spark, [("x", 1, 0.5)], schema) == (1, 1, 0)
    assert duplicates(spark, [], schema) == (0, 0, 0)
    assert duplicates(spark, [("a", None, 1.0), (None, None, 1.0)] * 50, schema) == (100, 2, 98)


# --- many options


def same(a, b):
    assert a.columns == b.columns
    assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


@pytest.mark.parametrize("unmapped", ["zero", "null"])
@pytest.mark.parametrize("n", [1, 3, 7, 40])
def test_packed_adoption_is_adoption(spark, unmapped, n):
    draw = random.Random(n)
    kinds = [["0", "1"], ["0", "1", None], [None], ["1", "?", None], ["0.5", "2", "1", "x", None]]
    columns = [f"o{i}" for i in range(n)]
    rows = []
    for _ in range(300):
        shown = draw.random() < 0.8
        rows.append([draw.choice(["w1", "w2", None]), *[draw.choice(kinds[i % 5]) if shown else None for i in range(n)]])
    df = spark.createDataFrame(rows, ", ".join(["wave string", *[f"{c} string" for c in columns]])).repartition(4)
    groups = {"a": {c: c for c in columns[: n // 2 + 1]}, "b": {c: f"_{c}" for c in columns[n // 2 + 1 :]}}
    groups = {k: g for k, g in groups.items() if g}
    same(ad.adoption_packed(df, groups, ["wave"], unmapped), ad.adoption_groups(df, groups, ["wave"], unmapped))


def test_packed_counters_do_not_run_over(spark, monkeypatch):
    """Counters of few bits: many blocks, each filled to what its counters hold."""
    monkeypatch.setattr(ad, "LANE_BITS", 4)
    df = spark.range(1000).select(F.lit("w").alias("wave"), F.lit("1").alias("x"), F.lit("1").alias("y"), (F.col("id") % 2).cast("string").alias("z")).coalesce(1)
    got = {r["option"]: (r["eligible"], r["selected"]) for r in ad.adoption_packed(df, {"g": {c: c for c in "xyz"}}, ["wave"]).collect()}
    assert got == {"x": (1000, 1000.0), "y": (1000, 1000.0), "z": (1000, 500.0)}


def test_packed_adoption_makes_no_row_per_option(spark, tmp_path):
    spark.range(3000).select(F.lit("w").alias("wave"), *[(F.col("id") % 2).cast("string").alias(f"o{i}") for i in range(30)]).write.parquet(str(tmp_path / "t"))
    got = ad.adoption_packed(spark.read.parquet(str(tmp_path / "t")), {"g": {f"o{i}": str(i) for i in range(30)}}, ["wave"])
    assert got.count() == 30 and "FileScan" in final_plan(got)
