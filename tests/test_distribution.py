import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wavelens.operators import checks as ck
from wavelens.operators import distribution as di
from wavelens.operators import filters as fl

SCHEMA = "wave string, gender string, role string, level string"


@pytest.fixture
def people(spark):
    return spark.createDataFrame(
        [
            ("w1", "f", "a", "x"), ("w1", "f", "a", None), ("w1", "m", "b", "x"), ("w1", None, "b", "y"),
            ("w2", "f", None, None), ("w2", "m", "a", None), (None, "m", "a", "x"),
        ],
        SCHEMA,
    )


def test_each_variable_has_its_own_base_and_null_dims_vanish(people, rows):
    got = rows(di.distribution(people, ["role", "level", "missing"], ["wave"]))
    assert got == [
        ("w1", "level", "x", 2, 3, 66.7), ("w1", "level", "y", 1, 3, 33.3),
        ("w1", "role", "a", 2, 4, 50.0), ("w1", "role", "b", 2, 4, 50.0),
        ("w2", "role", "a", 1, 1, 100.0),
    ]


def test_two_dims_drop_a_null_in_either(people, rows):
    got = rows(di.distribution(people, ["role"], ["wave", "gender"]), "wave", "gender", "value", "n", "base")
    assert got == [("w1", "f", "a", 2, 2), ("w1", "m", "b", 1, 1), ("w2", "m", "a", 1, 1)]


def test_all_null_variable_gives_nothing(people):
    empty = people.withColumn("role", F.lit(None).cast("string"))
    assert di.distribution(empty, ["role"], ["wave"]).count() == 0


def test_odd_variable_names(spark, rows):
    df = spark.createDataFrame([("w", "a"), ("w", "b")], ["wave", "h2o.ai`x"])
    got = rows(di.distribution(df, ["h2o.ai`x"], ["wave"]))
    assert got == [("w", "h2o.ai`x", "a", 1, 2, 50.0), ("w", "h2o.ai`x", "b", 1, 2, 50.0)]


def test_window_and_join_give_the_same_shares(people, rows):
    counts = di.count_by(fl.not_null(people, ["wave", "role"]), ["wave", "role"])
    assert rows(di.with_share(counts, ["wave"])) == rows(di.join_base(counts, ["wave"]))


def test_with_share_keeps_a_null_slice_and_join_base_drops_it(people):
    counts = di.count_by(people, ["wave", "role"])
    assert di.with_share(counts, ["wave"]).filter("wave IS NULL").count() == 1
    assert di.join_base(counts, ["wave"]).filter("wave IS NULL").count() == 0


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(
    st.sampled_from(["w1", "w2", None]), st.sampled_from(["f", "m"]),
    st.sampled_from(["a", "b", "c", None]), st.sampled_from(["x", None])), min_size=1, max_size=40))
def test_parts_add_up_to_the_base(spark, answers):
    df = spark.createDataFrame(answers, SCHEMA)
    got = di.distribution(df, ["role", "level"], ["wave"])
    audit = ck.base_audit(got, ["wave", "variable"]).collect()
    assert all(r["status"] == "OK" for r in audit)
    expected = sum(1 for w, _, role, _ in answers if w and role) + sum(1 for w, _, _, level in answers if w and level)
    assert (got.agg(F.sum("n")).first()[0] or 0) == expected
    assert ck.pct_out_of_range(got, ["wave", "variable"], low=99.7, high=100.3).count() == 0


def test_reshare_recomputes_while_sum_shares_adds_rounded_ones(spark, rows):
    df = spark.createDataFrame([("w", "top", 1, 33.3), ("w", "top", 1, 33.3), ("w", "rest", 1, 33.3)],
                               "wave string, label string, n long, pct double")
    assert rows(di.reshare(df, ["wave"], "label"), "label", "n", "pct") == [("rest", 1, 33.33), ("top", 2, 66.67)]
    assert rows(di.sum_shares(df, ["wave", "label"]), "label", "pct") == [("rest", 33.3), ("top", 66.6)]
    assert di.sum_shares(df, []).first()["pct"] == 99.9


def test_subgroup_share_omits_slices_without_members(spark, rows):
    df = spark.createDataFrame([("w", "a", "f", 1), ("w", "a", "m", 3), ("w", "b", "m", 2)],
                               "wave string, role string, gender string, n long")
    assert rows(di.subgroup_share(df, ["wave", "role"], "gender", "f")) == [("w", "a", 1, 4, 25.0)]


def test_external_base_may_exceed_a_hundred_percent(spark, rows):
    marks = spark.createDataFrame([("w", 15), ("v", 1)], "wave string, marks long")
    base = spark.createDataFrame([("w", 10)], "wave string, base long")
    assert rows(di.marks_ratio(marks, base, ["wave"])) == [("v", 1, None, None, None), ("w", 15, 10, 5, 1.5)]
    assert rows(di.presence(marks, base, ["wave"], "marks"), "wave", "pct") == [("v", None), ("w", 150.0)]


def test_topbox(spark, rows):
    df = spark.createDataFrame([("w", 1, 3, 10), ("w", 2, 2, 10), ("w", 5, 5, 10), ("v", 5, 7, 7)],
                               "wave string, pos int, n long, base long")
    assert rows(di.topbox_share(df, ["wave"], "pos", [1, 2])) == [("v", 0, 7, 0.0), ("w", 5, 10, 50.0)]


def test_complete_grid_keeps_listed_order_and_absent_rows(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("z", "x", 9.0)], "r string, c string, v double")
    grid = di.complete_grid(df, "r", ["b", "a"], "c", ["y", "x"], "v").orderBy("position").collect()
    assert [tuple(r) for r in grid] == [(1, "b", None, None), (2, "a", None, 1.0)]
    filled = di.complete_grid(df, "r", ["b", "a"], "c", ["y", "x"], "v", 0.0).orderBy("position").collect()
    assert [tuple(r) for r in filled] == [(1, "b", 0.0, 0.0), (2, "a", 0.0, 1.0)]
    assert ck.unrecognised(df, "r", ["a", "b"]).collect()[0]["r"] == "z"


def test_matrix_avg(spark, rows):
    df = spark.createDataFrame([("a", "x", 1), ("a", "x", 2), ("a", "y", 5)], "r string, c string, v int")
    assert rows(di.matrix_avg(df, "r", "c", ["x", "y", "z"], "v")) == [("a", 1.5, 5.0, None)]


def test_null_keeping_and_null_dropping_exclusion(people):
    assert fl.exclude_label(people, "level", ["x"]).count() == 4
    assert fl.exclude_label(people, "level", ["x"], keep_null=False).count() == 1


def test_base_filters(spark, rows):
    df = spark.createDataFrame([("a", 1), ("b", 20), ("c", 21)], "role string, base long")
    assert rows(fl.min_base(df, "base", 20, "role", ["c"])) == [("b", 20)]
    kept, discarded = fl.split_by_base(df, "base", 1)
    assert rows(kept) == [("b", 20), ("c", 21)] and rows(discarded) == [("a", 1)]


def test_base_audit_finds_two_bases_and_wrong_sums(spark):
    df = spark.createDataFrame([("a", 1, 2), ("a", 1, 3), ("b", 1, 5), ("c", 2, 2)], "d string, n long, base long")
    got = {r["d"]: r["status"] for r in ck.base_audit(df, ["d"]).collect()}
    assert got == {"a": "VERIFICAR", "b": "VERIFICAR", "c": "OK"}
