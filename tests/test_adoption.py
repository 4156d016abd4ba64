import pytest

from wavelens.operators import adoption as ad

SCHEMA = "wave string, opt_a string, opt_b string, opt_c string, val_a string"


@pytest.fixture
def marks(spark):
    return spark.createDataFrame(
        [
            ("w1", "1", "0", None, None), ("w1", None, "1", None, None), ("w1", None, None, None, None),
            ("w2", "x", "1", None, "1"), ("w2", "1", None, None, "0"),
            ("w3", None, None, None, "1"), (None, "1", "1", None, "1"),
        ],
        SCHEMA,
    )


def test_base_is_whoever_answered_any_option(marks, rows):
    got = rows(ad.adoption(marks, ["opt_a", "opt_b", "opt_c"], ["wave"], "opt_"))
    assert got == [
        ("w1", "a", 2, 1.0, 50.0), ("w1", "b", 2, 1.0, 50.0), ("w1", "c", 2, 0.0, 0.0),
        ("w2", "a", 2, 1.0, 50.0), ("w2", "b", 2, 1.0, 50.0), ("w2", "c", 2, 0.0, 0.0),
    ]


def test_unmapped_option_can_have_no_share(marks, rows):
    got = rows(ad.adoption(marks, ["opt_a", "opt_c"], ["wave"], "opt_", unmapped="null"), "wave", "option", "pct")
    assert ("w1", "c", None) in got and ("w1", "a", 100.0) in got


def test_groups_have_their_own_bases_and_waves(marks, rows):
    groups = ad.groups_by_prefix(marks, {"o": "opt_", "v": "val_"})
    got = rows(ad.adoption_groups(marks, groups, ["wave"]), "wave", "category", "option", "eligible")
    assert [r for r in got if r[1] == "v"] == [("w2", "v", "a", 2), ("w3", "v", "a", 1)]
    assert not [r for r in got if r[0] == "w3" and r[1] == "o"]


def test_prefix_without_columns_is_skipped_with_a_warning(marks):
    with pytest.warns(UserWarning, match="category 'z' skipped"):
        assert ad.groups_by_prefix(marks, {"v": "val_", "z": "zzz_"}) == {"v": {"val_a": "a"}}


def test_complement(spark, rows):
    df = spark.createDataFrame([("w", 10, 3.0, 30.0)], "wave string, eligible long, selected double, pct double")
    assert rows(ad.complement(df)) == [("w", 10, 3, 7, 70.0)]


def test_ranking_breaks_ties_by_marks_then_name_and_skips_zero(spark, rows):
    df = spark.createDataFrame(
        [("w", "c", 5.0, 10.0), ("w", "b", 6.0, 10.0), ("w", "a", 5.0, 10.0), ("w", "z", 0.0, 0.0)],
        "wave string, option string, selected double, pct double")
    got = rows(ad.adoption_ranking(df, ["wave"]), "ranking", "option")
    assert got == [(1, "b"), (2, "a"), (3, "c")]


def test_coverage_lists_waves_in_order(spark, rows):
    df = spark.createDataFrame([("c", "w2"), ("c", "w1"), ("c", "w2"), ("d", "w3")], "cat string, wave string")
    assert rows(ad.coverage(df, ["cat"], "wave")) == [("c", 2, "w1, w2"), ("d", 1, "w3")]
