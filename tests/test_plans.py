"""Plan shapes that decide whether a query still works on very large tables."""

import re

import pytest
from pyspark.sql import functions as F

from wavelens.operators import adoption as ad
from wavelens.operators import distribution as di
from wavelens.operators import evolution as ev
from wavelens.operators import matching as ma
from wavelens.operators import ordinal as od
from wavelens.operators import profile as pr


@pytest.fixture(scope="module")
def answers(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("answers") / "t")
    columns = [F.concat(F.lit(f"v{i}_"), (F.col("id") % (i + 2)).cast("string")).alias(f"q{i}") for i in range(8)]
    flags = [((F.col("id") + i) % 2).cast("string").alias(f"opt_{i}") for i in range(40)]
    spark.range(2000).select(
        (F.col("id") % 3).cast("string").alias("wave"), (F.col("id") % 5).cast("string").alias("role"),
        (F.col("id") % 13 + 1).cast("int").alias("pos"), *columns, *flags,
    ).write.parquet(path)
    return spark.read.parquet(path)


def final_plan(df):
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def shape(df):
    plan = final_plan(df)
    return len(re.findall("FileScan", plan)), len(re.findall(r"- Exchange ", plan))


def read_columns(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return {c.split(":")[0] for m in re.findall(r"ReadSchema: struct<([^>]*)>", text) for c in m.split(",")}


@pytest.mark.parametrize("n", [1, 8])
def test_distribution_is_one_scan_and_two_exchanges(answers, n):
    got = di.distribution(answers, [f"q{i}" for i in range(n)], ["wave"])
    assert shape(got) == (1, 2)
    assert "Window" not in final_plan(got)
    assert read_columns(got) == {"wave", *[f"q{i}" for i in range(n)]}


def test_an_open_question_has_no_window_over_its_labels(spark, tmp_path):
    spark.range(3000).select(F.lit("w").alias("wave"), F.col("id").cast("string").alias("open")).write.parquet(str(tmp_path / "t"))
    got = di.distribution(spark.read.parquet(str(tmp_path / "t")), ["open"], ["wave"])
    assert "Window" not in final_plan(got) and shape(got) == (1, 2)


def test_results_read_only_what_they_show(spark):
    from wavelens.plans import gold
    from wavelens.plans.reports import REPORTS, needs

    for name, wanted, other in (("nivel_atual", "nivel", "setor"), ("cloud_historico", "cloud_dia_a_dia_", "banco_de_dados_dia_a_dia_")):
        table, report = REPORTS[name]
        columns = ["edicao", "nivel", "setor", "cargo_atual", "cloud_dia_a_dia_x", "banco_de_dados_dia_a_dia_y"]
        silver = spark.createDataFrame([tuple("1" for _ in columns)] * 2, ", ".join(f"{c} string" for c in columns))
        plan = report(gold.TABLES[table](silver, needs(name)))._jdf.queryExecution().optimizedPlan().toString()
        assert wanted in plan and other not in plan.split("LogicalRDD")[0].split("LocalRelation")[0]


@pytest.mark.parametrize("n", [2, 40])
def test_adoption_is_one_scan_and_one_exchange(answers, n):
    got = ad.adoption(answers, [f"opt_{i}" for i in range(n)], ["wave"], "opt_")
    assert shape(got) == (1, 1)
    assert "partial_sum" in final_plan(got)


def test_several_groups_share_scan_and_exchange(answers):
    groups = {"a": {f"opt_{i}": str(i) for i in range(20)}, "b": {f"opt_{i}": str(i) for i in range(20, 40)}}
    assert shape(ad.adoption_groups(answers, groups, ["wave"])) == (1, 1)


def test_quantiles_are_one_exchange_without_window(answers):
    got = od.ordinal_quantiles(answers, ["wave", "role"], "pos", 13)
    assert shape(got) == (1, 1) and "Window" not in final_plan(got)
    assert read_columns(got) == {"wave", "role", "pos"}


def test_ranking_reuses_the_aggregate(answers):
    got = od.rank_by(od.ordinal_quantiles(answers, ["wave", "role"], "pos", 13), ["wave"], ["p50", "p75"])
    assert shape(got)[0] == 1 and "ReusedExchange" in final_plan(got)


def test_joined_base_reuses_the_counts(answers):
    got = di.join_base(di.count_by(answers, ["wave", "q7"]), ["wave"])
    assert shape(got)[0] == 1 and "ReusedExchange" in final_plan(got) and "Window" not in final_plan(got)


def test_evolution_is_one_aggregate(answers):
    assert shape(ev.evolution(di.count_by(answers, ["wave", "role"]), ["role"], "wave", "n", ["0", "2"])) == (1, 2)


def test_topk_is_cut_before_the_exchange(answers):
    got = ev.topk_by(answers.select("wave", "q7", "pos"), ["wave"], [F.desc("pos"), F.asc("q7")], 3)
    plan = final_plan(got)
    assert plan.count("WindowGroupLimit") == 2


def test_profiles_scan_once(answers):
    assert shape(pr.null_dictionary(answers, "w")) == (1, 1)
    assert shape(pr.distinct_profile(answers)) == (1, 2)


def test_filters_reach_the_scan(answers):
    got = di.count_by(answers.filter(F.col("wave") == "1"), ["role"])
    got.collect()
    assert "PushedFilters: [IsNotNull(wave), EqualTo(wave,1)]" in got._jdf.queryExecution().executedPlan().toString()


def test_one_wave_reads_one_partition(spark, answers, tmp_path):
    path = str(tmp_path / "waves")
    answers.select("wave", "role").write.partitionBy("wave").parquet(path)
    got = spark.read.schema("role string, wave string").parquet(path).filter(F.col("wave") == "2")
    got.collect()
    assert "PartitionFilters: [isnotnull(wave" in got._jdf.queryExecution().executedPlan().toString()


def test_name_candidates_are_an_equi_join(spark):
    names = spark.createDataFrame([(1, "abc"), (2, "abd")], "position int, name string")
    plan = final_plan(ma.fuzzy_candidates(names, names, kind="levenshtein"))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
