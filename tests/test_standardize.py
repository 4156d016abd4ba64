import pytest

from wavelens.functions.text import lit_col
from wavelens.operators import profile as pr
from wavelens.operators import standardize as st
from wavelens.session import scratch_path, shared_dir
from wavelens.sources import readers, writers

HEADER = ["1.a_Faixa/Idade (anos)", "2.l_Critérios", "2.l.1_Salário", "2.l.2_Remoto", "2.l.3_Outro", "3.f_IA", "3.f.1_Não uso", "4.l_IA", "4.l.1_Não uso"]
RAW = [
    ("25-29", "Salário", "1", "0", "texto", None, None, "Não uso", "1"),
    ("30-34", "Salário, Remoto", "1", "1", None, "Não uso", "1", None, None),
    (None, None, None, None, None, None, None, None, None),
]


@pytest.fixture
def raw(spark):
    return spark.createDataFrame(RAW, ", ".join(f"c{i} string" for i in range(9))).toDF(*HEADER)


def test_standardise(raw, rows):
    got = st.standardize(raw, aliases=[("3.f", "4.l")])
    assert got.columns == ["faixa_idade_anos", "criterios_salario", "criterios_remoto", "outro", "ia_nao_uso"]
    assert rows(got) == sorted([("25-29", "1", "0", "texto", "1"), ("30-34", "1", "1", None, "1"), (None,) * 5], key=repr)


def test_without_alias_the_same_name_twice_is_an_error(raw):
    with pytest.raises(ValueError, match="ia_nao_uso"):
        st.standardize(raw)


def test_lone_member_of_an_alias_and_corrections(raw):
    got = st.standardize(raw.drop("3.f_IA", "3.f.1_Não uso"), aliases=[("3.f", "4.l")], corrections={"2.l.3_Outro": "Texto/livre"})
    assert got.columns == ["faixa_idade_anos", "criterios_salario", "criterios_remoto", "texto_livre", "ia_nao_uso"]


def test_two_columns_normalising_alike_collide(spark):
    with pytest.raises(ValueError, match="a_b"):
        st.standardize(spark.createDataFrame([("x", "y")], ["1.a_A/B", "1.b_á b"]))


def test_tuple_headers(spark, rows):
    df = spark.createDataFrame([("20", "x", "1", "0")], ["('P1_a ', 'Idade')", "('P4_l ', 'IA')", "('P4_l_1 ', 'Não uso')", "broken ('x"])
    got = st.standardize(df, "tuple", fixes={"broken ('x": ("P4_l_2", "Uso")})
    assert got.columns == ["idade", "ia_nao_uso", "ia_uso"] and rows(got) == [("20", "1", "0")]


def test_the_last_of_two_parents_with_one_code_counts(spark, rows):
    df = spark.createDataFrame([("x", "y", "1")], ["2.l_Velho", "2.l_Novo", "2.l.1_A"])
    got = st.standardize(df)
    assert got.columns == ["velho", "novo_a"] and rows(got) == [("x", "1")]


def test_all_null_candidate_is_no_option(spark):
    df = spark.createDataFrame([(None, "1")], "a string, b string").toDF("2.l_P", "2.l.1_Q")
    df = df.withColumn("2.l.2_R", lit_col("2.l_P"))
    assert set(st.standardize(df).columns) == {"p_q", "r"}


def test_raw_csv_with_line_breaks_quotes_and_damage(spark, tmp_path, rows):
    path = tmp_path / "wave.csv"
    text = "1.a_Situação,1.b_Texto\n".encode().decode("latin-1") + '"linha 1\nlinha ""2""",' + "não".encode().decode("latin-1") + "\nplain,já certo\n"
    path.write_text(text, encoding="utf-8")
    wave = readers.read_wave(spark, str(path))
    assert wave.columns == ["1.a_Situação", "1.b_Texto"]
    assert rows(wave) == [('linha 1\nlinha "2"', "não"), ("plain", "já certo")]
    assert st.standardize(wave).columns == ["situacao", "texto"]


def test_conform_and_harmonize(spark, rows):
    a = spark.createDataFrame([("x", 1)], "p string, n int")
    b = spark.createDataFrame([("y",)], "q string")
    mapping = spark.createDataFrame([("w1", "papel", "p"), ("w1", "num", "n"), ("w2", "papel", "q"), ("w2", "lost", "gone")],
                                    "wave string, canonical string, source string")
    got = st.harmonize({"w1": a, "w2": b}, mapping)
    assert got.columns == ["lost", "num", "papel", "edition"]
    assert {f.dataType.simpleString() for f in got.schema} == {"string"}
    assert rows(got) == [(None, "1", "x", "w1"), (None, None, "y", "w2")]


def test_row_id_is_unique(spark):
    df = st.with_row_id(spark.range(100).repartition(7))
    assert df.select("source_row").distinct().count() == 100 and df.columns[0] == "source_row"


def test_null_dictionary(spark):
    rows = [("1", "a", None)] * 19 + [(None, None, None)]
    df = spark.createDataFrame(rows, "flag string, `odd.name` string, empty string")
    got = {r["column"]: (r["type"], r["pct_null"], r["null_meaning"]) for r in pr.null_dictionary(df, "w").collect()}
    assert got == {
        "flag": ("binary_multiselect", 5.0, "group_not_shown"),
        "odd.name": ("single_choice", 5.0, "near_universal"),
        "empty": ("single_choice", 100.0, "conditional_on_profile"),
    }
    nothing = pr.null_dictionary(df.limit(0), "w").collect()
    assert {r["pct_null"] for r in nothing} == {0.0}


def test_profiles(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 1), (None, 2)], "x string, n int")
    assert rows(pr.frequency_profile(df)) == sorted([("n", "1", 2), ("n", "2", 1), ("x", "a", 2), ("x", None, 1)], key=repr)
    assert rows(pr.distinct_profile(df)) == [("n", 2), ("x", 1)]
    assert rows(pr.distinct_profile(df, approx=True)) == [("n", 2), ("x", 1)]
    assert rows(pr.duplicate_count(df)) == [(3, 2, 1)]
    assert rows(pr.duplicate_count(df.limit(0))) == [(0, 0, 0)]
    assert rows(pr.binary_columns(df, ["x", "n"])) == [("n", False), ("x", False)]


def test_require_source(spark, tmp_path):
    for name in ("gold_1", "gold_2", "empty"):
        (tmp_path / name).mkdir()
    for name in ("gold_1", "gold_2"):
        (tmp_path / name / "part-0.csv").write_text("a")
        (tmp_path / name / "part-1.csv").write_text("a")
    assert readers.require_source(spark, f"{tmp_path}/gold_1*").endswith("gold_1")
    with pytest.raises(ValueError, match="several folders"):
        readers.require_source(spark, f"{tmp_path}/gold_*")
    with pytest.raises(FileNotFoundError):
        readers.require_source(spark, f"{tmp_path}/empty")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.require_source(spark, f"{tmp_path}/none_*")


def test_gold_csv_is_matched_by_header(spark, tmp_path, rows):
    path = str(tmp_path / "gold")
    writers.export_csv(spark.createDataFrame([("w", 2, 1.5)], "edition string, n long, pct double"), path)
    assert rows(readers.read_gold(spark, path, "edition string, n bigint, pct double")) == [("w", 2, 1.5)]
    with pytest.raises(Exception, match="header"):
        readers.read_gold(spark, path, "n bigint, edition string, pct double").collect()


def test_one_wave_is_replaced_and_others_stay(spark, tmp_path, rows):
    path = str(tmp_path / "silver")
    for wave, n in (("w1", 1), ("w2", 2), ("w1", 3)):
        writers.write_wave(spark.createDataFrame([(n,)], "n int"), path, wave)
    assert rows(spark.read.parquet(path), "edition", "n") == [("w1", 3), ("w2", 2)]


def test_registering_twice_updates_the_schema(spark, tmp_path, rows):
    path = str(tmp_path / "table")
    for columns in ("a int", "a int, `b c` string"):
        df = spark.createDataFrame([(1,) if columns == "a int" else (1, "x")], columns)
        writers.write_table(df, path)
        writers.register_table(df, "registered_twice", path)
    assert rows(spark.table("registered_twice")) == [(1, "x")]
    parts = str(tmp_path / "parts")
    df = spark.createDataFrame([(1, "2023"), (2, "2024")], "n int, edition string")
    df.write.partitionBy("edition").parquet(parts)
    for _ in range(2):
        writers.register_table(df, "registered_parts", parts, ["edition"])
    waves = readers.read_waves(spark, "registered_parts", "edition", "edicao")
    assert rows(waves) == [(1, "2023"), (2, "2024")] and waves.columns[-1] == "edicao"


def test_dictionary_without_review_column(spark, tmp_path):
    path = str(tmp_path / "dictionary")
    writers.export_csv(spark.createDataFrame([("a", "b", 0.9)], "base string, name_w string, score_w double"), path)
    row = readers.read_dictionary(spark, path, "base", ["w"]).first()
    assert row["score_w"] == 0.9 and row["review_w"] is None


def test_shared_folder_is_the_one_of_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
