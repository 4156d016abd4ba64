"""Published results on small pre-aggregated tables, with the numbers written out."""

import pytest

from wavelens.plans import fixed_values as v
from wavelens.plans import gold
from wavelens.plans.reports import REPORTS

W1, W2, W3 = v.WAVES
DIST = "edicao string, variavel string, valor string, contagem long, total_respondentes long, pct_na_dimensao double"
ADOPT = "edicao string, opcao string, elegiveis long, selecionaram double, pct_adocao double, categoria string"
ENGINEER_OLD, ENGINEER, ARCHITECT = v.ROLE_MERGE["Engenharia e Arquitetura de Dados"]
MERGED = "Engenharia e Arquitetura de Dados"


def report(name, table):
    return [tuple(r) for r in REPORTS[name][1](table).collect()]


@pytest.fixture
def market(spark):
    data = [
        (W1, "cargo_atual", ENGINEER_OLD, 30, 100, 30.0), (W1, "cargo_atual", "Economista", 10, 100, 10.0),
        (W1, "cargo_atual", "Outra Opção", 60, 100, 60.0),
        (W2, "cargo_atual", ENGINEER, 25, 90, 27.8), (W2, "cargo_atual", ARCHITECT, 5, 90, 5.6), (W2, "cargo_atual", "Outra Opção", 60, 90, 66.7),
        (W3, "cargo_atual", ENGINEER, 20, 70, 28.6), (W3, "cargo_atual", ARCHITECT, 10, 70, 14.3), (W3, "cargo_atual", "Outra Opção", 40, 70, 57.1),
        (W1, "numero_de_funcionarios", "de 1 a 5", 9, 10, 90.0), (W1, "numero_de_funcionarios", v.BAD_COMPANY_SIZE, 1, 10, 10.0),
        (W3, "numero_de_funcionarios", "de 1 a 5", 10, 10, 100.0),
        (W2, "modelo_de_trabalho_atual", v.REMOTE, 45, 100, 45.7), (W2, "modelo_de_trabalho_atual", "Modelo 100% presencial", 20, 100, 16.3),
        (W2, "modelo_de_trabalho_atual", "outro", 35, 100, 38.0),
    ]
    return spark.createDataFrame(data, DIST)


def test_roles_are_merged_before_shares(market):
    assert report("cargos_estrutura_atual", market) == [("Outra Opção", 40, 57.14), (MERGED, 30, 42.86)]
    assert report("cargos_historico", market) == [(MERGED, 30.0, 33.33, 42.86, 12.86), ("Outra Opção", 60.0, 66.67, 57.14, -2.86)]
    assert report("cargos_maiores_quedas", market) == [("Outra Opção", 60.0, 66.67, 57.14, -2.86)]
    assert report("cargos_participacao_top3", market) == [(100.0,)]


def test_broken_label_is_left_out_and_absent_wave_is_null(market):
    assert report("porte_historico", market) == [("de 1 a 5", 90.0, None, 100.0, 10.0)]
    assert report("porte_atual", market) == [("de 1 a 5", 10, 100.0)]


def test_work_models_are_added_up_from_rounded_shares(market):
    assert report("modelo_trabalho_consolidado", market) == [(W2, "Com componente presencial", 54.3), (W2, "100% remoto", 45.7)]


def profile_rows(spark, cells):
    data = [(w, role, level, "faixa_salarial", band, n, 0, 0.0) for w, role, level, band, n in cells]
    return spark.createDataFrame(data, DIST.replace("variavel", "cargo_atual string, nivel string, variavel", 1))


def test_profiles_need_a_base_and_share_a_rank(spark):
    b = v.PAY_BANDS
    table = profile_rows(spark, [
        (W3, ENGINEER, "Pleno", b[4], 12), (W3, ARCHITECT, "Pleno", b[6], 12),
        (W3, "Analytics Engineer", "Pleno", b[4], 99), (W3, "Analytics Engineer", "Pleno", b[6], 101),
        (W3, "Outra Opção", "Pleno", b[12], 500), (W3, "DBA", "Pleno", b[12], 19), (W2, "DBA", "Pleno", b[12], 30),
        (W3, "DBA", "Pleno", v.BAD_PAY_BAND, 30),
    ])
    got = report("perfis_valorizados_atual", table)
    # 99 of 200 is 49.5 %, which this ranking rounds to 50.
    assert got == [
        ("Pleno", 1, "Analytics Engineer", 200, b[4], b[6], 5, 7), ("Pleno", 1, MERGED, 24, b[4], b[6], 5, 7),
    ]


def test_only_comparable_profiles_that_moved_are_kept_with_all_waves(spark):
    b, cells = v.PAY_BANDS, []
    for w, band in ((W1, b[4]), (W2, b[4]), (W3, b[5])):
        cells.append((w, "Analytics Engineer", "Pleno", band, 20))
        cells.append((w, "Cientista de Dados/Data Scientist", "Pleno", b[4], 20))
        cells.append((w, "Cientista de Dados/Data Scientist", "Sênior", band, 20 if w != W2 else 19))
    got = report("perfis_evolucao_historica", profile_rows(spark, cells))
    assert [(r[0], r[1], r[5], r[7]) for r in got] == [
        (W1, "Analytics Engineer", 5, 5), (W2, "Analytics Engineer", 5, 5), (W3, "Analytics Engineer", 6, 6)]


def gender_rows(spark, cells):
    data = [(w, g, var, val, n, 0, 0.0) for w, g, var, val, n in cells]
    return spark.createDataFrame(data, DIST.replace("variavel", "genero string, variavel", 1))


def test_gender_results(spark):
    cells = []
    for w in v.WAVES:
        cells += [(w, "Feminino", "nivel", "Especialista/Staff+", 5), (w, "Masculino", "nivel", "Júnior", 15), (w, "Feminino", "nivel", "Júnior", 5),
                  (w, "Feminino", "cor_raca_etnia", "Branca", 20), (w, "Masculino", "cor_raca_etnia", "Branca", 10),
                  (w, "Masculino", "cor_raca_etnia", "Outra", 50), (w, "Masculino", "cor_raca_etnia", "Amarela", 19)]
    cells += [(W1, "Feminino", "faixa_salarial", "odd", 1), (W1, "Feminino", "faixa_salarial", v.PAY_BANDS[1], 2), (W1, "Feminino", "faixa_salarial", v.PAY_BANDS[0], 1),
              (W1, "Masculino", "faixa_salarial", v.PAY_BANDS[0], 2)]
    table = gender_rows(spark, cells)
    assert report("composicao_genero_historica", table)[:2] == [(W1, "Masculino", 15, 25, 60.0), (W1, "Feminino", 10, 25, 40.0)]
    assert report("participacao_feminina_senioridade_historica", table)[:2] == [(W1, "Júnior", 5, 20, 25.0), (W1, "Especialista/Staff+", 5, 5, 100.0)]
    assert report("participacao_feminina_salario_historica", table) == [(W1, v.PAY_BANDS[0], 1, 3, 33.3), (W1, v.PAY_BANDS[1], 2, 2, 100.0)]
    assert report("faixas_salariais_descartadas", table) == [(W1, "odd", 1)]
    assert report("validacao_cor_raca", table)[0] == (W1, 99, 25, 74, 3.96)
    # 120 %: the answers outnumber those who stated a level.
    assert report("composicao_cor_raca_historica", table)[0] == (W1, "Branca", 30, 25, 120.0)
    assert {r[1] for r in report("participacao_feminina_cor_raca_historica", table)} == {"Branca"}
    assert report("variacao_participacao_feminina", table) == [("Branca", 66.7, 66.7, 0.0)]


def test_role_comparability_counts_waves_without_women(spark):
    cells = [(w, "Masculino", "cargo_atual", "DBA", 30) for w in v.WAVES] + [(W3, "Feminino", "cargo_atual", "DBA", 10)]
    assert report("participacao_feminina_cargo_historica", gender_rows(spark, cells)) == [(W3, "DBA", 10, 40, 25.0)]


@pytest.fixture
def technology(spark):
    data = [
        (W1, "aws", 100, 0.0, 0.0, "cloud"), (W2, "aws", 100, 40.0, 40.0, "cloud"), (W3, "aws", 100, 44.0, 44.0, "cloud"),
        (W1, "gcp", 100, 30.0, 30.0, "cloud"), (W3, "gcp", 100, 20.0, 20.0, "cloud"), (W3, "azure", 100, 20.0, 20.0, "cloud"),
        (W1, "sql", 50, 45.0, 90.0, "linguagem_de_programacao"),
    ]
    return spark.createDataFrame(data, ADOPT)


def test_technology_results(technology):
    assert report("cobertura_categorias", technology) == [
        ("cloud", "Cloud", 3, ", ".join(v.WAVES)), ("linguagem_de_programacao", "Linguagens de Programação", 1, W1)]
    assert report("cloud_historico", technology) == [
        (W1, 1, "gcp", 100, 30.0, 30.0), (W2, 1, "aws", 100, 40.0, 40.0),
        (W3, 1, "aws", 100, 44.0, 44.0), (W3, 2, "azure", 100, 20.0, 20.0), (W3, 3, "gcp", 100, 20.0, 20.0)]
    assert {r[0] for r in report("top_5_tecnologias_ultima_edicao", technology)} == {W3}
    assert report("evolucao_tecnologias_comparaveis", technology) == [
        ("cloud", "Cloud", "aws", W2, W3, 2, 40.0, 44.0, 4.0), ("cloud", "Cloud", "gcp", W1, W3, 2, 30.0, 20.0, -10.0)]
    assert report("maiores_quedas_adocao", technology) == [("cloud", "Cloud", 1, "gcp", W1, W3, 30.0, 20.0, -10.0)]


def test_personal_use_is_the_complement_of_non_use(spark):
    data = [(w, v.NO_PERSONAL_USE, 3772, n, p, "uso_pessoal_chatgpt_copilot") for w, n, p in ((W1, 744.0, 19.7), (W3, 79.0, 2.1))]
    table = spark.createDataFrame(data, ADOPT)
    assert report("ia_adocao_pessoal_historico", table) == [(W1, 3772, 744, 3028, 80.3), (W3, 3772, 79, 3693, 97.9)]
    assert report("ia_adocao_pessoal_comparativo", table) == [(80.3, None, 97.9, 17.6)]


def test_challenges(spark):
    data = [(w, f"o{i}", 10, float(i), 10.0 * i + (w == W3), "desafios_como_gestor") for i in range(7) for w in (W2, W3)]
    table = spark.createDataFrame(data + [(W3, "new", 10, 1.0, 10.0, "desafios_como_gestor")], ADOPT)
    assert [r[1:3] for r in report("sintese_executiva", table)] == [(1, "o6"), (2, "o5"), (3, "o4"), (4, "o3"), (5, "o2")]
    assert len(report("cenario_atual", table)) == 8
    evolution = report("evolucao_2024_2026", table)
    assert len(evolution) == 7 and {r[4] for r in evolution} == {1.0}


def test_pay_label_off_the_scale_stops_the_job(spark):
    schema = DIST.replace("variavel", "regiao_onde_mora string, nivel string, modelo_de_trabalho_atual string, variavel", 1)
    good = (W2, "Sul", "Pleno", v.REMOTE, "faixa_salarial", v.PAY_BANDS[3], 10, 10, 100.0)
    table = spark.createDataFrame([good], schema)
    assert report("salario_por_modelo_trabalho", table) == [(W2, "100% remoto", 10, v.PAY_BANDS[3], v.PAY_BANDS[3], 4, 4, 1, "Amostra pequena (<30)")]
    assert report("senioridade_x_regiao", table)[0][:5] == (W2, "Pleno", 2, "Sul", 10)
    bad = spark.createDataFrame([good, (W2, "Sul", "Pleno", v.REMOTE, "faixa_salarial", "odd", 1, 11, 9.0)], schema)
    with pytest.raises(Exception, match="off the scale: odd"):
        report("salario_por_regiao", bad)


def test_gold_tables_skip_what_the_survey_did_not_ask(spark):
    silver = spark.createDataFrame([(W1, "Júnior", "1", None), (W1, "Pleno", "0", None)],
                                   "edicao string, nivel string, cloud_dia_a_dia_aws string, cloud_dia_a_dia_gcp string")
    assert {r["valor"] for r in gold.market_structure(silver).collect()} == {"Júnior", "Pleno"}
    with pytest.warns(UserWarning):
        adopted = gold.technology_adoption(silver)
    assert sorted(tuple(r) for r in adopted.collect()) == [(W1, "aws", 2, 1.0, 50.0, "cloud"), (W1, "gcp", 2, 0.0, 0.0, "cloud")]
    assert adopted.columns == ["edicao", "opcao", "elegiveis", "selecionaram", "pct_adocao", "categoria"]


def test_mixed_table_without_the_priority_question(spark):
    silver = spark.createDataFrame([(W1, "1")], "edicao string, usa_chatgpt_ou_copilot_no_trabalho_x string")
    with pytest.warns(UserWarning):
        assert "valor" not in gold.ai_adoption(silver).columns
    full = silver.selectExpr("*", f"'Não sei' AS {v.AI_PRIORITY_VARIABLE}")
    with pytest.warns(UserWarning):
        mixed = gold.ai_adoption(full)
    assert sorted(r["categoria"] for r in mixed.collect()) == [v.AI_PRIORITY_CATEGORY, "uso_pessoal_chatgpt_copilot"]


def test_tables_have_the_stated_schemas(spark):
    from wavelens import testviews as tv

    for name, build in gold.TABLES.items():
        source = tv.survey if "adocao" in name or "oportunidades" in name else tv.people
        table = build(source(spark, "/root/testdata/sf0.001"))
        assert ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table.schema) == gold.SCHEMAS[name]
