"""Raw files of three waves through every step to the published results."""

import csv

import pytest

from wavelens.plans import fixed_values as v
from wavelens.plans import flow

ROLES = ["Analista de Dados/Data Analyst", "Analytics Engineer"]
BAND = v.PAY_BANDS


def write_csv(path, header, rows):
    with open(path, "w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out)
        writer.writerow(header)
        writer.writerows(rows)


def answers(n, wave):
    """Respondents with a level, pay band, gender and two database options."""
    for i in range(n):
        yield [
            ROLES[i % 2], v.LEVELS[i % 3], BAND[min(12, i % 6 + (2 if wave == v.LAST_WAVE else 0))],
            "Feminino" if i % 4 == 0 else "Masculino", "Branca", "Sudeste",
            "x" if i % 5 else "", "1" if i % 5 and i % 2 else ("0" if i % 5 else ""), "1" if i % 5 else "",
        ]


LABELS = ["Cargo Atual", "Nível", "Faixa Salarial", "Gênero", "Cor/Raça/Etnia", "Região onde mora",
          "Banco de Dados (dia a dia)", "PostgreSQL", "SQLite"]
CODES = ["2.f", "2.g", "2.h", "1.b", "1.c", "1.i", "4.g", "4.g.1", "4.g.2"]


@pytest.fixture(scope="module")
def layout(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("flow")
    layout = flow.Layout(str(root / "lake"))
    for wave in v.WAVES:
        labels = list(LABELS)
        if wave == v.LAST_WAVE:
            labels[5] = "Região onde moraa"
        if v.HEADER_STYLE[wave] == "tuple":
            header = [f"('P{c.replace('.', '_')} ', '{x}')" for c, x in zip(CODES, labels, strict=True)]
        else:
            header = [f"{c}_{x}" for c, x in zip(CODES, labels, strict=True)]
        raw = root / f"{wave}.csv"
        write_csv(raw, [*header, "('P9_z ', 'Só aqui')" if wave == v.FIRST_WAVE else "9.y_Comum"],
                  [[*row, f"quebra\n{i}"] for i, row in enumerate(answers(60, wave))])
        flow.stage_wave(spark, layout, wave, str(raw))
    flow.document_nulls(spark, layout)
    flow.match_columns(spark, layout)
    flow.build_silver(spark, layout, table="flow_silver")
    spark.sql("CREATE DATABASE IF NOT EXISTS flow_db")
    with pytest.warns(UserWarning):
        flow.build_gold(spark, layout, "flow_db")
    return layout


def test_staged_names(spark, layout):
    staged = spark.read.parquet(layout.staging(v.FIRST_WAVE))
    assert set(staged.columns) == {
        "cargo_atual", "nivel", "faixa_salarial", "genero", "cor_raca_etnia", "regiao_onde_mora",
        "banco_de_dados_dia_a_dia_postgresql", "banco_de_dados_dia_a_dia_sqlite", "so_aqui"}
    assert staged.count() == 60


def test_dictionaries(spark, layout):
    nulls = spark.read.option("header", True).csv(layout.document("null_dictionary"))
    options = nulls.filter("type = 'binary_multiselect'")
    assert options.count() == 6 and {r["pct_null"] for r in options.collect()} == {"20.0"}
    names = spark.read.option("header", True).csv(layout.document("column_dictionary"))
    found = {r["base"]: (r[f"method_{v.LAST_WAVE}"], r[f"name_{v.LAST_WAVE}"]) for r in names.collect()}
    assert found["regiao_onde_mora"] == ("fuzzy", "regiao_onde_moraa")
    assert found["nivel"] == ("exact", "nivel")


def test_silver_has_one_partition_per_wave_and_nulls_for_missing_columns(spark, layout):
    silver = flow.read_silver(spark, layout)
    assert {tuple(r) for r in silver.groupBy("edicao").count().collect()} == {(w, 60) for w in v.WAVES}
    assert silver.filter("edicao <> '2023-2024' AND so_aqui IS NOT NULL").count() == 0
    assert silver.filter("regiao_onde_mora IS NULL").count() == 0
    assert silver.select("edicao", flow.ROW_ID).distinct().count() == 180
    assert spark.table("flow_silver").filter("particao = '2024-2025'").count() == 60


def test_a_rejected_match_is_not_used(spark, layout):
    names = spark.read.option("header", True).csv(layout.document("column_dictionary"))
    reviewed = names.selectExpr(
        "*", f"CASE WHEN base = 'regiao_onde_mora' THEN 'rejected' END AS `review_{v.LAST_WAVE}`")
    path = layout.document("reviewed")
    flow.writers.export_csv(reviewed, path)
    other = flow.Layout(layout.root + "/again")
    for wave in v.WAVES:
        flow.writers.write_table(spark.read.parquet(layout.staging(wave)), other.staging(wave))
    flow.build_silver(spark, other, dictionary=path)
    last = flow.read_silver(spark, other).filter(f"edicao = '{v.LAST_WAVE}'")
    assert last.filter("regiao_onde_mora IS NOT NULL").count() == 0


def test_gold_and_results(spark, layout):
    assert spark.table("flow_db.gold_04_adocao_tecnologias").count() == 6
    used = spark.read.parquet(layout.gold("gold_04_adocao_tecnologias")).filter("opcao = 'sqlite'").collect()
    assert {(r["elegiveis"], r["pct_adocao"]) for r in used} == {(48, 100.0)}
    from wavelens.plans.reports import REPORTS

    for name in ("nivel_atual", "participacao_feminina_senioridade_historica", "perfis_valorizados_atual"):
        table, query = REPORTS[name]
        flow.writers.export_csv(query(spark.read.parquet(layout.gold(table))), layout.result(name))
    levels = spark.read.option("header", True).csv(layout.result("nivel_atual")).collect()
    assert [tuple(r) for r in levels] == [("Júnior", "20", "33.3"), ("Pleno", "20", "33.3"), ("Sênior", "20", "33.3")]
    ranked = spark.read.option("header", True).csv(layout.result("perfis_valorizados_atual"))
    assert ranked.count() == 0


def test_jobs_over_all_columns_use_no_method_too_long_to_compile(spark, tmp_path, monkeypatch):
    from wavelens.plans import gold_once, increment
    from wavelens.session import METHOD_CONF

    before, seen = spark.conf.get(METHOD_CONF), {}

    def noting(module, name):
        run = getattr(module, name)

        def noted(df, *args, **kwargs):
            seen.setdefault(args[0].split("/")[-1], set()).add(spark.conf.get(METHOD_CONF))
            return run(df, *args, **kwargs)

        monkeypatch.setattr(module, name, noted)

    noting(increment.writers, "write_table")
    noting(increment.writers, "write_wave")
    noting(gold_once, "stored")
    raw = tmp_path / "raw.csv"
    raw.write_text("2.f_Cargo Atual,2.g_Nível\nnão,Pleno\nnÃ£o,Júnior\n,\n", encoding="utf-8")
    layout = increment.Layout(str(tmp_path / "lake"))
    increment.update(spark, layout, {"2024-2025": str(raw)}, styles={"2024-2025": "dotted"}, aliases={})
    assert {k: seen[k] for k in ("2024-2025", "silver", "all-counts")} == dict.fromkeys(("2024-2025", "silver", "all-counts"), {"8000"})
    assert spark.conf.get(METHOD_CONF) == before != "8000"
    rows = spark.read.parquet(layout.silver).collect()
    assert sorted((r["cargo_atual"] or "", r["nivel"] or "") for r in rows) == [("", ""), ("não", "Júnior"), ("não", "Pleno")]
