"""The pre-aggregated tables and every published result, on the survey-shaped views."""

from __future__ import annotations

from collections.abc import Sequence

from wavelens import testviews as tv
from wavelens.plans import fixed_values as v
from wavelens.plans import gold
from wavelens.plans.reports import REPORTS, needs
from wavelens.registry.core import adoption_sql, dist_sql, quantile_sql, register
from wavelens.session import stored

W1, W2, W3 = v.WAVES


def quoted(values: Sequence[str]) -> str:
    return ", ".join("'" + x.replace("'", "''") + "'" for x in values)


def case(col: str, names: dict[str, str]) -> str:
    whens = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in names.items())
    return f"CASE {col} {whens} ELSE {col} END"


def position(col: str, scale: Sequence[str]) -> str:
    return "CASE " + col + " " + " ".join(f"WHEN '{x}' THEN {i}" for i, x in enumerate(scale, 1)) + " END"


def label(col: str) -> str:
    return f"CASE {col} " + " ".join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(v.PAY_BANDS, 1)) + " END"


def dist_table(variables: Sequence[str], dims: Sequence[str]) -> str:
    return (
        f"SELECT {', '.join(dims)}, variable AS variavel, value AS valor, n AS contagem, base AS total_respondentes, "
        f"pct AS pct_na_dimensao FROM ({dist_sql('people', variables, dims)}) d"
    )


def adoption_table(prefixes: dict[str, str]) -> str:
    groups = {
        category: {c: c[len(prefix):] for c in tv.OPTION_COLUMNS if c.startswith(prefix)}
        for category, prefix in prefixes.items()
    }
    return (
        "SELECT edicao, option AS opcao, eligible AS elegiveis, selected AS selecionaram, pct AS pct_adocao, "
        f"category AS categoria FROM ({adoption_sql('survey', groups, ['edicao'])}) a"
    )


GOLD_SQL = {
    "gold_01_estrutura_mercado": dist_table(v.MARKET_VARIABLES, ["edicao"]),
    "gold_02_perfis_valorizados": dist_table(["faixa_salarial"], ["edicao", "cargo_atual", "nivel"]),
    "gold_03_diversidade_genero": dist_table(v.GENDER_VARIABLES, ["edicao", "genero"]),
    "gold_04_adocao_tecnologias": adoption_table(v.TECHNOLOGY_GROUPS),
    "gold_05_adocao_ia": f"""
SELECT edicao, variavel AS variavel_original, valor, contagem, total_respondentes, pct_na_dimensao,
 '{v.AI_PRIORITY_CATEGORY}' AS categoria, CAST(NULL AS VARCHAR) AS opcao, CAST(NULL AS BIGINT) AS elegiveis,
 CAST(NULL AS DOUBLE) AS selecionaram, CAST(NULL AS DOUBLE) AS pct_adocao FROM ({dist_table([v.AI_PRIORITY_VARIABLE], ['edicao'])}) p
UNION ALL SELECT edicao, NULL, NULL, NULL, NULL, NULL, categoria, opcao, elegiveis, selecionaram, pct_adocao
FROM ({adoption_table(v.AI_GROUPS)}) u""",
    "gold_06_diferencas_regiao_senioridade_modelo": dist_table(
        ["faixa_salarial"], ["edicao", "regiao_onde_mora", "nivel", "modelo_de_trabalho_atual"]),
    "gold_07_oportunidades_desafios": adoption_table(v.CHALLENGE_GROUPS),
}


def wide(value: str, waves: Sequence[str]) -> str:
    return ", ".join(f"max(CASE WHEN edicao = '{w}' THEN {value} END) AS \"{w}\"" for w in waves)


def history(source: str, key: str, value: str, waves: Sequence[str], scale: int, delta: str) -> str:
    keys = f"{key}, " if key else ""
    group = f" GROUP BY {key}" if key else ""
    return (
        f"SELECT *, round(\"{waves[-1]}\" - \"{waves[0]}\", {scale}) AS {delta} FROM ("
        f"SELECT {keys}{wide(value, waves)} FROM ({source}) h WHERE edicao IN ({quoted(waves)}){group}) w"
    )


ROLE = f"CASE WHEN {{0}} IN ({quoted(v.ROLE_MERGE['Engenharia e Arquitetura de Dados'])}) THEN 'Engenharia e Arquitetura de Dados' ELSE {{0}} END"
ROLES = f"""SELECT edicao, cargo_harmonizado, contagem, round(CAST(contagem AS DOUBLE) / sum(contagem) OVER (PARTITION BY edicao) * 100, 2) AS pct_na_dimensao
 FROM (SELECT edicao, {ROLE.format('valor')} AS cargo_harmonizado, CAST(sum(contagem) AS BIGINT) AS contagem FROM g WHERE variavel = 'cargo_atual' GROUP BY 1, 2) c"""
ROLES_HISTORY = f"SELECT * FROM ({history(ROLES, 'cargo_harmonizado', 'pct_na_dimensao', v.WAVES, 2, 'variacao_pp')}) r WHERE \"{W1}\" IS NOT NULL AND \"{W2}\" IS NOT NULL AND \"{W3}\" IS NOT NULL"
ROLES_NOW = f"SELECT cargo_harmonizado, contagem, pct_na_dimensao FROM ({ROLES}) r WHERE edicao = '{W3}'"


def now(variable: str, without: str = "") -> str:
    skip = f" AND valor <> '{without}'" if without else ""
    return f"SELECT valor, contagem, pct_na_dimensao FROM g WHERE variavel = '{variable}' AND edicao = '{W3}'{skip}"


def past(variable: str, waves: Sequence[str], without: str = "") -> str:
    skip = f" AND valor <> '{without}'" if without else ""
    rows = f"SELECT * FROM g WHERE variavel = '{variable}'{skip}"
    return history(rows, "valor", "pct_na_dimensao", waves, 2, "variacao_pp")


_LAST_TWO = [W2, W3]
SQL: dict[str, str] = {
    "cargos_estrutura_atual": ROLES_NOW,
    "cargos_historico": ROLES_HISTORY,
    "cargos_maiores_crescimentos": f"SELECT * FROM ({ROLES_HISTORY}) x WHERE variacao_pp > 0",
    "cargos_maiores_quedas": f"SELECT * FROM ({ROLES_HISTORY}) x WHERE variacao_pp < 0",
    "cargos_participacao_top3": f"SELECT round(sum(pct_na_dimensao), 2) AS participacao_top3 FROM (SELECT * FROM ({ROLES_NOW}) n ORDER BY pct_na_dimensao DESC, cargo_harmonizado LIMIT 3) t",
    "setor_participacao_top2": f"SELECT round(sum(pct_na_dimensao), 2) AS participacao_top2 FROM (SELECT * FROM ({now('setor')}) n ORDER BY pct_na_dimensao DESC, valor LIMIT 2) t",
    "nivel_experiente_atual": f"SELECT round(sum(pct_na_dimensao), 2) AS pct_senior_staff FROM ({now('nivel')}) n WHERE valor IN ('Sênior', 'Especialista/Staff+')",
    "nivel_atual": now("nivel"),
    "nivel_historico": past("nivel", [W1, W2]),
    "setor_atual": now("setor"),
    "setor_historico": past("setor", v.WAVES),
    "modelo_trabalho_atual": now("modelo_de_trabalho_atual"),
    "modelo_trabalho_historico": past("modelo_de_trabalho_atual", _LAST_TWO),
    "modelo_trabalho_consolidado": f"""SELECT edicao, CASE WHEN valor = '{v.REMOTE}' THEN '100% remoto' ELSE 'Com componente presencial' END AS grupo_modelo,
 round(sum(pct_na_dimensao), 2) AS pct_na_dimensao FROM g WHERE variavel = 'modelo_de_trabalho_atual' GROUP BY 1, 2""",
    "regiao_historico": past("regiao_onde_mora", v.WAVES),
    "situacao_trabalho_historico": past("situacao_de_trabalho", _LAST_TWO),
    "porte_historico": past("numero_de_funcionarios", v.WAVES, v.BAD_COMPANY_SIZE),
    "porte_atual": now("numero_de_funcionarios", v.BAD_COMPANY_SIZE),
}

# --- valued profiles: the scale position of a label off the scale is 0, below the first band

PROFILES = f"""p AS (SELECT edicao, {ROLE.format('cargo_atual')} AS cargo_harmonizado, nivel, coalesce({position('valor', v.PAY_BANDS)}, 0) AS pos, contagem
 FROM g WHERE valor <> '{v.BAD_PAY_BAND}')"""


def profile_bands(basis: str) -> str:
    return quantile_sql("p", ["edicao", "cargo_harmonizado", "nivel"], "pos", "contagem", basis, "total_respondentes")


SQL["perfis_valorizados_atual"] = f"""WITH {PROFILES}, b AS ({profile_bands('round0')})
SELECT nivel, CAST(dense_rank() OVER (PARTITION BY nivel ORDER BY p50 DESC, p75 DESC) AS INTEGER) AS ranking, cargo_harmonizado, total_respondentes,
 {label('p50')} AS faixa_salarial_mediana, {label('p75')} AS faixa_salarial_p75, p50 AS ordem_faixa_mediana, p75 AS ordem_faixa_p75
FROM b WHERE edicao = '{W3}' AND total_respondentes >= 20 AND cargo_harmonizado <> 'Outra Opção'"""
SQL["perfis_evolucao_historica"] = f"""WITH {PROFILES}, b AS (SELECT * FROM ({profile_bands('round2')}) q WHERE cargo_harmonizado IN ({quoted(v.HISTORY_ROLES)}) AND nivel IN ({quoted(v.HISTORY_LEVELS)})),
 k AS (SELECT cargo_harmonizado, nivel FROM b GROUP BY 1, 2 HAVING count(DISTINCT edicao) = 3 AND min(total_respondentes) >= 20),
 m AS (SELECT x.cargo_harmonizado, x.nivel FROM b x JOIN b y ON x.cargo_harmonizado = y.cargo_harmonizado AND x.nivel = y.nivel
   WHERE x.edicao = '{W1}' AND y.edicao = '{W3}' AND (x.p50 <> y.p50 OR x.p75 <> y.p75))
SELECT edicao, cargo_harmonizado, nivel, total_respondentes, {label('p50')} AS faixa_p50, p50 AS ordem_faixa_p50, {label('p75')} AS faixa_p75, p75 AS ordem_faixa_p75
FROM b JOIN k USING (cargo_harmonizado, nivel) JOIN m USING (cargo_harmonizado, nivel)"""

# --- gender

SQL["composicao_genero_historica"] = """SELECT edicao, genero, respondentes, CAST(sum(respondentes) OVER (PARTITION BY edicao) AS BIGINT) AS total_edicao,
 round(CAST(respondentes AS DOUBLE) / sum(respondentes) OVER (PARTITION BY edicao) * 100, 1) AS pct_geral
FROM (SELECT edicao, genero, CAST(sum(contagem) AS BIGINT) AS respondentes FROM g WHERE variavel = 'nivel' GROUP BY 1, 2) c"""


def women(variable: str, key: str, name: str, total: str) -> str:
    """Every gender's share by a window, then the women."""
    return f"""SELECT edicao, {name}, contagem AS mulheres, {total}, pct AS pct_feminino FROM (
 SELECT *, CAST(sum(contagem) OVER (PARTITION BY edicao, {name}) AS BIGINT) AS {total},
  round(CAST(contagem AS DOUBLE) / sum(contagem) OVER (PARTITION BY edicao, {name}) * 100, 1) AS pct
 FROM (SELECT edicao, {key} AS {name}, genero, CAST(sum(contagem) AS BIGINT) AS contagem FROM g WHERE variavel = '{variable}' GROUP BY 1, 2, 3) c) s WHERE genero = 'Feminino'"""


SQL["participacao_feminina_senioridade_historica"] = women("nivel", "valor", "nivel", "total_nivel")
SQL["participacao_feminina_cargo_historica"] = f"""WITH s AS (SELECT edicao, {ROLE.format('valor')} AS cargo, sum(contagem) AS n FROM g WHERE variavel = 'cargo_atual' GROUP BY 1, 2)
SELECT * FROM ({women('cargo_atual', ROLE.format('valor'), 'cargo_harmonizado', 'total_cargo')}) w WHERE cargo_harmonizado IN (
 SELECT cargo FROM s WHERE cargo <> 'Outra Opção' GROUP BY cargo HAVING count(DISTINCT edicao) = 3 AND min(n) >= 20)"""
SQL["participacao_feminina_salario_historica"] = f"SELECT * FROM ({women('faixa_salarial', 'valor', 'faixa_salarial', 'total_faixa')}) w WHERE total_faixa > 1"
SQL["faixas_salariais_descartadas"] = "SELECT edicao, valor AS faixa_salarial, CAST(sum(contagem) AS BIGINT) AS total_faixa FROM g WHERE variavel = 'faixa_salarial' GROUP BY 1, 2 HAVING sum(contagem) <= 1"
STATED = "(SELECT edicao, CAST(sum(contagem) AS BIGINT) AS total_respondentes FROM g WHERE variavel = 'nivel' GROUP BY 1)"
SQL["validacao_cor_raca"] = f"""SELECT m.edicao, total_marcacoes, total_respondentes, total_marcacoes - total_respondentes AS diferenca,
 round(CAST(total_marcacoes AS DOUBLE) / total_respondentes, 2) AS marcacoes_por_respondente
FROM (SELECT edicao, CAST(sum(contagem) AS BIGINT) AS total_marcacoes FROM g WHERE variavel = 'cor_raca_etnia' GROUP BY 1) m LEFT JOIN {STATED} t ON m.edicao = t.edicao"""
RACE = "r AS (SELECT edicao, valor AS cor_raca_etnia, CAST(sum(contagem) AS BIGINT) AS respondentes FROM g WHERE variavel = 'cor_raca_etnia' GROUP BY 1, 2)"
RACE_KEYS = "(SELECT cor_raca_etnia FROM r WHERE cor_raca_etnia NOT IN ('Prefiro não informar', 'Outra') GROUP BY 1 HAVING count(DISTINCT edicao) = 3 AND min(respondentes) >= 20)"
PRESENCE = f"""SELECT r.edicao, cor_raca_etnia, respondentes, total_respondentes, round(CAST(respondentes AS DOUBLE) / total_respondentes * 100, 1) AS pct_respondentes
 FROM r JOIN {STATED} t ON r.edicao = t.edicao WHERE cor_raca_etnia IN {RACE_KEYS}"""
WOMEN_RACE = f"SELECT * FROM ({women('cor_raca_etnia', 'valor', 'cor_raca_etnia', 'total_cor_raca')}) w WHERE cor_raca_etnia IN {RACE_KEYS}"


def variation(rows: str, value: str, name: str) -> str:
    return (
        f"WITH {RACE} SELECT cor_raca_etnia, \"{W1}\" AS {name}_2023_2024, \"{W3}\" AS {name}_2025_2026, variacao_pp "
        f"FROM ({history(rows, 'cor_raca_etnia', value, [W1, W3], 1, 'variacao_pp')}) v"
    )


SQL["composicao_cor_raca_historica"] = f"WITH {RACE} {PRESENCE}"
SQL["variacao_composicao_cor_raca"] = variation(PRESENCE, "pct_respondentes", "pct")
SQL["participacao_feminina_cor_raca_historica"] = f"WITH {RACE} {WOMEN_RACE}"
SQL["variacao_participacao_feminina"] = variation(WOMEN_RACE, "pct_feminino", "pct_feminino")

# --- technology

ADOPTED = f"(SELECT *, {case('categoria', v.CATEGORY_NAMES)} AS categoria_nome FROM g WHERE pct_adocao > 0)"
RANKING = f"""SELECT edicao, categoria, categoria_nome, CAST(row_number() OVER (PARTITION BY edicao, categoria ORDER BY pct_adocao DESC, selecionaram DESC, opcao) AS INTEGER) AS ranking,
 opcao, elegiveis, selecionaram, pct_adocao FROM {ADOPTED} a"""
SQL["cobertura_categorias"] = f"SELECT categoria, categoria_nome, count(DISTINCT edicao) AS qtd_edicoes, string_agg(DISTINCT edicao, ', ' ORDER BY edicao) AS edicoes FROM {ADOPTED} a GROUP BY 1, 2"
SQL["ranking_adocao_por_categoria"] = RANKING
SQL["top_5_tecnologias_ultima_edicao"] = f"SELECT * FROM ({RANKING}) r WHERE ranking <= 5 AND edicao = (SELECT max(edicao) FROM g)"
for _name, _category in {
    "linguagens_programacao_historico": "linguagem_de_programacao",
    "ferramentas_bi_historico": "ferramenta_de_bi",
    "cloud_historico": "cloud",
    "bancos_dados_historico": "banco_de_dados",
    "etl_data_engineer_historico": "ferramenta_etl_data_engineer",
    "etl_data_analyst_historico": "ferramenta_etl_data_analyst",
    "linguagem_preferida_2025_2026": "linguagem_preferida_2025_2026",
}.items():
    SQL[_name] = f"SELECT edicao, ranking, opcao, elegiveis, selecionaram, pct_adocao FROM ({RANKING}) r WHERE categoria = '{_category}'"
EVOLUTION = f"""SELECT f.categoria, f.categoria_nome, f.opcao, f.edicao AS primeira_edicao, l.edicao AS ultima_edicao, qtd_edicoes, f.pct_adocao AS pct_inicio,
 l.pct_adocao AS pct_fim, round(l.pct_adocao - f.pct_adocao, 1) AS variacao_pp
FROM (SELECT categoria, opcao, min(edicao) AS lo, max(edicao) AS hi, count(DISTINCT edicao) AS qtd_edicoes FROM {ADOPTED} a GROUP BY 1, 2 HAVING count(DISTINCT edicao) >= 2) k
JOIN {ADOPTED} f ON f.categoria = k.categoria AND f.opcao = k.opcao AND f.edicao = lo
JOIN {ADOPTED} l ON l.categoria = k.categoria AND l.opcao = k.opcao AND l.edicao = hi"""
SQL["evolucao_tecnologias_comparaveis"] = EVOLUTION
for _name, _rank, _sign, _dir in (("maiores_crescimentos_adocao", "ranking_crescimento", ">", "DESC"), ("maiores_quedas_adocao", "ranking_queda", "<", "ASC")):
    SQL[_name] = f"""SELECT categoria, categoria_nome, {_rank}, opcao, primeira_edicao, ultima_edicao, pct_inicio, pct_fim, variacao_pp FROM (
 SELECT *, CAST(row_number() OVER (PARTITION BY categoria ORDER BY variacao_pp {_dir}, opcao) AS INTEGER) AS {_rank} FROM ({EVOLUTION}) e WHERE variacao_pp {_sign} 0) t WHERE {_rank} <= 5"""

# --- artificial intelligence

PERSONAL = f"""SELECT edicao, elegiveis, CAST(selecionaram AS INTEGER) AS nao_usam_ia, CAST(elegiveis - selecionaram AS INTEGER) AS usam_ia,
 round(100 - pct_adocao, 1) AS pct_adocao_pessoal FROM g WHERE categoria = 'uso_pessoal_chatgpt_copilot' AND opcao = '{v.NO_PERSONAL_USE}'"""
SQL["ia_adocao_pessoal_historico"] = PERSONAL
SQL["ia_adocao_pessoal_comparativo"] = history(PERSONAL, "", "pct_adocao_pessoal", v.WAVES, 1, "variacao_pp_23_26")
PRIORITY = f"""SELECT edicao, prioridade, contagem, total_respondentes, pct_na_dimensao, coalesce({position('prioridade', v.PRIORITY_SCALE)}, 5) AS ordem FROM (
 SELECT *, CASE WHEN valor LIKE '%principal prioridade como empresa%' THEN 'Principal prioridade' WHEN valor LIKE '%principais prioridades para os próximos%' THEN 'Entre as principais prioridades'
  WHEN valor LIKE 'Mais ou menos%' THEN 'Iniciativa secundária' WHEN valor LIKE 'Não é uma iniciativa%' THEN 'Não é prioridade' WHEN valor LIKE 'Não sei%' THEN 'Não sabe opinar' ELSE valor END AS prioridade
 FROM g WHERE categoria = '{v.AI_PRIORITY_CATEGORY}') p"""
SQL["ia_prioridade_empresa"] = PRIORITY
SQL["ia_prioridade_alta"] = f"""SELECT *, round(CAST(respondentes_prioridade_alta AS DOUBLE) / total_respondentes * 100, 1) AS pct_prioridade_alta FROM (
 SELECT edicao, CAST(sum(CASE WHEN ordem IN (1, 2) THEN contagem ELSE 0 END) AS BIGINT) AS respondentes_prioridade_alta, max(total_respondentes) AS total_respondentes FROM ({PRIORITY}) o GROUP BY 1) t"""
for _name, _category, _names, _label in (
    ("ia_uso_empresa_historico", "tipo_de_uso_de_ia_na_empresa", v.COMPANY_USE, "tipo_uso"),
    ("ia_uso_pessoal_historico", "uso_pessoal_chatgpt_copilot", v.PERSONAL_USE, "tipo_uso"),
    ("ia_barreiras_historico", "motivos_para_nao_usar_ia", v.BARRIERS, "barreira"),
):
    SQL[_name] = history(
        f"SELECT *, {case('opcao', _names)} AS {_label} FROM g WHERE categoria = '{_category}'",
        _label, "pct_adocao", v.WAVES, 1, "variacao_pp_23_26")
SQL["ia_top_5_barreiras_2025_2026"] = f"""SELECT {case('opcao', v.BARRIERS)} AS barreira, selecionaram, elegiveis, pct_adocao FROM g
WHERE categoria = 'motivos_para_nao_usar_ia' AND edicao = '{W3}' ORDER BY pct_adocao DESC, barreira LIMIT 5"""

# --- pay by region, level and work model

PAY = f"""p AS (SELECT *, {position('valor', v.PAY_BANDS)} AS pos, {position('nivel', v.LEVELS)} AS ordem_nivel,
 {case('modelo_de_trabalho_atual', v.WORK_MODELS)} AS modelo_trabalho FROM g WHERE variavel = 'faixa_salarial')"""


def pay(dims: Sequence[str], within: str, rank: str) -> str:
    bands = quantile_sql("p", dims, "pos", "contagem", total="total_respondentes")
    return f"""WITH {PAY} SELECT {', '.join(dims)}, total_respondentes, {label('p50')} AS faixa_salarial_mediana, {label('p75')} AS faixa_salarial_p75,
 p50 AS ordem_faixa_mediana, p75 AS ordem_faixa_p75, CAST(dense_rank() OVER (PARTITION BY {within} ORDER BY p50 DESC, p75 DESC) AS INTEGER) AS {rank},
 CASE WHEN total_respondentes < 30 THEN 'Amostra pequena (<30)' ELSE 'OK' END AS status_amostra FROM ({bands}) b"""


for _name, _dim in (("salario_por_regiao", "regiao_onde_mora"), ("salario_por_senioridade", "nivel"), ("salario_por_modelo_trabalho", "modelo_trabalho")):
    SQL[_name] = pay(["edicao", _dim], "edicao", "ranking")
for _name, _dim in (("senioridade_x_modelo_trabalho", "modelo_trabalho"), ("senioridade_x_regiao", "regiao_onde_mora")):
    SQL[_name] = pay(["edicao", "nivel", "ordem_nivel", _dim], "edicao, nivel", "ranking_no_nivel")

# --- opportunities and challenges

SCENE = f"""SELECT categoria, CAST(row_number() OVER (PARTITION BY categoria ORDER BY pct_adocao DESC, opcao) AS INTEGER) AS ranking, opcao, elegiveis, selecionaram, pct_adocao
 FROM g WHERE edicao = '{W3}'"""
SQL["cenario_atual"] = SCENE
SQL["sintese_executiva"] = f"SELECT categoria, ranking, opcao, pct_adocao FROM ({SCENE}) s WHERE ranking <= 5"
SQL["evolucao_2024_2026"] = """SELECT *, round(pct_2025_2026 - pct_2024_2025, 1) AS variacao_pp FROM (
 SELECT categoria, opcao, max(CASE WHEN edicao = '2024-2025' THEN pct_adocao END) AS pct_2024_2025, max(CASE WHEN edicao = '2025-2026' THEN pct_adocao END) AS pct_2025_2026
 FROM g GROUP BY categoria, opcao) w WHERE pct_2024_2025 IS NOT NULL AND pct_2025_2026 IS NOT NULL"""
BARRIERS = "SELECT edicao, opcao, elegiveis, selecionaram, pct_adocao FROM g WHERE categoria = 'motivos_para_nao_usar_ia'"
SQL["barreiras_ia_historico"] = BARRIERS
SQL["barreiras_ia_variacao_historica"] = f"SELECT opcao, \"{W1}\" AS pct_2023_2024, \"{W3}\" AS pct_2025_2026, variacao_pp FROM ({history(BARRIERS, 'opcao', 'pct_adocao', [W1, W3], 1, 'variacao_pp')}) v"


def _source(s, d, table: str):
    """Multi-select tables need the option columns, the others only the respondents."""
    return tv.survey(s, d) if "adocao" in table or "oportunidades" in table else tv.people(s, d)


def _with_gold(table: str, sql: str) -> str:
    body = sql.strip()
    own = f", {body[5:]}" if body.startswith("WITH ") else f" {body}"
    return f"WITH g AS MATERIALIZED ({GOLD_SQL[table]}){own}"


for _table, _build in gold.TABLES.items():
    register(_table, lambda s, d, t=_table, b=_build: b(_source(s, d, t)), GOLD_SQL[_table])


def _result(name: str):
    """A report over just the part of its table that it needs.

    Reports over a whole table start from it more than once; it is written first.
    """
    table, report = REPORTS[name]
    only = needs(name)

    def run(s, d):
        built = gold.TABLES[table](_source(s, d, table), only)
        return report(built if only else stored(built, table))

    return run


for _name, (_table, _) in REPORTS.items():
    register(f"result_{_name}", _result(_name), _with_gold(_table, SQL[_name]))
