"""The published results, each a query over one pre-aggregated table.

The inputs are tables of counts, already one row per slice and label.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavelens.functions.labels import (
    binary_regroup,
    classify_text,
    ordinal,
    relabel,
    remap,
    share,
    small_base_flag,
)
from wavelens.functions.text import lit_col
from wavelens.operators import adoption as ad
from wavelens.operators import distribution as di
from wavelens.operators import evolution as ev
from wavelens.operators import ordinal as od
from wavelens.operators.filters import exclude_label, min_base, signed, split_by_base
from wavelens.plans import fixed_values as v

COUNT, BASE, PCT = "contagem", "total_respondentes", "pct_na_dimensao"


def _variable(gold: DataFrame, name: str) -> DataFrame:
    return gold.filter(F.col("variavel") == name)


# --- market structure -----------------------------------------------------------


def _roles(gold: DataFrame) -> DataFrame:
    merged = _variable(gold, "cargo_atual").withColumn(
        "cargo_harmonizado", remap(F.col("valor"), v.ROLE_MERGE)
    )
    return di.reshare(merged, ["edicao"], "cargo_harmonizado", COUNT, base="total_edicao", pct=PCT)


def roles_now(gold: DataFrame) -> DataFrame:
    now = _roles(gold).filter(F.col("edicao") == v.LAST_WAVE)
    return now.select("cargo_harmonizado", COUNT, PCT).orderBy(F.desc(PCT), "cargo_harmonizado")


def roles_history(gold: DataFrame) -> DataFrame:
    """Roles present in every wave; a key absent from one has a NULL variation."""
    wide = ev.evolution(
        _roles(gold), ["cargo_harmonizado"], "edicao", PCT, v.WAVES, 2, "variacao_pp"
    )
    return wide.dropna(subset=v.WAVES).orderBy(F.desc("variacao_pp"), "cargo_harmonizado")


def roles_risen(gold: DataFrame) -> DataFrame:
    return signed(roles_history(gold), "variacao_pp").orderBy(F.desc("variacao_pp"), "cargo_harmonizado")


def roles_fallen(gold: DataFrame) -> DataFrame:
    return signed(roles_history(gold), "variacao_pp", -1).orderBy("variacao_pp", "cargo_harmonizado")


def roles_top3_share(gold: DataFrame) -> DataFrame:
    total = di.sum_shares(roles_now(gold).limit(v.TOP_ROLES), [], PCT)
    return total.withColumnRenamed(PCT, "participacao_top3")


def sectors_top2_share(gold: DataFrame) -> DataFrame:
    total = di.sum_shares(structure_now(gold, "setor").limit(v.TOP_SECTORS), [], PCT)
    return total.withColumnRenamed(PCT, "participacao_top2")


def experienced_share(gold: DataFrame) -> DataFrame:
    chosen = structure_now(gold, "nivel").filter(F.col("valor").isin(v.EXPERIENCED_LEVELS))
    return di.sum_shares(chosen, [], PCT).withColumnRenamed(PCT, "pct_senior_staff")


def structure_now(gold: DataFrame, variable: str, without: Sequence[str] = ()) -> DataFrame:
    now = _variable(gold, variable).filter(F.col("edicao") == v.LAST_WAVE)
    if without:
        now = exclude_label(now, "valor", without, keep_null=False)
    return now.select("valor", COUNT, PCT).orderBy(F.desc(PCT), "valor")


def structure_history(
    gold: DataFrame, variable: str, waves: Sequence[str], without: Sequence[str] = ()
) -> DataFrame:
    rows = _variable(gold, variable)
    if without:
        rows = exclude_label(rows, "valor", without, keep_null=False)
    wide = ev.evolution(rows, ["valor"], "edicao", PCT, waves, 2, "variacao_pp")
    return wide.orderBy(F.desc_nulls_last("variacao_pp"), "valor")


def work_model_groups(gold: DataFrame) -> DataFrame:
    group = binary_regroup(F.col("valor"), v.REMOTE, v.REMOTE_GROUP, v.ON_SITE_GROUP)
    rows = _variable(gold, "modelo_de_trabalho_atual").withColumn("grupo_modelo", group)
    return di.sum_shares(rows, ["edicao", "grupo_modelo"], PCT).orderBy("edicao", F.desc(PCT))


# --- valued profiles --------------------------------------------------------------


def _profile_counts(gold: DataFrame) -> DataFrame:
    """Counts per wave, merged role, level and pay band, without the broken band."""
    clean = exclude_label(gold, "valor", [v.BAD_PAY_BAND])
    merged = clean.withColumn("cargo_harmonizado", remap(F.col("cargo_atual"), v.ROLE_MERGE))
    return merged.withColumn("ordem", ordinal(F.col("valor"), v.PAY_BANDS))


def _profile_bands(rows: DataFrame, basis: str) -> DataFrame:
    return od.ordinal_quantiles(
        rows, ["edicao", "cargo_harmonizado", "nivel"], "ordem", len(v.PAY_BANDS),
        weight=COUNT, basis=basis, total=BASE, off_scale="lowest",
    )


def profiles_ranked(gold: DataFrame) -> DataFrame:
    """Newest wave: profiles with enough answers, ranked by median and upper-quartile band."""
    now = _profile_counts(gold).filter(F.col("edicao") == v.LAST_WAVE)
    bands = min_base(
        _profile_bands(now, "round0"), BASE, v.MIN_BASE, "cargo_harmonizado", [v.CATCH_ALL_ROLE]
    )
    bands = bands.withColumnsRenamed({"p50": "ordem_faixa_mediana", "p75": "ordem_faixa_p75"})
    ranked = od.rank_by(bands, ["nivel"], ["ordem_faixa_mediana", "ordem_faixa_p75"])
    labelled = od.with_band_labels(
        ranked, v.PAY_BANDS,
        {"ordem_faixa_mediana": "faixa_salarial_mediana", "ordem_faixa_p75": "faixa_salarial_p75"},
    )
    return labelled.select(
        "nivel", "ranking", "cargo_harmonizado", BASE, "faixa_salarial_mediana",
        "faixa_salarial_p75", "ordem_faixa_mediana", "ordem_faixa_p75",
    ).orderBy("nivel", "ranking", F.desc(BASE), "cargo_harmonizado")


def _profile_history(gold: DataFrame) -> DataFrame:
    rows = _profile_counts(gold).filter(
        F.col("cargo_harmonizado").isin(v.HISTORY_ROLES) & F.col("nivel").isin(v.HISTORY_LEVELS)
    )
    bands = _profile_bands(rows, "round2")
    steady = ev.comparable(
        bands, ["cargo_harmonizado", "nivel"], "edicao", len(v.WAVES), BASE, v.MIN_BASE
    )
    return ev.keep_keys(bands, steady, ["cargo_harmonizado", "nivel"])


def profiles_moved(gold: DataFrame) -> DataFrame:
    """All waves of the comparable profiles whose band differs between first and last wave."""
    moved = od.band_movement(
        _profile_history(gold), ["cargo_harmonizado", "nivel"], "edicao",
        v.FIRST_WAVE, v.LAST_WAVE, ["p50", "p75"],
    )
    labelled = od.with_band_labels(moved, v.PAY_BANDS, {"p50": "faixa_p50", "p75": "faixa_p75"})
    return labelled.select(
        "edicao", "cargo_harmonizado", "nivel", BASE, "faixa_p50",
        F.col("p50").alias("ordem_faixa_p50"), "faixa_p75", F.col("p75").alias("ordem_faixa_p75"),
    ).orderBy("cargo_harmonizado", "nivel", "edicao")


# --- gender -----------------------------------------------------------------------


def gender_composition(gold: DataFrame) -> DataFrame:
    people = di.resum(_variable(gold, "nivel"), ["edicao", "genero"], COUNT)
    people = people.withColumnRenamed(COUNT, "respondentes")
    out = di.with_share(people, ["edicao"], "respondentes", "total_edicao", "pct_geral", 1)
    return out.orderBy("edicao", F.desc("respondentes"), "genero")


def _women(rows: DataFrame, slice_: str, total: str) -> DataFrame:
    women = di.subgroup_share(rows, ["edicao", slice_], "genero", v.WOMEN, COUNT)
    return women.withColumnsRenamed({"members": "mulheres", "total": total, "pct": "pct_feminino"})


def women_by_level(gold: DataFrame) -> DataFrame:
    rows = _variable(gold, "nivel").withColumn("nivel", F.col("valor"))
    place = ordinal(F.col("nivel"), v.LEVELS, unmapped=99)
    return _women(rows, "nivel", "total_nivel").orderBy("edicao", place, "nivel")


def women_by_role(gold: DataFrame) -> DataFrame:
    """Merged roles with enough answers in every wave.

    Comparability looks at the role's whole base, so also at waves without women.
    """
    rows = _variable(gold, "cargo_atual").withColumn(
        "cargo_harmonizado", remap(F.col("valor"), v.ROLE_MERGE)
    )
    rows = exclude_label(rows, "cargo_harmonizado", [v.CATCH_ALL_ROLE])
    totals = di.resum(rows, ["edicao", "cargo_harmonizado"], COUNT)
    steady = ev.comparable(
        totals, ["cargo_harmonizado"], "edicao", len(v.WAVES), COUNT, v.MIN_BASE
    )
    women = _women(rows, "cargo_harmonizado", "total_cargo")
    return ev.keep_keys(women, steady, ["cargo_harmonizado"]).select(
        "edicao", "cargo_harmonizado", "mulheres", "total_cargo", "pct_feminino"
    ).orderBy("cargo_harmonizado", "edicao")


def women_by_pay(gold: DataFrame) -> DataFrame:
    rows = _variable(gold, "faixa_salarial").withColumn("faixa_salarial", F.col("valor"))
    kept, _ = split_by_base(
        _women(rows, "faixa_salarial", "total_faixa"), "total_faixa", v.SINGLE_ANSWER
    )
    place = ordinal(F.col("faixa_salarial"), v.PAY_BANDS, unmapped=99)
    return kept.orderBy("edicao", place, "faixa_salarial")


def pay_bands_discarded(gold: DataFrame) -> DataFrame:
    rows = _variable(gold, "faixa_salarial").withColumn("faixa_salarial", F.col("valor"))
    totals = di.resum(rows, ["edicao", "faixa_salarial"], COUNT)
    _, discarded = split_by_base(totals, COUNT, v.SINGLE_ANSWER)
    return discarded.withColumnRenamed(COUNT, "total_faixa").orderBy("edicao", "faixa_salarial")


def _respondents(gold: DataFrame) -> DataFrame:
    return di.resum(_variable(gold, "nivel"), ["edicao"], COUNT).withColumnRenamed(COUNT, BASE)


def _race(gold: DataFrame) -> DataFrame:
    return _variable(gold, "cor_raca_etnia").withColumn("cor_raca_etnia", F.col("valor"))


def race_marks(gold: DataFrame) -> DataFrame:
    marks = di.resum(_race(gold), ["edicao"], COUNT).withColumnRenamed(COUNT, "total_marcacoes")
    out = di.marks_ratio(marks, _respondents(gold), ["edicao"], "total_marcacoes", BASE)
    return out.withColumnsRenamed(
        {"difference": "diferenca", "marks_per_respondent": "marcacoes_por_respondente"}
    ).orderBy("edicao")


def _race_totals(gold: DataFrame) -> DataFrame:
    counts = di.resum(_race(gold), ["edicao", "cor_raca_etnia"], COUNT)
    return counts.withColumnRenamed(COUNT, "respondentes")


def _race_comparable(gold: DataFrame) -> DataFrame:
    steady = ev.comparable(
        _race_totals(gold), ["cor_raca_etnia"], "edicao", len(v.WAVES), "respondentes", v.MIN_BASE
    )
    return exclude_label(steady, "cor_raca_etnia", v.RACE_EXCLUDED)


def race_presence(gold: DataFrame) -> DataFrame:
    """Share of those who stated their level, which is a smaller base than the answers."""
    out = di.presence(
        _race_totals(gold), _respondents(gold), ["edicao"], "respondentes", BASE, "pct_respondentes"
    )
    return ev.keep_keys(out, _race_comparable(gold), ["cor_raca_etnia"]).select(
        "edicao", "cor_raca_etnia", "respondentes", BASE, "pct_respondentes"
    ).orderBy("cor_raca_etnia", "edicao")


def women_by_race(gold: DataFrame) -> DataFrame:
    women = _women(_race(gold), "cor_raca_etnia", "total_cor_raca")
    return ev.keep_keys(women, _race_comparable(gold), ["cor_raca_etnia"]).select(
        "edicao", "cor_raca_etnia", "mulheres", "total_cor_raca", "pct_feminino"
    ).orderBy("cor_raca_etnia", "edicao")


def _variation(rows: DataFrame, key: str, value: str) -> DataFrame:
    wide = ev.evolution(rows, [key], "edicao", value, [v.FIRST_WAVE, v.LAST_WAVE], 1, "variacao_pp")
    names = {w: f"{value.removesuffix('_respondentes')}_{w.replace('-', '_')}" for w in v.WAVES}
    return wide.withColumnsRenamed(names).orderBy(F.desc_nulls_last("variacao_pp"), key)


def race_presence_variation(gold: DataFrame) -> DataFrame:
    return _variation(race_presence(gold), "cor_raca_etnia", "pct_respondentes")


def women_by_race_variation(gold: DataFrame) -> DataFrame:
    return _variation(women_by_race(gold), "cor_raca_etnia", "pct_feminino")


# --- technology -------------------------------------------------------------------


def _adopted(gold: DataFrame) -> DataFrame:
    named = gold.withColumn("categoria_nome", relabel(F.col("categoria"), v.CATEGORY_NAMES))
    return signed(named, "pct_adocao")


def category_coverage(gold: DataFrame) -> DataFrame:
    out = ad.coverage(_adopted(gold), ["categoria", "categoria_nome"], "edicao")
    return out.withColumnsRenamed({"n_waves": "qtd_edicoes", "waves": "edicoes"}).orderBy(
        F.desc("qtd_edicoes"), "categoria_nome"
    )


def technology_ranking(gold: DataFrame) -> DataFrame:
    ranked = ad.adoption_ranking(
        _adopted(gold), ["edicao", "categoria"], "opcao", "selecionaram", "pct_adocao"
    )
    return ranked.select(
        "edicao", "categoria", "categoria_nome", "ranking", "opcao", "elegiveis",
        "selecionaram", "pct_adocao",
    ).orderBy("edicao", "categoria_nome", "ranking")


def technology_top5_latest(gold: DataFrame) -> DataFrame:
    top = technology_ranking(gold).filter(F.col("ranking") <= v.TOP_K)
    return ev.in_latest_wave(top, "edicao", gold).select(*top.columns).orderBy(
        "categoria_nome", "ranking"
    )


def technology_history(gold: DataFrame, category: str) -> DataFrame:
    ranked = technology_ranking(gold.filter(F.col("categoria") == category))
    return ranked.select(
        "edicao", "ranking", "opcao", "elegiveis", "selecionaram", "pct_adocao"
    ).orderBy("edicao", "ranking")


def technology_evolution(gold: DataFrame) -> DataFrame:
    """First against last wave with any adoption, for options adopted in two or more."""
    out = ev.evolution_available(
        _adopted(gold), ["categoria", "categoria_nome", "opcao"], "edicao", "pct_adocao"
    )
    return out.select(
        "categoria", "categoria_nome", "opcao",
        F.col("first_wave").alias("primeira_edicao"),
        F.col("last_wave").alias("ultima_edicao"),
        F.col("n_waves").alias("qtd_edicoes"),
        F.col("first_value").alias("pct_inicio"),
        F.col("last_value").alias("pct_fim"),
        F.col("variation").alias("variacao_pp"),
    ).orderBy("categoria_nome", F.desc("variacao_pp"), "opcao")


def technology_movers(gold: DataFrame, rising: bool) -> DataFrame:
    rank = "ranking_crescimento" if rising else "ranking_queda"
    out = ev.movers(
        technology_evolution(gold), ["categoria"], "opcao", "variacao_pp", v.TOP_K, rising
    ).withColumnRenamed("ranking", rank)
    return out.select(
        "categoria", "categoria_nome", rank, "opcao", "primeira_edicao", "ultima_edicao",
        "pct_inicio", "pct_fim", "variacao_pp",
    ).orderBy("categoria_nome", rank)


# --- artificial intelligence --------------------------------------------------------


def ai_personal_use(gold: DataFrame) -> DataFrame:
    none = gold.filter(
        (F.col("categoria") == "uso_pessoal_chatgpt_copilot") & (F.col("opcao") == v.NO_PERSONAL_USE)
    ).select("edicao", "elegiveis", "selecionaram", "pct_adocao")
    out = ad.complement(none, "elegiveis", "selecionaram", "pct_adocao")
    return out.withColumnsRenamed(
        {"non_users": "nao_usam_ia", "users": "usam_ia", "pct_users": "pct_adocao_pessoal"}
    ).orderBy("edicao")


def ai_personal_use_compared(gold: DataFrame) -> DataFrame:
    return ev.evolution(
        ai_personal_use(gold), [], "edicao", "pct_adocao_pessoal", v.WAVES, 1, "variacao_pp_23_26"
    )


def ai_priority(gold: DataFrame) -> DataFrame:
    rows = gold.filter(F.col("categoria") == v.AI_PRIORITY_CATEGORY)
    rows = rows.withColumn("prioridade", classify_text(F.col("valor"), v.PRIORITY_RULES))
    place = ordinal(F.col("prioridade"), v.PRIORITY_SCALE, unmapped=v.PRIORITY_OTHER)
    return rows.select("edicao", "prioridade", COUNT, BASE, PCT, place.alias("ordem")).orderBy(
        "edicao", "ordem"
    )


def ai_priority_high(gold: DataFrame) -> DataFrame:
    out = di.topbox_share(ai_priority(gold), ["edicao"], "ordem", v.PRIORITY_HIGH, COUNT, BASE)
    return out.withColumnsRenamed(
        {"top": "respondentes_prioridade_alta", "pct": "pct_prioridade_alta"}
    ).orderBy("edicao")


def _ai_options(gold: DataFrame, category: str, names: dict, label: str) -> DataFrame:
    rows = gold.filter(F.col("categoria") == category)
    return rows.withColumn(label, relabel(F.col("opcao"), names))


def ai_history(gold: DataFrame, category: str, names: dict, label: str) -> DataFrame:
    rows = _ai_options(gold, category, names, label)
    wide = ev.evolution(rows, [label], "edicao", "pct_adocao", v.WAVES, 1, "variacao_pp_23_26")
    return wide.orderBy(lit_col(v.LAST_WAVE).desc_nulls_last(), label)


def ai_top5_barriers(gold: DataFrame) -> DataFrame:
    rows = _ai_options(gold, "motivos_para_nao_usar_ia", v.BARRIERS, "barreira")
    now = rows.filter(F.col("edicao") == v.LAST_WAVE)
    return now.select("barreira", "selecionaram", "elegiveis", "pct_adocao").orderBy(
        F.desc("pct_adocao"), "barreira"
    ).limit(v.TOP_K)


# --- pay by region, level and work model ----------------------------------------------


def _pay_rows(gold: DataFrame) -> DataFrame:
    """Pay counts with band positions; a label off the scale stops the job."""
    return (
        _variable(gold, "faixa_salarial")
        .withColumn("ordem_faixa", ordinal(F.col("valor"), v.PAY_BANDS, unmapped="error"))
        .withColumn("modelo_trabalho", relabel(F.col("modelo_de_trabalho_atual"), v.WORK_MODELS))
        .withColumn("ordem_nivel", ordinal(F.col("nivel"), v.LEVELS))
    )


def _pay_summary(rows: DataFrame, dims: Sequence[str], within: Sequence[str], rank: str) -> DataFrame:
    bands = od.ordinal_quantiles(
        rows, dims, "ordem_faixa", len(v.PAY_BANDS), weight=COUNT, total=BASE
    ).withColumnsRenamed({"p50": "ordem_faixa_mediana", "p75": "ordem_faixa_p75"})
    ranked = od.rank_by(bands, within, ["ordem_faixa_mediana", "ordem_faixa_p75"], rank)
    labelled = od.with_band_labels(
        ranked, v.PAY_BANDS,
        {"ordem_faixa_mediana": "faixa_salarial_mediana", "ordem_faixa_p75": "faixa_salarial_p75"},
    )
    return labelled.select(
        *dims, BASE, "faixa_salarial_mediana", "faixa_salarial_p75", "ordem_faixa_mediana",
        "ordem_faixa_p75", rank, small_base_flag(F.col(BASE), v.SMALL_BASE).alias("status_amostra"),
    )


def pay_by(gold: DataFrame, dim: str) -> DataFrame:
    out = _pay_summary(_pay_rows(gold), ["edicao", dim], ["edicao"], "ranking")
    return out.orderBy("edicao", "ranking", dim)


def pay_by_level_and(gold: DataFrame, dim: str) -> DataFrame:
    out = _pay_summary(
        _pay_rows(gold), ["edicao", "nivel", "ordem_nivel", dim], ["edicao", "nivel"],
        "ranking_no_nivel",
    )
    return out.orderBy("edicao", "ordem_nivel", "ranking_no_nivel", dim)


# --- opportunities and challenges -----------------------------------------------------


def challenges_now(gold: DataFrame) -> DataFrame:
    now = gold.filter(F.col("edicao") == v.LAST_WAVE)
    ranked = ev.numbered(now, ["categoria"], [F.desc("pct_adocao"), F.asc("opcao")])
    return ranked.select(
        "categoria", "ranking", "opcao", "elegiveis", "selecionaram", "pct_adocao"
    ).orderBy("categoria", "ranking")


def executive_summary(gold: DataFrame) -> DataFrame:
    top = challenges_now(gold).filter(F.col("ranking") <= v.TOP_K)
    return top.select("categoria", "ranking", "opcao", "pct_adocao").orderBy("categoria", "ranking")


def challenges_evolution(gold: DataFrame) -> DataFrame:
    """Options both of the last two waves have."""
    wide = ev.evolution(
        gold, ["categoria", "opcao"], "edicao", "pct_adocao", [v.MIDDLE_WAVE, v.LAST_WAVE], 1,
        "variacao_pp",
    )
    wide = wide.withColumnsRenamed({w: f"pct_{w.replace('-', '_')}" for w in v.WAVES})
    return wide.dropna(subset=["variacao_pp"]).orderBy("categoria", F.desc("variacao_pp"), "opcao")


def barriers_history(gold: DataFrame) -> DataFrame:
    rows = gold.filter(F.col("categoria") == "motivos_para_nao_usar_ia")
    return rows.select("edicao", "opcao", "elegiveis", "selecionaram", "pct_adocao").orderBy(
        "opcao", "edicao"
    )


def barriers_variation(gold: DataFrame) -> DataFrame:
    wide = ev.evolution(
        barriers_history(gold), ["opcao"], "edicao", "pct_adocao", [v.FIRST_WAVE, v.LAST_WAVE], 1,
        "variacao_pp",
    )
    wide = wide.withColumnsRenamed({w: f"pct_{w.replace('-', '_')}" for w in v.WAVES})
    return wide.orderBy(F.desc_nulls_last("variacao_pp"), "opcao")


_LAST_TWO = [v.MIDDLE_WAVE, v.LAST_WAVE]

# result name -> (pre-aggregated table, query over it)
REPORTS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {}


def _add(table: str, **queries: Callable[[DataFrame], DataFrame]) -> None:
    REPORTS.update({name: (table, query) for name, query in queries.items()})


_add(
    "gold_01_estrutura_mercado",
    cargos_estrutura_atual=roles_now,
    cargos_historico=roles_history,
    cargos_maiores_crescimentos=roles_risen,
    cargos_maiores_quedas=roles_fallen,
    cargos_participacao_top3=roles_top3_share,
    setor_participacao_top2=sectors_top2_share,
    nivel_experiente_atual=experienced_share,
    nivel_atual=partial(structure_now, variable="nivel"),
    nivel_historico=partial(structure_history, variable="nivel", waves=[v.FIRST_WAVE, v.MIDDLE_WAVE]),
    setor_atual=partial(structure_now, variable="setor"),
    setor_historico=partial(structure_history, variable="setor", waves=v.WAVES),
    modelo_trabalho_atual=partial(structure_now, variable="modelo_de_trabalho_atual"),
    modelo_trabalho_historico=partial(
        structure_history, variable="modelo_de_trabalho_atual", waves=_LAST_TWO
    ),
    modelo_trabalho_consolidado=work_model_groups,
    regiao_historico=partial(structure_history, variable="regiao_onde_mora", waves=v.WAVES),
    situacao_trabalho_historico=partial(
        structure_history, variable="situacao_de_trabalho", waves=_LAST_TWO
    ),
    porte_historico=partial(
        structure_history, variable="numero_de_funcionarios", waves=v.WAVES,
        without=[v.BAD_COMPANY_SIZE],
    ),
    porte_atual=partial(
        structure_now, variable="numero_de_funcionarios", without=[v.BAD_COMPANY_SIZE]
    ),
)
_add(
    "gold_02_perfis_valorizados",
    perfis_valorizados_atual=profiles_ranked,
    perfis_evolucao_historica=profiles_moved,
)
_add(
    "gold_03_diversidade_genero",
    composicao_genero_historica=gender_composition,
    participacao_feminina_senioridade_historica=women_by_level,
    participacao_feminina_cargo_historica=women_by_role,
    participacao_feminina_salario_historica=women_by_pay,
    faixas_salariais_descartadas=pay_bands_discarded,
    validacao_cor_raca=race_marks,
    composicao_cor_raca_historica=race_presence,
    variacao_composicao_cor_raca=race_presence_variation,
    participacao_feminina_cor_raca_historica=women_by_race,
    variacao_participacao_feminina=women_by_race_variation,
)
_add(
    "gold_04_adocao_tecnologias",
    cobertura_categorias=category_coverage,
    ranking_adocao_por_categoria=technology_ranking,
    top_5_tecnologias_ultima_edicao=technology_top5_latest,
    linguagens_programacao_historico=partial(technology_history, category="linguagem_de_programacao"),
    ferramentas_bi_historico=partial(technology_history, category="ferramenta_de_bi"),
    cloud_historico=partial(technology_history, category="cloud"),
    bancos_dados_historico=partial(technology_history, category="banco_de_dados"),
    etl_data_engineer_historico=partial(technology_history, category="ferramenta_etl_data_engineer"),
    etl_data_analyst_historico=partial(technology_history, category="ferramenta_etl_data_analyst"),
    linguagem_preferida_2025_2026=partial(technology_history, category="linguagem_preferida_2025_2026"),
    evolucao_tecnologias_comparaveis=technology_evolution,
    maiores_crescimentos_adocao=partial(technology_movers, rising=True),
    maiores_quedas_adocao=partial(technology_movers, rising=False),
)
_add(
    "gold_05_adocao_ia",
    ia_adocao_pessoal_historico=ai_personal_use,
    ia_adocao_pessoal_comparativo=ai_personal_use_compared,
    ia_prioridade_empresa=ai_priority,
    ia_prioridade_alta=ai_priority_high,
    ia_uso_empresa_historico=partial(
        ai_history, category="tipo_de_uso_de_ia_na_empresa", names=v.COMPANY_USE, label="tipo_uso"
    ),
    ia_uso_pessoal_historico=partial(
        ai_history, category="uso_pessoal_chatgpt_copilot", names=v.PERSONAL_USE, label="tipo_uso"
    ),
    ia_barreiras_historico=partial(
        ai_history, category="motivos_para_nao_usar_ia", names=v.BARRIERS, label="barreira"
    ),
    ia_top_5_barreiras_2025_2026=ai_top5_barriers,
)
_add(
    "gold_06_diferencas_regiao_senioridade_modelo",
    salario_por_regiao=partial(pay_by, dim="regiao_onde_mora"),
    salario_por_senioridade=partial(pay_by, dim="nivel"),
    salario_por_modelo_trabalho=partial(pay_by, dim="modelo_trabalho"),
    senioridade_x_modelo_trabalho=partial(pay_by_level_and, dim="modelo_trabalho"),
    senioridade_x_regiao=partial(pay_by_level_and, dim="regiao_onde_mora"),
)
_add(
    "gold_07_oportunidades_desafios",
    cenario_atual=challenges_now,
    evolucao_2024_2026=challenges_evolution,
    barreiras_ia_historico=barriers_history,
    barreiras_ia_variacao_historica=barriers_variation,
    sintese_executiva=executive_summary,
)

_NEEDS = {
    ("cargo_atual",): [roles_now, roles_history, roles_risen, roles_fallen, roles_top3_share, women_by_role],
    ("setor",): [sectors_top2_share],
    ("nivel",): [experienced_share, gender_composition, women_by_level],
    ("modelo_de_trabalho_atual",): [work_model_groups],
    ("faixa_salarial",): [women_by_pay, pay_bands_discarded],
    ("cor_raca_etnia", "nivel"): [
        race_marks, race_presence, race_presence_variation, women_by_race, women_by_race_variation,
    ],
    ("uso_pessoal_chatgpt_copilot",): [ai_personal_use, ai_personal_use_compared],
    (v.AI_PRIORITY_CATEGORY,): [ai_priority, ai_priority_high],
    ("motivos_para_nao_usar_ia",): [ai_top5_barriers, barriers_history, barriers_variation],
}


def needs(name: str) -> tuple[str, ...] | None:
    """Variables or categories of its table that a report looks at; None for all."""
    query = REPORTS[name][1]
    if isinstance(query, partial):
        wanted = query.keywords.get("variable") or query.keywords.get("category")
        return (wanted,) if wanted else None
    return next((wanted for wanted, queries in _NEEDS.items() if query in queries), None)
