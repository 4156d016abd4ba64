"""The seven pre-aggregated tables of the survey, from the harmonised responses."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavelens.operators.adoption import adoption_groups, groups_by_prefix
from wavelens.operators.distribution import distribution
from wavelens.operators.standardize import union_all_by_name
from wavelens.plans import fixed_values as v

# Column names of the published tables.
DISTRIBUTION_NAMES = {
    "variable": "variavel",
    "value": "valor",
    "n": "contagem",
    "base": "total_respondentes",
    "pct": "pct_na_dimensao",
}
ADOPTION_NAMES = {
    "option": "opcao",
    "eligible": "elegiveis",
    "selected": "selecionaram",
    "pct": "pct_adocao",
    "category": "categoria",
}
_COUNTS = "variavel string, valor string, contagem bigint, total_respondentes bigint, pct_na_dimensao double"
_OPTIONS = "opcao string, elegiveis bigint, selecionaram double, pct_adocao double"
# Schemas of the tables, to read those that exist as CSV already without inference.
SCHEMAS = {
    "gold_01_estrutura_mercado": f"edicao string, {_COUNTS}",
    "gold_02_perfis_valorizados": f"edicao string, cargo_atual string, nivel string, {_COUNTS}",
    "gold_03_diversidade_genero": f"edicao string, genero string, {_COUNTS}",
    "gold_04_adocao_tecnologias": f"edicao string, {_OPTIONS}, categoria string",
    "gold_05_adocao_ia": "edicao string, " + _COUNTS.replace("variavel", "variavel_original") + f", categoria string, {_OPTIONS}",
    "gold_06_diferencas_regiao_senioridade_modelo": "edicao string, regiao_onde_mora string, nivel string, "
    f"modelo_de_trabalho_atual string, {_COUNTS}",
    "gold_07_oportunidades_desafios": f"edicao string, {_OPTIONS}, categoria string",
}


Only = Collection[str] | None


def _distribution(
    silver: DataFrame, variables: Sequence[str], dims: Sequence[str], only: Only = None
) -> DataFrame:
    """``only`` names the variables wanted, so that the others' columns are never read."""
    present = [d for d in dims if d in silver.columns]
    wanted = [x for x in variables if only is None or x in only]
    return distribution(silver, wanted, present).withColumnsRenamed(DISTRIBUTION_NAMES)


def _adoption(silver: DataFrame, prefixes: Mapping[str, str], only: Only = None) -> DataFrame:
    """``only`` names the categories wanted."""
    wanted = {k: p for k, p in prefixes.items() if only is None or k in only}
    groups = groups_by_prefix(silver, wanted)
    return adoption_groups(silver, groups, ["edicao"]).withColumnsRenamed(ADOPTION_NAMES)


def market_structure(silver: DataFrame, only: Only = None) -> DataFrame:
    return _distribution(silver, v.MARKET_VARIABLES, ["edicao"], only)


def valued_profiles(silver: DataFrame, only: Only = None) -> DataFrame:
    return _distribution(silver, ["faixa_salarial"], ["edicao", "cargo_atual", "nivel"], only)


def gender_diversity(silver: DataFrame, only: Only = None) -> DataFrame:
    return _distribution(silver, v.GENDER_VARIABLES, ["edicao", "genero"], only)


def technology_adoption(silver: DataFrame, only: Only = None) -> DataFrame:
    return _adoption(silver, v.TECHNOLOGY_GROUPS, only)


def ai_adoption(silver: DataFrame, only: Only = None) -> DataFrame:
    """Company priority (a distribution) and use or barriers (adoption) in one table."""
    adopted = _adoption(silver, v.AI_GROUPS, only)
    unwanted = only is not None and v.AI_PRIORITY_CATEGORY not in only
    if unwanted or v.AI_PRIORITY_VARIABLE not in silver.columns:
        return adopted
    priority = (
        _distribution(silver, [v.AI_PRIORITY_VARIABLE], ["edicao"])
        .withColumnRenamed("variavel", "variavel_original")
        .withColumn("categoria", F.lit(v.AI_PRIORITY_CATEGORY))
    )
    return union_all_by_name([priority, adopted])


def region_level_model(silver: DataFrame, only: Only = None) -> DataFrame:
    dims = ["edicao", "regiao_onde_mora", "nivel", "modelo_de_trabalho_atual"]
    return _distribution(silver, ["faixa_salarial"], dims, only)


def opportunities_challenges(silver: DataFrame, only: Only = None) -> DataFrame:
    return _adoption(silver, v.CHALLENGE_GROUPS, only)


TABLES = {
    "gold_01_estrutura_mercado": market_structure,
    "gold_02_perfis_valorizados": valued_profiles,
    "gold_03_diversidade_genero": gender_diversity,
    "gold_04_adocao_tecnologias": technology_adoption,
    "gold_05_adocao_ia": ai_adoption,
    "gold_06_diferencas_regiao_senioridade_modelo": region_level_model,
    "gold_07_oportunidades_desafios": opportunities_challenges,
}
