"""The whole way from raw files to the pre-aggregated tables, and all of these at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavelens import testviews as tv
from wavelens.operators import standardize as st
from wavelens.plans import fixed_values as v
from wavelens.plans import gold_once, increment
from wavelens.plans.flow import Layout
from wavelens.plans.gold import TABLES
from wavelens.registry.core import register
from wavelens.registry.results import GOLD_SQL
from wavelens.session import scratch_path, small_methods, stored

#: Questions of the raw waves: code and label by the name they are harmonised to.
SINGLE = {
    "cargo_atual": ("2.f", "Cargo Atual"),
    "nivel": ("2.g", "Nível"),
    "faixa_salarial": ("2.h", "Faixa Salarial"),
    "situacao_de_trabalho": ("2.a", "Situação de Trabalho"),
    "modelo_de_trabalho_atual": ("2.r", "Modelo de Trabalho Atual"),
    "regiao_onde_mora": ("1.i", "Região onde mora"),
    "setor": ("2.b", "Setor"),
    "numero_de_funcionarios": ("2.c", "Número de Funcionários"),
    "genero": ("1.b", "Gênero"),
    "cor_raca_etnia": ("1.c", "Cor/Raça/Etnia"),
    "ai_generativa_e_llm_e_uma_prioridade": ("3.e", "AI Generativa e LLM é uma prioridade?"),
}
#: A label that the last wave spells differently, to be matched by likeness.
RESPELLED = {"regiao_onde_mora": "Região onde moraa"}
EVERYTHING = f"SELECT p.*, s.* EXCEPT (resp, edicao, {v.AI_PRIORITY_VARIABLE}) FROM ({tv.PEOPLE}) p JOIN ({tv.SURVEY}) s ON p.resp = s.resp"
ALL_SQL = " UNION ALL BY NAME ".join(f"SELECT '{name}' AS tabela, * FROM ({sql}) t" for name, sql in GOLD_SQL.items())


def everybody(s, d) -> DataFrame:
    """Respondents with all their answers, stored."""
    with small_methods(s):
        return stored(tv.view(s, d, EVERYTHING), "everybody")


def tagged(tables: dict[str, DataFrame]) -> DataFrame:
    return st.union_all_by_name([df.withColumn("tabela", F.lit(name)) for name, df in tables.items()])


register("gold_all_tables", lambda s, d: tagged(gold_once.all_tables(everybody(s, d))), ALL_SQL)


def _header(wave: str, code: str, label: str) -> str:
    if v.HEADER_STYLE[wave] == "tuple":
        return f"('P{code.replace('.', '_')} ', '{label}')"
    return f"{code}_{label}"


def raw_wave(answers: DataFrame, wave: str, asked: set[str]) -> DataFrame:
    """The answers of one wave under coded headers, groups with the text of their parent."""
    out = []
    for name, (code, label) in SINGLE.items():
        if name in asked:
            out.append(F.col(name).alias(_header(wave, code, RESPELLED.get(name, label) if wave == v.LAST_WAVE else label)))
    for letter, (prefix, _, options) in zip("abcdefghijklmnop", tv._GROUPS, strict=False):
        columns = [(prefix + o, o) for o in options if prefix + o in asked]
        if columns:
            chosen = [F.when(F.col(c) == "1", F.lit(o)) for c, o in columns]
            out.append(F.concat_ws(", ", *chosen).alias(_header(wave, f"5.{letter}", prefix.replace("_", " ").strip())))
        for i, (column, option) in enumerate(columns, 1):
            out.append(F.col(column).alias(_header(wave, f"5.{letter}.{i}", option.replace("_", " "))))
    remark = F.concat_ws("\n", F.lit('"remark"'), "asked_as", "setor")
    return answers.select(*out, remark.alias(_header(wave, "9.z", "Comentário, livre")))


def write_raw(s, d, root: str) -> dict[str, str]:
    """Raw CSV files of the three waves; a wave has the questions somebody answered in it."""
    people = everybody(s, d)
    answered = {r["edicao"]: r for r in people.groupBy("edicao").agg(*[F.count(c).alias(c) for c in people.columns if c != "edicao"]).collect()}
    out = {}
    for wave in v.WAVES:
        answers = people.filter(F.col("edicao") == wave)
        asked = {c for c, n in answered[wave].asDict().items() if n}
        out[wave] = f"{root}/raw/{wave}"
        raw_wave(answers, wave, asked).write.option("header", True).option("escape", '"').option("quoteAll", True).option(
            "emptyValue", "").csv(out[wave])
    return out


def flow_raw_to_results(s, d) -> DataFrame:
    """Two raw waves through all layers, then the third: all tables as they are read after it."""
    layout = Layout(scratch_path(s, "lake"))
    raw = write_raw(s, d, layout.root)
    first = {w: raw[w] for w in v.WAVES[:2]}
    increment.update(s, layout, first)
    increment.update(s, layout, raw)
    entries = increment.read_manifest(s, layout)
    return tagged({name: increment.read_gold(s, layout, entries, name) for name in TABLES})


register("flow_raw_to_results", flow_raw_to_results, ALL_SQL)
