"""All seven pre-aggregated tables from one scan and one exchange of the responses.

Every answer becomes rows tagged with the question it counts for: one per dimension set
and variable of the distributions, one per option of the groups a respondent was asked.
They are counted together by ``(source, dimensions, value)``, before they move; the
tables are then cut out of that small table. A group that two tables show is counted once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavelens.functions.labels import share
from wavelens.functions.text import lit_col
from wavelens.operators.adoption import flag_value, groups_by_prefix
from wavelens.operators.distribution import join_base
from wavelens.operators.standardize import union_all_by_name
from wavelens.plans import fixed_values as v
from wavelens.plans.gold import ADOPTION_NAMES, DISTRIBUTION_NAMES, TABLES
from wavelens.session import small_methods, stored

WAVE = "edicao"
#: Variables and dimensions of the distribution tables.
DISTRIBUTIONS = {
    "gold_01_estrutura_mercado": (v.MARKET_VARIABLES, [WAVE]),
    "gold_02_perfis_valorizados": (["faixa_salarial"], [WAVE, "cargo_atual", "nivel"]),
    "gold_03_diversidade_genero": (v.GENDER_VARIABLES, [WAVE, "genero"]),
    "gold_05_adocao_ia": ([v.AI_PRIORITY_VARIABLE], [WAVE]),
    "gold_06_diferencas_regiao_senioridade_modelo": (
        ["faixa_salarial"], [WAVE, "regiao_onde_mora", "nivel", "modelo_de_trabalho_atual"],
    ),
}
#: Option groups of the adoption tables.
ADOPTIONS = {
    "gold_04_adocao_tecnologias": v.TECHNOLOGY_GROUPS,
    "gold_05_adocao_ia": v.AI_GROUPS,
    "gold_07_oportunidades_desafios": v.CHALLENGE_GROUPS,
}
WIDTH = max(len(dims) for _, dims in DISTRIBUTIONS.values())
KEYS = ["source", *[f"d{i}" for i in range(WIDTH)], "value"]


@dataclass(frozen=True)
class Question:
    """A variable within dimensions, or a group of options (``{column: option}``)."""

    table: str
    dims: tuple[str, ...]
    variable: str = ""
    prefix: str = ""
    options: tuple[tuple[str, str], ...] = ()

    def rows(self, source: int) -> Column:
        """What one respondent adds: nothing where a dimension or the answer is missing."""
        dims = [lit_col(d).alias(f"d{i}") for i, d in enumerate(self.dims)]
        dims += [F.lit(None).cast("string").alias(f"d{i}") for i in range(len(dims), WIDTH)]

        def row(value: Column, flag: Column) -> Column:
            return F.struct(F.lit(source).alias("source"), *dims, value.alias("value"), flag.cast("string").alias("flag"))

        if self.variable:
            rows = [row(lit_col(self.variable).cast("string"), F.lit(None))]
            needed = [*self.dims, self.variable]
        else:
            rows = [row(F.lit(option), lit_col(column)) for column, option in self.options]
            needed = list(self.dims)
        given = F.lit(True)
        for name in needed:
            given = given & lit_col(name).isNotNull()
        if self.options:
            given = given & F.coalesce(*[lit_col(c).cast("string") for c, _ in self.options]).isNotNull()
        made = F.array(*rows)
        return F.when(given, made).otherwise(F.slice(made, 1, 0))


def questions(columns: list[str], silver: DataFrame) -> list[Question]:
    """Everything the seven tables count, of what the table has; each group once."""
    out = []
    for table, (variables, dims) in DISTRIBUTIONS.items():
        present = tuple(d for d in dims if d in columns)
        out += [Question(table, present, x) for x in variables if x in columns]
    prefixes = {p: c for groups in ADOPTIONS.values() for c, p in groups.items()}
    for prefix, options in groups_by_prefix(silver, {p: p for p in prefixes}).items():
        out.append(Question("", (WAVE,), prefix=prefix, options=tuple(options.items())))
    return out


def count_everything(silver: DataFrame, asked: list[Question]) -> DataFrame:
    """``(source, d0…, value, n, marks)``; ``source`` is the place of the question in ``asked``."""
    rows = F.flatten(F.array(*[q.rows(i) for i, q in enumerate(asked)]))
    marks = F.sum(flag_value(F.col("flag")))
    return silver.select(F.inline(rows)).groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n"), marks.alias("marks"))


def _distribution(counts: DataFrame, asked: list[Question], table: str) -> DataFrame | None:
    own = {i: q for i, q in enumerate(asked) if q.table == table}
    if not own:
        return None
    dims = next(iter(own.values())).dims
    names = F.create_map(*[F.lit(x) for i, q in own.items() for x in (i, q.variable)])
    rows = counts.filter(F.col("source").isin(list(own))).select(
        *[F.col(f"d{i}").alias(d) for i, d in enumerate(dims)], names[F.col("source")].alias("variable"), "value", "n"
    )
    return join_base(rows, [*dims, "variable"], scale=1, keep_null=True).withColumnsRenamed(DISTRIBUTION_NAMES)


def _adoption(counts: DataFrame, asked: list[Question], table: str) -> DataFrame | None:
    categories = {p: c for c, p in ADOPTIONS[table].items()}
    own = {i: categories[q.prefix] for i, q in enumerate(asked) if q.prefix in categories}
    if not own:
        return None
    names = F.create_map(*[F.lit(x) for pair in own.items() for x in pair])
    selected = F.coalesce("marks", F.lit(0.0))
    return counts.filter(F.col("source").isin(list(own))).select(
        F.col("d0").alias(WAVE), F.col("value").alias("option"), F.col("n").alias("eligible"), selected.alias("selected"),
        share(selected, F.col("n")).alias("pct"), names[F.col("source")].alias("category"),
    ).withColumnsRenamed(ADOPTION_NAMES)


def all_tables(silver: DataFrame) -> dict[str, DataFrame]:
    """The seven tables by name, with the columns that building each alone gives.

    Runs one job, which writes the counts below the shared folder; a table of which the
    responses have no question is built alone, empty.
    """
    asked = questions(silver.columns, silver)
    with small_methods(silver.sparkSession):
        counts = stored(count_everything(silver, asked), "all-counts") if asked else None
    out = {}
    for table, build in TABLES.items():
        parts = []
        if table in DISTRIBUTIONS and counts is not None:
            part = _distribution(counts, asked, table)
            if part is not None and table in ADOPTIONS:
                part = part.withColumnRenamed("variavel", "variavel_original").withColumn("categoria", F.lit(v.AI_PRIORITY_CATEGORY))
            parts.append(part)
        if table in ADOPTIONS and counts is not None:
            parts.append(_adoption(counts, asked, table))
        parts = [p for p in parts if p is not None]
        out[table] = union_all_by_name(parts) if parts else build(silver)
    return out
