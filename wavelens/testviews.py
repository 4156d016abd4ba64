"""Survey-like views over the star-schema test tables, as SQL for Spark and DuckDB.

One text serves both engines (``{S}`` is the string type, ``{table}`` a table),
so a registered query and its check start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wavelens.plans import fixed_values as v
from wavelens.session import stored

TABLES = ("region", "nation", "customer", "orders", "lineitem", "part", "events", "documents", "labels")

RESPONSES = """
SELECT o.o_orderkey AS resp_id,
       CAST(year(o.o_orderdate) AS {S}) AS edition,
       o.o_orderpriority AS role,
       CASE WHEN c.c_acctbal < 0 THEN NULL ELSE o.o_orderstatus END AS level,
       c.c_mktsegment AS segment,
       r.r_name AS region,
       CASE WHEN year(o.o_orderdate) = 1995 THEN NULL
            WHEN c.c_acctbal < 2500 THEN 'remote'
            WHEN c.c_acctbal < 5000 THEN 'onsite' ELSE 'hybrid' END AS work_model,
       CASE WHEN c.c_acctbal > 9000 THEN NULL
            ELSE concat('band_', CAST(least(13, 1 + CAST(floor(o.o_totalprice / 40000) AS INT)) AS {S})) END AS pay_band
FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey
JOIN {nation} n ON c.c_nationkey = n.n_nationkey
JOIN {region} r ON n.n_regionkey = r.r_regionkey
"""

# The first group is not asked on closing days, the second not in the first week.
FLAGS = """
SELECT user_id, day, edition,
       CASE WHEN asked THEN CAST(f_click AS {S}) END AS opt_click,
       CASE WHEN asked THEN CAST(f_view AS {S}) END AS opt_view,
       CASE WHEN asked THEN CAST(f_purchase AS {S}) END AS opt_purchase,
       CASE WHEN asked THEN CAST(f_signup AS {S}) END AS opt_signup,
       CASE WHEN asked THEN CAST(f_error AS {S}) END AS opt_error,
       CAST(NULL AS {S}) AS opt_refund,
       CASE WHEN edition <> 'w1' THEN CAST(f_high AS {S}) END AS val_high,
       CASE WHEN edition <> 'w1' THEN CAST(f_low AS {S}) END AS val_low
FROM (
  SELECT user_id, CAST(ts AS DATE) AS day,
         dayofmonth(CAST(ts AS DATE)) NOT IN (6, 13, 20, 27) AS asked,
         concat('w', CAST(CAST(floor((dayofmonth(CAST(ts AS DATE)) - 1) / 7) AS INT) + 1 AS {S})) AS edition,
         max(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS f_click,
         max(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS f_view,
         max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS f_purchase,
         max(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) AS f_signup,
         max(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS f_error,
         max(CASE WHEN value > 100 THEN 1 ELSE 0 END) AS f_high,
         max(CASE WHEN value < 10 THEN 1 ELSE 0 END) AS f_low
  FROM {events} GROUP BY user_id, CAST(ts AS DATE)
) days
"""

# Question names of two waves: some agree, some changed ending or word order.
NAME_CATALOG = """
SELECT 'A' AS wave, min(p_partkey) AS position, lower(replace(concat(p_name, '_', p_type), ' ', '_')) AS name
FROM {part} GROUP BY 3
UNION ALL
SELECT 'B' AS wave, min(p_partkey) AS position, lower(replace(
    CASE WHEN p_type = 'PROMO' THEN concat(p_type, '_', p_name)
         WHEN p_type IN ('SMALL', 'LARGE') THEN concat(p_name, 's_', p_type)
         WHEN p_type = 'MEDIUM' THEN concat(p_name, '_', p_type, '_', 'q')
         ELSE concat(p_name, '_', p_type) END, ' ', '_')) AS name
FROM {part} GROUP BY 3
"""

_BANDS = "\n".join(f"WHEN {i} THEN '{band}'" for i, band in enumerate(v.PAY_BANDS, 1))

# One row per respondent under the column names of the harmonised survey table.
PEOPLE = """
SELECT resp, edicao,
       CASE WHEN c_acctbal < -900 THEN NULL
            WHEN o_orderpriority = '1-URGENT' AND edicao = '2023-2024'
              THEN 'Engenheiro de Dados/Arquiteto de Dados/Data Engineer/Data Architect'
            WHEN o_orderpriority = '1-URGENT' AND c_mktsegment = 'BUILDING' THEN 'Arquiteto de Dados/Data Architect'
            WHEN o_orderpriority = '1-URGENT' THEN 'Engenheiro de Dados/Data Engineer/Data Architect'
            WHEN o_orderpriority = '2-HIGH' AND c_mktsegment = 'FURNITURE' THEN 'Analytics Engineer'
            WHEN o_orderpriority = '2-HIGH' THEN 'Cientista de Dados/Data Scientist'
            WHEN o_orderpriority = '3-MEDIUM' THEN 'Analista de Dados/Data Analyst'
            WHEN o_orderpriority = '4-NOT SPECIFIED' AND c_mktsegment = 'MACHINERY' AND edicao = '2023-2024' THEN 'Economista'
            WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'Engenheiro de Machine Learning/ML Engineer/AI Engineer'
            ELSE 'Outra Opção' END AS cargo_atual,
       CASE WHEN c_acctbal < 0 THEN NULL
            WHEN o_orderstatus = 'F' THEN 'Júnior'
            WHEN o_orderstatus = 'O' THEN 'Pleno'
            WHEN edicao = '2025-2026' AND o_totalprice > 400000 THEN 'Especialista/Staff+'
            ELSE 'Sênior' END AS nivel,
       CASE WHEN edicao = '2023-2024' THEN NULL
            WHEN c_mktsegment = 'BUILDING' THEN 'Empregado (CLT)'
            WHEN c_mktsegment = 'FURNITURE' THEN 'Servidor Público'
            WHEN c_mktsegment = 'MACHINERY' THEN 'Estagiário'
            WHEN c_mktsegment = 'HOUSEHOLD' THEN 'Freelancer'
            ELSE 'Empreendedor ou Empregado (CNPJ)' END AS situacao_de_trabalho,
       CASE WHEN edicao = '2023-2024' THEN NULL
            WHEN c_acctbal < 2500 THEN 'Modelo 100% remoto'
            WHEN c_acctbal < 5000 THEN 'Modelo 100% presencial'
            WHEN c_acctbal < 7000 THEN 'Modelo híbrido com dias fixos de trabalho presencial'
            ELSE 'Modelo híbrido flexível (o funcionário tem liberdade para escolher quando estar no escritório presencialmente)'
            END AS modelo_de_trabalho_atual,
       CASE r_name WHEN 'AFRICA' THEN 'Norte' WHEN 'AMERICA' THEN 'Nordeste' WHEN 'ASIA' THEN 'Sudeste'
            WHEN 'EUROPE' THEN 'Sul' ELSE 'Centro-oeste' END AS regiao_onde_mora,
       n_name AS setor,
       CASE WHEN c_acctbal > 9950 THEN 'de 501 a 100'
            WHEN o_totalprice < 20000 THEN 'de 1 a 5'
            WHEN o_totalprice < 60000 THEN 'de 11 a 50'
            WHEN o_totalprice < 150000 THEN 'de 101 a 500'
            WHEN o_totalprice < 300000 THEN 'de 1.001 a 3.000'
            ELSE 'Acima de 3.000' END AS numero_de_funcionarios,
       CASE WHEN c_acctbal > 9500 THEN NULL
            WHEN edicao = '2023-2024' AND o_totalprice < 1020 THEN 'de R$ 101/mês a R$ 2.000/mês'
            ELSE CASE least(13, 1 + CAST(floor(o_totalprice / CASE o_orderstatus WHEN 'F' THEN 60000
                   WHEN 'O' THEN 45000 ELSE 35000 END) AS INT))
                 """ + _BANDS + """ END END AS faixa_salarial,
       CASE WHEN c_acctbal > 9900 THEN 'Prefiro não informar'
            WHEN c_mktsegment = 'FURNITURE' THEN 'Feminino'
            WHEN c_mktsegment = 'HOUSEHOLD' AND o_orderstatus = 'F' THEN 'Feminino'
            ELSE 'Masculino' END AS genero,
       CASE WHEN n_nationkey < 12 THEN 'Branca' WHEN n_nationkey < 18 THEN 'Parda'
            WHEN n_nationkey < 21 THEN 'Preta' WHEN n_nationkey < 23 THEN 'Amarela'
            WHEN n_nationkey = 23 THEN 'Outra' ELSE 'Prefiro não informar' END AS cor_raca_etnia,
       CASE WHEN edicao = '2023-2024' OR o_orderpriority <> '2-HIGH' THEN NULL
            WHEN c_mktsegment = 'BUILDING' THEN 'Sim, é nossa principal prioridade como empresa.'
            WHEN c_mktsegment = 'FURNITURE' THEN 'Sim, está entre nossas principais prioridades para os próximos 2-4 anos.'
            WHEN c_mktsegment = 'MACHINERY' THEN 'Mais ou menos... É uma das várias iniciativas.'
            WHEN c_mktsegment = 'HOUSEHOLD' THEN 'Não é uma iniciativa que estamos focando.'
            ELSE 'Não sei opinar sobre esse assunto.' END AS ai_generativa_e_llm_e_uma_prioridade,
       o_orderpriority AS asked_as
FROM (
  SELECT o.o_orderkey AS resp, o.o_orderpriority, o.o_orderstatus, o.o_totalprice,
         c.c_acctbal, c.c_mktsegment, n.n_name, n.n_nationkey, r.r_name,
         CASE WHEN year(o.o_orderdate) <= 1996 THEN '2023-2024'
              WHEN year(o.o_orderdate) <= 1998 THEN '2024-2025' ELSE '2025-2026' END AS edicao
  FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey
  JOIN {nation} n ON c.c_nationkey = n.n_nationkey
  JOIN {region} r ON n.n_regionkey = r.r_regionkey
) answers
"""

LINE_FLAGS = """
SELECT l_orderkey,
       max(CASE WHEN l_quantity > 40 THEN 1 ELSE 0 END) AS big,
       max(CASE WHEN l_quantity < 5 THEN 1 ELSE 0 END) AS tiny,
       max(CASE WHEN l_discount > 0.085 THEN 1 ELSE 0 END) AS deal,
       max(CASE WHEN l_discount < 0.015 THEN 1 ELSE 0 END) AS full_price,
       max(CASE WHEN l_tax > 0.075 THEN 1 ELSE 0 END) AS taxed,
       max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS returned,
       max(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS open_line,
       max(CASE WHEN l_extendedprice > 80000 THEN 1 ELSE 0 END) AS dear,
       max(CASE WHEN l_linenumber > 5 THEN 1 ELSE 0 END) AS late_line
FROM {lineitem} GROUP BY l_orderkey
"""

_EARLY = "edicao <> '2025-2026'"
_LATER = "edicao <> '2023-2024'"
_LAST = "edicao = '2025-2026'"
_MANAGER = "asked_as = '2-HIGH'"
_ALL = "edicao IS NOT NULL"
# (prefix, who is asked, {option: (flag, waves it is mapped in)})
_GROUPS = [
    ("linguagem_de_programacao_dia_a_dia_", _EARLY,
     {"sql": ("big", _ALL), "python": ("full_price", _ALL), "r": ("returned", _ALL), "scala": ("late_line", _ALL)}),
    ("banco_de_dados_dia_a_dia_", _LATER,
     {"postgresql": ("deal", _ALL), "sql_server": ("taxed", _ALL), "sqlite": ("tiny", _ALL)}),
    ("cloud_dia_a_dia_", _ALL,
     {"amazon_web_services_aws": ("big", _LATER), "azure_microsoft": ("deal", _LATER),
      "google_cloud_gcp": ("dear", _LATER), "servidores_on_premise_nao_utilizamos_cloud": ("taxed", _ALL)}),
    ("ferramenta_de_bi_dia_a_dia_", _ALL,
     {"microsoft_powerbi": ("open_line", _ALL), "tableau": ("tiny", _ALL), "looker": ("dear", _ALL),
      "grafana": ("late_line", _ALL), "metabase": ("deal", _ALL), "qlik": ("full_price", _ALL)}),
    ("ferramentas_etl_de_", "asked_as = '1-URGENT' AND edicao <> '2023-2024'",
     {"scripts_python": ("open_line", _ALL), "sql_stored_procedures": ("big", _ALL), "apache_airflow": ("late_line", _ALL)}),
    ("ferramentas_etl_da_", "asked_as = '3-MEDIUM' AND edicao <> '2023-2024'",
     {"scripts_python": ("returned", _ALL), "sql_stored_procedures": ("dear", _ALL), "apache_airflow": ("late_line", _LATER)}),
    ("linguagem_preferida_", _LAST, {"python": ("open_line", _ALL), "sql": ("big", _ALL), "r": ("tiny", _ALL)}),
    ("usa_chatgpt_ou_copilot_no_trabalho_", _ALL,
     dict(zip(v.PERSONAL_USE, [("dear", _ALL), ("open_line", _ALL), ("big", _ALL), ("deal", _ALL), ("late_line", _ALL)], strict=True))),
    ("tipo_de_uso_de_ai_generativa_e_llm_na_empresa_", _MANAGER,
     dict(zip(v.COMPANY_USE, [("open_line", _ALL), ("big", _ALL), ("dear", _ALL), ("deal", _ALL), ("taxed", _ALL),
                              ("late_line", _ALL), ("tiny", _LATER), ("returned", _ALL)], strict=True))),
    ("motivos_para_nao_usar_ai_generativa_e_llm_", "asked_as IN ('2-HIGH', '5-LOW')",
     dict(zip(v.BARRIERS, [("open_line", _ALL), ("big", _ALL), ("dear", _ALL), ("deal", _ALL), ("taxed", _ALL),
                           ("late_line", _ALL), ("tiny", _ALL), ("returned", _ALL), ("full_price", _ALL)], strict=True))),
    ("desafios_como_gestor_", _MANAGER,
     {"contratar_talentos": ("big", _LATER), "gerar_valor": ("deal", _ALL), "gerir_projetos": ("returned", _LATER)}),
    ("motivo_insatisfacao_", _ALL,
     {"salario": ("dear", _LATER), "falta_de_crescimento": ("tiny", _ALL), "clima": ("taxed", _ALL),
      "lideranca": ("late_line", _ALL), "beneficios": ("deal", _ALL), "carga": ("big", _ALL)}),
    ("criterios_para_escolha_de_emprego_", _ALL,
     {"remuneracao_salario": ("open_line", _ALL), "remoto": ("big", _ALL), "carreira": ("full_price", _ALL)}),
]
OPTION_COLUMNS = [prefix + option for prefix, _, options in _GROUPS for option in options]
_OPTION_SQL = ",\n       ".join(
    f"CASE WHEN {asked} AND {mapped} THEN CAST(f.{flag} AS {{S}}) END AS {prefix}{option}"
    for prefix, asked, options in _GROUPS
    for option, (flag, mapped) in options.items()
)
# Respondents with the multi-select answers; without any line they were asked none.
SURVEY = f"""
SELECT p.resp, p.edicao, p.ai_generativa_e_llm_e_uma_prioridade,
       {_OPTION_SQL}
FROM ({PEOPLE}) p LEFT JOIN ({LINE_FLAGS}) f ON p.resp = f.l_orderkey
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """A view text over the Parquet tables it names."""
    used = {t: table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in text}
    return spark.sql(text.replace("{S}", "STRING"), **used)


def duck(text: str) -> str:
    """The same text for DuckDB, where the tables are views of the same names."""
    return text.format(S="VARCHAR", **{t: t for t in TABLES})


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, RESPONSES)


def flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, FLAGS)


def question_names(spark: SparkSession, sf_dir: str, wave: str) -> DataFrame:
    """``(position, name)`` of one wave's question names, stored as a small table."""
    names = view(spark, sf_dir, NAME_CATALOG).filter(F.col("wave") == wave)
    return stored(names.select("position", "name"), f"names-{wave}")


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, PEOPLE)


def survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, SURVEY)
