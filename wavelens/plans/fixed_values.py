"""Fixed values of the annual data-professionals survey.

Everything here must read exactly like the survey data or the published result
tables, so it is stated as it is there: waves, labels, scales, prefixes, limits.
"""

WAVES = ["2023-2024", "2024-2025", "2025-2026"]
FIRST_WAVE, MIDDLE_WAVE, LAST_WAVE = WAVES

# Limits
MIN_BASE = 20
SMALL_BASE = 30
SINGLE_ANSWER = 1
TOP_K = 5
TOP_ROLES = 3
TOP_SECTORS = 2

# Role taxonomy
ROLE_MERGE = {
    "Engenharia e Arquitetura de Dados": [
        "Engenheiro de Dados/Arquiteto de Dados/Data Engineer/Data Architect",
        "Engenheiro de Dados/Data Engineer/Data Architect",
        "Arquiteto de Dados/Data Architect",
    ]
}
CATCH_ALL_ROLE = "Outra Opção"
HISTORY_ROLES = [
    "Cientista de Dados/Data Scientist",
    "Engenheiro de Machine Learning/ML Engineer/AI Engineer",
    "Engenharia e Arquitetura de Dados",
    "Analytics Engineer",
    "Desenvolvedor/ Engenheiro de Software/ Analista de Sistemas",
]

# Levels
LEVELS = ["Júnior", "Pleno", "Sênior", "Especialista/Staff+"]
HISTORY_LEVELS = ["Júnior", "Pleno", "Sênior"]
EXPERIENCED_LEVELS = ["Sênior", "Especialista/Staff+"]

# Pay bands, lowest first, and labels known to be wrong
PAY_BANDS = [
    "Menos de R$ 1.000/mês",
    "de R$ 1.001/mês a R$ 2.000/mês",
    "de R$ 2.001/mês a R$ 3.000/mês",
    "de R$ 3.001/mês a R$ 4.000/mês",
    "de R$ 4.001/mês a R$ 6.000/mês",
    "de R$ 6.001/mês a R$ 8.000/mês",
    "de R$ 8.001/mês a R$ 12.000/mês",
    "de R$ 12.001/mês a R$ 16.000/mês",
    "de R$ 16.001/mês a R$ 20.000/mês",
    "de R$ 20.001/mês a R$ 25.000/mês",
    "de R$ 25.001/mês a R$ 30.000/mês",
    "de R$ 30.001/mês a R$ 40.000/mês",
    "Acima de R$ 40.001/mês",
]
BAD_PAY_BAND = "de R$ 101/mês a R$ 2.000/mês"
BAD_COMPANY_SIZE = "de 501 a 100"

# Gender and race
WOMEN = "Feminino"
RACE_EXCLUDED = ["Prefiro não informar", "Outra"]

# Work models
REMOTE = "Modelo 100% remoto"
REMOTE_GROUP = "100% remoto"
ON_SITE_GROUP = "Com componente presencial"
WORK_MODELS = {
    "Modelo 100% remoto": "100% remoto",
    "Modelo 100% presencial": "100% presencial",
    "Modelo híbrido com dias fixos de trabalho presencial": "Híbrido com dias fixos",
    "Modelo híbrido flexível (o funcionário tem liberdade para escolher quando estar no escritório presencialmente)": "Híbrido flexível",
}

# Variables and option prefixes of the pre-aggregated tables
MARKET_VARIABLES = [
    "cargo_atual",
    "nivel",
    "situacao_de_trabalho",
    "modelo_de_trabalho_atual",
    "regiao_onde_mora",
    "setor",
    "numero_de_funcionarios",
]
GENDER_VARIABLES = ["cargo_atual", "nivel", "faixa_salarial", "cor_raca_etnia"]
TECHNOLOGY_GROUPS = {
    "linguagem_de_programacao": "linguagem_de_programacao_dia_a_dia_",
    "banco_de_dados": "banco_de_dados_dia_a_dia_",
    "cloud": "cloud_dia_a_dia_",
    "ferramenta_de_bi": "ferramenta_de_bi_dia_a_dia_",
    "ferramenta_etl_data_engineer": "ferramentas_etl_de_",
    "ferramenta_etl_data_analyst": "ferramentas_etl_da_",
    "linguagem_preferida_2025_2026": "linguagem_preferida_",
}
AI_PRIORITY_VARIABLE = "ai_generativa_e_llm_e_uma_prioridade"
AI_PRIORITY_CATEGORY = "ia_generativa_prioridade_na_empresa"
AI_GROUPS = {
    "uso_pessoal_chatgpt_copilot": "usa_chatgpt_ou_copilot_no_trabalho_",
    "tipo_de_uso_de_ia_na_empresa": "tipo_de_uso_de_ai_generativa_e_llm_na_empresa_",
    "motivos_para_nao_usar_ia": "motivos_para_nao_usar_ai_generativa_e_llm_",
}
CHALLENGE_GROUPS = {
    "desafios_como_gestor": "desafios_como_gestor_",
    "motivo_insatisfacao_profissional": "motivo_insatisfacao_",
    "criterios_para_escolher_emprego": "criterios_para_escolha_de_emprego_",
    "motivos_para_nao_usar_ia": "motivos_para_nao_usar_ai_generativa_e_llm_",
}

# Display names
CATEGORY_NAMES = {
    "linguagem_de_programacao": "Linguagens de Programação",
    "ferramenta_de_bi": "Ferramentas de BI",
    "cloud": "Cloud",
    "banco_de_dados": "Bancos de Dados",
    "ferramenta_etl_data_engineer": "ETL - Data Engineer",
    "ferramenta_etl_data_analyst": "ETL - Data Analyst",
    "linguagem_preferida_2025_2026": "Linguagem Preferida",
}
NO_PERSONAL_USE = "nao_uso_solucoes_de_ai_generativa_com_foco_em_produtividade"
PRIORITY_RULES = [
    ("contains", "principal prioridade como empresa", "Principal prioridade"),
    ("contains", "principais prioridades para os próximos", "Entre as principais prioridades"),
    ("startswith", "Mais ou menos", "Iniciativa secundária"),
    ("startswith", "Não é uma iniciativa", "Não é prioridade"),
    ("startswith", "Não sei", "Não sabe opinar"),
]
PRIORITY_SCALE = [
    "Principal prioridade",
    "Entre as principais prioridades",
    "Iniciativa secundária",
    "Não é prioridade",
]
PRIORITY_OTHER = 5
PRIORITY_HIGH = [1, 2]
COMPANY_USE = {
    "colaboradores_usando_ai_generativa_de_forma_independente_e_descentralizada": "Uso independente/descentralizado",
    "direcionamento_centralizado_do_uso_de_ai_generativa": "Direcionamento centralizado",
    "desenvolvedores_utilizando_copilots": "Desenvolvedores usando Copilots",
    "ai_generativa_e_llms_para_melhorar_produtos_internos_para_os_colaboradores": "Melhoria de produtos internos",
    "ai_generativa_e_llms_para_melhorar_produtos_externos_para_os_clientes_finais": "Melhoria de produtos externos",
    "ia_generativa_e_llms_como_principal_frente_do_negocio": "IA como principal frente do negócio",
    "ia_generativa_e_llms_nao_e_prioridade": "IA não é prioridade",
    "nao_sei_opinar_sobre_o_uso_de_ia_generativa_e_llms_na_empresa": "Não sabe opinar",
}
PERSONAL_USE = {
    "a_empresa_que_trabalho_paga_pelas_solucoes_de_ai_generativa_com_foco_em_produtividade": "Empresa paga pela solução",
    "uso_solucoes_gratuitas_de_ai_generativa_com_foco_em_produtividade": "Uso soluções gratuitas",
    "uso_solucoes_do_tipo_copilot": "Uso soluções tipo Copilot",
    "uso_e_pago_pelas_solucoes_de_ai_generativa_com_foco_em_produtividade": "Uso e pago pela solução",
    "nao_uso_solucoes_de_ai_generativa_com_foco_em_produtividade": "Não uso IA generativa",
}
BARRIERS = {
    "falta_de_expertise_ou_falta_de_recursos": "Falta de expertise ou recursos",
    "dados_da_empresa_nao_estao_prontos_para_uso_de_ia_generativa": "Dados não estão preparados",
    "falta_de_compreensao_dos_casos_de_uso": "Falta de compreensão dos casos de uso",
    "retorno_sobre_investimento_roi_nao_comprovado_de_ia_generativa": "ROI não comprovado",
    "preocupacoes_com_seguranca_e_privacidade_de_dados": "Segurança e privacidade",
    "falta_de_confiabilidade_das_saidas_alucinacao_dos_modelos": "Confiabilidade das respostas",
    "incerteza_em_relacao_a_regulamentacao": "Incerteza regulatória",
    "preocupacoes_com_propriedade_intelectual": "Propriedade intelectual",
    "alta_direcao_da_empresa_nao_ve_valor_ou_nao_ve_como_prioridade": "Alta direção não vê valor/prioridade",
}

# Codes of the question put to managers and to everybody else, by wave
ALIAS_CODES = {
    "2023-2024": [("P3.f", "P4.l")],
    "2024-2025": [("3.f", "4.l")],
    "2025-2026": [("3.f", "4.i")],
}
HEADER_STYLE = {"2023-2024": "tuple", "2024-2025": "dotted", "2025-2026": "dotted"}
HEADER_FIXES = {
    "('P6_b_16 ', 'SQL Server Integration Services (SSIS))": (
        "P6_b_16",
        "SQL Server Integration Services (SSIS)",
    ),
}
