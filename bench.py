"""Time the headline queries; prints one JSON line.

Settings: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default all).
Each query runs twice on a warm session and its faster run counts.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parent
sys.path.insert(0, str(ROOT))

HEADLINES = [
    "survey_distribution",
    "survey_adoption",
    "survey_adoption_groups",
    "ordinal_quantile_exact",
    "survey_crossed_quantile",
    "survey_rank_profiles",
    "survey_band_movement",
    "survey_reshare",
    "survey_evolution",
    "survey_evolution_available",
    "survey_subgroup_share",
    "survey_null_dictionary",
    "survey_standardize",
    "survey_correspondence",
    "clean_mojibake",
    "clean_normalize_name",
    "profile_distinct",
    "gold_01_estrutura_mercado",
    "gold_03_diversidade_genero",
    "gold_04_adocao_tecnologias",
    "gold_05_adocao_ia",
    "gold_06_diferencas_regiao_senioridade_modelo",
    "gold_07_oportunidades_desafios",
    "result_cargos_historico",
    "result_perfis_evolucao_historica",
    "result_ranking_adocao_por_categoria",
    "result_senioridade_x_regiao",
]


def run(spark, query, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    from wavelens.registry import QUERIES
    from wavelens.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = local_session("bench", cpus, **{"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, QUERIES["agg_count"].run, sf_dir)
    times = {}
    for key in HEADLINES:
        times[key] = round(min(run(spark, QUERIES[key].run, sf_dir) for _ in range(2)), 3)
    spark.stop()
    result = {
        "metric": "headline queries, total time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "cpus": int(cpus),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
