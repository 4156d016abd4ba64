"""Waves merged one by one: what is read again, what is not, and that the result is the same."""

import csv
import shutil

import pytest
from pyspark.sql import functions as F

from wavelens.operators.profile import ProfileOnWrite, null_dictionary
from wavelens.plans import fixed_values as v
from wavelens.plans import flow, gold_once, increment
from wavelens.plans.gold import TABLES

W1, W2, W3 = v.WAVES
LABELS = {"2.f": "Cargo Atual", "2.g": "Nível", "2.h": "Faixa Salarial", "1.b": "Gênero", "4.g": "Banco de Dados (dia a dia)",
          "4.g.1": "PostgreSQL", "4.g.2": "SQLite"}


def write_wave(root, wave, extra=(), respell=None, n=60):
    """A raw wave; ``extra`` are further options of the group, ``respell`` another label of the level."""
    labels = dict(LABELS, **{f"4.g.{i}": x for i, x in enumerate(extra, 3)})
    if respell:
        labels["2.g"] = respell
    tuples = v.HEADER_STYLE[wave] == "tuple"
    header = [f"('P{c.replace('.', '_')} ', '{x}')" if tuples else f"{c}_{x}" for c, x in labels.items()]
    rows = []
    for i in range(n):
        asked = i % 5 > 0
        flags = [str((i + k) % 2) if asked else "" for k in range(2 + len(extra))]
        rows.append([f"papel {i % 3}", v.LEVELS[i % 3], v.PAY_BANDS[i % 7], "Feminino" if i % 4 else "Masculino",
                     "quebra\nde linha" if asked else "", *flags])
    root.mkdir(parents=True, exist_ok=True)
    with open(root / f"{wave}.csv", "w", newline="", encoding="utf-8") as out:
        csv.writer(out).writerows([header, *rows])
    return str(root / f"{wave}.csv")


@pytest.fixture
def read_paths(monkeypatch):
    """Raw files that a run really reads."""
    seen, read = [], increment.readers.read_wave
    monkeypatch.setattr(increment.readers, "read_wave", lambda spark, path: seen.append(path) or read(spark, path))
    return seen


def tables(spark, layout):
    entries = increment.read_manifest(spark, layout)
    return {name: sorted(map(tuple, increment.read_gold(spark, layout, entries, name).collect()), key=repr) for name in TABLES}


def at_once(spark, layout):
    """The same tables by the one-step functions over the whole harmonised table."""
    silver = increment.read_silver(spark, layout, increment.read_manifest(spark, layout))
    return {name: sorted(map(tuple, build(silver).collect()), key=repr) for name, build in TABLES.items()}


@pytest.mark.filterwarnings("ignore:no column starts with")
def test_a_new_wave_reads_no_old_raw_file(spark, tmp_path, read_paths):
    layout = flow.Layout(str(tmp_path / "lake"))
    raw = {w: write_wave(tmp_path / "raw", w) for w in (W1, W2)}
    assert increment.update(spark, layout, raw) == [W1, W2]
    before = tables(spark, layout)
    assert before == at_once(spark, layout)
    assert increment.update(spark, layout, raw) == [] and len(read_paths) == 2
    raw[W3] = write_wave(tmp_path / "raw", W3, extra=["DuckDB"], respell="Níveis")
    assert increment.update(spark, layout, raw) == [W3]
    assert read_paths[2:] == [raw[W3]]
    after = tables(spark, layout)
    assert after == at_once(spark, layout) and before["gold_01_estrutura_mercado"] != after["gold_01_estrutura_mercado"]
    zero = [r for r in after["gold_04_adocao_tecnologias"] if "duckdb" in r and r[0] == W1]
    assert zero == [(W1, "duckdb", 48, 0.0, 0.0, "banco_de_dados")]


@pytest.mark.filterwarnings("ignore:no column starts with")
def test_changed_files_reviews_and_a_lost_entry(spark, tmp_path, read_paths):
    layout = flow.Layout(str(tmp_path / "lake"))
    raw = {w: write_wave(tmp_path / "raw", w, respell="Nível x" if w == W3 else None) for w in v.WAVES}
    increment.update(spark, layout, raw)
    manifest = increment.read_manifest(spark, layout)
    assert "nivel" not in manifest[W3].mapping  # likeness 0.71 is not trusted
    verdict = spark.createDataFrame([(W3, "nivel", "nivel_x", "approved")], "wave string, base string, other string, review string")
    del read_paths[:]
    assert increment.update(spark, layout, raw, reviews=verdict) == [] and read_paths == []
    assert increment.read_manifest(spark, layout)[W3].mapping["nivel"] == "nivel_x"
    assert tables(spark, layout) == at_once(spark, layout)
    write_wave(tmp_path / "raw", W1, n=40)
    assert increment.update(spark, layout, raw, reviews=verdict) == [W1]
    shutil.rmtree(f"{layout.root}/manifest/part={W2}")  # as if the run had died before its last write
    assert increment.update(spark, layout, raw, reviews=verdict) == [W2]
    assert tables(spark, layout) == at_once(spark, layout)


def test_the_base_wave_must_be_there(spark, tmp_path):
    with pytest.raises(ValueError, match="base wave"):
        increment.update(spark, flow.Layout(str(tmp_path)), {W1: write_wave(tmp_path, W1)})


def test_a_profile_comes_from_the_job_that_writes(spark, tmp_path):
    rows = [(str(i % 2), None if i % 3 else "x", "7", None) for i in range(30)]
    df = spark.createDataFrame(rows, "flag string, `a.b` string, seven string, none string")
    out, profile = ProfileOnWrite.of(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("CollectMetrics") == 1
    out.write.parquet(str(tmp_path / "t"))
    assert profile.rows == 30
    assert sorted(map(tuple, profile.null_dictionary(spark, "w").collect())) == sorted(map(tuple, null_dictionary(df, "w").collect()))


@pytest.fixture(scope="module")
def silver(spark, tmp_path_factory):
    """Responses with NULL dimensions, unanswered groups and flags that are no numbers."""
    path = str(tmp_path_factory.mktemp("silver") / "t")
    flags = [f"{p}{o}" for p in ("cloud_dia_a_dia_", "motivos_para_nao_usar_ai_generativa_e_llm_", "motivo_insatisfacao_") for o in "xyz"]
    pick = lambda n, name: F.when(F.col("id") % n > 0, F.concat(F.lit(name), (F.col("id") % n).cast("string")))
    spark.range(500).select(
        (F.col("id") % 3).cast("string").alias("edicao"), *[pick(i + 3, c).alias(c) for i, c in enumerate(
            ["cargo_atual", "nivel", "faixa_salarial", "genero", "cor_raca_etnia", "regiao_onde_mora", "setor", v.AI_PRIORITY_VARIABLE])],
        *[F.when(F.col("id") % 4 > 1, F.when(F.col("id") % 97 == 5, "?").otherwise(((F.col("id") + i) % 2).cast("string"))).alias(c) for i, c in enumerate(flags)],
    ).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.filterwarnings("ignore:no column starts with")
def test_seven_tables_at_once_are_those_built_alone(silver):
    got = gold_once.all_tables(silver)
    assert list(got) == list(TABLES)
    for name, build in TABLES.items():
        alone = build(silver)
        assert [(f.name, f.dataType) for f in got[name].schema] == [(f.name, f.dataType) for f in alone.schema], name
        assert sorted(map(tuple, got[name].collect()), key=repr) == sorted(map(tuple, alone.collect()), key=repr), name


@pytest.mark.filterwarnings("ignore:no column starts with")
def test_all_counts_are_one_scan_and_one_exchange(silver):
    counts = gold_once.count_everything(silver, gold_once.questions(silver.columns, silver))
    counts.collect()
    plan = counts._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 1 and plan.count("- Exchange ") == 1


@pytest.mark.filterwarnings("ignore:no column starts with")
def test_a_table_without_its_questions_is_empty(spark):
    got = gold_once.all_tables(spark.createDataFrame([("w", "a")], "edicao string, setor string"))
    assert {name: df.count() for name, df in got.items()} == {name: int(name.startswith("gold_01")) for name in TABLES}
