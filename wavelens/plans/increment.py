"""Waves merged one by one: a wave that is new is staged, matched and counted alone.

A manifest says, for every wave that has been merged, which raw files it came from (path,
length, time of change), its staged columns and where each canonical column comes from. A
run compares it with the raw files by listing them. Only waves whose files are new or
changed are read from raw; what the other layers hold of a wave is written again only
where its mapping changed, and from the layer before it. Every write replaces what one
wave has in one layer, and the manifest's entry comes last, so that a run that died is
made good by the next one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wavelens.operators.matching import canonical_map, match_names
from wavelens.operators.profile import ProfileOnWrite
from wavelens.operators.standardize import conform, standardize, union_all_by_name, with_row_id
from wavelens.plans import fixed_values as v
from wavelens.plans.flow import PARTITION, ROW_ID, WAVE, Layout
from wavelens.plans.gold import TABLES
from wavelens.plans.gold_once import ADOPTIONS, all_tables
from wavelens.session import header_table, small_methods
from wavelens.sources import readers, writers

ENTRY = "wave string, fingerprint string, columns array<string>, mapping map<string,string>"

#: Dimensions besides the wave; a table counts by those of them that exist.
DIMENSIONS = ["cargo_atual", "nivel", "genero", "regiao_onde_mora", "modelo_de_trabalho_atual"]


@dataclass(frozen=True)
class Entry:
    """What the manifest says of a wave."""

    fingerprint: str = ""
    columns: list[str] = field(default_factory=list)
    mapping: dict[str, str] = field(default_factory=dict)


def _manifest(layout: Layout) -> str:
    return f"{layout.root}/manifest"


def _matches(layout: Layout) -> str:
    return layout.document("matches")


def _nulls(layout: Layout) -> str:
    return layout.document("nulls")


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table written wave by wave; empty before its first wave."""
    if not readers.exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def read_manifest(spark: SparkSession, layout: Layout) -> dict[str, Entry]:
    """One entry per merged wave; as small as the tables' headers."""
    rows = _read(spark, _manifest(layout), ENTRY).collect()
    return {r["wave"]: Entry(r["fingerprint"], r["columns"], r["mapping"]) for r in rows}


def fingerprints(spark: SparkSession, raw: Mapping[str, str]) -> dict[str, str]:
    """A digest of the names, lengths and times of change of each wave's raw files.

    Files are listed, not read. A folder or pattern without files is an error.
    """
    out = {}
    for wave, path in raw.items():
        files = spark.read.format("binaryFile").load(path).select("path", "length", F.col("modificationTime").cast("string"))
        found = sorted(map(tuple, files.collect()))
        if not found:
            raise FileNotFoundError(f"no raw files of {wave} in {path}")
        out[wave] = hashlib.sha256(repr(found).encode()).hexdigest()
    return out


def stage(spark: SparkSession, layout: Layout, wave: str, raw: str, style: str, aliases: Sequence, fixes: Mapping | None) -> None:
    """Write a wave under its normalised names; its null dictionary comes from the same job."""
    with small_methods(spark):
        out, profile = ProfileOnWrite.of(standardize(readers.read_wave(spark, raw), style, aliases, fixes))
        writers.write_table(out, layout.staging(wave))
    writers.write_wave(profile.null_dictionary(spark, wave), _nulls(layout), wave, "part")


def match(spark: SparkSession, layout: Layout, wave: str, columns: Sequence[str], base: Sequence[str]) -> None:
    """Propose which columns of one wave are the base wave's."""
    found = match_names(header_table(spark, base), header_table(spark, columns)).withColumn("wave", F.lit(wave))
    writers.write_wave(found, _matches(layout), wave, "part")


MATCHES = "base string, other string, method string, score double, confidence string, wave string"


def mappings(spark: SparkSession, layout: Layout, base: str, columns: Mapping[str, Sequence[str]], reviews: DataFrame | None = None) -> dict[str, dict[str, str]]:
    """``{wave: {canonical: source}}`` from the stored matches of all waves.

    ``reviews`` is ``(wave, base, other, review)`` with ``approved`` or ``rejected``.
    """
    found = _read(spark, _matches(layout), MATCHES)
    if reviews is None:
        found = found.withColumn("review", F.lit(None).cast("string"))
    else:
        found = found.join(reviews.select("wave", "base", "other", "review"), ["wave", "base", "other"], "left")
    out = {base: {c: c for c in columns[base]}}
    for wave in columns:
        if wave == base:
            continue
        own = found.filter(F.col("wave") == wave).select(
            "base", *[F.col(c).alias(f"{new}_{wave}") for c, new in (("other", "name"), ("method", "method"), ("confidence", "confidence"), ("review", "review"))]
        )
        rows = canonical_map(own, base, [wave]).filter(F.col("wave") == wave).collect()
        out[wave] = {r["canonical"]: r["source"] for r in rows if r["source"] in columns[wave]}
    return out


def read_silver(spark: SparkSession, layout: Layout, entries: Mapping[str, Entry], waves: Sequence[str] | None = None) -> DataFrame:
    """The harmonised table, by the schema that the manifest holds; columns a wave lacks are NULL."""
    canonical = sorted(set().union(*(e.mapping for e in entries.values())))
    fields = [T.StructField(ROW_ID, T.LongType()), *[T.StructField(c, T.StringType()) for c in [*canonical, PARTITION]]]
    rows = spark.read.schema(T.StructType(fields)).parquet(layout.silver).withColumnRenamed(PARTITION, WAVE)
    return rows if waves is None else rows.filter(F.col(WAVE).isin(list(waves)))


def update(
    spark: SparkSession,
    layout: Layout,
    raw: Mapping[str, str],
    base: str = v.MIDDLE_WAVE,
    reviews: DataFrame | None = None,
    styles: Mapping[str, str] = v.HEADER_STYLE,
    aliases: Mapping[str, Sequence] = v.ALIAS_CODES,
) -> list[str]:
    """Bring all layers up to date with the raw waves; the waves that were read from raw.

    ``raw`` maps waves to their files; waves merged earlier may be left out and stay. The
    first run must have the base wave. A base that changed is matched with all waves anew,
    from their staged names.
    """
    done = read_manifest(spark, layout)
    prints = fingerprints(spark, raw)
    new = [w for w in raw if w not in done or done[w].fingerprint != prints[w]]
    if base not in done and base not in new:
        raise ValueError(f"the base wave {base} has not been merged and is not among the raw waves")
    for wave in new:
        style = styles[wave]
        stage(spark, layout, wave, raw[wave], style, aliases.get(wave, ()), v.HEADER_FIXES if style == "tuple" else None)
    columns = {w: e.columns for w, e in done.items()}
    columns |= {w: readers.read_staging(spark, layout.staging(w)).columns for w in new}
    for wave in columns if base in new else new:
        if wave != base:
            match(spark, layout, wave, columns[wave], columns[base])
    mapped = mappings(spark, layout, base, columns, reviews)
    changed = [w for w in columns if w in new or mapped[w] != done[w].mapping]
    if not changed:
        return []
    for wave in changed:
        staged = readers.read_staging(spark, layout.staging(wave))
        rows = with_row_id(conform(staged, mapped[wave], sorted(mapped[wave])), ROW_ID)
        with small_methods(spark):
            writers.write_wave(rows, layout.silver, wave, PARTITION)
    canonical = sorted(set().union(*mapped.values()))
    entries = {
        w: Entry(prints[w] if w in new else done[w].fingerprint, list(columns[w]), mapped[w]) for w in columns
    }
    before = {d for e in done.values() for d in e.mapping} & set(DIMENSIONS)
    same_dimensions = before == set(canonical) & set(DIMENSIONS)
    build_gold(spark, layout, entries, [w for w in entries if w in changed or not same_dimensions])
    for wave in changed:
        e = entries[wave]
        row = [(wave, e.fingerprint, e.columns, e.mapping)]
        writers.write_wave(spark.createDataFrame(row, ENTRY), _manifest(layout), wave, "part")
    return new


def build_gold(spark: SparkSession, layout: Layout, entries: Mapping[str, Entry], waves: Sequence[str]) -> None:
    """Count the given waves, each in one scan of its own partition, into the pre-aggregated tables.

    All tables are by wave, so a wave's part depends on no other wave.
    """
    for wave in waves:
        for name, table in all_tables(read_silver(spark, layout, entries, [wave])).items():
            writers.write_wave(table, layout.gold(name), wave, "part")


def read_gold(spark: SparkSession, layout: Layout, entries: Mapping[str, Entry], name: str) -> DataFrame:
    """A pre-aggregated table over all waves.

    An option that a later wave brought in counts as asked in the earlier ones too, by
    nobody chosen: its row there follows from the others of its group.
    """
    silver = read_silver(spark, layout, entries)
    table = TABLES[name](silver.limit(0))
    rows = spark.read.schema(table.schema).parquet(layout.gold(name)).select(*table.columns)
    if name not in ADOPTIONS:
        return rows
    canonical = [c for c in silver.columns if c not in (WAVE, ROW_ID)]
    options = [
        (category, c[len(prefix):]) for category, prefix in ADOPTIONS[name].items() for c in canonical if c.startswith(prefix)
    ]
    listed = spark.createDataFrame(options, "categoria string, opcao string")
    given = rows.filter(F.col("opcao").isNotNull())
    asked = given.groupBy(WAVE, "categoria").agg(F.max("elegiveis").alias("elegiveis"))
    absent = asked.join(listed, "categoria").join(given, [WAVE, "categoria", "opcao"], "left_anti")
    zero = absent.withColumn("selecionaram", F.lit(0.0)).withColumn("pct_adocao", F.lit(0.0))
    return union_all_by_name([rows, zero]).select(*table.columns)
