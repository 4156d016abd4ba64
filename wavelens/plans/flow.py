"""From raw waves to published results, one step per function.

Every step reads what the step before has written, so steps can be run and
repeated on their own. Between ``match_columns`` and ``build_silver`` the
dictionary may be reviewed: a column ``review_<wave>`` holding ``approved`` or
``rejected`` overrides the match.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wavelens.operators.matching import canonical_map, canonical_names, correspond
from wavelens.operators.profile import null_dictionary
from wavelens.operators.standardize import conform, standardize, union_all_by_name, with_row_id
from wavelens.plans import fixed_values as v
from wavelens.plans.gold import TABLES
from wavelens.plans.reports import REPORTS
from wavelens.session import header_table
from wavelens.sources import readers, writers

# Names of the harmonised table's own columns.
WAVE = "edicao"
PARTITION = "particao"
ROW_ID = "linha_origem_silver"


@dataclass(frozen=True)
class Layout:
    """Where the layers live below one root folder."""

    root: str

    def staging(self, wave: str) -> str:
        return f"{self.root}/staging/{wave}"

    def document(self, name: str) -> str:
        return f"{self.root}/documents/{name}"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver"

    def gold(self, table: str) -> str:
        return f"{self.root}/gold/{table}"

    def result(self, name: str) -> str:
        return f"{self.root}/results/{name}"


def stage_wave(
    spark: SparkSession, layout: Layout, wave: str, raw: str, corrections: Mapping[str, str] | None = None
) -> None:
    """Standardise the raw file of one wave."""
    style = v.HEADER_STYLE[wave]
    fixes = v.HEADER_FIXES if style == "tuple" else None
    out = standardize(
        readers.read_wave(spark, raw), style, v.ALIAS_CODES[wave], fixes, corrections
    )
    writers.write_table(out, layout.staging(wave))


def document_nulls(spark: SparkSession, layout: Layout, waves: Sequence[str] = v.WAVES) -> None:
    parts = [null_dictionary(readers.read_staging(spark, layout.staging(w)), w) for w in waves]
    out = union_all_by_name(parts).orderBy("wave", F.desc("pct_null"), "column")
    writers.export_csv(out, layout.document("null_dictionary"))


def match_columns(
    spark: SparkSession, layout: Layout, base: str = v.MIDDLE_WAVE, waves: Sequence[str] = v.WAVES
) -> None:
    """Propose which columns of the other waves are the base wave's."""
    names = {
        w: header_table(spark, readers.read_staging(spark, layout.staging(w)).columns) for w in waves
    }
    out = correspond(names[base], {w: names[w] for w in waves if w != base})
    writers.export_csv(out, layout.document("column_dictionary"))


def build_silver(
    spark: SparkSession,
    layout: Layout,
    base: str = v.MIDDLE_WAVE,
    waves: Sequence[str] = v.WAVES,
    dictionary: str | None = None,
    table: str | None = None,
) -> None:
    """Write every wave under the canonical schema into its own partition."""
    others = [w for w in waves if w != base]
    path = dictionary or layout.document("column_dictionary")
    mapping = canonical_map(readers.read_dictionary(spark, path, base, others), base, others)
    canonical = [r["canonical"] for r in canonical_names(mapping).collect()]
    sources: dict[str, dict[str, str]] = {w: {} for w in waves}
    for row in mapping.collect():
        sources[row["wave"]][row["canonical"]] = row["source"]
    for wave in waves:
        staged = readers.read_staging(spark, layout.staging(wave))
        rows = with_row_id(conform(staged, sources[wave], canonical), ROW_ID)
        writers.write_wave(rows, layout.silver, wave, PARTITION)
    if table:
        writers.register_table(read_silver(spark, layout, PARTITION), table, layout.silver, [PARTITION])


def read_silver(spark: SparkSession, layout: Layout, dimension: str = WAVE) -> DataFrame:
    """The harmonised table with its partition column as the wave dimension.

    The wave is read as text by a stated schema, so that ``01`` stays ``01``.
    """
    found = spark.read.parquet(layout.silver).schema
    fields = [T.StructField(f.name, T.StringType() if f.name == PARTITION else f.dataType) for f in found]
    rows = spark.read.schema(T.StructType(fields)).parquet(layout.silver)
    return rows.withColumnRenamed(PARTITION, dimension)


def build_gold(spark: SparkSession, layout: Layout, database: str | None = None) -> None:
    """Write the pre-aggregated tables; each scans only the columns it counts."""
    silver = read_silver(spark, layout)
    for name, build in TABLES.items():
        writers.write_table(build(silver), layout.gold(name))
        if database:
            stored = spark.read.parquet(layout.gold(name))
            writers.register_table(stored, f"{database}.{name}", layout.gold(name))


def export_results(spark: SparkSession, layout: Layout, sep: str = ",") -> None:
    """Write every published result as a CSV file."""
    for name, (table, query) in REPORTS.items():
        writers.export_csv(query(spark.read.parquet(layout.gold(table))), layout.result(name), sep)
