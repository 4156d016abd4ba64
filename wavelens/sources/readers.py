"""Reading raw waves, staged tables and dictionaries."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wavelens.functions.text import lit_col, repair_mojibake


def read_wave(spark: SparkSession, path: str) -> DataFrame:
    """A raw wave: CSV, every column text, quoted line breaks, damage repaired.

    The header is repaired with the same expression as the values.
    """
    raw = (
        spark.read.option("header", True)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("encoding", "UTF-8")
        .csv(path)
    )
    names = spark.sql("SELECT 1").select(
        F.array(*[repair_mojibake(F.lit(c)) for c in raw.columns])
    ).first()[0]
    raw = raw.toDF(*names)
    return raw.select(*[repair_mojibake(lit_col(c)).alias(c) for c in names])


def read_staging(spark: SparkSession, path: str) -> DataFrame:
    """A standardised wave (Parquet, so typed and column-pruned)."""
    return spark.read.parquet(path)


def read_gold(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Pre-aggregated CSV parts with a declared schema: no inference job.

    Columns are matched by header name, so a reordered file fails instead of
    shifting values.
    """
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def read_waves(spark: SparkSession, name: str, storage: str, dimension: str) -> DataFrame:
    """A catalogued table whose partition column is shown as the wave dimension."""
    table = spark.table(name)
    return table.withColumnRenamed(storage, dimension) if storage != dimension else table


def name_catalog(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(wave, position, name)`` for every column; reads no data."""
    rows = [(w, i, c) for w, df in tables.items() for i, c in enumerate(df.columns)]
    return spark.createDataFrame(rows, "wave string, position int, name string")


def read_dictionary(spark: SparkSession, path: str, base: str, others: list[str]) -> DataFrame:
    """The reviewed correspondence dictionary, typed by position-free header names."""
    header = spark.read.option("header", True).csv(path)
    typed = {f"score_{w}": T.DoubleType() for w in others}
    out = header.select(*[lit_col(c).cast(typed.get(c, T.StringType())).alias(c) for c in header.columns])
    for wave in others:
        review = f"review_{wave}"
        if review not in out.columns:
            out = out.withColumn(review, F.lit(None).cast("string"))
    return out


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder ``path``, in whatever store it lies."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def require_source(spark: SparkSession, pattern: str) -> str:
    """The one folder with files that matches ``pattern``; none or several is an error.

    Lists files without reading them. Spark itself stops at a pattern that
    matches nothing.
    """
    files = spark.read.format("binaryFile").load(pattern)
    folder = F.regexp_extract("path", "^(.*)/[^/]+$", 1)
    found = sorted(r[0] for r in files.select(folder).distinct().collect())
    if not found:
        raise FileNotFoundError(f"no files in {pattern}")
    if len(found) > 1:
        raise ValueError(f"several folders match {pattern}: {found}")
    return found[0]
