"""Data-quality checks: each returns the rows to look at."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavelens.operators.filters import out_of_range


def name_collisions(catalog: DataFrame, name: str = "name", keys: Sequence[str] = ()) -> DataFrame:
    """Names that more than one column would get."""
    counted = catalog.groupBy(*keys, name).agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") > 1)


def base_audit(df: DataFrame, dims: Sequence[str], count: str = "n", base: str = "base") -> DataFrame:
    """Sum of parts against the stated base, which must be one per slice."""
    out = df.groupBy(*dims).agg(
        F.sum(count).alias("sum_of_parts"),
        F.max(base).alias("stated_base"),
        F.countDistinct(base).alias("n_bases"),
    )
    fine = (F.col("sum_of_parts") == F.col("stated_base")) & (F.col("n_bases") == 1)
    return out.withColumn("status", F.when(fine, "OK").otherwise("VERIFICAR"))


def pct_sum(df: DataFrame, dims: Sequence[str], pct: str = "pct") -> DataFrame:
    """Sum of the shares of each slice, rounded to two decimals."""
    return df.groupBy(*dims).agg(F.round(F.sum(pct), 2).alias("pct_sum"))


def pct_out_of_range(
    df: DataFrame, dims: Sequence[str], pct: str = "pct", low: float = 99.9, high: float = 100.1
) -> DataFrame:
    return out_of_range(pct_sum(df, dims, pct), "pct_sum", low, high)


def unmapped_labels(df: DataFrame, label: str, position: str) -> DataFrame:
    """Labels that an ordinal scale left without a position."""
    missing = df.filter(F.col(label).isNotNull() & F.col(position).isNull())
    return missing.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def label_presence(df: DataFrame, label: str, wave: str) -> DataFrame:
    """Waves every label occurs in; a short list shows a change of wording."""
    seen = df.filter(F.col(label).isNotNull())
    return seen.groupBy(label).agg(
        F.countDistinct(wave).alias("n_waves"),
        F.min(wave).alias("first_wave"),
        F.max(wave).alias("last_wave"),
    )


def unrecognised(df: DataFrame, label: str, known: Sequence[str]) -> DataFrame:
    """Labels outside a known list, with their rows."""
    strange = df.filter(F.col(label).isNotNull() & ~F.col(label).isin(list(known)))
    return strange.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
