"""Categorical distributions: counts, bases and shares of single-choice answers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wavelens.functions.labels import share
from wavelens.functions.text import lit_col
from wavelens.operators.filters import not_null


def answers_long(df: DataFrame, variables: Sequence[str], dims: Sequence[str]) -> DataFrame:
    """``(dims…, variable, value)``, one row per given answer, from a single scan.

    Answers become rows by a generator rather than ``unpivot``: dimensions pass through
    it as they are, so that two uses of the same counts plan alike and share an exchange.
    """
    answers = [
        F.struct(F.lit(v).alias("variable"), lit_col(v).cast("string").alias("value")) for v in variables
    ]
    long = not_null(df, dims).select(*[lit_col(d) for d in dims], F.inline(F.array(*answers)))
    return long.filter(F.col("value").isNotNull())


def distribution(
    df: DataFrame, variables: Sequence[str], dims: Sequence[str], scale: int = 1
) -> DataFrame:
    """Count and share of every answer within ``dims``, each variable on its own base.

    Respondents without an answer, or with a NULL dimension, are in neither the
    counts nor the base. Variables the table does not have are skipped.
    One scan whatever the number of variables: answers are pre-aggregated before
    they move, and the base is an aggregate over the counts, joined back to them, so
    that an open-ended question with very many labels is spread over tasks.
    """
    present = [v for v in variables if v in df.columns]
    if not present:
        return empty_like(df, dims, "variable string, value string, n bigint, base bigint, pct double")
    counts = (
        answers_long(df, present, dims)
        .groupBy(*dims, "variable", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return join_base(counts, [*dims, "variable"], scale=scale, keep_null=True)  # none are left


def empty_like(df: DataFrame, dims: Sequence[str], columns: str) -> DataFrame:
    """No rows, the dimensions of ``df`` and the given columns."""
    fields = [df.schema[d] for d in dims] + list(T.StructType.fromDDL(columns))
    return df.sparkSession.createDataFrame([], T.StructType(fields))


def count_by(df: DataFrame, dims: Sequence[str], name: str = "n") -> DataFrame:
    return df.groupBy(*dims).agg(F.count(F.lit(1)).alias(name))


def with_share(
    counts: DataFrame,
    dims: Sequence[str],
    count: str = "n",
    base: str = "base",
    pct: str = "pct",
    scale: int = 1,
) -> DataFrame:
    """Add the total of ``count`` within ``dims`` and each row's share of it.

    ``counts`` must already be aggregated to one row per answer label, so the
    window sees the closed label list of a slice and never its respondents. For
    open-ended answers use :func:`join_base`, which moves no slice as a whole.
    """
    out = counts.withColumn(base, F.sum(count).over(Window.partitionBy(*dims)))
    return out.withColumn(pct, share(F.col(count), F.col(base), scale))


def join_base(
    counts: DataFrame,
    dims: Sequence[str],
    count: str = "n",
    base: str = "base",
    pct: str = "pct",
    scale: int = 1,
    keep_null: bool = False,
) -> DataFrame:
    """As :func:`with_share`, through a join of the counts to their bases.

    The base is a partial aggregate over the same counts, whose exchange Spark
    reuses (the null-safe keys keep both branches equal), and the join is sized
    at run time, so a slice with very many labels is spread over tasks. NULL
    dimensions drop out unless they are to be kept.
    """
    counts = counts if keep_null else not_null(counts, dims)
    bases = counts.groupBy(*dims).agg(F.sum(count).alias(base))
    bases = bases.select(*[lit_col(d).alias(f"_{d}") for d in dims], base)
    same = [lit_col(d).eqNullSafe(lit_col(f"_{d}")) for d in dims]
    out = counts.join(bases, same, "inner").drop(*[f"_{d}" for d in dims])
    return out.withColumn(pct, share(F.col(count), F.col(base), scale))


def resum(df: DataFrame, dims: Sequence[str], count: str = "n") -> DataFrame:
    """Add up counts after labels have been merged."""
    return df.groupBy(*dims).agg(F.sum(count).alias(count))


def reshare(
    df: DataFrame, dims: Sequence[str], label: str, count: str = "n", scale: int = 2, **names: str
) -> DataFrame:
    """Re-sum merged labels and recompute base and share from the counts."""
    return join_base(resum(df, [*dims, label], count), dims, count, scale=scale, keep_null=True, **names)


def sum_shares(df: DataFrame, dims: Sequence[str], pct: str = "pct", scale: int = 2) -> DataFrame:
    """Add up shares that were rounded before; with no dims, one overall row."""
    return df.groupBy(*dims).agg(F.round(F.sum(pct), scale).alias(pct))


def subgroup_share(
    counts: DataFrame,
    dims: Sequence[str],
    group: str,
    value: str,
    count: str = "n",
    scale: int = 1,
) -> DataFrame:
    """Share of one group (say one gender) inside every slice of ``dims``.

    ``members`` and ``total`` come from one aggregate; slices without a member
    are left out.
    """
    members = F.sum(F.when(F.col(group) == value, F.col(count)))
    out = counts.groupBy(*dims).agg(members.alias("members"), F.sum(count).alias("total"))
    out = not_null(out, ["members"])
    return out.withColumn("pct", share(F.col("members"), F.col("total"), scale))


def attach_totals(df: DataFrame, totals: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join of an aggregate to the totals of its wave."""
    return df.join(totals, list(on), "left")


def marks_ratio(
    marks: DataFrame, base: DataFrame, on: Sequence[str], mark: str = "marks", total: str = "base"
) -> DataFrame:
    """Marks against respondents: difference and marks per respondent."""
    out = attach_totals(marks, base, on)
    return out.withColumn("difference", F.col(mark) - F.col(total)).withColumn(
        "marks_per_respondent", F.round(F.col(mark) / F.col(total), 2)
    )


def presence(
    counts: DataFrame, base: DataFrame, on: Sequence[str], count: str = "n", total: str = "base",
    pct: str = "pct",
) -> DataFrame:
    """Share of an external base; shares of one wave may add up to more than 100."""
    out = attach_totals(counts, base, on)
    return out.withColumn(pct, share(F.col(count), F.col(total), 1))


def topbox_share(
    df: DataFrame, dims: Sequence[str], position: str, keep: Sequence[int],
    count: str = "n", base: str = "base",
) -> DataFrame:
    """Respondents in the best boxes of an ordered answer, over the slice's base."""
    top = F.when(F.col(position).isin(list(keep)), F.col(count)).otherwise(F.lit(0))
    out = df.groupBy(*dims).agg(F.sum(top).alias("top"), F.max(base).alias(base))
    return out.withColumn("pct", share(F.col("top"), F.col(base), 1))


def complete_grid(
    df: DataFrame, row: str, rows: Sequence[str], col: str, cols: Sequence[str], value: str,
    fill: float | None = None,
) -> DataFrame:
    """A matrix with exactly ``rows`` and ``cols``, absent cells NULL or ``fill``.

    Only listed labels appear; check for others first with ``checks.unrecognised``.
    """
    cells = df.filter(F.col(row).isin(list(rows)))
    wide = cells.groupBy(row).agg(
        *[F.max(F.when(F.col(col) == c, F.col(value))).alias(c) for c in cols]
    )
    listed = df.sparkSession.createDataFrame(list(enumerate(rows, 1)), f"position int, `{row}` string")
    grid = listed.join(wide, row, "left").select("position", row, *[lit_col(c) for c in cols])
    return grid if fill is None else grid.fillna(fill, subset=list(cols))


def matrix_avg(df: DataFrame, row: str, col: str, cols: Sequence[str], value: str) -> DataFrame:
    """Average of ``value`` for each row label and each listed column label."""
    return df.groupBy(row).agg(
        *[F.avg(F.when(F.col(col) == c, F.col(value))).alias(c) for c in cols]
    )
