"""Row filters whose NULL handling or base rule is part of the meaning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavelens.functions.text import lit_col


def not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    for c in cols:
        df = df.filter(lit_col(c).isNotNull())
    return df


def exclude_label(
    df: DataFrame, col: str, labels: Sequence[str], keep_null: bool = True
) -> DataFrame:
    """Rows whose label is not one of ``labels``; NULL rows stay only if asked for."""
    kept = ~F.col(col).isin(list(labels))
    return df.filter(kept | F.col(col).isNull()) if keep_null else df.filter(kept)


def eligible(df: DataFrame, options: Sequence[str]) -> DataFrame:
    """Respondents who were shown the group: at least one option is answered."""
    return df.filter(F.coalesce(*[lit_col(c) for c in options]).isNotNull())


def min_base(
    df: DataFrame, base: str, n: int, label: str | None = None, exclude: Sequence[str] = ()
) -> DataFrame:
    """Slices with at least ``n`` respondents, without the catch-all labels."""
    out = df.filter(F.col(base) >= n)
    return out.filter(~F.col(label).isin(list(exclude))) if exclude else out


def split_by_base(df: DataFrame, base: str, n: int) -> tuple[DataFrame, DataFrame]:
    """``(kept, discarded)``: slices above ``n`` respondents and all the others."""
    return df.filter(F.col(base) > n), df.filter(F.col(base) <= n)


def out_of_range(df: DataFrame, col: str, low: float, high: float) -> DataFrame:
    return df.filter((F.col(col) < low) | (F.col(col) > high))


def signed(df: DataFrame, col: str, sign: int = 1) -> DataFrame:
    """Only rows whose (already rounded) metric is above, or below, zero."""
    return df.filter(F.col(col) * sign > 0)


def any_nonzero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    condition = F.lit(False)
    for c in cols:
        condition = condition | (F.col(c) != 0)
    return df.filter(condition)
