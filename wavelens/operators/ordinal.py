"""Percentile bands of ordered categories, and rankings by them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wavelens.functions.labels import ordinal_label, share
from wavelens.functions.text import lit_col
from wavelens.operators.filters import any_nonzero, not_null

P50_P75 = {"p50": 0.50, "p75": 0.75}


def ordinal_quantiles(
    df: DataFrame,
    dims: Sequence[str],
    position: str,
    size: int,
    quantiles: Mapping[str, float] = P50_P75,
    weight: str | None = None,
    basis: str = "exact",
    total: str = "total",
    off_scale: str = "drop",
) -> DataFrame:
    """First band whose cumulated share reaches each quantile, per slice.

    ``position`` is the 1-based band; rows with a NULL dimension take no part.
    Rows off the scale (NULL) do not either, or with ``off_scale="lowest"`` they
    belong to the total and lie below the first band. ``weight`` is a count
    column when ``df`` is aggregated already. ``basis`` compares exact counts, or
    the cumulated share rounded to two (``round2``) or no (``round0``) decimals.

    A scale has a fixed, short list of bands, so the cumulated counts of a slice
    are one set of conditional sums: one partial aggregate, one exchange, no
    window, and no row of a hot slice is moved.
    """
    amount = F.lit(1) if weight is None else F.col(weight)
    place = F.when(F.col(position).between(1, size), F.col(position))
    if off_scale == "lowest":
        rows, place, lowest = df, F.coalesce(place, F.lit(0)), 0
    else:
        rows, lowest = df.filter(F.col(position).between(1, size)), 1
    bands = range(lowest, size + 1)
    histogram = not_null(rows, dims).groupBy(*dims).agg(
        F.sum(amount).alias(total),
        *[F.sum(F.when(place <= i, amount).otherwise(F.lit(0))).alias(f"_to{i}") for i in bands],
    )

    def first_band(q: float) -> Column:
        reached = [_reaches(F.col(f"_to{i}"), F.col(total), q, basis) for i in bands]
        band = F.when(F.lit(False), F.lit(0))
        for i, test in zip(bands, reached, strict=True):
            band = band.when(test, F.lit(i) if i else F.lit(None))
        return band

    return histogram.select(
        *[lit_col(d) for d in dims],
        total,
        *[first_band(q).alias(name) for name, q in quantiles.items()],
    )


def _reaches(cumulated: Column, total: Column, q: float, basis: str) -> Column:
    if basis == "exact":
        return cumulated >= total * q
    digits = {"round2": 2, "round0": 0}[basis]
    return share(cumulated, total, digits) >= q * 100


def running_share(
    counts: DataFrame, dims: Sequence[str], position: str, count: str = "n", scale: int = 2
) -> DataFrame:
    """Cumulated count and share along the scale, one row per band.

    ``counts`` holds at most one row per slice and band, so the window is as
    long as the scale.
    """
    slice_ = Window.partitionBy(*dims)
    upto = slice_.orderBy(position).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        counts.withColumn("total", F.sum(count).over(slice_))
        .withColumn("cumulated", F.sum(count).over(upto))
        .withColumn("pct_cumulated", share(F.col("cumulated"), F.col("total"), scale))
    )


def first_at(
    df: DataFrame, dims: Sequence[str], position: str, reached: str, threshold: float
) -> DataFrame:
    """The first band of each slice whose ``reached`` is at least ``threshold``."""
    hit = df.filter(F.col(reached) >= threshold)
    return hit.groupBy(*dims).agg(F.min(position).alias(position))


def join_quantiles(low: DataFrame, high: DataFrame, on: Sequence[str]) -> DataFrame:
    """Put two separately computed percentile results side by side."""
    return low.join(high, list(on), "inner")


def rank_by(
    df: DataFrame, dims: Sequence[str], order: Sequence[str], name: str = "ranking"
) -> DataFrame:
    """Dense rank within ``dims``, highest first, by ``order`` and then its next columns.

    Equal values share a position, so it is enough to rank the distinct values
    of a slice (for band pairs at most the square of the scale) and look the
    position up; the slice's own rows are not sorted in one task.
    """
    window = Window.partitionBy(*dims).orderBy(*[F.desc(c) for c in order])
    by = [*dims, *order]
    keys = df.select(*by).distinct().withColumn(name, F.dense_rank().over(window))
    keys = keys.select(*[F.col(c).alias(f"_{c}") for c in by], name)
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
    return df.join(keys, same, "inner").drop(*[f"_{c}" for c in by])


def leaders(df: DataFrame, rank: str = "ranking") -> DataFrame:
    """First positions, ties included."""
    return df.filter(F.col(rank) == 1)


def with_band_labels(
    df: DataFrame, scale: Sequence[str], names: Mapping[str, str]
) -> DataFrame:
    """Add the label of each position column; ``names`` maps position to label column."""
    for position, label in names.items():
        df = df.withColumn(label, ordinal_label(F.col(position), scale))
    return df


def band_change(
    df: DataFrame, keys: Sequence[str], wave: str, first: str, last: str, cols: Sequence[str]
) -> DataFrame:
    """Last minus first position for keys seen in both waves, as ``<col>_change``."""

    def at(which: str, c: str) -> Column:
        return F.max(F.when(F.col(wave) == which, F.col(c)))

    out = df.groupBy(*keys).agg(*[(at(last, c) - at(first, c)).alias(f"{c}_change") for c in cols])
    return not_null(out, [f"{c}_change" for c in cols])


def band_movement(
    df: DataFrame, keys: Sequence[str], wave: str, first: str, last: str, cols: Sequence[str]
) -> DataFrame:
    """All waves of the keys whose band moved between the first and the last wave."""
    change = band_change(df, keys, wave, first, last, cols)
    moved = any_nonzero(change, [f"{c}_change" for c in cols])
    return df.join(moved.select(*keys), list(keys), "left_semi")
