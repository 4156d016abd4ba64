"""Comparing waves: pivots, deltas, comparability and movers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wavelens.functions.text import lit_col


def pivot_waves(
    df: DataFrame, keys: Sequence[str], wave: str, value: str, waves: Sequence[str] | None = None
) -> DataFrame:
    """One column per wave, NULL where a key has no value; no keys gives one row.

    With the waves listed this is a single aggregate. Without them Spark looks
    for the wave values first, which is one more pass over ``df``.
    """
    if waves is None:
        return df.groupBy(*keys).pivot(wave).agg(F.max(value))
    return df.groupBy(*keys).agg(
        *[F.max(F.when(F.col(wave) == w, F.col(value))).alias(w) for w in waves]
    )


def evolution(
    df: DataFrame,
    keys: Sequence[str],
    wave: str,
    value: str,
    waves: Sequence[str],
    scale: int = 1,
    delta: str = "variation",
) -> DataFrame:
    """Waves side by side with last minus first, in points; NULL if either is absent."""
    wide = pivot_waves(df.filter(F.col(wave).isin(list(waves))), keys, wave, value, waves)
    return wide.withColumn(delta, F.round(lit_col(waves[-1]) - lit_col(waves[0]), scale))


def first_last(df: DataFrame, keys: Sequence[str], wave: str, value: str) -> DataFrame:
    """First and last wave of each key with their values, in one aggregate."""
    return df.groupBy(*keys).agg(
        F.min(wave).alias("first_wave"),
        F.max(wave).alias("last_wave"),
        F.min_by(value, wave).alias("first_value"),
        F.max_by(value, wave).alias("last_value"),
    )


def attach_first_last(
    keys: DataFrame, first: DataFrame, last: DataFrame, on: Sequence[str]
) -> DataFrame:
    """Left join of keys to separately computed first and last values."""
    return keys.join(first, list(on), "left").join(last, list(on), "left")


def evolution_available(
    df: DataFrame, keys: Sequence[str], wave: str, value: str, at_least: int = 2, scale: int = 1
) -> DataFrame:
    """First against last wave a key was seen in, for keys seen in enough waves."""
    out = df.groupBy(*keys).agg(
        F.min(wave).alias("first_wave"),
        F.max(wave).alias("last_wave"),
        F.countDistinct(wave).alias("n_waves"),
        F.min_by(value, wave).alias("first_value"),
        F.max_by(value, wave).alias("last_value"),
    )
    return out.filter(F.col("n_waves") >= at_least).withColumn(
        "variation", F.round(F.col("last_value") - F.col("first_value"), scale)
    )


def compare_waves(
    df: DataFrame, keys: Sequence[str], wave: str, values: Sequence[str], first: str, last: str
) -> DataFrame:
    """First wave joined to last wave on the keys both have."""

    def side(which: str, tag: str) -> DataFrame:
        return df.filter(F.col(wave) == which).select(
            *keys, *[F.col(v).alias(f"{v}_{tag}") for v in values]
        )

    return side(first, "first").join(side(last, "last"), list(keys), "inner")


def numbered(df: DataFrame, dims: Sequence[str], order: Sequence) -> DataFrame:
    """Position of every row in its slice, for slices that are short lists of labels.

    End ``order`` with a unique column, or tied rows are numbered at random.
    """
    return df.withColumn("ranking", F.row_number().over(Window.partitionBy(*dims).orderBy(*order)))


def topk_by(df: DataFrame, dims: Sequence[str], order: Sequence, k: int) -> DataFrame:
    """First ``k`` rows of every slice; end ``order`` with a unique column.

    Spark applies the limit per slice before the shuffle as well, so at most
    ``k`` rows of a slice leave any task, however long the slice is.
    """
    return numbered(df, dims, order).filter(F.col("ranking") <= k)


def movers(
    df: DataFrame, dims: Sequence[str], label: str, delta: str = "variation", k: int = 5,
    rising: bool = True,
) -> DataFrame:
    """Strongest growth, or decline, per slice; ties by label."""
    moved = df.filter(F.col(delta) > 0) if rising else df.filter(F.col(delta) < 0)
    strongest = F.desc(delta) if rising else F.asc(delta)
    return topk_by(moved, dims, [strongest, F.asc(label)], k)


def comparable(
    df: DataFrame,
    keys: Sequence[str],
    wave: str,
    n_waves: int,
    base: str | None = None,
    min_base: int = 0,
) -> DataFrame:
    """Keys seen in ``n_waves`` waves, with at least ``min_base`` respondents in each."""
    aggregates = [F.countDistinct(wave).alias("n_waves")]
    if base:
        aggregates += [F.min(base).alias("smallest"), F.max(base).alias("largest")]
    out = df.groupBy(*keys).agg(*aggregates).filter(F.col("n_waves") == n_waves)
    return out.filter(F.col("smallest") >= min_base) if base else out


def keep_keys(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is listed; a repeated key in the list changes nothing."""
    return df.join(keys, list(on), "left_semi")


def latest_wave(df: DataFrame, wave: str) -> DataFrame:
    """One row with the newest wave; stays a DataFrame, nothing is collected."""
    return df.agg(F.max(wave).alias(wave))


def in_latest_wave(df: DataFrame, wave: str, source: DataFrame | None = None) -> DataFrame:
    """Rows of the newest wave of ``source`` (by default of ``df`` itself)."""
    return keep_keys(df, latest_wave(df if source is None else source, wave), [wave])


def topk_history(
    df: DataFrame, key: str, value: str, wave: str, ref_wave: str, k: int
) -> DataFrame:
    """All waves of the ``k`` keys that lead one reference wave."""
    top = df.filter(F.col(wave) == ref_wave).orderBy(F.desc(value), F.asc(key)).limit(k)
    return keep_keys(df, top.select(key), [key])
