"""Column profiles, each from one aggregate whatever the number of columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from wavelens.functions.text import lit_col
from wavelens.session import stored

# Fixed value: below this share of NULLs a question counts as put to nearly everyone.
NEAR_UNIVERSAL = 10.0


def _per_column(df: DataFrame, cols: Sequence[str], measures: dict) -> DataFrame:
    """One row per column from one aggregated row; names may hold any character."""
    wide = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[make(lit_col(c)).alias(f"{m}{i}") for i, c in enumerate(cols) for m, make in measures.items()],
    )
    cells = [
        F.struct(
            F.lit(c).alias("column"),
            F.col("rows").alias("rows"),
            *[F.col(f"{m}{i}").alias(m) for m in measures],
        )
        for i, c in enumerate(cols)
    ]
    return wide.select(F.inline(F.array(*cells)))


def _nulls(c):
    return F.count(F.when(c.isNull(), F.lit(1)))


def _binary(c):
    return F.coalesce(F.bool_and(c.cast("string").isin("0", "1")), F.lit(False))


def round_binary(x: Column) -> Column:
    """A share from 0 to 100 to one decimal by its exact binary value, ties to even.

    So 6.25 gives 6.2. Twenty times the share is the sum of two exact products, and what
    their sum loses to rounding is exact too; with it, the distance from the tie between
    two neighbours has the right sign.
    """
    big, small = x * 16, x * 4
    twenty = big + small
    back = twenty - big
    lost = (big - (twenty - back)) + (small - back)
    below = F.floor(twenty / 2)
    over = (twenty - (below * 2 + 1)) + lost
    up = (over > 0) | ((over == 0) & (below % 2 == 1))
    return (below + F.when(up, 1).otherwise(0)) / 10


def binary_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Whether the answers of a column are only ``0`` and ``1``; never if all are NULL."""
    return _per_column(df, cols, {"binary": _binary}).select("column", "binary")


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return _per_column(df, cols or df.columns, {"nulls": _nulls})


def null_dictionary(df: DataFrame, wave: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Type of every column, its share of NULLs and what a NULL means there."""
    return _described(_per_column(df, cols or df.columns, {"nulls": _nulls, "binary": _binary}), wave)


def _described(profile: DataFrame, wave: str) -> DataFrame:
    """Null dictionary of ``(column, rows, nulls, binary)``."""
    exact = F.col("nulls") / F.col("rows") * 100
    pct = F.when(F.col("rows") > 0, round_binary(exact)).otherwise(F.lit(0.0))
    return profile.select(
        F.lit(wave).alias("wave"),
        "column",
        F.when(F.col("binary"), "binary_multiselect").otherwise("single_choice").alias("type"),
        pct.alias("pct_null"),
        F.when(F.col("binary"), "group_not_shown")
        .when(pct < NEAR_UNIVERSAL, "near_universal")
        .otherwise("conditional_on_profile")
        .alias("null_meaning"),
    )


class ProfileOnWrite:
    """Counts gathered by the very job that writes a table, so that it is scanned once.

    Metrics ride on the rows as they pass: number of rows, NULLs of every column, whether
    its answers are only ``0`` and ``1``. They are there once the write has ended.
    """

    def __init__(self, columns: Sequence[str], checks: Sequence[str] = ()):
        self.columns = list(columns)
        self.checks = list(checks)
        self.observation = Observation()

    @classmethod
    def of(cls, df: DataFrame, checks: Mapping[str, Column] | None = None) -> tuple[DataFrame, ProfileOnWrite]:
        """``df`` as it is to be written, and its profile.

        ``checks`` are conditions that rows should meet; those that do not (NULL counts as
        met) are counted by the name of the check.
        """
        checks = dict(checks or {})
        profile = cls(df.columns, checks)
        metrics = [F.count(F.lit(1)).alias("rows")]
        for i, name in enumerate(df.columns):
            metrics += [_nulls(lit_col(name)).alias(f"nulls{i}"), _binary(lit_col(name)).alias(f"binary{i}")]
        metrics += [F.count(F.when(~ok, F.lit(1))).alias(f"check{i}") for i, ok in enumerate(checks.values())]
        return df.observe(profile.observation, *metrics), profile

    @property
    def rows(self) -> int:
        return self.observation.get["rows"]

    def counts(self, spark: SparkSession) -> DataFrame:
        """``(column, rows, nulls, binary)``, one row per column."""
        found = self.observation.get
        rows = [(c, found["rows"], found[f"nulls{i}"], found[f"binary{i}"]) for i, c in enumerate(self.columns)]
        return spark.createDataFrame(rows, "column string, rows long, nulls long, binary boolean")

    def null_dictionary(self, spark: SparkSession, wave: str) -> DataFrame:
        return _described(self.counts(spark), wave)

    def failures(self, spark: SparkSession) -> DataFrame:
        """``(check, rows, failed)`` of every check."""
        found = self.observation.get
        rows = [(name, found["rows"], found[f"check{i}"]) for i, name in enumerate(self.checks)]
        return spark.createDataFrame(rows, "check string, rows long, failed long")


def frequency_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``(column, value, n)`` of every column, NULL included, from one scan."""
    cols = list(cols or df.columns)
    text = df.select(*[lit_col(c).cast("string").alias(c) for c in cols])
    long = text.unpivot([], [lit_col(c) for c in cols], "column", "value")
    return long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def distinct_profile(df: DataFrame, cols: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """Distinct non-NULL values per column: exact over the frequencies, or a sketch."""
    if approx:
        sketch = _per_column(df, cols or df.columns, {"distinct_values": F.approx_count_distinct})
        return sketch.select("column", "distinct_values")
    return frequency_profile(df, cols).groupBy("column").agg(F.count("value").alias("distinct_values"))


def distinct_sketches(df: DataFrame, wave: str, cols: Sequence[str] | None = None, log_size: int = 14) -> DataFrame:
    """``(wave, column, sketch)``: a summary of the distinct values of every column of a wave.

    Summaries of several waves can be put together later without the waves themselves.
    """
    found = _per_column(df, cols or df.columns, {"sketch": lambda c: F.hll_sketch_agg(c.cast("string"), F.lit(log_size))})
    return found.select(F.lit(wave).alias("wave"), "column", "sketch")


def merged_distinct(sketches: DataFrame) -> DataFrame:
    """``(column, waves, distinct_values)`` over all waves of ``sketches``.

    The estimate is within ``4 * 1.04 / sqrt(2 ** log_size)`` of the truth (3.3 % for 14)
    but for one case in ten thousand.
    """
    merged = sketches.groupBy("column").agg(F.count(F.lit(1)).alias("waves"), F.hll_union_agg("sketch").alias("sketch"))
    return merged.select("column", "waves", F.hll_sketch_estimate("sketch").alias("distinct_values"))


#: Slots that the labels of a slice are summed up in, before any label is counted.
SLOTS = 1 << 14


def top_labels(df: DataFrame, dims: Sequence[str], label: str, k: int, slots: int = SLOTS) -> DataFrame:
    """``(dims…, label, n, ranking)``: exactly the ``k`` most frequent labels of each slice.

    For open-ended answers, where nearly every row has its own label. First rows are
    counted by slots of the label's hash, which bounds that exchange: no label is more
    frequent than its slot. The labels of the fullest slots are counted then, and the
    ``k``-th of them is a floor; only labels of slots that reach it can be among the first
    ``k``, and these are counted in full. NULL labels do not count; ties go by label.
    """
    keys = [lit_col(d) for d in dims]
    rows = df.select(*keys, lit_col(label).cast("string").alias("label")).filter(F.col("label").isNotNull())
    rows = rows.withColumn("_slot", F.pmod(F.xxhash64("label"), F.lit(slots)))
    sizes = stored(rows.groupBy(*dims, "_slot").agg(F.count(F.lit(1)).alias("_size")), "slot-sizes")
    fullest = Window.partitionBy(*dims).orderBy(F.desc("_size"), "_slot")
    some = sizes.withColumn("_place", F.row_number().over(fullest)).filter(F.col("_place") <= k)
    first = _ranked_labels(_in_slots(rows, some, dims), dims, k)
    floors = first.groupBy(*dims).agg(F.max("ranking").alias("_found"), F.min("n").alias("_floor"))
    floors = floors.select(*[lit_col(d).alias(f"_{d}") for d in dims], F.when(F.col("_found") >= k, F.col("_floor")).otherwise(0).alias("_floor"))
    same = [lit_col(d).eqNullSafe(lit_col(f"_{d}")) for d in dims] or [F.lit(True)]
    needed = sizes.join(F.broadcast(floors) if not dims else floors, same).filter(F.col("_size") >= F.col("_floor"))
    return _ranked_labels(_in_slots(rows, stored(needed.select(*dims, "_slot"), "slots"), dims), dims, k)


def _in_slots(rows: DataFrame, slots: DataFrame, dims: Sequence[str]) -> DataFrame:
    wanted = slots.select(*[lit_col(d).alias(f"_{d}") for d in dims], F.col("_slot").alias("_wanted"))
    same = [lit_col(d).eqNullSafe(lit_col(f"_{d}")) for d in dims] + [F.col("_slot") == F.col("_wanted")]
    return rows.join(wanted, same, "left_semi")


def _ranked_labels(rows: DataFrame, dims: Sequence[str], k: int) -> DataFrame:
    counts = rows.groupBy(*dims, "label").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy(*dims).orderBy(F.desc("n"), "label")
    return counts.withColumn("ranking", F.row_number().over(order)).filter(F.col("ranking") <= k)


def duplicates_by_fingerprint(df: DataFrame) -> DataFrame:
    """As :func:`duplicate_count`, but whole rows move only where a fingerprint repeats.

    Rows are counted by 128 bits of them; rows whose bits come twice are compared whole,
    so that two different rows with the same bits are not taken for copies.
    """
    cells = [F.struct(lit_col(c).isNull(), lit_col(c)) for c in df.columns]
    marked = df.withColumn("_a", F.xxhash64(*cells)).withColumn("_b", F.xxhash64(F.lit(1), *cells))
    prints = stored(marked.groupBy("_a", "_b").agg(F.count(F.lit(1)).alias("_n")), "fingerprints")
    repeated = prints.filter("_n > 1").select("_a", "_b")
    whole = marked.join(repeated, ["_a", "_b"], "left_semi").groupBy("_a", "_b", *[lit_col(c) for c in df.columns]).agg(F.lit(1).alias("_one"))
    distinct_rows = prints.filter("_n = 1").agg(F.count(F.lit(1)).alias("d")).unionAll(whole.agg(F.count(F.lit(1))))
    rows = prints.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"), F.lit(0).cast("long").alias("d"))
    both = rows.unionByName(distinct_rows.select(F.lit(0).cast("long").alias("rows"), "d"))
    out = both.agg(F.sum("rows").alias("rows"), F.sum("d").alias("distinct_rows"))
    return out.withColumn("duplicates", F.col("rows") - F.col("distinct_rows"))


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows, distinct rows and surplus rows, NULLs comparing equal."""
    copies = df.groupBy(*[lit_col(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("_n"))
    return copies.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("distinct_rows")
    ).withColumn("duplicates", F.col("rows") - F.col("distinct_rows"))


def columns_like(catalog: DataFrame, pattern: str) -> DataFrame:
    """Columns whose name matches a regular expression, ignoring case."""
    return catalog.filter(F.lower("name").rlike(pattern))
