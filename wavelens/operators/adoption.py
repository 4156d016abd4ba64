"""Adoption of multi-select options over the population that was asked."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wavelens.functions.labels import share
from wavelens.functions.text import lit_col
from wavelens.operators.distribution import empty_like
from wavelens.operators.filters import not_null


def flag_value(flag: Column) -> Column:
    """An option's 0/1 text as a number; anything not numeric counts as not answered.

    Almost every answer is ``0`` or ``1``, and comparing is far cheaper than parsing.
    """
    return F.when(flag == "1", F.lit(1.0)).when(flag == "0", F.lit(0.0)).otherwise(
        flag.try_cast("double")
    )


def adoption_groups(
    df: DataFrame,
    groups: Mapping[str, Mapping[str, str]],
    dims: Sequence[str],
    unmapped: str = "zero",
) -> DataFrame:
    """``(dims…, option, eligible, selected, pct, category)`` for many groups at once.

    ``groups`` maps a category to its ``{column: option}``. A respondent is
    eligible for a group if any of its columns is answered. A missing flag of an
    eligible respondent counts as 0; with ``unmapped="null"`` an option nobody
    answered in a slice has no share instead of 0 %. Slices without eligible
    respondents are left out.

    All groups share one scan and one exchange. A respondent's flags are turned
    into rows group by group, after the groups not answered are dropped, and
    counted before they move; the work grows with the number of flags, and no
    single aggregate gets too wide to be compiled.
    """
    if not groups:
        return empty_like(df, dims, "option string, eligible bigint, selected double, pct double, category string")
    blocks = [
        F.struct(
            F.lit(g).alias("_group"),
            F.array(*[lit_col(c).cast("string") for c in options]).alias("_flags"),
        )
        for g, options in enumerate(groups.values())
    ]
    keys = [lit_col(d) for d in dims]
    asked = not_null(df, dims).select(*keys, F.inline(F.array(*blocks)))
    asked = asked.filter(F.array_max("_flags").isNotNull())
    marks = asked.select(*keys, "_group", F.posexplode("_flags").alias("_option", "_flag"))
    sums = marks.groupBy(*dims, "_group", "_option").agg(
        F.count(F.lit(1)).alias("eligible"), F.sum(flag_value(F.col("_flag"))).alias("selected")
    )
    if unmapped == "zero":
        sums = sums.withColumn("selected", F.coalesce("selected", F.lit(0.0)))
    names = F.array(*[F.array(*[F.lit(o) for o in options.values()]) for options in groups.values()])
    categories = F.array(*[F.lit(c) for c in groups])
    return sums.select(
        *keys,
        names[F.col("_group")][F.col("_option")].alias("option"),
        "eligible",
        "selected",
        share(F.col("selected"), F.col("eligible")).alias("pct"),
        categories[F.col("_group")].alias("category"),
    )


#: Bits of a counter within a packed sum, and counters in one. A sum takes in as many rows as a counter of one bit
#: less has room for.
LANE_BITS = 21
LANES = 3


def adoption_packed(
    df: DataFrame, groups: Mapping[str, Mapping[str, str]], dims: Sequence[str], unmapped: str = "zero"
) -> DataFrame:
    """As :func:`adoption_groups`, without a row per respondent and option.

    The flags of three options are three counters within one number, so that one sum
    counts all three; ``n`` options take ``n / 3`` sums, however many respondents there
    are. Rows are summed in blocks small enough for the counters (a block lies within one
    task), which are unpacked and added up. A group's
    bases are counters too. Flags other than ``0`` and ``1`` are rare and counted apart.
    """
    if not groups:
        return adoption_groups(df, groups, dims, unmapped)
    keys = [lit_col(d) for d in dims]
    options = [(g, option, column) for g, columns in enumerate(groups.values()) for column, option in columns.items()]
    text = {c: lit_col(c).cast("string") for _, _, c in options}
    asked = [F.coalesce(*[text[c] for c in columns]).isNotNull() for columns in groups.values()]
    marks = asked + [text[c] == "1" for _, _, c in options]
    if unmapped != "zero":
        marks += [text[c].isNotNull() for _, _, c in options]
    bits = [F.coalesce(mark.cast("long"), F.lit(0).cast("long")) for mark in marks]
    packed = [
        sum((bits[i + lane] * (1 << (LANE_BITS * lane)) for lane in range(1, min(LANES, len(bits) - i))), bits[i])
        for i in range(0, len(bits), LANES)
    ]
    present = not_null(df, dims)
    block = F.shiftright(F.monotonically_increasing_id(), LANE_BITS - 1).alias("_block")  # of one task
    sums = present.select(*keys, block, *[p.alias(f"_p{i}") for i, p in enumerate(packed)]).groupBy(*dims, "_block").agg(
        *[F.sum(f"_p{i}").alias(f"_p{i}") for i in range(len(packed))]
    )
    words = F.array(*[F.col(f"_p{i}") for i in range(len(packed))])
    cells = sums.select(*keys, F.posexplode(words).alias("_word", "_sum"))
    lanes = F.array(*[F.shiftright("_sum", LANE_BITS * lane).bitwiseAND((1 << LANE_BITS) - 1) for lane in range(LANES)])
    cells = cells.select(*keys, "_word", F.posexplode(lanes).alias("_lane", "_n"))
    totals = cells.groupBy(*dims, (F.col("_word") * LANES + F.col("_lane")).alias("_at")).agg(F.sum("_n").alias("_n"))
    totals = totals.filter(F.col("_at") < len(bits))
    at, first = F.col("_at"), len(groups)
    option = F.when(at < first, F.lit(-1)).otherwise((at - first) % len(options))
    group_of = F.array(*[F.lit(g) for g, _, _ in options])
    group = F.when(at < first, at).otherwise(group_of[option])
    what = F.when(at < first, "eligible").when(at < first + len(options), "selected").otherwise("answered")
    found = totals.select(*keys, group.alias("_group"), option.alias("_option"), what.alias("_what"), "_n")
    bases = found.filter("_what = 'eligible' AND _n > 0").select(
        *[F.col(d).alias(f"_{d}") for d in dims], F.col("_group").alias("_g"), F.col("_n").alias("eligible")
    )
    rows = found.filter("_option >= 0").groupBy(*dims, "_group", "_option").agg(
        F.sum(F.when(F.col("_what") == "selected", F.col("_n"))).cast("double").alias("selected"),
        F.sum(F.when(F.col("_what") == "answered", F.col("_n"))).alias("answered"),
    )
    same = [lit_col(d).eqNullSafe(lit_col(f"_{d}")) for d in dims] + [F.col("_group") == F.col("_g")]
    rows = rows.join(bases, same).drop(*[f"_{d}" for d in dims], "_g")
    odd = _odd_flags(present, [c for _, _, c in options], dims)
    other = [lit_col(d).eqNullSafe(lit_col(f"_{d}")) for d in dims] + [F.col("_at_option") == F.col("_option")]
    rows = rows.join(odd, other, "left").drop(*[f"_{d}" for d in dims])
    numeric = F.coalesce("answered", F.lit(0)) - F.coalesce("_texts", F.lit(0))
    selected = F.col("selected") + F.coalesce("_more", F.lit(0.0))
    if unmapped != "zero":
        selected = F.when(numeric > 0, selected)
    names = F.array(*[F.lit(o) for _, o, _ in options])
    categories = F.array(*[F.lit(c) for c in groups])
    return rows.select(
        *keys, names[F.col("_option")].alias("option"), "eligible", selected.alias("selected"),
        share(selected, F.col("eligible")).alias("pct"), categories[F.col("_group")].alias("category"),
    )


def _odd_flags(df: DataFrame, columns: Sequence[str], dims: Sequence[str]) -> DataFrame:
    """``(_dims…, _at_option, _more, _texts)`` of flags that are neither empty nor ``0`` or ``1``.

    ``_more`` adds up those that are numbers, ``_texts`` counts those that are none.
    """
    flags = F.array(*[F.struct(F.lit(i).alias("_at_option"), lit_col(c).cast("string").alias("flag")) for i, c in enumerate(columns)])
    odd = df.select(*[lit_col(d).alias(f"_{d}") for d in dims], F.inline(F.filter(flags, lambda x: ~x["flag"].isin("0", "1"))))
    number = F.col("flag").try_cast("double")
    return odd.groupBy(*[f"_{d}" for d in dims], "_at_option").agg(
        F.sum(number).alias("_more"), F.count(F.when(number.isNull(), F.lit(1))).alias("_texts")
    )


def adoption(
    df: DataFrame, options: Sequence[str], dims: Sequence[str], prefix: str = "",
    unmapped: str = "zero",
) -> DataFrame:
    """Adoption of one group; option names lose ``prefix``."""
    named = {c: c.removeprefix(prefix) for c in options}
    return adoption_groups(df, {"": named}, dims, unmapped).drop("category")


def groups_by_prefix(df: DataFrame, prefixes: Mapping[str, str]) -> dict[str, dict[str, str]]:
    """Columns of each category by prefix; a prefix without columns is skipped."""
    groups = {}
    for category, prefix in prefixes.items():
        found = {c: c[len(prefix):] for c in df.columns if c.startswith(prefix)}
        if found:
            groups[category] = found
        else:
            warnings.warn(f"no column starts with '{prefix}': category '{category}' skipped")
    return groups


def complement(
    df: DataFrame, eligible: str = "eligible", selected: str = "selected", pct: str = "pct"
) -> DataFrame:
    """Users from the answers of the 'none of them' option."""
    return df.select(
        *[c for c in df.columns if c not in (selected, pct)],
        F.col(selected).cast("int").alias("non_users"),
        (F.col(eligible) - F.col(selected)).cast("int").alias("users"),
        F.round(100 - F.col(pct), 1).alias("pct_users"),
    )


def adoption_ranking(
    df: DataFrame,
    dims: Sequence[str],
    option: str = "option",
    selected: str = "selected",
    pct: str = "pct",
) -> DataFrame:
    """Position of each adopted option within ``dims`` by share, then marks, then name.

    The window holds the options of one group, which are columns of the source
    table, so it is bounded by the table's width.
    """
    order = Window.partitionBy(*dims).orderBy(
        F.desc(pct), F.desc(selected), F.asc(option)
    )
    return df.filter(F.col(pct) > 0).withColumn("ranking", F.row_number().over(order))


def coverage(df: DataFrame, keys: Sequence[str], wave: str) -> DataFrame:
    """Number of waves and their sorted list for each key."""
    seen = df.groupBy(*keys).agg(F.sort_array(F.collect_set(wave)).alias("_seen"))
    return seen.select(
        *keys,
        F.size("_seen").cast("bigint").alias("n_waves"),
        F.concat_ws(", ", "_seen").alias("waves"),
    )
