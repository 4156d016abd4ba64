"""From a raw wave to a standardised one, and from waves to one harmonised table."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavelens.functions.text import lit_col, normalize_name, parse_question
from wavelens.operators.profile import binary_columns
from wavelens.session import cut_lineage, header_table


def parsed_catalog(catalog: DataFrame, style: str = "dotted", fixes: Mapping | None = None) -> DataFrame:
    """``(position, name, code, label)`` of a raw wave's headers."""
    parsed = catalog.withColumn("_q", parse_question(F.col("name"), style, fixes))
    return parsed.select("position", "name", F.col("_q.code"), F.col("_q.label"))


def option_candidates(catalog: DataFrame) -> DataFrame:
    """Columns coded ``X.y.N`` whose parent ``X.y`` is a column too (the last of that code)."""
    parts = F.split("code", r"\.")
    children = catalog.filter((F.size(parts) >= 3) & F.element_at(parts, -1).rlike("^[0-9]+$"))
    children = children.withColumn("root", F.regexp_replace("code", r"\.[^.]*$", ""))
    coded = catalog.filter(F.col("code").isNotNull())
    parents = coded.groupBy(F.col("code").alias("root")).agg(
        F.max_by("name", "position").alias("parent"),
        F.max_by("label", "position").alias("parent_label"),
    )
    return children.join(parents, "root").select(
        "root", "parent", "parent_label", "position", "name", "label"
    )


def detect_groups(df: DataFrame, catalog: DataFrame) -> DataFrame:
    """Options of multi-select groups: candidates whose answers are only 0 and 1.

    Only the candidate columns are scanned, all of them in one aggregate.
    """
    candidates = option_candidates(catalog)
    names = [r["name"] for r in candidates.select("name").collect()]
    if not names:
        return candidates
    binary = binary_columns(df, names).filter("binary").select(F.col("column").alias("name"))
    return candidates.join(binary, "name", "left_semi")


def column_plan(
    catalog: DataFrame,
    groups: DataFrame,
    aliases: Sequence[Sequence[str]] = (),
    corrections: Mapping[str, str] | None = None,
) -> DataFrame:
    """``(position, target, sources)``: the output columns and where they come from.

    Options of one group that read the same are one column, across all groups of
    an alias (the same question under several codes, first code wins). Parents of
    groups are dropped. ``corrections`` replaces the label of a raw name.
    """
    first_code = {code: codes[0] for codes in aliases for code in codes}
    order = {code: i for codes in aliases for i, code in enumerate(codes)}
    lead = _chosen(F.col("root"), first_code)
    rank = _chosen(F.col("root"), order, F.lit(0))
    members = groups.withColumn("lead", lead).withColumn("rank", rank)
    question = members.groupBy("lead").agg(F.min_by("parent_label", F.struct("rank", "position")).alias("question"))
    options = (
        members.groupBy("lead", "label")
        .agg(
            F.min("position").alias("position"),
            F.transform(
                F.sort_array(F.collect_list(F.struct("rank", "position", "name"))), lambda x: x["name"]
            ).alias("sources"),
        )
        .join(question, "lead")
        .select(
            "position",
            normalize_name(F.concat_ws("_", "question", "label")).alias("target"),
            "sources",
        )
    )
    used = groups.select("name").unionAll(groups.select(F.col("parent").alias("name"))).distinct()
    label = _chosen(F.col("name"), corrections or {}, F.col("label"))
    plain = catalog.join(used, "name", "left_anti").select(
        "position", normalize_name(label).alias("target"), F.array("name").alias("sources")
    )
    return plain.unionAll(options)


def _chosen(col: Column, values: Mapping, default: Column | None = None) -> Column:
    default = col if default is None else default
    if not values:
        return default
    pairs = F.create_map(*[F.lit(x) for pair in values.items() for x in pair])
    return F.coalesce(F.element_at(pairs, col), default)


def standardize(
    df: DataFrame,
    style: str = "dotted",
    aliases: Sequence[Sequence[str]] = (),
    fixes: Mapping | None = None,
    corrections: Mapping[str, str] | None = None,
) -> DataFrame:
    """A raw wave under normalised names, options merged, group parents dropped.

    Reads the data once to test the candidate options; the result is lazy. Two
    columns that would get the same name are an error. Only header rows, as many
    as the table is wide, reach the driver.
    """
    catalog = parsed_catalog(header_table(df.sparkSession, df.columns), style, fixes)
    groups = cut_lineage(detect_groups(df, catalog))
    plan = column_plan(catalog, groups, aliases, corrections)
    rows = sorted(plan.collect(), key=lambda r: r["position"])
    clashes = sorted(name for name, n in Counter(r["target"] for r in rows).items() if n > 1)
    if clashes:
        raise ValueError(f"several columns would be called: {clashes}")
    return df.select(
        *[F.coalesce(*[lit_col(c) for c in r["sources"]]).alias(r["target"]) for r in rows]
    )


def merge_alias(df: DataFrame, pairs: Mapping[str, Sequence[str]]) -> DataFrame:
    """Add the first answered of several columns as one column."""
    return df.select("*", *[F.coalesce(*[lit_col(c) for c in cols]).alias(new) for new, cols in pairs.items()])


def conform(df: DataFrame, mapping: Mapping[str, str], canonical: Sequence[str]) -> DataFrame:
    """The canonical columns of a wave, as text; unmapped ones are NULL."""
    return df.select(
        *[
            lit_col(mapping[c]).cast("string").alias(c)
            if mapping.get(c) in df.columns
            else F.lit(None).cast("string").alias(c)
            for c in canonical
        ]
    )


def with_row_id(df: DataFrame, name: str = "source_row") -> DataFrame:
    """A row id that is unique within this frame; the key of a wave is (wave, id)."""
    return df.select(F.monotonically_increasing_id().alias(name), "*")


def union_all_by_name(dfs: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; columns a frame lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def union_waves(waves: Mapping[str, DataFrame], wave: str = "edition") -> DataFrame:
    return union_all_by_name([df.withColumn(wave, F.lit(w)) for w, df in waves.items()])


def harmonize(waves: Mapping[str, DataFrame], mapping: DataFrame, wave: str = "edition") -> DataFrame:
    """All waves under the canonical schema, tagged with their wave.

    ``mapping`` is ``(wave, canonical, source)``, one row per column.
    """
    by_wave: dict[str, dict[str, str]] = {w: {} for w in waves}
    for row in mapping.filter(F.col("wave").isin(list(waves))).collect():
        by_wave[row["wave"]][row["canonical"]] = row["source"]
    canonical = sorted(set().union(*by_wave.values()))
    return union_waves({w: conform(df, by_wave[w], canonical) for w, df in waves.items()}, wave)
