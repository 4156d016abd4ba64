"""Matching question names between waves: exact, fuzzy, one to one."""

from __future__ import annotations

from collections.abc import Mapping
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wavelens.session import cut_lineage

# Acceptance threshold and confidence limits of fuzzy matches.
MIN_SCORE = 0.60
HIGH_CONFIDENCE = 0.85
MEDIUM_CONFIDENCE = 0.70

# Room for the last digit of a double when a bound is compared.
SLACK = 1e-9

# Buckets that names sharing a letter are spread over.
SALTS = 8


def match_exact(base: DataFrame, other: DataFrame) -> DataFrame:
    """Names both sides have; both are ``(position, name)`` frames of distinct names."""
    left = base.select("name", F.col("position").alias("base_position"))
    return left.join(other.select("name", F.col("position").alias("other_position")), "name", "inner")


def _letters(name: Column) -> Column:
    """Letters numbered by occurrence (``a1 n1 a2``), so that a set is a multiset."""
    chars = F.split(name, "")
    return F.transform(
        chars,
        lambda c, i: F.concat(
            c, F.size(F.filter(F.slice(chars, F.lit(1), i + 1), lambda d: d == c)).cast("string")
        ),
    )


def similarity(base: Column, other: Column, kind: str) -> Column:
    """``levenshtein``: one minus edits over the longer length. ``sequence``: matching
    blocks, twice their length over both lengths, in the order (base, other); it takes
    Python for every pair and is no default."""
    if kind == "levenshtein":
        longer = F.greatest(F.length(base), F.length(other))
        return 1 - F.levenshtein(base, other) / longer
    if kind != "sequence":
        raise ValueError(f"unknown similarity: {kind}")

    def ratio(left: pd.Series, right: pd.Series) -> pd.Series:
        scores = [SequenceMatcher(None, a, b).ratio() for a, b in zip(left, right, strict=True)]
        return pd.Series(scores, dtype="float64")

    return F.pandas_udf(ratio, "double")(base, other)


def two_decimals(score: Column, kind: str) -> Column:
    """The score as it is published: the sequence ratio by its binary value, where
    0.625 gives 0.62 and 0.845 gives 0.84; the levenshtein ratio half up."""
    if kind == "levenshtein":
        return F.round(score, 2)

    def binary(scores: pd.Series) -> pd.Series:
        return scores.map(lambda x: round(x, 2)).astype("float64")

    return F.pandas_udf(binary, "double")(score)


def _prefixes(names: DataFrame, counts: DataFrame, side: str, need: float) -> DataFrame:
    """Names with their letters and the rarest of them that a partner must share one of.

    A partner has at least ``need`` times as many letters in common as the name is long,
    so it cannot lack all of the rarest ``n - ceil(need * n) + 1``.
    """
    named = names.select(
        F.col("position").alias(f"{side}_position"),
        F.col("name").alias(side),
        _letters(F.col("name")).alias(f"{side}_letters"),
    )
    letters = named.select(side, F.explode(f"{side}_letters").alias("letter")).join(counts, "letter")
    ordered = letters.groupBy(side).agg(F.sort_array(F.collect_list(F.struct("n", "letter"))).alias("ordered"))
    size = F.size("ordered")
    rarest = F.slice("ordered", F.lit(1), size - F.ceil(size * need - SLACK).cast("int") + 1)
    return named.join(ordered.select(side, rarest["letter"].alias(f"{side}_rarest")), side)


def fuzzy_candidates(
    base: DataFrame, other: DataFrame, min_score: float = MIN_SCORE, kind: str = "levenshtein"
) -> DataFrame:
    """All pairs of names scoring at least ``min_score``.

    Neither similarity can exceed what the lengths and the shared letters of two names
    allow, so names meet on the rarest letters of either that a partner cannot all lack,
    each pair once, at the first of them. Frequent letters are spread: the base side is
    dealt over ``SALTS`` buckets, and the other side goes to all of them. What lengths and
    letters rule out never leaves the join, and no pair that reaches the score is lost.
    Names are table headers: both lists are bounded by the width of a table.
    """
    if kind == "levenshtein":
        need = min_score
        possible = F.greatest(F.size("base_letters"), F.size("other_letters"))
    else:
        need = min_score / (2 - min_score)
        possible = (F.size("base_letters") + F.size("other_letters")) / 2
    every = base.select("name").unionAll(other.select("name"))
    counts = every.select(F.explode(_letters(F.col("name"))).alias("letter")).groupBy("letter").agg(
        F.count(F.lit(1)).alias("n")
    )
    left = _prefixes(base, counts, "base", need).withColumn("salt", F.pmod(F.hash("base"), F.lit(SALTS)))
    left = left.withColumn("letter", F.explode("base_rarest"))
    right = _prefixes(other, counts, "other", need).withColumn("letter", F.explode("other_rarest"))
    right = right.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    first = F.element_at(F.array_intersect("base_rarest", "other_rarest"), 1) == F.col("letter")
    sizes = F.least(F.size("base_letters"), F.size("other_letters")) >= (
        F.greatest(F.size("base_letters"), F.size("other_letters")) * need - SLACK
    )
    shared = F.size(F.array_intersect("base_letters", "other_letters"))
    pairs = left.join(right, ["letter", "salt"]).filter(sizes & first & (shared >= possible * min_score - SLACK))
    scored = pairs.withColumn("score", similarity(F.col("base"), F.col("other"), kind))
    return scored.filter(F.col("score") >= min_score).select(
        "base_position", "base", "other_position", "other", "score"
    )


PAIR = ["base_position", "base", "other_position", "other", "score"]


def assign_one_to_one(pairs: DataFrame) -> DataFrame:
    """Greedy assignment: best score first, ties by base and then other position.

    A pair is taken if no better pair of either name is. One that is the best of both its
    names is taken at once. One with a single better pair is taken if that one is not, so
    such pairs hang in chains, and a chain is followed to its end by pointer jumping: each
    step joins every pair to what its better pair has found, so that steps double. What
    hangs on a pair with several better ones waits; pairs of the names taken go, and the
    rest starts anew. Every step is written once to the shared folder. A name has at most
    as many candidates as the other table is wide, which bounds the windows.
    """
    left = cut_lineage(pairs.select(*PAIR).withColumn("id", F.monotonically_increasing_id()))
    accepted = []
    while not left.isEmpty():
        ended = _followed(cut_lineage(_links(left)))
        taken = ended.filter("flips % 2 = 0").select("id", "base", "other")
        accepted.append(left.join(taken.select("id"), "id", "left_semi").select(*PAIR))
        left = cut_lineage(left.join(taken, "base", "left_anti").join(taken, "other", "left_anti"))
    out = left.select(*PAIR)
    for taken in accepted:
        out = out.unionAll(taken)
    return out


def _links(left: DataFrame) -> DataFrame:
    """Pairs with at most one better pair: ``(id, base, other, parent, flips, ended)``.

    ``parent`` is the better pair, or the pair itself at the end of a chain; ``flips``
    counts the steps to it.
    """
    order = [F.desc("score"), F.asc("base_position"), F.asc("other_position")]
    ranked = left
    for side in ("base", "other"):
        within = Window.partitionBy(side).orderBy(*order)
        ranked = ranked.withColumn(f"{side}_rank", F.row_number().over(within))
        ranked = ranked.withColumn(f"{side}_best", F.first("id").over(within))
    best = (F.col("base_rank") == 1) & (F.col("other_rank") == 1)
    parent = F.when(F.col("base_rank") == 2, F.col("base_best")).otherwise(F.col("other_best"))
    return ranked.filter("base_rank + other_rank <= 3").select(
        "id", "base", "other", F.when(best, F.col("id")).otherwise(parent).alias("parent"),
        F.when(best, 0).otherwise(1).cast("long").alias("flips"), best.alias("ended"),
    )


def _followed(links: DataFrame) -> DataFrame:
    """The links whose chain ends, with ``parent`` its end and ``flips`` the steps to there."""
    while not links.filter("NOT ended").isEmpty():
        above = links.select(
            F.col("id").alias("parent"), F.col("parent").alias("next"), F.col("flips").alias("more"), F.col("ended").alias("end")
        )
        links = cut_lineage(
            links.join(above, "parent").select(
                "id", "base", "other", F.col("next").alias("parent"), (F.col("flips") + F.col("more")).alias("flips"), F.col("end").alias("ended")
            )
        )
    return links


def unmatched(names: DataFrame, matches: DataFrame, side: str) -> DataFrame:
    """Names of one side that no accepted match uses."""
    return names.join(matches.select(F.col(side).alias("name")), "name", "left_anti")


def confidence(method: Column, score: Column) -> Column:
    """Exact is high; fuzzy goes by its score rounded to two decimals; else NULL."""
    fuzzy = (
        F.when(score >= HIGH_CONFIDENCE, "high")
        .when(score >= MEDIUM_CONFIDENCE, "medium")
        .otherwise("low")
    )
    return F.when(method == "exact", "high").when(method == "fuzzy", fuzzy)


def match_names(base: DataFrame, other: DataFrame, kind: str = "levenshtein") -> DataFrame:
    """``(base, other, method, score, confidence)``: every name of either side once.

    Exact names first, then the greedy fuzzy assignment of the rest, then the
    names left over: ``no_match`` for the base, ``only_here`` for the other.
    """
    exact = match_exact(base, other).select(F.col("name").alias("base"), F.col("name").alias("other"))
    rest_base, rest_other = unmatched(base, exact, "base"), unmatched(other, exact, "other")
    fuzzy = assign_one_to_one(fuzzy_candidates(rest_base, rest_other, kind=kind))
    none = F.lit(None).cast("string")
    found = exact.select("base", "other", F.lit("exact").alias("method"), F.lit(1.0).alias("score"))
    found = found.unionAll(
        fuzzy.select("base", "other", F.lit("fuzzy"), two_decimals(F.col("score"), kind))
    )
    lone = unmatched(rest_base, fuzzy, "base").select(
        F.col("name").alias("base"), none.alias("other"), F.lit("no_match"), F.lit(0.0)
    )
    extra = unmatched(rest_other, fuzzy, "other").select(
        none.alias("base"), F.col("name").alias("other"), F.lit("only_here"), F.lit(None).cast("double")
    )
    out = found.unionAll(lone).unionAll(extra)
    return out.withColumn("confidence", confidence(F.col("method"), F.col("score")))


def correspond(base: DataFrame, others: Mapping[str, DataFrame], kind: str = "levenshtein") -> DataFrame:
    """The correspondence dictionary: one row per base name, then the exclusive names.

    Columns are ``base`` and, for every other wave W, ``name_W``, ``method_W``,
    ``score_W`` and ``confidence_W``.
    """
    rows = base.select(F.col("name").alias("base"))
    exclusive = []
    for wave, names in others.items():
        matched = match_names(base, names, kind).select(
            "base",
            F.col("other").alias(f"name_{wave}"),
            *[F.col(c).alias(f"{c}_{wave}") for c in ("method", "score", "confidence")],
        )
        rows = rows.join(matched.filter(F.col("base").isNotNull()), "base", "left")
        exclusive.append(matched.filter(F.col("base").isNull()))
    for extra in exclusive:
        rows = rows.unionByName(extra, allowMissingColumns=True)
    return rows


def trusted(method: Column, conf: Column, review: Column) -> Column:
    """Whether a correspondence may be used; a manual review decides first."""
    return (
        F.when(review == "rejected", F.lit(False))
        .when(review == "approved", F.lit(True))
        .when(method == "exact", F.lit(True))
        .when((method == "fuzzy") & (conf == "high"), F.lit(True))
        .otherwise(F.lit(False))
    )


def canonical_map(dictionary: DataFrame, base_wave: str, others: list[str]) -> DataFrame:
    """``(wave, canonical, source)``: base names are canonical, exclusive ones their own."""
    own = F.col("base").isNotNull()
    cells = [F.struct(F.lit(base_wave).alias("wave"), F.col("base").alias("source"), own.alias("ok"))]
    for wave in others:
        review = f"review_{wave}"
        decision = F.col(review) if review in dictionary.columns else F.lit(None).cast("string")
        ok = F.col("base").isNull() | trusted(
            F.col(f"method_{wave}"), F.col(f"confidence_{wave}"), decision
        )
        cells.append(
            F.struct(F.lit(wave).alias("wave"), F.col(f"name_{wave}").alias("source"), ok.alias("ok"))
        )
    canonical = F.coalesce("base", *[f"name_{w}" for w in others]).alias("canonical")
    long = dictionary.select(canonical, F.inline(F.array(*cells)))
    return long.filter(F.col("ok") & F.col("source").isNotNull()).select("wave", "canonical", "source")


def canonical_names(mapping: DataFrame) -> DataFrame:
    """The sorted union of canonical names of all waves."""
    return mapping.select("canonical").distinct().orderBy("canonical")
