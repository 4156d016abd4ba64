"""Column expressions that map one set of labels to another."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _lookup(pairs: Mapping) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def relabel(col: Column, names: Mapping[str, str]) -> Column:
    """Display name of a code; a code without one is kept."""
    return F.coalesce(F.element_at(_lookup(names), col), col)


def remap(col: Column, merged: Mapping[str, Sequence[str]]) -> Column:
    """Merge several spellings into one label; other labels are kept."""
    return relabel(col, {old: new for new, olds in merged.items() for old in olds})


def binary_regroup(col: Column, label: str, this: str, rest: str) -> Column:
    """One label against everything else (NULL counts as the rest)."""
    return F.when(col == label, this).otherwise(rest)


def classify_text(col: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """First rule that matches wins; rules are ``(contains|startswith, text, class)``."""
    out = col
    for how, text, name in reversed(rules):
        test = {"contains": col.contains, "startswith": col.startswith}[how](text)
        out = F.when(test, F.lit(name)).otherwise(out)
    return out


def ordinal(col: Column, scale: Sequence[str], unmapped: int | str | None = None) -> Column:
    """1-based position of a label on ``scale``.

    ``unmapped`` is None (NULL), a number for labels off the scale, or
    ``"error"`` to stop the job at the first such label.
    """
    position = F.element_at(_lookup({label: i for i, label in enumerate(scale, 1)}), col)
    if unmapped is None:
        return position
    if unmapped == "error":
        missing = F.raise_error(F.concat(F.lit("label off the scale: "), col)).cast("int")
        return F.when(col.isNull() | position.isNotNull(), position).otherwise(missing)
    return F.coalesce(position, F.lit(unmapped))


def ordinal_label(position: Column, scale: Sequence[str]) -> Column:
    """Label at a 1-based position; NULL when there is none."""
    return F.element_at(_lookup(dict(enumerate(scale, 1))), position)


def small_base_flag(base: Column, minimum: int = 30) -> Column:
    """Text flag for slices below ``minimum``; the rows stay in the result."""
    return F.when(base < minimum, f"Amostra pequena (<{minimum})").otherwise("OK")


def share(part: Column, whole: Column, scale: int = 1) -> Column:
    """Percentage rounded half up; the order of operations decides ties."""
    return F.round(part / whole * 100, scale)
