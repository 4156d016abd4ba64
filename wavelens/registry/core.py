"""Registered queries: a Spark callable and, where SQL can say it, a DuckDB check."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from wavelens import testviews as tv

Run = Callable[[SparkSession, str], DataFrame]

VIEWS = {
    "responses": tv.duck(tv.RESPONSES),
    "flags": tv.duck(tv.FLAGS),
    "name_catalog": tv.duck(tv.NAME_CATALOG),
    "people": tv.duck(tv.PEOPLE),
    "survey": tv.duck(tv.SURVEY),
}


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


QUERIES: dict[str, Query] = {}


def register(key: str, run: Run, sql: str | None = None) -> None:
    """Add a query; test views named in ``sql`` are put in front of it."""
    if key in QUERIES:
        raise ValueError(f"query {key} is registered twice")
    QUERIES[key] = Query(run, with_views(sql) if sql else None)


def register_as(key: str, run: Run, other: str) -> None:
    """Add a query that must give what the registered query ``other`` gives."""
    register(key, run)
    QUERIES[key] = Query(run, QUERIES[other].sql)


def with_views(sql: str) -> str:
    used = [f"{n} AS MATERIALIZED ({t})" for n, t in VIEWS.items() if re.search(rf"\b{n}\b", sql)]
    if not used:
        return sql
    head = re.match(r"\s*WITH( RECURSIVE)? ", sql)
    if head is None:
        return f"WITH {', '.join(used)} {sql.strip()}"
    return f"WITH{head[1] or ''} {', '.join(used)}, {sql[head.end():]}"


# A share of NULLs to one decimal, over ``missing`` and ``total``. A tie between two tenths is where 2000 * missing is
# an odd multiple of the total. By its binary value, a share that is a multiple of a quarter is the tie itself and goes
# to even; any other is on one side of it.
ROUNDED_SHARE = """CASE WHEN (2000 * missing) % total = 0 AND (2000 * missing // total) % 2 = 1 AND (400 * missing) % total = 0
 THEN 2 * round_even(1000 * missing / total / 2, 0) / 10 ELSE round(CAST(missing AS DOUBLE) / total * 100, 1) END"""


# --- pieces of check SQL ----------------------------------------------------------


def and_not_null(cols: Sequence[str]) -> str:
    return " AND ".join(f"{c} IS NOT NULL" for c in cols)


def dist_sql(view: str, variables: Sequence[str], dims: Sequence[str], scale: int = 1) -> str:
    """Counts per variable by separate aggregates, shares by a window."""
    d = ", ".join(dims)
    parts = " UNION ALL ".join(
        f"SELECT {d}, '{x}' AS variable, CAST({x} AS VARCHAR) AS value, count(*) AS n "
        f"FROM {view} WHERE {and_not_null([x, *dims])} GROUP BY {d}, {x}"
        for x in variables
    )
    total = f"sum(n) OVER (PARTITION BY {d}, variable)"
    return (
        f"SELECT {d}, variable, value, n, CAST({total} AS BIGINT) AS base, "
        f"round(CAST(n AS DOUBLE) / {total} * 100, {scale}) AS pct FROM ({parts}) parts"
    )


def adoption_sql(
    view: str, groups: dict[str, dict[str, str]], dims: Sequence[str], unmapped: str = "zero"
) -> str:
    """Adoption by one aggregate per option over the eligible rows."""
    d = ", ".join(dims)
    parts = []
    for category, options in groups.items():
        shown = f"coalesce({', '.join(options)}, NULL) IS NOT NULL"
        for column, option in options.items():
            flag = f"TRY_CAST({column} AS DOUBLE)"
            if unmapped == "zero":
                flag = f"coalesce({flag}, 0.0)"
            parts.append(
                f"SELECT {d}, '{option}' AS option, count(*) AS eligible, sum({flag}) AS selected, "
                f"'{category}' AS category FROM {view} WHERE {shown} AND {and_not_null(dims)} GROUP BY {d}"
            )
    return (
        f"SELECT {d}, option, eligible, selected, round(selected / eligible * 100, 1) AS pct, category "
        f"FROM ({' UNION ALL '.join(parts)}) parts"
    )


def quantile_sql(
    source: str, dims: Sequence[str], position: str, weight: str = "1", basis: str = "exact",
    total: str = "total",
) -> str:
    """Percentile bands by running sums over the ordered bands."""
    d = ", ".join(dims)
    reach = {
        "exact": lambda q: f"cum >= total * {q}",
        "round2": lambda q: f"round(CAST(cum AS DOUBLE) / total * 100, 2) >= {q} * 100",
        "round0": lambda q: f"round(CAST(cum AS DOUBLE) / total * 100, 0) >= {q} * 100",
    }[basis]
    return (
        f"SELECT {d}, CAST(max(total) AS BIGINT) AS {total}, "
        f"min(CASE WHEN {reach(0.5)} THEN pos END) AS p50, min(CASE WHEN {reach(0.75)} THEN pos END) AS p75 "
        f"FROM (SELECT *, sum(n) OVER (PARTITION BY {d}) AS total, "
        f"sum(n) OVER (PARTITION BY {d} ORDER BY pos) AS cum FROM ("
        f"SELECT {d}, {position} AS pos, sum({weight}) AS n FROM {source} "
        f"WHERE {position} IS NOT NULL AND {and_not_null(dims)} GROUP BY {d}, {position}) bands) running GROUP BY {d}"
    )
