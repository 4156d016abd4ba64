"""Forms of profiles and adoption for very wide, very long or growing tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavelens import testviews as tv
from wavelens.operators import adoption as ad
from wavelens.operators import profile as pr
from wavelens.operators import standardize as st
from wavelens.plans import fixed_values as v
from wavelens.registry import basics  # noqa: F401 - its checks are used again
from wavelens.registry.core import adoption_sql, register, register_as
from wavelens.registry.survey_ops import GROUPS, GROUPS_SQL
from wavelens.session import scratch_path, stored
from wavelens.sources import writers

R, FL = tv.responses, tv.flags
_COLUMNS = ["edition", "role", "level", "segment", "region", "work_model", "pay_band"]


# --- counts that ride on a write -----------------------------------------------------------


def null_dictionary_on_write(s, d) -> DataFrame:
    """The null dictionary of two waves, each from the job that writes the wave."""
    parts = []
    for wave, rows in (("responses", R(s, d)), ("flags", FL(s, d))):
        out, profile = pr.ProfileOnWrite.of(rows)
        writers.write_table(out, scratch_path(s, wave))
        parts.append(profile.null_dictionary(s, wave))
    return st.union_all_by_name(parts)


register_as("profile_on_write", null_dictionary_on_write, "survey_null_dictionary")

BANDS = ", ".join(f"'band_{i}'" for i in range(1, 13))


def checks_on_write(s, d) -> DataFrame:
    """Labels off the scale, answers out of the list and missing dimensions, counted by the write."""
    out, profile = pr.ProfileOnWrite.of(R(s, d), {
        "pay_band_on_scale": F.expr(f"pay_band IN ({BANDS})"),
        "level_known": F.col("level").isin("F", "O"),
        "region_given": F.col("region").isNotNull(),
        "level_given": F.col("level").isNotNull(),
    })
    writers.write_table(out, scratch_path(s, "checked"))
    return profile.failures(s)


register("check_on_write", checks_on_write, " UNION ALL ".join(
    f"SELECT '{name}' AS \"check\", count(*) AS rows, count(*) FILTER (NOT ({ok})) AS failed FROM responses"
    for name, ok in (("pay_band_on_scale", f"pay_band IN ({BANDS})"), ("level_known", "level IN ('F', 'O')"),
                     ("region_given", "region IS NOT NULL"), ("level_given", "level IS NOT NULL"))))

# --- distinct values over waves ------------------------------------------------------------


def distinct_merged(s, d) -> DataFrame:
    """Distinct values of every column over all waves, from one summary per wave.

    Each wave is summarised alone and its summary written; together they are read without
    the waves. The estimates are held against exact counts, within the stated error.
    """
    path = scratch_path(s, "sketches")
    rows = stored(R(s, d), "responses")
    for wave in [r[0] for r in rows.select("edition").distinct().collect()]:
        own = rows.filter(F.col("edition") == wave)
        writers.write_wave(pr.distinct_sketches(own, wave, [*_COLUMNS, "resp_id"]), path, wave)
    found = pr.merged_distinct(s.read.parquet(path).select("column", "sketch"))
    exact = pr.distinct_profile(rows, [*_COLUMNS, "resp_id"]).withColumnRenamed("distinct_values", "exact")
    near = F.abs(F.col("distinct_values") - F.col("exact")) <= F.col("exact") * 0.033
    return found.join(exact, "column").select("column", "waves", "exact", near.alias("within_error"))


register("profile_distinct_merged", distinct_merged, " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT edition) AS waves, count(DISTINCT {c}) AS exact, true AS within_error FROM responses"
    for c in [*_COLUMNS, "resp_id"]))

# --- frequent labels, duplicates, many options ---------------------------------------------


def top_open_labels(s, d) -> DataFrame:
    """The five most frequent answers by kind, where the answers are open-ended."""
    events = tv.view(s, d, "SELECT event_type, CAST(user_id AS STRING) AS answer FROM {events}")
    return pr.top_labels(events, ["event_type"], "answer", v.TOP_K)


register("topk_open_labels", top_open_labels, f"""
SELECT event_type, label, n, ranking FROM (
 SELECT *, CAST(row_number() OVER (PARTITION BY event_type ORDER BY n DESC, label) AS INTEGER) AS ranking FROM (
  SELECT event_type, CAST(user_id AS VARCHAR) AS label, count(*) AS n FROM events WHERE user_id IS NOT NULL GROUP BY 1, 2) c) r
WHERE ranking <= {v.TOP_K}""")
register_as("profile_duplicates_fingerprint",
            lambda s, d: pr.duplicates_by_fingerprint(R(s, d).select("edition", "role", "level", "region", "pay_band")),
            "profile_duplicates")
register("survey_adoption_packed",
         lambda s, d: ad.adoption_packed(FL(s, d), GROUPS, ["edition"]), GROUPS_SQL)
register("survey_adoption_packed_null",
         lambda s, d: ad.adoption_packed(FL(s, d), GROUPS, ["edition"], "null"), adoption_sql("flags", GROUPS, ["edition"], "null"))
