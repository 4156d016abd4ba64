"""Composite survey operators, matching, harmonisation and quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from wavelens import testviews as tv
from wavelens.functions import labels as lb
from wavelens.functions import text as tx
from wavelens.operators import adoption as ad
from wavelens.operators import checks as ck
from wavelens.operators import distribution as di
from wavelens.operators import evolution as ev
from wavelens.operators import filters as fl
from wavelens.operators import matching as ma
from wavelens.operators import ordinal as od
from wavelens.operators import profile as pr
from wavelens.operators import standardize as st
from wavelens.registry.basics import (
    ADOPT, BANDS, DIST, FL, OPTS, POS, R, VALS, _BANDS_BY_ROLE, _CATALOG, _MERGE, _ROLE_COUNTS,
    _pivot, adopted, bands_by_role, dist, evolved, role_counts, with_position,
)
from wavelens.registry.core import ROUNDED_SHARE, adoption_sql, dist_sql, quantile_sql, register
from wavelens.session import header_table, scratch_path
from wavelens.sources import readers

GROUPS = {"events": {c: c[4:] for c in OPTS}, "value": {c: c[4:] for c in VALS}}
GROUP_PREFIXES = {"events": "opt_", "value": "val_", "absent": "nothing_"}
GROUPS_SQL = adoption_sql("flags", GROUPS, ["edition"])
UNASKED_SQL = adoption_sql(
    "(SELECT *, CAST(NULL AS VARCHAR) AS void_a, CAST(NULL AS VARCHAR) AS void_b FROM flags) f",
    GROUPS | {"unasked": {"void_a": "a", "void_b": "b"}}, ["edition"])


def grouped(s, d):
    """All groups; one that the table does not have is skipped."""
    df = FL(s, d)
    return ad.adoption_groups(df, ad.groups_by_prefix(df, GROUP_PREFIXES), ["edition"])


def grouped_with_unasked(s, d):
    """The same and a group that nobody was asked, whose category drops out."""
    df = FL(s, d).withColumns({c: F.lit(None).cast("string") for c in ("void_a", "void_b")})
    prefixes = GROUP_PREFIXES | {"unasked": "void_"}
    return ad.adoption_groups(df, ad.groups_by_prefix(df, prefixes), ["edition"])


# --- distributions and adoption -----------------------------------------------------------

register("survey_distribution",
         lambda s, d: di.distribution(R(s, d), ["role", "segment", "work_model", "pay_band", "not_there"], ["edition", "level"]),
         dist_sql("responses", ["role", "segment", "work_model", "pay_band"], ["edition", "level"]))
register("survey_adoption", adopted, ADOPT)
register("survey_adoption_unmapped_null",
         lambda s, d: ad.adoption(FL(s, d), OPTS, ["edition"], "opt_", unmapped="null"),
         "SELECT edition, option, eligible, selected, pct FROM (" + adoption_sql("flags", {"": GROUPS["events"]}, ["edition"], "null") + ") a")
register("survey_adoption_groups", grouped, GROUPS_SQL)
register("survey_adoption_nonempty",
         grouped_with_unasked, f"SELECT * FROM ({UNASKED_SQL}) a WHERE eligible > 0")


def survey_mixed_union(s, d):
    level = di.distribution(R(s, d), ["level"], ["edition"]).withColumnRenamed("variable", "source_variable")
    return st.union_all_by_name([level.withColumn("category", F.lit("level")), grouped(s, d).withColumnRenamed("pct", "pct_adopted")])


register("survey_mixed_union", survey_mixed_union, f"""
SELECT edition, variable AS source_variable, value, n, base, pct, 'level' AS category, CAST(NULL AS VARCHAR) AS option,
       CAST(NULL AS BIGINT) AS eligible, CAST(NULL AS DOUBLE) AS selected, CAST(NULL AS DOUBLE) AS pct_adopted
FROM ({dist_sql('responses', ['level'], ['edition'])}) l
UNION ALL SELECT edition, NULL, NULL, NULL, NULL, NULL, category, option, eligible, selected, pct FROM ({GROUPS_SQL}) a""")

# --- standardising a raw wave -----------------------------------------------------------------

# (raw header, expression over flags)
RAW = [
    ("1.a_Usuário/Código (id)", "CAST(user_id AS {S})"),
    ("1.b_Dia", "CAST(day AS {S})"),
    ("2.l_Critérios", "concat_ws(', ', CASE WHEN opt_click = '1' THEN 'Salário' END, CASE WHEN opt_view = '1' THEN 'Remoto' END)"),
    ("2.l.1_Salário", "opt_click"),
    ("2.l.2_Remoto", "opt_view"),
    ("2.l.3_Texto livre", "edition"),
    ("2.l.4_Nunca mostrada", "opt_refund"),
    ("3.f_IA", "CASE WHEN edition = 'w2' THEN 'Não uso' END"),
    ("3.f.1_Não uso", "CASE WHEN edition = 'w2' THEN opt_purchase END"),
    ("4.l_IA", "CASE WHEN edition <> 'w2' THEN 'Não uso' END"),
    ("4.l.1_Não uso", "CASE WHEN edition <> 'w2' THEN opt_signup END"),
]
ALIASES = [("3.f", "4.l")]
RAW_VIEW = "SELECT " + ", ".join(f"{e} AS c{i}" for i, (_, e) in enumerate(RAW)) + f" FROM ({tv.FLAGS}) f"
STANDARD_SQL = """SELECT CAST(user_id AS VARCHAR) AS usuario_codigo_id, CAST(day AS VARCHAR) AS dia, opt_click AS criterios_salario,
 opt_view AS criterios_remoto, edition AS texto_livre, opt_refund AS nunca_mostrada,
 CASE WHEN edition = 'w2' THEN opt_purchase ELSE opt_signup END AS ia_nao_uso FROM flags"""


def raw_wave(s, d):
    return tv.view(s, d, RAW_VIEW).toDF(*[h for h, _ in RAW])


def headers(s, d):
    df = raw_wave(s, d)
    return df, st.parsed_catalog(header_table(s, df.columns))


def survey_standardize(s, d):
    """Through a CSV whose header is damaged, as a raw wave would come in."""
    path = scratch_path(s, "wave")
    damaged = raw_wave(s, d).toDF(*[h.encode("utf-8").decode("latin-1") for h, _ in RAW])
    damaged.write.option("header", True).option("escape", '"').csv(path)
    return st.standardize(readers.read_wave(s, path), aliases=ALIASES)


register("survey_standardize", survey_standardize, STANDARD_SQL)
register("proj_drop_parents", lambda s, d: st.standardize(raw_wave(s, d), aliases=ALIASES), STANDARD_SQL)
register("survey_detect_groups",
         lambda s, d: st.detect_groups(*headers(s, d)).select("root", "parent", "parent_label", "name", "label"),
         """WITH t AS (SELECT * FROM (VALUES ('2.l', '2.l_Critérios', 'Critérios', '2.l.1_Salário', 'Salário', 'opt_click'),
         ('2.l', '2.l_Critérios', 'Critérios', '2.l.2_Remoto', 'Remoto', 'opt_view'), ('2.l', '2.l_Critérios', 'Critérios', '2.l.3_Texto livre', 'Texto livre', 'edition'),
         ('2.l', '2.l_Critérios', 'Critérios', '2.l.4_Nunca mostrada', 'Nunca mostrada', 'opt_refund'), ('3.f', '3.f_IA', 'IA', '3.f.1_Não uso', 'Não uso', 'opt_purchase'),
         ('4.l', '4.l_IA', 'IA', '4.l.1_Não uso', 'Não uso', 'opt_signup')) v(root, parent, parent_label, name, label, col)),
         b AS (""" + " UNION ALL ".join(
             f"SELECT '{c}' AS col, bool_and({c} IN ('0', '1')) AS ok FROM flags" for c in
             ("opt_click", "opt_view", "edition", "opt_refund", "opt_purchase", "opt_signup")) +
         ") SELECT root, parent, parent_label, name, label FROM t JOIN b USING (col) WHERE ok")
register("check_name_collision",
         lambda s, d: ck.name_collisions(
             tv.view(s, d, "SELECT DISTINCT p_name, p_type FROM {part}").select(
                 tx.normalize_name(F.concat_ws("_", "p_name")).alias("name"))),
         "SELECT replace(p_name, ' ', '_') AS name, count(*) AS n FROM (SELECT DISTINCT p_name, p_type FROM part) t GROUP BY 1 HAVING count(*) > 1")


def survey_null_dictionary(s, d):
    return st.union_all_by_name(
        [pr.null_dictionary(R(s, d), "responses"), pr.null_dictionary(FL(s, d), "flags")]
    ).orderBy("wave", F.desc("pct_null"))


def _null_row(view, c):
    return (f"SELECT '{view}' AS wave, '{c}' AS \"column\", coalesce(bool_and(CAST({c} AS VARCHAR) IN ('0', '1')), false) AS b, "
            f"count(*) AS total, count(*) - count({c}) AS missing FROM {view}")


register("survey_null_dictionary", survey_null_dictionary,
         "SELECT wave, \"column\", CASE WHEN b THEN 'binary_multiselect' ELSE 'single_choice' END AS type, pct_null, "
         "CASE WHEN b THEN 'group_not_shown' WHEN pct_null < 10 THEN 'near_universal' ELSE 'conditional_on_profile' END AS null_meaning FROM ("
         + f"SELECT wave, \"column\", b, {ROUNDED_SHARE} AS pct_null FROM ("
         + " UNION ALL ".join(_null_row(w, c) for w, cols in _CATALOG for c in cols) + ") u) t")
register("profile_columns_like",
         lambda s, d: pr.columns_like(
             tv.view(s, d, tv.NAME_CATALOG), "^(blue|hot).*promo").select("wave", "name"),
         "SELECT wave, name FROM name_catalog WHERE regexp_matches(lower(name), '^(blue|hot).*promo')")

# --- matching names -----------------------------------------------------------------------------


def names(s, d, wave):
    return tv.question_names(s, d, wave)


def rest(s, d):
    a, b = names(s, d, "A"), names(s, d, "B")
    exact = ma.match_exact(a, b).select(F.col("name").alias("base"), F.col("name").alias("other"))
    return ma.unmatched(a, exact, "base"), ma.unmatched(b, exact, "other")


register("match_exact", lambda s, d: ma.match_exact(names(s, d, "A"), names(s, d, "B")).select("name"),
         "SELECT name FROM name_catalog WHERE wave = 'A' INTERSECT SELECT name FROM name_catalog WHERE wave = 'B'")


def match_unmatched(s, d):
    left, right = rest(s, d)
    return st.union_waves({"A": left.select("name"), "B": right.select("name")}, "wave")


register("match_unmatched", match_unmatched,
         "SELECT wave, name FROM name_catalog WHERE name IN (SELECT name FROM name_catalog GROUP BY name HAVING count(*) = 1)")
REST = """WITH RECURSIVE n AS (SELECT * FROM name_catalog WHERE name IN (SELECT name FROM name_catalog GROUP BY name HAVING count(*) = 1)),
 pairs AS (SELECT a.name AS base, b.name AS other, a.position AS base_position, b.position AS other_position, 1 - CAST(levenshtein(a.name, b.name) AS DOUBLE) / greatest(length(a.name), length(b.name)) AS score
 FROM n a JOIN n b ON a.wave = 'A' AND b.wave = 'B')"""


def candidates(s, d, kind):
    return ma.fuzzy_candidates(*rest(s, d), kind=kind)


register("match_fuzzy_candidates",
         lambda s, d: candidates(s, d, "levenshtein").select("base", "other", "score"),
         f"{REST} SELECT base, other, score FROM pairs WHERE score >= 0.6")

# The greedy order pair by pair, with the names used so far.
GREEDY = """, ordered AS (SELECT row_number() OVER (ORDER BY score DESC, base_position, other_position) AS i, base, other, score FROM pairs WHERE score >= 0.6),
 walk AS (SELECT CAST(0 AS BIGINT) AS i, CAST([] AS VARCHAR[]) AS used_base, CAST([] AS VARCHAR[]) AS used_other, false AS taken
  UNION ALL SELECT o.i, CASE WHEN f.free THEN list_append(w.used_base, o.base) ELSE w.used_base END,
   CASE WHEN f.free THEN list_append(w.used_other, o.other) ELSE w.used_other END, f.free
  FROM walk w JOIN ordered o ON o.i = w.i + 1, LATERAL (SELECT NOT list_contains(w.used_base, o.base) AND NOT list_contains(w.used_other, o.other) AS free) f),
 greedy AS (SELECT base, other, score FROM walk JOIN ordered USING (i) WHERE taken)"""
register("match_assign_greedy",
         lambda s, d: ma.assign_one_to_one(candidates(s, d, "levenshtein")).select("base", "other", "score"),
         f"{REST}{GREEDY} SELECT base, other, score FROM greedy")
CORRESPONDENCE = f"""{REST}{GREEDY}, matched AS (
         SELECT a.name AS base, a.name AS other, 'exact' AS method, 1.0::DOUBLE AS score FROM name_catalog a JOIN name_catalog b ON a.name = b.name WHERE a.wave = 'A' AND b.wave = 'B'
         UNION ALL SELECT base, other, 'fuzzy', round(score, 2) FROM greedy
         UNION ALL SELECT name, NULL, 'no_match', 0 FROM n WHERE wave = 'A' AND name NOT IN (SELECT base FROM greedy)
         UNION ALL SELECT NULL, name, 'only_here', NULL FROM n WHERE wave = 'B' AND name NOT IN (SELECT other FROM greedy))
         SELECT base, other AS "name_B", method AS "method_B", score AS "score_B", CASE WHEN method = 'exact' THEN 'high'
         WHEN method = 'fuzzy' THEN CASE WHEN score >= 0.85 THEN 'high' WHEN score >= 0.7 THEN 'medium' ELSE 'low' END END AS "confidence_B" FROM matched"""
register("survey_correspondence", lambda s, d: ma.correspond(names(s, d, "A"), {"B": names(s, d, "B")}), CORRESPONDENCE)
register("survey_correspondence_levenshtein",
         lambda s, d: ma.correspond(names(s, d, "A"), {"B": names(s, d, "B")}, "levenshtein"), CORRESPONDENCE)


def reviewed(s, d):
    """Candidate correspondences with a reviewer's verdict on some of them."""
    pairs = candidates(s, d, "levenshtein").withColumn("score", F.round("score", 2))
    verdict = F.when(F.col("base").startswith("blue"), "rejected").when(F.col("base").startswith("hot"), "approved")
    return pairs.select("base", "other", F.lit("fuzzy").alias("method"), "score", verdict.alias("review"))


register("survey_trust_policy",
         lambda s, d: reviewed(s, d).withColumn("confidence", ma.confidence(F.col("method"), F.col("score"))).withColumn(
             "trusted", ma.trusted(F.col("method"), F.col("confidence"), F.col("review"))),
         f"""{REST} SELECT base, other, method, score, review, confidence,
         CASE WHEN review = 'rejected' THEN false WHEN review = 'approved' THEN true ELSE confidence = 'high' END AS trusted FROM (
         SELECT *, CASE WHEN score >= 0.85 THEN 'high' WHEN score >= 0.7 THEN 'medium' ELSE 'low' END AS confidence FROM (
         SELECT base, other, 'fuzzy' AS method, round(score, 2) AS score, CASE WHEN base LIKE 'blue%' THEN 'rejected' WHEN base LIKE 'hot%' THEN 'approved' END AS review
         FROM pairs WHERE score >= 0.6) x) y""")


def dictionary(s, d):
    """Base names with their exact match or a manual verdict, then names only wave B has."""
    a, b = names(s, d, "A"), names(s, d, "B").select(F.col("name").alias("name_B"))
    joined = a.select(F.col("name").alias("base")).join(b, F.col("base") == F.col("name_B"), "full")
    exact = F.col("base") == F.col("name_B")
    review = F.when(F.col("base").startswith("cold"), "rejected")
    return joined.select(
        "base", "name_B", review.alias("review_B"),
        F.when(exact, "exact").when(F.col("base").isNull(), "only_here").otherwise("no_match").alias("method_B"),
        F.when(exact, "high").alias("confidence_B"))


register("survey_canonical_map", lambda s, d: ma.canonical_map(dictionary(s, d), "A", ["B"]),
         """SELECT 'A' AS wave, name AS canonical, name AS source FROM name_catalog WHERE wave = 'A'
         UNION ALL SELECT 'B', name, name FROM name_catalog b WHERE wave = 'B'
         AND NOT (name LIKE 'cold%' AND EXISTS (SELECT 1 FROM name_catalog a WHERE a.wave = 'A' AND a.name = b.name))""")
register("set_canonical_names", lambda s, d: ma.canonical_names(ma.canonical_map(dictionary(s, d), "A", ["B"])),
         """SELECT name AS canonical FROM name_catalog WHERE wave = 'A' UNION SELECT name FROM name_catalog b WHERE wave = 'B'
         AND NOT (name LIKE 'cold%' AND EXISTS (SELECT 1 FROM name_catalog a WHERE a.wave = 'A' AND a.name = b.name))""")


def survey_harmonize(s, d):
    rows = R(s, d)
    waves = {
        "early": rows.filter(F.col("edition") < "1998").select(F.col("role").alias("cargo"), F.col("level").alias("senioridade")),
        "late": rows.filter(F.col("edition") >= "1998").select(F.col("role").alias("cargo_2"), "region", F.col("level").alias("unused")),
    }
    mapping = s.createDataFrame(
        [("early", "cargo", "cargo"), ("early", "nivel", "senioridade"), ("late", "cargo", "cargo_2"),
         ("late", "regiao", "region"), ("late", "nivel", "no_such_column")],
        "wave string, canonical string, source string")
    return di.count_by(st.harmonize(waves, mapping), ["edition", "cargo", "nivel", "regiao"])


register("survey_harmonize", survey_harmonize, """
SELECT edition, cargo, nivel, regiao, count(*) AS n FROM (
 SELECT 'early' AS edition, role AS cargo, level AS nivel, NULL AS regiao FROM responses WHERE edition < '1998'
 UNION ALL SELECT 'late', role, NULL, region FROM responses WHERE edition >= '1998') h GROUP BY edition, cargo, nivel, regiao""")

# --- waves --------------------------------------------------------------------------------------


def reshared(s, d):
    rows = dist(s, d).filter(F.col("variable") == "role").withColumn("merged", lb.remap(F.col("value"), _MERGE))
    return di.reshare(rows, ["edition"], "merged")


RESHARED = f"""SELECT edition, merged, n, CAST(sum(n) OVER (PARTITION BY edition) AS BIGINT) AS base,
 round(CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY edition) * 100, 2) AS pct FROM (
 SELECT edition, CASE WHEN value IN ('1-URGENT', '2-HIGH') THEN 'top' ELSE value END AS merged, CAST(sum(n) AS BIGINT) AS n
 FROM ({DIST}) g WHERE variable = 'role' GROUP BY 1, 2) c"""
register("survey_reshare", reshared, RESHARED)
register("survey_comparable",
         lambda s, d: ev.comparable(fl.exclude_label(role_counts(s, d), "role", ["5-LOW"]), ["role", "region"], "edition", 7, "n", 60),
         f"SELECT role, region, count(DISTINCT edition) AS n_waves, min(n) AS smallest, max(n) AS largest FROM ({_ROLE_COUNTS}) c "
         "WHERE role <> '5-LOW' GROUP BY role, region HAVING count(DISTINCT edition) = 7 AND min(n) >= 60")
register("survey_evolution",
         lambda s, d: ev.evolution(reshared(s, d), ["merged"], "edition", "pct", ["1995", "1998", "2001"], 2)
         .orderBy(F.desc("variation"), "merged"),
         f"SELECT *, round(\"2001\" - \"1995\", 2) AS variation FROM (SELECT merged, {_pivot(['1995', '1998', '2001'])} FROM ({RESHARED}) g GROUP BY merged) t")
register("survey_evolution_available", evolved,
         f"""WITH a AS ({ADOPT}) SELECT option, min(edition) AS first_wave, max(edition) AS last_wave, count(DISTINCT edition) AS n_waves, arg_min(pct, edition) AS first_value,
 arg_max(pct, edition) AS last_value, round(arg_max(pct, edition) - arg_min(pct, edition), 1) AS variation FROM a WHERE pct > 0 GROUP BY option HAVING count(DISTINCT edition) >= 2""")

# --- ordered categories -----------------------------------------------------------------------------

FLAGSHIP_DIMS = ["edition", "region"]


def median_bands(s, d):
    """Median and upper-quartile band of every region and wave, ranked within the wave."""
    bands = od.ordinal_quantiles(with_position(R(s, d)), FLAGSHIP_DIMS, "pos", len(BANDS))
    return od.rank_by(bands, ["edition"], ["p50", "p75"])


register("ordinal_quantile_exact", median_bands,
         f"SELECT *, CAST(dense_rank() OVER (PARTITION BY edition ORDER BY p50 DESC, p75 DESC) AS INTEGER) AS ranking FROM ({quantile_sql('responses', FLAGSHIP_DIMS, POS)}) b")
for _basis in ("round2", "round0"):
    register(f"ordinal_quantile_{_basis}",
             lambda s, d, b=_basis: od.ordinal_quantiles(with_position(R(s, d)), ["edition", "region", "role"], "pos", 13, basis=b),
             quantile_sql("responses", ["edition", "region", "role"], POS, basis=_basis))


def survey_rank_profiles(s, d):
    bands = od.ordinal_quantiles(with_position(R(s, d)), ["level", "role", "region"], "pos", 13, basis="round0")
    kept = fl.min_base(bands, "total", 150, "role", ["5-LOW"])
    ranked = od.rank_by(kept, ["level"], ["p50", "p75"])
    return od.with_band_labels(ranked, BANDS, {"p50": "median_band", "p75": "upper_band"})


register("survey_rank_profiles", survey_rank_profiles, f"""
SELECT *, CAST(dense_rank() OVER (PARTITION BY level ORDER BY p50 DESC, p75 DESC) AS INTEGER) AS ranking,
 concat('band_', CAST(p50 AS VARCHAR)) AS median_band, concat('band_', CAST(p75 AS VARCHAR)) AS upper_band
FROM ({quantile_sql('responses', ['level', 'role', 'region'], POS, basis='round0')}) b WHERE total >= 150 AND role <> '5-LOW'""")


def survey_crossed_quantile(s, d):
    bands = od.ordinal_quantiles(with_position(R(s, d)), ["edition", "level", "region"], "pos", 13)
    ranked = od.rank_by(bands, ["edition", "level"], ["p50", "p75"], "rank_in_level")
    return ranked.withColumn("sample", lb.small_base_flag(F.col("total"), 130))


register("survey_crossed_quantile", survey_crossed_quantile, f"""
SELECT *, CAST(dense_rank() OVER (PARTITION BY edition, level ORDER BY p50 DESC, p75 DESC) AS INTEGER) AS rank_in_level,
 CASE WHEN total < 130 THEN 'Amostra pequena (<130)' ELSE 'OK' END AS sample
FROM ({quantile_sql('responses', ['edition', 'level', 'region'], POS)}) b""")
register("survey_band_movement",
         lambda s, d: od.band_movement(bands_by_role(s, d), ["role"], "edition", "1996", "2001", ["p50", "p75"]),
         f"""WITH b AS ({_BANDS_BY_ROLE}) SELECT * FROM b WHERE role IN (SELECT x.role FROM b x JOIN b y ON x.role = y.role
         WHERE x.edition = '1996' AND y.edition = '2001' AND (x.p50 <> y.p50 OR x.p75 <> y.p75))""")

# --- subgroups and external bases -------------------------------------------------------------------

register("survey_subgroup_share",
         lambda s, d: di.subgroup_share(di.count_by(R(s, d), ["edition", "region", "level"]), ["edition", "region"], "level", "P"),
         """SELECT edition, region, count(*) FILTER (WHERE level = 'P') AS members, count(*) AS total,
         round(CAST(count(*) FILTER (WHERE level = 'P') AS DOUBLE) / count(*) * 100, 1) AS pct FROM responses GROUP BY edition, region HAVING count(*) FILTER (WHERE level = 'P') > 0""")


def stated_level(s, d):
    return di.count_by(fl.not_null(R(s, d), ["level"]), ["edition"], "base")


register("survey_marks_ratio",
         lambda s, d: di.marks_ratio(di.count_by(R(s, d), ["edition"], "marks"), stated_level(s, d), ["edition"]),
         """SELECT edition, count(*) AS marks, count(level) AS base, count(*) - count(level) AS difference,
         round(CAST(count(*) AS DOUBLE) / count(level), 2) AS marks_per_respondent FROM responses GROUP BY edition""")
register("survey_presence_external_base",
         lambda s, d: di.presence(di.count_by(R(s, d), ["edition", "segment"]), stated_level(s, d), ["edition"]),
         """SELECT c.edition, segment, n, base, round(CAST(n AS DOUBLE) / base * 100, 1) AS pct FROM (SELECT edition, segment, count(*) AS n FROM responses GROUP BY edition, segment) c
         JOIN (SELECT edition, count(level) AS base FROM responses GROUP BY edition) t ON c.edition = t.edition""")


def survey_topbox(s, d):
    urgency = lb.classify_text(F.col("role"), [("startswith", "1", "now"), ("contains", "HIGH", "soon"), ("contains", "-", "later")])
    counts = di.distribution(R(s, d), ["role"], ["edition"]).withColumnRenamed("value", "role")
    place = lb.ordinal(urgency, ["now", "soon"], 5)
    return di.topbox_share(counts.withColumn("pos", place), ["edition"], "pos", [1, 2])


register("survey_topbox", survey_topbox, """
SELECT edition, count(*) FILTER (WHERE role IN ('1-URGENT', '2-HIGH')) AS top, count(*) AS base,
 round(CAST(count(*) FILTER (WHERE role IN ('1-URGENT', '2-HIGH')) AS DOUBLE) / count(*) * 100, 1) AS pct FROM responses GROUP BY edition""")

# --- adoption rankings --------------------------------------------------------------------------------

RANKED = f"""SELECT *, CAST(row_number() OVER (PARTITION BY edition, category ORDER BY pct DESC, selected DESC, option) AS INTEGER) AS ranking
 FROM ({GROUPS_SQL}) g WHERE pct > 0"""


def ranked(s, d):
    return ad.adoption_ranking(grouped(s, d), ["edition", "category"])


register("survey_adoption_ranking", ranked, RANKED)
register("survey_category_coverage", lambda s, d: ad.coverage(fl.signed(grouped(s, d), "pct"), ["category"], "edition"),
         f"SELECT category, count(DISTINCT edition) AS n_waves, string_agg(DISTINCT edition, ', ' ORDER BY edition) AS waves FROM ({GROUPS_SQL}) g WHERE pct > 0 GROUP BY category")
register("survey_latest_top5",
         lambda s, d: ev.in_latest_wave(ranked(s, d).filter(F.col("ranking") <= 5), "edition", grouped(s, d)),
         f"SELECT * FROM ({RANKED}) r WHERE ranking <= 5 AND edition = (SELECT max(edition) FROM ({GROUPS_SQL}) g)")


def survey_executive_summary(s, d):
    last = grouped(s, d).filter(F.col("edition") == "w5")
    return ev.topk_by(last, ["category"], [F.desc("pct"), F.asc("option")], 5).select("category", "ranking", "option", "pct")


register("survey_executive_summary", survey_executive_summary,
         f"SELECT category, ranking, option, pct FROM (SELECT *, CAST(row_number() OVER (PARTITION BY category ORDER BY pct DESC, option) AS INTEGER) AS ranking FROM ({GROUPS_SQL}) g WHERE edition = 'w5') t WHERE ranking <= 5")

# --- checks -----------------------------------------------------------------------------------------



def check_base_status(s, d):
    """Every slice with its status; the counts of one label are off by one, so some fail."""
    n = F.when(F.col("value") == "remote", F.col("n") + 1).otherwise(F.col("n"))
    return ck.base_audit(dist(s, d).withColumn("n", n), ["edition", "variable"])


register("check_base_status", check_base_status,
         f"""SELECT *, CASE WHEN sum_of_parts = stated_base AND n_bases = 1 THEN 'OK' ELSE 'VERIFICAR' END AS status FROM (
         SELECT edition, variable, CAST(sum(n + CASE WHEN value = 'remote' THEN 1 ELSE 0 END) AS BIGINT) AS sum_of_parts, max(base) AS stated_base,
         count(DISTINCT base) AS n_bases FROM ({DIST}) g GROUP BY edition, variable) a""")
register("check_pct_sum", lambda s, d: ck.pct_sum(dist(s, d), ["edition", "variable"]),
         f"SELECT edition, variable, round(sum(pct), 2) AS pct_sum FROM ({DIST}) g GROUP BY edition, variable")
register("check_unmapped_labels",
         lambda s, d: ck.unmapped_labels(R(s, d).withColumn("pos", lb.ordinal(F.col("pay_band"), BANDS[:9])), "pay_band", "pos"),
         f"SELECT pay_band, count(*) AS n FROM responses WHERE {POS} > 9 GROUP BY pay_band")
register("check_label_presence", lambda s, d: ck.label_presence(R(s, d), "work_model", "edition"),
         "SELECT work_model, count(DISTINCT edition) AS n_waves, min(edition) AS first_wave, max(edition) AS last_wave FROM responses WHERE work_model IS NOT NULL GROUP BY work_model")
register("check_unrecognised_labels", lambda s, d: ck.unrecognised(R(s, d), "role", ["1-URGENT", "2-HIGH", "3-medium"]),
         "SELECT role, count(*) AS n FROM responses WHERE role NOT IN ('1-URGENT', '2-HIGH', '3-medium') GROUP BY role")
