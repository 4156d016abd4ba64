"""Sources, sinks, projections, filters, joins, aggregates, windows, sorts and sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wavelens import testviews as tv
from wavelens.functions import labels as lb
from wavelens.functions import text as tx
from wavelens.operators import adoption as ad
from wavelens.operators import checks as ck
from wavelens.operators import distribution as di
from wavelens.operators import evolution as ev
from wavelens.operators import filters as fl
from wavelens.operators import ordinal as od
from wavelens.operators import profile as pr
from wavelens.operators import standardize as st
from wavelens.registry.core import ROUNDED_SHARE, adoption_sql, dist_sql, quantile_sql, register
from wavelens.session import scratch_path, stored
from wavelens.sources import readers, writers

R, FL = tv.responses, tv.flags
BANDS = [f"band_{i}" for i in range(1, 14)]
POS = "CAST(replace(pay_band, 'band_', '') AS INTEGER)"
OPTS = ["opt_click", "opt_view", "opt_purchase", "opt_signup", "opt_error", "opt_refund"]
VALS = ["val_high", "val_low"]


def dist(s: SparkSession, d: str) -> DataFrame:
    return di.distribution(R(s, d), ["role", "segment", "work_model"], ["edition"])


DIST = dist_sql("responses", ["role", "segment", "work_model"], ["edition"])


def adopted(s: SparkSession, d: str) -> DataFrame:
    return ad.adoption(FL(s, d), OPTS, ["edition"], "opt_")


ADOPT = (
    "SELECT edition, option, eligible, selected, pct FROM ("
    + adoption_sql("flags", {"": {c: c[4:] for c in OPTS}}, ["edition"])
    + ") a"
)


def with_position(df: DataFrame) -> DataFrame:
    return df.withColumn("pos", lb.ordinal(F.col("pay_band"), BANDS))


# --- sources ------------------------------------------------------------------------


def scan_raw_csv(s, d):
    path = scratch_path(s, "raw-wave")
    docs = tv.table(s, d, "documents").select("doc_id", "lang", F.col("text").alias("1.a_Texto"))
    (
        docs.write.option("header", True).option("quoteAll", True).option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    )
    wave = readers.read_wave(s, path)
    return wave.select("doc_id", "lang", F.length(tx.lit_col("1.a_Texto")).alias("length"),
                       F.md5(tx.lit_col("1.a_Texto")).alias("digest"))


register("scan_raw_csv", scan_raw_csv,
         "SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, CAST(length(text) AS INTEGER) AS length, "
         "md5(text) AS digest FROM documents")

register("scan_staging",
         lambda s, d: readers.read_staging(s, f"{d}/orders.parquet"), "SELECT * FROM orders")


def scan_gold_typed(s, d):
    path = scratch_path(s, "gold")
    writers.export_csv(dist(s, d), path)
    schema = "edition string, variable string, value string, n bigint, base bigint, pct double"
    return readers.read_gold(s, path, schema)


register("scan_gold_typed", scan_gold_typed, DIST)


def _partitioned(s, d, storage):
    path = scratch_path(s, "waves")
    rows = R(s, d).withColumnRenamed("edition", storage)
    rows.write.partitionBy(storage).parquet(path)
    name = "waves_" + path.rsplit("-", 1)[-1]
    writers.register_table(rows, name, path, [storage])
    return name


register("scan_partitioned",
         lambda s, d: di.count_by(
             readers.read_waves(s, _partitioned(s, d, "edition"), "edition", "edition")
             .filter(F.col("edition") == "1996"), ["edition", "role"]),
         "SELECT edition, role, count(*) AS n FROM responses WHERE edition = '1996' GROUP BY edition, role")

register("rename_partition_dim",
         lambda s, d: di.count_by(
             readers.read_waves(s, _partitioned(s, d, "particao"), "particao", "edicao"), ["edicao"]),
         "SELECT edition AS edicao, count(*) AS n FROM responses GROUP BY edition")


def scan_name_catalog(s, d):
    waves = {"responses": R(s, d), "flags": FL(s, d)}
    nulls = st.union_all_by_name(
        [pr.null_profile(df).withColumn("wave", F.lit(w)) for w, df in waves.items()])
    catalog = readers.name_catalog(s, waves).withColumnRenamed("name", "column")
    return catalog.join(nulls, ["wave", "column"]).select("wave", "position", "column", "nulls")


_CATALOG = [("responses", ["resp_id", "edition", "role", "level", "segment", "region", "work_model", "pay_band"]),
            ("flags", ["user_id", "day", "edition", *OPTS, *VALS])]
register("scan_name_catalog", scan_name_catalog, " UNION ALL ".join(
    f"SELECT '{w}' AS wave, {i} AS position, '{c}' AS \"column\", count(*) - count({c}) AS nulls FROM {w}"
    for w, cols in _CATALOG for i, c in enumerate(cols)))


def scan_dictionary(s, d):
    a, b = tv.question_names(s, d, "A"), tv.question_names(s, d, "B")
    named = b.select("name", F.col("name").alias("name_B"))
    found = F.col("name_B").isNotNull()
    rows = a.join(named, "name", "left").select(
        F.col("name").alias("base"), "name_B",
        F.when(found, "exact").otherwise("no_match").alias("method_B"),
        F.when(found, 1.0).otherwise(0.0).alias("score_B"),
        F.when(found, "high").alias("confidence_B"))
    path = scratch_path(s, "dictionary")
    writers.export_csv(rows, path)
    return readers.read_dictionary(s, path, "A", ["B"])


register("scan_dictionary", scan_dictionary, """
SELECT a.name AS base, b.name AS "name_B", CASE WHEN b.name IS NULL THEN 'no_match' ELSE 'exact' END AS "method_B",
       CAST(CASE WHEN b.name IS NULL THEN 0 ELSE 1 END AS DOUBLE) AS "score_B",
       CASE WHEN b.name IS NOT NULL THEN 'high' END AS "confidence_B", CAST(NULL AS VARCHAR) AS "review_B"
FROM name_catalog a LEFT JOIN (SELECT name FROM name_catalog WHERE wave = 'B') b ON a.name = b.name WHERE a.wave = 'A'""")


# --- sinks --------------------------------------------------------------------------


def sink_roundtrip(s, d):
    path = scratch_path(s, "table")
    writers.write_table(R(s, d), path)
    writers.write_table(R(s, d), path)
    return di.count_by(s.read.parquet(path), ["edition", "level"])


register("sink_roundtrip", sink_roundtrip,
         "SELECT edition, level, count(*) AS n FROM responses GROUP BY edition, level")


def sink_partition_overwrite(s, d):
    """All waves; then one again with fewer rows, and one with none."""
    path = scratch_path(s, "silver")
    rows = R(s, d)
    waves = [r[0] for r in rows.select("edition").distinct().collect()]
    for wave in waves:
        writers.write_wave(rows.filter(F.col("edition") == wave).drop("edition"), path, wave)
    fewer = rows.filter((F.col("edition") == "1996") & (F.col("level") == "F")).drop("edition")
    writers.write_wave(fewer, path, "1996")
    writers.write_wave(rows.filter("false").drop("edition"), path, "1997")
    out = s.read.parquet(path)
    return di.count_by(out.withColumn("edition", F.col("edition").cast("string")), ["edition"])


register("sink_partition_overwrite", sink_partition_overwrite, """
SELECT edition, count(*) AS n FROM responses
WHERE edition NOT IN ('1996', '1997') OR (edition = '1996' AND level = 'F') GROUP BY edition""")


def sink_register_table(s, d):
    path = scratch_path(s, "registered")
    name = "table_" + path.rsplit("-", 1)[-1]
    for rows in (R(s, d).drop("region"), R(s, d)):
        writers.write_table(rows, path)
        writers.register_table(rows, name, path)
    return di.count_by(s.table(name), ["region"])


register("sink_register_table", sink_register_table,
         "SELECT region, count(*) AS n FROM responses GROUP BY region")


def sink_export_csv(s, d):
    path = scratch_path(s, "export")
    writers.export_csv(adopted(s, d), path, ";")
    schema = "edition string, option string, eligible bigint, selected double, pct double"
    return s.read.schema(schema).option("header", True).option("sep", ";").csv(path)


register("sink_export_csv", sink_export_csv, ADOPT)


def sink_export_file(s, d):
    """One file under the asked name, with a byte-order mark in front of the header."""
    path = f"{scratch_path(s, 'export')}/adopted.csv"
    writers.export_file(adopted(s, d), path)
    schema = "edition string, option string, eligible bigint, selected double, pct double"
    return s.read.schema(schema).option("header", True).option("sep", ";").csv(path)


register("sink_export_file", sink_export_file, ADOPT)


def sink_dictionary(s, d):
    """The null dictionary of all responses, written and read again."""
    path = scratch_path(s, "null-dictionary")
    writers.export_csv(pr.null_dictionary(R(s, d), "responses").orderBy("column"), path)
    return s.read.schema("wave string, column string, type string, pct_null double, null_meaning string").option("header", True).csv(path)


register("sink_dictionary", sink_dictionary,
         "SELECT wave, \"column\", CASE WHEN b THEN 'binary_multiselect' ELSE 'single_choice' END AS type, pct_null, "
         "CASE WHEN b THEN 'group_not_shown' WHEN pct_null < 10 THEN 'near_universal' ELSE 'conditional_on_profile' END AS null_meaning "
         f"FROM (SELECT wave, \"column\", b, {ROUNDED_SHARE} AS pct_null FROM (" + " UNION ALL ".join(
             f"SELECT 'responses' AS wave, '{c}' AS \"column\", coalesce(bool_and(CAST({c} AS VARCHAR) IN ('0', '1')), false) AS b, "
             f"count(*) AS total, count(*) - count({c}) AS missing FROM responses"
             for c in ("resp_id", "edition", "role", "level", "segment", "region", "work_model", "pay_band")) + ") u) t")


def scan_required_source(s, d):
    """The one folder that matches a pattern, found and read."""
    path = scratch_path(s, "source")
    writers.export_csv(dist(s, d), f"{path}/only-one")
    found = readers.require_source(s, f"{path}/only-*/*.csv")
    return readers.read_gold(s, found, "edition string, variable string, value string, n bigint, base bigint, pct double")


register("scan_required_source", scan_required_source, DIST)

# --- projections and cleaning ---------------------------------------------------------

register("proj_literal_names",
         lambda s, d: R(s, d).select("resp_id", F.col("role").alias("h2o.ai"), F.col("level").alias("a`b"))
         .select("resp_id", tx.lit_col("h2o.ai"), tx.lit_col("a`b")),
         'SELECT resp_id, role AS "h2o.ai", level AS "a`b" FROM responses')


def clean_mojibake(s, d):
    """Damage whole texts, repair them; and leave texts that are right as they are."""
    docs = tv.table(s, d, "documents")
    damaged = F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")
    return docs.select("doc_id", F.md5(tx.repair_mojibake(damaged)).alias("repaired"),
                       F.md5(tx.repair_mojibake(F.col("text"))).alias("kept"))


register("clean_mojibake", clean_mojibake,
         "SELECT doc_id, md5(text) AS repaired, md5(text) AS kept FROM documents")

register("proj_rename_all",
         lambda s, d: R(s, d).toDF("id", "wave", "job", "grade", "market", "area", "model", "pay"),
         "SELECT resp_id AS id, edition AS wave, role AS job, level AS grade, segment AS market, "
         "region AS area, work_model AS model, pay_band AS pay FROM responses")
register("proj_rename", lambda s, d: dist(s, d).withColumnRenamed("variable", "variavel_original"),
         f"SELECT edition, variable AS variavel_original, value, n, base, pct FROM ({DIST}) g")

_LETTER = "lower(substr(p_type, 1, 1))"
_HEADERS = f"SELECT DISTINCT concat(CAST(p_size AS {{S}}), '.', {_LETTER}, CASE WHEN p_brand = 'Brand#1' THEN '' ELSE concat('.', substr(p_brand, 7)) END, '_', p_name, '/', p_type) AS raw FROM {{part}} UNION ALL SELECT DISTINCT concat(p_name, ' ', p_type) AS raw FROM {{part}}"
_TUPLES = f"SELECT DISTINCT CASE WHEN p_size = 1 THEN concat('(''P1_', {_LETTER}, ' '', ''Malformed))') ELSE concat('(''P', CAST(p_size AS {{S}}), '_', {_LETTER}, ' '', ''', p_name, ''')') END AS raw FROM {{part}}"


def parse_question_code(s, d):
    q = tx.parse_question(F.col("raw"))
    return tv.view(s, d, _HEADERS).select("raw", q["code"].alias("code"), q["label"].alias("label"))


register("parse_question_code", parse_question_code, f"""
WITH h AS ({tv.duck(_HEADERS)})
SELECT raw, nullif(regexp_extract(raw, '{tx.DOTTED_HEADER}', 1), '') AS code,
  CASE WHEN regexp_matches(raw, '{tx.DOTTED_HEADER}') THEN regexp_extract(raw, '{tx.DOTTED_HEADER}', 2) ELSE raw END AS label
FROM h""")

_TUPLE_FIXES = {f"('P1_{c} ', 'Malformed))": (f"P1_{c}", "Malformed (MF)") for c in "eplms"}


def parse_question_tuple(s, d):
    q = tx.parse_question(F.col("raw"), "tuple", _TUPLE_FIXES)
    return tv.view(s, d, _TUPLES).select("raw", q["code"].alias("code"), q["label"].alias("label"))


_TUPLE_SQL = tx.TUPLE_HEADER.replace("'", "''")
register("parse_question_tuple", parse_question_tuple, f"""
WITH h AS ({tv.duck(_TUPLES)})
SELECT raw, CASE WHEN raw LIKE '%Malformed%' THEN concat('P1.', substr(raw, 6, 1))
   ELSE replace(trim(regexp_extract(raw, '{_TUPLE_SQL}', 1)), '_', '.') END AS code,
  CASE WHEN raw LIKE '%Malformed%' THEN 'Malformed (MF)' ELSE trim(regexp_extract(raw, '{_TUPLE_SQL}', 2)) END AS label
FROM h""")

register("clean_normalize_name",
         lambda s, d: tv.table(s, d, "documents").select(
             "doc_id", F.md5(tx.normalize_name(F.col("text"))).alias("name")),
         r"""SELECT doc_id, md5(trim(regexp_replace(regexp_replace(lower(strip_accents(replace(text, '/', '_'))),
         '[,?().]', '', 'g'), '[\s_]+', '_', 'g'), '_')) AS name FROM documents""")

_FIXES = {"blue bolt": "azure bolt", "red widget": "crimson widget"}
register("clean_name_fixes",
         lambda s, d: tv.table(s, d, "part").select(
             "p_partkey", tx.normalize_name(lb.relabel(F.col("p_name"), _FIXES)).alias("label")),
         """SELECT p_partkey, replace(CASE p_name WHEN 'blue bolt' THEN 'azure bolt' WHEN 'red widget' THEN 'crimson widget'
         ELSE p_name END, ' ', '_') AS label FROM part""")
register("clean_alias_coalesce",
         lambda s, d: st.merge_alias(FL(s, d), {"click": ["opt_refund", "val_high", "opt_click"]})
         .select("user_id", "edition", F.col("day").cast("string").alias("day"), "click"),
         "SELECT user_id, edition, CAST(day AS VARCHAR) AS day, coalesce(opt_refund, val_high, opt_click) AS click FROM flags")

_CANON = {"papel": "role", "nivel": "level", "faixa": "pay_band", "ausente": "no_such_column"}
register("harmonize_conform",
         lambda s, d: st.conform(R(s, d), _CANON, ["faixa", "nivel", "papel", "ausente", "nova"]),
         "SELECT pay_band AS faixa, level AS nivel, role AS papel, CAST(NULL AS VARCHAR) AS ausente, "
         "CAST(NULL AS VARCHAR) AS nova FROM responses")
register("proj_row_id",
         lambda s, d: st.with_row_id(R(s, d)).groupBy("edition", "role", "level").agg(
             F.count(F.lit(1)).alias("rows"), F.countDistinct("source_row").alias("ids"), F.sum("resp_id").alias("total")),
         "SELECT edition, role, level, count(*) AS rows, count(DISTINCT resp_id) AS ids, CAST(sum(resp_id) AS BIGINT) AS total "
         "FROM responses GROUP BY edition, role, level")
register("proj_tag_literal",
         lambda s, d: adopted(s, d).withColumn("category", F.lit("options")),
         f"SELECT *, 'options' AS category FROM ({ADOPT}) a")

_MERGE = {"top": ["1-URGENT", "2-HIGH"]}
register("clean_taxonomy_remap",
         lambda s, d: R(s, d).select("resp_id", lb.remap(F.col("role"), _MERGE).alias("role_merged")),
         "SELECT resp_id, CASE WHEN role IN ('1-URGENT', '2-HIGH') THEN 'top' ELSE role END AS role_merged FROM responses")
_NAMES = {"F": "Finished", "O": "Open"}
register("clean_relabel",
         lambda s, d: R(s, d).select("resp_id", lb.relabel(F.col("level"), _NAMES).alias("level_name")),
         "SELECT resp_id, CASE level WHEN 'F' THEN 'Finished' WHEN 'O' THEN 'Open' ELSE level END AS level_name FROM responses")
_RULES = [("contains", "URG", "now"), ("startswith", "2", "soon"), ("contains", "-", "later")]
register("clean_classify_text",
         lambda s, d: R(s, d).select("resp_id", lb.classify_text(F.col("role"), _RULES).alias("urgency")),
         "SELECT resp_id, CASE WHEN role LIKE '%URG%' THEN 'now' WHEN role LIKE '2%' THEN 'soon' "
         "WHEN role LIKE '%-%' THEN 'later' ELSE role END AS urgency FROM responses")
register("ordinal_encode",
         lambda s, d: R(s, d).select(
             "resp_id", lb.ordinal(F.col("pay_band"), BANDS, "error").alias("pos"),
             lb.ordinal(F.col("level"), ["F", "O"]).alias("level_or_null"),
             lb.ordinal(F.col("level"), ["F", "O"], 99).alias("level_or_99")),
         f"SELECT resp_id, {POS} AS pos, CASE level WHEN 'F' THEN 1 WHEN 'O' THEN 2 END AS level_or_null, "
         "CASE level WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 99 END AS level_or_99 FROM responses")
register("ordinal_decode",
         lambda s, d: with_position(R(s, d)).select(
             "resp_id", lb.ordinal_label(F.col("pos") + 1, BANDS).alias("next_band")),
         f"SELECT resp_id, CASE WHEN {POS} < 13 THEN concat('band_', CAST({POS} + 1 AS VARCHAR)) END AS next_band FROM responses")
register("clean_binary_regroup",
         lambda s, d: R(s, d).select(
             "resp_id", lb.binary_regroup(F.col("work_model"), "remote", "remote", "with site").alias("model")),
         "SELECT resp_id, CASE WHEN work_model = 'remote' THEN 'remote' ELSE 'with site' END AS model FROM responses")
register("flag_small_base",
         lambda s, d: di.count_by(R(s, d), ["edition", "region", "role"]).withColumn(
             "sample", lb.small_base_flag(F.col("n"), 90)),
         "SELECT edition, region, role, count(*) AS n, CASE WHEN count(*) < 90 THEN 'Amostra pequena (<90)' ELSE 'OK' END AS sample "
         "FROM responses GROUP BY edition, region, role")
register("adoption_complement",
         lambda s, d: ad.complement(adopted(s, d).filter(F.col("option") == "error")),
         f"SELECT edition, option, eligible, CAST(selected AS INTEGER) AS non_users, CAST(eligible - selected AS INTEGER) AS users, "
         f"round(100 - pct, 1) AS pct_users FROM ({ADOPT}) a WHERE option = 'error'")
register("proj_composite_key",
         lambda s, d: R(s, d).select("resp_id", F.concat_ws(" | ", "role", "level").alias("profile")),
         "SELECT resp_id, concat_ws(' | ', role, level) AS profile FROM responses")

# --- filters --------------------------------------------------------------------------

register("filter_eq", lambda s, d: dist(s, d).filter(F.col("variable") == "segment"),
         f"SELECT * FROM ({DIST}) g WHERE variable = 'segment'")
register("filter_isin",
         lambda s, d: R(s, d).filter(F.col("segment").isin("BUILDING", "FURNITURE") & ~F.col("role").isin("5-LOW"))
         .select("resp_id", "segment", "role"),
         "SELECT resp_id, segment, role FROM responses WHERE segment IN ('BUILDING', 'FURNITURE') AND role NOT IN ('5-LOW')")
register("filter_notnull", lambda s, d: fl.not_null(R(s, d), ["level", "pay_band"]).select("resp_id", "level", "pay_band"),
         "SELECT resp_id, level, pay_band FROM responses WHERE level IS NOT NULL AND pay_band IS NOT NULL")
register("filter_exclude_keep_null",
         lambda s, d: fl.exclude_label(R(s, d), "level", ["F"]).select("resp_id", "level"),
         "SELECT resp_id, level FROM responses WHERE level <> 'F' OR level IS NULL")
register("filter_exclude_drop_null",
         lambda s, d: fl.exclude_label(R(s, d), "level", ["F"], keep_null=False).select("resp_id", "level"),
         "SELECT resp_id, level FROM responses WHERE level <> 'F'")
register("filter_min_base",
         lambda s, d: fl.min_base(di.count_by(R(s, d), ["edition", "region", "role"]), "n", 90, "role", ["5-LOW"]),
         "SELECT edition, region, role, count(*) AS n FROM responses WHERE role <> '5-LOW' GROUP BY edition, region, role HAVING count(*) >= 90")


def filter_discarded_slices(s, d):
    counts = di.count_by(R(s, d), ["edition", "region", "role"])
    kept, discarded = fl.split_by_base(counts, "n", 80)
    return st.union_all_by_name(
        [kept.withColumn("part", F.lit("kept")), discarded.withColumn("part", F.lit("discarded"))])


register("filter_discarded_slices", filter_discarded_slices,
         "SELECT edition, region, role, count(*) AS n, CASE WHEN count(*) > 80 THEN 'kept' ELSE 'discarded' END AS part "
         "FROM responses GROUP BY edition, region, role")
register("check_pct_out_of_range",
         lambda s, d: ck.pct_out_of_range(dist(s, d), ["edition", "variable"], low=100.0, high=100.0),
         f"SELECT * FROM (SELECT edition, variable, round(sum(pct), 2) AS pct_sum FROM ({DIST}) g GROUP BY edition, variable) t "
         "WHERE pct_sum < 100 OR pct_sum > 100")
register("filter_eligible",
         lambda s, d: di.count_by(fl.eligible(FL(s, d), OPTS), ["edition"]),
         f"SELECT edition, count(*) AS n FROM flags WHERE coalesce({', '.join(OPTS)}) IS NOT NULL GROUP BY edition")
register("filter_positive", lambda s, d: fl.signed(adopted(s, d), "pct"),
         f"SELECT * FROM ({ADOPT}) a WHERE pct > 0")

_BANDS_BY_ROLE = quantile_sql("responses", ["edition", "role"], POS)


def bands_by_role(s, d):
    return od.ordinal_quantiles(with_position(R(s, d)), ["edition", "role"], "pos", 13)


register("filter_any_change",
         lambda s, d: fl.any_nonzero(
             od.band_change(bands_by_role(s, d), ["role"], "edition", "1995", "2001", ["p50", "p75"]),
             ["p50_change", "p75_change"]),
         f"WITH b AS ({_BANDS_BY_ROLE}) SELECT x.role, y.p50 - x.p50 AS p50_change, y.p75 - x.p75 AS p75_change FROM b x JOIN b y ON x.role = y.role "
         "WHERE x.edition = '1995' AND y.edition = '2001' AND (y.p50 <> x.p50 OR y.p75 <> x.p75)")

# --- joins ----------------------------------------------------------------------------

register("join_inner_base",
         lambda s, d: di.join_base(di.count_by(R(s, d), ["edition", "level", "pay_band"]), ["edition", "level"]),
         """WITH c AS (SELECT edition, level, pay_band, count(*) AS n FROM responses GROUP BY edition, level, pay_band),
         t AS (SELECT edition, level, CAST(sum(n) AS BIGINT) AS base FROM c GROUP BY edition, level)
         SELECT c.edition, c.level, c.pay_band, c.n, t.base, round(CAST(c.n AS DOUBLE) / t.base * 100, 1) AS pct
         FROM c JOIN t ON c.edition = t.edition AND c.level = t.level""")
_ROLE_COUNTS = "SELECT edition, role, region, count(*) AS n FROM responses GROUP BY edition, role, region"


def role_counts(s, d):
    return di.count_by(R(s, d), ["edition", "role", "region"])


register("join_semi_whitelist",
         lambda s, d: ev.keep_keys(
             role_counts(s, d), ev.comparable(role_counts(s, d), ["role", "region"], "edition", 7, "n", 50),
             ["role", "region"]),
         f"WITH c AS ({_ROLE_COUNTS}) SELECT * FROM c WHERE (role, region) IN (SELECT (role, region) FROM c GROUP BY role, region "
         "HAVING count(DISTINCT edition) = 7 AND min(n) >= 50)")
register("join_left_totals",
         lambda s, d: di.attach_totals(
             di.count_by(R(s, d), ["edition", "work_model"]),
             di.count_by(fl.not_null(R(s, d), ["work_model"]), ["edition"], "total"), ["edition"]),
         """SELECT c.edition, c.work_model, c.n, t.total FROM (SELECT edition, work_model, count(*) AS n FROM responses GROUP BY edition, work_model) c
         LEFT JOIN (SELECT edition, count(*) AS total FROM responses WHERE work_model IS NOT NULL GROUP BY edition) t ON c.edition = t.edition""")


def join_left_chain(s, d):
    rows = ev.first_last(fl.signed(adopted(s, d), "pct"), ["option"], "edition", "pct")
    keys = adopted(s, d).select("option").distinct()
    first = rows.select("option", "first_wave", "first_value")
    return ev.attach_first_last(keys, first, rows.select("option", "last_wave", "last_value"), ["option"])


_FIRST_LAST = """SELECT option, min(edition) AS first_wave, max(edition) AS last_wave, arg_min(pct, edition) AS first_value,
 arg_max(pct, edition) AS last_value FROM a WHERE pct > 0 GROUP BY option"""
register("join_left_chain", join_left_chain,
         f"WITH a AS ({ADOPT}), f AS ({_FIRST_LAST}) SELECT k.option, first_wave, first_value, last_wave, last_value "
         "FROM (SELECT DISTINCT option FROM a) k LEFT JOIN f ON k.option = f.option")
register("join_inner_multi_key",
         lambda s, d: od.join_quantiles(
             bands_by_role(s, d).select("edition", "role", "total", "p50"),
             bands_by_role(s, d).select("edition", "role", "total", "p75"), ["edition", "role", "total"]),
         _BANDS_BY_ROLE)
register("join_self_waves",
         lambda s, d: ev.compare_waves(stored(bands_by_role(s, d), "bands"), ["role"], "edition", ["p50", "p75"], "1996", "2000"),
         f"WITH b AS ({_BANDS_BY_ROLE}) SELECT x.role, x.p50 AS p50_first, x.p75 AS p75_first, y.p50 AS p50_last, y.p75 AS p75_last "
         "FROM b x JOIN b y ON x.role = y.role WHERE x.edition = '1996' AND y.edition = '2000'")

# --- aggregates -----------------------------------------------------------------------

register("agg_count", lambda s, d: di.count_by(R(s, d), ["edition", "level"]),
         "SELECT edition, level, count(*) AS n FROM responses GROUP BY edition, level")
register("agg_resum",
         lambda s, d: di.resum(role_counts(s, d).withColumn("role", lb.remap(F.col("role"), _MERGE)), ["edition", "role"]),
         "SELECT edition, CASE WHEN role IN ('1-URGENT', '2-HIGH') THEN 'top' ELSE role END AS role, count(*) AS n FROM responses GROUP BY 1, 2")
register("agg_count_distinct",
         lambda s, d: R(s, d).groupBy("role").agg(F.countDistinct("edition").alias("n_waves"), F.countDistinct("work_model").alias("n_models")),
         "SELECT role, count(DISTINCT edition) AS n_waves, count(DISTINCT work_model) AS n_models FROM responses GROUP BY role")
register("agg_min_max",
         lambda s, d: role_counts(s, d).groupBy("role", "region").agg(F.min("n").alias("smallest"), F.max("n").alias("largest")),
         f"SELECT role, region, min(n) AS smallest, max(n) AS largest FROM ({_ROLE_COUNTS}) c GROUP BY role, region")
register("agg_global_share",
         lambda s, d: di.sum_shares(
             dist(s, d).filter((F.col("edition") == "2000") & (F.col("variable") == "role"))
             .orderBy(F.desc("pct"), "value").limit(3), []),
         f"SELECT round(sum(pct), 2) AS pct FROM (SELECT pct FROM ({DIST}) g WHERE edition = '2000' AND variable = 'role' ORDER BY pct DESC, value LIMIT 3) t")
register("agg_sum_shares",
         lambda s, d: di.sum_shares(
             dist(s, d).filter(F.col("variable") == "role").withColumn("merged", lb.remap(F.col("value"), _MERGE)), ["edition", "merged"]),
         f"SELECT edition, CASE WHEN value IN ('1-URGENT', '2-HIGH') THEN 'top' ELSE value END AS merged, round(sum(pct), 2) AS pct FROM ({DIST}) g WHERE variable = 'role' GROUP BY 1, 2")


def agg_topbox_share(s, d):
    rows = dist(s, d).filter(F.col("variable") == "role")
    place = lb.ordinal(F.col("value"), ["1-URGENT", "2-HIGH", "3-MEDIUM"], 5)
    return di.topbox_share(rows.withColumn("pos", place), ["edition"], "pos", [1, 2])


register("agg_topbox_share", agg_topbox_share,
         f"SELECT edition, top, base, round(CAST(top AS DOUBLE) / base * 100, 1) AS pct FROM (SELECT edition, CAST(sum(CASE WHEN value IN ('1-URGENT', '2-HIGH') THEN n ELSE 0 END) AS BIGINT) AS top, "
         f"max(base) AS base FROM ({DIST}) g WHERE variable = 'role' GROUP BY edition) t")
register("agg_ordinal_quantile",
         lambda s, d: od.ordinal_quantiles(with_position(R(s, d)), ["region"], "pos", 13),
         quantile_sql("responses", ["region"], POS))

YEARS = ["1995", "1998", "2001"]


def _pivot(years):
    return ", ".join(f"max(CASE WHEN edition = '{y}' THEN pct END) AS \"{y}\"" for y in years)


register("agg_pivot_explicit",
         lambda s, d: ev.pivot_waves(dist(s, d), ["variable", "value"], "edition", "pct", YEARS),
         f"SELECT variable, value, {_pivot(YEARS)} FROM ({DIST}) g GROUP BY variable, value")
_ALL_YEARS = [str(y) for y in range(1995, 2002)]
register("agg_pivot_discovered",
         lambda s, d: ev.pivot_waves(dist(s, d), ["variable", "value"], "edition", "pct"),
         f"SELECT variable, value, {_pivot(_ALL_YEARS)} FROM ({DIST}) g GROUP BY variable, value")
register("agg_pivot_global",
         lambda s, d: ev.evolution(dist(s, d).filter(F.col("value") == "remote"), [], "edition", "pct", ["1996", "2001"]),
         f"SELECT *, round(\"2001\" - \"1996\", 1) AS variation FROM (SELECT {_pivot(['1996', '2001'])} FROM ({DIST}) g WHERE value = 'remote') t")
register("agg_manual_pivot",
         lambda s, d: ev.evolution(dist(s, d), ["variable", "value"], "edition", "pct", ["1995", "2001"], 1, "variation_pp"),
         f"SELECT *, round(\"2001\" - \"1995\", 1) AS variation_pp FROM (SELECT variable, value, {_pivot(['1995', '2001'])} FROM ({DIST}) g "
         "WHERE edition IN ('1995', '2001') GROUP BY variable, value) t")
register("agg_sorted_set_text", lambda s, d: ad.coverage(fl.not_null(R(s, d), ["work_model"]), ["work_model"], "edition"),
         "SELECT work_model, count(DISTINCT edition) AS n_waves, string_agg(DISTINCT edition, ', ' ORDER BY edition) AS waves "
         "FROM responses WHERE work_model IS NOT NULL GROUP BY work_model")
register("profile_domain", lambda s, d: pr.binary_columns(FL(s, d), [*OPTS, *VALS, "edition"]),
         " UNION ALL ".join(f"SELECT '{c}' AS \"column\", coalesce(bool_and({c} IN ('0', '1')), false) AS \"binary\" FROM flags" for c in [*OPTS, *VALS, "edition"]))
_COLS = _CATALOG[0][1]
register("profile_nulls", lambda s, d: pr.null_profile(R(s, d)),
         " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) AS rows, count(*) - count({c}) AS nulls FROM responses" for c in _COLS))
register("profile_distinct", lambda s, d: pr.distinct_profile(R(s, d)),
         " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS distinct_values FROM responses" for c in _COLS))
register("profile_frequencies", lambda s, d: pr.frequency_profile(R(s, d), _COLS[1:]),
         " UNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, count(*) AS n FROM responses GROUP BY {c}" for c in _COLS[1:]))
register("profile_duplicates",
         lambda s, d: pr.duplicate_count(R(s, d).select("edition", "role", "level", "region", "pay_band")),
         "SELECT CAST(sum(n) AS BIGINT) AS rows, count(*) AS distinct_rows, CAST(sum(n) - count(*) AS BIGINT) AS duplicates "
         "FROM (SELECT count(*) AS n FROM responses GROUP BY edition, role, level, region, pay_band) t")
register("agg_latest_wave", lambda s, d: ev.in_latest_wave(stored(dist(s, d), "distribution"), "edition"),
         f"WITH g AS ({DIST}) SELECT * FROM g WHERE edition = (SELECT max(edition) FROM g)")
MODELS = ["hybrid", "onsite", "remote"]
register("agg_matrix_avg",
         lambda s, d: di.matrix_avg(with_position(R(s, d)), "level", "work_model", MODELS, "pos")
         .select("level", *[F.round(m, 6).alias(m) for m in MODELS]),
         "SELECT level, " + ", ".join(f"round(avg(CASE WHEN work_model = '{m}' THEN {POS} END), 6) AS {m}" for m in MODELS) + " FROM responses GROUP BY level")
register("check_base_audit", lambda s, d: ck.base_audit(dist(s, d), ["edition"]),
         f"""SELECT *, CASE WHEN sum_of_parts = stated_base AND n_bases = 1 THEN 'OK' ELSE 'VERIFICAR' END AS status FROM (
         SELECT edition, CAST(sum(n) AS BIGINT) AS sum_of_parts, max(base) AS stated_base, count(DISTINCT base) AS n_bases FROM ({DIST}) g GROUP BY edition) t""")
_ROWS = ["5-LOW", "1-URGENT", "9-ABSENT"]
register("agg_complete_grid",
         lambda s, d: di.complete_grid(dist(s, d).filter(F.col("variable") == "role"), "value", _ROWS, "edition", ["2001", "1995", "1900"], "pct", 0.0),
         f"""SELECT r.position, r.value, coalesce(max(CASE WHEN edition = '2001' THEN pct END), 0) AS "2001",
         coalesce(max(CASE WHEN edition = '1995' THEN pct END), 0) AS "1995", CAST(0 AS DOUBLE) AS "1900"
         FROM (VALUES (1, '5-LOW'), (2, '1-URGENT'), (3, '9-ABSENT')) r(position, value)
         LEFT JOIN (SELECT * FROM ({DIST}) g WHERE variable = 'role') g ON g.value = r.value GROUP BY r.position, r.value""")

# --- windows --------------------------------------------------------------------------

register("win_partition_share",
         lambda s, d: di.with_share(di.count_by(R(s, d), ["edition", "level"]), ["edition"], scale=2),
         "SELECT edition, level, n, CAST(sum(n) OVER (PARTITION BY edition) AS BIGINT) AS base, round(CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY edition) * 100, 2) AS pct "
         "FROM (SELECT edition, level, count(*) AS n FROM responses GROUP BY edition, level) c")


def band_counts(s, d):
    rows = fl.not_null(with_position(R(s, d)), ["pos"])
    return di.count_by(rows, ["edition", "region", "pos"])


_RUNNING = f"""SELECT edition, region, pos, n, CAST(sum(n) OVER (PARTITION BY edition, region) AS BIGINT) AS total,
 CAST(sum(n) OVER (PARTITION BY edition, region ORDER BY pos ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cumulated,
 round(CAST(sum(n) OVER (PARTITION BY edition, region ORDER BY pos ROWS UNBOUNDED PRECEDING) AS DOUBLE) / sum(n) OVER (PARTITION BY edition, region) * 100, 2) AS pct_cumulated
 FROM (SELECT edition, region, {POS} AS pos, count(*) AS n FROM responses WHERE pay_band IS NOT NULL GROUP BY 1, 2, 3) c"""
register("win_running_share", lambda s, d: od.running_share(band_counts(s, d), ["edition", "region"], "pos"), _RUNNING)
register("win_topk",
         lambda s, d: ev.topk_by(dist(s, d), ["edition", "variable"], [F.desc("pct"), F.asc("value")], 2),
         f"SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY edition, variable ORDER BY pct DESC, value) AS INTEGER) AS ranking FROM ({DIST}) g) t WHERE ranking <= 2")
register("win_dense_rank",
         lambda s, d: od.rank_by(
             od.ordinal_quantiles(with_position(R(s, d)), ["level", "role"], "pos", 13), ["level"], ["p50", "p75"]),
         f"SELECT *, CAST(dense_rank() OVER (PARTITION BY level ORDER BY p50 DESC, p75 DESC) AS INTEGER) AS ranking FROM ({quantile_sql('responses', ['level', 'role'], POS)}) b")
register("win_dense_rank_wave", lambda s, d: od.rank_by(bands_by_role(s, d), ["edition"], ["p50", "p75"]),
         f"SELECT *, CAST(dense_rank() OVER (PARTITION BY edition ORDER BY p50 DESC, p75 DESC) AS INTEGER) AS ranking FROM ({_BANDS_BY_ROLE}) b")
register("win_first_at_threshold",
         lambda s, d: od.first_at(od.running_share(band_counts(s, d), ["edition", "region"], "pos"),
                                  ["edition", "region"], "pos", "pct_cumulated", 75),
         f"SELECT edition, region, pos FROM (SELECT *, row_number() OVER (PARTITION BY edition, region ORDER BY pos) AS rn FROM ({_RUNNING}) r WHERE pct_cumulated >= 75) t WHERE rn = 1")
register("win_first_last", lambda s, d: ev.first_last(fl.signed(adopted(s, d), "pct"), ["option"], "edition", "pct"),
         f"WITH a AS ({ADOPT}) {_FIRST_LAST}")
_EVOLVED = """SELECT option, min(edition) AS first_wave, max(edition) AS last_wave, count(DISTINCT edition) AS n_waves, arg_min(pct, edition) AS first_value,
 arg_max(pct, edition) AS last_value, round(arg_max(pct, edition) - arg_min(pct, edition), 1) AS variation FROM a WHERE pct > 0 GROUP BY option HAVING count(DISTINCT edition) >= 2"""


def evolved(s, d):
    return ev.evolution_available(fl.signed(adopted(s, d), "pct"), ["option"], "edition", "pct")


def win_movers(s, d):
    rows = evolved(s, d).withColumn("category", F.lit("opt"))
    return st.union_all_by_name([
        ev.movers(rows, ["category"], "option", k=2).withColumn("direction", F.lit("up")),
        ev.movers(rows, ["category"], "option", k=2, rising=False).withColumn("direction", F.lit("down"))])


register("win_movers", win_movers,
         f"""WITH a AS ({ADOPT}), e AS ({_EVOLVED}) SELECT *, 'opt' AS category FROM (
         SELECT *, CAST(row_number() OVER (ORDER BY variation DESC, option) AS INTEGER) AS ranking, 'up' AS direction FROM e WHERE variation > 0
         UNION ALL SELECT *, CAST(row_number() OVER (ORDER BY variation, option) AS INTEGER) AS ranking, 'down' AS direction FROM e WHERE variation < 0) t WHERE ranking <= 2""")
register("win_leaders", lambda s, d: od.leaders(od.rank_by(bands_by_role(s, d), ["edition"], ["p50", "p75"])),
         f"SELECT * FROM (SELECT *, CAST(dense_rank() OVER (PARTITION BY edition ORDER BY p50 DESC, p75 DESC) AS INTEGER) AS ranking FROM ({_BANDS_BY_ROLE}) b) t WHERE ranking = 1")

# --- sorts and limits -------------------------------------------------------------------

register("sort_multi", lambda s, d: role_counts(s, d).orderBy("edition", F.desc("n"), "role", "region"),
         f"SELECT * FROM ({_ROLE_COUNTS}) c ORDER BY edition, n DESC, role, region")


def sort_by_ordinal(s, d):
    place = lb.ordinal(F.col("level"), ["P", "F"], 99)
    return di.count_by(R(s, d), ["edition", "level"]).withColumn("_p", place).orderBy("edition", "_p", "level").drop("_p")


register("sort_by_ordinal", sort_by_ordinal,
         "SELECT edition, level, count(*) AS n FROM responses GROUP BY edition, level ORDER BY edition, CASE level WHEN 'P' THEN 1 WHEN 'F' THEN 2 ELSE 99 END, level")
register("topk_global", lambda s, d: role_counts(s, d).orderBy(F.desc("n"), "edition", "role", "region").limit(5),
         f"SELECT * FROM ({_ROLE_COUNTS}) c ORDER BY n DESC, edition, role, region LIMIT 5")
register("topk_history",
         lambda s, d: ev.topk_history(
             stored(dist(s, d), "distribution").filter(F.col("variable") == "role"), "value", "pct", "edition", "2001", 3),
         f"WITH g AS ({DIST}) SELECT * FROM g WHERE variable = 'role' AND value IN (SELECT value FROM g WHERE variable = 'role' AND edition = '2001' ORDER BY pct DESC, value LIMIT 3)")

# --- sets -------------------------------------------------------------------------------

register("union_by_name",
         lambda s, d: st.union_all_by_name([R(s, d).select("resp_id", "role"), R(s, d).select("level", "resp_id")]),
         "SELECT resp_id, role, CAST(NULL AS VARCHAR) AS level FROM responses UNION ALL SELECT resp_id, NULL, level FROM responses")
register("union_waves",
         lambda s, d: di.count_by(st.union_waves(
             {"first": R(s, d).filter(F.col("edition") < "1998").drop("edition", "region"),
              "second": R(s, d).filter(F.col("edition") >= "1998").drop("edition", "work_model")}), ["edition", "region", "work_model"]),
         """SELECT edition, region, work_model, count(*) AS n FROM (
         SELECT 'first' AS edition, NULL AS region, work_model FROM responses WHERE edition < '1998'
         UNION ALL SELECT 'second', region, NULL FROM responses WHERE edition >= '1998') u GROUP BY edition, region, work_model""")
register("set_distinct", lambda s, d: R(s, d).select("edition", "work_model").distinct(),
         "SELECT DISTINCT edition, work_model FROM responses")
register("set_drop_duplicates", lambda s, d: R(s, d).select("role", "level", "region").dropDuplicates(),
         "SELECT DISTINCT role, level, region FROM responses")

# --- scalars ----------------------------------------------------------------------------

register("scalar_round_share",
         lambda s, d: role_counts(s, d).select(
             "edition", "role", "region", lb.share(F.col("n"), F.lit(977), 0).alias("p0"),
             lb.share(F.col("n"), F.lit(977), 1).alias("p1"), lb.share(F.col("n"), F.lit(977), 2).alias("p2")),
         "SELECT edition, role, region, " + ", ".join(f"round(CAST(n AS DOUBLE) / 977 * 100, {k}) AS p{k}" for k in range(3)) + f" FROM ({_ROLE_COUNTS}) c")
register("scalar_string",
         lambda s, d: tv.table(s, d, "documents").select(
             "doc_id", F.col("text").contains("the").alias("has_the"), F.col("text").startswith("É").alias("starts"),
             F.md5(F.lower(tx.strip_accents(F.col("text")))).alias("plain"), F.concat_ws("-", "lang", "source").alias("origin")),
         "SELECT doc_id, contains(text, 'the') AS has_the, starts_with(text, 'É') AS starts, md5(lower(strip_accents(text))) AS plain, "
         "concat_ws('-', lang, source) AS origin FROM documents")
register("scalar_null",
         lambda s, d: R(s, d).select("resp_id", F.coalesce("level", "work_model", F.lit("none")).alias("first_known"),
                                     F.col("pay_band").isNull().alias("unpaid"), F.lit(None).cast("string").alias("empty")),
         "SELECT resp_id, coalesce(level, work_model, 'none') AS first_known, pay_band IS NULL AS unpaid, CAST(NULL AS VARCHAR) AS empty FROM responses")
