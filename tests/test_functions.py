import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from wavelens.functions import labels as lb
from wavelens.operators.profile import null_dictionary, round_binary
from wavelens.functions import text as tx


def texts(spark, values):
    return spark.createDataFrame([(i, x) for i, x in enumerate(values)], "i int, x string")


def apply(spark, values, make):
    return [r[0] for r in texts(spark, values).select("i", make(F.col("x")).alias("y")).orderBy("i").select("y").collect()]


def damage(text):
    return text.encode("utf-8").decode("latin-1")


def test_mojibake_is_repaired_and_right_text_kept(spark):
    right = ["não", "Sênior", "plain", "", None, "preço: 5 €", "日本", "linha\nquebrada ção", "ÿ", "Ã", "naïve café"]
    assert apply(spark, right, tx.repair_mojibake) == right
    assert apply(spark, [damage("não"), damage("日本\nçé")], tx.repair_mojibake) == ["não", "日本\nçé"]


def test_mojibake_overlong_and_surrogate_bytes_are_no_utf8(spark):
    kept = ["À\x80", "í\xa0\x80", "ÿþ"]
    assert apply(spark, kept, tx.repair_mojibake) == kept


def test_parse_dotted_header(spark):
    headers = ["2.l.1_Remuneração/Salário", " 1.a Idade ", "sem código", "2.l__Critérios", "10_x"]
    parsed = apply(spark, headers, lambda c: tx.parse_question(c))
    assert [tuple(p) for p in parsed] == [
        ("2.l.1", "Remuneração/Salário"), ("1.a", "Idade"), (None, "sem código"), ("2.l", "Critérios"), ("10", "x"),
    ]


def test_parse_tuple_header_with_fixes(spark):
    bad = "('P6_b_16 ', 'Integration (X))"
    headers = ["('P1_a ', 'Idade')", bad, "outra coisa"]
    parsed = apply(spark, headers, lambda c: tx.parse_question(c, "tuple", {bad: ("P6_b_16", "Integration (X)")}))
    assert [tuple(p) for p in parsed] == [("P1.a", "Idade"), ("P6.b.16", "Integration (X)"), (None, "outra coisa")]


def test_unknown_header_style(spark):
    with pytest.raises(ValueError):
        tx.parse_question(F.col("x"), "other")


def test_strip_accents_follows_unicode_decomposition(spark):
    sample = "".join(chr(c) for c in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00))) + "éª½ﬁ"
    expected = "".join(c for c in unicodedata.normalize("NFKD", sample[:-1]) if not unicodedata.combining(c))
    assert apply(spark, [sample[:-1]], tx.strip_accents) == [expected]


@pytest.mark.parametrize(
    "raw, name",
    [
        ("Faixa/Idade (anos)", "faixa_idade_anos"),
        ("  Você usa h2o.ai?  ", "voce_usa_h2oai"),
        ("a__b / c", "a_b_c"),
        ("_x_", "x"),
        ("Até\tR$ 1.000,00", "ate_r$_100000"),
    ],
)
def test_normalize_name(spark, raw, name):
    assert apply(spark, [raw], tx.normalize_name) == [name]


def test_lit_col_reads_odd_names(spark):
    df = spark.createDataFrame([(1, 2)], ["h2o.ai", "a`b"])
    assert tuple(df.select(tx.lit_col("h2o.ai"), tx.lit_col("a`b")).first()) == (1, 2)


def test_relabel_remap_and_regroup(spark):
    assert apply(spark, ["a", "b", "c", None], lambda c: lb.relabel(c, {"a": "A"})) == ["A", "b", "c", None]
    assert apply(spark, ["a", "b", "c", None], lambda c: lb.remap(c, {"ab": ["a", "b"]})) == ["ab", "ab", "c", None]
    assert apply(spark, ["a", "b", None], lambda c: lb.binary_regroup(c, "a", "yes", "no")) == ["yes", "no", "no"]


def test_first_matching_text_rule_wins(spark):
    rules = [("contains", "x", "1"), ("startswith", "a", "2")]
    assert apply(spark, ["ax", "ab", "b", None], lambda c: lb.classify_text(c, rules)) == ["1", "2", "b", None]


def test_ordinal_and_back(spark):
    scale = ["low", "mid", "high"]
    values = ["mid", "odd", None]
    assert apply(spark, values, lambda c: lb.ordinal(c, scale)) == [2, None, None]
    assert apply(spark, values, lambda c: lb.ordinal(c, scale, 99)) == [2, 99, 99]
    assert apply(spark, ["high", "odd"], lambda c: lb.ordinal_label(lb.ordinal(c, scale), scale)) == ["high", None]
    with pytest.raises(Exception, match="off the scale: odd"):
        apply(spark, values, lambda c: lb.ordinal(c, scale, "error"))
    assert apply(spark, ["low", None], lambda c: lb.ordinal(c, scale, "error")) == [1, None]


def test_share_rounds_half_up(spark):
    df = spark.createDataFrame([(1, 8, 2), (1, 800, 1), (3, 800, 1)], "a long, b long, s int")
    got = [df.filter(F.col("a") == a).filter(F.col("b") == b).select(lb.share(F.col("a"), F.col("b"), s)).first()[0]
           for a, b, s in ((1, 8, 1), (1, 800, 1), (3, 800, 1))]
    assert got == [12.5, 0.1, 0.4]


def test_small_base_flag(spark):
    df = spark.createDataFrame([(29,), (30,)], "n int")
    assert [r[0] for r in df.select(lb.small_base_flag(F.col("n"))).collect()] == ["Amostra pequena (<30)", "OK"]


def test_normalised_names_in_every_script(spark):
    texts = ["Outros… quais", "Power BI™", "a\u2009b\u2003c\u202fd", "ﬁnal", "й ά", "Ｆｕｌｌ", "한글 각", "x½²", "ö_ ß", "\U0001d4d0bc"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(tx.normalize_name(F.col("t"))).collect()]
    assert got == [reference_name(t) for t in texts]


def reference_name(text):
    plain = "".join(c for c in unicodedata.normalize("NFKD", text.replace("/", "_")) if not unicodedata.combining(c))
    return re.sub(r"[\s_]+", "_", re.sub(r"[,?().]", "", plain.lower())).strip("_")


def test_accents_of_every_character_of_the_basic_plane(spark):
    chars = [chr(c) for c in range(0x80, 0x10000) if not 0xD800 <= c < 0xE000]
    frame = spark.createDataFrame([(c,) for c in chars], "c string").repartition(8)
    got = {r["c"]: r["p"] for r in frame.select("c", tx.strip_accents(F.col("c")).alias("p")).collect()}
    want = {c: "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x)) for c in chars}
    assert {c: (got[c], want[c]) for c in chars if got[c] != want[c]} == {}


def test_damage_repair_survives_line_separators(spark):
    texts = ["abc\u2028", "abc\u2029", "abc\n", "nÃ£o\n"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(tx.repair_mojibake(F.col("t"))).collect()]
    assert got == ["abc\u2028", "abc\u2029", "abc\n", "não\n"]


def test_blanks_of_any_script_are_stripped_from_headers(spark):
    raw = ["2.l.2_Sal\u00a0", "\u2003(\u00a0'P1_a ' ,\u2009'Idade\u3000')"]
    frame = spark.createDataFrame([(t,) for t in raw], "t string")
    dotted, other = (frame.select(tx.parse_question(F.col("t"), s)["label"]).collect() for s in ("dotted", "tuple"))
    assert dotted[0][0] == "Sal" and other[1][0] == "Idade"


def test_null_share_is_rounded_by_its_binary_value(spark):
    frame = spark.createDataFrame([(n, d) for d in range(1, 241) for n in range(d + 1)], "n int, d int")
    got = frame.select("n", "d", round_binary(F.col("n") / F.col("d") * 100).alias("r")).collect()
    assert [(r["n"], r["d"], r["r"]) for r in got if r["r"] != round(r["n"] / r["d"] * 100, 1)] == []


def test_profiles_take_dates(spark):
    frame = spark.sql("SELECT DATE'2020-01-01' AS day, '1' AS flag")
    got = {r["column"]: r["type"] for r in null_dictionary(frame, "w").collect()}
    assert got == {"day": "single_choice", "flag": "binary_multiselect"}
