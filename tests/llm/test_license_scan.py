import textwrap
from collections import defaultdict

import numpy as np
import pytest
import regex
from helpers import DOC, EDGES, edges, empty
from wavelens.llm import license_scan as ls
from wavelens.llm.registry import op2_license_scan

SF = "/root/testdata/sf0.001"
MIT = ls.TEMPLATES["mit"][2] + ", and to permit persons to whom the Software is furnished to do so."
GPL, BSD, APACHE = ls.TEMPLATES["gpl-3.0"][1], ls.TEMPLATES["bsd-3-clause"][1], ls.TEMPLATES["apache-2.0"][1]
PROSE = "We went to the market and bought apples and pears for the winter. " * 8
FORMS = [
    ("\n".join(textwrap.wrap(MIT, 78)), {"mit"}),
    ("/*\n" + "\n".join(f" * {x}" for x in textwrap.wrap(GPL, 70)) + "\n */\nint main() {}", {"gpl-3.0"}),
    ("\r\n".join(f"# {x}" for x in textwrap.wrap(BSD.upper(), 60)), {"bsd-3-clause"}),
    ("\n".join(f"// {x}" for x in textwrap.wrap(APACHE, 50)), {"apache-2.0"}),
    ("Released under the MIT License. Licensed under CC BY 4.0.", {"mit", "cc-by-4.0"}),
    (f"{PROSE}{ls.TEMPLATES['cc-by-sa-4.0'][1]} {PROSE}", {"cc-by-sa-4.0"}),
    (f"{PROSE}{MIT} {PROSE}", {"mit"}),
    ("Licensed under the Apache License, Version 1.1.", {ls.UNKNOWN}),
    ("This work is licensed under the GNU General Public License, version 2.", {ls.UNKNOWN}),
    ("This program is licensed under the GNU Affero General Public License, version 3.", {ls.UNKNOWN}),
    ("Released under the Foo Bar Public License, version 9.", {ls.UNKNOWN}),
    (PROSE, set()), ("the house and the garden\nwere quiet in the morning", set()),
]


@pytest.fixture(scope="module")
def classifier(spark):
    return ls.fit(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"))


def grams(ws):
    return {*ws, *(f"{a} {b}" for a, b in zip(ws, ws[1:], strict=False))}


def brute(rows, c):
    """The scan in plain Python: every window scored, every template compared."""
    weights, start = c.regression.coefficientMatrix.toArray(), c.regression.interceptVector.toArray()
    place = {g: i for i, g in enumerate(c.vectors.vocabulary)}
    templates = [(f, regex.findall(ls.WORD, t.lower()), ls.required(t)) for f, ts in ls.TEMPLATES.items() for t in ts]
    out = []
    for doc, text in rows:
        for number, block in enumerate(regex.split(ls.BLANK_LINES, text or "")):
            ws, flagged = regex.findall(ls.WORD, block.lower()), []
            for i in range(0, max(0, len(ws) - ls.WINDOW + ls.STRIDE - 1) + 1, ls.STRIDE) if ws else []:
                near, wide = (grams(ws[max(0, i - k) : i + ls.WINDOW + k]) for k in (0, ls.AROUND))
                raw = (start + weights[:, [place[g] for g in near if g in place]].sum(1)) / c.temperature
                share = np.exp(raw - raw.max()) / np.exp(raw - raw.max()).sum()
                ranked = [x for _, x in sorted(zip(share, c.labels, strict=True), reverse=True)]
                if ranked[0] == ls.OTHER:
                    continue
                sure = set()
                for family, tw, must in templates:
                    have = near if len(tw) <= ls.WINDOW - ls.STRIDE else wide
                    if family in [x for x in ranked if x not in (ls.OTHER, ls.UNKNOWN)][: ls.FAMILIES]:
                        if set(must) <= have and len(grams(tw) & have) >= ls.CONFIRMED * len(grams(tw)):
                            sure.add(family)
                flagged.append((i, i + len(ws[i : i + ls.WINDOW]) - 1, sure, 1 - share[c.labels.index(ls.OTHER)]))
            spans = defaultdict(list)
            for a, b, sure, notice in flagged:
                settled = any(s for x, _, s, _ in flagged if abs(x - a) < ls.WINDOW)
                for family in sure or ([ls.UNKNOWN] if not settled and notice > c.threshold else []):
                    spans[family].append((a, b))
            out += [(doc, number, f, min(a for a, _ in s), max(b for _, b in s)) for f, s in spans.items()]
    return sorted(out, key=str)


def found(df):
    return sorted(((r["doc_id"], r["paragraph"], r["family"], r["first_word"], r["last_word"]) for r in df.collect()), key=str)


def test_forms_of_notices(spark, classifier):
    docs = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(FORMS)], DOC)
    got = defaultdict(set)
    for doc, _, family, _, _ in found(ls.scan(docs, classifier)):
        got[doc].add(family)
    assert {i: got[i] for i in range(len(FORMS))} == {i: want for i, (_, want) in enumerate(FORMS)}


def test_against_every_window_in_plain_python(spark, classifier):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()] + [(-i, t) for i, (t, _) in enumerate(FORMS, 1)]
    rows += [(-100 - i, t) for i, (_, t) in enumerate(EDGES)] + [(-200, "\n\n".join(t for t, _ in FORMS)), (-201, " ".join(t for t, _ in FORMS))]
    want = brute(rows, classifier)
    assert found(ls.scan(spark.createDataFrame(rows, DOC), classifier)) == want and len(want) > len(FORMS)


def test_query_finds_the_notices_of_its_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    known = {x: family for family, texts in ls.TEMPLATES.items() for x in texts}
    want = {(r["doc_id"], known[line]) for r in docs for line in (r["text"] or "").split("\n") if line in known}
    assert want and {(r["doc_id"], r["family"]) for r in op2_license_scan(spark, SF).collect()} == want


def test_windows_without_cues_are_no_notices(spark, classifier):
    assert classifier.cues
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    pages = ls.paragraphs(docs).cache()
    missed = ls.windows(pages).join(ls.windows(pages, classifier.cues), ["doc_id", "paragraph", "start"], "left_anti")
    scored = classifier.classify(missed.withColumn("grams", ls.ngrams(missed["words"])))
    assert scored.count() and scored.filter(scored["label"] != ls.OTHER).count() == 0


def test_cue_words():
    vocabulary = ["the", "of", "license", "the license", "rare"]
    weights = np.array([[0, 0.1, 0.0, 0.9, 0], [0.3, 0.2, 0.0, 0.0, 0], [0, 0.0, 0.0, 0.0, 5]], float)
    # 0.2 and 0.3 together do not make up a lead of 1, but they do one of 0.4; a pair goes by its rarer word
    assert ls.cue_words(vocabulary, weights, np.array([1.0, 0.0, 2.0]), 2) == ["license"]
    assert ls.cue_words(vocabulary, weights, np.array([1.0, 0.0, 1.4]), 2) == ["license", "the"]
    assert ls.cue_words(vocabulary, weights, np.array([1.0, 3.0, 2.0]), 2) is None


def test_edges_and_no_rows(spark, classifier):
    assert ls.scan(edges(spark), classifier).count() == 0 == ls.scan(empty(spark), classifier).count()
    notice = spark.createDataFrame([(1, "All rights reserved.")] * 2 + [(None, "Licensed under CC BY-NC 4.0.")], DOC)
    rows = sorted((str(r["doc_id"]), r["family"], r["confirmed"]) for r in ls.scan(notice, classifier).collect())
    assert rows == [("1", "all-rights-reserved", True)] * 2 + [("None", "cc-by-nc-4.0", True)]
    long = [(1, "a." * 100_000), (2, "\n" * 100_000 + "All rights reserved."), (3, "*\n" * 100_000), (4, "x" * 500_000)]
    assert {r["doc_id"] for r in ls.scan(spark.createDataFrame(long, DOC), classifier).collect()} == {2}


def test_fit_without_a_corpus(spark):
    own = ls.fit(empty(spark))
    assert [r["family"] for r in ls.scan(spark.createDataFrame([(1, "Released under the MIT License.")], DOC), own).collect()] == ["mit"]


def test_probabilities_are_calibrated(classifier):
    assert 0.5 <= classifier.threshold <= 0.99 and classifier.temperature > 0


def test_no_python_in_the_plan(spark, classifier):
    plan = ls.windows(ls.paragraphs(empty(spark)), classifier.cues)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
