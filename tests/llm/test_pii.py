import hashlib
import math
import random
import re
from collections import Counter

from helpers import DOC, EDGES, edges, empty
from pyspark.sql import functions as F
from wavelens.llm import pii

SF = "/root/testdata/sf0.001"
KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
ODD = [
    "a@b.c%d@e.f g@h@i.jk .x@-.-- @a.b a@b a@b. mail.to+tag%x@sub.example.com.",
    "1.2.3.4.5.6.7.8 256.1.1.1 0001.002.255.09 1.2.3 1.2.3.4.5 999999999999999999999.1.1.1 \U0001f6421.1.1.1",
    "4111 1111 1111 1111 4111-1111-1111-1112 4111  1111 4103495397927849 1-2-3-4 5- 6 00000000000000",
    "+1 (988) 555-2485 orthen +123 +1+2 +49.30.123456 (5) +1 5 5 5 5 5 5 5 5 5 5 5 5 5 5 5 5 + 12 +12345678901 4111111111111111",
    "é +1 (456) 555-2186, ü a@b.cd 10.0.0.1 4111 1111 1111 1111 \n+12 345 678 901\n", "a@" * 3000 + "b.c", "1." * 5000, "+" * 2000 + "1" * 2000,
]


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(x) <= 255 for x in value.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def spans(text):
    return [(k, m.start(), m.end()) for k, p in KINDS.items() for m in re.finditer(p, text or "") if valid(k, m[0])]


def written(found):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in found)


def base_of(row):
    return [(s["kind"], s["start"], s["end"]) for s in row["spans"] if s["kind"] in KINDS]


def test_base_spans_of_odd_texts(spark):
    rows = list(enumerate(ODD))
    got = {r["doc_id"]: r for r in pii.scan(spark.createDataFrame(rows, DOC)).collect()}
    for i, text in rows:
        assert base_of(got[i]) == spans(text)
        assert all(s["value"] == text[s["start"] : s["end"]] for s in got[i]["spans"])


def test_query_over_the_whole_table(spark):
    from wavelens.llm.registry import op9_pii

    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op9_pii(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        found = spans(texts[r["doc_id"]])
        assert [r[f"n_{k}"] for k in KINDS] == [sum(s[0] == k for s in found) for k in KINDS]
        assert r["base_sha256"] == hashlib.sha256(written(found).encode()).hexdigest()
        assert r["spans"].startswith(written(found))


def disclosing():
    """An address met with one rare name in several contexts, among common words."""
    filler = ["the of and to", "in is that for", "on was with as", "by at from be"]
    rows = [(i, f"{filler[i % 4]} zorblax {filler[(i + 1) % 4]} secret@corp.example {filler[(i + 2) % 4]} ZORBLAX end{i}") for i in range(4)]
    rows += [(10 + i, f"{filler[i % 4]} {filler[(i * 7 + 1) % 4]} plain text {i}") for i in range(60)]
    return [*rows, (99, "zorblax alone, no address")]


def test_terms_that_disclose_an_entity(spark):
    docs = spark.createDataFrame(disclosing(), DOC)
    found = pii.find(docs)
    risky = {r["term"]: r["share"] for r in pii.disclosures(docs, found).collect()}
    assert risky["zorblax"] > 0.9 and max(s for t, s in risky.items() if t != "zorblax") < pii.GENERALISE
    got = {r["doc_id"]: r for r in pii.scan(docs).collect()}
    text = dict(disclosing())[0]
    extra = [(s["kind"], text[s["start"] : s["end"]]) for s in got[0]["spans"] if s["kind"] not in KINDS]
    assert extra == [("removed", "zorblax"), ("removed", "ZORBLAX")]
    assert [s["kind"] for s in got[99]["spans"]] == ["removed"] and got[10]["spans"] == []
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(docs).collect()}
    assert "orblax" not in clean[0].lower() and "[EMAIL]" in clean[0] and clean[99] == " alone, no address"


def test_terms_far_from_the_entity_count(spark):
    filler = ["the of and to", "in is that for", "on was with as", "by at from be"]
    far = " ".join(filler * 20)  # 320 words and many digits lie between the name and the address
    rows = [(i, f"zorblax {far} 1975, {i} 12 secret@corp.example end{i}") for i in range(4)]
    docs = spark.createDataFrame(rows + [(10 + i, f"{far} plain text note{i}") for i in range(60)], DOC)
    risky = {r["term"]: r["share"] for r in pii.disclosures(docs, pii.find(docs)).collect()}
    assert risky["zorblax"] > 0.99 and risky["1975"] > 0.99
    assert not {"secret", "corp", "example"} & set(risky)


def test_a_pair_met_twice_counts_by_its_rarity(spark):
    """Two documents are enough for a term that is nowhere else, not for one that is common."""
    usual = " ".join(f"w{i}" for i in range(40))
    rows = [(i, f"quux {usual} me@x.yz only{i}") for i in range(2)] + [(9, f"quibble {usual} you@x.yz")]
    docs = spark.createDataFrame(rows + [(10 + i, f"{usual} text note{i}") for i in range(300)], DOC)
    got = {(r["entity"], r["term"]): r["share"] for r in pii.disclosures(docs, pii.find(docs)).collect()}
    assert {k for k, share in got.items() if share >= pii.GENERALISE} == {("email:me@x.yz", "quux")}


def test_disclosing_terms_go_where_the_entity_is_not(spark):
    filler = ["the of and to", "in is that for", "on was with as", "by at from be"]
    rows = [(i, f"{filler[i % 4]} zorblax secret@corp.example end{i}") for i in range(9)]
    rows += [(None, "Zorblax alone"), (51, "zorblax with a@b.cd"), (52, "zorblaxes"), (53, "Zorblax alone"), (54, None)]
    rows += [(100 + i, f"{filler[i % 4]} {filler[(i * 7 + 1) % 4]} note{i}") for i in range(300)]
    docs = spark.createDataFrame(rows, DOC)
    got = pii.scan(docs).collect()
    extra = {r["doc_id"]: [(s["kind"], s["value"]) for s in r["spans"] if s["kind"] not in KINDS] for r in got}
    assert len(got) == len(rows) and extra[52] == extra[54] == extra[100] == []
    assert all(extra[i] and extra[i][0][1].lower() == "zorblax" for i in (None, 0, 51, 53))
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(docs).collect()}
    assert len(clean) == len(rows) and not any("zorblax " in (t or "").lower() for t in clean.values())
    assert clean[52] == "zorblaxes" and clean[54] is None


def test_copies_are_one_piece_of_evidence(spark):
    docs = spark.createDataFrame([(i, "see quux about me@x.yz now") for i in range(50)] + [(90, "other")], DOC)
    assert pii.disclosures(docs, pii.find(docs)).count() == 0


def test_overlapping_spans_are_masked_once(spark):
    text = "call +1 (456) 555-2186 4111 or a@1.2.3.4 x"
    got = pii.sanitise(spark.createDataFrame([(1, text)], DOC)).first()["text"]
    assert "555" not in got and "@" not in got and got.endswith(" x") and got.startswith("call [PHONE]")


def test_edges_keep_rows_columns_and_clean_texts(spark):
    df = edges(spark).withColumn("spans", F.lit("mine")).withColumn("row_", F.lit(1))
    got = pii.sanitise(df)
    assert got.columns == df.columns and sorted(map(repr, got.collect())) == sorted(map(repr, df.collect()))
    assert pii.scan(df).count() == len(EDGES)


def test_no_rows(spark):
    assert pii.scan(empty(spark)).count() == 0 and pii.sanitise(empty(spark)).count() == 0


def test_copies_count_once_in_every_number(spark):
    """Many copies, some in other letter case, of texts with and without personal data."""
    texts = ["see quux about me@x.yz now", "plain words of all kinds", "quux and plain", "me@x.yz again quux", "", "words"]
    rows = [(i, t.upper() if i % 7 == 0 else t) for i, t in enumerate(t for n, t in enumerate(texts) for _ in range(n * 3 + 1))]
    docs = spark.createDataFrame([*rows, (900, None), (901, None)], DOC).repartition(5)
    found = pii.find(docs)
    groups = pii.copies(docs)
    assert groups.count() == len(texts) and groups.agg({"n": "sum"}).first()[0] == len(rows) + 2
    want = {}
    for t in texts:
        for term in set(t.replace("me@x.yz", " ").split()):
            want[term] = want.get(term, 0) + 1
    assert {r["term"]: r["n_term"] for r in pii.term_counts(docs, found, groups).collect()} == want
    held = pii.entity_documents(found).collect()
    assert sorted(sorted(r["terms"]) for r in held) == [["about", "now", "quux", "see"], ["again", "quux"]]


def test_a_template_tells_nobody_from_its_words(spark):
    """Twelve texts of one template with an address, a rare name beside another, and clean texts."""
    rows = [(i, f"order {1000 + i} please see our spring brochure or write to info@acme.com today") for i in range(12)]
    filler = ["the of and to", "in is that for", "on was with as", "by at from be"]
    rows += [(20 + i, f"{filler[i % 4]} zorblax {filler[(i + 1) % 4]} secret@corp.example end{i}") for i in range(8)]
    clean = [(100, "my garden brochure arrived today"), (101, "see you in spring, please write")]
    clean += [(200 + i, f"{filler[i % 4]} {filler[(i * 7 + 1) % 4]} note{i}") for i in range(300)]
    docs = spark.createDataFrame([*rows, *clean], DOC)
    got = pii.disclosures(docs, pii.find(docs)).filter(f"share >= {pii.GENERALISE}").collect()
    assert {(r["entity"], r["term"]) for r in got} == {("email:secret@corp.example", "zorblax")}
    after = {r["doc_id"]: r["text"] for r in pii.sanitise(docs).collect()}
    assert all(after[d] == t for d, t in clean)
    assert all("[EMAIL]" in after[d] and "brochure" in after[d] for d in range(12))
    assert not any("zorblax" in after[20 + i] for i in range(8))


def brute_shares(rows):
    """Shares of all pairs by plain counting over different texts (letter case aside)."""
    texts = list({(t or "").lower(): t or "" for _, t in rows}.values())
    total, docs = len(texts), []
    for t in texts:
        found, out = spans(t), list(t)
        for s in found:
            out[s[1] : s[2]] = " " * (s[2] - s[1])
        entities = {s[0] + ":" + (re.sub("[^0-9]", "", t[s[1] : s[2]]) if s[0] in ("card", "phone") else t[s[1] : s[2]].lower()) for s in found}
        docs.append((entities, set(re.findall(r"[^\W_]{2,}", "".join(out).lower()))))
    n_entity = Counter(e for es, _ in docs for e in es)
    n_term = Counter(t for _, ts in docs for t in ts)
    both = Counter((e, t) for es, ts in docs for e in es for t in ts)
    least = math.log(max(len(both), 1) / pii.RISK)
    share = {}
    for (e, t), n in both.items():
        chance = n_entity[e] * n_term[t] / total
        if n > chance and n * math.log(n / chance) - n + max(chance, math.log(2 * math.pi * n) / 2) >= least and total > n_entity[e]:
            share[e, t] = math.log2(n * total / (n_entity[e] * n_term[t])) / math.log2(total / n_entity[e])
    crowd = Counter(e for (e, _), x in share.items() if x >= pii.GENERALISE)
    return {k: x for k, x in share.items() if crowd[k[0]] <= pii.PASSAGE and x >= pii.GENERALISE}


def test_shares_against_plain_counting(spark):
    draw = random.Random(5)
    common = [f"w{i}" for i in range(60)]
    people = {f"p{i}@x.example": f"name{i}" for i in range(6)}
    rows = []
    for i in range(500):
        words = draw.sample(common, 12)
        if draw.random() < 0.2:
            mail, name = draw.choice(list(people.items()))
            words += [mail.upper() if draw.random() < 0.3 else mail] + ([name] if draw.random() < 0.8 else [])
        draw.shuffle(words)
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, rows[i % 20][1].upper()) for i in range(60)] + [(2000, None), (2001, "")]
    docs = spark.createDataFrame(rows, DOC)
    got = {(r["entity"], r["term"]): r["share"] for r in pii.disclosures(docs, pii.find(docs)).filter(f"share >= {pii.GENERALISE}").collect()}
    want = brute_shares(rows)
    assert got.keys() == want.keys() and len(want) >= 4
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


def brute_pieces(rows, entity, telling):
    """Shares of terms by pieces of evidence, by plain counting; ``entity`` is an address."""
    texts = list({t.lower(): t for _, t in rows}.values())
    split = [[w for w in re.findall(r"[^\W_]{2,}", t.lower().replace(entity, " "))] for t in texts]
    own = [i for i, t in enumerate(texts) if entity in t.lower()]
    size = pii.PASSAGE + 1
    runs = {i: {tuple(split[i][k : k + size]) for k in range(len(split[i]) - size + 1)} for i in own}
    runs = {i: {r for r in rs if set(r) & telling} for i, rs in runs.items()}
    up = {i: i for i in own}
    for _ in own:
        for i in own:
            up[i] = min(up[j] for j in own if i == j or runs[i] & runs[j])
    n_entity, out = len(set(up.values())), {}
    total = len(texts) - len(own) + n_entity
    for t in telling:
        both = len({up[i] for i in own if t in split[i]})
        n_term = sum(t in s for s in split) - sum(t in split[i] for i in own) + both
        out[t] = math.log2(both * total / (n_entity * n_term)) / math.log2(total / n_entity) if both > 1 else 0.0
    return out


def test_more_terms_than_a_passage_has_disclose_a_person(spark):
    """Five rare terms in other words each time, a template with the same address, and a template of its own."""
    draw = random.Random(3)
    common = [f"w{i}" for i in range(200)]
    rare = ["zorblax", "quibbleton", "harpsichord", "1873", "vexford"]
    rows = []
    for i in range(12):
        words = draw.sample(common, 30)
        for k, term in enumerate(rare):
            words.insert(2 + 6 * k + draw.randrange(3), term)
        rows.append((i, " ".join(words) + " me@x.yz"))
    rows += [(20 + i, f"notice {1000 + i} our spring brochure has arrived write to me@x.yz") for i in range(9)]
    rows += [(40 + i, f"order {1000 + i} please see the winter catalogue or ask info@acme.com today") for i in range(12)]
    clean = [(100, "my brochure and your catalogue came in spring"), (101, "Zorblax of Vexford")]
    rows += [*clean, *((200 + i, " ".join(draw.sample(common, 30))) for i in range(600))]
    docs = spark.createDataFrame(rows, DOC).repartition(4)
    got = {(r["entity"], r["term"]): r["share"] for r in pii.disclosures(docs, pii.find(docs)).filter(f"share >= {pii.GENERALISE}").collect()}
    assert got.keys() == {("email:me@x.yz", t) for t in rare}
    telling = set(rare) | {"notice", "our", "spring", "brochure", "has", "arrived", "write", "to", *(str(1000 + i) for i in range(9))}
    want = brute_pieces(rows, "me@x.yz", telling)
    assert all(abs(share - want[t]) < 1e-9 for (_, t), share in got.items()) and want["brochure"] == 0
    after = {r["doc_id"]: r["text"] for r in pii.sanitise(docs).collect()}
    assert not any(t in after[i] for i in range(12) for t in rare) and after[100] == clean[0][1]
    assert "zorblax" not in after[101].lower() and all("brochure" in after[20 + i] for i in range(9))


def test_pieces_of_evidence(spark):
    """Documents linked through a third one are one piece; short ones are pieces of their own."""
    texts = [(1, "aa bb cc t1 dd".split()), (2, "bb cc t1 dd ee t2 ff gg".split()), (3, "xx ee t2 ff gg".split()), (4, ["t1", "t2"]), (5, ["t1"])]
    df = spark.createDataFrame([(d, w, ["e", "f"]) for d, w in texts], "doc long, words array<string>, entities array<string>")
    telling = spark.createDataFrame([("e", "t1"), ("e", "t2"), ("f", "t2"), ("f", "gg")], "entity string, term string")
    of_entity, of_pair = pii.pieces(df, telling)
    assert {tuple(r) for r in of_entity.collect()} == {("e", 3), ("f", 4)}
    assert {tuple(r) for r in of_pair.collect()} == {("e", "t1", 3), ("e", "t2", 2), ("f", "t2", 2), ("f", "gg", 1)}
    plan = of_pair._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
