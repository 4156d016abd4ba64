"""Personal data: base patterns, and terms that give protected entities away.

Base spans are addresses, numbers and cards found by pattern. Masking them is not enough
where other words tell who is meant, so the corpus decides which words do. With document
frequencies of whole texts as probabilities, copies (but for letter case) counted once, the information content of an entity ``e`` is
``IC(e) = -log2 p(e)``, and what a term ``t`` tells about it is the pointwise mutual
information ``PMI(e, t) = log2(p(e, t) / (p(e) p(t)))``, at most ``IC(e)``. A term whose share
``PMI / IC`` reaches a threshold discloses ``e``, if the lower confidence bound of the PMI
over all pairs that meet anywhere is above zero: it is generalised from ``GENERALISE`` on and removed from ``REMOVE`` on,
in all documents, whether or not they hold ``e``. Where many terms would disclose one
entity, documents that share a passage around them count as one, as copies do.

Everything is DataFrame functions. A match's place follows from the lengths of the pieces
between matches, as the patterns never overlap themselves.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavelens.llm.common import among, filled, salted_join
from wavelens.llm.components import components_by_joins
from wavelens.llm.line_dedup import fixed_array
from wavelens.session import stored

#: Chance that any pair of the corpus meets as often as one that counts by accident.
RISK = 0.05
#: Shares of an entity's information content.
GENERALISE = 0.6
REMOVE = 0.9
#: Terms that disclose one entity without a further look, and that a name may have. More in a row, one of which would
#: disclose the entity, are a passage (of a template, or of copies with small changes): documents that share one are one
#: piece of evidence, however many they are, and one piece tells none of its terms from another.
PASSAGE = 3
#: Slots of the filter that terms pass before they meet the risky ones, and salts of that join.
FILTER_BITS = 20
SALTS = 16

TERM = r"[\p{L}\p{N}]{2,}"
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"

#: Patterns by kind. Possessive loops and the look-behind only keep the matcher linear:
#: a match can begin only where a run of its characters does, or where one has ended.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?+[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}

#: Cheaper conditions that every text with a valid match meets.
SCREENS = {
    "email": lambda text: F.contains(text, F.lit("@")),
    "ip": lambda text: text.rlike(r"[0-9]\.[0-9]++\.[0-9]"),
    "card": lambda text: text.rlike(r"[0-9](?:[ -]?[0-9]){12}"),
    "phone": lambda text: F.contains(text, F.lit("+")),
}

SPAN = "array<struct<kind:string,start:int,end:int,value:string>>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a text of digits ends in the right check digit."""
    doubled = F.translate(digits, "0123456789", "0246813579")
    size = F.length(digits)
    each = F.transform(
        F.sequence(F.lit(1), size),
        lambda i: F.substring(F.when((size - i) % 2 == 0, digits).otherwise(doubled), i, F.lit(1)).cast("int"),
    )
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def is_valid(kind: str, value: Column) -> Column:
    """Whether a match of the pattern counts."""
    if kind == "ip":
        return value.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        size = F.length(_digits(value))
        return F.when((size >= 13) & (size <= 19), luhn(_digits(value))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def place_matches(text: Column, kind: str, pattern: str | Column) -> Column:
    """Spans of all matches of a pattern, in code points, in the order of the text."""
    by_column = isinstance(pattern, Column)
    gaps = F.split(text, pattern, -1)
    matches = F.regexp_extract_all(text, pattern if by_column else F.lit(pattern), F.lit(0))
    steps = F.zip_with(gaps, matches, lambda gap, match: F.struct(F.length(gap).alias("gap"), match.alias("value")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("found"))

    def step(done: Column, x: Column) -> Column:
        begin = done["at"] + x["gap"]
        end = begin + F.length(x["value"])
        span = F.struct(F.lit(kind).alias("kind"), begin.alias("start"), end.alias("end"), x["value"].alias("value"))
        more = F.concat(done["found"], F.array(span))
        at = F.coalesce(end, begin)
        return F.struct(at.alias("at"), F.when(x["value"].isNull(), done["found"]).otherwise(more).alias("found"))

    return F.aggregate(steps, start, step, lambda done: done["found"])


def base_spans(text: Column) -> Column:
    """All base spans of a text that is not null, by kind as listed, then by start."""
    empty = F.array().cast(SPAN)
    parts = []
    for kind, pattern in PATTERNS.items():
        found = F.filter(place_matches(text, kind, pattern), _valid_span(kind))
        parts.append(F.when(SCREENS[kind](text), found).otherwise(empty))
    return F.concat(*parts)


def _valid_span(kind: str):
    return lambda s: is_valid(kind, s["value"])


def of_kind(kind: str):
    return lambda s: s["kind"] == kind


def entity(kind: Column, value: Column) -> Column:
    """What a span stands for: letter case and the layout of numbers do not matter."""
    return F.concat(kind, F.lit(":"), F.when(kind.isin("card", "phone"), _digits(value)).otherwise(F.lower(value)))


def find(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` that hold personal data, with ``spans`` and a number ``row``; stored.

    The other columns are kept as they are; ``spans`` and ``row`` must not be among them.
    """
    text = filled()
    found = docs.withColumn("spans", F.when(_screened(text), base_spans(text))).filter(F.size("spans") > 0)
    return stored(found.withColumn("row", F.monotonically_increasing_id()), "personal")


def _screened(text: Column) -> Column:
    tests = [screen(text) for screen in SCREENS.values()]
    return tests[0] | tests[1] | tests[2] | tests[3]


def is_clean(text: Column) -> Column:
    """Whether a text holds no base span at all; the complement of ``find``."""
    return ~F.coalesce(F.when(_screened(text), F.size(base_spans(text)) > 0), F.lit(False))


def outside(text: Column, spans: Column) -> Column:
    """The text with a blank in place of each span."""
    return F.when(F.size(spans) > 0, _replaced(text, spans, lambda s: F.lit(" "))).otherwise(text)


def _copy_key(text: Column) -> list[Column]:
    """128 bits that texts alike in all but letter case share."""
    return [F.xxhash64(F.lower(text)).alias("key"), F.xxhash64(F.lower(text), F.lit(1)).alias("check")]


def copies(docs: DataFrame) -> DataFrame:
    """``(key, check, n)`` of every different text; stored. Only keys move."""
    return stored(docs.select(*_copy_key(filled())).groupBy("key", "check").agg(F.count(F.lit(1)).alias("n")), "copies")


def _own_words(spans: str | None = "spans") -> Column:
    """Terms of ``text`` outside its spans, in its order."""
    return _terms(filled() if spans is None else outside(filled(), F.col(spans)))


def _own_terms(spans: str | None = "spans") -> Column:
    """Distinct terms of ``text`` outside its spans."""
    return F.array_distinct(_own_words(spans))


def entity_texts(found: DataFrame) -> DataFrame:
    """``(doc, words, entities)`` of each text that holds personal data, copies once.

    ``words`` are its terms in their order, ``entities`` are distinct, ``doc`` is a number of the text.
    """
    rows = found.select(filled().alias("text"), "spans", *_copy_key(filled()))
    once = rows.groupBy("key", "check").agg(F.any_value(F.struct("text", "spans")).alias("doc")).select("key", "check", "doc.*")
    entities = F.array_distinct(F.transform("spans", lambda s: entity(s["kind"], s["value"])))
    return once.select(F.xxhash64("key", "check").alias("doc"), _own_words().alias("words"), entities.alias("entities"))


def entity_documents(found: DataFrame) -> DataFrame:
    """``(terms, entities)``, both distinct, of each text that holds personal data, copies once."""
    return entity_texts(found).select(F.array_distinct("words").alias("terms"), "entities")


def term_counts(docs: DataFrame, found: DataFrame, groups: DataFrame) -> DataFrame:
    """``(term, n_term)``: different texts that hold each term.

    Terms are counted in all texts where they are read; what copies add too much is taken
    off again by one text of each group of them.
    """
    clean = docs.filter(is_clean(filled()))
    every = found.select(F.explode(_own_terms()).alias("term")).unionByName(clean.select(F.explode(_own_terms(None)).alias("term")))
    counted = every.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    again = among(docs.select(filled().alias("text"), *_copy_key(filled())), groups.filter("n > 1"))
    once = again.groupBy("key", "check").agg(F.any_value("text").alias("text"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    spans = F.coalesce(F.when(_screened(F.col("text")), base_spans(F.col("text"))), F.array().cast(SPAN))
    extra = once.withColumn("spans", spans).select("n", F.explode(_own_terms()).alias("term")).groupBy("term").agg(F.sum(F.col("n") - 1).alias("more"))
    return counted.join(extra, "term", "left").select("term", (F.col("n") - F.coalesce("more", F.lit(0))).alias("n_term"))


def _terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def _is_rare(n_both: Column, n_entity: Column, n_term: Column, total: Column, least: float) -> Column:
    """Whether a pair meets more often than by accident, by bounds of the Poisson tail."""
    chance = n_entity * n_term / total
    rest = F.greatest(chance, F.log(2 * math.pi * n_both) / 2)  # Chernoff; Stirling under chance^n / n!
    return (n_both > chance) & (n_both * F.log(n_both / chance) - n_both + rest >= least)


def _share(n_both: Column, n_entity: Column, n_term: Column, total: Column, least: float) -> Column:
    """Share of an entity's information content that a term tells; 0 where they may meet by accident."""
    content = F.log2(total / n_entity)
    told = F.log2(n_both * total / (n_entity * n_term)) / content
    return F.when((content > 0) & _is_rare(n_both, n_entity, n_term, total, least), told).otherwise(0.0)


def disclosures(docs: DataFrame, found: DataFrame, risk: float = RISK) -> DataFrame:
    """``(entity, term, share)`` for all terms that may disclose an entity.

    All counts are of different documents, so that copies of one are one piece of evidence.
    Were a pair independent, it would meet in ``n_entity * n_term / total`` of them; the
    lower bound of its PMI is above zero if meeting ``n_both`` times or more (by bounds of
    the Poisson tail) is rarer than ``risk`` dealt out to all pairs that meet, else the
    share is 0. Pairs that miss that even at the least ``n_term``, ``n_both``, are left out.
    Of an entity that more than ``PASSAGE`` terms would disclose, these are counted again,
    by pieces of evidence.
    """
    groups = copies(docs)
    total = groups.count()
    texts = stored(entity_texts(found), "entity-documents")
    held = texts.select(F.explode("entities").alias("entity"), F.array_distinct("words").alias("terms"))
    of_entity = held.groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity"))
    pairs = held.select("entity", F.explode("terms").alias("term"))
    both = stored(pairs.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("n_both")), "both")
    least = math.log(max(both.count(), 1) / risk)
    every = F.lit(float(total))
    n_both, n_entity, n_term = F.col("n_both"), F.col("n_entity"), F.col("n_term")
    joint = stored(both.join(of_entity, "entity").filter(_is_rare(n_both, n_entity, n_both, every, least)), "joint")
    # an inner join stays above the aggregate
    of_term = term_counts(docs, found, groups).join(joint.select("term").distinct(), "term")
    counted = joint.join(of_term, "term").withColumn("share", _share(n_both, n_entity, n_term, every, least))
    return _by_pieces(stored(counted, "shares"), texts, total, least)


def _by_pieces(pairs: DataFrame, texts: DataFrame, total: int, least: float) -> DataFrame:
    """``(entity, term, share)``; the terms of entities with more than ``PASSAGE`` are counted by pieces of evidence.

    The documents of a piece count as one in every number, as copies do, and a term of one
    piece alone has share 0, as nothing tells it from the others there.
    """
    plain = pairs.select("entity", "term", "share")
    telling = pairs.filter(F.col("share") >= GENERALISE)
    many = telling.groupBy("entity").agg(F.count(F.lit(1)).alias("together")).filter(F.col("together") > PASSAGE)
    crowd = stored(telling.join(many.select("entity"), "entity"), "crowd")
    if crowd.isEmpty():
        return plain
    of_entity, of_pair = pieces(texts, crowd.select("entity", "term"))
    counted = crowd.join(of_entity, "entity").join(of_pair, ["entity", "term"])
    fewer_both, fewer = F.col("n_both") - F.col("pair_pieces"), F.col("n_entity") - F.col("entity_pieces")
    share = _share(F.col("pair_pieces"), F.col("entity_pieces"), F.col("n_term") - fewer_both, F.lit(float(total)) - fewer, least)
    settled = F.when(F.col("pair_pieces") > 1, share).otherwise(0.0)
    again = counted.select("entity", "term", settled.alias("again"))
    return plain.join(again, ["entity", "term"], "left").select("entity", "term", F.coalesce("again", "share").alias("share"))


def pieces(texts: DataFrame, telling: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(entity, entity_pieces)`` and ``(entity, term, pair_pieces)``: pieces of evidence.

    ``texts`` are those of ``entity_texts``, ``telling`` the different ``(entity, term)`` in
    question. Documents of an entity are one piece if they share a passage, more than
    ``PASSAGE`` words in a row with one of its terms among them, or are linked by such.
    """
    node = F.xxhash64("entity", "doc").alias("node")
    rows = texts.select("doc", "words", F.explode("entities").alias("entity")).join(telling.select("entity").distinct(), "entity")
    size = PASSAGE + 1
    starts = F.sequence(F.lit(1), F.size("words") - PASSAGE)
    passages = F.when(F.size("words") >= size, F.transform(starts, lambda i: F.xxhash64(F.slice("words", i, F.lit(size)))))
    marked = rows.select("entity", node, F.coalesce(passages, F.array().cast("array<long>")).alias("passages"), "words")
    placed = marked.select("entity", "node", "passages", F.posexplode("words").alias("at", "term")).filter(_listed(telling)(F.col("term")))
    first = F.greatest(F.lit(0), F.col("at") - PASSAGE)
    around = F.slice("passages", first + 1, F.col("at") + 1 - first)  # those that begin no later than the word
    pair = F.struct("entity", "term").alias("pair")
    spots = placed.select(pair, "node", around.alias("passages"))
    spots = stored(salted_join(spots, telling.select(pair), "pair", "node"), "crowd-spots")
    shared = spots.select("node", "pair.entity", F.explode("passages").alias("passage"))
    shared = shared.select("node", F.xxhash64("entity", "passage").alias("passage"))
    shared = stored(shared.distinct(), "crowd-passages")
    least = shared.groupBy("passage").agg(F.min("node").alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    links = components_by_joins(salted_join(shared, least, "passage", "node"), "node", "least")
    piece = F.coalesce("component", "node").alias("piece")
    of_entity = rows.select("entity", node).join(links, "node", "left").select("entity", piece)
    of_pair = spots.select("pair", "node").distinct().join(links, "node", "left").select("pair", piece)
    return (
        of_entity.groupBy("entity").agg(F.count_distinct("piece").alias("entity_pieces")),
        of_pair.groupBy("pair").agg(F.count_distinct("piece").alias("pair_pieces")).select("pair.*", "pair_pieces"),
    )


def _listed(risky: DataFrame) -> Callable[[Column], Column]:
    """Whether a term may be among those of ``risky``: a bit per slot of its hash."""
    def slot(term: Column) -> Column:
        return F.pmod(F.xxhash64(term), F.lit(1 << FILTER_BITS)).cast("int")

    bits = risky.select(slot(F.col("term")).alias("slot")).groupBy(F.shiftright("slot", 6).alias("part")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("slot") % 64)).alias("bits")
    )
    table = [0] * (1 << (FILTER_BITS - 6))
    for row in bits.collect():
        table[row["part"]] = row["bits"]
    words = fixed_array(table, "bigint")
    return lambda term: F.getbit(F.element_at(words, F.shiftright(slot(term), 6) + 1), slot(term) % 64) == 1


def split_terms(docs: DataFrame, found: DataFrame, risky: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of ``docs`` with the ``spans`` of ``find`` and of disclosing terms; all others.

    The terms of all rows that may be risky meet the risky ones by value, salted.
    """
    shares = stored(risky.groupBy("term").agg(F.max("share").alias("share")), "risky-terms")
    if shares.isEmpty():
        return found, docs.filter(is_clean(filled()))
    listed = _listed(shares)
    clean = docs.filter(is_clean(filled()))
    may_hold = F.exists(_terms(filled()), listed)
    more = clean.filter(may_hold).withColumn("spans", F.array().cast(SPAN))
    more = stored(more.withColumn("row", -1 - F.monotonically_increasing_id()), "named")
    rows = found.unionByName(more)
    own = F.filter(F.array_distinct(_terms(outside(filled(), F.col("spans")))), listed)
    held = rows.select("row", F.explode(own).alias("term")).withColumn("salt", F.pmod("row", F.lit(SALTS)).cast("int"))
    salted = shares.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return add_terms(rows, held.join(salted, ["term", "salt"]).select("row", "term", "share")), clean.filter(~may_hold)


def add_terms(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """Append to ``spans`` the places of the ``terms`` (``row, term, share``) of each row."""
    quoted = F.concat(F.lit(r"\Q"), F.col("term"), F.lit(r"\E"))
    lists = terms.groupBy("row").agg(
        F.concat_ws("|", F.sort_array(F.collect_set(F.when(F.col("share") >= REMOVE, quoted)))).alias("remove"),
        F.concat_ws("|", F.sort_array(F.collect_set(F.when(F.col("share") < REMOVE, quoted)))).alias("generalise"),
    )
    joined = rows.join(lists, "row", "left")
    text = filled()
    extra = []
    for kind, column in (("term", "generalise"), ("removed", "remove")):
        listed = F.col(column)
        pattern = F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}])(?:"), listed, F.lit(r")(?![\p{L}\p{N}])"))
        extra.append(F.when(listed != "", place_matches(text, kind, pattern)).otherwise(F.array().cast(SPAN)))
    return joined.withColumn("spans", F.concat("spans", *extra)).drop("remove", "generalise")


def written(spans: str | Column) -> Column:
    """Spans as text, ``kind:start:end`` joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def masked(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind; overlapping spans become one."""
    def label(s: Column) -> Column:
        return F.when(s["kind"] == "removed", "").otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))

    return _replaced(text, spans, label)


def _replaced(text: Column, spans: Column, label: Callable[[Column], Column]) -> Column:
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["end"], s["kind"])))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(done: Column, s: Column) -> Column:
        between = F.substring(text, done["at"] + 1, s["start"] - done["at"])
        out = F.when(s["start"] >= done["at"], F.concat(done["out"], between, label(s))).otherwise(done["out"])
        return F.struct(F.greatest(done["at"], s["end"]).alias("at"), out.alias("out"))

    return F.aggregate(
        ordered, start, step,
        lambda done: F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text))),
    )


def scan(docs: DataFrame, risk: float = RISK) -> DataFrame:
    """``(doc_id, spans)`` for every row of ``(doc_id, text)``; null text is empty.

    ``spans`` has ``kind, start, end, value``: base spans by kind as listed, then ``term``
    (to be generalised) and ``removed``, each in the order of the text; without either it
    is empty. Rows that repeat are scanned alike, one result each.
    """
    docs = docs.select("doc_id", "text")
    found = find(docs)
    marked, clean = split_terms(docs, found, disclosures(docs, found, risk).filter(F.col("share") >= GENERALISE))
    return marked.select("doc_id", "spans").unionByName(clean.select("doc_id", F.array().cast(SPAN).alias("spans")))


def sanitise(docs: DataFrame, text: str = "text", risk: float = RISK) -> DataFrame:
    """``docs`` with personal data masked and disclosing terms generalised or removed.

    Same rows and columns; a text without either, null included, is unchanged.
    """
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))]).withColumn("text", F.col(f"c{names.index(text)}"))
    found = find(plain)
    marked, clean = split_terms(plain, found, disclosures(plain, found, risk).filter(F.col("share") >= GENERALISE))
    changed = marked.withColumn(f"c{names.index(text)}", masked(F.col("text"), F.col("spans")))
    keep = [f"c{i}" for i in range(len(names))]
    return changed.select(keep).unionByName(clean.select(keep)).toDF(*names)
