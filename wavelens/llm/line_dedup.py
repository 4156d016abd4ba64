"""Near-duplicate lines by an exact set-similarity join, in DataFrame functions alone.

A line is the set of its words. All sets are sorted by one global order, long words first,
as these are mostly the rare ones. Neighbours in that order are a set's keys: a word that
only one of two sets has breaks at most two keys of that set and one of the other, so two
sets of Jaccard similarity ``t`` must share one of the first ``2 (1 - t) n + 1`` keys of each
(prefix filter; below ``PAIRS_FROM`` percent, keys are single words). Sets that share a key
only make a pair if their sizes are within a factor ``t`` of each other (length filter). A
set's words also switch bits of a mask of 256 bits; as every bit in which two masks differ is
a word that only one set has, masks too far apart rule a pair out as well. What remains is
verified on the whole sets, and a line goes if any earlier line matches it.

Members of a group of sets with the same key are first compared with its earliest, the
leader, and with the one before them. Only sets that go by none of these are compared with
all earlier members of their groups, so a large group of near copies does not make all its
pairs.

Keys are taken in slices, one after the other, so that shuffle files hold one slice at most.

A word is 56 bits of its hash and its length.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wavelens.llm.common import among, filled
from wavelens.session import discard, shuffles_dropped, stored

PERCENT = 80
#: Lines without a word always stay.
MIN_WORDS = 1
#: From this percentage on two neighbouring words make a key; below, too many keys could break.
PAIRS_FROM = 67
#: Bits of an id that hold its set's size, as far as they go.
SIZE_BITS = 9
#: Lines for which one more slice of the keys is taken, up to so many slices.
SLICE_LINES = 1 << 17
MOST_SLICES = 8
_HASH_BITS = 56
_PLACE = ("unknown", "doc_id", "h", "line")
_MASKS = ("mask0", "mask1", "mask2", "mask3")


def fixed_array(numbers: list[int], kind: str) -> Column:
    """An array of fixed size as one literal of the plan."""
    return F.from_json(F.lit(json.dumps(numbers)), f"array<{kind}>")


def _word(word: Column) -> Column:
    return F.shiftleft(F.octet_length(word).cast("long"), _HASH_BITS).bitwiseXOR(
        F.shiftrightunsigned(F.xxhash64(word), 64 - _HASH_BITS)
    )


def words(line: Column) -> Column:
    """Distinct words between spaces, the longest first."""
    found = F.array_distinct(F.transform(F.split(line, " "), _word))
    return F.array_remove(F.sort_array(found, asc=False), _word(F.lit("")))


def _lines(docs: DataFrame) -> DataFrame:
    """``(unknown, doc_id, h, line, text)`` of all lines, other ASCII blanks in them made spaces.

    ``h`` is a hash of the text, which tells rows of one ``doc_id`` apart.
    """
    blanks = F.when(filled().rlike("[\t\x0b\x0c\r]"), F.translate(filled(), "\t\x0b\x0c\r", "    ")).otherwise(filled())
    return docs.select(
        F.col("doc_id").isNull().alias("unknown"), "doc_id", F.xxhash64(filled()).alias("h"),
        F.posexplode(F.split(blanks, "\n")).alias("line", "text"),
    )


def _mask(tokens: Column, lane: int) -> Column:
    """64 bits, each switched by every word whose hash picks this lane and the bit."""
    return F.aggregate(
        tokens, F.lit(0).cast("long"),
        lambda bits, t: F.when(
            t.bitwiseAND(64 * (len(_MASKS) - 1)) == 64 * lane,
            bits.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), t.bitwiseAND(63).cast("int"))),
        ).otherwise(bits),
    )


def keys(tokens: Column, percent: int) -> Column:
    """Hashes of the first keys of a set, so many that sets alike share one.

    Of ``n`` words at most ``x`` are missing in a set alike and ``y`` others in it, where
    ``100 x + percent y <= (100 - percent) n``. Sets so small that one more word already
    makes them too different only match equal sets and have none.
    """
    n = F.size(tokens)
    able = n * 100 >= (n + 1) * percent
    if percent < PAIRS_FROM:
        count = n - F.floor((n * percent + 99) / 100).cast("int") + 1
        return F.transform(F.slice(tokens, F.lit(1), F.when(able, count).otherwise(0)), lambda t: F.hash(t))
    count = F.when(able, F.floor(n * (100 - percent) * 2 / 100).cast("int") + 1).otherwise(0)
    return F.zip_with(F.slice(tokens, F.lit(1), count), F.slice(tokens, F.lit(2), count), lambda s, t: F.hash(s, t))


def line_sets(docs: DataFrame, percent: int) -> DataFrame:
    """``(row, place..., a, b, n, masks..., keys)`` of all lines; ``a, b`` are equal for equal sets."""
    sets = _lines(docs).select(*_PLACE, words(F.col("text")).alias("tokens"))
    t = F.col("tokens")
    return sets.select(
        F.monotonically_increasing_id().alias("row"), *_PLACE,
        F.xxhash64(t).alias("a"), F.xxhash64(t, F.lit(1)).alias("b"), F.size(t).alias("n"),
        *(_mask(t, lane).alias(m) for lane, m in enumerate(_MASKS)), keys(t, percent).alias("keys"),
    )


def line_classes(lines: DataFrame) -> DataFrame:
    """``(id, row, a, b, first, copies)``: one row per distinct set, with row and place of its first line.

    A later first place has a larger ``id``, which ends with the set's size. Partial
    aggregation leaves one row per task of a line that many documents share.
    """
    first = F.min(F.struct(*_PLACE, "row", "n")).alias("first")
    grouped = lines.groupBy("a", "b").agg(first, F.count(F.lit(1)).alias("copies"))
    size = F.least("first.n", F.lit((1 << SIZE_BITS) - 1))
    return grouped.orderBy(*(f"first.{c}" for c in _PLACE)).select(
        (F.shiftleft(F.monotonically_increasing_id(), SIZE_BITS) + size).alias("id"), "first.row", "a", "b",
        F.col("first").dropFields("row", "n").alias("first"), "copies",
    )


def of_slice(number: str, slices: int, part: int) -> Column:
    """Whether a number is of this slice. The slice stands in an array and not in the
    compiled code, which all slices share.
    """
    return F.array_contains(fixed_array([part], "long"), F.pmod(F.col(number), F.lit(slices).cast("long")))


def together(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def keyed(sets: DataFrame, classes: DataFrame, slices: int) -> DataFrame:
    """``(id, masks..., keys)`` of every set that has keys, from its first line."""
    rows, first = sets.select("row", *_MASKS, "keys").filter(F.size("keys") > 0), classes.select("id", "row")
    parts = [of_slice("row", slices, s) for s in range(slices)]
    return together([stored(rows.filter(p).join(first.filter(p), "row").drop("row"), "line-facts") for p in parts])


def _near(x: str, y: str, percent: int) -> Column:
    """Whether sizes and masks of two rows of ``alike`` leave it open that the sets match."""
    n, m = (F.col(f"{r}id").bitwiseAND((1 << SIZE_BITS) - 1) for r in (x, y))
    length = F.least(n, m) * 100 >= F.greatest(n, m) * percent
    apart = sum((F.bit_count(F.col(f"{x}{c}").bitwiseXOR(F.col(f"{y}{c}"))) for c in _MASKS), F.lit(0))
    cut = F.greatest(n, m) == (1 << SIZE_BITS) - 1
    return length & (cut | ((n + m - apart) * (100 + percent) >= 2 * (n + m) * percent))


def alike(facts: DataFrame, slices: int, part: int, percent: int) -> DataFrame:
    """``(key, id, nth, members, near)`` of the sets that share a key with others, for one slice of the keys.

    A set is the ``nth`` of the key's ``members``; ``near`` has the first of them and the one
    before the set, where sizes and masks leave it open that they match it. Of up to three
    members these are all earlier ones, so only rows that have such are kept there.
    """
    entries = facts.select(F.explode("keys").alias("key"), "id", *_MASKS).filter(of_slice("key", slices, part))
    order, one = W.partitionBy("key").orderBy("id"), F.struct("id", *_MASKS)
    found = entries.select(
        "*", F.row_number().over(order).alias("nth"),
        F.count(F.lit(1)).over(order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)).cast("int").alias("members"),
        F.first(one).over(order.rowsBetween(W.unboundedPreceding, 0)).alias("first"), F.lag(one).over(order).alias("last"),
    ).filter("members > 1")
    near = [F.when((F.col(f"{x}.id") < F.col("id")) & _near(f"{x}.", "", percent), F.col(f"{x}.id")) for x in ("first", "last")]
    found = found.select("key", "id", "nth", "members", F.array_compact(F.array_distinct(F.array(*near))).alias("near"))
    return found.filter((F.col("members") > 3) | (F.size("near") > 0))


def led(shared: DataFrame) -> DataFrame:
    """Pairs ``(id1, id2)`` of members of a key with its first and with the member before them, filtered."""
    return shared.select(F.explode("near").alias("id1"), F.col("id").alias("id2")).distinct()


def rest_of(shared: DataFrame, facts: DataFrame, gone: DataFrame) -> DataFrame:
    """``(key, id, nth, masks..., gone)`` of the members of keys in which ``led`` leaves pairs out."""
    masks = facts.select("id", *_MASKS).join(gone.withColumn("gone", F.lit(True)), "id", "left")
    return shared.filter("members > 3 AND nth > 1").select("key", "id", "nth").join(masks, "id")


def others(rest: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(id1, id2)`` of members that are not ``gone`` with the earlier ones that ``led`` leaves out, filtered."""
    late = rest.filter("nth > 3 AND gone IS NULL").alias("y")
    found = late.join(rest.alias("x"), "key").filter("x.nth < y.nth - 1 AND x.id < y.id").filter(_near("x.", "y.", percent))
    return found.select(F.col("x.id").alias("id1"), F.col("y.id").alias("id2")).distinct()


def matched(docs: DataFrame, classes: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """``id`` of every later set of ``pairs`` (``id2``) that the earlier one matches, by their whole sets."""
    ids = pairs.select(F.explode(F.array("id1", "id2")).alias("id")).distinct()
    ends = stored(classes.select("id", "first").join(ids, "id", "left_semi").select("id", "first.*"), "line-ends")
    doc, place = F.xxhash64("doc_id"), F.xxhash64("doc_id", "h", "line")
    near = among(docs.withColumn("key", doc), ends.select(doc.alias("key"))).select("doc_id", "text")
    texts = among(_lines(near).withColumn("key", place), ends.select(place.alias("key")))
    named = ends.select("id", *(F.col(c).alias(f"_{c}") for c in _PLACE))
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("h") == F.col("_h")) & (F.col("line") == F.col("_line"))
    sets = texts.join(named, same).select("id", words(F.col("text")).alias("tokens"))
    sets = stored(sets.groupBy("id").agg(F.any_value("tokens").alias("tokens")), "line-sets")
    one, two = (sets.select(*(F.col(c).alias(f"{c}{i}") for c in sets.columns)) for i in (1, 2))
    both = pairs.join(one, "id1").join(two, "id2")
    common = F.size(F.array_intersect("tokens1", "tokens2"))
    links = both.filter(common * (100 + percent) >= (F.size("tokens1") + F.size("tokens2")) * percent)
    return links.select(F.col("id2").alias("id")).distinct()


def removals(docs: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """``(doc_id, h, line)`` of every line that an earlier one matches.

    Earlier means a smaller ``doc_id`` (null last), then text hash, then line number.
    The first place of a set goes if the first place of any similar set comes before it;
    all its later places go in any case.
    """
    docs = docs.select("doc_id", "text")
    with shuffles_dropped(docs.sparkSession):
        sets = stored(line_sets(docs, percent).filter(F.col("n") >= min_words), "line-words")
        slices = min(MOST_SLICES, 1 + sets.count() // SLICE_LINES)
        classes = stored(line_classes(sets), "line-classes")
        facts = keyed(sets, classes, slices)
        lines = stored(sets.select(*_PLACE, "a", "b"), "lines")
        discard(sets)
        shared = together([stored(alike(facts, slices, s, percent), "line-shared") for s in range(slices)])
        pairs = stored(led(shared), "line-pairs")
        gone = stored(matched(docs, classes, pairs, percent), "line-gone")
        rest = stored(rest_of(shared, facts, gone), "line-rest")
        discard(facts)
        discard(shared)
        parts = [rest.filter(of_slice("key", slices, s)) for s in range(slices)]
        found = together([stored(others(part, percent), "line-found") for part in parts])
        discard(rest)
        later = stored(found.distinct().join(pairs, ["id1", "id2"], "left_anti"), "line-pairs")
        gone = stored(gone.unionByName(matched(docs, classes, later, percent)).distinct(), "line-gone")
        known = classes.select("id", "a", "b", "first", "copies").join(gone.withColumn("gone", F.lit(True)), "id", "left")
        affected = stored(known.filter("copies > 1 OR gone").select("a", "b", "first", "gone"), "line-affected")
    place = F.struct(*_PLACE)
    found = lines.select(*_PLACE, "a", "b").join(affected, ["a", "b"])
    return found.filter(F.col("gone") | (place != F.col("first"))).select("doc_id", "h", "line")


def without_lines(docs: DataFrame, removed: DataFrame) -> DataFrame:
    """``docs`` with the lines of ``removed`` taken out of ``text``; other columns as they are.

    A text with nothing to remove, null included, is unchanged.
    """
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    text, key = F.col(f"c{names.index('text')}"), F.col(f"c{names.index('doc_id')}")
    lists = removed.groupBy("doc_id", "h").agg(F.collect_set("line").alias("out"))
    joined = plain.withColumn("own", F.xxhash64(filled(text))).join(
        lists, key.eqNullSafe(F.col("doc_id")) & (F.col("own") == F.col("h")), "left"
    )
    kept = F.filter(F.split(text, "\n"), lambda line, i: ~F.array_contains("out", i))
    cleaned = F.when(F.col("out").isNull(), text).otherwise(F.array_join(kept, "\n"))
    return joined.withColumn(f"c{names.index('text')}", cleaned).select([f"c{i}" for i in range(len(names))]).toDF(*names)


def report(docs: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """Per row of ``(doc_id, text)``: ``doc_id, n_lines, n_removed, removed``.

    ``removed`` holds the numbers of the removed lines (from 0), joined by commas. A null
    text is one empty line. Rows alike in ``doc_id`` and text are one document.
    """
    lists = removals(docs, percent, min_words).groupBy("doc_id", "h").agg(F.sort_array(F.collect_set("line")).alias("out"))
    rows = docs.select(
        "doc_id", F.xxhash64(filled()).alias("h"), F.size(F.split(filled(), "\n")).cast("long").alias("n_lines")
    )
    own = F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("g") == F.col("h"))
    joined = rows.join(lists.toDF("d", "g", "out"), own, "left")
    out = F.coalesce("out", F.array().cast("array<int>"))
    return joined.select(
        "doc_id", "n_lines", F.size(out).cast("long").alias("n_removed"), F.array_join(out.cast("array<string>"), ",").alias("removed")
    )
