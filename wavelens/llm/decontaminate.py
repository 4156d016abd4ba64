"""Benchmark decontamination by a broadcast set of the items' word windows.

Items are cut into windows of consecutive words; a document's windows are looked up by
hash in the broadcast set, and a hit counts only if its words are equal. Everything is
DataFrame functions. A window's hash is put together from those of words, pairs, fours
and eights, so that each is made once per place, whatever the length of a window.

The set is broadcast in blocks of at most ``BLOCK_BYTES``, measured before; each block
is one more pass over the documents. Rows of documents move once, with their hits alone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavelens.llm.common import filled
from wavelens.session import stored

WINDOW = 10
#: Bytes of windows, their words and item lists, that are broadcast at once.
BLOCK_BYTES = 32 << 20
#: Bytes a window takes besides its words and items: hash, sizes, headers.
ROW_BYTES = 96

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = "".join(chr(c) for c in range(128) if not chr(c).isalnum())
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
RANGES = "array<struct<start:int,end:int>>"


def words(text: Column) -> Column:
    """Words of a text, A-Z in lower case; a null text has none."""
    spaced = F.translate(filled(text), _UPPER + _BETWEEN, _LOWER + " " * len(_BETWEEN))
    return F.filter(F.split(spaced, " "), lambda w: w != "")


def _joined(left: Column, right: Column, shift: int) -> Column:
    """Hash of each entry of ``left`` with the entry of ``right`` that is ``shift`` further on."""
    moved = F.slice(right, F.lit(shift + 1), F.greatest(F.size(right) - shift, F.lit(0)))
    return F.zip_with(left, moved, lambda a, b: F.xxhash64(a, b))


def with_windows(df: DataFrame, sizes: list[int]) -> DataFrame:
    """Add ``w<size>``, hashes of all windows of each size over the column ``words``."""
    powers = [1 << k for k in range(max(sizes).bit_length())] if sizes else []
    for p in powers:
        hashes = F.transform("words", lambda w: F.xxhash64(w)) if p == 1 else _joined(F.col(f"p{p // 2}"), F.col(f"p{p // 2}"), p // 2)
        df = df.withColumn(f"p{p}", hashes)
    for size in sizes:
        parts = [p for p in reversed(powers) if size & p]
        whole, length = F.col(f"p{parts[0]}"), parts[0]
        for p in parts[1:]:
            whole, length = _joined(whole, F.col(f"p{p}"), length), length + p
        df = df.withColumn(f"w{size}", F.slice(whole, F.lit(1), F.greatest(F.size("words") - (size - 1), F.lit(0))))
    return df.drop(*[f"p{p}" for p in powers])


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(hash, size, item_words, items)`` of every different window of ``(item_id, text)``.

    An item of fewer words than a window is one window; without words it has none. Rows
    of one ``item_id`` are one item, and a null ``item_id`` is the item ``''``.
    """
    named = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words(F.col("text")).alias("words"))
    size = F.least(F.size("words"), F.lit(window))
    places = F.sequence(F.lit(1), F.size("words") - size + 1)
    cut = named.filter(F.size("words") > 0).select(
        "item", size.alias("size"), F.explode(F.transform(places, lambda i: F.slice("words", i, size))).alias("item_words")
    )
    lists = cut.groupBy("size", "item_words").agg(F.sort_array(F.collect_set("item")).alias("items"))
    return lists.withColumnRenamed("item_words", "words")


def _hashed(lists: DataFrame, size: int) -> DataFrame:
    rows = with_windows(lists.filter(F.col("size") == size), [size])
    return rows.select(F.element_at(f"w{size}", 1).alias("hash"), "size", F.col("words").alias("item_words"), "items")


def find(docs: DataFrame, items: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(doc_id, key, n_words, ranges, items)`` for every row of ``(doc_id, text)``.

    ``ranges`` are the stretches of words (numbered from 0, end exclusive) inside any
    occurrence of a window, in order and apart; ``items`` the items with occurring
    windows, sorted. ``key`` is a hash of the text. Null, empty and wordless texts have
    no ranges; rows that repeat each have their own result; without items nothing is hit.
    """
    spark = docs.sparkSession
    lists = stored(item_windows(items.select("item_id", "text"), window), "item-windows")
    width = F.aggregate(F.concat("words", "items"), F.lit(ROW_BYTES), lambda n, x: n + F.octet_length(x) + 24)
    facts = lists.groupBy("size").agg(F.sum(width.cast("long")).alias("bytes")).collect()
    sizes = sorted((r["size"] for r in facts), reverse=True)
    blocks = max(1, math.ceil(sum(r["bytes"] for r in facts) / block_bytes))
    rows = docs.select(
        "doc_id", F.xxhash64(filled()).alias("key"), F.monotonically_increasing_id().alias("row"), words(F.col("text")).alias("words")
    )
    rows = with_windows(rows, sizes)
    count = {s: F.size(f"w{s}") for s in sizes}
    last = sum((count[s] for s in sizes), F.lit(0))
    # one more entry without a hash brings every document through the join
    all_hashes = F.concat(*[F.col(f"w{s}") for s in sizes], F.array(F.lit(None).cast("long")))
    places = rows.select("doc_id", "key", "row", "words", last.alias("last"), *[c.alias(f"n{s}") for s, c in count.items()],
                         F.posexplode(all_hashes).alias("at", "hash"))
    windows = None
    for s in sizes:
        part = _hashed(lists, s)
        windows = part if windows is None else windows.unionByName(part)
    if windows is None:
        windows = spark.createDataFrame([], "hash long, size int, item_words array<string>, items array<string>")
    before, offsets = F.lit(0), F.lit(None).cast("int")
    for s in sizes:
        offsets = F.coalesce(F.when(F.col("size") == s, before), offsets)
        before = before + F.col(f"n{s}")
    hits = None
    for block in range(blocks):
        mine = windows.filter(F.pmod("hash", F.lit(blocks)) == block).withColumnRenamed("hash", "item_hash")
        met = places.join(F.broadcast(mine), F.col("hash") == F.col("item_hash"), "left")
        met = met.withColumn("start", F.col("at") - offsets)
        same = F.slice("words", F.col("start") + 1, F.col("size")) == F.col("item_words")
        real = F.coalesce((F.col("start") >= 0) & same, F.lit(False))
        whole = (F.col("at") == F.col("last")) if block == 0 else F.lit(False)
        found = met.filter(real | whole).select(
            "row", "doc_id", "key", F.when(F.col("at") == F.col("last"), F.size("words")).alias("n_words"),
            F.when(real, F.struct("start", (F.col("start") + F.col("size")).alias("end"))).alias("range"), "items",
        )
        hits = found if hits is None else hits.unionByName(found)
    grouped = hits.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("key").alias("key"), F.max("n_words").cast("long").alias("n_words"),
        F.sort_array(F.collect_list("range")).alias("found"), F.collect_set("items").alias("lists"),
    )
    return grouped.select(
        "doc_id", "key", "n_words", _merged(F.col("found")).alias("ranges"),
        F.array_sort(F.array_distinct(F.flatten("lists"))).alias("items"),
    )


def _merged(found: Column) -> Column:
    """Sorted ranges with those that touch or overlap made one."""
    empty = F.struct(F.array().cast(RANGES).alias("done"), F.lit(-1).alias("start"), F.lit(-1).alias("end"))

    def closed(state: Column) -> Column:
        one = F.array(F.struct(state["start"].alias("start"), state["end"].alias("end")))
        return F.when(state["end"] < 0, state["done"]).otherwise(F.concat(state["done"], one))

    def step(state: Column, x: Column) -> Column:
        apart = x["start"] > state["end"]
        return F.struct(
            F.when(apart, closed(state)).otherwise(state["done"]).alias("done"),
            F.when(apart, x["start"]).otherwise(state["start"]).alias("start"),
            F.greatest(state["end"], x["end"]).alias("end"),
        )

    return F.aggregate(found, empty, step, closed)


def n_hit(ranges: str = "ranges") -> Column:
    return F.aggregate(ranges, F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])


def report(docs: DataFrame, items: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``."""
    return find(docs, items, window, block_bytes).select(
        "doc_id", "n_words", n_hit().alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("ranges") > 0).alias("contaminated"),
    )


def without_words(text: Column, ranges: Column) -> Column:
    """The text without the words of ``ranges`` and what separates each from the word before."""
    pieces = F.zip_with(
        F.split(text, _WORD, -1), F.regexp_extract_all(text, F.lit(_WORD), F.lit(0)),
        lambda gap, word: F.concat(gap, F.coalesce(word, F.lit(""))),
    )  # the last piece is what follows the last word
    ends = F.concat(F.array(F.lit(0)), F.transform(ranges, lambda r: r["end"]))
    starts = F.concat(F.transform(ranges, lambda r: r["start"]), F.array(F.size(pieces)))
    kept = F.zip_with(ends, starts, lambda a, b: F.array_join(F.slice(pieces, a + 1, b - a), ""))
    return F.array_join(kept, "")


def decontaminate(docs: DataFrame, items: DataFrame, remove: str = "spans", text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` without benchmark passages: their words (``spans``) or whole ``documents``.

    Same columns, whatever they are called; rows that hit nothing, null and empty texts
    among them, are unchanged. Rows alike in ``key`` and text are hit alike.
    """
    if remove not in ("spans", "documents"):
        raise ValueError(f"remove spans or documents, not {remove}")
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    own, body = F.col(f"c{names.index(key)}"), F.col(f"c{names.index(text)}")
    found = find(plain.select(own.alias("doc_id"), body.alias("text")), items).filter(F.size("ranges") > 0)
    hit = found.groupBy("doc_id", "key").agg(F.first("ranges").alias("ranges"))
    same = own.eqNullSafe(F.col("doc_id")) & (F.col("own") == F.col("key"))
    plain = plain.withColumn("own", F.xxhash64(filled(body)))
    columns = [f"c{i}" for i in range(len(names))]
    if remove == "documents":
        return plain.join(hit, same, "left_anti").select(columns).toDF(*names)
    joined = plain.join(hit, same, "left")
    cleaned = F.when(F.col("ranges").isNull(), body).otherwise(without_words(body, F.col("ranges")))
    return joined.withColumn(f"c{names.index(text)}", cleaned).select(columns).toDF(*names)
