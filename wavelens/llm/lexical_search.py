"""Ranked lexical search by one automaton over all terms of the items.

No document is indexed. The terms of all items, each between two guards, are one
Aho-Corasick automaton, which is broadcast; a text, with every byte outside a term turned
into a guard, goes through it once, and what it finds are whole terms with their counts.
The corpus counts follow from what the documents found, and a second pass over these
counts alone scores documents: the automaton's outputs map to the items that have the
term. Each task holds the best ``k`` documents of each item and hands on only these.

The automaton is bounded: items are taken in blocks of at most ``BLOCK_TERMS`` terms and
``BLOCK_ITEMS`` items (counted before), one pass over the documents each.
"""

from __future__ import annotations

import math
import pickle
from collections import Counter
from collections.abc import Iterable, Iterator
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wavelens.llm.common import arrow_map, filled, int_lists, slices
from wavelens.session import stored

TOP = 50
BLOCK_TERMS = 1 << 18
BLOCK_ITEMS = 1 << 14
#: Scores and steps of one chunk inside a scoring task.
CHUNK = 1 << 21
#: Parts that the candidates of one item are dealt over before its final ranking.
PARTS = 64

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes of terms (letters in lower case, digits, all above ASCII); any other is a guard.
BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_IS_TERM = np.array([b != 32 for b in BYTES])
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def item_terms(items: DataFrame) -> DataFrame:
    """``(item_id, term)``, each pair once; rows of one ``item_id`` are one item."""
    found = F.regexp_extract_all(F.translate(filled(), _UPPER, _LOWER), F.lit(TERM), F.lit(0))
    return items.select("item_id", F.explode(F.array_distinct(found)).alias("term")).distinct()


def guarded(text: bytes) -> str:
    """A text with guards between terms and at both ends, one character per byte."""
    return (b" " + text.translate(BYTES) + b" ").decode("latin-1")


def automaton(terms: list[str]) -> ahocorasick.Automaton:
    """Finds every one of ``terms`` that stands between guards, and tells its number."""
    found = ahocorasick.Automaton()
    for number, term in enumerate(terms):
        found.add_word(f" {term.encode().decode('latin-1')} ", number)
    found.make_automaton()
    return found


def n_terms(text: bytes) -> int:
    inside = _IS_TERM[np.frombuffer(text, np.uint8)]
    return int(np.count_nonzero(inside[1:] & ~inside[:-1])) + bool(len(inside) and inside[0])


def counts(docs: DataFrame, terms: list[str]) -> DataFrame:
    """``(doc_id, n, terms, tf)`` of every text with a term; numbers of found ``terms``."""
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(automaton(terms)) if terms else b"")
    names = ["doc_id", "n", "terms", "tf"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = pickle.loads(shared.value) if shared.value else None
        number = itemgetter(1)
        for batch in batches:
            for part in slices(batch, "text"):
                texts = [t or b"" for t in part.column(1).cast(pa.binary()).to_pylist()]
                sizes = [n_terms(t) for t in texts]
                found = [Counter(map(number, finder.iter(guarded(t)))) if finder and n else {} for t, n in zip(texts, sizes, strict=True)]
                lists = [[np.fromiter(x, np.int32, len(f)) for f in found for x in (values(f),)] for values in (dict.keys, dict.values)]
                out = [part.column(0), pa.array(sizes, pa.int64()), int_lists(lists[0]), int_lists(lists[1])]
                rows = pa.RecordBatch.from_arrays(out, names)
                yield rows.filter(pa.array([n > 0 for n in sizes], pa.bool_()))

    schema = T.StructType([
        docs.schema["doc_id"], T.StructField("n", T.LongType()),
        T.StructField("terms", T.ArrayType(T.IntegerType())), T.StructField("tf", T.ArrayType(T.IntegerType())),
    ])
    return arrow_map(docs.select("doc_id", F.col("text").cast("string").alias("text")), run, schema)


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


class Best:
    """The ``k`` best documents of each item so far: greatest score, then smallest id."""

    def __init__(self, k: int):
        self.k = k
        self.rows = [np.zeros(0, np.int64) for _ in range(4)]  # item, score, id is null, id

    def add(self, *rows: np.ndarray) -> None:
        item, score, none, doc = (np.concatenate(x) for x in zip(self.rows, rows, strict=True))
        order = np.lexsort((doc, none, -score, item))
        item = item[order]
        first = np.searchsorted(item, item)  # place where the item begins
        keep = order[np.arange(len(order)) - first < self.k]
        self.rows = [x[keep] for x in (np.concatenate(y) for y in zip(self.rows, rows, strict=True))]

    def least(self, items: int) -> np.ndarray:
        """Score that a document needs at least to come among the best of each item."""
        item, score = self.rows[:2]
        out = np.ones(items, np.int64)
        sizes = np.bincount(item, minlength=items)
        lowest = np.full(items, np.iinfo(np.int64).max)
        np.minimum.at(lowest, item, score)
        full = sizes >= self.k
        out[full] = lowest[full]
        return out


def _scores(found: DataFrame, weights: np.ndarray, starts: np.ndarray, members: np.ndarray, items: int, total: int, length: int, k: int) -> DataFrame:
    """Best ``k`` documents per item and task: ``(item, doc_id, score)``.

    ``members[starts[t]:starts[t + 1]]`` are the items that have term ``t``.
    """
    shared = found.sparkSession.sparkContext.broadcast((weights, starts, members))
    empty = pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, starts, members = shared.value
        spread = np.diff(starts)
        best = Best(k)
        for batch in batches:
            terms = batch.column(2)
            sizes = np.asarray(terms.value_lengths(), np.int64)
            term = np.asarray(terms.flatten(), np.int64)
            tf = np.asarray(batch.column(3).flatten(), np.int64)
            n = np.asarray(batch.column(1), np.int64)
            none = np.asarray(batch.column(0).is_null(), np.int64)
            ids = np.asarray(batch.column(0).fill_null(0), np.int64)
            m = 50 + (50 * n * total) // length
            row = np.repeat(np.arange(batch.num_rows), sizes)
            part = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[row]))
            steps = np.concatenate([[0], np.cumsum(np.bincount(row, spread[term], minlength=batch.num_rows).astype(np.int64))])
            ends = np.concatenate([[0], np.cumsum(sizes)])
            begin = 0
            while begin < batch.num_rows:
                most = min(begin + max(CHUNK // items, 1), batch.num_rows)
                end = int(np.searchsorted(steps, steps[begin] + CHUNK, side="right")) - 1
                end = max(min(end, most), begin + 1)
                some = slice(ends[begin], ends[end])
                score = np.zeros((end - begin) * items, np.int64)
                times = spread[term[some]]
                first = np.repeat(starts[term[some]] - np.concatenate([[0], np.cumsum(times)[:-1]]), times) if len(times) else np.zeros(0, np.int64)
                item = members[first + np.arange(len(first))]
                np.add.at(score, np.repeat((row[some] - begin) * items, times) + item, np.repeat(part[some], times))
                score = score.reshape(end - begin, items)
                doc, item = np.nonzero(score >= best.least(items)[None, :])
                best.add(item, score[doc, item], none[begin:end][doc], ids[begin:end][doc])
                begin = end
        item, score, none, doc = best.rows
        ids = pa.array(doc, pa.int64(), mask=none.astype(bool))
        yield pa.RecordBatch.from_arrays([pa.array(item.astype(np.int32)), ids, pa.array(score)], schema=empty)

    return arrow_map(found.select(F.col("doc_id").cast("long").alias("doc_id"), "n", "terms", "tf"), run, "item int, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = TOP, block_terms: int = BLOCK_TERMS, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """The ``k`` best documents of ``(doc_id, text)`` for each item of ``(item_id, text)``.

    ``item_id, rank, doc_id, score``, scores above 0 only, equal ones by ascending
    ``doc_id`` (null last). Null and empty texts have no terms, so such documents are
    never found and such items have no rows. Rows that repeat a ``doc_id`` are ranked
    each; rows of one ``item_id``, null too, are one item.
    """
    docs, items = docs.select("doc_id", "text"), items.select("item_id", "text")
    pairs = stored(item_terms(items), "item-terms")
    n_items, n_pairs = pairs.agg(F.count_distinct(F.struct("item_id")), F.count(F.lit(1))).first()
    blocks = max(1, math.ceil(n_items / block_items), math.ceil(n_pairs / block_terms))
    out = None
    for block in range(blocks):
        part = pairs.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        ranked = _ranked(docs, part, k)
        out = ranked if out is None else out.unionByName(ranked)
    return out


def _ranked(docs: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    spark = docs.sparkSession
    held = pairs.groupBy("item_id").agg(F.sort_array(F.collect_set("term")).alias("terms")).collect()
    names = spark.createDataFrame(
        [(i, r["item_id"]) for i, r in enumerate(held)], T.StructType([T.StructField("item", T.IntegerType()), pairs.schema["item_id"]])
    )
    terms = sorted({t for r in held for t in r["terms"]})
    number = {t: i for i, t in enumerate(terms)}
    found = stored(counts(docs, terms), "term-counts")
    total, length = found.agg(F.count(F.lit(1)), F.sum("n")).first()
    holding = {r["term"]: r["df"] for r in found.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).collect()}
    weights = np.array([weight(total, holding[t]) if t in holding else 0 for t in range(len(terms))], np.int64)
    term, item = np.array([(number[t], i) for i, r in enumerate(held) for t in r["terms"]], np.int64).reshape(-1, 2).T
    members = item[np.argsort(term, kind="stable")]
    starts = np.concatenate([[0], np.cumsum(np.bincount(term, minlength=len(terms)))])
    best = _scores(found, weights, starts, members, max(len(held), 1), total, length or 1, k)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    best = best.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)))
    for keys in (["item", "part"], ["item"]):
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("rank") <= k)
    return best.join(names, "item").select("item_id", "rank", "doc_id", "score")
