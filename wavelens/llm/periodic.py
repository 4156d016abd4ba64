"""Periodic runs of words: repeats side by side, three times and more, found exactly.

A run is a stretch of words with smallest period ``q`` that no neighbouring word extends.
Suffixes of a text are sorted, and neighbours in that order joined by decreasing length
of their common prefix, as Kruskal's algorithm joins nodes: a union-find keeps, for each
class of suffixes, its positions in order. When classes meet at length ``l``, positions
that become neighbours at distance ``d`` start the same ``l`` words, so where ``l >= 2 d``
they seed a run of length ``l + d``. The start of every such run and the place one period
on are neighbours the moment they meet (a position between would make the period smaller),
so each run is seeded once, with its smallest period, and is whole to its right; it counts
if the words before both differ.

A run of 24 words and three periods repeats 16 words, so texts in which no stretch of 16
words comes twice (told by a rolling hash, which may only let too much through) have none.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from wavelens.llm.common import arrow_map, slices

#: Least length of a run in words, and least number of its periods.
LEAST_WORDS = 24
LEAST_PERIODS = 3


def suffix_order(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and the rank of each, by doubling the length compared."""
    _, rank = np.unique(words, return_inverse=True)
    rank = rank.astype(np.int64)
    n, step = len(rank), 1
    while True:
        after = np.zeros(n, np.int64)
        after[: max(n - step, 0)] = rank[step:] + 1
        pair = rank * (n + 1) + after
        order = np.argsort(pair, kind="stable")
        new = np.zeros(n, np.int64)
        new[order[1:]] = np.cumsum(np.diff(pair[order]) != 0)
        rank, step = new, step * 2
        if n == 0 or rank[order[-1]] == n - 1:
            return order, rank


def common_prefixes(words: np.ndarray, order: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Words that each suffix shares with the one before it in the order; linear."""
    out = np.zeros(len(words), np.int64)
    text, at, place = words.tolist(), order.tolist(), rank.tolist()
    n, length = len(text), 0
    for i in range(n):
        if not place[i]:
            length = 0
            continue
        j = at[place[i] - 1]
        most = n - max(i, j)
        while length < most and text[i + length] == text[j + length]:
            length += 1
        out[place[i]] = length
        length -= length > 0
    return out


class Classes:
    """Union-find over the places of a suffix order; each class has its positions sorted."""

    def __init__(self, order: Sequence[int]):
        self.up = list(range(len(order)))
        self.positions: list[list[int] | None] = [[p] for p in order]

    def find(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> list[tuple[int, int]]:
        """Put two classes together; pairs of positions, one of each, that become neighbours."""
        a, b = self.find(i), self.find(j)
        big, small = (a, b) if len(self.positions[a]) >= len(self.positions[b]) else (b, a)
        held, moved = self.positions[big], self.positions[small]
        self.up[small], self.positions[small] = big, None
        at = [bisect_left(held, p) for p in moved]
        met = []
        for k, (p, i) in enumerate(zip(moved, at, strict=True)):
            if i and (k == 0 or at[k - 1] != i):
                met.append((held[i - 1], p))
            if i < len(held) and (k + 1 == len(at) or at[k + 1] != i):
                met.append((p, held[i]))
        if len(moved) > 8:
            held += moved
            held.sort()  # two sorted stretches: one merge
        else:
            for p, i in zip(reversed(moved), reversed(at), strict=True):
                held.insert(i, p)
        return met


def runs(words: np.ndarray, least: int = LEAST_WORDS, periods: int = LEAST_PERIODS) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of all runs of a sequence of numbers, sorted."""
    order, rank = suffix_order(words)
    shared = common_prefixes(words, order, rank)
    least_shared = shared_words(least, periods)
    places = np.flatnonzero(shared >= least_shared)
    places = places[np.argsort(-shared[places], kind="stable")]
    text, classes, found = words, Classes(order.tolist()), []
    for place, length in zip(places.tolist(), shared[places].tolist(), strict=True):
        for i, j in classes.join(place - 1, place):
            d = j - i
            if length >= (periods - 1) * d and length + d >= least and (i == 0 or text[i - 1] != text[j - 1]):
                found.append((i, length + d, d))
    return sorted(found)


def shared_words(least: int, periods: int) -> int:
    """Words that the start of any run shares with the place one period on, at least."""
    return min(max(least - d, (periods - 1) * d) for d in range(1, least + 1))


def repeats(numbers: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """Which sequences (between ``starts``) may hold a stretch of ``width`` words twice."""
    out = np.zeros(len(starts) - 1, bool)
    n = len(numbers) - width + 1
    if n <= 1:
        return out
    with np.errstate(over="ignore"):
        base = np.uint64(0x9E3779B97F4A7C15)
        mixed = (numbers.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        rolled, size = mixed, 1
        power = base
        total, done = None, 0
        left = width
        while left:  # stretches of 1, 2, 4, … words, put together to ``width``
            if left & 1:
                if total is None:
                    total = rolled
                else:
                    m = min(len(total), len(rolled) - done)
                    total = total[:m] * power + rolled[done : done + m]
                done += size
            left >>= 1
            if left:
                rolled = rolled[: len(rolled) - size] * power + rolled[size:]
                size, power = size * 2, power * power
        owner = np.searchsorted(starts, np.arange(n), side="right") - 1
        inside = np.arange(n) + width <= starts[owner + 1]
        keys = (total[:n] ^ (owner.astype(np.uint64) * np.uint64(0xA24BAED4963EE407)))[inside]
    owner = owner[inside]
    order = np.argsort(keys, kind="stable")
    twice = keys[order][1:] == keys[order][:-1]
    same = owner[order][1:] == owner[order][:-1]
    out[owner[order][1:][twice & same]] = True
    return out


def kept_words(n: int, found: Iterable[tuple[int, int, int]]) -> np.ndarray:
    """Which words stay when every run is cut to its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in found:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:n]) == 0


def strongest(found: Sequence[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length over period; then the first, then the shortest period."""
    best = None
    for run in found:
        if best is None:
            best = run
            continue
        more = run[1] * best[2] - best[1] * run[2]
        if more > 0 or (more == 0 and (run[0], run[2]) < (best[0], best[2])):
            best = run
    return best


def altered(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """Words of a document, made periodic from some place on for one identifier in ten.

    Which, where and with what period follow from the CRC-32 of the decimal identifier;
    a document without one is left as it is.
    """
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


SCHEMA = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string"
)


def _sequences(batch: pa.RecordBatch, alter: bool) -> Iterator[tuple[int | None, list[bytes], list[tuple[int, int, int]]]]:
    """``(doc_id, words, runs)`` of every row of ``(doc_id, text)``."""
    ids = batch.column(0).to_pylist()
    texts = [(t or b"").split() for t in batch.column(1).cast(pa.binary()).to_pylist()]
    if alter:
        texts = [altered(t, d) for t, d in zip(texts, ids, strict=True)]
    known: dict[bytes, int] = {}
    starts = np.cumsum([0, *map(len, texts)])
    numbers = np.fromiter((known.setdefault(w, len(known)) for t in texts for w in t), np.int64, starts[-1])
    maybe = repeats(numbers, starts, shared_words(LEAST_WORDS, LEAST_PERIODS))
    for i, (doc, text) in enumerate(zip(ids, texts, strict=True)):
        yield doc, text, runs(numbers[starts[i] : starts[i + 1]]) if maybe[i] else []


def report(docs: DataFrame, alter: bool = False) -> DataFrame:
    """Per row of ``(doc_id, text)``: its runs, the strongest, and digests.

    ``doc_id, n_runs``; ``start, length, period, exponent_milli`` of the strongest run
    (null without one); ``runs_sha256`` of all runs, ``collapsed_sha256`` of the words left.
    Null and empty texts have no words; rows that repeat each have their own result. With
    ``alter``, one document in ten is made periodic first, as :func:`altered` says.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(f.split()[0], pa.string() if f.endswith("string") else pa.int64()) for f in SCHEMA.split(", ")])
        for batch in batches:
            for part in slices(batch, "text"):
                rows = []
                for doc, text, found in _sequences(part, alter):
                    best = strongest(found)
                    start, length, period = best or (None, None, None)
                    listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
                    stay = kept_words(len(text), found).tolist() if found else None
                    left = text if stay is None else [w for w, k in zip(text, stay, strict=True) if k]
                    rows.append((
                        doc, len(found), start, length, period, 1000 * length // period if best else None,
                        hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(left)).hexdigest(),
                    ))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return arrow_map(docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")), run, SCHEMA)


def collapse(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every run of ``text`` cut to its first period; same rows and columns.

    Texts with a run come back as their remaining words joined by one space; all others,
    null included, are unchanged.
    """
    names = docs.columns
    at = names.index(text)
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    body = f"c{at}"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, body):
                column = part.column(at)
                pairs = pa.RecordBatch.from_arrays([pa.nulls(part.num_rows, pa.int64()), column], ["doc_id", "text"])
                out = column.to_pylist()
                for i, (_, words, found) in enumerate(_sequences(pairs, False)):
                    if found:
                        stay = kept_words(len(words), found).tolist()
                        out[i] = b" ".join(w for w, k in zip(words, stay, strict=True) if k).decode()
                yield part.set_column(at, part.schema.field(at), pa.array(out, column.type))

    return arrow_map(plain, run, plain.schema).toDF(*names)
