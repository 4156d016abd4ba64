"""Near-duplicate documents by an inverted join over MinHash coordinates.

A document is the set of its word shingles, and its signature holds the smallest value
of the set under each of ``COORDINATES`` hash functions. Two sets of similarity ``s``
agree in a coordinate with probability ``s``, so links agree in at least ``MATCHES`` of
them but for a few in 100,000.

1. Documents with the same set are one class; classes with the same signature are one
   vertex of the join.
2. Every vertex is posted under its coordinate-value pairs. A pair of vertices with
   ``MATCHES`` common pairs shares one of the ``COORDINATES - MATCHES + 1`` rarest of
   either, so only these are posted (prefix), the common ones are skipped, and a vertex
   with too few pairs that anybody else has is in no list at all.
3. In each list, collisions of all coordinates are counted. Only a spanning forest of
   the pairs above the match threshold leaves the task: the trees, put together, are
   families that no link can leave.
4. Within families, links are confirmed on the full sets, in blocks of bounded size.
   Blocks of a large family are first compared within themselves, with one member of the
   family in all of them; after that, only what is still apart is compared across.

Joins of tables that grow with the documents are hinted to merge: Spark takes an array for
one element, an exploded table for the one before it and a stored one for its compressed
files, and would broadcast tables many times as large as its threshold through the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavelens.llm.common import arrow_map, map_groups, salted_join, slices
from wavelens.llm.components import Forest, components
from wavelens.session import stored

WORDS = 5
PERCENT = 80
COORDINATES = 32
MATCHES = 16
#: Largest block of a posting list, and of a family.
LIST_BLOCK = 1024
FAMILY_BLOCK = 256

_U = np.uint64
_LOWER = bytes(range(256)).lower()  # A-Z only: bytes of other letters stay
_RNG = np.random.default_rng(20)
_BYTES = _RNG.integers(1, 1 << 63, 256, dtype=_U)
_BASE = int(_RNG.integers(1, 1 << 62)) * 2 + 1
_STEP = _U(int(_RNG.integers(1, 1 << 62)) * 2 + 1)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits in which every bit depends on all."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def coordinate_hashes(k: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers and offsets of ``k`` hash functions, the same everywhere."""
    rng = np.random.default_rng(k)
    return rng.integers(1, 1 << 62, k, dtype=_U) * _U(2) + _U(1), rng.integers(0, 1 << 63, k, dtype=_U)


_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        out = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(n, base, _U)
            steps[0] = 1
            out.append(np.multiply.accumulate(steps))
        _POWERS[:] = out
    return _POWERS[0], _POWERS[1]


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of the words between ASCII blanks, in order."""
    data = np.frombuffer(text, np.uint8)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate(([True], blank, [True])).astype(np.int8)))
    begin, end = edge[::2], edge[1::2]
    if not len(begin):
        return np.empty(0, _U)
    out = np.zeros(len(begin), _U)
    first = 0
    while first < len(begin):  # a long text in parts, so that its arrays stay small
        last = max(first + 1, int(np.searchsorted(end, begin[first] + (1 << 20), side="right")))
        a, b = int(begin[first]), int(end[last - 1])
        up, down = _powers(max(1 << 16, b - a))
        total = np.zeros(b - a + 1, _U)
        np.cumsum(_BYTES[data[a:b]] * up[: b - a], out=total[1:])
        x, y = begin[first:last] - a, end[first:last] - a
        out[first:last] = _mix((total[y] - total[x]) * down[x] + (y - x).astype(_U))
        first = last
    return out


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``words`` words; of all words if fewer."""
    each = word_hashes((text or "").encode().translate(_LOWER))
    n = min(words, len(each))
    if not n:
        return np.empty(0, _U)
    total = np.zeros(len(each) - n + 1, _U)
    for i in range(n):
        total = total * _STEP + each[i : len(each) - n + 1 + i]
    return np.unique(_mix(total + _U(n)))


def signatures(docs: DataFrame, words: int = WORDS, k: int = COORDINATES) -> DataFrame:
    """``(row, doc_id, n, set, sig)`` of ``(row, doc_id, text)``: set size, a 128-bit
    digest of the whole set, and its signature. An empty set has neither.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scale, shift = (x[:, None] for x in coordinate_hashes(k))
        for batch in batches:
            for part in slices(batch, "text"):
                sizes, digests, sigs = [], [], []
                for text in part.column(2).to_pylist():
                    found = shingle_set(text, words)
                    sizes.append(len(found))
                    digests.append(hashlib.blake2b(found, digest_size=16).digest() if len(found) else None)
                    sigs.append(_signature(found, scale, shift) if len(found) else None)
                columns = [pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(sigs, pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *columns], ["row", "doc_id", "n", "set", "sig"])

    kept = docs.select("row", "doc_id", F.col("text").cast("string").alias("text"))
    kind = kept.schema["doc_id"].dataType.simpleString()
    return arrow_map(kept, run, f"row long, doc_id {kind}, n long, set binary, sig array<int>")


def _signature(found: np.ndarray, scale: np.ndarray, shift: np.ndarray) -> np.ndarray:
    low = np.full(len(scale), ~_U(0))
    for i in range(0, len(found), 4096):
        np.minimum(low, (found[i : i + 4096] * scale + shift).min(axis=1), out=low)
    return (low >> _U(32)).astype(np.uint32).view(np.int32)


def postings(vertices: DataFrame, k: int, matches: int) -> DataFrame:
    """``(key, n, row)``: each vertex under its rarest coordinate-value pairs.

    ``n`` is how many vertices have the pair. Pairs of one vertex are the rarest of all
    and fill its prefix first, so only the others are looked up.
    """
    pair = F.shiftleft(F.col("i").cast("long"), 32).bitwiseOR(F.col("v").cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))
    pairs = vertices.select("row", F.posexplode("sig").alias("i", "v")).select("row", pair.alias("key"))
    shared = pairs.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    own = pairs.join(shared.hint("merge"), "key").groupBy("row").agg(F.sort_array(F.collect_list(F.struct("n", "key"))).alias("own"))
    prefix = F.size("own") - F.lit(matches - 1)
    return own.filter(F.size("own") >= matches).select(
        "row", F.explode(F.slice("own", F.lit(1), prefix)).alias("p")
    ).select("p.key", "p.n", "row")


def collisions(posted: DataFrame, vertices: DataFrame, matches: int, block: int = LIST_BLOCK) -> DataFrame:
    """Edges ``(a, b)``: a spanning forest, per list, of pairs with enough common coordinates.

    Lists above ``block`` are compared block against block, so a task holds two blocks.
    """
    blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = (
        posted.withColumn("blocks", blocks).withColumn("own", own).select("key", "row", "own", other)
        .select("key", "row", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"))
    )
    full = dealt.join(vertices.select("row", "sig").hint("merge"), "row").select("key", "x", "y", "row", "sig")

    def work(rows: pa.Table, starts: np.ndarray) -> pa.RecordBatch | None:
        node = np.asarray(rows.column("row"))
        sigs = rows.column("sig").combine_chunks()
        sigs = np.asarray(sigs.values).reshape(len(node), -1) if len(node) else np.empty((0, 1))
        return _edges(node, _agreeing(sigs, starts, matches))

    return map_groups(full, ["key", "x", "y"], work, "a long, b long").distinct()


def _edges(node: np.ndarray, found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch | None:
    if not found:
        return None
    a, b = (np.concatenate(x) for x in zip(*found, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(node[a]), pa.array(node[b])], ["a", "b"])


def _agreeing(sigs: np.ndarray, starts: np.ndarray, matches: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per group, a spanning forest of the pairs that agree in ``matches`` coordinates."""
    sizes = np.diff(starts)
    found = []
    small = sizes <= 8
    for step in range(1, 8):  # all small groups at once: every row with the one ``step`` later
        fits = small & (sizes > step)
        if not fits.any():
            break
        i = np.concatenate([np.arange(s, s + n - step) for s, n in zip(starts[:-1][fits], sizes[fits], strict=True)])
        i = i[(sigs[i] == sigs[i + step]).sum(1) >= matches]
        found.append((i, i + step))
    for s, n in zip(starts[:-1][~small], sizes[~small], strict=True):
        group, forest = sigs[s : s + n], Forest(n)
        left = np.arange(n)  # rows that are in no tree yet, and the roots of trees being grown
        while len(left):
            queue, left = [left[0]], left[1:]
            while queue and len(left):
                i = queue.pop()
                near = (group[left] == group[i]).sum(1) >= matches
                for j in left[near]:
                    forest.join(int(i), int(j))
                    queue.append(j)
                left = left[~near]
        if forest.edges:
            a, b = np.array(forest.edges).T
            found.append((a + s, b + s))
    return found


def linked(sets: list[np.ndarray], percent: int, labels: np.ndarray | None = None) -> list[tuple[int, int]]:
    """A spanning forest of all links among sets, by exact intersections.

    With ``labels``, sets of the same label count as joined already.
    """
    n = len(sets)
    forest = Forest(n)
    if labels is not None:
        for group in np.split(np.argsort(labels, kind="stable"), np.flatnonzero(np.diff(np.sort(labels))) + 1):
            for i in group[1:]:
                forest.join(int(group[0]), int(i))
        forest.edges.clear()
    sizes = np.array([len(s) for s in sets])
    if n <= 4:
        for i in range(n):
            for j in range(i + 1, n):
                if 100 * min(sizes[i], sizes[j]) < percent * max(sizes[i], sizes[j]) or forest.find(i) == forest.find(j):
                    continue
                common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if (100 + percent) * common >= percent * (sizes[i] + sizes[j]):
                    forest.join(i, j)
        return forest.edges
    common = _intersections(sets)
    near = (100 + percent) * common >= percent * (sizes[:, None] + sizes[None, :])
    for i, j in np.argwhere(np.triu(near, 1)):
        forest.join(int(i), int(j))
    return forest.edges


def _intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, by products of 0/1 matrices."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    values, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts > 1
    number = np.cumsum(shared) - 1
    picked = shared[inverse]
    owner, column = owner[picked], number[inverse[picked]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = np.zeros((n, n))
    width = 8192
    for start in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(column, [start, start + width])
        part = np.zeros((n, width), np.float32)
        part[owner[a:b], column[a:b] - start] = 1
        total += part @ part.T
    return total.astype(np.int64)


def _sets_of(rows: pa.Table) -> list[np.ndarray]:
    column = rows.column("shingles").combine_chunks()
    offsets, flat = np.asarray(column.offsets), np.asarray(column.values).view(_U)
    return [flat[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def full_sets(docs: DataFrame, members: DataFrame, words: int) -> DataFrame:
    """``(row, family, shingles)``: the whole sets of the members, from their texts."""
    ids = members.select(F.col("doc_id").alias("member"), "row", "family", "set")
    texts = docs.select("doc_id", "text").join(ids, F.col("doc_id").eqNullSafe(F.col("member")))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                row, family, digest, text = (c.to_pylist() for c in part.columns)
                kept = []
                for i, t in enumerate(text):
                    found = shingle_set(t, words)
                    # another text under the same identifier is not this member
                    if hashlib.blake2b(found, digest_size=16).digest() == digest[i]:
                        kept.append((row[i], family[i], found.view(np.int64)))
                if kept:
                    r, f, s = zip(*kept, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(r), pa.array(f), pa.array(s, pa.list_(pa.int64()))], ["row", "family", "shingles"]
                    )

    found = arrow_map(texts.select("row", "family", "set", "text"), run, "row long, family long, shingles array<long>")
    return found.dropDuplicates(["row"])


def confirm(sets: DataFrame, percent: int, block: int = FAMILY_BLOCK) -> DataFrame:
    """Edges ``(a, b)`` that connect exactly what links connect, within families."""
    sizes = sets.groupBy("family").agg(F.count(F.lit(1)).alias("size"), F.min("row").alias("hub"))
    sized = sets.join(sizes.withColumn("blocks", F.ceil(F.col("size") / block).cast("int")), "family")
    own = F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int")
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    inside = sized.select(
        "family", "row", "shingles", F.explode(F.when(F.col("row") == F.col("hub"), every).otherwise(F.array(own))).alias("x")
    )

    def within(rows: pa.Table, starts: np.ndarray) -> pa.RecordBatch | None:
        return _confirmed(rows, starts, percent, None)

    near = stored(map_groups(inside, ["family", "x"], within, "a long, b long"), "links")
    large = sizes.filter(F.col("size") > block)
    if large.isEmpty():
        return near
    return near.unionByName(_across(sized.filter(F.col("blocks") > 1), near, percent, block))


def _across(sized: DataFrame, near: DataFrame, percent: int, block: int) -> DataFrame:
    """Links between parts of large families that are still apart.

    All parts but the largest of a family are compared with the whole family, block by
    block. A family that hangs together already has no other part and costs nothing.
    """
    part = components(near).withColumnRenamed("node", "row").withColumnRenamed("component", "part")
    parted = stored(sized.join(part.hint("merge"), "row", "left").withColumn("part", F.coalesce("part", "row")), "parts")
    counted = parted.groupBy("family", "part").agg(F.count(F.lit(1)).alias("n"))
    largest = counted.groupBy("family").agg(F.max(F.struct("n", "part")).alias("m"), F.sum("n").alias("size"))
    apart = largest.filter(F.col("m.n") < F.col("size")).select(
        "family", F.col("m.part").alias("main"), F.ceil((F.col("size") - F.col("m.n")) / block).cast("int").alias("few")
    )
    rows = parted.join(apart, "family")
    own = F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int")
    minor = F.pmod(F.xxhash64("row", F.lit(1)), F.col("few")).cast("int")
    columns = ["family", "row", "part", "shingles"]
    everyone = rows.select(*columns, F.explode(F.sequence(F.lit(0), F.col("few") - 1)).alias("x"), own.alias("y"))
    minors = rows.filter("part <> main").select(
        *columns, minor.alias("x"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("y")
    )

    def between(table: pa.Table, starts: np.ndarray) -> pa.RecordBatch | None:
        return _confirmed(table, starts, percent, np.asarray(table.column("part")))

    return map_groups(everyone.unionByName(minors), ["family", "x", "y"], between, "a long, b long")


def _confirmed(rows: pa.Table, starts: np.ndarray, percent: int, part: np.ndarray | None) -> pa.RecordBatch | None:
    node, sets, found = np.asarray(rows.column("row")), _sets_of(rows), []
    for a, b in zip(starts[:-1], starts[1:], strict=True):
        if b - a > 1:
            edges = linked(sets[a:b], percent, None if part is None else part[a:b])
            found += [(i + a, j + a) for i, j in edges]
    if not found:
        return None
    x, y = np.array(found).T
    return pa.RecordBatch.from_arrays([pa.array(node[x]), pa.array(node[y])], ["a", "b"])


def near_dedup(
    docs: DataFrame, words: int = WORDS, percent: int = PERCENT, k: int = COORDINATES, matches: int = MATCHES
) -> DataFrame:
    """Per row of ``(doc_id, text)``: ``doc_id, n_shingles, component_id, kept``.

    Two documents link when ``100 * |A and B| >= percent * |A or B|`` for their sets of
    word shingles. ``component_id`` is the smallest ``doc_id`` reachable by links, and
    the row that has it is kept; of rows that repeat it, one. A null or blank text has
    an empty set and links with nothing. A null ``doc_id`` counts as larger than others.
    """
    numbered = docs.select("doc_id", "text").withColumn("row", F.monotonically_increasing_id())
    rows = stored(signatures(numbered, words, k), "signatures")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row")).alias("first")
    classes = rows.filter("n > 0").groupBy("set").agg(first, F.any_value("n").alias("n"), F.any_value("sig").alias("sig"))
    classes = stored(classes.select("set", "first", F.col("first.row").alias("row"), F.col("first.doc_id").alias("doc_id"), "sig"), "classes")
    vertex = classes.groupBy("sig").agg(F.min("row").alias("vertex"))
    same = classes.join(vertex.hint("merge"), "sig").filter("row <> vertex").select(F.col("vertex").alias("a"), F.col("row").alias("b"))
    vertices = vertex.select(F.col("vertex").alias("row"), "sig")
    similar = collisions(postings(vertices, k, matches), vertices, matches)
    family = stored(components(similar.unionByName(same)), "families").select(F.col("node").alias("row"), F.col("component").alias("family"))
    members = classes.select("row", "doc_id", "set").join(family.hint("merge"), "row")
    sets = stored(full_sets(docs, members, words), "sets")
    links = components(confirm(sets, percent)).select(F.col("node").alias("row"), F.col("component").alias("root"))
    rooted = classes.join(links.hint("merge"), "row", "left").select("set", "first", "root")
    linked = rooted.filter("root IS NOT NULL")
    keep = linked.groupBy("root").agg(F.min("first").alias("keep"))
    labels = salted_join(linked, keep, "root", "set").select("set", "keep")
    labels = labels.unionByName(rooted.filter("root IS NULL").select("set", F.col("first").alias("keep")))
    out = rows.filter("n > 0").join(labels.hint("merge"), "set").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("keep.doc_id").alias("component_id"),
        (F.col("row") == F.col("keep.row")).alias("kept"),
    )
    alone = rows.filter("n = 0").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(True).alias("kept")
    )
    return out.unionByName(alone)
