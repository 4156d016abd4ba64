"""Near-duplicate embeddings by cross-polytope hashing.

A vector is turned by three rounds of random signs and a fast Hadamard transform; its
hash is the coordinate axis it then lies closest to, with the sign. Two such hashes make
a bucket, and each of several tables has rotations of its own. Every vector is stored in
its own bucket and looks into the next likely ones too (multiprobe): those of the axes
that come right after the closest. Pairs that meet in a bucket are verified by their
cosine in double precision, and each is counted where it meets first.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavelens.llm.common import arrow_map, map_groups, salted_join
from wavelens.llm.components import Forest, components
from wavelens.session import stored

COSINE = 0.95
TABLES = 6
HASHES = 2
PROBES = 3
#: Rows of a bucket that are compared at once; a larger bucket is cut into blocks.
BLOCK = 1024


def hadamard(x: np.ndarray) -> np.ndarray:
    """Rows of ``x`` (a power of two long) under the fast Hadamard transform."""
    n = x.shape[1]
    step = 1
    while step < n:
        x = x.reshape(len(x), -1, 2, step)
        x = np.stack((x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]), axis=2).reshape(len(x), n)
        step *= 2
    return x


def hash_vectors(
    x: np.ndarray, tables: int = TABLES, hashes: int = HASHES, probes: int = PROBES
) -> tuple[np.ndarray, np.ndarray]:
    """Own buckets ``[n, tables]`` and further buckets ``[n, tables, probes]`` of unit rows."""
    n, dim = x.shape
    size = 1 << max(probes.bit_length() + 1, (dim - 1).bit_length())  # room for all probes
    padded = np.zeros((n, size))
    padded[:, :dim] = x
    own = np.empty((n, tables), np.int64)
    more = np.empty((n, tables, probes), np.int64)
    for t in range(tables):
        codes, costs = [], []
        for h in range(hashes):
            signs = np.random.default_rng([t, h, size]).integers(0, 2, (3, size)) * 2 - 1
            turned = padded
            for s in signs:
                turned = hadamard(turned * s) / np.sqrt(size)
            weight = np.abs(turned)
            axes = np.argsort(-weight, axis=1, kind="stable")[:, : probes + 1]
            rows = np.arange(n)[:, None]
            codes.append(axes * 2 + (turned[rows, axes] < 0))
            costs.append((weight[rows, axes[:, :1]] - weight[rows, axes]) ** 2)
        base = 2 * size
        place = [base**h for h in range(hashes)]
        own[:, t] = sum(c[:, 0] * p for c, p in zip(codes, place, strict=True))
        # One hash moved to its next axes, the cheapest moves over all hashes first.
        moved = np.concatenate([own[:, t, None] + (c[:, 1:] - c[:, :1]) * p for c, p in zip(codes, place, strict=True)], 1)
        cheap = np.argsort(np.concatenate([c[:, 1:] for c in costs], 1), axis=1, kind="stable")[:, :probes]
        more[:, t] = np.take_along_axis(moved, cheap, 1)
    return own, more


def usable(vectors: DataFrame) -> DataFrame:
    """``(row, vec_id, v)`` for vectors that are whole, finite and not zero."""
    v = F.transform(F.col("v"), lambda x: x.cast("double"))
    whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    nonzero = F.exists("v", lambda x: x != 0)
    return vectors.withColumn("v", v).filter(F.coalesce(whole & nonzero, F.lit(False)))


def _unit(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = np.asarray(column.flatten(), np.float64)
    x = flat.reshape(len(column), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def post(vectors: DataFrame, tables: int, hashes: int, probes: int) -> DataFrame:
    """``(dim, t, bucket, row, main)``: each vector in its own buckets and those it probes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.asarray(batch.column(1).value_lengths())
            for dim in np.unique(lengths):
                same = batch.filter(pa.array(lengths == dim))
                own, more = hash_vectors(_unit(same.column(1)), tables, hashes, probes)
                n = same.num_rows
                bucket = np.concatenate([own[:, :, None], more], 2).reshape(-1)
                each = tables * (probes + 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n * each, dim, np.int32)),
                        pa.array(np.tile(np.repeat(np.arange(tables, dtype=np.int32), probes + 1), n)),
                        pa.array(bucket),
                        pa.array(np.repeat(np.asarray(same.column(0)), each)),
                        pa.array(np.tile(np.arange(probes + 1) == 0, n * tables)),
                    ],
                    ["dim", "t", "bucket", "row", "main"],
                )

    return arrow_map(vectors.select("row", "v"), run, "dim int, t int, bucket long, row long, main boolean")


def meet(posted: DataFrame, block: int) -> DataFrame:
    """Rows with what is compared with what: ``(dim, t, bucket, x, y, row, main)``.

    Buckets without two rows, or without an owner, are dropped. Larger ones are cut into
    blocks, and every two blocks meet, so that a task holds at most two.
    """
    sizes = posted.groupBy("dim", "t", "bucket").agg(
        F.count(F.lit(1)).alias("n"), F.bool_or("main").alias("owned")
    ).filter("n > 1 AND owned")
    sized = posted.join(sizes, ["dim", "t", "bucket"]).withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    own = F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = sized.withColumn("own", own).select("dim", "t", "bucket", "row", "main", "own", other)
    return dealt.select(
        "dim", "t", "bucket", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"),
        "own", "row", "main",
    )


def verified(
    vectors: DataFrame, cosine: float, tables: int, hashes: int, probes: int, block: int
) -> DataFrame:
    """``(row, other, n)``: partial numbers of links per row, and edges that connect them.

    A task returns, for each of its rows, the links counted there (``other`` null) and a
    spanning forest of them (``n`` zero), so that a dense group of m vectors gives m
    rows per task and not m * m.
    """
    met = meet(post(vectors, tables, hashes, probes), block)
    full = met.join(vectors.select("row", "v", "copies"), "row")
    keys = ["dim", "t", "bucket", "x", "y"]

    def work(rows: pa.Table, starts: np.ndarray) -> pa.RecordBatch | None:
        node, own = np.asarray(rows.column("row")), np.asarray(rows.column("own"))
        main, copies = np.asarray(rows.column("main")), np.asarray(rows.column("copies"))
        t, bucket = np.asarray(rows.column("t")), np.asarray(rows.column("bucket"))
        across = np.asarray(rows.column("x")) != np.asarray(rows.column("y"))
        column = rows.column("v").combine_chunks()
        out: list[tuple] = []
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            mains = main[a:b]
            if b - a < 2 or not mains.any():
                continue
            x = _unit(column.slice(a, b - a))
            close = x @ x.T >= cosine - 1e-9
            close &= mains[:, None] | mains[None, :]
            close = np.triu(close, 1)
            if across[a]:
                close &= own[a:b, None] != own[None, a:b]
            i, j = np.nonzero(close)
            if not len(i):
                continue
            keep = np.einsum("ij,ij->i", x[i], x[j]) >= cosine
            i, j = i[keep], j[keep]
            keep = _first_meeting(x, i, j, t[a], bucket[a], tables, hashes, probes)
            i, j = i[keep], j[keep]
            counts = np.bincount(i, copies[a + j], b - a) + np.bincount(j, copies[a + i], b - a)
            forest = Forest(b - a)
            for p, q in zip(i, j, strict=True):
                forest.join(int(p), int(q))
            out += [(node[a + k], None, int(counts[k])) for k in np.flatnonzero(counts)]
            out += [(node[a + p], node[a + q], 0) for p, q in forest.edges]
        if not out:
            return None
        r, o, n = zip(*out, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(r, pa.int64()), pa.array(o, pa.int64()), pa.array(n, pa.int64())], ["row", "other", "n"]
        )

    return map_groups(full.select(*keys, "own", "row", "main", "copies", "v"), keys, work, "row long, other long, n long")


def _first_meeting(x, i, j, t, bucket, tables, hashes, probes) -> np.ndarray:
    """Whether pairs ``i, j`` meet in this table and bucket before any other."""
    if not len(i):
        return np.zeros(0, bool)
    own, more = hash_vectors(x, t + 1, hashes, probes)
    first = np.ones(len(i), bool)
    for s in range(t + 1):
        a, b = own[i, s], own[j, s]
        by_first = (more[j, s] == a[:, None]).any(1)  # j looks into the bucket of i
        by_second = (more[i, s] == b[:, None]).any(1)
        meets = (a == b) | by_first | by_second
        if s < t:
            first &= ~meets
        else:
            low = np.minimum(np.where(by_first, a, np.iinfo(np.int64).max), np.where(by_second, b, np.iinfo(np.int64).max))
            first &= np.where(a == b, a, low) == bucket
    return first


def near_dedup(
    vectors: DataFrame, cosine: float = COSINE, tables: int = TABLES, hashes: int = HASHES,
    probes: int = PROBES, block: int = BLOCK,
) -> DataFrame:
    """Per row of ``(vec_id, embedding)``: ``vec_id, n_links, component_id, kept``.

    A link is a pair of vectors of equal length found with a cosine of at least
    ``cosine``; ``component_id`` is the smallest ``vec_id`` reachable by links. Vectors
    that are null, zero or hold null or non-finite components link with nothing. Equal
    vectors are one while searching and count as often as they are there; rows that
    repeat a ``vec_id`` are vectors of their own, of which one is kept. A null
    ``vec_id`` counts as larger than any other.
    """
    numbered = stored(
        vectors.select("vec_id", F.col("embedding").alias("v")).withColumn("row", F.monotonically_increasing_id()), "vectors"
    )
    clean = usable(numbered)
    first = F.min(F.struct(F.col("vec_id").isNull().alias("unknown"), "vec_id", "row")).alias("first")
    classes = clean.groupBy("v").agg(first, F.count(F.lit(1)).alias("copies"))
    classes = stored(classes.select("v", "first", "copies", F.col("first.row").alias("row")), "classes")
    found = stored(verified(classes, cosine, tables, hashes, probes, block), "links")
    n_links = found.filter("other IS NULL").groupBy("row").agg(F.sum("n").alias("n"))
    part = components(found.filter("other IS NOT NULL"), "row", "other").select(F.col("node").alias("row"), "component")
    rooted = classes.join(n_links, "row", "left").join(part, "row", "left").select(
        "v", "first", "row", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "row").alias("root"),
    )
    keep = rooted.groupBy("root").agg(F.min("first").alias("keep"))
    labels = salted_join(rooted, keep, "root", "row").select("v", "n_links", "keep")
    linked = clean.join(labels, "v").select(
        "vec_id", "n_links", F.col("keep.vec_id").alias("component_id"), (F.col("row") == F.col("keep.row")).alias("kept")
    )
    others = numbered.join(clean.select("row"), "row", "left_anti").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")
    )
    return linked.unionByName(others)
