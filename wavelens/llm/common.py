"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows, or bytes, of whole groups gathered inside a Python task before they are worked on.
GROUP_ROWS = 2048
GROUP_BYTES = 32 << 20
#: Text handled at once inside a Python task, in bytes.
SLICE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed_text(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, text)`` alone, so that other columns cannot clash with what operators add."""
    return df.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))


def filled(text: str | Column = "text") -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def among(rows: DataFrame, keys: DataFrame, key: str = "key", bits: int = 24) -> DataFrame:
    """Rows whose ``key`` (a hash) may be among those of ``keys``, by a broadcast of fixed size.

    There is a bit per slot of the key, 64 to a row of at most ``2 ** (bits - 6)`` rows.
    What it lets through too much must do no harm; nothing that is among them is lost.
    """
    slot = F.pmod(key, F.lit(1 << bits))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("_slot") % 64).cast("int"))
    table = keys.select(slot.alias("_slot")).groupBy(F.shiftright("_slot", 6).alias("_part")).agg(F.bit_or(one).alias("_bits"))
    placed = rows.withColumn("_slot", slot).withColumn("_part", F.shiftright("_slot", 6))
    met = placed.join(F.broadcast(table), "_part").filter(F.getbit("_bits", (F.col("_slot") % 64).cast("int")) == 1)
    return met.drop("_slot", "_part", "_bits")


def salted_join(left: DataFrame, right: DataFrame, key: str, spread: str, salts: int = 16) -> DataFrame:
    """Inner join of ``left`` to ``right`` (one row per ``key``), a key's rows dealt over tasks.

    Rows of ``left`` go by the hash of their column ``spread``, those of ``right`` to all.
    Spark does not count the copies when it sizes ``right``, so it is told not to broadcast it.
    """
    salt = F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int")
    every = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.withColumn("_salt", salt).join(every.hint("merge"), [key, "_salt"]).drop("_salt")


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch where its texts reach ``limit`` bytes; a longer text stands alone."""
    column = batch.column(batch.schema.get_field_index(text))
    sizes = np.asarray(pc.fill_null(pc.binary_length(column), 0), dtype=np.int64)
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if start < batch.num_rows:
        yield batch.slice(start)


def arrow_map(df: DataFrame, run: Callable, schema) -> DataFrame:
    """``mapInArrow`` by code of this package, which is sent to the executors once."""
    context = df.sparkSession.sparkContext
    if not hasattr(context, "_wavelens_code"):
        package = Path(__file__).resolve().parents[1]
        folder = tempfile.TemporaryDirectory(prefix="wavelens-code-")
        path = f"{folder.name}/wavelens-code.zip"
        with zipfile.ZipFile(path, "w") as archive:
            for file in package.rglob("*.py"):
                archive.write(file, file.relative_to(package.parent))
        context.addPyFile(path)
        context._wavelens_code = folder  # the driver serves the file as long as it runs
    return df.mapInArrow(run, schema)


def int_lists(parts: Sequence[np.ndarray]) -> pa.ListArray:
    """A list column of int32 from one array per row."""
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    flat = np.concatenate(parts) if parts else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32, copy=False)))


def map_groups(
    df: DataFrame,
    keys: Sequence[str],
    work: Callable[[pa.Table, np.ndarray], pa.RecordBatch | None],
    schema: str,
) -> DataFrame:
    """Apply ``work`` to runs of whole groups of ``keys``.

    Rows are dealt by ``keys`` and sorted, and ``work`` gets a table of one or more
    complete groups with the positions where groups begin (and the end), as soon as
    ``GROUP_ROWS`` rows or ``GROUP_BYTES`` bytes are there. A group must be of bounded size;
    callers split larger ones into blocks first.
    """
    keys = list(keys)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(b.num_rows for b in held) < GROUP_ROWS and sum(b.nbytes for b in held) < GROUP_BYTES:
                continue
            rows = pa.Table.from_batches(held)
            cut = _starts(rows, keys)[-2]
            if cut:
                out = _worked(work, rows.slice(0, cut), keys)
                if out is not None:
                    yield out
            held = rows.slice(cut).combine_chunks().to_batches()
        if held:
            out = _worked(work, pa.Table.from_batches(held), keys)
            if out is not None:
                yield out

    return arrow_map(df.repartition(*keys).sortWithinPartitions(*keys), run, schema)


def _starts(rows: pa.Table, keys: Sequence[str]) -> np.ndarray:
    new = np.zeros(rows.num_rows, bool)
    new[0] = True
    for key in keys:
        column = rows.column(key).combine_chunks()
        differs = pc.not_equal(column.slice(1), column.slice(0, len(column) - 1))
        new[1:] |= np.asarray(pc.fill_null(differs, True))
    return np.append(np.flatnonzero(new), rows.num_rows)


def _worked(work, rows: pa.Table, keys: Sequence[str]) -> pa.RecordBatch | None:
    rows = rows.combine_chunks()
    return work(rows, _starts(rows, keys))
