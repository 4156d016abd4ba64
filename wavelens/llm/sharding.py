"""Placement of keys on shards by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a table of prime size:
start at an offset and go on by a skip, both from hashes of its name. Shards take turns
claiming the first slot of their order that is still free, so that slots are even to one
per turn, and a shard that leaves mostly frees its own slots alone. A key's slot is its
hash modulo the table size, so placing a row is one hash and one lookup.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Prime; the lookup table that is broadcast has this many rows.
SLOTS = 65_537


def _number(text: str) -> int:
    return int.from_bytes(hashlib.sha256(text.encode()).digest()[:8], "big")


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n**0.5) + 1))


def lookup_table(shards: Sequence[str], weights: Sequence[int] | None = None, slots: int = SLOTS) -> np.ndarray:
    """Shard index of every slot; ``weights`` are claims per turn (1 unless given).

    ``slots`` must be a prime larger than the number of shards, names must differ.
    """
    if not _is_prime(slots) or not 0 < len(shards) < slots:
        raise ValueError("slots must be a prime above the number of shards")
    if len(set(shards)) != len(shards):
        raise ValueError("shards must have different names")
    weights = [1] * len(shards) if weights is None else list(weights)
    if len(weights) != len(shards) or min(weights) < 0 or not any(weights):
        raise ValueError("one weight per shard, not all zero")
    at = [_number(f"offset:{name}") % slots for name in shards]
    skip = [_number(f"skip:{name}") % (slots - 1) + 1 for name in shards]
    owner = np.full(slots, -1, np.int32)
    claimed = 0
    while True:
        for i, claims in enumerate(weights):
            for _ in range(claims):
                while owner[at[i]] >= 0:
                    at[i] = (at[i] + skip[i]) % slots
                owner[at[i]] = i
                claimed += 1
                if claimed == slots:
                    return owner


def slot_of(key: str | Column, slots: int = SLOTS) -> Column:
    """Slot of a key, by a hash of its text; a null key takes the slot of the empty text."""
    text = F.coalesce((F.col(key) if isinstance(key, str) else key).cast("string"), F.lit(""))
    return F.pmod(F.xxhash64(text), F.lit(slots)).cast("int")


def place(
    df: DataFrame, key: str | Column, shards: Sequence[str], weights: Sequence[int] | None = None,
    slots: int = SLOTS, slot: str = "slot", shard: str = "shard",
) -> DataFrame:
    """Add ``slot`` and ``shard`` (its name) to every row; columns so called are replaced.

    Equal keys share a shard; a null key is placed like an empty text. Rows never move.
    The table's size is fixed by ``slots``, whatever the input.
    """
    owner = lookup_table(shards, weights, slots)
    kept = df.select([c for c in df.columns if c.lower() not in (slot.lower(), shard.lower())])
    names = pa.array(shards, pa.string()).take(pa.array(owner))
    rows = pa.table({slot: pa.array(range(slots), pa.int32()), shard: names})
    lookup = F.broadcast(df.sparkSession.createDataFrame(rows))
    return kept.withColumn(slot, slot_of(key, slots)).join(lookup, slot).select(*kept.columns, slot, shard)


def write_shards(placed: DataFrame, path: str, shard: str = "shard", files: int = 8) -> None:
    """One folder per shard, each written by up to ``files`` tasks.

    Rows are dealt by shard and slot, so that a shard that holds many rows is spread;
    ``slot`` decides the file, so the same key always lies in the same one.
    """
    spread = F.pmod(F.col("slot"), F.lit(files))
    placed.repartition(shard, spread).write.partitionBy(shard).parquet(path)
