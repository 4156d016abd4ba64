"""Packing documents into training sequences by linear grouping and best fit.

Documents become pieces of at most ``size`` tokens. How many pieces there are of each
length is all that planning needs: at most ``size`` numbers, however large the corpus.
The plan, made on the driver from these numbers, names runs of sequences; every piece
then finds its own place from its length and its rank among pieces of that length.

1. Lengths above a share of ``size`` are large. Sorted, they are cut into groups of equal
   cardinality, and each length is rounded up to the largest of its group.
2. Which configurations of these few sizes to use is a linear program, solved by column
   generation: a knapsack finds the next configuration, until none improves.
3. Real pieces take the slots of their group; what rounding wasted becomes free again.
4. Large pieces left over from rounding the program's solution down, and then the small
   ones, go by best fit, longest first, into the sequence with the least room left.

A plan is made for each of a few shares and numbers of groups, and the one with the
fewest sequences is used: few groups waste room by rounding, which small pieces only
fill if there are enough of them.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from pathlib import Path

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wavelens.llm.bpe import read_ranks
from wavelens.llm.common import arrow_map, int_lists, slices
from wavelens.session import stored

SIZE = 2048
#: What counts as large (above ``size`` divided by this) and the number of groups.
SCHEMES = ((2, 96), (3, 128), (4, 96), (8, 48))
_CODECS: dict[tuple, tiktoken.Encoding] = {}

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long"


def added_tokens(path: str) -> dict[str, int]:
    """Strings that a tokenizer file (JSON) takes out of a text before all else, with their ids.

    Strings that also take the blanks beside them, stand only between words, or are
    looked for in normalised text are refused, as are strings that hold one another.
    """
    rows = json.loads(Path(path).read_text())["added_tokens"]
    out = {r["content"]: r["id"] for r in rows}
    flags = any(r[f] for r in rows for f in ("single_word", "lstrip", "rstrip", "normalized"))
    if flags or any(a != b and a in b for a in out for b in out):
        raise ValueError(f"added tokens of {path} need rules that are not kept here")
    return out


def codec(path: str, pattern: str, added: dict[str, int] | None = None) -> tiktoken.Encoding:
    """The worker's tokenizer; strings of ``added`` become their own ids wherever they occur."""
    key = (path, pattern, tuple(sorted((added or {}).items())))
    if key not in _CODECS:
        _CODECS[key] = tiktoken.Encoding(
            "own", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens=dict(added or {})
        )
    return _CODECS[key]


def cut_pieces(
    docs: DataFrame, path: str, pattern: str, size: int = SIZE, end: int = 0, with_ids: bool = False,
    added: dict[str, int] | None = None,
) -> DataFrame:
    """Token pieces of ``(doc_id, text)``: every document is its ids and then ``end``.

    A document of more than ``size`` ids is cut into pieces of ``size``; only its first
    may be shorter. A null or empty text is the single id ``end``. ``task`` and ``nth``
    number the pieces of one length within a task; ``with_ids`` adds the ids themselves.
    ``added`` are strings with ids of their own (see ``added_tokens``): the text between
    them is encoded part by part, as if each part stood alone.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = codec(path, pattern, added)
        context = TaskContext.get()
        task = context.partitionId() if context else 0
        seen = np.zeros(size + 1, np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                out, ids = [], []
                for doc, text in zip(*(part.column(i).to_pylist() for i in range(2)), strict=True):
                    all_ids = np.array([*tokens.encode(text or "", allowed_special="all"), end], "<u4")
                    cuts = [0, *range(len(all_ids) % size or size, len(all_ids) + 1, size)]
                    if cuts[-1] != len(all_ids):
                        cuts.append(len(all_ids))
                    for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                        piece = all_ids[a:b]
                        out.append((doc, k, a, b - a, zlib.crc32(piece.tobytes()), task, seen[b - a]))
                        seen[b - a] += 1
                        if with_ids:
                            ids.append(piece.astype(np.int32))
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"]
                types = [part.schema.field(0).type, pa.int32(), *[pa.int64()] * 3, pa.int32(), pa.int64()]
                columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
                if with_ids:
                    columns, names = [*columns, int_lists(ids)], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names)

    kept = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    schema = PIECE.replace("doc_id long", f"doc_id {kept.schema['doc_id'].dataType.simpleString()}")
    return arrow_map(kept, run, schema + (", ids array<int>" if with_ids else ""))


@dataclass
class Plan:
    """Runs of slots: the pieces of ``length`` ranked ``rank … rank+n`` go to ``bin …`` at ``offset``."""

    size: int
    bins: int = 0
    runs: list[tuple[int, int, int, int, int]] = field(default_factory=list)
    used: dict[int, int] = field(default_factory=dict)
    room: dict[int, list[tuple[int, int]]] = field(default_factory=dict)

    def place(self, first: int, n: int, length: int, offset: int) -> None:
        rank = self.used.get(length, 0)
        self.runs.append((length, rank, n, first, offset))
        self.used[length] = rank + n

    def leave(self, first: int, n: int, room: int) -> None:
        if n and room:
            self.room.setdefault(room, []).append((first, n))

    def open(self, n: int) -> int:
        self.bins += n
        return self.bins - n

    def fill(self, first: int, n: int, room: int, length: int, each: int) -> None:
        """Put ``each`` pieces of ``length`` into each of ``n`` sequences."""
        for k in range(each):
            self.place(first, n, length, self.size - room + k * length)
        self.leave(first, n, room - each * length)

    def best_fit(self, length: int, count: int) -> None:
        """Put ``count`` equal pieces where the least room is left."""
        for room in sorted(r for r in self.room if r >= length):
            if not count:
                return
            each, spans = room // length, self.room.pop(room)
            for first, n in spans:
                full = min(n, count // each)
                self.fill(first, full, room, length, each)
                count -= full * each
                if full < n and count:
                    self.fill(first + full, 1, room, length, count)
                    count, full = 0, full + 1
                self.leave(first + full, n - full, room)
        each = self.size // length
        if full := count // each:
            self.fill(self.open(full), full, self.size, length, each)
        if rest := count % each:
            self.fill(self.open(1), 1, self.size, length, rest)


def linear_groups(counts: np.ndarray, lengths: list[int], groups: int) -> dict[int, list[list[int]]]:
    """Groups of equal cardinality: rounded size -> ``[length, count]`` in descending order."""
    total = int(sum(counts[x] for x in lengths))
    share = max(1, -(-total // groups))
    out: dict[int, list[list[int]]] = {}
    taken, size = 0, 0
    for length in sorted(lengths, reverse=True):
        left = int(counts[length])
        while left:
            if taken % share == 0:
                size = length
            n = min(left, share - taken % share)
            out.setdefault(size, []).append([length, n])
            taken, left = taken + n, left - n
    return out


def configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[np.ndarray, int]]:
    """How often to use which combination of ``sizes``: the linear program, rounded down."""
    m = len(sizes)
    base = np.diag([float(capacity // s) for s in sizes])
    amount = np.array(demand, float) / np.diag(base)
    for _ in range(40 * m):
        price = np.linalg.solve(base.T, np.ones(m))
        column, value = _knapsack(sizes, price, capacity)
        if value <= 1 + 1e-7:
            break
        step = np.linalg.solve(base, column)
        ratio = np.where(step > 1e-9, amount / np.where(step > 1e-9, step, 1), np.inf)
        out = int(np.argmin(ratio))
        base[:, out] = column
        amount = np.maximum(np.linalg.solve(base, np.array(demand, float)), 0)
    return [(base[:, k].astype(int), int(np.floor(amount[k] + 1e-9))) for k in range(m)]


def _knapsack(sizes: list[int], price: np.ndarray, capacity: int) -> tuple[np.ndarray, float]:
    """The combination of the highest price that fits, by the number of things in it."""
    best = np.zeros(capacity + 1)
    chosen = []
    for _ in range(capacity // min(sizes)):
        options = np.zeros((len(sizes) + 1, capacity + 1))
        options[-1] = best
        for i, s in enumerate(sizes):
            options[i, s:] = best[:-s] + price[i]
            options[i, :s] = -1
        chosen.append(options.argmax(0))
        best = options.max(0)
    column, room = np.zeros(len(sizes)), capacity
    for pick in reversed(chosen):
        if (i := pick[room]) < len(sizes):
            column[i] += 1
            room -= sizes[i]
    return column, float(best[capacity])


def make_plan(counts: np.ndarray, size: int, share: int, groups: int) -> Plan:
    """Runs of slots for ``counts[length]`` pieces of each length."""
    plan = Plan(size)
    if counts[size]:
        whole = int(counts[size])
        plan.fill(plan.open(whole), whole, size, size, 1)
    lengths = [x for x in range(1, size) if counts[x]]
    grouped = linear_groups(counts, [x for x in lengths if x > size // share], groups)
    sizes = sorted(grouped, reverse=True)
    if sizes:
        demand = [sum(n for _, n in grouped[s]) for s in sizes]
        found = configurations(sizes, demand, size)
        for column, times in sorted(found, key=lambda x: -float(x[0] @ np.array(sizes))):
            _substitute(plan, [grouped[s] for s, k in zip(sizes, column, strict=True) for _ in range(k)], times)
    rest = {x: int(counts[x]) for x in lengths if x <= size // share}
    for queue in grouped.values():
        for length, n in queue:
            rest[length] = rest.get(length, 0) + n
    for length in sorted(rest, reverse=True):
        plan.best_fit(length, rest[length])
    return plan


def _substitute(plan: Plan, slots: list[list[list[int]]], times: int) -> None:
    """Open ``times`` sequences with one slot for each queue, filled from the queues."""
    while times and slots:
        used: dict[int, int] = {}
        for queue in slots:
            used[id(queue)] = used.get(id(queue), 0) + 1
        if any(not queue for queue in slots):
            return
        n = min(times, *(queue[0][1] // used[id(queue)] for queue in slots))
        heads = [queue[0][0] for queue in slots]
        if n == 0:  # two slots of one queue straddle a change of length: one mixed sequence
            if any(sum(c for _, c in queue) < used[id(queue)] for queue in slots):
                return
            n, heads = 1, []
            for queue in slots:
                heads.append(queue[0][0])
                _take(queue, 1)
        else:
            for queue in slots:
                _take(queue, n)
        first, at = plan.open(n), 0
        for length in heads:
            plan.place(first, n, length, at)
            at += length
        plan.leave(first, n, plan.size - at)
        times -= n


def _take(queue: list[list[int]], n: int) -> None:
    queue[0][1] -= n
    if not queue[0][1]:
        queue.pop(0)


def best_plan(counts: np.ndarray, size: int) -> Plan:
    return min((make_plan(counts, size, *scheme) for scheme in SCHEMES), key=lambda plan: plan.bins)


def pack(pieces: DataFrame, size: int = SIZE) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to stored pieces (as from ``cut_pieces``).

    Within each length, a piece's rank is its number within its task plus how many
    pieces of this length earlier tasks have: one aggregate, no sort of the pieces.
    Only the counts by length pass through the driver (``size`` rows), and only the
    plan's runs are broadcast; their number depends on ``size``, not on the pieces.
    """
    by_task = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    by_length = by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(size + 1, np.int64)
    for row in by_length:
        counts[row["length"]] = row["n"]
    runs = np.array(sorted(best_plan(counts, size).runs), np.int64).reshape(-1, 5)
    table = pieces.sparkSession.sparkContext.broadcast(runs)
    before = W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    offsets = by_task.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = pieces.join(offsets, ["length", "task"]).withColumn("rank", F.col("before") + F.col("nth"))
    ranked = ranked.select([c for c in pieces.columns if c not in ("task", "nth")] + ["rank"])
    names = [c for c in ranked.columns if c != "rank"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = table.value
        keys = runs[:, 0] << 44 | runs[:, 1]
        for batch in batches:
            if not batch.num_rows:
                continue
            length = np.asarray(batch.column(batch.schema.get_field_index("length")))
            rank = np.asarray(batch.column(batch.schema.get_field_index("rank")))
            found = runs[np.searchsorted(keys, length << 44 | rank, side="right") - 1]
            place = [pa.array(found[:, 3] + rank - found[:, 1]), pa.array(found[:, 4])]
            columns = [batch.column(batch.schema.get_field_index(c)) for c in names]
            yield pa.RecordBatch.from_arrays([*columns, *place], [*names, "sequence_id", "offset"])

    fields = ", ".join(f"`{c}` {ranked.schema[c].dataType.simpleString()}" for c in names)
    return arrow_map(ranked, run, f"{fields}, sequence_id long, offset long")


def pack_documents(
    docs: DataFrame, path: str, pattern: str, size: int = SIZE, added: dict[str, int] | None = None
) -> DataFrame:
    """Pieces of ``(doc_id, text)`` with their places; texts are tokenized once."""
    return pack(stored(cut_pieces(docs, path, pattern, size, added=added), "pieces"), size)


def sequences(packed: DataFrame) -> DataFrame:
    """``(sequence_id, ids)`` from placed pieces that carry ids; a sequence is at most ``size`` long."""
    parts = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten("parts.ids").alias("ids"))
