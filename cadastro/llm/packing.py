"""Best-fit packing of token pieces into sequences, planned on counts of lengths.

A sequence holds ``capacity`` tokens, so pieces have at most ``capacity`` different lengths, however
many documents there are. The plan is therefore made on the histogram of lengths (``capacity`` numbers,
the only thing that reaches the driver) and says how many sequences of each make-up there are:

1. Large pieces, above a third of the capacity, can share a sequence with at most one other large
   piece, as three never fit. Greedy matching pairs each, longest first, with the largest
   partner that still fits.
2. Smaller pieces, longest first, go where they fit best: into the smallest remaining gap that holds
   them. All gaps of one width are filled at once, so the plan's work depends on the number of
   different lengths, not on the number of pieces.

The pieces then claim their places in parallel: the r-th piece of a length takes the r-th place the plan
has for that length. r comes from a two-level count (pieces before it in its task, tasks before its
own), so no length, however common, is gathered in one task. The pieces are written in buckets of their
task, so each meets its task's one row of counts where it lies: token ids are never shuffled.
"""

from __future__ import annotations

import bisect
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._common import materialise, materialise_bucketed, slices
from .tokens import encoder


@dataclass
class _Group:
    """``n`` sequences alike, numbered from ``first``, each with ``used`` tokens placed so far."""

    first: int
    n: int
    used: int


@dataclass
class Plan:
    """Places by length: parallel arrays sorted by (length, first rank).

    Places of segment j: ranks ``rank[j]`` to ``rank[j + 1]``; the i-th of them is in sequence
    ``sequence[j] + i // each[j]`` at offset ``offset[j] + i % each[j] * length``.
    """

    length: np.ndarray
    rank: np.ndarray
    sequence: np.ndarray
    each: np.ndarray
    offset: np.ndarray
    first_segment: np.ndarray  # by length
    n_sequences: int

    def place(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of the pieces with these lengths and ranks within their length."""
        at = np.empty(len(lengths), np.int64)
        for size in np.unique(lengths):
            mine = lengths == size
            lo, hi = self.first_segment[size], self.first_segment[size + 1]
            at[mine] = lo + np.searchsorted(self.rank[lo:hi], ranks[mine], side="right") - 1
        i = ranks - self.rank[at]
        return self.sequence[at] + i // self.each[at], self.offset[at] + i % self.each[at] * lengths


def plan_packing(counts: dict[int, int], capacity: int) -> Plan:
    """Large-item matching and best fit on ``counts`` (length -> number of pieces)."""
    left = [0] * (capacity + 1)
    for size, n in counts.items():
        if not 0 < size <= capacity:
            raise ValueError(f"a piece of {size} tokens does not fit {capacity}")
        left[size] += n
    segments: list[tuple[int, int, int, int, int]] = []  # length, rank, sequence, each, offset
    ranks = [0] * (capacity + 1)
    gaps: dict[int, list[_Group]] = {}
    widths: list[int] = []  # gaps that are open, ascending
    sequences = 0

    def put(size: int, group: _Group, each: int, n: int) -> None:
        """``n`` pieces into the group, ``each`` of them in every sequence."""
        segments.append((size, ranks[size], group.first, each, group.used))
        ranks[size] += n
        group.used += each * size

    def keep(group: _Group) -> None:
        gap = capacity - group.used
        if group.n and gap:
            if gap not in gaps:
                bisect.insort(widths, gap)
            gaps.setdefault(gap, []).append(group)

    third = capacity // 3
    large = [s for s in range(capacity, third, -1) if left[s]]
    partners = sorted(large)
    for size in large:
        while left[size]:
            # The largest partner that fits beside this length and is still there.
            at = bisect.bisect_right(partners, capacity - size) - 1
            while at >= 0 and not left[partners[at]]:
                partners.pop(at)
                at -= 1
            partner = partners[at] if at >= 0 else 0
            if partner == size and left[size] == 1:
                at -= 1
                while at >= 0 and not left[partners[at]]:
                    partners.pop(at)
                    at -= 1
                partner = partners[at] if at >= 0 else 0
            n = left[size] if not partner else left[size] // 2 if partner == size else min(left[size], left[partner])
            group = _Group(sequences, n, 0)
            sequences += n
            if partner == size:
                put(size, group, 2, 2 * n)
                left[size] -= 2 * n
            else:
                put(size, group, 1, n)
                left[size] -= n
                if partner:
                    put(partner, group, 1, n)
                    left[partner] -= n
            keep(group)
    for size in range(third, 0, -1):
        while left[size]:
            at = bisect.bisect_left(widths, size)
            if at == len(widths):
                each = capacity // size
                whole = left[size] // each
                for n, k in ((whole, each), (1, left[size] - whole * each)):
                    if n and k:
                        group = _Group(sequences, n, 0)
                        sequences += n
                        put(size, group, k, n * k)
                        left[size] -= n * k
                        keep(group)
                break
            width = widths[at]
            group = gaps[width].pop()
            if not gaps[width]:
                del gaps[width]
                widths.pop(at)
            each = width // size
            whole = min(group.n, left[size] // each)
            rest = left[size] - whole * each if whole < group.n else 0
            if whole:
                filled = _Group(group.first, whole, group.used)
                put(size, filled, each, whole * each)
                left[size] -= whole * each
                keep(filled)
            if rest:  # fewer pieces are left than one sequence of the group could take
                one = _Group(group.first + whole, 1, group.used)
                put(size, one, rest, rest)
                left[size] -= rest
                keep(one)
            spare = group.n - whole - bool(rest)
            keep(_Group(group.first + group.n - spare, spare, group.used))
    segments.sort()
    table = np.array(segments, np.int64).reshape(-1, 5)
    first = np.searchsorted(table[:, 0], np.arange(capacity + 2))
    return Plan(*(table[:, k] for k in range(5)), first, sequences)


def cut_pieces(
    docs: DataFrame, tokenizer_json: str, *, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048, end_id: int = 0,
) -> DataFrame:
    """Encoded documents cut into pieces: id, piece, start, length, ids (little-endian unsigned 32-bit
    integers as bytes), and the task and rank that ``pack`` counts by.

    Only documents longer than ``capacity`` are cut; all their pieces but the last are full.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(tokenizer_json)
    narrow = docs.select(F.col(id_col), F.col(text_col).alias("text"))
    schema = T.StructType([
        T.StructField(id_col, narrow.schema[0].dataType), T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType()),
        T.StructField("task", T.IntegerType()), T.StructField("rank", T.LongType()),
    ])

    def run(batches):
        encode, width = encoder(shipped.value), 4
        end, task, seen = np.array([end_id], "<u4").tobytes(), TaskContext.get().partitionId(), [0] * (capacity + 1)
        for batch in batches:
            for start, texts in slices(batch, 1):
                owner, piece, begin, length, ids, rank = [], [], [], [], [], []
                for row, text in enumerate(texts):
                    whole = np.frombuffer(encode.encode(text), encode.dtype).astype("<u4").tobytes() + end
                    for k, at in enumerate(range(0, len(whole), capacity * width)):
                        part = whole[at:at + capacity * width]
                        size = len(part) // width
                        owner.append(row)
                        piece.append(k)
                        begin.append(at // width)
                        length.append(size)
                        ids.append(part)
                        rank.append(seen[size])
                        seen[size] += 1
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(texts)).take(pa.array(owner, pa.int64())), pa.array(piece, pa.int32()),
                     pa.array(begin, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary()),
                     pa.array([task] * len(ids), pa.int32()), pa.array(rank, pa.int64())], names=schema.names)

    return narrow.mapInArrow(run, schema)


def pack(
    docs: DataFrame, tokenizer_json: str, *, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048, end_id: int = 0,
) -> DataFrame:
    """Pieces of all documents with their places: id, piece, start, length, ids, sequence_id, offset.

    Null text counts as empty (one piece with the end id alone); repeated rows are packed as often as
    they come; ties between pieces of one length are decided by task and order; an empty table gives no
    pieces; extra columns are not read. The encoded pieces are written once to the shared scratch folder
    and reread, so texts are encoded once and ranks stay fixed when tasks run again.
    """
    pieces = materialise_bucketed(
        cut_pieces(docs, tokenizer_json, id_col=id_col, text_col=text_col, capacity=capacity, end_id=end_id), "pieces", "task")
    by_task = materialise(pieces.groupBy("task", "length").count(), "piece_counts")
    # At most ``capacity`` rows reach the driver, whatever the size of the corpus.
    totals = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    plan = docs.sparkSession.sparkContext.broadcast(plan_packing(totals, capacity))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = by_task.select("task", "length", F.coalesce(F.sum("count").over(before), F.lit(0)).cast("long").alias("base"))
    # The hint keeps one plan at every size: the pieces stay in their buckets, the tasks' rows come to them.
    ranked = pieces.join(_by_task(bases, capacity).hint("shuffle_hash"), "task").select(
        id_col, "piece", "start", "length", "ids", (F.get("bases", F.col("length").cast("int")) + F.col("rank")).alias("rank"))
    schema = T.StructType([*ranked.schema.fields[:5], T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(batches):
        for batch in batches:
            sequence, offset = plan.value.place(batch.column(3).to_numpy(), batch.column(5).to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], names=schema.names)

    return ranked.mapInArrow(run, schema)


def _by_task(bases: DataFrame, capacity: int) -> DataFrame:
    """Rows (task, length, base) -> one row a task: the bases of all lengths as an array."""

    def run(batches):
        task, held = None, None
        for batch in batches:
            for t, length, base in zip(*(c.to_numpy() for c in batch.columns), strict=True):
                if t != task:
                    if held is not None:
                        yield out(task, held)
                    task, held = t, np.zeros(capacity + 1, np.int64)
                held[length] = base
        if held is not None:
            yield out(task, held)

    def out(task, held):
        return pa.RecordBatch.from_arrays([pa.array([task], pa.int32()), pa.array([held], pa.list_(pa.int64()))], names=["task", "bases"])

    return bases.repartition("task").sortWithinPartitions("task").mapInArrow(run, "task int, bases array<long>")


def sequences(packed: DataFrame) -> DataFrame:
    """One row per sequence: its ids joined in order of offset, and its length (at most the capacity)."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids", "length")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id",
        F.aggregate("parts", F.lit(b""), lambda acc, p: F.concat(acc, p["ids"])).alias("ids"),
        F.aggregate("parts", F.lit(0).cast("long"), lambda acc, p: acc + p["length"]).alias("length"))


