"""Best-fit packing of documents into sequences of a fixed number of tokens.

A sequence's content matters only through lengths, so the instance is its histogram: at most
``capacity`` counts, whatever the size of the corpus. The plan is made on that histogram:

1. Martello-Toth reduction. For the longest piece left, look at the sets of other pieces that fit
   beside it. Where one set dominates all others (it fills the sequence exactly, or every other set
   can be exchanged for it piece by piece), some best packing has it, so it is fixed, for as many
   sequences as the counts allow.
2. Best fit, longest first, for the rest: each length goes to the fullest sequences that still take it.

The plan is a list of runs: so many sequences with this content. Spark then numbers the pieces of each
length: every task counts its own, the counts of earlier tasks are added through a window over (length,
task), and the place of a piece follows from its number. No piece moves for that and no length, however
common, is gathered in one task.

Defined results
    null or empty text: the end token alone. Null ids: kept. Repeated rows: packed each.
    Empty table: no rows. Other columns: ignored by ``pieces``, kept by ``pack``, but for columns that
    have the names of the two it adds.
    A document longer than the capacity is cut into full pieces; the first one takes the remainder.
"""

from __future__ import annotations

import bisect
from collections import defaultdict
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketloom.llm.common import Stage, free_name
from marketloom.llm.tokens import encoder

CAPACITY = 1024
END_ID = 2

PIECES = "piece int, start long, length long, ids binary"
Run = tuple[int, dict[int, int]]  # sequences, pieces of each length in every one of them


def cut(n_ids: int, capacity: int) -> Iterator[tuple[int, int]]:
    """(start, length) of each piece of a document with so many ids."""
    head = n_ids % capacity if n_ids > capacity else n_ids
    if head:
        yield 0, head
    for start in range(head, n_ids, capacity):
        yield start, capacity


def pieces(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
    capacity: int = CAPACITY,
) -> DataFrame:
    """One row per piece: the id, ``piece``, ``start``, ``length`` and ``ids`` (little-endian unsigned 32-bit).

    ``tokenizer``: a ``tokenizers`` file that every executor can open.
    """
    import pyarrow as pa

    ident = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField("id", ident), *T.StructType.fromDDL(PIECES).fields])
    end = end_id.to_bytes(4, "little")

    def encode(batches):
        for batch in batches:
            codes = encoder(tokenizer)
            rows, piece, start, length, ids = [], [], [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                whole = codes.encode(text or "") + end
                for k, (at, n) in enumerate(cut(len(whole) // 4, capacity)):
                    rows.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(n)
                    ids.append(whole[4 * at : 4 * (at + n)])
            columns = [batch.column(0).take(pa.array(rows, pa.int32())), pa.array(piece, pa.int32())]
            columns += [pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "piece", "start", "length", "ids"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col)).mapInArrow(encode, schema)


class Histogram:
    """Pieces left of each length, with the lengths in order."""

    def __init__(self, counts: dict[int, int]):
        self.n = {w: c for w, c in counts.items() if c > 0}
        self.lengths = sorted(self.n)

    def take(self, w: int, count: int) -> None:
        self.n[w] -= count
        if not self.n[w]:
            del self.n[w]
            self.lengths.pop(bisect.bisect_left(self.lengths, w))

    def smallest(self, but: int, many: int) -> list[int]:
        """The smallest pieces left besides one of length ``but``."""
        out = []
        for w in self.lengths:
            out += [w] * min(self.n[w] - (w == but), many - len(out))
            if len(out) == many:
                break
        return out

    def largest(self, room: int, used: dict[int, int]) -> int | None:
        """The largest piece that fits into the room and is left beside the used ones."""
        at = bisect.bisect_right(self.lengths, room)
        for w in reversed(self.lengths[max(0, at - 3) : at]):
            if self.n[w] > used.get(w, 0):
                return w
        return None


def dominating(left: Histogram, w: int, capacity: int) -> list[int] | None:
    """The pieces beside one of length ``w`` that dominate every other choice, if such a set is known.

    Up to two others are looked at, as in the reduction procedure of Martello and Toth.
    """
    room = capacity - w
    small = left.smallest(w, 3)
    if not small or small[0] > room:
        return []
    one = left.largest(room, {w: 1})
    if one == room or len(small) < 2 or small[0] + small[1] > room:
        return [one]  # fills the sequence, or at most one other fits and this is the largest
    if len(small) == 3 and sum(small) <= room:
        return None
    # At most two others fit. In any pair the smaller one is at most half of the room.
    lesser = left.largest(room // 2, {w: 1})
    two = left.largest(room - one, {w: 1} | {one: 1 + (one == w)})
    if two is not None and lesser is not None and lesser <= two:
        return [one, two]  # each choice fits into the slots of these two
    return None


def reduce(counts: dict[int, int], capacity: int) -> tuple[list[Run], dict[int, int]]:
    """The sequences that some best packing has, and the pieces that are left."""
    left, runs = Histogram(counts), []
    at = len(left.lengths) - 1
    while at >= 0 and left.lengths:
        at = min(at, len(left.lengths) - 1)
        w = left.lengths[at]
        others = dominating(left, w, capacity)
        if others is None:
            at -= 1
            continue
        need: dict[int, int] = defaultdict(int)
        for x in [w, *others]:
            need[x] += 1
        # As often as the counts allow; the next look repeats the test on what is left.
        times = min(left.n[x] // k for x, k in need.items())
        if len(others) == 2 or (others and sum(others) < capacity - w):
            times = min(times, max(1, min(left.n[x] // k - 2 for x, k in need.items())))
        runs.append((times, dict(need)))
        for x, k in need.items():
            left.take(x, times * k)
        at = len(left.lengths) - 1 if at >= len(left.lengths) else max(at, 0)
    return runs, dict(left.n)


def best_fit(counts: dict[int, int], capacity: int) -> list[Run]:
    """Best fit, longest first, on counts: sequences with the same content are one run."""
    open_runs: dict[int, list[tuple[int, dict[int, int]]]] = defaultdict(list)  # by room left
    rooms: list[int] = []

    def put(room: int, count: int, content: dict[int, int]) -> None:
        if count:
            if not open_runs[room]:
                bisect.insort(rooms, room)
            open_runs[room].append((count, content))

    for w in sorted(counts, reverse=True):
        todo = counts[w]
        while todo:
            at = bisect.bisect_left(rooms, w)
            if at == len(rooms):
                each = min(capacity // w, todo)
                put(capacity - each * w, todo // each, {w: each})
                rest = todo % each
                put(capacity - rest * w, 1 if rest else 0, {w: rest})
                break
            room = rooms[at]
            count, content = open_runs[room].pop()
            if not open_runs[room]:
                rooms.pop(at)
            each = room // w
            full, rest = min(count, todo // each), 0
            put(room - each * w, full, {**content, w: content.get(w, 0) + each})
            todo -= full * each
            if full < count and todo:
                rest = min(todo, each)
                put(room - rest * w, 1, {**content, w: content.get(w, 0) + rest})
                todo -= rest
            put(room, count - full - (rest > 0), content)
    return [run for runs in open_runs.values() for run in runs]


def plan(counts: dict[int, int], capacity: int) -> list[Run]:
    fixed, rest = reduce(counts, capacity)
    return fixed + best_fit(rest, capacity)


def slots(runs: list[Run]) -> dict[int, list[tuple[int, int, int, int]]]:
    """For each length, in order of the pieces' numbers: (first number, pieces in a sequence, first sequence, offset)."""
    out: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
    numbers: dict[int, int] = defaultdict(int)
    sequence = 0
    for count, content in runs:
        offset = 0
        for w, each in sorted(content.items(), reverse=True):
            out[w].append((numbers[w], each, sequence, offset))
            numbers[w] += count * each
            offset += each * w
        sequence += count
    return out


def pack(cut_docs: DataFrame, capacity: int = CAPACITY, length_col: str = "length") -> DataFrame:
    """The rows with ``sequence_id`` and ``offset``; every length is between 1 and the capacity."""
    import numpy as np
    import pyarrow as pa
    from pyspark import TaskContext

    spark = cut_docs.sparkSession
    task, rank, base = (free_name(cut_docs.columns, n) for n in ("task", "rank", "base"))
    cut_docs = cut_docs.select([c for c in cut_docs.columns if c.lower() not in ("sequence_id", "offset")])
    kept = T.StructType(cut_docs.schema.fields)
    numbered = T.StructType([*kept.fields, T.StructField(task, T.IntegerType()), T.StructField(rank, T.LongType())])

    def number(batches):
        seen = np.zeros(capacity + 1, np.int64)
        me = TaskContext.get().partitionId()
        for batch in batches:
            w = batch.column(batch.schema.get_field_index(length_col)).to_numpy(zero_copy_only=False).astype(np.int64)
            if len(w) and not 0 < w.min() <= w.max() <= capacity:
                raise ValueError(f"lengths must be between 1 and {capacity}")
            order = np.argsort(w, kind="stable")
            ranks = np.empty(len(w), np.int64)
            counts = np.bincount(w, minlength=capacity + 1)
            starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
            ranks[order] = np.arange(len(w)) - starts[w[order]]
            ranks += seen[w]
            seen += counts
            columns = [*batch.columns, pa.array(np.full(len(w), me, np.int32)), pa.array(ranks)]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, task, rank])

    stage = Stage(spark, "packing")
    rows = stage.keep("rows", cut_docs.mapInArrow(number, numbered))
    by_task = rows.groupBy(length_col, task).agg(F.count("*").alias("n"))
    counts = {r[0]: r[1] for r in by_task.groupBy(length_col).agg(F.sum("n")).collect()}  # at most ``capacity`` rows
    table = {w: np.array(x, np.int64) for w, x in slots(plan(counts, capacity)).items()}
    before = Window.partitionBy(length_col).orderBy(task).rowsBetween(Window.unboundedPreceding, -1)
    bases = by_task.select(length_col, task, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(base))
    placed = T.StructType([*kept.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def place(batches):
        for batch in batches:
            names = batch.schema.names
            w = batch.column(names.index(length_col)).to_numpy(zero_copy_only=False).astype(np.int64)
            at = batch.column(names.index(rank)).to_numpy() + batch.column(names.index(base)).to_numpy()
            sequence, offset = np.zeros(len(w), np.int64), np.zeros(len(w), np.int64)
            for x in np.unique(w):
                mine = np.flatnonzero(w == x)
                runs = table[int(x)]
                run = runs[np.searchsorted(runs[:, 0], at[mine], side="right") - 1]
                k = at[mine] - run[:, 0]
                sequence[mine] = run[:, 2] + k // run[:, 1]
                offset[mine] = run[:, 3] + k % run[:, 1] * x
            columns = [batch.column(names.index(c)) for c in kept.names] + [pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(columns, [*kept.names, "sequence_id", "offset"])

    joined = rows.join(bases, [length_col, task]).select(*kept.names, rank, base)
    return joined.mapInArrow(place, placed)


