"""Best-fit packing of documents into sequences of a fixed number of tokens.

A linear grouping scheme over the counts of lengths, which are as many as a sequence has
tokens however large the corpus is:

1. the large pieces, sorted by length, form groups of equal cardinality, and each counts
   as long as the longest of its group;
2. for these few sizes, configurations (which sizes share a sequence) and their numbers
   are optimised by column generation;
3. actual pieces take the places of the rounded ones, so the rounded-up room is free again;
4. what is left over and all small pieces go where they fit best.

The result is a short plan of runs: so many sequences alike, with so many pieces of each
length. Tasks number the pieces of each length and look up their place in the plan.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeproof.llm.encoding import encoder_of
from lakeproof.llm.support import in_slices, sized_join, staged, text_of

#: The ranks of byte_bpe_50k.json: the same ids, several times faster.
VOCABULARY = "byte_bpe_50k.tiktoken"
END_ID = 2
SEQUENCE_TOKENS = 1024
GROUPS = 64
#: Pieces up to this part of a sequence are small.
SMALL_PART = 1 / 8
PIECE_SCHEMA = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, task int, nth bigint"


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full ones, after a shorter first one if need be."""
    if length <= capacity:
        return [(0, length)]
    first = length % capacity
    return [(0, first)] * bool(first) + [(at, capacity) for at in range(first, length, capacity)]


def token_pieces(documents: DataFrame, vocabulary: str | None = None, end_id: int = END_ID, capacity: int = SEQUENCE_TOKENS) -> DataFrame:
    """Every piece with its length and checksum, and which of its task's pieces of that length it is."""
    path = vocabulary or public_tokenizers.path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, seen, end = TaskContext.get().partitionId(), Counter(), np.array([end_id], "<u4").tobytes()
        encoder = encoder_of(path)
        for batch in in_slices(batches):
            rows = []
            for doc_id, ids in zip(batch["doc_id"].to_pylist(), encoder.encode(batch["text"].to_pylist())):
                ids += end
                for number, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    crc = zlib.crc32(memoryview(ids)[4 * start:4 * (start + length)])
                    rows.append((doc_id, number, start, length, crc, task, seen[length]))
                    seen[length] += 1
            columns = list(zip(*rows))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], [f.split()[0] for f in PIECE_SCHEMA.split(", ")]
            )

    return documents.select("doc_id", text_of()).mapInArrow(run, PIECE_SCHEMA)


def best_configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[list[int], float]]:
    """Configurations (how many of each size) and their numbers, for the fewest sequences if parts of one counted.

    Column generation: of all configurations only those that improve the current solution
    are ever looked at; each is the answer to a knapsack with the sizes' current prices.
    """
    count = len(sizes)
    widths = np.array(sizes)
    patterns = np.diag([capacity // s for s in sizes]).astype(float)
    inverse = np.linalg.inv(patterns)
    for _ in range(50 * count):
        prices = inverse.sum(axis=0)
        worth, pattern = _knapsack(widths, prices, capacity)
        if worth <= 1 + 1e-7:
            break
        numbers, change = inverse @ np.array(demand, float), inverse @ pattern
        able = change > 1e-9
        leaving = int(np.argmin(np.where(able, numbers / np.where(able, change, 1), np.inf)))
        patterns[:, leaving] = pattern
        inverse = np.linalg.inv(patterns)
    numbers = inverse @ np.array(demand, float)
    return [([int(n) for n in patterns[:, k]], float(numbers[k])) for k in range(count) if numbers[k] > 1e-9]


def _knapsack(widths: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    worth, taken = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        worth[room] = worth[room - 1]
        fits = np.flatnonzero(widths <= room)
        if len(fits):
            gains = worth[room - widths[fits]] + prices[fits]
            best = int(np.argmax(gains))
            if gains[best] > worth[room] + 1e-12:
                worth[room], taken[room] = gains[best], fits[best]
    pattern, room = np.zeros(len(widths)), capacity
    while room > 0:
        if taken[room] < 0:
            room -= 1
        else:
            pattern[taken[room]] += 1
            room -= widths[taken[room]]
    return float(worth[capacity]), pattern


@dataclass
class Run:
    """So many sequences alike: (length, how many of it) in order, and the room left in each."""

    sequences: int
    slots: list[tuple[int, int]]
    room: int


def plan_runs(lengths: dict[int, int], capacity: int = SEQUENCE_TOKENS, groups: int = GROUPS) -> list[Run]:
    """Runs that hold exactly the pieces counted in ``lengths``."""
    runs = [Run(lengths[capacity], [(capacity, 1)], 0)] if lengths.get(capacity) else []
    least = max(1, int(capacity * SMALL_PART)) + 1
    large = [(n, lengths[n]) for n in sorted(lengths, reverse=True) if least <= n < capacity and lengths[n]]
    left = Counter({n: c for n, c in lengths.items() if n < least and c})
    if large:
        shares = _equal_groups(large, groups)
        sizes = [share[0][0] for share in shares]
        for pattern, number in best_configurations(sizes, [sum(c for _, c in s) for s in shares], capacity):
            runs += _substituted(pattern, int(number + 1e-6), shares, capacity)
        for share in shares:
            left.update(dict(_merged(share)))
    _best_fit(runs, left, capacity)
    return [r for r in runs if r.sequences]


def _equal_groups(large: list[tuple[int, int]], groups: int) -> list[list[tuple[int, int]]]:
    """The pieces, longest first, in groups of equal cardinality. A length alone may fill several groups, which are one size."""
    total = sum(c for _, c in large)
    share = -(-total // groups)
    found: list[list[tuple[int, int]]] = [[]]
    room = share
    for length, count in large:
        while count:
            if room == 0:
                room = share
                if found[-1][0][0] != length:
                    found.append([])
            taken = min(count, room)
            found[-1].append((length, taken))
            count, room = count - taken, room - taken
    return [_merged(g) for g in found if g]


def _merged(share: list[tuple[int, int]]) -> list[tuple[int, int]]:
    counts: Counter[int] = Counter()
    for length, count in share:
        counts[length] += count
    return [(n, counts[n]) for n in sorted(counts, reverse=True) if counts[n]]


def _substituted(pattern: list[int], number: int, shares: list[list[tuple[int, int]]], capacity: int) -> list[Run]:
    """``number`` sequences of a configuration with actual pieces, as runs of equal ones. Takes the pieces from the shares."""
    wanted = [g for g, copies in enumerate(pattern) for _ in range(copies)]
    for g in set(wanted):
        number = min(number, sum(c for _, c in shares[g]) // pattern[g])
    if number <= 0:
        return []
    columns = [_take(shares[g], number) for g in wanted]
    runs, at = [], [0] * len(columns)
    done = 0
    while done < number:
        step = min(column[i][1] for column, i in zip(columns, at))
        lengths = Counter(column[i][0] for column, i in zip(columns, at))
        slots = sorted(lengths.items(), reverse=True)
        runs.append(Run(step, slots, capacity - sum(n * c for n, c in slots)))
        for k, column in enumerate(columns):
            length, count = column[at[k]]
            column[at[k]] = (length, count - step)
            at[k] += count == step
        done += step
    return runs


def _take(share: list[tuple[int, int]], number: int) -> list[tuple[int, int]]:
    taken = []
    while number:
        length, count = share[0]
        part = min(count, number)
        taken.append((length, part))
        number -= part
        if part == count:
            share.pop(0)
        else:
            share[0] = (length, count - part)
    return taken


def _best_fit(runs: list[Run], left: Counter[int], capacity: int) -> None:
    """Put pieces, longest first, into the sequences with the least room that takes them, or into new ones."""
    by_room: dict[int, list[Run]] = {}
    for run in runs:
        by_room.setdefault(run.room, []).append(run)
    for length in sorted(left, reverse=True):
        count = left[length]
        while count:
            room = min((r for r, held in by_room.items() if r >= length and held), default=None)
            if room is None:
                each = min(capacity // length, count)
                fresh = Run(max(count // each, 1), [], capacity)
                runs.append(fresh)
                by_room.setdefault(capacity, []).append(fresh)
                continue
            run = by_room[room].pop()
            each = min(room // length, count)
            filled = min(count // each, run.sequences)
            if filled < run.sequences:
                rest = Run(run.sequences - filled, list(run.slots), room)
                runs.append(rest)
                by_room[room].append(rest)
            run.sequences = filled
            run.slots.append((length, each))
            run.room = room - each * length
            by_room.setdefault(run.room, []).append(run)
            count -= filled * each


def plan_table(runs: list[Run]) -> dict[int, np.ndarray]:
    """By length: rows of (first rank, first sequence, offset, pieces of this length in one sequence), by rank."""
    entries: dict[int, list[tuple[int, int, int, int]]] = {}
    ranks: Counter[int] = Counter()
    first = 0
    for run in runs:
        offset = 0
        for length, each in run.slots:
            entries.setdefault(length, []).append((ranks[length], first, offset, each))
            ranks[length] += run.sequences * each
            offset += length * each
        first += run.sequences
    return {length: np.array(rows, np.int64) for length, rows in entries.items()}


def pack(documents: DataFrame, vocabulary: str | None = None, end_id: int = END_ID, capacity: int = SEQUENCE_TOKENS, groups: int = GROUPS) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece of every row.

    Null text is empty and packs as its end id alone; repeated rows and null ids are packed
    each. No documents give no rows. What the driver holds is one count for each length.
    """
    pieces = staged(token_pieces(documents, vocabulary, end_id, capacity), "pieces")
    by_task = pieces.groupBy("length", "task").agg(F.count("*").alias("count"))
    counted = staged(by_task.withColumn("before", F.coalesce(
        F.sum("count").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )), "piece-counts")
    lengths = {r["length"]: r["n"] for r in counted.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    plan = plan_table(plan_runs(lengths, capacity, groups))
    ranked = sized_join(pieces, counted.select("length", "task", "before"), ["length", "task"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth")).alias("rank")
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch["length"].to_numpy(), batch["rank"].to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for value in np.unique(length):
                rows, at = plan[int(value)], np.flatnonzero(length == value)
                entry = rows[np.searchsorted(rows[:, 0], rank[at], "right") - 1]
                nth, within = np.divmod(rank[at] - entry[:, 0], entry[:, 3])
                sequence[at], offset[at] = entry[:, 1] + nth, entry[:, 2] + within * value
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return ranked.mapInArrow(
        place, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    )
