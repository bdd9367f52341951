"""Best-fit packing of tokenised documents into sequences of fixed length by bin completion.

1. Each document is tokenised once, ended with id 0 and, if longer than a sequence, cut into full pieces behind a
   shorter first piece. The pieces, with their place among the pieces of the same length in their partition, are checkpointed.
2. Sizes are at most the sequence length, so the whole instance is a histogram with that many counts, however large the
   corpus. The better of best-fit decreasing and one pass of bin completion (the filling of least waste around the largest
   size left, as often as the counts allow) is the incumbent. While it is above the lower bound, branch and bound goes over
   the undominated fillings of the largest size left; it ends at the bound or after a fixed number of nodes.
3. The patterns (a table bounded by the sequence length, not by the corpus) are broadcast; each piece finds its slot from
   its length and its index among the pieces of that length.

Edge cases: null and empty texts are the single id 0; repeated rows are packed each; a null doc_id is kept; an empty
table gives no rows; other columns of the input are left out.
"""

from __future__ import annotations

import sys
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weftlink.llm.common import cut, ship
from weftlink.llm.tokens import Packer

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, place long"
SLOTS = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def pieces_of(docs: DataFrame, tokenizer: str, capacity: int, end_id: int = 0) -> DataFrame:
    """One row per piece, with (part, place): its partition and its index there among the pieces of its length."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        packer, seen, end = Packer.at(tokenizer), Counter(), end_id.to_bytes(4, "little")
        part = TaskContext.get().partitionId()
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = memoryview(packer.pack(text.as_py() or "") + end)
                n, start, piece = len(ids) // 4, 0, 0
                while start < n:
                    length = (n % capacity or capacity) if piece == 0 else capacity
                    for column, value in zip(out, (doc_id, piece, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), part, seen[length]), strict=True):
                        column.append(value)
                    seen[length] += 1
                    start, piece = start + length, piece + 1
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            names = ("doc_id", "piece", "start", "length", "ids_crc32", "part", "place")
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, PIECES)


def completions(sizes: list[int], counts: dict[int, int], room: int, nodes: int = 4000) -> tuple[int, ...]:
    """The filling of `room` with least waste (then fewest items) from `sizes` (descending) with `counts`.

    Depth-first over sizes in descending order. The incumbent is the best-fit filling; a branch is cut when even filling
    its whole rest could not waste less, and fillings that a larger single item dominates are never opened, because each
    level starts at the largest size that fits. `nodes` bounds the search; the incumbent stands when it runs out.
    """
    best: list[int] = []
    left = room
    for s in _fitting(sizes, left):
        while s <= left and best.count(s) < counts[s]:
            best.append(s)
            left -= s
    waste, answer, budget = left, tuple(best), nodes
    smallest = sizes[-1] if sizes else 0
    picked: list[int] = []

    def down(i: int, space: int, had: int) -> None:
        nonlocal waste, answer, budget
        if space < waste or (space == waste and len(picked) < len(answer)):
            waste, answer = space, tuple(picked)
        if space < smallest or budget <= 0 or (waste == 0 and len(picked) + 1 >= len(answer)):
            return
        for j in range(max(i, _first(sizes, space)), len(sizes)):
            s = sizes[j]
            used = had if j == i else 0
            if used >= counts[s]:
                continue
            budget -= 1
            picked.append(s)
            down(j, space - s, used + 1)
            picked.pop()
            if budget <= 0 or (waste == 0 and len(picked) + 1 >= len(answer)):
                return

    down(0, room, 0)
    return answer


def _first(sizes: list[int], room: int) -> int:
    """Index of the largest of `sizes` (descending) that fits."""
    return bisect_left(sizes, -room, key=lambda s: -s)


def _fitting(sizes: list[int], room: int) -> list[int]:
    return sizes[_first(sizes, room) :]


def lower_bound(histogram: dict[int, int], capacity: int) -> int:
    """Martello and Toth's bound: for each k, sizes over capacity-k stand alone and cannot take what is at least k."""
    best = -(-sum(s * n for s, n in histogram.items()) // capacity)
    big = np.zeros(capacity + 2, dtype=np.int64)
    for s, n in histogram.items():
        big[s] += n
    count, mass = np.cumsum(big), np.cumsum(big * np.arange(capacity + 2))
    for k in range(1, capacity // 2 + 1):
        alone = count[capacity] - count[capacity - k]
        half = count[capacity - k] - count[capacity // 2]
        spare = half * capacity - (mass[capacity - k] - mass[capacity // 2])
        small = mass[capacity // 2] - mass[k - 1]
        best = max(best, int(alone + half + max(0, -(-(small - spare) // capacity))))
    return best


Patterns = list[tuple[tuple[int, ...], int]]


def best_fit(histogram: dict[int, int], capacity: int) -> Patterns:
    """Best-fit decreasing over the histogram: bins of equal content are one group, so its work does not grow with the counts."""
    groups: dict[int, Patterns] = {capacity: []}
    rooms = []  # what is left in open bins, ascending
    for s in sorted((s for s, n in histogram.items() if n > 0), reverse=True):
        n = histogram[s]
        while n:
            at = bisect_left(rooms, s)
            room = rooms[at] if at < len(rooms) else capacity
            fits = room // s
            if at < len(rooms):
                fill, bins = groups[room].pop()
            else:
                fill, bins = (), -(-n // fits)
            whole = min(bins, n // fits)
            rest = n - whole * fits if whole < bins else 0
            parts = [(fill + (s,) * fits, whole), (fill + (s,) * rest, 1 if rest else 0), (fill, bins - whole - (1 if rest else 0))]
            n -= whole * fits + rest
            for items, times in parts:
                if times and items:
                    left = capacity - sum(items)
                    if not groups.setdefault(left, []):
                        _place(rooms, left)
                    groups[left].append((items, times))
            if room < capacity and not groups[room]:
                rooms.remove(room)
    return [p for group in groups.values() for p in group]


def _place(rooms: list[int], room: int) -> None:
    at = bisect_left(rooms, room)
    if at == len(rooms) or rooms[at] != room:
        rooms.insert(at, room)


def fillings(counts: dict[int, int], capacity: int, budget: list[int]) -> Iterator[tuple[int, ...]]:
    """Fillings around the largest size, descending in their sizes; those that an unused size could still join, or in which one could take a smaller item's place, are dominated and left out."""
    sizes = sorted(counts, reverse=True)

    def down(i: int, picked: tuple[int, ...], room: int) -> Iterator[tuple[int, ...]]:
        budget[0] -= 1
        if budget[0] <= 0:
            return
        used = Counter(picked)
        free = [s for s in sizes if counts[s] > used[s]]
        for j in range(max(i, _first(sizes, room)), len(sizes)):
            if counts[sizes[j]] > used[sizes[j]]:
                yield from down(j, (*picked, sizes[j]), room - sizes[j])
        if not any(x <= room or any(y < x <= y + room for y in used if y != picked[0]) for x in free):
            yield picked

    return down(0, (sizes[0],), capacity - sizes[0])


def improved(histogram: dict[int, int], capacity: int, incumbent: Patterns, nodes: int) -> Patterns:
    """Branch and bound from `incumbent`: over the undominated fillings of the largest size left and how often each is laid down."""
    best, fewest, budget = incumbent, sum(t for _, t in incumbent), [nodes]  # the fillings' own steps count as well
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 2 * nodes + 1000))
    floor = lower_bound(histogram, capacity)

    def down(counts: dict[int, int], laid: Patterns, used: int) -> None:
        nonlocal best, fewest
        if not counts:
            if used < fewest:
                best, fewest = laid, used
            return
        budget[0] -= 1
        if budget[0] <= 0 or used + lower_bound(counts, capacity) >= fewest:
            return
        for fill in fillings(counts, capacity, budget):
            pattern = Counter(fill)
            for times in range(min(counts[s] // n for s, n in pattern.items()), 0, -1):
                left = {s: n - pattern[s] * times for s, n in counts.items() if n > pattern[s] * times}
                down(left, [*laid, (fill, times)], used + times)
                if budget[0] <= 0 or fewest <= floor:
                    return

    down({s: n for s, n in histogram.items() if n > 0}, [], 0)
    return best


def plan_patterns(histogram: dict[int, int], capacity: int, nodes: int = 1000) -> Patterns:
    """(sizes, how often) of every pattern; the counts of `histogram` are used up exactly.

    The better of best-fit decreasing and bin completion; where it is above the lower bound, branch and bound goes on from it.
    It is fewest for sure when it meets the bound or the search ends within `nodes`."""
    plan = min(best_fit(histogram, capacity), completed(histogram, capacity), key=lambda p: sum(t for _, t in p))
    if sum(t for _, t in plan) > lower_bound(histogram, capacity):
        plan = improved(histogram, capacity, plan, nodes)
    return plan


def completed(histogram: dict[int, int], capacity: int) -> Patterns:
    """One pass of bin completion: the filling of least waste around the largest size left, as often as the counts allow."""
    counts = {s: n for s, n in histogram.items() if n > 0}
    patterns: list[tuple[tuple[int, ...], int]] = []
    while counts:
        sizes = sorted(counts, reverse=True)
        first = sizes[0]
        counts[first] -= 1
        rest = [s for s in sizes if counts[s] > 0]
        fill = completions(rest, counts, capacity - first)
        counts[first] += 1
        pattern = Counter((first, *fill))
        times = min(counts[s] // n for s, n in pattern.items())
        for s, n in pattern.items():
            counts[s] -= n * times
            if not counts[s]:
                del counts[s]
        patterns.append((tuple(sorted(pattern.elements(), reverse=True)), times))
    return patterns


def slot_table(patterns: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """Rows (size, first index, first sequence, copies in the pattern, offset), sorted by size and first index."""
    rows, used, base = [], Counter(), 0
    for sizes, times in patterns:
        offset = 0
        for s, n in sorted(Counter(sizes).items(), reverse=True):
            rows.append((s, used[s], base, n, offset))
            used[s] += n * times
            offset += s * n
        base += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def pack_sequences(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """The packing of `docs` (doc_id, text); see the module's text."""
    ship(docs.sparkSession)
    pieces = cut(pieces_of(docs, tokenizer, capacity, end_id))
    per_part = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = per_part.select("part", "length", F.coalesce(before, F.lit(0)).alias("before"))
    histogram = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = pieces.sparkSession.sparkContext.broadcast(slot_table(plan_patterns(histogram, capacity)))

    def place(batches: Iterator) -> Iterator:
        import pyarrow as pa

        table = slots.value
        keys = table[:, 0] * (1 << 44) + table[:, 1]
        for batch in batches:
            cols = {n: batch.column(n) for n in batch.schema.names}
            length, index = (cols[n].to_numpy(zero_copy_only=False) for n in ("length", "index"))
            row = table[np.searchsorted(keys, length * (1 << 44) + index, side="right") - 1]
            t = index - row[:, 1]
            sequence, offset = row[:, 2] + t // row[:, 3], row[:, 4] + t % row[:, 3] * length
            yield pa.RecordBatch.from_arrays(
                [cols["doc_id"], cols["piece"], cols["start"], cols["length"], cols["ids_crc32"], pa.array(sequence), pa.array(offset)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    indexed = pieces.join(starts, ["part", "length"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("place")).alias("index"))
    return indexed.mapInArrow(place, SLOTS)
