"""Pack token sequences: a configuration linear program over the histogram of lengths, solved by multiplicative weights and rounded."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridweave.llm.common import slices
from gridweave.llm.tokens import encode
from gridweave.sources.scratch import written
from gridweave.sources.workers import map_arrow

#: Pieces of one length that one window group holds on average.
GROUP = 500


def pieces(docs: DataFrame, vocabulary: str, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents as token ids with a 0 at their end, cut into pieces: id, ``piece``, ``start``, ``length``, ``ids_crc32``.

    Only documents longer than ``capacity`` are cut; all their pieces but the first are full. Null text counts as empty, so every row has
    a piece.
    """
    kept = docs.select(F.col(id_col), F.col(text_col).alias("_text"))
    names = [id_col, "piece", "start", "length", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            rows, index = [], []
            for at, text in enumerate(batch.column(1)):
                ids = np.append(encode(text.as_py() or "", vocabulary), np.uint32(0)).astype("<u4")
                cuts = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)] if len(ids) > capacity else [0, len(ids)]
                for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    rows.append((piece, a, b - a, zlib.crc32(ids[a:b].tobytes())))
                    index.append(at)
            piece, start, length, crc = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(index, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))], names=names
            )

    return map_arrow(kept, run, f"`{id_col}` {dict(kept.dtypes)[id_col]}, piece int, start bigint, length bigint, ids_crc32 bigint")


def best_pattern(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> dict[int, int]:
    """Knapsack by dynamic programming: the multiset of sizes (index to count) with the highest price that fits."""
    value = np.zeros(capacity + 1)
    last = np.full(capacity + 1, -1)
    fit = np.searchsorted(sizes, np.arange(capacity + 1), side="right")
    for room in range(1, capacity + 1):
        value[room] = value[room - 1]
        if k := fit[room]:
            offer = value[room - sizes[:k]] + prices[:k]
            j = int(offer.argmax())
            if offer[j] > value[room]:
                value[room], last[room] = offer[j], j
    pattern: dict[int, int] = {}
    room = capacity
    while room > 0:
        if last[room] < 0:
            room -= 1
        else:
            pattern[int(last[room])] = pattern.get(int(last[room]), 0) + 1
            room -= int(sizes[last[room]])
    return pattern


def solve(sizes: np.ndarray, counts: np.ndarray, capacity: int, rounds: int, rate: float) -> list[tuple[dict[int, int], float]]:
    """Fractional covering of the histogram by patterns, by multiplicative weights.

    Prices start at size over capacity, the dual of the bound by volume, and grow for sizes that lag behind. Each round prices all
    patterns by a knapsack and gives the best one an equal share of all sequences.
    """
    bins = max(1.0, float((sizes * counts).sum()) / capacity)
    covered = np.zeros(len(sizes))
    found: dict[tuple, float] = {}
    step = bins / rounds
    for now in range(rounds):
        lag = np.clip((now + 1) / rounds - covered / counts, -1.0, 1.0)
        prices = sizes / capacity * np.exp(rate * lag)
        pattern = best_pattern(sizes, prices, capacity)
        if not pattern:
            break
        key = tuple(sorted(pattern.items()))
        found[key] = found.get(key, 0.0) + step
        covered[list(pattern)] += step * np.array(list(pattern.values()))
    return sorted(((dict(k), x) for k, x in found.items()), key=lambda p: -p[1])


def best_fit(sizes: np.ndarray, left: np.ndarray, bins: list[tuple[dict[int, int], int]], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Put what is ``left`` of each size into the room of ``bins`` (pattern, times) and then into new ones, largest first; equal bins at once."""
    out = []
    todo = [(dict(pattern), capacity - sum(int(sizes[j]) * n for j, n in pattern.items()), times, len(sizes) - 1) for pattern, times in reversed(bins)]
    while todo or left.any():
        pattern, room, times, top = todo.pop() if todo else ({}, capacity, 1 << 60, len(sizes) - 1)
        j = min(top, int(np.searchsorted(sizes, room, side="right")) - 1)
        while j >= 0 and not left[j]:
            j -= 1
        if j < 0:
            out.append((pattern, times))
            continue
        most = int(min(room // sizes[j], left[j]))
        each = most if not pattern else int(min(most, max(1, left[j] // times)))  # a new bin takes all it can, and as many are opened as that fills
        some = int(min(times, left[j] // each))
        if some < times and pattern:
            todo.append((pattern, room, times - some, top))
        left[j] -= each * some
        todo.append((pattern | {j: pattern.get(j, 0) + each}, room - each * int(sizes[j]), some, j))
    return out


@dataclass(frozen=True)
class Plan:
    """Patterns with their multiplicities: for each (size, pattern), which ranks of the size fill it and where."""

    bins: int
    size: np.ndarray
    rank: np.ndarray  # first rank of this size that belongs here
    first: np.ndarray  # first sequence of the pattern
    each: np.ndarray  # pieces of this size in one sequence
    offset: np.ndarray  # where they begin in it

    def place(self, size: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the ``rank``-th piece of each size."""
        at = np.searchsorted(self.size * (1 << 44) + self.rank, size * (1 << 44) + rank, side="right") - 1
        inside = rank - self.rank[at]
        return self.first[at] + inside // self.each[at], self.offset[at] + inside % self.each[at] * size


def plan(histogram: dict[int, int], capacity: int = 2048, rounds: int = 120, rate: float = 0.5, passes: int = 3, levels: tuple[float, ...] = (1.0, 0.9, 0.75, 0.5, 0.25, 0.0)) -> Plan:
    """Cover a histogram of lengths exactly by sequences of ``capacity``.

    The configuration program is solved for all lengths; its solution is rounded down to whole sequences that no length exceeds,
    and what is left is solved again, ``passes`` times in all. What remains goes to the room of these sequences and to new ones, best
    fit. Rounding may leave that a rest that fits badly, so this is tried with less of the program's solution, down the ``levels``, until a
    plan has no more sequences than the volume asks for; of all tried, the first with the fewest is taken. The work depends on
    the number of distinct lengths, at most ``capacity``, not on the number of pieces.
    """
    sizes = np.array(sorted(histogram), np.int64)
    counts = np.array([histogram[int(s)] for s in sizes], np.int64)
    bound = -(-int((sizes * counts).sum()) // capacity)
    left = counts.copy()
    solved: list[tuple[dict[int, int], int]] = []
    for again in range(passes):
        present = np.flatnonzero(left)
        if len(present) < 2:
            break
        for pattern, amount in solve(sizes[present], left[present].astype(float), capacity, max(1, rounds >> again), rate):
            own = {int(present[j]): n for j, n in pattern.items()}
            times = min(int(amount), *(int(left[j]) // n for j, n in own.items()))
            if times:
                solved.append((own, times))
                for j, n in own.items():
                    left[j] -= n * times
    chosen: list[tuple[dict[int, int], int]] | None = None
    for level in levels:
        kept = [(pattern, int(times * level)) for pattern, times in solved if int(times * level)]
        rest = counts.copy()
        for pattern, times in kept:
            for j, n in pattern.items():
                rest[j] -= n * times
        kept.sort(key=lambda p: sum(int(sizes[j]) * n for j, n in p[0].items()))
        tried = best_fit(sizes, rest, kept, capacity)
        if chosen is None or sum(n for _, n in tried) < sum(n for _, n in chosen):
            chosen = tried
        if sum(n for _, n in chosen) <= bound:
            break
    rows, used, bins = [], np.zeros(len(sizes), np.int64), 0
    for pattern, times in chosen or []:
        offset = 0
        for j in sorted(pattern, reverse=True):
            rows.append((int(sizes[j]), int(used[j]), bins, pattern[j], offset))
            used[j] += pattern[j] * times
            offset += pattern[j] * int(sizes[j])
        bins += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return Plan(bins, *table.T)


def packed(docs: DataFrame, vocabulary: str, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text", rounds: int = 120) -> DataFrame:
    """One row per piece of a document (see ``pieces``) with ``sequence_id`` and ``offset``, its place in a sequence of ``capacity`` ids.

    Pieces of a sequence follow each other without gaps from 0. Only the histogram of lengths, at most ``capacity`` rows, goes to the
    driver. Pieces of one length are numbered in two steps, within buckets and over buckets, so that a length that a third of
    all pieces have is no single task. Empty and null texts are pieces of one id; very long texts are cut; repeated rows are pieces
    of their own; no rows give no rows; other columns are ignored.
    """
    cut = written(pieces(docs, vocabulary, capacity, id_col, text_col), "pieces")
    sums = cut.groupBy("length").agg(F.count(F.lit(1)).alias("n"))
    histogram = {row["length"]: row["n"] for row in sums.collect()}
    layout = plan(histogram, capacity, rounds)
    buckets = F.create_map(*[F.lit(x) for size, n in histogram.items() for x in (size, -(-n // GROUP))]) if histogram else F.lit(None)
    dealt = cut.withColumn("_bucket", F.pmod(F.xxhash64(id_col, "piece"), F.element_at(buckets, F.col("length"))) if histogram else F.lit(0).cast("long"))
    ahead = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = dealt.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n")).withColumn("_ahead", F.coalesce(F.sum("_n").over(ahead), F.lit(0))).drop("_n")
    own = Window.partitionBy("length", "_bucket").orderBy(id_col, "piece", "ids_crc32")
    ranked = dealt.join(before, ["length", "_bucket"]).withColumn("_rank", F.col("_ahead") + F.row_number().over(own) - 1).select(*cut.columns, "_rank")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("length", "_rank"))
            sequence, offset = layout.place(length, rank) if len(length) else (length, rank)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())], names=[*batch.schema.names[:-1], "sequence_id", "offset"])

    kind = dict(cut.dtypes)[id_col]
    return map_arrow(ranked, run, f"`{id_col}` {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")
