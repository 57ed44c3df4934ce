"""Shared helpers: words, column names, bounded candidate blocks, spanning forests."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A word is a run of anything but these six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows of one candidate bucket that are compared in one task; larger buckets become pairs of chunks.
BLOCK = 1024


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it while ``df`` has a column of that name in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def word_count(text: Column) -> Column:
    """Number of words; null counts as none. Words start where a non-space follows a space or the start."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def candidate_blocks(keyed: DataFrame, keys: list[str], spread: Column, fields: list[str], block: int = BLOCK, own: str | None = None, carried: DataFrame | None = None) -> DataFrame:
    """Rows that share a bucket, as arrays of bounded length, such that each pair in a bucket meets in exactly one array.

    Buckets with one row are left out, and those without a row that has ``own`` set, if that is given. A bucket of ``n`` rows is cut into
    ``ceil(n / block)`` chunks by ``spread``; each two chunks (and each chunk with itself) form one array, so no task ever holds more
    than about two chunks however many rows share the bucket. ``carried`` has columns that only rows in such arrays need, by ``id``.
    Columns: the keys, ``lo``, ``hi`` (chunk numbers), ``members`` (array of struct of ``chunk`` and ``fields``).
    """
    counts = keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.max(own or F.lit(True)).alias("_own")).where("_n > 1 AND _own").drop("_own")
    chunks = F.ceil(F.col("_n") / F.lit(float(block))).cast("int")
    dealt = (
        keyed.join(counts, keys)
        .withColumn("_k", chunks)
        .withColumn("chunk", F.pmod(spread, F.col("_k")).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)))
        .withColumn("lo", F.least("chunk", "_other"))
        .withColumn("hi", F.greatest("chunk", "_other"))
    )
    if carried is not None:
        dealt = dealt.join(carried, "id")
    return dealt.groupBy(*keys, "lo", "hi").agg(F.collect_list(F.struct("chunk", *fields)).alias("members"))


def slices(batches: Iterator[pa.RecordBatch], text: int, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in slices whose texts (column number ``text``) have about ``most`` bytes, or one longer text, so that work on a slice is bounded."""
    for batch in batches:
        ends = pc.cumulative_sum(pc.fill_null(pc.binary_length(batch.column(text)), 0).cast(pa.int64())).to_numpy(zero_copy_only=False)
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right")))
            yield batch.slice(at, end - at)
            at = end


def member_lists(batch: pa.RecordBatch, column: str = "members") -> tuple[np.ndarray, pa.StructArray]:
    """Offsets and the flat struct array of a list column."""
    lists = batch.column(batch.schema.get_field_index(column))
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    offsets = lists.offsets.to_numpy()
    flat = lists.values.slice(int(offsets[0]), int(offsets[-1] - offsets[0]))
    return offsets - offsets[0], flat


def spanning_forest(close: np.ndarray) -> Iterator[tuple[int, int]]:
    """Tree edges (parent, child) of the graph with the square boolean adjacency ``close``; linear in its cells."""
    left = np.ones(len(close), bool)
    for root in range(len(close)):
        if not left[root]:
            continue
        left[root] = False
        stack = [root]
        while stack:
            node = stack.pop()
            found = np.flatnonzero(close[node] & left)
            left[found] = False
            for child in found.tolist():
                yield node, child
            stack.extend(found.tolist())
