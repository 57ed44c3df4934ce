"""SimHash near-duplicates: fingerprints of word shingles, linked within a Hamming distance through pigeonhole blocks."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridweave.llm.common import candidate_blocks, fresh, member_lists, spanning_forest
from gridweave.operators.graph import connected_components
from gridweave.sources.scratch import written
from gridweave.sources.workers import map_arrow

#: Hashes whose bits are counted at a time, so that a very long text needs no more memory than others.
STEP = 32_768


def fingerprint(text: str | None, width: int = 4, seed: int = 42) -> int:
    """64-bit SimHash: a bit is set where over half the shingles' hashes have it; no words give 0.

    Letters A-Z are lower-cased, words are split at ASCII white space, shingles are counted with repeats;
    a text with fewer words than ``width`` is one shingle.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - width + 1)
    first, last = starts[:n].tolist(), ends[len(words) - n :].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, n, STEP):
        hashes = np.array([digest(line[i:j], seed) for i, j in zip(first[at : at + STEP], last[at : at + STEP])], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > n, bitorder="little")
    return int(bits.view("<u8")[0])


def _text_key(text_col: str) -> list[Column]:
    """128 bits of a text, by which rows that share an id are told apart without moving their texts; a null text has a key of its own."""
    text = F.col(text_col)
    return [F.xxhash64(text).alias("ka"), F.xxhash64(F.lit(1), text, text.isNull()).alias("kb")]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, seed: int = 42) -> DataFrame:
    """One row per row of ``docs``: the id, ``fp``, the fingerprint as a signed 64-bit integer, and ``ka`` and ``kb`` (``_text_key``).
    Null text counts as empty."""
    kept = docs.select(F.col(text_col).alias("_text"), F.col(id_col), *_text_key(text_col))
    schema = f"`{id_col}` {dict(kept.dtypes)[id_col]}, ka bigint, kb bigint, fp bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(t.as_py(), width, seed) for t in batch.column(0)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(values.view(np.int64))], names=[id_col, "ka", "kb", "fp"])

    return map_arrow(kept, run, schema)


def block_masks(distance: int, blocks: int) -> list[int]:
    """Bit masks of ``blocks - distance`` of ``blocks`` runs of bits: two fingerprints within ``distance`` agree under one of them."""
    if blocks <= distance:
        raise ValueError("there must be more blocks than differing bits")
    cuts = [round(64 * i / blocks) for i in range(blocks + 1)]
    runs = [((1 << cuts[i + 1]) - 1) ^ ((1 << cuts[i]) - 1) for i in range(blocks)]
    return [sum(runs[i] for i in chosen) for chosen in combinations(range(blocks), blocks - distance)]


def close_pairs(prints: DataFrame, distance: int = 4, blocks: int = 6, block_rows: int = 1024) -> DataFrame:
    """Tree edges ``a``, ``b`` between ids of distinct fingerprints (columns ``id``, ``fp``) within ``distance`` bits.

    Distance 4 over 6 blocks leaves two whole blocks in common, so a row goes to 15 buckets of 21 bits (``blocks_for``). Buckets are
    compared in bounded pairs of chunks; of each, only a spanning forest of its links is emitted, which has the same
    components as all links and never more rows than members.
    """
    masks = [m - (1 << 64) if m >> 63 else m for m in block_masks(distance, blocks)]
    keyed = prints.select("id", "fp", F.explode(F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("k")) for t, m in enumerate(masks)])).alias("_key")).select("id", "fp", "_key.t", "_key.k")
    groups = candidate_blocks(keyed, ["t", "k"], F.xxhash64("fp"), ["id", "fp"], block_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            offsets, flat = member_lists(batch)
            chunk, ids, fps = (flat.field(name).to_numpy(zero_copy_only=False) for name in ("chunk", "id", "fp"))
            fps = fps.view(np.uint64)
            lengths = np.diff(offsets)
            twos = offsets[:-1][lengths == 2]
            twos = twos[np.bitwise_count(fps[twos] ^ fps[twos + 1]) <= distance]
            left, right = [ids[twos]], [ids[twos + 1]]
            for group in np.flatnonzero(lengths > 2).tolist():
                part = slice(int(offsets[group]), int(offsets[group + 1]))
                own, name, side = fps[part], ids[part], chunk[part]
                close = np.bitwise_count(own[:, None] ^ own[None, :]) <= distance
                if side.min() != side.max():
                    close &= side[:, None] != side[None, :]
                if tree := list(spanning_forest(close)):
                    parents, children = np.array(tree).T
                    left.append(name[parents])
                    right.append(name[children])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(left)), pa.array(np.concatenate(right))], names=["a", "b"])

    return map_arrow(groups.select("members"), run, "a bigint, b bigint")


def blocks_for(prints: int, distance: int = 4) -> int:
    """Number of blocks for so many different prints: enough key bits that a bucket holds few of them, at the price of more keys a row.

    At distance 4, 5 blocks give 5 keys of 13 bits, 6 give 15 of 21 and 8 give 70 of 32. With a key row as dear as some 50
    comparisons, these cost least up to about 2^20, up to about 2^28 and beyond. All find the same pairs.
    """
    return distance + (1 if prints <= 1 << 20 else 2 if prints <= 1 << 28 else 4)


def _named(docs: DataFrame, id_col: str, text_col: str, width: int, seed: int, distance: int, blocks: int | None) -> DataFrame:
    """``fingerprints`` of ``docs`` with ``component_id``."""
    prints = written(fingerprints(docs, id_col, text_col, width, seed), "prints")
    nodes = written(prints.groupBy("fp").agg(F.min(id_col).alias("id")), "nodes")
    reach = connected_components(close_pairs(nodes.where("id IS NOT NULL"), distance, blocks or blocks_for(nodes.count(), distance)))
    named = nodes.join(reach, F.col("id") == F.col("node"), "left").select("fp", F.coalesce("component", "id").alias("component_id"))
    return prints.join(named, "fp")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, seed: int = 42, distance: int = 4, blocks: int | None = None) -> DataFrame:
    """One row per row of ``docs``: the id, ``fingerprint`` (16 hex digits) and ``component_id``, the smallest id reachable by links.

    Equal fingerprints are one node, so groups of copies cost one row; nothing is dropped or capped. ``blocks`` is ``blocks_for`` the
    number of different fingerprints where it is not given. Null and empty texts have fingerprint zero and link with each other
    like any other. A null id gets the component of its fingerprint, or null if no row of that fingerprint has an id. Repeated
    rows are returned as often as they come. No rows give no rows. Other columns of ``docs`` are ignored.
    """
    return _named(docs, id_col, text_col, width, seed, distance, blocks).select(F.col(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, seed: int = 42, distance: int = 4, blocks: int | None = None, most_held: int = 2_000_000) -> DataFrame:
    """One row of ``docs`` for each component of ``simhash_components``, with all its columns: one with the smallest id, once.

    Of rows with equal ids but different texts each belongs to the component of its own text; if such rows share a component and its smallest
    id, one of them stays (the smallest by ``_text_key``). Rows with equal id and text count as repeated and stay once, whatever
    their other columns say. Null ids are never compared away: their rows all stay. Null and empty texts are near copies of each other.
    No rows give no rows. What goes is decided on ids and hashes, at 25 bytes a row; up to ``most_held`` such rows are held by every task, and the texts
    stay where they are; more are joined by key, with the same result.
    """
    ka, kb, judged = (fresh(docs, name) for name in ("ka", "kb", "judged"))
    rows = written(_named(docs, id_col, text_col, width, seed, distance, blocks).where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id"), "ka", "kb", "component_id").agg(F.count(F.lit(1)).alias("n")), "rows")
    first = rows.where("id = component_id").groupBy("id").agg(F.min(F.struct("ka", "kb")).alias("first"), F.count(F.lit(1)).alias("texts")).where("texts > 1").select("id", "first")
    others = rows.where("id = component_id").join(first, "id").where("ka != first.ka OR kb != first.kb")
    gone = rows.where("id != component_id").select("id", "ka", "kb").unionByName(others.select("id", "ka", "kb"))
    twice = rows.where("id = component_id AND n > 1").select("id", "ka", "kb").join(gone, ["id", "ka", "kb"], "left_anti")
    known = written(gone.withColumn("copies", F.lit(False)).unionByName(twice.withColumn("copies", F.lit(True))), "judged").select(F.col("id").alias(judged), F.col("ka").alias(ka), F.col("kb").alias(kb), F.col("copies").alias(fresh(docs, "copies")))
    copies = known.columns[-1]
    text_a, text_b = _text_key(text_col)
    match = (F.col(id_col) == F.col(judged)) & (text_a == F.col(ka)) & (text_b == F.col(kb))
    if known.count() <= most_held:
        known = F.broadcast(known)
    stay = docs.join(known, match, "left_anti")
    once = docs.join(known.where(F.col(copies)), match).dropDuplicates([judged, ka, kb])
    return stay.unionByName(once.select(*docs.columns))
