"""Embedding near-duplicates by lattice hashing: random projections, cells of the E8 lattice in several tables, verified cosines."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridweave.llm.common import candidate_blocks, member_lists, spanning_forest
from gridweave.operators.graph import connected_components
from gridweave.sources.scratch import written
from gridweave.sources.workers import map_arrow


@dataclass(frozen=True)
class Lattice:
    """Tables, neighbouring cells probed in each, size of a unit vector's projection in lattice units, seed."""

    tables: int = 5
    probes: int = 3
    scale: float = 1.75
    seed: int = 42


#: Odd multipliers that mix cell, table and group to a bucket's number.
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


@lru_cache(maxsize=1)
def minimal_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8: two entries of plus or minus one, or eight of plus or minus a half with an even number of minus signs."""
    out = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    out += [np.array(s) / 2 for s in product((1.0, -1.0), repeat=8) if np.prod(s) > 0]
    return np.array(out)


def _even(x: np.ndarray) -> np.ndarray:
    """Nearest point of D8 to each row: round, and where the sum is odd round the worst coordinate the other way."""
    out = np.rint(x)
    gap = x - out
    worst = np.abs(gap).argmax(1)
    rows = np.flatnonzero(out.sum(1) % 2)
    w = worst[rows]
    out[rows, w] += np.where(gap[rows, w] >= 0, 1.0, -1.0)
    return out


def nearest(x: np.ndarray) -> np.ndarray:
    """Nearest point of E8 (D8 and its copy shifted by halves) to each row of eight coordinates."""
    a, b = _even(x), _even(x - 0.5) + 0.5
    return np.where((((x - a) ** 2).sum(1) <= ((x - b) ** 2).sum(1))[:, None], a, b)


@lru_cache(maxsize=32)
def projections(dim: int, lattice: Lattice) -> tuple[np.ndarray, np.ndarray]:
    """For each table a projection to eight dimensions with orthonormal rows (as many as there are), scaled; and odd multipliers that hash cells."""
    rng = np.random.default_rng([lattice.seed, dim])
    out = np.zeros((lattice.tables, dim, 8))
    for t in range(lattice.tables):
        q = np.linalg.qr(rng.standard_normal((dim, min(dim, 8))))[0]
        out[t, :, : q.shape[1]] = q * (lattice.scale * np.sqrt(dim / 8))
    return out, rng.integers(1, 1 << 62, 8, dtype=np.int64) * 2 + 1


def row_products(rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """``rows @ columns``, summed up in the same order whatever other rows there are, so that a row's product is the same in any batch."""
    out = np.zeros((len(rows), columns.shape[1]))
    for k in range(columns.shape[0]):
        out += rows[:, k, None] * columns[k]
    return out


def cells(unit: np.ndarray, lattice: Lattice) -> np.ndarray:
    """Hashes (rows x tables x (1 + probes)) of each unit vector's own cell and of the neighbouring cells nearest to it."""
    maps, odd = projections(unit.shape[1], lattice)
    out = np.empty((len(unit), lattice.tables, 1 + lattice.probes), np.int64)
    near = minimal_vectors()
    with np.errstate(over="ignore"):
        for t in range(lattice.tables):
            x = row_products(unit, maps[t])
            own = nearest(x)
            out[:, t, 0] = ((2 * own).astype(np.int64) * odd).sum(1)
            if lattice.probes:
                best = np.argsort(-row_products(x - own, near.T), axis=1, kind="stable")[:, : lattice.probes]
                beside = (2 * (own[:, None, :] + near[best])).astype(np.int64)
                out[:, t, 1:] = (beside * odd).sum(2)
    return out


def usable(vector: Column) -> Column:
    """Whether a vector has components, all of them finite numbers, and is not zero."""
    broken = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~broken & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit_rows(values: np.ndarray) -> np.ndarray:
    """Rows scaled to length one in double precision, however large or small their numbers are."""
    rows = values.astype(np.float64)
    rows /= np.abs(rows).max(1)[:, None]
    return rows / np.sqrt((rows * rows).sum(1))[:, None]


def buckets(unit: np.ndarray, group: np.ndarray, lattice: Lattice) -> np.ndarray:
    """Numbers (rows x tables x (1 + probes)) of the cells of unit vectors, by group and table."""
    with np.errstate(over="ignore"):
        mixed = cells(unit, lattice).view(np.uint64)
        mixed ^= mixed >> np.uint64(31)
        mixed = mixed * _MIX[0] + np.arange(1, lattice.tables + 1, dtype=np.uint64)[None, :, None] * _MIX[1] + (group.view(np.uint64) * _MIX[2])[:, None, None]
        return ((mixed ^ (mixed >> np.uint64(29))) * _MIX[3]).view(np.int64)


def hashed(distinct: DataFrame, lattice: Lattice) -> DataFrame:
    """Rows (``id``, ``bucket``, ``own``) for each vector, table, and cell, its own or a probed one; ``group`` tells label and length."""
    each = lattice.tables * (1 + lattice.probes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                column, group = batch.column(2), batch.column(1).to_numpy()
                values, lengths = column.flatten().to_numpy(zero_copy_only=False), column.value_lengths().to_numpy(zero_copy_only=False)
                starts = np.cumsum(lengths) - lengths
                for dim in np.unique(lengths).tolist():
                    rows = np.flatnonzero(lengths == dim)
                    keys = buckets(unit_rows(np.stack([values[starts[i] : starts[i] + dim] for i in rows])), group[rows], lattice)
                    own = np.tile(np.arange(1 + lattice.probes) == 0, len(rows) * lattice.tables)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(np.repeat(rows, each))), pa.array(keys.reshape(-1)), pa.array(own)], names=["id", "bucket", "own"])

    return map_arrow(distinct.select("id", "group", "vector"), run, "id bigint, bucket bigint, own boolean")


def _first_meeting(keys: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Bucket in which two vectors count as met: in the first table where one's own cell is among the other's, the smaller such cell."""
    bucket = np.empty(len(left), np.int64)
    most = np.iinfo(np.int64).max
    for at in range(0, len(left), 20_000):
        a, b = keys[left[at : at + 20_000]], keys[right[at : at + 20_000]]
        in_b = (a[:, :, :1] == b).any(2)
        in_a = (b[:, :, :1] == a).any(2)
        first = (in_a | in_b).argmax(1)
        row = np.arange(len(a))
        bucket[at : at + 20_000] = np.minimum(np.where(in_b[row, first], a[row, first, 0], most), np.where(in_a[row, first], b[row, first, 0], most))
    return bucket


def alike(unit: np.ndarray, least: float) -> np.ndarray:
    """Which pairs of rows have a cosine of ``least`` or more; those within rounding of it are summed up pair by pair, alike in any batch."""
    cosine = unit @ unit.T
    close = cosine >= least
    left, right = np.nonzero(np.triu(np.abs(cosine - least) < 1e-9, 1))
    close[left, right] = close[right, left] = np.ascontiguousarray(unit[left] * unit[right]).sum(1) >= least
    np.fill_diagonal(close, False)
    return close


def links(distinct: DataFrame, lattice: Lattice, least: float, block: int) -> DataFrame:
    """Rows ``a, b, n``: links of vector ``a`` counted in a bucket (``n``, with null ``b``), and tree edges between ``a`` and ``b``.

    Only cells that are some vector's own and hold others are compared, and vectors are only moved to these. There, members whose own cell it is
    are compared with all others. Two vectors may meet in several buckets; a link is counted only where ``_first_meeting`` says, so
    the counts add up without a table of pairs.
    """
    keyed = written(hashed(distinct, lattice), "cells")
    carried = distinct.select("id", "group", "copies", "vector")
    groups = candidate_blocks(keyed, ["bucket"], F.xxhash64("id"), ["id", "own", "group", "copies", "vector"], block, "own", carried)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            offsets, flat = member_lists(batch)
            homes = batch.column(batch.schema.get_field_index("bucket")).to_numpy()
            chunks, ids, owns, groups_, copies = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("chunk", "id", "own", "group", "copies"))
            vectors = flat.field("vector")
            values, ends = vectors.flatten().to_numpy(zero_copy_only=False), np.cumsum(vectors.value_lengths().to_numpy(zero_copy_only=False))
            starts = ends - np.diff(ends, prepend=0)
            out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            met: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # rows of linked pairs and the bucket where they were compared

            def count() -> None:
                """Links that count where they were found; the buckets of each vector are computed once for all its pairs."""
                left, right, where = (np.concatenate(x) for x in zip(*met))
                met.clear()
                ones = np.unique(np.concatenate([left, right]))
                ones = ones[np.unique(ids[ones], return_index=True)[1]]  # a vector may be a member of several groups
                keys = np.empty((len(ones), lattice.tables, 1 + lattice.probes), np.int64)
                sizes = ends[ones] - starts[ones]
                for dim in np.unique(sizes).tolist():
                    same = np.flatnonzero(sizes == dim)
                    keys[same] = buckets(unit_rows(values[starts[ones[same], None] + np.arange(dim)]), groups_[ones[same]], lattice)
                at_left, at_right = (np.searchsorted(ids[ones], ids[x]) for x in (left, right))
                here = _first_meeting(keys, at_left, at_right) == where
                n = (np.bincount(at_left[here], copies[right[here]], len(ones)) + np.bincount(at_right[here], copies[left[here]], len(ones))).astype(np.int64)
                counted = np.flatnonzero(n)
                out.append((ids[ones[counted]], np.full(len(counted), -1), n[counted]))

            for g in np.flatnonzero(np.diff(offsets) > 1).tolist():
                members = np.arange(int(offsets[g]), int(offsets[g + 1]))
                kinds = groups_[members]
                for group in np.unique(kinds).tolist() if (kinds != kinds[0]).any() else [None]:
                    rows = members if group is None else members[kinds == group]
                    chunk, own = chunks[rows], owns[rows]
                    if len(rows) < 2 or not own.any():
                        continue
                    unit = unit_rows(values[starts[rows, None] + np.arange(ends[rows[0]] - starts[rows[0]])])
                    close = alike(unit, least) & (own[:, None] | own[None, :]) & (ids[rows][:, None] != ids[rows][None, :])
                    if chunk.min() != chunk.max():
                        close &= chunk[:, None] != chunk[None, :]
                    left, right = np.nonzero(np.triu(close))
                    if not len(left):
                        continue
                    met.append((rows[left], rows[right], np.full(len(left), homes[g])))
                    tree = rows[np.array(list(spanning_forest(close)))]
                    out.append((ids[tree[:, 0]], ids[tree[:, 1]], np.zeros(len(tree), np.int64)))
                    if sum(len(x[0]) for x in met) > 500_000:
                        count()
            if met:
                count()
            if out:
                first, second, n = (np.concatenate(x) for x in zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array(first), pa.array(second, mask=n > 0), pa.array(n)], names=["a", "b", "n"])

    return map_arrow(groups.select("bucket", "members"), run, "a bigint, b bigint, n bigint")


def near_vectors(vectors: DataFrame, least: float = 0.93, lattice: Lattice = Lattice(), block: int = 512, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per row of ``vectors``: the id, ``n_links``, ``component_id`` and ``kept``.

    Rows with equal labels and as many components link where the cosine of their vectors, in double precision, is ``least`` or more and a table of
    the lattice brings them together; recall is measured in the tests. ``n_links`` counts other rows linked directly, ``component_id``
    is the smallest id reachable, ``kept`` is true for that row. Equal vectors are one row in all that is compared and always link.
    Vectors that are null, empty, zero, or hold a null or a number that is not finite, and rows with a null label or id, link with nothing. Ids
    are taken to be unique; repeated rows are copies of each other. No rows give no rows; other columns are ignored; texts
    are not read, and a vector of any length is compared whole. Results do not depend on ``block``.
    """
    kept = F.col(vector_col) if dict(vectors.dtypes)[vector_col] == "array<float>" else F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), kept.alias("vector"), F.col(label_col).alias("label"))
    fit = F.coalesce(F.col("label").isNotNull() & F.col("id").isNotNull() & usable(F.col("vector")), F.lit(False))
    hash_a, hash_b = F.xxhash64("vector").alias("ka"), F.xxhash64(F.lit(1), "vector").alias("kb")
    group = F.xxhash64("label", F.size("vector")).alias("group")
    once = rows.where(fit).groupBy("label", "vector").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"))
    distinct = written(once.select("id", "copies", "label", "vector", group, hash_a, hash_b), "vectors")
    found = written(links(distinct, lattice, least, block), "links")
    counts = found.groupBy("a").agg(F.sum("n").alias("links")).where("links > 0")
    reach = connected_components(found.where("b IS NOT NULL"))
    named = (
        distinct.join(counts, F.col("id") == F.col("a"), "left")
        .join(reach, F.col("id") == F.col("node"), "left")
        .select("label", "ka", "kb", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    )
    # back to all rows by 128 bits of their vectors
    linked = rows.where(fit).select("id", "label", hash_a, hash_b).join(named, ["label", "ka", "kb"]).select("id", "n_links", "component_id")
    alone = rows.where(~fit).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
