"""Embedding near-dedup on randomly rotated binary codes.

Equal vectors are one class. A class's unit vector is rotated by a fixed random rotation and kept as one bit per dimension
together with the inner product of vector and code. From a code, that factor and another rotated vector follows an
unbiased estimate of the cosine with a confidence bound; only pairs whose estimate plus bound reaches the threshold are computed
again, in double precision.

What travels to the cells is the code, not the vector: one byte per dimension, whose top bit is the binary code and whose other seven
tell the rotated vector well enough to be the other side of an estimate. Vectors follow only for rows that have a pair left in a cell.

Pairs to estimate come from sign bits of further random directions: a few bits of them name a cell, in as many tables as it takes
to miss fewer than ``MISSED`` of the pairs that lie exactly at the threshold (closer pairs are missed far more rarely). Directions and
bytes are whole numbers, so every task gets the same keys from a code. A task counts its rows' links and merges them, so
it emits at most one row per row it has read.
"""

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smeltworks.llm.cells import CELL_ROWS, cell_ranges, deal
from smeltworks.llm.common import short_batches
from smeltworks.llm.components import connected_components, merge
from smeltworks.operators.skew import join_unique
from smeltworks.sources.scratch import materialise

THRESHOLD = 0.95
MISSED = 0.01
# Rows per cell if directions were even, and the width of the confidence bound.
EVEN_CELL = 64
WIDTH = 3.0
# Levels of a rotated component to either side of zero.
LEVELS = 128
SEED = 20240229


@functools.cache
def rotation(dims: int) -> np.ndarray:
    return np.linalg.qr(np.random.default_rng(SEED).standard_normal((dims, dims)))[0]


@functools.cache
def directions(dims: int, count: int) -> np.ndarray:
    """Whole numbers, small enough for exact sums with the bytes of a code."""
    return np.rint(np.random.default_rng(SEED + 1).standard_normal((dims, count)) * 1024)


def tables(rows: int, threshold: float = THRESHOLD, missed: float = MISSED) -> tuple[int, int]:
    """Bits per key and number of tables."""
    bits = min(40, max(2, math.ceil(math.log2(max(rows, 2) / EVEN_CELL))))
    agree = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, math.ceil(math.log(missed) / math.log(1 - agree))


def units(flat: np.ndarray, dims: int) -> np.ndarray:
    v = flat.reshape(-1, dims).astype(np.float64)
    v /= np.abs(v).max(1, keepdims=True)  # so that squares neither vanish nor overflow
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def cell_keys(levels: np.ndarray, bits: int, count: int) -> np.ndarray:
    """Keys of the codes ``levels`` in ``count`` tables. Odd numbers, twice a level and one, stand for the middle of a level."""
    signs = ((2 * levels.astype(np.float64) + 1) @ directions(levels.shape[1], bits * count)) > 0
    return signs.reshape(len(levels), count, bits) @ (1 << np.arange(bits, dtype=np.int64))


def codes(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rotated vectors in levels of one byte, whose signs are the binary code; the width of a level; each vector's inner product
    with its binary code."""
    turned = unit @ rotation(unit.shape[1])
    step = np.abs(turned).max(1) / LEVELS
    levels = np.clip(np.floor(turned / step[:, None]), -LEVELS, LEVELS - 1).astype(np.int8)
    return levels, step, np.abs(turned).sum(1) / math.sqrt(unit.shape[1])


def estimate(code: np.ndarray, factor: np.ndarray, levels: np.ndarray, step: np.ndarray, width: float = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Estimated cosines of binary codes (rows: signs of ``code``, and factors) with rotated vectors (columns: levels and their widths),
    and the bound of each estimate's error. The bound's last part is the most that the levels can be off."""
    dims = levels.shape[1]
    signs = np.where(code >= 0, np.float32(1), np.float32(-1))
    turned = (levels.astype(np.float32) + np.float32(0.5)) * step[:, None].astype(np.float32)
    cosines = (signs @ turned.T) / (math.sqrt(dims) * factor)[:, None]
    spread = np.sqrt(np.maximum(1 - factor**2, 0)) / factor
    bound = width * spread / math.sqrt(max(dims - 1, 1)) + 1e-5
    return cosines, bound[:, None] + math.sqrt(dims) / 2 * step[None, :] / factor[:, None]


def _dims_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All components in a row, and where each vector begins."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    return column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]], offsets - offsets[0]


def _grouped(flat: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, int, np.ndarray]]:
    """Vectors by their number of dimensions: positions, dimensions, unit vectors."""
    size = np.diff(offsets)
    for dims in np.unique(size).tolist():
        at = np.flatnonzero(size == dims)
        if len(at):
            yield at, dims, units(flat[(offsets[at][:, None] + np.arange(dims)).ravel()], dims)


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(no, copies, embedding)`` -> ``(no, copies, levels, step, factor)``."""
    for batch in batches:
        flat, offsets = _dims_of(batch.column(2))
        for at, dims, unit in _grouped(flat, offsets) if batch.num_rows else ():
            levels, step, factor = codes(unit)
            rows = batch.take(pa.array(at))
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1), _binary(levels), pa.array(step), pa.array(factor)],
                names=["no", "copies", "levels", "step", "factor"],
            )


def _binary(levels: np.ndarray) -> pa.Array:
    ends = pa.array(np.arange(len(levels) + 1, dtype=np.int32) * levels.shape[1])
    return pa.Array.from_buffers(pa.binary(), len(levels), [None, ends.buffers()[1], pa.py_buffer(np.ascontiguousarray(levels).tobytes())])


def _levels(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Codes by their number of dimensions: positions and levels."""
    offsets = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4).astype(np.int64)
    flat, size = np.frombuffer(column.buffers()[2], np.int8), np.diff(offsets)
    for dims in np.unique(size).tolist():
        at = np.flatnonzero(size == dims)
        yield at, flat[offsets[at][:, None] + np.arange(dims)]


CELL = ["t", "key", "dims", "lo", "hi"]


def links(classes: DataFrame, threshold: float = THRESHOLD, cell_rows: int = CELL_ROWS) -> DataFrame:
    """``classes(no, embedding, copies)``, a stored table -> partial results ``(no, root, n)``: links to vectors of other classes, and a link to merge."""
    bits, count = tables(classes.count(), threshold)
    short_batches(classes.sparkSession)
    coded = classes.select("no", "copies", "embedding").mapInArrow(_coded, "no bigint, copies bigint, levels binary, step double, factor double")
    coded = materialise(coded, "coded")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, levels in _levels(batch.column("levels")) if batch.num_rows else ():
                keys = cell_keys(levels, bits, count)
                rows = batch.take(pa.array(np.repeat(at, count)))
                t = np.tile(np.arange(count, dtype=np.int32), len(at))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(t), pa.array(keys.ravel())], names=[*batch.schema.names, "t", "key"])

    placed = coded.select("no", "levels", "step", "factor").mapInArrow(place, "no bigint, levels binary, step double, factor double, t int, key bigint")
    dealt = deal(placed.withColumn("dims", F.octet_length("levels")), CELL[:3], "no", cell_rows)

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if got:
            yield from _sifted(pa.Table.from_batches(got).combine_chunks(), bits, count, threshold)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if got:
            yield from _joined(pa.Table.from_batches(got).combine_chunks(), bits, count, threshold)

    left = dealt.select("no", "levels", "step", "factor", *CELL, "chunk").mapInArrow(sift, "no bigint, t int, key bigint, dims int, lo int, hi int, chunk int")
    left = materialise(left, "left")
    exact = left.join(coded, "no").join(classes.select("no", "embedding"), "no").repartition(*CELL)
    return exact.mapInArrow(join, "no bigint, root bigint, n bigint")


@dataclass(frozen=True)
class _Cells:
    """The rows of some cells that have one number of dimensions, in the order of their cells."""

    rows: np.ndarray
    levels: np.ndarray
    step: np.ndarray
    factor: np.ndarray
    table: np.ndarray
    keys: np.ndarray
    ranges: np.ndarray

    def pairs(self, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per cell the pairs that may reach the threshold. A pair belongs to the first table in which its keys agree."""
        for a0, a1, b0, b1 in self.ranges.T.tolist():
            if b1 - a0 < 2 or b1 == b0 or a1 == a0:
                continue
            cosines, bound = estimate(self.levels[a0:a1], self.factor[a0:a1], self.levels[b0:b1], self.step[b0:b1])
            a, b = np.nonzero(cosines + bound >= threshold)
            a, b = a + a0, b + b0
            a, b = (x[a < b] for x in (a, b))
            before = self.table[a0]
            fresh = ~(self.keys[a, :before] == self.keys[b, :before]).any(1)
            yield a[fresh], b[fresh]


def _cells(rows: pa.Table, bits: int, count: int) -> Iterator[_Cells]:
    t, key, lo, hi, chunk, step, factor = (rows.column(c).to_numpy() for c in ("t", "key", "lo", "hi", "chunk", "step", "factor"))
    for at, levels in _levels(rows.column("levels").chunk(0)):
        side = (chunk[at] != lo[at]).astype(np.int8)
        order = np.lexsort((side, hi[at], lo[at], key[at], t[at]))
        mine, levels, side = at[order], levels[order], side[order]
        ranges = cell_ranges([t[mine], key[mine]], lo[mine], hi[mine], side)
        yield _Cells(mine, levels, step[mine], factor[mine], t[mine], cell_keys(levels, bits, count), ranges)


def _sifted(rows: pa.Table, bits: int, count: int, threshold: float) -> Iterator[pa.RecordBatch]:
    """The rows, without their codes, that have a pair left in their cell."""
    wanted = np.zeros(rows.num_rows, bool)
    for cells in _cells(rows, bits, count):
        for a, b in cells.pairs(threshold):
            wanted[cells.rows[a]] = True
            wanted[cells.rows[b]] = True
    yield from rows.select(["no", *CELL, "chunk"]).filter(pa.array(wanted)).to_batches()


def _joined(rows: pa.Table, bits: int, count: int, threshold: float) -> Iterator[pa.RecordBatch]:
    numbers, copies = (rows.column(c).to_numpy() for c in ("no", "copies"))
    flat, offsets = _dims_of(rows.column("embedding").chunk(0))
    for cells in _cells(rows, bits, count):
        mine, dims = cells.rows, cells.levels.shape[1]
        unit = units(flat[(offsets[mine][:, None] + np.arange(dims)).ravel()], dims)
        n, labels, weight = np.zeros(len(mine), np.int64), np.arange(len(mine)), copies[mine]
        firsts, seconds = [], []
        for a, b in cells.pairs(threshold):
            near = np.einsum("ij,ij->i", unit[a], unit[b]) >= threshold
            a, b = a[near], b[near]
            np.add.at(n, a, weight[b])
            np.add.at(n, b, weight[a])
            firsts.append(a)
            seconds.append(b)
            if sum(map(len, firsts)) > 1 << 20:
                labels = merge(labels, np.concatenate(firsts), np.concatenate(seconds))
                firsts, seconds = [], []
        if firsts:
            labels = merge(labels, np.concatenate(firsts), np.concatenate(seconds))
        told = np.flatnonzero((n > 0) | (labels != np.arange(len(mine))))
        yield pa.RecordBatch.from_arrays([pa.array(numbers[mine][told]), pa.array(numbers[mine][labels[told]]), pa.array(n[told])], names=["no", "root", "n"])


def embedding_dedup(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", threshold: float = THRESHOLD, cell_rows: int = CELL_ROWS) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    Two vectors link if found with a cosine of at least ``threshold``; none below it link. Null, empty and zero vectors, and vectors
    that hold a null or a non-finite component, link with nothing, and vectors of different length never link. A component is named by
    the smallest id reachable by links; a vector without links is its own. Rows with the same id count as vectors of their own. Rows with
    a null id link with nothing. An empty table gives no rows. Other columns are not read.
    """
    kind = vectors.schema[embedding].dataType
    component = "float" if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType) else "double"
    values = F.transform(F.col(embedding), lambda x: x.cast(component))
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), values.alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sound = rows.where(F.coalesce(finite, F.lit(False)) & F.exists("embedding", lambda x: x != 0))
    sound = materialise(sound.where(F.col("vec_id").isNotNull()), "sound")
    classes = sound.groupBy("embedding").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"))
    # Ids may repeat on different vectors; numbers do not.
    classes = materialise(classes.withColumn("no", F.monotonically_increasing_id()), "classes")
    found = materialise(links(classes, threshold, cell_rows), "found")
    components = connected_components(found.select(F.col("no").alias("a"), F.col("root").alias("b")))
    members = materialise(components.withColumnRenamed("id", "no").join(classes.select("no", "id"), "no"), "members")
    named = join_unique(members, members.groupBy("component").agg(F.min("id").alias("component_id")), ["component"])
    told = found.groupBy("no").agg(F.sum("n").alias("n")).join(named.select("no", "component_id"), "no", "left")
    known = classes.join(told, "no", "left").select(
        "embedding",
        (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
    )
    linked = sound.join(known, "embedding").select("vec_id", "n_links", "component_id")
    unsound = rows.where(~F.coalesce(finite & F.exists("embedding", lambda x: x != 0), F.lit(False)) | F.col("vec_id").isNull())
    alone = unsound.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
