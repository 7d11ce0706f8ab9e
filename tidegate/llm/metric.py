"""Near-duplicate vectors: an exact range join in the metric of angles.

1. Equal vectors are one class; only classes go on.
2. A bounded sample gives pivots of two kinds. Tight pivots sit in dense places: what lies
   within half the range of one forms a tight cell, in which the triangle inequality links
   all pairs without looking at any. All other classes go to the cell of their nearest loose
   pivot. The sample only steers the work; every sample gives the same links.
3. Per cell and pivot the smallest and largest angle are known. A class can only reach a
   cell if its own angle to every pivot lies within the range of that interval; then, and
   only then, it is replicated there. If its angle to a tight pivot and the cell's radius
   together are within the range, it is linked to the whole cell at once instead.
4. Cells are dealt in chunks of bounded size. A chunk and what visits it form one group,
   which a task joins by itself: the chunk is held, visitors stream past in blocks, and
   links are counted, never listed. What leaves a group is a count and one neighbour per
   class, and the chunk's own components.
5. Counts are summed, and components formed of the neighbours.

Two cells, or chunks, meet once: a rule on their numbers says which of them visits the
other. Vectors without structure defeat every pivot: then all chunks meet, and the work
grows with the square of the number of classes, in blocks.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions.compare import quoted
from tidegate.llm.components import components
from tidegate.llm.vectors import dimension, matrix_of, packed, pieces, unpacked, units
from tidegate.session import cut_lineage, finished, run_folder

# Vectors drawn to choose pivots from, and bytes they may take.
SAMPLE, SAMPLE_BYTES = 2048, 1 << 25
# Pivots of a kind at most; sample vectors a tight pivot must have around it.
PIVOTS, DENSE = 128, 4
# Classes of a chunk: a bound, and the least, towards which more chunks than SPREAD are not made.
CHUNK, LEAST, SPREAD = 1 << 15, 2048, 256
# Angles are compared with this slack wherever a pair is not looked at itself.
SLACK = 1e-6
_BLOCK = 512


class Cells(NamedTuple):
    """Pivots, tight ones first, and what is known of the cells, which bear their pivots' numbers."""

    pivots: np.ndarray
    tight: int
    low: np.ndarray  # [cell, pivot]: smallest and largest angle
    high: np.ndarray
    chunks: np.ndarray  # per cell, and the number of the cell's first chunk
    first: np.ndarray
    weight: np.ndarray  # rows per cell


def _angles(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(vectors @ pivots.T, -1.0, 1.0))


def _visits(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Of two different numbers, does the first visit the second? True for one order of them."""
    return (one < other) == ((one + other) % 2 == 0)


def choose_pivots(sample: np.ndarray, loose: int, reach: float) -> tuple[np.ndarray, int]:
    """Tight pivots at the densest places of the sample, then loose ones; and the number of tight ones."""
    near = sample @ sample.T >= math.cos(reach / 2)
    left, counts, chosen = np.ones(len(sample), dtype=bool), near.sum(axis=1), []
    while len(chosen) < PIVOTS and counts.max(initial=0) >= DENSE:
        best = int(counts.argmax())
        chosen.append(best)
        gone = near[best] & left
        left &= ~gone
        counts = np.where(left, counts - near[:, gone].sum(axis=1), 0)
    others = np.flatnonzero(left)[:loose]
    if not len(others):
        others = np.arange(min(1, len(sample)))
    return np.concatenate((sample[chosen], sample[others])), len(chosen)


def _profiles(rows: DataFrame, id_column: str, vector_column: str, size: int, kind: str) -> DataFrame:
    """id, digest and packed vector of every row; the digest is NULL where a vector links with nothing."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 4096):
            matrix, fine = unpacked(batch.column(1), size)
            fine &= matrix.any(axis=1)
            held = (matrix + 0.0).astype(kind)  # one zero only
            digests = [hashlib.blake2b(row, digest_size=16).digest() if f else None for row, f in zip(held, fine, strict=True)]
            columns = [batch.column(0), pa.array(digests, pa.binary()), packed(held)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "digest", "vector"])

    named = rows.select(quoted(id_column).alias("id"), quoted(vector_column).alias("vector"))
    return named.mapInArrow(each, f"id {rows.schema[id_column].dataType.simpleString()}, digest binary, vector binary")


def _assigned(classes: DataFrame, pivots: np.ndarray, tight: int, reach: float, kind: str) -> DataFrame:
    """The classes with their cell: that of a tight pivot within half the range, or of the nearest loose one."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 4096):
            angles = _angles(units(matrix_of(batch.column(2), kind).astype(float)), pivots)
            cell = tight + angles[:, tight:].argmin(axis=1)
            if tight:
                best = angles[:, :tight].argmin(axis=1)
                inside = angles[np.arange(len(best)), best] <= reach / 2 - SLACK
                cell = np.where(inside, best, cell)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int32())], [*batch.schema.names, "cell"])

    return classes.select("digest", "weight", "vector").mapInArrow(
        each, "digest binary, weight long, vector binary, cell int"
    )


def _measured(assigned: DataFrame, pivots: np.ndarray, tight: int, chunk: int, kind: str) -> tuple[Cells, dict[int, bytes]]:
    """What is known of the cells, and one class of each. At most cells x pivots rows reach the driver."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = np.full((len(pivots), len(pivots)), np.inf)
        high = -low
        for batch in pieces(batches, 4096):
            angles = _angles(units(matrix_of(batch.column(0), kind).astype(float)), pivots)
            cells = batch.column(1).to_numpy()
            for c in np.unique(cells):
                own = angles[cells == c]
                low[c], high[c] = np.minimum(low[c], own.min(axis=0)), np.maximum(high[c], own.max(axis=0))
        held, at = np.nonzero(np.isfinite(low))
        columns = [pa.array(held, pa.int32()), pa.array(at, pa.int32()), pa.array(low[held, at]), pa.array(high[held, at])]
        yield pa.RecordBatch.from_arrays(columns, ["cell", "pivot", "low", "high"])

    bounds = assigned.select("vector", "cell").mapInArrow(each, "cell int, pivot int, low double, high double")
    bounds = bounds.groupBy("cell", "pivot").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect()
    sizes = assigned.groupBy("cell").agg(F.count(F.lit(1)), F.sum("weight"), F.min("digest")).collect()
    n = len(pivots)
    low, high = np.full((n, n), np.inf), np.full((n, n), -np.inf)
    for c, p, lo, hi in bounds:
        low[c, p], high[c, p] = lo, hi
    chunks, weight = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    for c, count, rows, _ in sizes:
        chunks[c], weight[c] = math.ceil(count / chunk), rows
    return Cells(pivots, tight, low, high, chunks, np.cumsum(chunks) - chunks, weight), {c: bytes(d) for c, _, _, d in sizes}


def _reaches(cells: Cells, angles: np.ndarray, own: np.ndarray, reach: float) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per cell that rows may visit: rows linked to all of it, and rows that have to be compared."""
    for c in np.flatnonzero(cells.chunks):
        is_tight = c < cells.tight
        comes = own != c
        comes &= _visits(own, c) & (own < cells.tight) if is_tight else (own >= cells.tight) & _visits(own, c)
        if is_tight:
            comes |= own >= cells.tight
        rows = np.flatnonzero(comes)
        least = np.maximum(cells.low[c] - angles[rows], angles[rows] - cells.high[c]).max(axis=1, initial=0.0)
        rows = rows[least <= reach + SLACK]
        sure = angles[rows, c] + cells.high[c, c] <= reach - SLACK if is_tight else np.zeros(len(rows), dtype=bool)
        yield int(c), rows[sure], rows[~sure]


def _sure_links(assigned: DataFrame, cells: Cells, reach: float, kind: str) -> DataFrame:
    """digest, weight and cell where the triangle inequality links a class to a whole tight cell."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 4096):
            angles = _angles(units(matrix_of(batch.column(2), kind).astype(float)), cells.pivots)
            for c, sure, _ in _reaches(cells, angles, batch.column(3).to_numpy(), reach):
                if len(sure):
                    some = batch.take(pa.array(sure))
                    columns = [some.column(0), some.column(1), pa.array(np.full(len(sure), c), pa.int32())]
                    yield pa.RecordBatch.from_arrays(columns, ["digest", "weight", "cell"])

    return assigned.mapInArrow(each, "digest binary, weight long, cell int")


def _dealt(assigned: DataFrame, cells: Cells, reach: float, kind: str) -> DataFrame:
    """Rows by group: each class as a member of its chunk (role 0) and as a visitor of others (role 1)."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 2048):
            own = batch.column(3).to_numpy()
            angles = _angles(units(matrix_of(batch.column(2), kind).astype(float)), cells.pivots)
            salt = matrix_of(batch.column(0), "u8")[:, 0]
            mine = cells.first[own] + (salt % cells.chunks[own].astype(np.uint64)).astype(np.int64)
            rows, groups, roles = [np.arange(len(own))], [mine], [0]
            for c, _, compared in _reaches(cells, angles, own, reach):
                for g in range(cells.first[c], cells.first[c] + cells.chunks[c]):
                    rows.append(compared), groups.append(np.full(len(compared), g)), roles.append(1)
                    if c >= cells.tight:  # chunks of one loose cell meet too
                        kin = np.flatnonzero((own == c) & (mine != g) & _visits(mine, g))
                        rows.append(kin), groups.append(np.full(len(kin), g)), roles.append(1)
            for at, group, role in zip(rows, groups, roles, strict=True):
                if not len(at):
                    continue
                some = batch.take(pa.array(at))
                inner = pa.array((own[at] >= cells.tight) if role == 0 else np.zeros(len(at), dtype=bool))
                columns = [pa.array(group, pa.int64()), pa.array(np.full(len(at), role), pa.int32()), inner, *some.columns[:3]]
                yield pa.RecordBatch.from_arrays(columns, ["group", "role", "inner", "digest", "weight", "vector"])

    return assigned.mapInArrow(each, "group long, role int, inner boolean, digest binary, weight long, vector binary")


def join_labels(labels: np.ndarray, u: np.ndarray, v: np.ndarray) -> None:
    """Merge the components of u and v, pair by pair; labels name each component's smallest member."""
    while True:
        a, b = labels[u], labels[v]
        apart = a != b
        if not apart.any():
            return
        u, v, a, b = u[apart], v[apart], a[apart], b[apart]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while True:
            further = labels[labels]
            if np.array_equal(further, labels):
                break
            labels[:] = further


class _Group:
    """A chunk of classes, with what visitors and its own pairs have shown so far."""

    def __init__(self, floor: float):
        self.floor, self.parts, self.inner = floor, [], False
        self.vectors = None

    def add(self, digests: pa.Array, weights: np.ndarray, vectors: np.ndarray, inner: bool) -> None:
        self.parts.append((digests, weights, vectors))
        self.inner |= inner

    def close(self) -> None:
        """All members are here: compare them with each other, unless their cell links them all."""
        if self.vectors is not None:
            return
        self.digests = pa.concat_arrays([p[0] for p in self.parts])
        self.weights = np.concatenate([p[1] for p in self.parts])
        self.vectors = np.concatenate([p[2] for p in self.parts])
        self.parts = []
        self.links = np.zeros(len(self.weights), dtype=np.int64)
        self.labels = np.arange(len(self.weights))
        if self.inner:
            for at in range(0, len(self.vectors), _BLOCK):
                near = self.vectors[at : at + _BLOCK] @ self.vectors.T >= self.floor
                own = np.arange(len(near))
                near[own, at + own] = False
                if near.any():
                    self.links[at : at + _BLOCK] += near @ self.weights
                    near &= self.labels[at : at + _BLOCK, None] != self.labels[None, :]
                    one, two = np.nonzero(near)
                    join_labels(self.labels, one + at, two)

    def meet(self, vectors: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Visitors: which have links here, how many, and one neighbour each."""
        near = vectors @ self.vectors.T >= self.floor
        rows = np.flatnonzero(near.any(axis=1))
        if not len(rows):
            return rows, rows, rows
        near = near[rows]
        self.links += weights[rows] @ near
        counts, first = near @ self.weights, near.argmax(axis=1)
        near &= self.labels[first][:, None] != self.labels[None, :]
        one, two = np.nonzero(near)
        join_labels(self.labels, first[one], two)
        return rows, counts, first

    def result(self) -> pa.RecordBatch:
        rows = np.flatnonzero((self.links > 0) | (self.labels != np.arange(len(self.labels))))
        return _linked(self.digests.take(pa.array(rows)), self.links[rows], self.digests.take(pa.array(self.labels[rows])))


def _linked(digests: pa.Array, links: np.ndarray, others: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([digests, pa.array(links, pa.int64()), others], ["digest", "links", "other"])


def _joined(dealt: DataFrame, groups: int, floor: float, kind: str) -> DataFrame:
    """digest, links counted in a group, and a class it is connected with."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, None
        for batch in pieces(batches, _BLOCK):
            numbers, roles = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = np.flatnonzero((np.diff(numbers) != 0) | (np.diff(roles) != 0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
                if numbers[a] != at:
                    if held is not None:
                        held.close()
                        yield held.result()
                    at, held = numbers[a], _Group(floor)
                some = batch.slice(a, b - a)
                weights = some.column(4).to_numpy()
                vectors = units(matrix_of(some.column(5), kind).astype(float))
                if roles[a] == 0:
                    held.add(some.column(3), weights, vectors, some.column(2)[0].as_py())
                    continue
                held.close()
                rows, counts, first = held.meet(vectors, weights)
                if len(rows):
                    yield _linked(some.column(3).take(pa.array(rows)), counts, held.digests.take(pa.array(first)))
        if held is not None:
            held.close()
            yield held.result()

    parts = max(1, min(2 * groups, 20_000))
    met = dealt.repartition(parts, "group").sortWithinPartitions("group", "role")
    return met.mapInArrow(each, "digest binary, links long, other binary")


def _counted(classes: DataFrame, kind: str, size: int, cosine: float) -> tuple[DataFrame, DataFrame]:
    """Links per class (digest, links) and links enough to connect all that are connected (u, v)."""
    reach, width = math.acos(cosine), size * np.dtype(kind).itemsize
    n = classes.count()
    most = max(16, min(SAMPLE, SAMPLE_BYTES // width))
    drawn = classes.select("digest", "vector").orderBy("digest").limit(most).collect()
    sample = units(np.array([np.frombuffer(r.vector, kind) for r in drawn]).astype(float))
    chunk = max(LEAST, min(CHUNK, math.ceil(n / SPREAD)))
    pivots, tight = choose_pivots(sample, min(PIVOTS, max(1, math.ceil(n / (2 * chunk)))), reach)
    assigned = cut_lineage(_assigned(classes, pivots, tight, reach, kind))
    cells, members = _measured(assigned, pivots, tight, chunk, kind)

    compared = cut_lineage(_joined(_dealt(assigned, cells, reach, kind), int(cells.chunks.sum()), cosine, kind))
    sure = cut_lineage(_sure_links(assigned, cells, reach, kind))
    spark = classes.sparkSession
    known = F.broadcast(
        spark.createDataFrame(
            [(c, int(cells.weight[c]), members[c]) for c in sorted(members) if c < tight], "cell int, rows long, member binary"
        )
    )  # at most one row per tight pivot
    more = F.broadcast(cut_lineage(sure.groupBy("cell").agg(F.sum("weight").alias("more"))))  # likewise
    inside = assigned.join(known, "cell").join(more, "cell", "left")
    to_cell = sure.join(known, "cell")
    links = (
        compared.select("digest", "links")
        .unionByName(to_cell.select("digest", F.col("rows").alias("links")))
        .unionByName(inside.select("digest", (F.col("rows") - F.col("weight") + F.coalesce("more", F.lit(0))).alias("links")))
        .groupBy("digest")
        .agg(F.sum("links").alias("links"))
    )
    edges = (
        compared.select(F.col("digest").alias("u"), F.col("other").alias("v"))
        .unionByName(to_cell.select(F.col("digest").alias("u"), F.col("member").alias("v")))
        .unionByName(inside.select(F.col("digest").alias("u"), F.col("member").alias("v")))
    )
    return links, edges


def near_vectors(
    rows: DataFrame, cosine: float = 0.9, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """Per row: its id, n_links, component_id and kept (id = component_id).

    Two rows are linked if the cosine of their vectors is at least `cosine`, in double
    precision; n_links counts the other rows a row is linked with, and component_id is the
    smallest id that links reach, its own included. Vectors that are NULL, empty or zero or hold
    NULL or non-finite components link with nothing and are kept. A shorter vector counts as one that ends
    with zeros. Rows that repeat an id are rows of their own, each with its own vector. Rows
    without an id take part and name no component that has another; they are kept only where
    no row of theirs has an id. No rows give no rows. Other columns are not read.
    """
    if not 0 < cosine < 1:
        raise ValueError("cosine must lie between 0 and 1")
    spark = rows.sparkSession
    element = rows.schema[vector_column].dataType.elementType
    kind = "<f4" if isinstance(element, T.FloatType) else "<f8"
    size = max(dimension(rows, vector_column), 1)
    with run_folder(spark):
        profile = cut_lineage(_profiles(rows, id_column, vector_column, size, kind))
        narrow = profile.select("id", "digest")
        classes = cut_lineage(
            profile.where("digest is not null")
            .groupBy("digest")
            .agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("weight"), F.first("vector").alias("vector"))
        )
        if classes.isEmpty():
            return finished(_named(narrow.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component")), id_column))
        links, edges = _counted(classes, kind, size, cosine)
        stars = components(edges)
        rooted = classes.select("digest", "id", "weight").join(stars, F.col("digest") == F.col("node"), "left")
        rooted = cut_lineage(rooted.select("digest", "id", "weight", F.coalesce("root", "digest").alias("root")))
        names = rooted.groupBy("root").agg(F.min("id").alias("component"))
        judged = (
            rooted.join(names, "root")
            .join(links, "digest", "left")
            .select("digest", "component", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
        )
        judged = cut_lineage(judged)
        found = narrow.join(judged, "digest", "left")
        alone = F.col("n_links").isNull()
        found = found.select(
            "id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
            F.when(alone, F.col("id")).otherwise(F.col("component")).alias("component"),
        )
        return finished(_named(found, id_column))


def _named(found: DataFrame, id_column: str) -> DataFrame:
    return found.select(
        F.col("id").alias(id_column),
        F.col("n_links").cast("long").alias("n_links"),
        F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"),
    )
