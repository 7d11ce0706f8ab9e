"""Hard negatives: threshold joins of anchors with all rows, by an index of leading dimensions.

Rows are dealt by id into blocks of bounded size; the anchors of all labels stream past each
block. A block orders the dimensions by weight and indexes of every row only those that come
before its suffix norm, times the longest anchor's norm, falls below the threshold: a pair
whose score could come from the rest alone cannot reach it. Partial scores are accumulated a
strip of dimensions at a time; after each strip a pair goes if its partial score and the
product of the remaining norms stay below the anchor's threshold. What is left at the end
is its exact integer score.

Thresholds start high and are lowered for the anchors whose window is not full, until it
is, or everything has been compared. Two such joins are run: the first finds each anchor's
positives, the second, which then knows their scores, the best rows of other labels within
each positive's window. A block gives at most a window's length per anchor and window, so
nothing grows with the number of rows alike an anchor; the best of all blocks are taken.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegate.functions.compare import quoted
from tidegate.llm.vectors import dimension, matrix_of, packed, pieces, unpacked
from tidegate.session import cut_lineage, finished, run_folder

SCALE = 256
# Length of the windows, for positives and for negatives; a negative's least share of the positive's score.
WINDOW, SHARE = 5, 80
# Rows of a block: a bound, and the least, towards which more blocks than SPREAD are not made.
BLOCK, LEAST, SPREAD = 1 << 16, 1024, 32
# Thresholds of a search for positives, as parts of the anchor's norm times the longest row's; then none.
STEPS = (0.9, 0.6, 0.45, 0.35, 0.25)
# Thresholds of a search for negatives, as parts of the way down from the highest positive score to the lowest that counts.
DOWN = (0.25, 0.5, 1.0)
_STRIP, _PAIRS = 8, 1 << 20
# Above this bound on a score, doubles are not exact and whole numbers are used.
_EXACT = 1 << 52


class Index(NamedTuple):
    """A block's rows, dimensions in the block's own order."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    order: np.ndarray  # of the dimensions, heaviest first
    rest: np.ndarray  # [row, strip]: norm of what comes from that strip on; 0 after the last


def _suffix_norms(vectors: np.ndarray) -> np.ndarray:
    """Per row and strip of dimensions, the norm from that strip on, never too small."""
    if not len(vectors):
        return np.zeros((0, math.ceil(vectors.shape[1] / _STRIP) + 1))
    strips = np.add.reduceat(vectors.astype(float) ** 2, np.arange(0, vectors.shape[1], _STRIP), axis=1)
    sums = np.cumsum(strips[:, ::-1], axis=1)[:, ::-1]
    return np.pad(np.sqrt(sums) * (1 + 1e-9), ((0, 0), (0, 1)))


def build_index(ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, longest: float) -> Index:
    """The block's index; `longest` is the longest anchor's norm."""
    order = np.argsort(-np.abs(vectors).max(axis=0, initial=0), kind="stable")
    vectors = vectors[:, order]
    rest = _suffix_norms(vectors)
    exact = float(rest.max(initial=0.0)) * longest < _EXACT
    return Index(ids, labels, vectors.astype(float) if exact else vectors, order, rest)


def pairs_above(index: Index, anchors: np.ndarray, thresholds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, score) of all pairs whose score reaches the anchor's threshold."""
    ours = anchors[:, index.order].astype(index.vectors.dtype)
    own, last = _suffix_norms(ours), index.rest.shape[1] - 1
    # Leading strips indexed per row; the suffix norm bounds what the others could give any anchor.
    depth = (index.rest[:, :last] * own[:, 0].max(initial=0.0) >= thresholds.min(initial=np.inf)).sum(axis=1)
    rows = np.argsort(-depth, kind="stable")[: np.count_nonzero(depth)]
    depth, vectors, rest = depth[rows], index.vectors[rows], index.rest[rows]
    scores = np.zeros((len(ours), len(rows)), dtype=vectors.dtype)
    alive = np.ones(scores.shape, dtype=bool)
    reached = np.zeros(len(rows), dtype=np.int64)  # strips of each row that are in its scores
    for strip in range(last):
        posted = np.count_nonzero(depth > strip)
        if not posted:
            break
        part = slice(strip * _STRIP, (strip + 1) * _STRIP)
        scores[:, :posted] += ours[:, part] @ vectors[:posted, part].T
        reached[:posted] += 1
        alive = scores + own[:, reached] * rest[np.arange(len(rows)), reached] >= thresholds[:, None]
        if alive.sum() * 8 <= alive.size:
            break
    one, two = np.nonzero(alive)
    held, done = scores[one, two], reached[two]
    for strip in range(last):
        late = np.flatnonzero(done == strip)
        if not len(late):
            continue
        part = slice(strip * _STRIP, (strip + 1) * _STRIP)
        held[late] += (ours[one[late], part] * vectors[two[late], part]).sum(axis=1)
        done[late] += 1
        keep = held + own[one, done] * rest[two, done] >= thresholds[one]
        one, two, held, done = one[keep], two[keep], held[keep], done[keep]
    keep = held >= thresholds[one]
    return one[keep], rows[two[keep]], held[keep].astype(np.int64)


def best_of(owner: np.ndarray, score: np.ndarray, ids: np.ndarray, window: int) -> np.ndarray:
    """Places of each owner's first entries, the highest scores first, then the smallest ids."""
    order = np.lexsort((ids, -score, owner))
    sorted_owner = owner[order]
    starts = np.searchsorted(sorted_owner, sorted_owner, side="left")
    return order[np.arange(len(order)) - starts < window]


def find_positives(index: Index, ids, labels, anchors, longest: float, window: int) -> Iterator[tuple]:
    """(anchor, row, score) of the best rows of an anchor's label here, but rows of its own id."""
    norms = np.sqrt((anchors.astype(float) ** 2).sum(axis=1))
    left = np.arange(len(ids))
    for step in (*STEPS, None):
        if not len(left):
            return
        floors = np.full(len(left), -np.inf) if step is None else step * norms[left] * index.rest[:, 0].max(initial=0.0)
        one, two, score = pairs_above(index, anchors[left], floors)
        fit = (index.labels[two] == labels[left[one]]) & (index.ids[two] != ids[left[one]])
        one, two, score = left[one[fit]], two[fit], score[fit]
        counts = np.bincount(one, minlength=len(ids))
        full = (counts >= window) | (step is None)
        use = full[one]
        one, two, score = one[use], two[use], score[use]
        best = best_of(one, score, index.ids[two], window)
        yield one[best], two[best], score[best]
        left = left[~full[left]]


def find_negatives(index: Index, ids, labels, anchors, tops: np.ndarray, window: int, share: int) -> Iterator[tuple]:
    """(anchor, positive score, row, score): the best rows of other labels in each positive's window.

    `tops` holds the anchors' different positive scores, -1 where there is none.
    """
    lows = -(-share * tops // 100)
    held = tops >= 0
    high = tops.max(axis=1, initial=-1)
    low = np.where(held, lows, np.iinfo(np.int64).max).min(axis=1, initial=np.iinfo(np.int64).max)
    left = np.flatnonzero(high >= 0)
    for step in DOWN:
        if not len(left):
            return
        floors = np.ceil(high[left] - step * (high[left] - low[left]))
        one, two, score = pairs_above(index, anchors[left], np.where(step < 1, floors, low[left]) * (1 - 1e-12))
        fit = (index.labels[two] != labels[left[one]]) & (index.ids[two] != ids[left[one]])
        at, two, score = left[one[fit]], two[fit], score[fit]
        full, found = np.ones(len(ids), dtype=bool), []
        floor = np.zeros(len(ids))
        floor[left] = floors
        for j in range(tops.shape[1]):
            inside = np.flatnonzero((score <= tops[at, j]) & (score >= lows[at, j]) & held[at, j])
            counts = np.bincount(at[inside], minlength=len(ids))
            full &= (counts >= window) | (lows[:, j] >= floor) | ~held[:, j] | (step == DOWN[-1])
            found.append(inside)
        for j, inside in enumerate(found):
            inside = inside[full[at[inside]]]
            best = inside[best_of(at[inside], score[inside], index.ids[two[inside]], window)]
            yield at[best], tops[at[best], j], two[best], score[best]
        left = left[~full[left]]


def _quantised(rows: DataFrame, id_column: str, label_column: str, vector_column: str, scale: int) -> DataFrame:
    """id, label, norm and packed vector of whole numbers of the rows that take part."""
    size = max(dimension(rows, vector_column), 1)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 4096):
            matrix, fine = unpacked(batch.column(2), size)
            whole = np.clip(np.floor(scale * matrix), -float(1 << 62), float(1 << 62))
            norms = np.sqrt((whole**2).sum(axis=1))
            columns = [batch.column(0), batch.column(1), pa.array(norms), packed(whole.astype("<i8"))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "label", "norm", "vector"]).filter(pa.array(fine))

    named = rows.select(
        quoted(id_column).cast("long").alias("id"), quoted(label_column).cast("long").alias("label"),
        quoted(vector_column).alias("vector"),
    )
    named = named.where("id is not null and label is not null and vector is not null")
    return named.mapInArrow(each, "id long, label long, norm double, vector binary")


def _searched(rows: DataFrame, anchors: DataFrame, blocks: int, longest: float, find: Callable, schema: str) -> DataFrame:
    """What `find` gives for every block of the rows and every anchor (anchor, id, label, vector, tops)."""
    inner = rows.select(
        F.expr(f"pmod(xxhash64(id), {blocks}L)").cast("int").alias("block"), F.lit(0).alias("role"),
        F.lit(None).cast("long").alias("anchor"), "id", "label", "vector", F.lit(None).cast("array<long>").alias("tops"),
    )
    visits = anchors.select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("role"),
        "anchor", "id", "label", "vector", "tops",
    )
    names = [field.split()[0] for field in schema.split(", ")]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, index = None, [], None
        for batch in pieces(batches, 4096):
            numbers, roles = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = np.flatnonzero((np.diff(numbers) != 0) | (np.diff(roles) != 0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
                some = batch.slice(a, b - a)
                ids, labels = some.column(3).to_numpy(), some.column(4).to_numpy()
                vectors = matrix_of(some.column(5), "<i8")
                if numbers[a] != at:
                    at, parts, index = numbers[a], [], None
                if roles[a] == 0:
                    parts.append((ids, labels, vectors))
                    continue
                if index is None:
                    if not parts:
                        continue
                    index = build_index(*_once(*(np.concatenate(x) for x in zip(*parts, strict=True))), longest)
                    parts = []
                numbered = some.column(2).to_numpy()
                tops, _ = _padded(some.column(6))
                step = max(1, _PAIRS // len(index.ids))
                for i in range(0, len(ids), step):
                    cut = slice(i, i + step)
                    for owner, *more, row, score in find(index, ids[cut], labels[cut], vectors[cut], tops[cut]):
                        columns = [numbered[cut][owner], *more, index.ids[row], score]
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    met = inner.unionByName(visits).repartition(max(1, 2 * blocks), "block").sortWithinPartitions("block", "role")
    return met.mapInArrow(each, schema)


def _padded(lists: pa.Array) -> tuple[np.ndarray, int]:
    values = [x or [] for x in lists.to_pylist()]
    most = max(map(len, values), default=0)
    return np.array([v + [-1] * (most - len(v)) for v in values], dtype=np.int64).reshape(len(values), most), most


def _once(ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rows without those that repeat another in id, label and vector."""
    _, place, counts = np.unique(ids, return_inverse=True, return_counts=True)
    keep, seen = np.ones(len(ids), dtype=bool), set()
    for i in np.flatnonzero(counts[place] > 1):
        key = (int(ids[i]), int(labels[i]), vectors[i].tobytes())
        keep[i] = key not in seen
        seen.add(key)
    return ids[keep], labels[keep], vectors[keep]


def hard_negatives(
    rows: DataFrame,
    every: int = 100,
    id_column: str = "vec_id",
    label_column: str = "label",
    vector_column: str = "embedding",
    window: int = WINDOW,
    share: int = SHARE,
    scale: int = SCALE,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    Anchors are the rows whose id `every` divides. Components become floor(scale * x), scores
    are whole inner products; higher ones come first, equal ones by smaller id. An anchor's
    positives are its first `window` rows of the same label and another id; for each of them
    come the first `window` rows of other labels whose score is at least `share` of 100 of the
    positive's and at most the positive's own, ranked from 1. A positive whose window is empty,
    as it is below a score of 0, gives no row.

    Rows with a NULL id, label or vector, or a component that is NULL or not finite, take no part;
    shorter vectors end with zeros. Rows equal in id, label and vector are one row, others that share
    an id are rows of their own, but never each other's positives or negatives. Scores beyond 64 bits are not defined. Fewer rows than a window give what there
    is; no rows give none. Labels are whole numbers. Other columns are not read.
    """
    spark = rows.sparkSession
    with run_folder(spark):
        whole = cut_lineage(_quantised(rows, id_column, label_column, vector_column, scale))
        n = whole.count()
        blocks = max(1, min(math.ceil(n / LEAST), max(SPREAD, math.ceil(n / BLOCK))))
        chosen = whole.where(F.col("id") % every == 0).select("id", "label", "vector", "norm").distinct()
        chosen = cut_lineage(chosen.withColumn("anchor", F.monotonically_increasing_id()))
        longest = chosen.agg(F.max("norm").alias("m")).first()["m"] or 0.0

        def positives(index, ids, labels, vectors, tops):
            return find_positives(index, ids, labels, vectors, longest, window)

        def negatives(index, ids, labels, vectors, tops):
            return find_negatives(index, ids, labels, vectors, tops, window, share)

        found = _searched(
            whole, chosen.withColumn("tops", F.lit(None).cast("array<long>")), blocks, longest, positives,
            "anchor long, id long, score long",
        )
        first = Window.partitionBy("anchor").orderBy(F.desc("score"), "id")
        found = found.withColumn("place", F.row_number().over(first)).where(F.col("place") <= window)
        found = cut_lineage(found.select("anchor", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")))
        tops = found.groupBy("anchor").agg(F.collect_set("positive_score").alias("tops"))  # a window's length at most
        near = _searched(
            whole, chosen.join(tops, "anchor"), blocks, longest, negatives,
            "anchor long, positive_score long, id long, score long",
        )
        ranked = Window.partitionBy("anchor", "positive_score").orderBy(F.desc("score"), "id")
        near = near.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= window)
        return finished(
            found.join(near, ["anchor", "positive_score"])
            .join(chosen.select("anchor", F.col("id").alias("anchor_id")), "anchor")
            .select(
                "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"),
                "positive_score", F.col("score").alias("negative_score"),
            )
        )
