"""Toxicity by a chain of linear classifiers over word beginnings.

Categories are predicted one after the other. The model of each category also sees the
probabilities of the earlier ones. For training these are out-of-fold predictions: each row's
come from a model that has not seen the row, so later models learn to trust them as much
as they deserve on new texts. Features are the first three to five characters of the
distinct words, hashed, present or not, so the length of a text does not dilute them, and
inflected forms share them. The lasso penalty leaves weights only where many rows agree.

The labelled rows used are bounded in number. A category's fits, one per fold and one of all
rows, are groups of one Spark job; only the weights that are not zero come to the driver.
Scoring reads each text once, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.compare import quoted
from tidegate.llm.payload import as_row, own_columns
from tidegate.operators.sizing import settle
from tidegate.session import cut_lineage, run_folder

# Documented bound: at most about this many labelled rows, chosen by a hash of their id.
TRAIN_ROWS = 16_000
# Places that features are hashed to.
FEATURES = 1 << 18
FOLDS = 3
PENALTY = 3e-4
THRESHOLD = 0.2
_SCALE = 1_000_000
# Quasi-Newton steps at most, and the gain by which a fit has to go on improving: fits end
# early, which on held-out labels is a little better than the exact minimum.
_STEPS, GAIN, _MEMORY = 30, 1e-4, 8
_BLOCK = 1 << 20


def beginnings(text: Column) -> Column:
    """The places of a text's features, each once."""
    words = F.array_distinct(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[^\p{L}]+"))
    parts = F.flatten(F.transform(words, lambda w: F.array(*[F.substring(w, 1, n) for n in (3, 4, 5)])))
    return F.array_distinct(F.transform(parts, lambda t: F.pmod(F.xxhash64(t), F.lit(FEATURES)).cast("int")))


def minimised(smooth: Callable, start: np.ndarray, penalty: np.ndarray, least: float = GAIN) -> np.ndarray:
    """Orthant-wise limited-memory quasi-Newton minimum of a smooth function plus weighted absolute values.

    `smooth` gives value and gradient.
    """

    def slopes(x: np.ndarray, gradient: np.ndarray) -> np.ndarray:
        up, down = gradient + penalty, gradient - penalty
        at_zero = np.where(down > 0, down, np.where(up < 0, up, 0.0))
        return np.where(x == 0, at_zero, gradient + penalty * np.sign(x))

    x = start.copy()
    value, gradient = smooth(x)
    value += float(penalty @ np.abs(x))
    pairs: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(_STEPS):
        slope = slopes(x, gradient)
        if not np.abs(slope).max(initial=0.0) > 1e-9:
            break
        way, scales = -slope, []
        for s, y, r in reversed(pairs):
            scales.append(r * float(s @ way))
            way = way - scales[-1] * y
        if pairs:
            s, y, r = pairs[-1]
            way = way / (r * float(y @ y))
        for (s, y, r), scale in zip(pairs, reversed(scales), strict=True):
            way = way + (scale - r * float(y @ way)) * s
        way = np.where(way * slope < 0, way, 0.0)
        side = np.where(x == 0, -np.sign(slope), np.sign(x))
        step = 1.0 if pairs else 1.0 / max(1.0, float(np.abs(slope).sum()))
        for _ in range(30):
            moved = x + step * way
            moved[moved * side < 0] = 0.0
            to, steeper = smooth(moved)
            to += float(penalty @ np.abs(moved))
            if to <= value + 1e-4 * float(slope @ (moved - x)):
                break
            step /= 2
        else:
            break
        s, y = moved - x, steeper - gradient
        if float(s @ y) > 1e-12:
            pairs = [*pairs, (s, y, 1.0 / float(s @ y))][-_MEMORY:]
        gain, x, value, gradient = value - to, moved, to, steeper
        if gain <= least * abs(value):
            break
    return x


def _slices(starts: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about a million places each, or are one long row."""
    at = 0
    while at + 1 < len(starts):
        end = max(at + 1, int(np.searchsorted(starts, starts[at] + _BLOCK, side="right")) - 1)
        yield at, end
        at = end


class Lasso:
    """Logistic regression with a lasso penalty on binary features and some dense columns.

    Row i's features are places[starts[i]:starts[i + 1]]. Work goes block by block, so that
    little is held besides the places themselves.
    """

    def __init__(self, penalty: float = PENALTY, gain: float = GAIN):
        self.penalty, self.gain = penalty, gain

    def fit(self, places: np.ndarray, starts: np.ndarray, dense: np.ndarray, y: np.ndarray) -> Lasso:
        n, extra = len(y), dense.shape[1]
        counts = np.zeros(FEATURES, dtype=np.int64)
        for a, b in _slices(starts):
            counts += np.bincount(places[starts[a] : starts[b]], minlength=FEATURES)
        # A feature of fewer rows than this cannot outweigh the penalty.
        self.held = np.flatnonzero(counts >= max(1.0, self.penalty * n))
        width = len(self.held)
        column = np.full(FEATURES, -1, dtype=np.int32)
        column[self.held] = np.arange(width)
        blocks = []
        for a, b in _slices(starts):
            own = column[places[starts[a] : starts[b]]]
            row = np.repeat(np.arange(b - a, dtype=np.int32), np.diff(starts[a : b + 1]))
            blocks.append((a, b, row[own >= 0], own[own >= 0]))

        def smooth(x: np.ndarray) -> tuple[float, np.ndarray]:
            z = dense @ x[width : width + extra] + x[-1]
            for a, b, row, place in blocks:
                z[a:b] += np.bincount(row, weights=x[place], minlength=b - a)
            wrong = 1 / (1 + np.exp(-np.clip(z, -500, 500))) - y
            value = float((np.logaddexp(0, z) - y * z).mean())
            out = np.zeros(len(x))
            for a, b, row, place in blocks:
                out[:width] += np.bincount(place, weights=wrong[a:b][row], minlength=width)[:width]
            out[width : width + extra], out[-1] = dense.T @ wrong, wrong.sum()
            return value, out / n

        start, weights = np.zeros(width + extra + 1), np.full(width + extra + 1, self.penalty)
        share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
        start[-1], weights[-1] = np.log(share / (1 - share)), 0.0
        x = minimised(smooth, start, weights, self.gain)
        self.weights, self.dense, self.constant = x[:width], x[width : width + extra], float(x[-1])
        return self

    def probability(self, places: np.ndarray, starts: np.ndarray, dense: np.ndarray) -> np.ndarray:
        table = np.zeros(FEATURES)
        table[self.held] = self.weights
        return _sigmoid(_sums(table, places, starts) + dense @ self.dense + self.constant)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _sums(table: np.ndarray, places: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Per row the sum of its places' weights."""
    out = np.zeros(len(starts) - 1)
    for a, b in _slices(starts):
        row = np.repeat(np.arange(b - a), np.diff(starts[a : b + 1]))
        out[a:b] = np.bincount(row, weights=table[places[starts[a] : starts[b]]], minlength=b - a)
    return out


@dataclass
class Link:
    """One category's model: weights of feature places, of the earlier categories, and a constant.

    Without a constant it gives one fixed probability.
    """

    places: list[int]
    weights: list[float]
    earlier: list[float]
    constant: float | None
    fixed: float = 0.0

    def probability(self, flat: np.ndarray, starts: np.ndarray, earlier: list[np.ndarray]) -> np.ndarray:
        """Of texts whose places lie one after the other, text i's from starts[i] to starts[i + 1]."""
        if self.constant is None:
            return np.full(len(starts) - 1, self.fixed)
        table = np.zeros(FEATURES)
        table[self.places] = self.weights
        z = _sums(table, flat, starts) + self.constant
        for weight, column in zip(self.earlier, earlier, strict=True):
            z = z + weight * column
        return _sigmoid(z)


@dataclass
class ToxicityChain:
    categories: list[str]
    links: list[Link]

    def _judged(self, docs: DataFrame, text_column: str) -> DataFrame:
        """row (all of the input's columns) and p0, p1, ...: a probability per category."""
        links = self.links

        @F.pandas_udf("array<double>")
        def judged(places: pd.Series) -> pd.Series:
            starts = np.concatenate(([0], np.cumsum(places.map(len).to_numpy(dtype=np.int64))))
            flat = np.concatenate(places.tolist()) if starts[-1] else np.empty(0, dtype=np.int32)
            found: list[np.ndarray] = []
            for link in links:
                found.append(link.probability(flat, starts, found))
            return pd.Series(list(np.stack(found, axis=1)), index=places.index)

        frame = docs.select(as_row(docs), judged(beginnings(quoted(text_column))).alias("p"))
        return frame.select("row", *[F.get("p", i).alias(f"p{i}") for i in range(len(links))])

    def score(self, docs: DataFrame, text_column: str = "text") -> DataFrame:
        """The frame with one column probability_<category> per category, in the chain's order.

        NULL and empty texts get the probabilities of a text without words. Input columns of
        those names are replaced; all others and all rows stay, repeated rows too.
        """
        named = [f"probability_{c}" for c in self.categories]
        kept = docs.drop(*named)
        frame = self._judged(kept, text_column)
        return frame.select(*own_columns(kept), *[F.col(f"p{i}").alias(n) for i, n in enumerate(named)])

    def without(self, docs: DataFrame, category: str, threshold: float = THRESHOLD, text_column: str = "text") -> DataFrame:
        """The rows whose probability of the category is below the threshold, with all their own columns."""
        frame = self._judged(docs, text_column)
        return frame.where(F.col(f"p{self.categories.index(category)}") < threshold).select(*own_columns(docs))


def _fits(rows: DataFrame, y: str, folds: Sequence[int]) -> DataFrame:
    """Weights (place, value) and predictions (row, value) of the models of the given parts.

    Part k leaves fold k out and predicts it; part -1 is of all rows and predicts none. Places
    below 0 are -1 for the constant, -2 and on for the earlier categories.
    """

    def dense_of(table: pa.Table) -> np.ndarray:
        return np.array(table["earlier"].to_pylist(), dtype=float).reshape(table.num_rows, -1)

    def places_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        lists = table["places"].combine_chunks()
        sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        return lists.flatten().to_numpy(zero_copy_only=False), np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))

    def each(part: pa.Table) -> pa.Table:
        k = part["part"][0].as_py()
        own = pc.equal(part["fold"], k)
        known = part.filter(pc.and_(pc.invert(own), pc.is_valid(part["y"])))
        model = Lasso().fit(*places_of(known), dense_of(known), known["y"].to_numpy())
        del known
        if k >= 0:
            due = part.filter(own)
            rows, values = due["row"].to_numpy(), model.probability(*places_of(due), dense_of(due))
            places = np.zeros(len(rows))
        else:
            used = np.flatnonzero(model.weights)
            places = np.concatenate((model.held[used], -2 - np.arange(len(model.dense)), [-1]))
            values = np.concatenate((model.weights[used], model.dense, [model.constant]))
            rows = np.full(len(places), -1)
        columns = [np.full(len(rows), k, dtype=np.int32), rows.astype(np.int64), places.astype(np.int32), values]
        return pa.table([pa.array(c) for c in columns], names=["part", "row", "place", "value"])

    parts = rows.select("row", "fold", F.col(y).alias("y"), "places", "earlier", F.explode(F.lit([*folds])).alias("part"))
    return cut_lineage(parts.groupBy("part").applyInArrow(each, "part int, row long, place int, value double"))


def fit_chain(
    docs: DataFrame,
    labels: DataFrame,
    categories: Sequence[str],
    id_column: str = "doc_id",
    text_column: str = "text",
    train_rows: int = TRAIN_ROWS,
    folds: int = FOLDS,
) -> ToxicityChain:
    """Train the chain on labelled documents; `labels` has the id and a 0/1 column per category.

    Labels that repeat an id count once, by their largest value; NULL labels are passed over
    and ids without a document are ignored; documents that repeat an id are rows of their own. Of more
    than `train_rows` labelled rows about that many are taken. A category without both kinds of rows
    gets a constant probability, 0 if nothing is known.
    """
    with run_folder(docs.sparkSession):
        known = labels.where(quoted(id_column).isNotNull()).groupBy(quoted(id_column).alias("id")).agg(
            *[F.max(quoted(c)).cast("double").alias(f"y{i}") for i, c in enumerate(categories)]
        )
        count = max(1, known.count())
        share = min(_SCALE, _SCALE * train_rows // count)
        taken = settle(known.where(F.pmod(F.xxhash64("id"), F.lit(_SCALE)) < share)).frame
        texts = docs.select(quoted(id_column).alias("id"), quoted(text_column).alias("text"))
        fold = F.pmod(F.crc32(F.concat(F.lit("fold "), F.col("id").cast("string")).cast("binary")), F.lit(folds))
        ys = [f"y{i}" for i in range(len(categories))]
        rows = texts.join(taken, "id").select(
            F.monotonically_increasing_id().alias("row"), fold.cast("int").alias("fold"), *ys, beginnings(F.col("text")).alias("places")
        )
        rows = cut_lineage(rows).withColumn("earlier", F.array().cast("array<double>"))

        links: list[Link] = []
        for i, y in enumerate(ys):
            seen = {r[0] for r in rows.select(y).where(f"{y} is not null").distinct().collect()}  # two values at most
            last = i + 1 == len(ys)
            if len(seen) < 2:
                fixed = float(next(iter(seen), 0.0))
                links.append(Link([], [], [], None, fixed))
                rows = rows.withColumn("earlier", F.array_append("earlier", F.lit(fixed)))
                continue
            # A fold may lack a kind of label; the constant of such a fit is bounded, so it stays defined.
            fits = _fits(rows, y, [-1] if last else [-1, *range(folds)])
            found = {r.place: r.value for r in fits.where("part = -1").collect()}
            places = sorted(p for p in found if p >= 0)
            links.append(Link(places, [found[p] for p in places], [found[-2 - k] for k in range(i)], found[-1]))
            if not last:
                out = fits.where("part >= 0").select("row", F.col("value").alias("p"))
                rows = rows.join(out, "row").withColumn("earlier", F.array_append("earlier", F.col("p"))).drop("p")
                rows = cut_lineage(rows)
        return ToxicityChain(list(categories), links)


def junk_and_toxic(labels: DataFrame) -> DataFrame:
    """The categories of the labels table: low quality, then toxic."""
    return labels.select("doc_id", (1 - F.col("quality")).alias("junk"), F.col("toxic"))


def _chain(labelled: DataFrame, labels: DataFrame) -> ToxicityChain:
    return fit_chain(labelled, junk_and_toxic(labels), ["junk", "toxic"])


def scored(docs: DataFrame, labelled: DataFrame, labels: DataFrame) -> DataFrame:
    """`docs` with probability_junk, probability_toxic and rejected, by a chain fitted on `labelled`.

    `labels` has doc_id, quality and toxic (0/1). Columns of `docs` with those names are replaced. Every
    row of `docs` is judged by its own text, NULL like an empty one; without labels nothing is
    rejected. No rows give no rows.
    """
    found = _chain(labelled, labels).score(docs.drop("rejected"))
    return found.withColumn("rejected", F.col("probability_toxic") >= THRESHOLD)


def drop_toxic(docs: DataFrame, labelled: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs` that `scored` would not reject, with their own columns, whatever their names."""
    return _chain(labelled, labels).without(docs, "toxic")
