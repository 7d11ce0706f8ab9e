"""Periodic runs of words: seeds on diagonals, extended once each.

A run of smallest period q and length L repeats itself on the diagonal of lag q over L - q
words. With L >= max(SHORTEST, EXPONENT * q) that overlap has a guaranteed minimum, which is
the length of the k-grams indexed. Lags go in octaves, (k/2, k] for k-grams: a k-gram as long
as the period occurs next exactly one period on, so every occurrence has to be paired with
its next one only, and that lag is the smallest period there. k-grams of doubled length are
named by pairs of names, which tells them apart exactly, without hashing; where no k-gram
occurs twice, no longer one does.

Pairs of a lag go from left to right. What the last extension of that lag has covered is not
extended again, so each run is found once, and a text costs n log n.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.functions.compare import quoted

# A run has at least so many words, and at least so many times its period.
SHORTEST, EXPONENT = 24, 3

_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def guaranteed_overlap(shortest: int = SHORTEST, exponent: int = EXPONENT) -> int:
    """Words that every run shares with itself one period on, at least."""
    return min(max(shortest - q, (exponent - 1) * q) for q in range(1, shortest + 1))


def _doubled(names: np.ndarray, by: int) -> np.ndarray:
    """Names of the k-grams made of two neighbours `by` apart."""
    pairs = names[:-by] * (int(names.max()) + 1) + names[by:]
    return np.unique(pairs, return_inverse=True)[1]


def _next_lags(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose k-gram occurs again, and how far on it does so first."""
    order = np.argsort(names, kind="stable")
    again = names[order[1:]] == names[order[:-1]]
    at = order[:-1][again]
    return at, order[1:][again] - at


def _extended(words: np.ndarray, at: int, lag: int) -> tuple[int, int]:
    """The widest [start, end) around `at` in which words `lag` apart are identical."""
    end, step = at, 64
    while end + lag < len(words):
        upto = min(end + step, len(words) - lag)
        other = np.flatnonzero(words[end:upto] != words[end + lag : upto + lag])
        if len(other):
            end += int(other[0])
            break
        end, step = upto, 2 * step
    start, step = at, 64
    while start > 0:
        down = max(start - step, 0)
        other = np.flatnonzero(words[down:start] != words[down + lag : start + lag])
        if len(other):
            start = down + int(other[-1]) + 1
            break
        start, step = down, 2 * step
    return start, end + lag


def find_runs(words: np.ndarray, shortest: int = SHORTEST, exponent: int = EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of the word numbers, by start, then period."""
    if len(words) < shortest or shortest < 1:
        return []
    seed = guaranteed_overlap(shortest, exponent)
    k, names = 1, words
    while 2 * k <= seed:  # a power of two, so that lengths can be doubled
        if len(names) <= k:
            return []
        names, k = _doubled(names, k), 2 * k
        if int(names.max()) + 1 == len(names):
            return []
    found, least = [], 1
    while True:
        at, lag = _next_lags(names)
        if not len(at):
            break
        fits = (lag >= least) & (lag <= k)
        at, lag = at[fits], lag[fits]
        order = np.lexsort((at, lag))
        at, lag = at[order], lag[order]
        lags, firsts = np.unique(lag, return_index=True)
        dealt = np.split(at, firsts[1:]) if len(at) else []
        covered = dict.fromkeys(lags.tolist(), 0)  # per lag: seeds before this position are done
        for q, seeds in zip(lags.tolist(), dealt, strict=True):
            place = 0
            while place < len(seeds):
                start, end = _extended(words, int(seeds[place]), q)
                covered[q] = end - q
                if end - start >= max(shortest, exponent * q):
                    found.append((start, end - start, q))
                place = int(np.searchsorted(seeds, covered[q]))
        least = k + 1
        if exponent * least > len(words) or len(names) <= k:
            break
        names, k = _doubled(names, k), 2 * k
    return sorted(found, key=lambda run: (run[0], run[2]))


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> str:
    """The words but those that a run repeats after its first period."""
    if runs:
        edge = np.zeros(len(words) + 1, dtype=np.int64)
        for start, length, period in runs:
            edge[start + period] += 1
            edge[start + length] -= 1
        words = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]
    return b" ".join(words).decode("utf-8", "surrogatepass")


def periodic_runs(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shortest: int = SHORTEST,
    exponent: int = EXPONENT,
) -> DataFrame:
    """Per row: its id, n_words, runs (start, length, period) and the collapsed text.

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0, told apart as they stand. A run is a stretch
    with smallest period q and at least max(shortest, exponent * q) words that no neighbour
    extends; runs go by start, then period. Collapsed is the text's words, joined by one space,
    without those that a run contains after its first period. NULL and empty texts have no words,
    no runs and an empty collapsed text. Each row is judged by itself, so repeated rows and rows
    without an id come out as they come in; no rows give no rows. Other columns are not read.
    Exponents below 3 need seeds shorter than a period and are refused.
    """
    if exponent < 3 or shortest < 2:
        raise ValueError("runs need an exponent of 3 or more and two words or more")
    kind = docs.schema[id_column].dataType

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in range(0, batch.num_rows, 1000):  # bounds what is held besides the batch itself
                some = batch.slice(part, 1000)
                counts, runs, texts = [], [], []
                for text in some.column(1):
                    words = text.as_py().encode("utf-8", "surrogatepass").split()
                    numbers: dict[bytes, int] = {}
                    named = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
                    held = find_runs(named, shortest, exponent)
                    counts.append(len(words))
                    runs.append([{"start": s, "length": n, "period": q} for s, n, q in held])
                    texts.append(_collapsed(words, held))
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(counts, pa.int64()), pa.array(runs, _RUNS), pa.array(texts, pa.string())],
                    ["id", "n_words", "runs", "collapsed"],
                )

    text = F.coalesce(quoted(text_column).cast("string"), F.lit(""))
    rows = docs.select(quoted(id_column).alias("id"), text.alias("text"))
    return rows.mapInArrow(
        each,
        f"id {kind.simpleString()}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string",
    ).select(F.col("id").alias(id_column), "n_words", "runs", "collapsed")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text, a tenth of the texts with a tail that repeats, by the id's checksum.

    With h the unsigned CRC-32 of the decimal id and g = h / 10: where h % 10 = 0, each of the n
    words from a = g % n on becomes word a + (i - a) % p, p = 1 + (n - a) / (3 + g % 8), whole
    divisions; the words are then joined by one space. Other texts, those without words and
    rows without an id stay as they are.
    """
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    chosen = F.coalesce(F.col("h") % 10 == 0, F.lit(False))
    rows = rows.select("doc_id", "text", F.expr("h div 10").alias("g"), F.when(chosen, words).alias("w"))
    rows = rows.select("doc_id", "text", "g", "w", F.expr("cast(g % nullif(size(w), 0) as int)").alias("a"))
    period = F.expr("cast(1 + (size(w) - a) div (3 + g % 8) as int)")
    rows = rows.select("doc_id", "text", "w", "a", period.alias("p"))
    tail = F.expr("transform(sequence(0, size(w) - a - 1), i -> w[a + i % p])")
    planted = F.array_join(F.concat(F.expr("slice(w, 1, a)"), tail), " ")
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), planted).otherwise(F.col("text")).alias("text"))


def run_digests(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Per row of `periodic_runs`: number of runs, the one of greatest exponent, and two digests.

    The greatest exponent is compared exactly; of equal ones the smallest start counts, then
    the smallest period. Without runs its four columns are NULL.
    """
    best = F.expr(
        """aggregate(runs, cast(null as struct<start: bigint, length: bigint, period: bigint>), (x, r) ->
             if(x is null or r.length * x.period > x.length * r.period, r, x))"""
    )
    listed = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    rows = found.select(quoted(id_column).alias(id_column), "runs", "collapsed", best.alias("best"))
    return rows.select(
        quoted(id_column).alias(id_column),
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )
