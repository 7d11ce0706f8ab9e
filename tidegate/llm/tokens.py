"""Token counts by byte-pair merging on a heap and a linked list; no identifiers are made.

For vocabularies in which a piece is merged whenever two neighbours spell it, lowest rank
first and leftmost on ties. White space is a marker that no piece holds after another
character, so a text falls into independent chunks, and the counts of short ones are kept
in a bounded table in each worker.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.functions.compare import quoted

MARK = "▁"
KEPT_CHUNKS = 1 << 18
KEPT_LENGTH = 48
OVER_LIMIT = 4096


def load_ranks(model_file: str) -> dict[str, float]:
    """Rank per piece of a sentencepiece model with byte fallback, lower merges first."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    special = (model.is_byte, model.is_control, model.is_unknown, model.is_unused)
    ranks = {
        model.id_to_piece(i): -model.get_score(i)
        for i in range(model.get_piece_size())
        if not any(test(i) for test in special)
    }
    for piece in ranks:
        if MARK in piece.lstrip(MARK) or "\n" in piece or any(c not in ranks for c in piece):
            raise ValueError(f"piece {piece!r} does not allow counting by chunks")
    return ranks


def merges(symbols: str, ranks: dict[str, float]) -> int:
    """How many merges the symbols allow, popping the lowest-ranked adjacent pair each time."""
    held: list[str | None] = list(symbols)
    size = len(held)
    before, after = list(range(-1, size - 1)), list(range(1, size + 1))
    heap = [
        (rank, i, both)
        for i in range(size - 1)
        if (rank := ranks.get(both := symbols[i : i + 2])) is not None
    ]
    heapify(heap)
    done = 0
    while heap:
        _, left, both = heappop(heap)
        right = after[left]
        if held[left] is None or right >= size or len(held[left]) + len(held[right]) != len(both):
            continue  # one of the two has been merged since
        held[left], held[right] = both, None
        done += 1
        follower, leader = after[right], before[left]
        after[left] = follower
        if follower < size:
            before[follower] = left
            joined = both + held[follower]
            if (rank := ranks.get(joined)) is not None:
                heappush(heap, (rank, left, joined))
        if leader >= 0:
            joined = held[leader] + both
            if (rank := ranks.get(joined)) is not None:
                heappush(heap, (rank, leader, joined))
    return done


class TokenCounter(dict):
    """Chunk -> number of tokens; computes what it lacks and stays below KEPT_CHUNKS entries."""

    _CHUNK = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")

    def __init__(self, ranks: dict[str, float]):
        super().__init__()
        self.ranks = ranks

    def __missing__(self, chunk: str) -> int:
        symbols = sum(1 if c in self.ranks else len(c.encode("utf-8", "surrogatepass")) for c in chunk)
        tokens = symbols - merges(chunk, self.ranks)
        if len(chunk) <= KEPT_LENGTH:
            if len(self) >= KEPT_CHUNKS:
                self.clear()
            self[chunk] = tokens
        return tokens

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        chunks: Iterator[str] = (m.group() for m in self._CHUNK.finditer(MARK + text.replace(" ", MARK)))
        return sum(map(self.__getitem__, chunks))


_COUNTERS: dict[int, TokenCounter] = {}


def token_count(spark: SparkSession, text: Column, model_file: str) -> Column:
    """Tokens of a text column. The vocabulary, of a fixed size, is sent to the executors."""
    ranks = spark.sparkContext.broadcast(load_ranks(model_file))

    @F.pandas_udf("long")
    def counted(texts: pd.Series) -> pd.Series:
        counter = _COUNTERS.get(id(ranks.value))
        if counter is None:
            _COUNTERS.clear()
            counter = _COUNTERS[id(ranks.value)] = TokenCounter(ranks.value)
        return pd.Series([counter.count(t) for t in texts], dtype="int64")

    return counted(F.coalesce(text.cast("string"), F.lit("")))


def token_counts(
    docs: DataFrame, model_file: str, id_column: str = "doc_id", text_column: str = "text", limit: int = OVER_LIMIT
) -> DataFrame:
    """Per row: its id, n_bytes, n_tokens and over_limit (n_tokens > limit).

    NULL and empty texts have no bytes and no tokens. Every row is counted by itself, repeated
    rows and NULL ids too; texts of any length are counted whole. Other columns are not read.
    """
    text = quoted(text_column)
    counted = docs.select(
        quoted(id_column).alias(id_column),
        F.octet_length(F.coalesce(text.cast("string"), F.lit(""))).cast("long").alias("n_bytes"),
        token_count(docs.sparkSession, text, model_file).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
