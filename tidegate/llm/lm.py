"""Document likelihood under a subword lattice, with corpus counts gathered by Spark.

The pieces and their order come from an existing vocabulary. A word is a path of pieces
through its characters; the marginal over all paths (log-space forward recursion) is its
subword probability. The vocabulary's own scores, read as ranks, weight the pieces.
Words seen in training also keep their share of the training tokens: of the probability
mass, the Good-Turing share of unseen events goes to the lattice and the rest to the counts,
which is one lattice with whole words as further arcs. No word crosses a word border, so
the document's marginal is the product over its tokens.

Words making up at least a HEAVY-th of all tokens, at most HEAVY of them, are scored where
the text is read; all others go through one shuffle as (document, word, count).
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.compare import quoted
from tidegate.session import cut_lineage

FOLDS, HELD_OUT = 7, 2
HEAVY = 20_000
SPACE = r"[\x20\x09-\x0D]+"
MARK = "▁"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Bytes with A-Z lowered; splitting bytes at white space splits at exactly the bytes of SPACE.
_LOWERED = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def words_of(text: Column) -> Column:
    """Words of a text with A-Z lowered, without white space."""
    return F.array_remove(F.split(F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _LOWER), SPACE), "")


class Lattice:
    """Marginal probabilities of words over all their segmentations into pieces."""

    def __init__(self, weights: dict[str, float], fallback: list[float]):
        self.weights = weights  # natural logarithms
        self.fallback = fallback  # of the 256 byte pieces
        # A beginning of pieces that is no piece itself has no weight; what is in here not at all ends the search.
        self.starts: dict[str, float | None] = {p[:n]: None for p in weights for n in range(1, len(p))}
        self.starts.update(weights)

    @classmethod
    def of_vocabulary(cls, model_file: str) -> Lattice:
        """Zipf weights by the rank that the vocabulary's scores give each piece."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        special = (model.is_byte, model.is_control, model.is_unknown, model.is_unused)
        normal = [i for i in range(model.get_piece_size()) if not any(test(i) for test in special)]
        ranked = sorted(normal, key=lambda i: (-model.get_score(i), i))
        raw = {model.id_to_piece(i): 1.0 / (50 + rank) for rank, i in enumerate(ranked)}
        raw = {p: w for p, w in raw.items() if p == MARK or MARK not in p[1:]}  # words hold one mark, in front
        rare = min(raw.values()) / 256
        total = sum(raw.values()) + 256 * rare
        return cls({p: math.log(w / total) for p, w in raw.items()}, [math.log(rare / total)] * 256)

    def log_probability(self, word: str) -> float:
        """Natural logarithm of the word's marginal, by forward recursion in log space."""
        text = MARK + word
        size, find, unknown = len(text), self.starts.get, self
        reached: list[list[float]] = [[] for _ in range(size + 1)]
        reached[0].append(0.0)
        for start in range(size):
            here = _summed(reached[start])
            reached[start] = []
            for end in range(start + 1, size + 1):
                weight = find(text[start:end], unknown)
                if weight is unknown:
                    break
                if weight is not None:
                    reached[end].append(here + weight)
            if text[start] not in self.weights:  # spelled in bytes
                spelled = text[start].encode("utf-8", "surrogatepass")
                reached[start + 1].append(here + sum([self.fallback[b] for b in spelled]))
        return _summed(reached[size])


def _summed(logs: list[float]) -> float:
    """Logarithm of the sum of the numbers with these logarithms."""
    if len(logs) == 1:
        return logs[0]
    top = max(logs)
    return top + math.log(sum([math.exp(x - top) for x in logs]))


def likelihoods(
    docs: DataFrame, model_file: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Per row: its id, held_out, n_tokens, n_known, train_tokens, base_score and score.

    Tokens are the words and one end per row. Rows whose crc32(id as text) leaves HELD_OUT
    modulo FOLDS are scored but not learnt from; a NULL id is learnt from. base_score is
    add-one over words, `score` the lattice model's log10 probability. NULL and empty texts are an
    end alone. Repeated rows are learnt from and scored each by itself. Without rows to
    learn from all words are unknown. Other columns are not read.
    """
    held = F.coalesce(F.pmod(F.crc32(quoted(id_column).cast("string")), F.lit(FOLDS)) == HELD_OUT, F.lit(False))
    rows = docs.select(quoted(id_column).alias("id"), held.alias("held"), quoted(text_column).alias("text"))

    learnt = F.sum(F.when(F.col("held"), 0).otherwise(1)).alias("c")
    words = cut_lineage(
        rows.select("held", F.explode(words_of(F.col("text"))).alias("word"))
        .groupBy("word")
        .agg(learnt, F.count(F.lit(1)).alias("seen"))
    )
    tokens, distinct, once, seen = words.agg(
        F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0), F.count_if(F.col("c") == 1), F.coalesce(F.sum("seen"), F.lit(0))
    ).first()
    ends = rows.where(~F.col("held")).count()
    tokens, distinct, once = tokens + ends, distinct + (ends > 0), once + (ends == 1)
    unseen = min(0.5, max(1e-4, once / tokens)) if tokens else 1.0

    shared = rows.sparkSession.sparkContext.broadcast(Lattice.of_vocabulary(model_file))  # of the vocabulary's size

    def base_of(c: int) -> float:
        return math.log10((c + 1) / (tokens + distinct + 1))

    def score_of(c: int, log_marginal: float) -> float:
        marginal = math.log(unseen) + log_marginal
        if not c or not tokens:
            return marginal / math.log(10)
        counted = math.log((1 - unseen) * c / tokens)
        top = max(counted, marginal)
        return (top + math.log(math.exp(counted - top) + math.exp(marginal - top))) / math.log(10)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held_words, counts = batch.column(0), batch.column(1).to_pylist()
            scores = [
                score_of(c, shared.value.log_probability(w)) for w, c in zip(held_words.to_pylist(), counts, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [held_words, batch.column(1), batch.column(2), pa.array([base_of(c) for c in counts], pa.float64()),
                 pa.array(scores, pa.float64())],
                ["word", "c", "seen", "base", "score"],
            )

    table = cut_lineage(
        words.select("word", "c", "seen").mapInArrow(score, "word string, c long, seen long, base double, score double")
    )
    heavy = F.col("seen") >= max(2, seen // HEAVY)
    often = {r["word"].encode("utf-8"): (r["c"] > 0, r["base"], r["score"]) for r in table.where(heavy).collect()}  # at most HEAVY
    end = (int(ends > 0), base_of(ends), score_of(ends, math.log(ends / tokens) if ends else 0.0))
    frequent = rows.sparkSession.sparkContext.broadcast(often)
    kind = docs.schema[id_column].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["at", "id", "held", "word", "k", "known", "base", "score"]
        types = [pa.int64(), None, pa.bool_(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        scored = frequent.value
        for batch in batches:
            types[1] = batch.schema.field(1).type
            whole: list[list] = [[] for _ in names]  # a row per document
            rest: list[list] = [[], [], []]  # at, word and k of what is not frequent

            def flush(whole=whole, rest=rest, types=tuple(types)):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(whole, types, strict=True)], names)
                size = len(rest[0])
                told = dict(zip(("at", "word", "k"), rest, strict=True))
                columns = [
                    pa.array(told[n], pa.binary() if n == "word" else t).cast(t) if n in told else pa.nulls(size, t)
                    for n, t in zip(names, types, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(columns, names)
                for column in (*whole, *rest):
                    column.clear()

            for at, key, kept, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                counts = Counter((text or "").encode("utf-8", "surrogatepass").translate(_LOWERED).split())
                n, known, base, total = 1, end[0], end[1], end[2]
                seldom = []
                for word, k in counts.items():
                    hit = scored.get(word)
                    n += k
                    if hit is None:
                        seldom.append(word)
                    else:
                        known += k * hit[0]
                        base += k * hit[1]
                        total += k * hit[2]
                rest[0].extend([at] * len(seldom))
                rest[1].extend(seldom)
                rest[2].extend([counts[word] for word in seldom])
                for column, value in zip(whole, (at, key, kept, None, n, known, base, total), strict=True):
                    column.append(value)
                if len(rest[0]) > 200_000:
                    yield from flush()
            yield from flush()

    parts = cut_lineage(
        rows.select(F.monotonically_increasing_id().alias("at"), "id", "held", F.col("text").cast("string"))
        .mapInArrow(
            read,
            f"at long, id {kind}, held boolean, word string, k long, known long, base double, score double",
        )
    )
    whole = parts.where("word is null").select("at", "id", "held", F.col("k").alias("n"), "known", "base", "score")
    rest = (
        parts.where("word is not null")
        .select("at", "word", "k")
        .join(table.where(~heavy).select("word", "c", "base", "score"), "word")
        .select(
            "at", F.lit(None).cast(kind).alias("id"), F.lit(None).cast("boolean").alias("held"),
            F.lit(0).cast("long").alias("n"), F.when(F.col("c") > 0, F.col("k")).otherwise(0).cast("long").alias("known"),
            (F.col("k") * F.col("base")).alias("base"), (F.col("k") * F.col("score")).alias("score"),
        )
    )
    return (
        whole.unionByName(rest)
        .groupBy("at")
        .agg(
            F.max("id").alias("id"), F.max("held").alias("held"), F.sum("n").alias("n"), F.sum("known").alias("known"),
            F.sum("base").alias("base"), F.sum("score").alias("score"),
        )
        .select(
            F.col("id").alias(id_column), F.col("held").alias("held_out"), F.col("n").alias("n_tokens"),
            F.col("known").alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"),
            F.col("base").alias("base_score"), "score",
        )
    )
