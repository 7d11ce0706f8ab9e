"""Exact deduplication by two Bloom passes, on DataFrame functions only.

Pass one counts how many rows set each bit of a blocked Bloom filter (two bits within one
64-bit word per row) and keeps the bits set at least twice. Pass two tests every row
against those: a row whose two bits are not both repeated has no equal and passes straight
through. Only the others are written once, grouped by their digest and joined back.
False positives cost a shuffle of that row and nothing else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.compare import quoted
from tidegate.operators.sizing import settle
from tidegate.session import cut_lineage

# Bits of the filter per row; with two bits per row about one row in 60 is a false positive.
BITS_PER_ROW = 16
WHITE_SPACE = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """The text with every run of white space as one space; NULL is empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), WHITE_SPACE, " ")


def _bits(words: int) -> tuple[Column, Column, Column]:
    """Word and the two bit positions of a row, from its digest."""
    place, spread = F.xxhash64("sha"), F.xxhash64("sha", F.lit(1))
    return F.pmod(place, F.lit(words)), spread.bitwiseAND(63), F.shiftright(spread, 6).bitwiseAND(63)


def _repeated_bits(hashed: DataFrame, words: int) -> DataFrame:
    word, first, second = _bits(words)
    return (
        hashed.select(word.alias("word"), F.explode(F.array(first, second)).alias("bit"))
        .groupBy("word", "bit")
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .groupBy("word")
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit as int))")).alias("bits"))
    )


def _decided(docs: DataFrame, id_column: str, text_column: str, payload: Column) -> DataFrame:
    """payload, id, sha, keep_id, group_size and kept of every row."""
    hashed = docs.select(
        payload.alias("payload"),
        quoted(id_column).alias("id"),
        F.sha2(normalised(quoted(text_column)), 256).alias("sha"),
    )
    words = max(1, docs.count() * BITS_PER_ROW // 64)
    repeated = settle(_repeated_bits(hashed, words)).frame
    word, first, second = _bits(words)
    mask = F.expr("shiftleft(1L, cast(first as int)) | shiftleft(1L, cast(second as int))")
    tested = (
        hashed.withColumns({"word": word, "first": first, "second": second})
        .join(repeated, "word", "left")
        .withColumn("maybe", F.coalesce(F.col("bits").bitwiseAND(mask) == mask, F.lit(False)))
    )
    alone = tested.where(~F.col("maybe")).select(
        "payload", "id", "sha", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
    )
    # The row number tells repeated rows apart; it is fixed once the rows are written.
    rows = cut_lineage(
        tested.where("maybe").select("payload", "id", "sha", F.monotonically_increasing_id().alias("at"))
    )
    order = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("at").alias("at"))
    groups = cut_lineage(
        rows.groupBy("sha").agg(F.min(order).alias("stays"), F.count(F.lit(1)).alias("group_size"))
    )
    grouped = rows.join(groups, "sha").select(
        "payload", "id", "sha", F.col("stays.id").alias("keep_id"), "group_size",
        (F.col("stays.at") == F.col("at")).alias("kept"),
    )
    return alone.unionByName(grouped)


def exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: its id, keep_id, group_size, kept and text_sha256.

    Of equal texts the row with the smallest id stays; ids that are NULL come last, and of
    rows that repeat both id and text any one stays. NULL text is empty text, and empty
    texts equal each other. No rows give no rows. Other columns are not read.
    """
    decided = _decided(docs, id_column, text_column, F.lit(True))
    return decided.select(
        F.col("id").alias(id_column), "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256")
    )


def drop_exact_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows that `exact_duplicates` keeps, with all their columns, whatever their names."""
    everything = F.struct(*[quoted(c) for c in docs.columns])
    kept = _decided(docs, id_column, text_column, everything).where("kept")
    return kept.select("payload.*")
