"""Benchmark decontamination as a prefix-filtered set join, on DataFrame functions only.

The sets are the windows of the benchmark items; their tokens are shingles of up to three
words. A document holds a window only if it holds all of the window's tokens, so the rarest
of them (counted over all documents) is the necessary prefix: a candidate is a place of that
token in a document. The token's offset gives the one start it can have (positional bound),
and the window must end within the document (length bound). A candidate is verified by
finding every token of the window at its own place; consecutive equal shingles are equal
word sequences, so this is exact. Texts are never shuffled: only the places of benchmark
tokens and one narrow row per document are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.compare import quoted
from tidegate.llm.payload import as_row, own_columns
from tidegate.operators.sizing import settle
from tidegate.session import cut_lineage

WINDOW = 10
TOKEN_WORDS = 3
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """The words of a text with A-Z lowered: runs of digits, letters and non-ASCII characters."""
    lowered = F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _LOWER)
    return F.array_remove(F.split(lowered, NO_WORD), "")


def _joined(words: Column, start: Column, length: int) -> Column:
    return F.array_join(F.slice(words, start, F.lit(length)), " ")


def _windows(benchmark: DataFrame, item_column: str, text_column: str, size: int) -> DataFrame:
    """One row per distinct window: its words, their number and the items that hold it."""
    words = benchmark.select(
        quoted(item_column).cast("string").alias("item"), words_of(quoted(text_column)).alias("words")
    ).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - size + 1, F.lit(1)))
    each = words.select("item", "words", F.explode(starts).alias("at")).select(
        "item", F.slice("words", F.col("at"), F.lit(size)).alias("words")
    )
    return each.groupBy("words").agg(F.collect_set("item").alias("items")).withColumn("length", F.size("words"))


def _tokens(words: Column, width: int, count: Column) -> Column:
    """The first `count` shingles of `width` words, in order, as strings."""
    if width == 1:
        return F.slice(words, F.lit(1), count)
    return F.transform(
        F.slice(words, F.lit(1), count),
        lambda w, i: F.concat_ws(" ", w, *[F.get(words, i + k) for k in range(1, width)]),
    )


def _window_tokens(windows: DataFrame) -> DataFrame:
    """(words, width, offset, token): every shingle of every window."""
    found = None
    for width in range(1, TOKEN_WORDS + 1):
        fits = F.col("length") == width if width < TOKEN_WORDS else F.col("length") >= width
        part = windows.where(fits).select(
            "words", "length", "items", F.lit(width).alias("width"),
            F.posexplode(_tokens(F.col("words"), width, F.size("words") - width + 1)).alias("offset", "token"),
        )
        found = part if found is None else found.unionByName(part)
    return found


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """Per document row: its id, n_words, n_hit, n_items, items_sha256, contaminated.

    A word is hit if it lies in any occurrence of a window: `window` consecutive words of an
    item, or a shorter item as a whole. NULL and empty texts have no words; items without
    words have no window; items whose id is NULL hit words but are not counted. Rows that
    repeat an id are judged each by its own text. An empty benchmark hits nothing. Other
    columns are not read.
    """
    found = _contamination(docs, benchmark, id_column, text_column, item_column, item_text_column, window)
    return found.select(
        F.col("doc").alias(id_column),
        "n_words",
        F.col("n_hit").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def _mark(text_column: str) -> Column:
    """Tells rows of one id apart by their text."""
    return F.xxhash64(F.coalesce(quoted(text_column).cast("string"), F.lit("")))


def _contamination(docs, benchmark, id_column, text_column, item_column, item_text_column, window) -> DataFrame:
    """doc, mark, n_words, n_hit and items of every row."""
    keyed = docs.select(
        quoted(id_column).alias("doc"), _mark(text_column).alias("mark"), words_of(quoted(text_column)).alias("words")
    )
    windows = cut_lineage(_windows(benchmark, item_column, item_text_column, window))
    shingles = cut_lineage(_window_tokens(windows))
    widths = sorted(r[0] for r in shingles.select("width").distinct().collect())  # at most TOKEN_WORDS values

    # Places of benchmark tokens in all documents: the only rows taken from the texts.
    wanted = settle(shingles.select("token").distinct()).frame
    places = None
    for width in widths:
        every = keyed.where(F.size("words") >= width).select(
            "doc", "mark", F.size("words").alias("n_words"),
            F.posexplode(_tokens(F.col("words"), width, F.size("words") - width + 1)).alias("place", "token"),
        )
        part = every.join(wanted, "token", "left_semi").withColumn("width", F.lit(width))
        places = part if places is None else places.unionByName(part)
    counted = keyed.select("doc", "mark", F.size("words").cast("long").alias("n_words"))
    if places is None:
        return counted.withColumns({"n_hit": F.lit(0), "items": F.array().cast("array<string>")})
    places = cut_lineage(places)

    rarity = places.groupBy("width", "token").agg(F.count(F.lit(1)).alias("seen"))
    ranked = shingles.join(rarity, ["width", "token"], "left").withColumn("seen", F.coalesce("seen", F.lit(0)))
    place_of = F.struct("seen", "token", "offset")
    prefix = (
        ranked.groupBy("words")
        .agg(F.min(place_of).alias("rarest"), F.first("length").alias("length"), F.first("width").alias("width"))
        .select("words", "length", "width", F.col("rarest.token").alias("token"), F.col("rarest.offset").alias("offset"))
    )
    candidates = (
        places.join(settle(prefix).frame, ["width", "token"])
        .withColumn("start", F.col("place") - F.col("offset"))
        .where((F.col("start") >= 0) & (F.col("start") + F.col("length") <= F.col("n_words")))
        .select("doc", "mark", "start", "words")
        .distinct()
    )
    own = settle(shingles.select("words", "length", "width", "offset", "token", "items")).frame
    asked = candidates.join(own, "words").select(
        "doc", "mark", "start", "words", "length", "width", "items",
        (F.col("start") + F.col("offset")).alias("place"), "token",
    )
    # Repeated rows have the same places twice; the distinct keeps the count of tokens right.
    spots = places.select("doc", "mark", "place", "token", "width").distinct().alias("p")
    asked = asked.alias("a")
    same = F.expr(
        "a.doc <=> p.doc and a.mark = p.mark and a.place = p.place and a.token = p.token and a.width = p.width"
    )
    verified = (
        asked.join(spots, same)
        .groupBy("a.doc", "a.mark", "a.start", "a.words")
        .agg(F.count(F.lit(1)).alias("n"), F.first("a.length").alias("length"), F.first("a.width").alias("width"),
             F.first("a.items").alias("items"))
        .where(F.col("n") == F.col("length") - F.col("width") + 1)
    )
    per_doc = (
        verified.groupBy("doc", "mark")
        .agg(F.collect_set(F.struct("start", "length")).alias("spans"), F.collect_set("items").alias("items"))
        .select("doc", "mark", _covered(F.col("spans")).alias("n_hit"), F.array_distinct(F.flatten("items")).alias("items"))
    )
    hit = cut_lineage(per_doc).alias("h")
    joined = counted.alias("c").join(hit, F.expr("c.doc <=> h.doc and c.mark = h.mark"), "left")
    return joined.select(
        "c.doc", "c.mark", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def _covered(spans: Column) -> Column:
    """Number of places within any of the (start, length) spans."""
    nothing = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("total"))

    def add(done: Column, span: Column) -> Column:
        end = (span["start"] + span["length"]).cast("long")
        fresh = F.greatest(end - F.greatest(done["end"], span["start"].cast("long")), F.lit(0).cast("long"))
        return F.struct(F.greatest(done["end"], end).alias("end"), (done["total"] + fresh).alias("total"))

    return F.aggregate(F.array_sort(spans), nothing, add, lambda done: done["total"])


def drop_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """The rows without any hit word, with all their columns, each judged by its own text."""
    found = _contamination(docs, benchmark, id_column, text_column, item_column, item_text_column, window)
    bad = found.where("n_hit > 0").select(F.col("doc").alias("bad"), F.col("mark").alias("bad_mark")).distinct()
    rows = docs.select(as_row(docs), quoted(id_column).alias("id"), _mark(text_column).alias("mark"))
    same = F.expr("id <=> bad and mark = bad_mark")
    return rows.join(settle(bad).frame, same, "left_anti").select(*own_columns(docs))
