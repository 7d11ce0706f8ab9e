"""Near-duplicate documents: MinHash banding, verification on full sets, components.

1. One pass over the texts gives each document the digest of its shingle set and a signature
   of universal hash minima. Documents of one digest are one class; only classes go on.
2. Banding: classes that agree in all rows of a band share a bucket. Every member is paired
   with the bucket's smallest class, never with all others.
3. Pairs whose signatures make the similarity implausible are dropped; the others are
   confirmed on the full sets, and components are formed.
4. Buckets that still hold several components may hide links between members other than the
   smallest. Their members meet a few other hubs, members of the bucket's most frequent
   component, which connects most of what belongs together at a linear cost. What
   is open then is joined exactly by a prefix filter with size and position bounds, in which
   a pair is only formed across components; its pairs are confirmed on full sets at once.
5. Components of all confirmed links; a document's component is named by its smallest id.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.compare import quoted
from tidegate.llm.components import components
from tidegate.llm.payload import as_row, own_columns
from tidegate.llm.shingles import UniversalHashes, overlap, shingle_set
from tidegate.operators.sizing import settle
from tidegate.session import cut_lineage, finished, run_folder, step_copy

SHINGLE_WORDS = 5
SEED = 20_011
# Chance at most that a pair at the threshold shares no band, and hash functions at most.
MISS, HASHES = 1e-6, 256
# Bytes of one minimum in a signature.
WIDE = 2
# Other hubs that members of undecided buckets meet before the prefix join, all in one pass.
ROUNDS = 3
_CHUNK = 1 << 15


def banding(percent: int, miss: float = MISS, hashes: int = HASHES) -> tuple[int, int]:
    """(rows, bands): the longest bands that keep the miss chance at the threshold."""
    for rows in range(12, 0, -1):
        bands = math.ceil(math.log(miss) / math.log1p(-((percent / 100) ** rows)))
        if rows * bands <= hashes:
            return rows, bands
    raise ValueError("no banding with that few hash functions")


def _plausible(percent: int, count: int, miss: float = MISS) -> int:
    """Equal minima that a pair at the threshold has but for a chance of `miss` (binomial tail)."""
    share, tail = percent / 100, 0.0
    for equal in range(count + 1):
        tail += math.comb(count, equal) * share**equal * (1 - share) ** (count - equal)
        if tail > miss:
            return equal
    return count


def _profiles(docs: DataFrame, id_column: str, text_column: str, width: int, count: int) -> DataFrame:
    """id, mark (of the text), n, digest and signature of every row."""
    kind = docs.schema[id_column].dataType

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = UniversalHashes(count, SEED)
        for batch in batches:
            sizes, digests, signatures, waiting, held = [], [], [], [], 0

            def flush(waiting=waiting, signatures=signatures):
                if waiting:
                    starts = np.cumsum([0] + [len(s) for s in waiting[:-1]])
                    minima = hashes.minima(np.concatenate(waiting), starts)
                    signatures.extend(row.tobytes() for row in np.ascontiguousarray(minima.T))
                    waiting.clear()

            for text in batch.column(2):
                held_set = shingle_set(text.as_py(), width)
                sizes.append(len(held_set))
                digests.append(hashlib.blake2b(held_set.tobytes(), digest_size=16).digest())
                waiting.append(held_set if len(held_set) else np.zeros(1, dtype=np.uint64))
                held += len(held_set)
                if held > _CHUNK:
                    flush()
                    held = 0
            flush()
            columns = [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                       pa.array(signatures, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "mark", "n", "digest", "signature"])

    text = F.coalesce(quoted(text_column).cast("string"), F.lit(""))
    rows = docs.select(quoted(id_column).alias("id"), F.xxhash64(text).alias("mark"), text.alias("text"))
    return rows.mapInArrow(each, f"id {kind.simpleString()}, mark long, n long, digest binary, signature binary")


def _sets(texts: DataFrame, width: int) -> DataFrame:
    """digest, n and the shingle set of rows (digest, text)."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_py(), width).view(np.int64) for t in batch.column(1)]
            sizes = pa.array([len(s) for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), sizes, pa.array(sets, pa.list_(pa.int64()))], ["digest", "n", "shingles"]
            )

    return texts.select("digest", "text").mapInArrow(each, "digest binary, n long, shingles array<long>")


def _sizes_allow(percent: int, left: Column, right: Column) -> Column:
    return F.least(left, right) * 100 >= F.greatest(left, right) * percent


def _screened(pairs: DataFrame, classes: DataFrame, percent: int, count: int) -> DataFrame:
    """Pairs (u, v) whose sizes and signatures make a link plausible."""
    least = _plausible(percent, count)
    one = classes.select(F.col("digest").alias("u"), F.col("n").alias("nu"), F.col("signature").alias("su"))
    two = classes.select(F.col("digest").alias("v"), F.col("n").alias("nv"), F.col("signature").alias("sv"))
    joined = pairs.join(two, "v").join(one, "u").where(_sizes_allow(percent, F.col("nu"), F.col("nv")))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [
                np.count_nonzero(np.frombuffer(a.as_py(), np.uint16) == np.frombuffer(b.as_py(), np.uint16)) >= least
                for a, b in zip(batch.column(2), batch.column(3), strict=True)
            ]
            chosen = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([chosen.column(0), chosen.column(1)], ["u", "v"])

    return joined.select("u", "v", "su", "sv").mapInArrow(each, "u binary, v binary")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose full sets reach the threshold."""
    one = sets.select(F.col("digest").alias("u"), F.col("shingles").alias("au"))
    two = sets.select(F.col("digest").alias("v"), F.col("shingles").alias("av"))

    def array(scalar: pa.ListScalar) -> np.ndarray:
        return scalar.values.to_numpy(zero_copy_only=False).view(np.uint64)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2), batch.column(3), strict=True):
                left, right = array(a), array(b)
                both = overlap(left, right)
                keep.append(100 * both >= percent * (len(left) + len(right) - both))
            chosen = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([chosen.column(0), chosen.column(1)], ["u", "v"])

    joined = pairs.join(two, "v").join(one, "u").select("u", "v", "au", "av")
    return joined.mapInArrow(each, "u binary, v binary")


def _prefix_pairs(sets: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (u, v) across roots that can reach the threshold, of the nodes (digest, root).

    Shingles are ordered by rarity. Of a pair (x, y) with n_x >= n_y, some shared shingle
    is early enough in both orders for the rest to reach the needed overlap; shingles of one
    class alone cannot be shared and only take up the first places. Nodes and roots go by
    numbers, as a row per shingle is shuffled.
    """
    p = percent
    numbered = cut_lineage(nodes.withColumn("node", F.monotonically_increasing_id()))
    by_root = numbered.groupBy("root").agg(F.min("node").alias("root_node"))
    numbered = cut_lineage(numbered.join(by_root, "root").select("digest", "node", "root_node"))
    held = sets.join(numbered, "digest")
    each = held.select("node", F.explode("shingles").alias("token"))
    shared = each.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    # ceil(percent * n / 100) of n must be shared at least, so only this many places can come first.
    room = F.expr(f"n - ceil({p} * n / 100.0) + 1")
    sizes_of = sets.select("digest", "n").join(numbered, "digest").select("node", "n", F.col("root_node").alias("root"))
    rows = (
        each.join(shared, "token")
        .groupBy("node")
        .agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("tokens"))
        .join(sizes_of, "node")
        .withColumn("alone", F.col("n") - F.size("tokens"))
        .withColumn("room", (room - F.col("alone")).cast("int"))
        .where("room > 0")
        .select("node", "root", "n", "alone", F.posexplode(F.slice("tokens", F.lit(1), F.col("room"))).alias("at", "t"))
        .select("node", "root", "n", F.col("t.token").alias("token"), (F.col("alone") + F.col("at")).alias("place"))
    )
    pairs = prefix_matches(rows, p)
    one = numbered.select(F.col("node").alias("x"), F.col("digest").alias("u"))
    two = numbered.select(F.col("node").alias("y"), F.col("digest").alias("v"))
    return pairs.join(two, "y").join(one, "x").select("u", "v")


def prefix_matches(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs of nodes (x, y) across roots that can reach the threshold, of the nodes' first tokens.

    `rows` (node, root, n, token, place) holds the tokens, places from 0, of each node's set of
    n in one order for all; as many as can come before the first shared one.
    """
    p = percent
    # Needed overlap of sizes a and b: ceil(p * (a + b) / (100 + p)).
    size_class = "cast(floor(ln({}) / ln(1.05)) as int)"
    index = rows.where(f"(n - place) * (100 + {p}) >= {2 * p} * n").withColumns(
        {"role": F.lit(0), "sizes": F.expr(size_class.format("n"))}
    )
    upto = f"least(n, cast(floor((n - place) * (100 + {p}) / {p}.0) as long) - n)"
    probe = (
        rows.withColumn("upto", F.expr(upto))
        .where(f"upto * 100 >= {p} * n and upto > 0")
        .withColumn("role", F.lit(1))
        .withColumn(
            "sizes",
            F.explode(
                F.expr(
                    f"sequence({size_class.format(f'ceil({p} * n / 100.0)')} , {size_class.format('upto')})"
                )
            ),
        )
        .drop("upto")
    )
    placed = cut_lineage(index.unionByName(probe))
    # Under each key the most frequent root is set apart, so that pairs within it are never formed.
    main = cut_lineage(
        placed.groupBy("token", "sizes", "root")
        .agg(F.count(F.lit(1)).alias("c"))
        .groupBy("token", "sizes")
        .agg(F.max_by("root", F.struct("c", "root")).alias("main"), F.count(F.lit(1)).alias("roots"))
        .where("roots > 1")
    )
    placed = cut_lineage(placed.join(main, ["token", "sizes"]).withColumn("odd", F.col("root") != F.col("main")))
    short = placed.where("role = 0").select(
        "token", "sizes", "odd", F.col("node").alias("y"), F.col("n").alias("ny"), F.col("place").alias("py"),
        F.col("root").alias("ry"),
    )
    long = placed.where("role = 1").select(
        "token", "sizes", "odd", F.col("node").alias("x"), F.col("n").alias("nx"), F.col("place").alias("px"),
        F.col("root").alias("rx"),
    )
    fits = (
        "rx != ry and ny <= nx and least(nx - px, ny - py) * (100 + {0}) >= {0} * (nx + ny)".format(p)
    )
    odd_short = short.where("odd").drop("odd").join(long.drop("odd"), ["token", "sizes"]).where(fits)
    odd_long = short.where("not odd").drop("odd").join(long.where("odd").drop("odd"), ["token", "sizes"]).where(fits)
    found = odd_short.select("x", "y").unionByName(odd_long.select("x", "y"))
    return found.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()


def near_duplicates(
    docs: DataFrame,
    percent: int = 85,
    id_column: str = "doc_id",
    text_column: str = "text",
    width: int = SHINGLE_WORDS,
) -> DataFrame:
    """Per row: its id, n_shingles, component_id and kept (id = component_id).

    Two documents are linked if the Jaccard similarity of their sets of `width`-word shingles
    (A-Z lowered; shorter texts are one shingle) is at least `percent` of 100. NULL and empty
    texts and texts without words have no shingles, are linked with nothing and kept. Rows
    that repeat an id share its decision if their texts are in one component. Rows without an
    id name no component that has another; they are kept only where no row of theirs has an id.
    No rows give no rows. Other columns are not read.
    """
    return _decided(docs, percent, id_column, text_column, width).select(
        F.col("id").alias(id_column),
        F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"),
    )


def _decided(docs: DataFrame, percent: int, id_column: str, text_column: str, width: int) -> DataFrame:
    """id, mark (of the text), n and component of every row."""
    with run_folder(docs.sparkSession):
        return finished(_named(docs, percent, id_column, text_column, width))


def _named(docs: DataFrame, percent: int, id_column: str, text_column: str, width: int) -> DataFrame:
    rows, bands = banding(percent)
    count = rows * bands
    with step_copy(_profiles(docs, id_column, text_column, width, count)) as profile:
        narrow = cut_lineage(profile.select("id", "mark", "n", "digest"))
        classes = cut_lineage(
            profile.where("n > 0")
            .groupBy("digest")
            .agg(F.first("n").alias("n"), F.first("signature").alias("signature"), F.min(F.struct("id", "mark")).alias("rep"))
        )
    found = _links(docs, classes, percent, id_column, text_column, width, rows, bands)
    if found is None:
        rooted = narrow.withColumn("root", F.col("digest"))
    else:
        stars = components(found)
        rooted = narrow.join(stars, F.col("digest") == F.col("node"), "left").withColumn("root", F.coalesce("root", "digest"))
    rooted = cut_lineage(rooted.select("id", "mark", "n", "root"))
    names = cut_lineage(rooted.where("n > 0").groupBy("root").agg(F.min("id").alias("component")))
    alone = rooted.where("n = 0").select("id", "mark", "n", F.col("id").alias("component"))
    return rooted.where("n > 0").join(names, "root").select("id", "mark", "n", "component").unionByName(alone)


def _links(docs, classes, percent, id_column, text_column, width, rows, bands) -> DataFrame | None:
    """Confirmed links between the documents' classes."""

    def sets_of(nodes: DataFrame) -> DataFrame:
        """The sets from one text of each class."""
        chosen = classes.join(nodes, "digest").select(
            "digest", F.col("rep.id").alias("rid"), F.col("rep.mark").alias("rmark")
        )
        wanted = settle(chosen).frame
        text = F.coalesce(quoted(text_column).cast("string"), F.lit(""))
        texts = docs.select(quoted(id_column).alias("id"), F.xxhash64(text).alias("mark"), text.alias("text"))
        texts = texts.join(wanted, F.col("id").eqNullSafe(F.col("rid")) & (F.col("mark") == F.col("rmark")))
        return _sets(texts, width).dropDuplicates(["digest"])

    return links_between(classes.drop("rep"), sets_of, percent, rows, bands)


def links_between(
    classes: DataFrame, sets_of: Callable[[DataFrame], DataFrame], percent: int, rows: int, bands: int
) -> DataFrame | None:
    """Links (u, v) between classes that connect all that confirmed links connect, and nothing else.

    `classes` holds digest, n and signature once per class; `sets_of` gives digest, n and
    shingles for a frame of digests. None if no two classes share a bucket.
    """
    count = rows * bands
    keys = F.array(*[
        F.xxhash64(F.lit(i), F.expr(f"substring(signature, {WIDE * rows * i + 1}, {WIDE * rows})")) for i in range(bands)
    ])
    members = classes.select("digest", F.explode(keys).alias("key"))
    buckets = cut_lineage(
        members.groupBy("key").agg(F.min("digest").alias("lowest"), F.count(F.lit(1)).alias("c")).where("c > 1").drop("c")
    )
    members = cut_lineage(members.join(buckets, "key"))
    pairs = cut_lineage(
        members.where("digest != lowest").select(F.col("lowest").alias("u"), F.col("digest").alias("v")).distinct()
    )
    if pairs.isEmpty():
        return None
    nodes = cut_lineage(members.select("digest").distinct())
    held = cut_lineage(classes.join(nodes, "digest"))
    sets = cut_lineage(sets_of(nodes))

    screened = cut_lineage(_screened(pairs, held, percent, count))
    links = cut_lineage(confirmed(screened, sets, percent))
    stars = components(links)
    rooted = cut_lineage(_rooted(members, stars))
    if ROUNDS:
        pairs = cut_lineage(hub_pairs(rooted, ROUNDS))
        if pairs.isEmpty():
            return _edges(stars)
        more = cut_lineage(confirmed(cut_lineage(_screened(pairs, held, percent, count)), sets, percent))
        if not more.isEmpty():
            stars = components(_edges(stars).unionByName(more))
            rooted = cut_lineage(_rooted(members, stars))
    undecided = rooted.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a != b").select("key")
    open_nodes = cut_lineage(rooted.join(cut_lineage(undecided), "key").select("digest", "root").distinct())
    if open_nodes.isEmpty():
        return _edges(stars)
    crossing = cut_lineage(_prefix_pairs(sets, open_nodes, percent))
    return _edges(stars).unionByName(confirmed(crossing, sets, percent))


def _edges(stars: DataFrame) -> DataFrame:
    """Stars (node, root) as links (u, v), which connect the same classes."""
    return stars.select(F.col("node").alias("u"), F.col("root").alias("v"))


def _rooted(members: DataFrame, stars: DataFrame) -> DataFrame:
    """key, digest and root of the buckets' members."""
    found = members.join(stars, F.col("digest") == F.col("node"), "left")
    return found.select("key", "digest", F.coalesce("root", "digest").alias("root"))


def hub_pairs(rooted: DataFrame, hubs: int) -> DataFrame:
    """Pairs (u, v) of the buckets that still hold several roots: all members of the smaller
    roots with some members of the most frequent one."""
    chosen = F.array(*[F.min_by("digest", F.xxhash64(F.lit(i), "digest")) for i in range(hubs)])
    roots = rooted.groupBy("key", "root").agg(F.count(F.lit(1)).alias("c"), chosen.alias("hubs"))
    main = (
        roots.groupBy("key")
        .agg(F.max_by(F.struct("root", "hubs"), F.struct("c", "root")).alias("m"), F.count(F.lit(1)).alias("roots"))
        .where("roots > 1")
        .select("key", F.col("m.root").alias("main"), F.col("m.hubs").alias("hubs"))
    )
    odd = rooted.join(cut_lineage(main), "key").where("root != main")
    each = odd.select("digest", F.explode(F.array_distinct("hubs")).alias("hub"))
    return each.select(F.least("digest", "hub").alias("u"), F.greatest("digest", "hub").alias("v")).distinct()


def drop_near_copies(
    docs: DataFrame, percent: int = 80, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The rows that `near_duplicates` keeps, with all their columns, each judged by its own text."""
    found = _decided(docs, percent, id_column, text_column, SHINGLE_WORDS)
    gone = found.where(~F.col("id").eqNullSafe(F.col("component")))
    bad = settle(gone.select(F.col("id").alias("bad"), F.col("mark").alias("bad_mark")).distinct()).frame
    mark = F.xxhash64(F.coalesce(quoted(text_column).cast("string"), F.lit("")))
    rows = docs.select(as_row(docs), quoted(id_column).alias("id"), mark.alias("mark"))
    return rows.join(bad, F.expr("id <=> bad and mark = bad_mark"), "left_anti").select(*own_columns(docs))
