"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm import (
    bpe,
    decontam,
    exact,
    html,
    lines,
    lm,
    metric,
    minhash,
    negatives,
    pii,
    runs,
    tokens,
    toxicity,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def _registered(sql: str | None = None) -> Callable[[Query], Query]:
    def keep(query: Query) -> Query:
        QUERIES[query.__name__] = query
        if sql is not None:
            SQL[query.__name__] = sql
        return query

    return keep


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


@_registered(
    r"""
    WITH t AS (
        SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
        FROM documents
    )
    SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id = min(doc_id) OVER w AS kept, text_sha256
    FROM t WINDOW w AS (PARTITION BY text_sha256)
    """
)
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(_table(spark, sf_dir, "documents", "doc_id", "text"))


@_registered(
    r"""
    WITH d AS (
        SELECT doc_id, regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM documents
    ), b AS (
        SELECT item_id, regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM benchmark
    ), win AS (
        SELECT DISTINCT item_id, array_to_string(w[i : i + 9], ' ') AS words, least(len(w), 10) AS n
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
    ), lengths AS (
        SELECT DISTINCT n FROM win
    ), places AS (
        SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths WHERE len(w) >= n
    ), hit AS (
        SELECT doc_id, i, p.n, item_id
        FROM places p JOIN win ON win.n = p.n AND win.words = array_to_string(w[i : i + p.n - 1], ' ')
    ), covered AS (
        SELECT doc_id, count(DISTINCT k) AS n_hit
        FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hit) GROUP BY doc_id
    ), items AS (
        SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id
    )
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
    """
)
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return decontam.contamination(docs, _table(spark, sf_dir, "benchmark", "item_id", "text"))


@_registered()
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return tokens.token_counts(docs, public_tokenizers.path("piece_bpe_32k.model"))


@_registered()
def op3_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return bpe.encoded(docs, public_tokenizers.path("word_bpe_49k.json"))


@_registered()
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    labels = _table(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    return toxicity.scored(docs, docs, labels).drop("text")


@_registered(
    r"""
    WITH RECURSIVE d AS (
        SELECT doc_id, regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x20\x09-\x0D]+') AS w
        FROM documents
    ), s AS (
        SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS g
        FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)
    ), n AS (
        SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
    ), p AS (
        SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared
        FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
    ), l AS (
        SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
        WHERE 100 * shared >= 85 * (nx.n + ny.n - shared)
    ), e AS (
        SELECT x, y FROM l UNION ALL SELECT y, x FROM l
    ), reach AS (
        SELECT doc_id, doc_id AS root FROM d
        UNION
        SELECT e.y, root FROM reach JOIN e ON e.x = reach.doc_id WHERE root < e.y
    ), c AS (
        SELECT doc_id, min(root) AS component_id FROM reach GROUP BY doc_id
    )
    SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
    FROM c LEFT JOIN n USING (doc_id)
    """
)
def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents", "doc_id", "text"), percent=85)


@_registered()
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(_table(spark, sf_dir, "documents", "doc_id", "text"))


@_registered()
def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return lm.likelihoods(docs, public_tokenizers.path("piece_bpe_32k.model"))


@_registered()
def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_texts(_table(spark, sf_dir, "pages", "page_id", "url", "html"))


@_registered()
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.without_duplicate_lines(_table(spark, sf_dir, "documents", "doc_id", "text"))


@_registered()
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = runs.with_planted_runs(_table(spark, sf_dir, "documents", "doc_id", "text"))
    return runs.run_digests(runs.periodic_runs(docs))


@_registered(
    """
    WITH RECURSIVE v AS (
        SELECT vec_id, embedding::DOUBLE[] AS x,
               coalesce(len(embedding), 0) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
               AND len(list_filter(embedding, lambda c: c != 0)) > 0 AS fine
        FROM embeddings
    ), e AS (
        SELECT a.vec_id AS x, b.vec_id AS y
        FROM v a JOIN v b ON a.fine AND b.fine AND a.vec_id != b.vec_id AND list_cosine_similarity(a.x, b.x) >= 0.9
    ), reach AS (
        SELECT vec_id, vec_id AS root FROM v
        UNION
        SELECT e.y, root FROM reach JOIN e ON e.x = reach.vec_id WHERE root < e.y
    )
    SELECT vec_id, coalesce(any_value(n), 0) AS n_links, min(root) AS component_id, vec_id = min(root) AS kept
    FROM reach LEFT JOIN (SELECT x AS vec_id, count(*) AS n FROM e GROUP BY x) USING (vec_id)
    GROUP BY vec_id
    """
)
def op12_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric.near_vectors(_table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


@_registered(
    """
    WITH v AS (
        SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x
        FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
    ), s AS (
        SELECT a.id AS anchor_id, b.id, a.label = b.label AS same, list_dot_product(a.x, b.x)::BIGINT AS score
        FROM v a JOIN v b ON a.id % 100 = 0 AND a.id != b.id
    ), p AS (
        SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
    )
    SELECT anchor_id, positive_id, id AS negative_id, positive_score, score AS negative_score,
           (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id))::INTEGER AS rank
    FROM p JOIN s USING (anchor_id)
    WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
    QUALIFY rank <= 5
    """
)
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings", "vec_id", "label", "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.withColumn("label", moved))
