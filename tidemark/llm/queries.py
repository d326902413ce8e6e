"""The registered queries of this subpackage: thin calls of its operators on whole tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .common import load


def tokenizer(name: str) -> str:
    """The place of a public tokenizer's file; such files are never copied here."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import language_id

    return language_id(load(spark, sf_dir))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secrets import secret_scan

    return secret_scan(load(spark, sf_dir))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_files import token_files

    return token_files(load(spark, sf_dir), tokenizer("word_bpe_49k.json"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import simhash_dedup

    return simhash_dedup(load(spark, sf_dir))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lm_scoring import lm_scores

    return lm_scores(load(spark, sf_dir))


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .embeddings import embedding_dedup

    return embedding_dedup(load(spark, sf_dir, "embeddings"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sharding import shard_by_bytes

    return shard_by_bytes(load(spark, sf_dir))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .exact_dedup import exact_dedup

    return exact_dedup(load(spark, sf_dir)).drop("text_hash", "stays")


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import best_fit_packing

    return best_fit_packing(load(spark, sf_dir), tokenizer("byte_bpe_50k.json"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bpe import bpe_round_trip

    return bpe_round_trip(load(spark, sf_dir), tokenizer("byte_bpe_50k.json"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .repair import repaired_conversations

    return repaired_conversations(load(spark, sf_dir, "conversations"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lexical import lexical_search

    return lexical_search(load(spark, sf_dir), load(spark, sf_dir, "benchmark"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_counts import token_counts

    return token_counts(load(spark, sf_dir), tokenizer("word_bpe_49k.json"))


EXACT_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[ \t-\r]', '', 'g')) AS s FROM documents
), g AS (
  SELECT doc_id, s, first_value(doc_id) OVER (PARTITION BY s ORDER BY n DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY s) AS group_size FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, s AS text_sha256 FROM g
"""

VECTORS_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
n AS (SELECT vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS s FROM v),
ok AS (SELECT vec_id, list_transform(e, lambda x: x / s) AS e FROM n WHERE s > 0 AND isfinite(s) AND len(list_filter(e, lambda x: x IS NULL)) = 0),
l AS (SELECT a.vec_id AS u, b.vec_id AS w FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_inner_product(a.e, b.e) >= 0.9),
r(u, w) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.u, l.w FROM r JOIN l ON r.w = l.u),
c AS (SELECT u, min(w) AS component_id FROM r GROUP BY 1), k AS (SELECT u, count(*) AS n_links FROM l GROUP BY 1)
SELECT v.vec_id, coalesce(k.n_links, 0) AS n_links, c.component_id, v.vec_id = c.component_id AS kept FROM v JOIN c ON c.u = v.vec_id LEFT JOIN k ON k.u = v.vec_id
"""

LEXICAL_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents WHERE text IS NOT NULL
), n AS (SELECT doc_id, t, CAST(len(t) AS BIGINT) AS n FROM d WHERE len(t) > 0),
c AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM n),
p AS (SELECT doc_id, n, unnest(t) AS term FROM n),
f AS (SELECT doc_id, n, term, count(*) AS tf FROM p GROUP BY doc_id, n, term),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM f, c GROUP BY term, docs),
s AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // terms)))) AS BIGINT) AS score
  FROM q JOIN w USING (term) JOIN f USING (term), c GROUP BY item_id, doc_id
), r AS (SELECT item_id, doc_id, score, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return {"op6_embedding_near_dedup": VECTORS_SQL, "op8_exact_dedup": EXACT_SQL, "op12_lexical_search": LEXICAL_SQL}
