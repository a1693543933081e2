"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .common import read_table


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_files import token_files

    return token_files(read_table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secret_scan import scan_secrets

    return scan_secrets(read_table(spark, sf_dir, "documents"))


def op3_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .html_extract import extract_pages

    return extract_pages(read_table(spark, sf_dir, "pages"))


def op4_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .imatch import edited_fingerprints

    return edited_fingerprints(read_table(spark, sf_dir, "documents"))


def op5_embed_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .embed_dedup import embedding_components

    return embedding_components(read_table(spark, sf_dir, "embeddings"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import warc_round_trip

    return warc_round_trip(read_table(spark, sf_dir, "pages")).drop("url")


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard_join import jaccard_components

    return jaccard_components(read_table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import score_toxicity

    return score_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op9_trie_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .trie_bpe import trie_bpe

    return trie_bpe(read_table(spark, sf_dir, "documents"), _vocabulary("word_bpe_49k.json"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mixing_rates

    return mixing_rates(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_files": op1_token_files,
    "op2_secret_scan": op2_secret_scan,
    "op3_html_extract": op3_html_extract,
    "op4_imatch": op4_imatch,
    "op5_embed_dedup": op5_embed_dedup,
    "op6_warc": op6_warc,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_toxicity": op8_toxicity,
    "op9_trie_bpe": op9_trie_bpe,
    "op10_mixing": op10_mixing,
}

SQL: dict[str, str] = {
    "op5_embed_dedup": """
        WITH RECURSIVE v AS (
            SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
        ), u AS (
            SELECT r, vec_id, e, sqrt(list_dot_product(e, e)) AS norm FROM v
            WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
        ), links AS (
            SELECT a.r AS a, b.r AS b, b.vec_id AS other FROM u a JOIN u b ON a.r <> b.r AND len(a.e) = len(b.e) AND list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 95e-2
        ), reach AS (
            SELECT r, r AS t FROM v UNION SELECT reach.r, links.b FROM reach JOIN links ON links.a = reach.t
        ), first AS (
            SELECT reach.r, min(v.vec_id) AS component_id FROM reach JOIN v ON v.r = reach.t GROUP BY reach.r
        ), n AS (
            SELECT a AS r, count(*) AS n_links FROM links GROUP BY a
        )
        SELECT vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
        FROM v JOIN first ON first.r = v.r LEFT JOIN n ON n.r = v.r""",
    "op6_warc": """
        WITH p AS (
            SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
        ), d AS (
            SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes, sha256(payload) AS payload_digest FROM p
        ), f AS (
            SELECT payload_digest, min(page_id) AS first_id FROM d WHERE payload_bytes >= 100 GROUP BY payload_digest
        )
        SELECT d.page_id, d.payload_bytes, d.payload_digest,
               CASE WHEN first_id < d.page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN first_id < d.page_id THEN first_id END AS refers_to
        FROM d LEFT JOIN f ON d.payload_digest = f.payload_digest""",
    "op7_jaccard_join": r"""
        WITH RECURSIVE d AS (
            SELECT row_number() OVER () AS r, doc_id,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
        ), s AS (
            SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                   ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS k FROM d
        ), e AS (
            SELECT r, unnest(k) AS x FROM s
        ), common AS (
            SELECT a.r AS a, b.r AS b, count(*) AS n FROM e a JOIN e b ON a.x = b.x AND a.r <> b.r GROUP BY ALL
        ), links AS (
            SELECT a, b FROM common JOIN s p ON p.r = a JOIN s q ON q.r = b WHERE 100 * n >= 75 * (len(p.k) + len(q.k) - n)
        ), reach AS (
            SELECT r, r AS t FROM s UNION SELECT reach.r, links.b FROM reach JOIN links ON links.a = reach.t
        )
        SELECT s.doc_id, CAST(any_value(len(s.k)) AS BIGINT) AS n_shingles, min(o.doc_id) AS component_id
        FROM s JOIN reach ON reach.r = s.r JOIN s o ON o.r = reach.t GROUP BY s.r, s.doc_id""",
}
