"""Named queries of this subpackage: thin applications of its operators to whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, embeddings, fingerprints, infill, jaccard, licenses, lm, packing, pii, suffixes, toxicity, trie, urls
from tidemark.llm.common import table


# The rules of the URL filter.
URL_RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judge every page's URL."""
    return urls.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every document."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode_documents(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score every document for toxicity."""
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group documents by links of Jaccard similarity 0.9 or more over 3-word shingles."""
    return jaccard.jaccard_groups(table(spark, sf_dir, "documents"), size=3, percent=90)


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack all documents into sequences of at most 1024 tokens."""
    spec = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack_documents(table(spark, sf_dir, "documents"), spec, public_tokenizers.PATTERN)


def op6_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint every document and its edited text."""
    return fingerprints.fingerprint_documents(table(spark, sf_dir, "documents"))


def op7_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Find licence notices in every document."""
    return licenses.scan(table(spark, sf_dir, "documents")).drop("found")


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Link all vectors with a cosine of 0.9 or more."""
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remove the passages of 200 bytes that occur more than once."""
    done = suffixes.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, span: n + span["end"] - span["start"])
    return done.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Find personal data and disclosing terms in every document."""
    return pii.digests(table(spark, sf_dir, "documents"))


def op11_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score every document by an attention model learned from the training texts, and by shares of words."""
    return lm.score_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transform every document for infilling, and rebuild it."""
    return infill.digests(infill.pieces(table(spark, sf_dir, "documents")))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all rebuilt conversations."""
    nodes = trie.prefix_trie(table(spark, sf_dir, "conversations"))
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_url_filters,
        op2_byte_bpe,
        op3_toxicity,
        op4_ngram_jaccard_join,
        op5_best_fit_packing,
        op6_document_fingerprints,
        op7_license_scans,
        op8_embedding_near_dedup,
        op9_suffix_array_dedup,
        op10_pii,
        op11_lm_scoring,
        op12_fill_in_middle,
        op13_conversation_trie,
    )
}

ORACLES: dict[str, str] = {
    "op12_fill_in_middle": """
        WITH cut AS (
            SELECT doc_id, coalesce(text, '') AS body, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
            FROM documents
        ), drawn AS (
            SELECT *, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (n + 1) AS a, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (n + 1) AS b,
                CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 AS c, CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 AS d
            FROM cut
        ), shaped AS (
            SELECT *, CASE
                    WHEN n = 0 OR contains(body, '<P>') OR contains(body, '<S>') OR contains(body, '<M>') OR c >= 90 THEN 'plain'
                    WHEN d < 20 THEN 'spm' ELSE 'psm' END AS form,
                substr(body, 1, least(a, b)) AS prefix,
                substr(body, least(a, b) + 1, greatest(a, b) - least(a, b)) AS middle,
                substr(body, greatest(a, b) + 1) AS suffix
            FROM drawn
        )
        SELECT doc_id, n, form,
            CASE WHEN form <> 'plain' THEN least(a, b) END AS prefix_chars,
            CASE WHEN form <> 'plain' THEN greatest(a, b) - least(a, b) END AS middle_chars,
            sha256(CASE form WHEN 'plain' THEN body WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
            sha256(body) AS restored_sha256
        FROM shaped
    """,
    "op13_conversation_trie": """
        WITH turns AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
            FROM conversations WHERE conv_id IS NOT NULL
        ), listed AS (
            SELECT conv_id, list({'role': role, 'text': text} ORDER BY pos) AS own FROM turns GROUP BY conv_id
        ), begun AS (
            SELECT *, xor(list_reduce(
                    list_transform(range(1, length(CAST(conv_id AS VARCHAR)) + 1), lambda i: CAST(ascii(substr(CAST(conv_id AS VARCHAR), i, 1)) AS BIGINT)),
                    lambda c, b: list_reduce(range(8), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(c, b)),
                    CAST(4294967295 AS BIGINT)
                ), 4294967295) % 9 AS h
            FROM listed
        ), rebuilt AS (
            SELECT c.conv_id, coalesce(b.own, [])[1:c.h] || c.own[c.h + 1:] AS path
            FROM begun c LEFT JOIN begun b ON b.conv_id = c.conv_id - c.conv_id % 5
        ), prefixes AS (
            SELECT conv_id, path[1:d] AS path, d AS depth, len(path) AS total FROM rebuilt, unnest(range(0, len(path) + 1)) AS u(d)
        ), nodes AS (
            SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
                sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE depth = total), '')) AS ends_sha256
            FROM prefixes GROUP BY path, depth
        ), children AS (
            SELECT path[1:depth - 1] AS path, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1, 2
        ), counted AS (
            SELECT n.*, coalesce(c.n_children, 0) AS n_children,
                CASE WHEN n.depth > 0 THEN (n.n_convs - 1) * strlen(n.path[n.depth].text) ELSE 0 END AS saved
            FROM nodes n LEFT JOIN children c ON c.path = n.path AND c.depth = n.depth
        ), sums AS (
            SELECT path[1:d] AS path, d AS depth, count(*) FILTER (WHERE n_children = 0) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens
            FROM counted, unnest(range(0, depth + 1)) AS u(d) GROUP BY 1, 2
        )
        SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
        FROM counted n JOIN sums s ON s.path = n.path AND s.depth = n.depth
            LEFT JOIN nodes p ON p.path = n.path[1:n.depth - 1] AND p.depth = n.depth - 1
    """,
}
