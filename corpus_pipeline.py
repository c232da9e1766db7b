"""The corpus pipeline: from raw documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import jaccard, packing, pii, suffixes, toxicity
from tidemark.llm.common import materialized, table
from tidemark.session import batches_of, configure, ensure_checkpoint_dir

# Rows of texts, sets and contexts hold kilobytes: 10,000 of them in one batch are held by the JVM and by Python, per task.
BATCH = "4m"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _measured(docs: DataFrame) -> DataFrame:
    """The columns of ``documents``, with the length of the text as it is now."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of 0.7 or more go. All other rows stay as they are."""
    return toxicity.without_toxic(docs.select(*COLUMNS), table(spark, sf_dir, "labels")).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by a Jaccard similarity of 0.8 over 5-word shingles, the smallest id stays.

    Documents without words are in no group and stay; repeated rows become one. Rows are told apart by id and text, so
    rows that share an id, or have none, are grouped each for itself; a row with an id stays rather than one without.
    """
    key = F.xxhash64("doc_id", "text", F.col("doc_id").isNull(), F.col("text").isNull()).alias("key")
    groups = materialized(jaccard.jaccard_groups(docs.select(key, "text"), id_column="key", size=5, percent=80).select("key", "component_id").distinct())
    # Only rows of components of two or more are looked at again.
    linked = groups.groupBy("component_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("component_id")
    ids = docs.select(key, "doc_id").distinct()
    members = groups.join(linked, "component_id").join(ids, "key").select("component_id", "key", "doc_id")
    first = members.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key"))["key"].alias("stays"))
    gone = members.join(first, "component_id").filter("key <> stays").select("key")
    # Both steps are dealt by the key, so texts travel once.
    return docs.select(*COLUMNS, key).join(gone, "key", "left_anti").dropDuplicates(["key", "doc_id", "text"]).select(*COLUMNS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 200 bytes or more that occur more than once are taken out of the texts; all documents stay."""
    return _measured(suffixes.without_repeats(docs.select(*COLUMNS)))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data are replaced by their kind and disclosing terms removed; all documents stay. Null is empty text."""
    found = pii.find(docs.select(*COLUMNS))
    text = F.coalesce("text", F.lit(""))
    return _measured(found.withColumn("text", pii.redact(text, F.col("spans"))))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as pieces of sequences of 1024 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("suffix_array_dedup", cut_repeats),
    ("pii", redact_personal_data),
    ("best_fit_packing", pack),
]

# Learned scores, suffix orders and packings cannot be written as SQL; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the table ``documents``; each result is written to the shared folder and read again."""
    configure(spark)
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    with batches_of(spark, BATCH):
        for number, (name, stage) in enumerate(STAGES):
            docs = stage(spark, docs, sf_dir)
            if number < len(STAGES) - 1:
                docs.write.parquet(f"{folder}/{number}-{name}")
                docs = spark.read.parquet(f"{folder}/{number}-{name}")
    return docs
