"""The sink tables as views over the ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.expressions import stable_event_id


def rejections(ledger: DataFrame) -> DataFrame:
    """One row per rejected delivery. A delivery has at most one rejection, so its id serves both."""
    return ledger.filter(F.col("disposition") == "rejected").select(
        F.col("delivery_id").alias("rejection_id"),
        "delivery_id",
        "topic",
        "source",
        "reason_code",
        "details",
        F.col("processed_at").alias("rejected_at"),
    )


def first_deliveries(ledger: DataFrame) -> DataFrame:
    """The deliveries that brought an event for the first time."""
    return ledger.filter(F.col("disposition").isin("accepted", "stale"))


def processed_events(ledger: DataFrame) -> DataFrame:
    """Registry of unique logical events; their first delivery is the ledger row itself."""
    return first_deliveries(ledger).select(
        "event_id",
        "source",
        "entity_key",
        "source_version",
        "content_hash",
        "envelope",
        F.col("delivery_id").alias("first_delivery_id"),
    )


def registry(ledger: DataFrame) -> DataFrame:
    """The slim part of ``processed_events`` that classification needs."""
    return processed_events(ledger).select("event_id", "source", "entity_key", "source_version", "content_hash")


def orders_current(ledger: DataFrame) -> DataFrame:
    """Highest version per entity.

    The winner was always accepted, so stale rows need not be read. The rank filter prunes each task's rows
    before the shuffle, which also keeps a hot entity small.
    """
    latest = W.partitionBy("source", "entity_key").orderBy(F.col("source_version").desc())
    return (
        ledger.filter(F.col("disposition") == "accepted")
        .withColumn("_rank", F.row_number().over(latest))
        .filter(F.col("_rank") == 1)
        .select(
            "source",
            "entity_key",
            "source_version",
            F.col("envelope.source_updated_at").alias("source_updated_at"),
            F.col("envelope.payload").alias("payload"),
            F.col("envelope.payload.total_price").alias("total_price"),
            F.col("event_id").alias("last_event_id"),
            F.col("captured_at").alias("last_captured_at"),
            F.col("processed_at").alias("updated_at"),
        )
    )


def accepted_states(deliveries: DataFrame) -> DataFrame:
    """What the accepted ones of stored deliveries (``operators/slim.py``) say about their entities, every version."""
    return deliveries.filter(F.col("disposition") == "accepted").select(
        "source",
        "entity_key",
        "source_version",
        F.col("occurred_at").alias("source_updated_at"),
        "payload",
        F.col("captured_at").alias("last_captured_at"),
        F.col("processed_at").alias("updated_at"),
    )


def whole_current(stored: DataFrame) -> DataFrame:
    """``orders_current`` from the stored state, which leaves out what follows from the rest."""
    return stored.select(
        "source",
        "entity_key",
        "source_version",
        "source_updated_at",
        "payload",
        F.col("payload.total_price").alias("total_price"),
        stable_event_id(F.col("source"), F.col("entity_key"), F.col("source_version")).alias("last_event_id"),
        "last_captured_at",
        "updated_at",
    )


def merge_current(snapshot: DataFrame, newer: DataFrame) -> DataFrame:
    """Compact two states into one row per entity; a lower version never replaces a higher one.

    ``newer`` may hold several versions of an entity: each task ranks its rows before the one shuffle. Equal versions only meet when a batch is written again: then the later writing counts.
    """
    latest = W.partitionBy("source", "entity_key").orderBy(F.col("source_version").desc(), F.col("_age"))
    return (
        snapshot.withColumn("_age", F.lit(1))
        .unionByName(newer.withColumn("_age", F.lit(0)))
        .withColumn("_rank", F.row_number().over(latest))
        .filter(F.col("_rank") == 1)
        .drop("_rank", "_age")
    )
